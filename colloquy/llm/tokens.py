"""Problem 6: encoding the corpus with a public tokenizer, over Arrow batches.

A byte-level tokenizer writes each byte of the UTF-8 text as one character of a 256-entry table; tokens are strings over that
table, so a character of several bytes may be split between tokens. Decoding therefore joins the tokens' strings first,
reverses the byte table, and decodes UTF-8 once at the end: every text comes back exactly. Offsets are in characters of the
text; tokens inside one split character share its offsets.

Defined results: null and empty texts get an empty list; strings that look like special tokens are ordinary text; repeated
rows are encoded as often as they occur; very long texts are encoded whole. A batch is cut into slices of bounded characters,
so memory follows the slice (or the one longest text), not Arrow's batch.

The tokenizer parts a text into words before it merges bytes, and words never join across a space or line break that follows
another character. Texts are therefore cut at such places and each different piece is encoded once per worker (`Pieces`): the ids
are the same as of the whole text, at a fraction of the time, as most words of a corpus are frequent ones.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FOLDER = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.json"
SLICE_CHARS, HELD_PIECES, HELD_CHARS = 2_000_000, 500_000, 200
_loaded: dict[str, object] = {}
_held: dict[str, dict[str, bytes]] = {}
# Characters that no engine takes for white space; a cut is made only between one of them and a space or line break.
_SURE = r"[^\s\x00-\x20\x7f-\xa0\xad\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]"
_PIECE = re.compile(rf"[ \n]?{_SURE}+(?=[ \n]|\Z)|.+?{_SURE}(?=[ \n]|\Z)|.+\Z", re.DOTALL)


def load(name: str = BYTE_BPE, folder: str = FOLDER):
    """The tokenizer, once per worker process; one thread, as each core has its own task."""
    path = f"{folder}/{name}"
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True
        _loaded[path] = tok
    return _loaded[path]


class Pieces:
    """Ids of texts as bytes of 32-bit integers, put together from those of their pieces."""

    def __init__(self, name: str = BYTE_BPE, folder: str = FOLDER):
        self.tok, self.held = load(name, folder), _held.setdefault(f"{folder}/{name}", {})

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [_PIECE.findall(t) for t in texts]
        if len(self.held) > HELD_PIECES:
            self.held.clear()
        new = list({p for ps in parts for p in ps if p not in self.held})
        ids = {p: np.asarray(e.ids, np.int32).tobytes() for p, e in zip(new, self.tok.encode_batch_fast(new, add_special_tokens=False), strict=True)}
        self.held.update((p, i) for p, i in ids.items() if len(p) <= HELD_CHARS)
        of = (lambda p: ids[p] if p in ids else self.held[p]) if any(len(p) > HELD_CHARS for p in ids) else self.held.__getitem__
        return [b"".join(map(of, ps)) for ps in parts]


def byte_table() -> dict[str, int]:
    """Character -> byte: printable Latin-1 stands for itself, the other bytes for the characters from U+0100 on, in order."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def decode(ids: list[int], name: str = BYTE_BPE, folder: str = FOLDER) -> str:
    tok, table = load(name, folder), byte_table()
    return bytes(table[c] for i in ids for c in tok.id_to_token(i)).decode("utf-8", errors="replace")


def slices(texts: pa.Array, chars: int = SLICE_CHARS) -> Iterator[list[str]]:
    """The texts (null as empty) in runs of at most `chars` characters, a longer text alone."""
    run, held = [], 0
    for t in texts:
        t = t.as_py() or ""
        if run and held + len(t) > chars:
            yield run
            run, held = [], 0
        run.append(t)
        held += len(t)
    if run:
        yield run


def encode(documents: DataFrame, key: str = "doc_id", text: str = "text", name: str = BYTE_BPE, folder: str = FOLDER) -> DataFrame:
    """(key, ids) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(name, folder)
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                got = pieces.encode(texts)
                ends = pa.array(np.cumsum([0, *map(len, got)]) // 4, pa.int32())
                ids = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(got), np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), ids], names=["k", "ids"])
                at += len(texts)

    rows = documents.select(F.col(key).alias("k"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["k"].dataType.simpleString()
    return rows.mapInArrow(run, f"k {kind}, ids array<int>").withColumnRenamed("k", key)


def decode_rows(encoded: DataFrame, key: str = "doc_id", name: str = BYTE_BPE, folder: str = FOLDER) -> DataFrame:
    """(key, text) of rows (key, ids); null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, table = load(name, folder), byte_table()
        pieces: dict[int, bytes] = {}
        for batch in batches:
            texts = []
            for ids in batch.column(1).to_pylist():
                for i in set(ids or ()) - pieces.keys():
                    pieces[i] = bytes(table[c] for c in tok.id_to_token(i))
                texts.append(None if ids is None else b"".join(map(pieces.__getitem__, ids)).decode("utf-8", errors="replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["k", "text"])

    rows = encoded.select(F.col(key).alias("k"), "ids")
    return rows.mapInArrow(run, f"k {rows.schema['k'].dataType.simpleString()}, text string").withColumnRenamed("k", key)


def encode_offsets(documents: DataFrame, key: str = "doc_id", text: str = "text", name: str = BYTE_BPE, folder: str = FOLDER) -> DataFrame:
    """(key, ids, starts, ends): with each token's character range in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, ints = load(name, folder), pa.list_(pa.int32())
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                got = tok.encode_batch(texts, add_special_tokens=False)
                cols = [[e.ids for e in got], [[a for a, _ in e.offsets] for e in got], [[b for _, b in e.offsets] for e in got]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), *[pa.array(c, ints) for c in cols]], names=["k", "ids", "starts", "ends"])
                at += len(texts)

    rows = documents.select(F.col(key).alias("k"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["k"].dataType.simpleString()
    return rows.mapInArrow(run, f"k {kind}, ids array<int>, starts array<int>, ends array<int>").withColumnRenamed("k", key)


def count_tokens(documents: DataFrame, *keep: str, text: str = "text", name: str = BYTE_BPE, folder: str = FOLDER) -> DataFrame:
    """The kept columns and tokens, the number of tokens of each row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(name, folder)
        for batch in batches:
            n = []
            for texts in slices(batch.column(batch.num_columns - 1)):
                n += [len(ids) // 4 for ids in pieces.encode(texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64())], names=[*keep, "tokens"])

    rows = documents.select(*keep, F.col(text).cast("string").alias("__text"))
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"{kinds}, tokens long")
