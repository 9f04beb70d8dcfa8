"""Problem 5: repetition inside a transcript, by tokenizer measures and an exact check.

Every transcript is encoded with public vocabularies, which gives characters per token, the share of byte-fallback pieces and
the entropy of its tokens, with rejection bands per script (`bands`). Such measures alone do not give the share of repeated
words. But they bound it: a repeated word is never its first occurrence, and of its tokens (each word encoded by itself, in
lower case) every one has occurred before. With T tokens of n words and D different tokens, T - D >= share * n; as
c * log2(c) >= 2 * (c - 1) for every count c, the entropy H obeys H <= log2(T) - 2 * (T - D) / T, so

    H <= log2(T) - 2 * share / (tokens per word)

is necessary for a share. Transcripts outside this band are rejected without loss; the exact share of the others follows from
runs of four words (hashed, first occurrences by sorting: O(n log n), whatever the length).

Defined results: null, empty and wordless transcripts and those under five words have share 0; words are parted by white
space and punctuation, compared in lower case; repeated rows are measured as often as they occur.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tokens import BYTE_BPE, FOLDER, load

RUN, SHARE = 4, 0.3
PIECES = "piece_bpe_32k.model"
# The letters of each script, as ranges of code points.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F), (0x1E00, 0x1EFF)], "greek": [(0x370, 0x3FF)], "cyrillic": [(0x400, 0x52F)], "armenian": [(0x530, 0x58F)], "hebrew": [(0x590, 0x5FF)], "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x963), (0x966, 0x97F)], "bengali": [(0x980, 0x9FF)], "gurmukhi": [(0xA00, 0xA7F)], "gujarati": [(0xA80, 0xAFF)], "odia": [(0xB00, 0xB7F)], "tamil": [(0xB80, 0xBFF)], "telugu": [(0xC00, 0xC7F)], "kannada": [(0xC80, 0xCFF)], "malayalam": [(0xD00, 0xD7F)], "sinhala": [(0xD80, 0xDFF)],
    "thai": [(0xE00, 0xE7F)], "georgian": [(0x10A0, 0x10FF)], "ethiopic": [(0x1200, 0x137F)], "kana": [(0x3040, 0x30FF)], "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)], "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
}
_pieces: dict[str, object] = {}


def words_of(text: str) -> list[str]:
    import regex

    return [w for w in regex.split(r"[\s\p{P}]+", text.lower()) if w]


def repeated_share(words: list[str], run: int = RUN) -> float:
    """The share of words inside a run of `run` words that also began earlier."""
    number: dict[str, int] = {}
    return _share(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)), len(number), run)


def _share(ids: np.ndarray, different: int, run: int) -> float:
    """repeated_share of word numbers below `different`."""
    n = len(ids)
    if n <= run:
        return 0.0
    code = ids[: n - run + 1]
    for k in range(1, run):  # exact: codes are renumbered after each word, so they stay below n
        code = code * different + ids[k : n - run + 1 + k]
        if k + 1 < run and different ** (k + 2) > 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
    first = np.unique(code, return_index=True)[1]
    later = np.ones(len(code), bool)
    later[first] = False
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, np.flatnonzero(later), 1)
    np.add.at(marks, np.flatnonzero(later) + run, -1)
    return float((np.cumsum(marks[:n]) > 0).mean())


def entropy(ids: list[int]) -> float:
    if not ids:
        return 0.0
    c = np.unique(np.asarray(ids), return_counts=True)[1]
    return float(math.log2(len(ids)) - (c * np.log2(c)).sum() / len(ids))


def _script(text: str) -> str:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = {k: sum(int(((code >= a) & (code <= b)).sum()) for a, b in ranges) for k, ranges in SCRIPTS.items()}
    best = max(n, key=n.get)
    return best if n[best] else "none"


def _sentence_pieces(folder: str):
    if folder not in _pieces:
        import sentencepiece

        _pieces[folder] = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{PIECES}")
    return _pieces[folder]


class _Band:
    """Word numbers, token counts and entropy of texts; the tokens of a word are looked up once per worker task."""

    def __init__(self, share: float, folder: str, held: int = 500_000):
        self.tok, self.share, self.held, self.ids, self.chars = load(BYTE_BPE, folder), share, held, {}, 0

    def measure(self, text: str) -> tuple[int, int, int, float, bool, float | None]:
        """(words, their characters, tokens, entropy, in band, repeated share) of a text."""
        words = words_of(text)
        number: dict[str, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
        if not words:
            return 0, 0, 0, 0.0, False, 0.0
        if missing := [w for w in number if w not in self.ids]:
            if len(self.ids) > self.held or self.chars > 100 * self.held:
                self.ids, self.chars, missing = {}, 0, list(number)
            self.chars += sum(map(len, missing))
            self.ids.update(zip(missing, (e.ids for e in self.tok.encode_batch(missing, add_special_tokens=False)), strict=True))
        count: dict[int, int] = {}
        for w, n in zip(number, np.bincount(ids).tolist(), strict=True):
            for i in self.ids[w]:
                count[i] = count.get(i, 0) + n
        c = np.fromiter(count.values(), np.float64, len(count))
        tokens = int(c.sum())
        h = math.log2(tokens) - float((c * np.log2(c)).sum()) / tokens
        band = h <= math.log2(tokens) - 2 * self.share * len(words) / tokens + 1e-9
        return len(words), sum(map(len, words)), tokens, h, band, _share(ids, len(number), RUN) if band else None


def measures(rows: DataFrame, key: str, text: str, share: float = SHARE, folder: str = FOLDER) -> DataFrame:
    """(key, script, words, tokens, chars_per_token, fallback_share, token_entropy, in_band, repeated_share) of every row.

    in_band is the necessary condition for `share`; repeated_share is null outside the band, where it is below `share`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band, sp = _Band(share, folder), _sentence_pieces(folder)
        for batch in batches:
            out = []
            for t in batch.column(1):
                t = t.as_py() or ""
                words, chars, tokens, h, inside, repeated = band.measure(t)
                pieces = sp.encode(t, num_threads=1) if t else []
                fallback = sum(map(sp.is_byte, pieces)) / len(pieces) if pieces else 0.0
                out.append((_script(t), words, tokens, chars / max(1, tokens), fallback, h, inside, repeated))
            cols = [pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 8, _KINDS, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["k", *_NAMES])

    own = rows.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    kind = own.schema["k"].dataType.simpleString()
    head = "script string, words long, tokens long, chars_per_token double, fallback_share double, token_entropy double, in_band boolean, repeated_share double"
    return own.mapInArrow(run, f"k {kind}, {head}").withColumnRenamed("k", key)


_NAMES = ["script", "words", "tokens", "chars_per_token", "fallback_share", "token_entropy", "in_band", "repeated_share"]
_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_(), pa.float64()]


def bands(measured: DataFrame, outside: float = 0.02) -> DataFrame:
    """(script, lo, hi, n): the band of characters per token of each script, by quantiles over all its rows."""
    q = lambda p: F.percentile_approx("chars_per_token", F.lit(p), F.lit(10_000))
    return measured.where("tokens > 0").groupBy("script").agg(q(outside / 2).alias("lo"), q(1 - outside / 2).alias("hi"), F.count("*").alias("n"))


def rejected(measured: DataFrame, outside: float = 0.02) -> DataFrame:
    """The measured rows with odd: whether characters per token lie outside the band of the row's script."""
    odd: Column = (F.col("chars_per_token") < F.col("lo")) | (F.col("chars_per_token") > F.col("hi"))
    return measured.join(F.broadcast(bands(measured, outside)).drop("n"), "script", "left").withColumn("odd", F.coalesce(odd, F.lit(False))).drop("lo", "hi")


def repetitive(rows: DataFrame, key: str = "audio_id", text: str = "transcript", share: float = SHARE, folder: str = FOLDER) -> DataFrame:
    """(key) of the rows at least `share` of whose words are repeated: inside the band, and by the exact share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band = _Band(share, folder)
        for batch in batches:
            keep = [band.measure(t.as_py() or "")[4:] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array([inside and (r or 0.0) >= share for inside, r in keep], pa.bool_()))], names=["k"])

    own = rows.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    return own.mapInArrow(run, f"k {own.schema['k'].dataType.simpleString()}").withColumnRenamed("k", key)
