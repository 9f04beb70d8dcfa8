"""Problem 8: text decoded with a wrong encoding: learned from near-twins, applied to every document.

1. Inventory. Every document counts its different characters outside stretches that read as a byte pattern (document frequencies).
2. Twins. Words (parted by ASCII white space) and whole lines are stripped of their non-ASCII characters; what is left, with the byte length of
   each stretch left out and the order in which its bytes recur, is the key on which garbled words meet clean ones (a garbled
   stretch has one character a byte, a clean one is UTF-8). No table is needed for that: any word may be the garbled side. Words
   too poor in such features are not used. Both sides are made distinct first, so copies never multiply, and a key that several
   clean words share says nothing, so a garbled word meets one clean word at most; a bit filter of the keys that occur on both
   sides keeps words without a partner out of the shuffle.
3. Alignment. The characters of a pair's stretches are laid against the UTF-8 bytes of its twin; where all agree with one wrong
   encoding of the family below, that encoding gets the word's support, and its character sequences become learned mappings.
   Where none agrees and none reads the word as UTF-8, the sequences are learned under the name `TWIN`, if two words (or two lines) show them
   and more than twice as many as show anything else for them (words of one pattern make chance twins).
   Pairs of neighbouring letters of the 8-bit alphabets are counted as well (at most the square of some 900 letters).
4. Application. In every document, whole texts: each stretch of non-ASCII characters around a suspicious pattern or a mapping of
   `TWIN` is turned back by the learned mappings, and where they do not cover it by the table of an encoding, layer by layer, and
   the most plausible result is taken. It must explain the whole stretch, and its characters must be known from clean text. Short
   stretches need an encoding learned from twins, or shown by long stretches of the same text, which speak for themselves.
   Double-byte encodings and swapped UTF-16 lose or swallow ASCII characters, so no stripped twin exists for them; they are
   recognised by their bytes alone, by the same rules. Lines or words whose letter pairs are unusual are read as one 8-bit
   encoding taken for another, and turned back if that makes their pairs usual ones. Undecodable bytes (U+FFFD) match any byte
   and leave U+FFFD. `evidence` tells for each document which of these ways were taken: mapping (learned sequences alone), table
   (the table of an encoding), bytes, pairs, or lost.

Defined results: null, empty and ASCII texts are not garbled; repeated rows are judged alike; a text with nothing but lost
characters (U+FFFD) is reported, unrestored; empty tables give no rows. Only the inventory (at most one row a Unicode character
or pair of 8-bit letters), the bit filter of twins' keys (2 MB) and the mappings (one row an encoding and character) reach the driver.
"""

from __future__ import annotations

import codecs
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import cut

# Encodings text is wrongly decoded with.
SINGLE = ["cp1252", "mac_roman", "cp437", "cp850", "cp1251", "cp1250", "iso8859_2", "iso8859_15", "koi8_r", "cp866", "cp1253", "cp1254", "cp1256", "cp852", "mac_cyrillic"]
DOUBLE = ["gb18030", "big5", "shift_jis", "cp949", "euc_jp"]
LEGACY = ["cp1251", "koi8_r", "cp866", "iso8859_5", "mac_cyrillic", "cp1252", "cp437", "mac_roman", "cp1253", "cp1256"]
ORIGINAL = ["cp1251", "koi8_r", "cp866", "cp1253", "cp1256"]
TWIN = "twin"  # stands for encodings known from near-twins only
LOST = "�"
LONG, NOISE, RARE = 4, 1e-6, 1e-3
WORD_LETTERS, WORD_BYTES, HELD_WORDS, HELD_CHARS = 3, 12, 200_000, 100  # longer words are looked at each time
FILTER_BITS = 24
_RUN = re.compile(r"[^\x00-\x7f]+")
_PARTS, _LETTER, _COUNT = re.compile(r"([^\x00-\x7f]+)"), re.compile("[A-Za-z]"), bytes(range(256))
_UNIT = re.compile(r"[^ \t\r\n\f\v]+")
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_WIDE = re.compile(r"[⺀-퟿-豈-￼　-㏿]")


def _table(name: str) -> dict[str, int]:
    """Character -> byte of the upper half; undefined bytes stand for the control characters of their own number."""
    table = {}
    for b in range(0x80, 0x100):
        c = codecs.decode(bytes([b]), name, "ignore")
        table[c if len(c) == 1 else chr(b)] = b
    if name == "cp1252":
        table = {chr(b): b for b in range(0x80, 0xA0)} | table
    return table


TABLES = {n: _table(n) for n in dict.fromkeys([*SINGLE, *LEGACY, *ORIGINAL])}
BACK = {n: {b: c for c, b in TABLES[n].items()} for n in ORIGINAL}
_EIGHT_BIT = {c for n in LEGACY for c in TABLES[n]}
_LETTERS = {c for n in TABLES for c in TABLES[n] if c.isalpha()}


def _class(table: dict[str, int], lo: int, hi: int, more: str = "") -> str:
    return "[" + "".join(f"\\u{ord(c):04x}" for c, b in sorted(table.items()) if lo <= b <= hi) + more + "]"


def _unit(name: str, lost: str = "\\ufffd") -> str:
    """The pattern of one UTF-8 character seen through the encoding."""
    t = TABLES[name]
    tail = _class(t, 0x80, 0xBF, lost)
    return f"(?:{_class(t, 0xC2, 0xDF)}{tail}|{_class(t, 0xE0, 0xEF)}{tail}{tail}|{_class(t, 0xF0, 0xF4)}{tail}{tail}{tail})"


_COVERED = re.compile("|".join(f"(?:{_unit(n)})+" for n in SINGLE))
_LEADS = {c for n in SINGLE for c, b in TABLES[n].items() if 0xC2 <= b <= 0xF4}
_UNITS = {n: re.compile(_unit(n)) for n in SINGLE}
_LENIENT = {n: re.compile(f"{_unit(n)}|{_class(TABLES[n], 0xE0, 0xEF)}{_class(TABLES[n], 0x80, 0xBF)}(?={_class(TABLES[n], 0xC2, 0xF4)}|$)") for n in SINGLE}
_BROKEN = {n: re.compile(f"(?:{_class(TABLES[n], 0xF0, 0xF4)}{_class(TABLES[n], 0x80, 0xBF)}{{2}})+") for n in SINGLE}
_OTHER = r"\ufffd\u1000-\u1fff\u2300-\u2dff\ua000-\uabff\u0080-\u009f"
_SUSPECT = re.compile("|".join(map(_unit, SINGLE)) + f"|{_WIDE.pattern}|[{_OTHER}]")
_ODD = re.compile("[" + "".join(f"\\u{ord(c):04x}" for c in sorted(_LEADS)) + _WIDE.pattern[1:-1] + _OTHER + "]")  # a quick look first


def suspicious(run: str) -> bool:
    """Whether a stretch of non-ASCII characters reads, as a whole, as UTF-8 seen through one of the encodings."""
    return run[0] in _LEADS and _COVERED.fullmatch(run) is not None


def _reread(run: str, wrong: str, right: str) -> str:
    return "".join(BACK[right][TABLES[wrong][c]] for c in run)


def _word(text: str) -> bool:
    """Letters of one block in a natural pattern of cases."""
    return text.isalpha() and len({ord(c) >> 8 for c in text}) == 1 and (text.islower() or text.istitle() or text.isupper() or not text.lower() != text.upper())


class Judge:
    """Turns stretches back; holds document frequencies, letter pair counts, learned encodings and mappings, and a memo of stretches."""

    def __init__(self, frequency: dict[str, int], learned: set[str], pairs: dict[str, int] | None = None, mappings: dict[str, dict[str, str]] | None = None):
        self.frequency, self.learned, self.pairs, self.mappings = frequency, learned, pairs or {}, mappings or {}
        self.taught = re.compile("[" + "".join(map(re.escape, sorted({seen[0] for seen in self.mappings[TWIN]}))) + "]") if self.mappings.get(TWIN) else None
        counts = sorted(self.pairs.values())
        self.usual_least = 0.5 * sum(n * math.log1p(n) for n in counts) / max(1, sum(counts))
        self.blocks = Counter()
        for c, n in frequency.items():
            self.blocks[ord(c) >> 7] += n
        self.most = math.log1p(max(frequency.values(), default=0))
        self.least = max(1.0, NOISE * max(frequency.values(), default=0))  # what a large corpus holds by accident is not known
        self.memo: dict[tuple, tuple | None] = {}
        self.way: dict[str, str] = {}  # of the stretches in the memo
        self.evidence: set[str] = set()  # of the text restored last

    def weight(self, c: str) -> float:
        return math.log1p(self.frequency.get(c, 0))

    def known(self, c: str) -> bool:
        return c < "\x80" or self.frequency.get(c, 0) > self.least or (self.blocks[ord(c) >> 7] > 50 * self.least and (c.isalpha() or unicodedata.category(c)[0] == "M"))

    def _mapped(self, run: str, name: str) -> str | None:
        """The stretch by the mappings learned of an encoding; None where they do not cover it."""
        out, at, mapping = [], 0, self.mappings.get(name, {})
        while at < len(run):
            k = next((k for k in (4, 3, 2) if run[at : at + k] in mapping), 0)
            if not k:
                return None
            out.append(mapping[run[at : at + k]])
            at += k
        return "".join(out)

    def _single(self, run: str, name: str) -> str | None:
        out, at, table = [], 0, TABLES[name]
        for m in _LENIENT[name].finditer(run):
            if m.start() != at:
                return None
            at = m.end()
            if LOST in m[0] or not _UNITS[name].fullmatch(m[0]):
                out.append(LOST)
                continue
            try:
                out.append(bytes(table[c] for c in m[0]).decode("utf-8"))
            except UnicodeDecodeError:
                return None
        rest = run[at:]
        if rest.strip(LOST) and not (len(rest) <= 2 and at >= 6):  # a stretch may be cut in its last character
            return None
        out += [LOST] if rest else []
        return "".join(out) if out.count(LOST) * 2 <= len(out) else None

    def usual(self, runs: list[str]) -> tuple[float, int]:
        """How usual the letter pairs of the runs are (mean logarithm of their counts), and how many there are."""
        got = [self.pairs.get(r[i : i + 2], 0) for r in runs for i in range(len(r) - 1)]
        return (sum(map(math.log1p, got)) / len(got) if got else 0.0), len(got)

    def _legacy(self, runs: list[str], now: float, least: float) -> tuple[str, str] | None:
        """The (wrong, right) 8-bit encodings that make the runs' letter pairs most usual."""
        best = None
        for name in LEGACY:
            table = TABLES[name]
            if not all(c in table for r in runs for c in r):
                continue
            for to in ORIGINAL:
                if to != name:
                    then = self.usual([_reread(r, name, to) for r in runs])[0]
                    if then > now + min(1.5, self.usual_least) and then > least and (best is None or then > best[0]):
                        best = (then, name, to)
        return best and best[1:]

    def legacy(self, line: str) -> tuple[str, str] | None:
        """(original, encodings) of a line, or of words of a line, written in one 8-bit encoding and read in another."""
        runs = [r for r in _RUN.findall(line) if _EIGHT_BIT.issuperset(r)]
        if not runs or not self.pairs:
            return None
        now, n = self.usual(runs)
        if n >= 6 and now <= self.usual_least and (got := self._legacy(runs, now, self.usual_least)):
            words = {r: got for r in runs if any(map(str.isalpha, r))}
        else:
            words = {}
            for r in set(runs):
                if len(r) >= 4 and (was := self.usual([r])[0]) < 1.2 * self.usual_least and (got := self._legacy([r], was, max(1.2 * self.usual_least, was + 0.6 * self.usual_least))) and _word(_reread(r, *got)):
                    words[r] = got
            for r in set(runs) - set(words):  # short neighbours, by an encoding shown in the line
                ways = [got for got in set(words.values()) if all(c in TABLES[got[0]] for c in r) and self.usual([_reread(r, *got)])[0] > self.usual([r])[0] + self.usual_least]
                if 1 < len(r) < 4 and ways:
                    words[r] = ways[0]
        if not words:
            return None
        return _RUN.sub(lambda m: _reread(m[0], *words[m[0]]) if m[0] in words else m[0], line), ", ".join(sorted({f"{a} for {b}" for a, b in words.values()}))

    def _double(self, run: str, name: str, shown: bool) -> str | None:
        if not _WIDE.search(run):
            return None
        got = b""
        for c in run:
            try:
                got += b"\xff" if c == LOST else c.encode(name)
            except UnicodeEncodeError:
                return None
        text = re.sub(f"{LOST}+", LOST, got.decode("utf-8", "replace"))
        good = sum(c > "\x7f" and c != LOST and self.known(c) for c in text)
        bad = sum(c > "\x7f" and (c == LOST or not self.known(c)) for c in text)
        return text if good and good >= (1.0 if shown else 1.5) * bad else None

    def _swapped(self, run: str) -> str | None:
        text = run.encode("utf-16-le", "surrogatepass").decode("utf-16-be", "surrogatepass")
        return text if len(run) > 1 and not any("\ud800" <= c <= "\udfff" for c in text) else None

    def _plausible(self, run: str, text: str, evident: bool, before: str, after: str) -> float | None:
        seen = [c for c in text if c > "\x7f" and c != LOST]
        if not seen or not all(map(self.known, seen)):
            return None
        if not evident and len(seen) < LONG and len(run) < 4 * len(seen):  # four bytes a character are a pattern that nothing else has
            return None
        if len(seen) == 1 and seen[0].isalpha() and any(c.isascii() and c.isalpha() for c in (before, after)) and "LATIN" not in unicodedata.name(seen[0], ""):
            return None
        gain = sum(map(self.weight, seen)) / len(seen) - sum(map(self.weight, run)) / len(run)
        return gain if gain > 0 or evident else None

    def turn_back(self, run: str, before: str = "", after: str = "", shown: frozenset[str] = frozenset()) -> tuple[str, str] | None:
        """(original, encodings) of a garbled stretch, or None; shown: encodings proven elsewhere in the text."""
        best: tuple[float, str, str] | None = None
        way = "bytes"
        frontier, met = [(run, "", "mapping")], {run}
        while frontier:  # each layer turned back leaves fewer characters
            onward = []
            for text, path, how in frontier:
                for name in [*SINGLE, TWIN]:
                    got, by = self._mapped(text, name), how
                    if got is None and name != TWIN:
                        got, by = self._single(text, name), "table"
                    if got is not None and got != text:
                        evident = name in self.learned or name in shown
                        onward.append((got, f"{path}{name} ", by))
                        score = self._plausible(run, got, evident, before, after)
                        if score is not None and (score > 0 or TWIN not in f"{path}{name}".split()) and (best is None or score > best[0]):
                            best, way = (score, got, f"{path}{name}"), by
            frontier = [(t, *more) for t, *more in onward if _RUN.fullmatch(t) and t not in met]
            met.update(t for t, *_ in frontier)
        if best is None:
            for name in DOUBLE:
                if (got := self._double(run, name, name in shown)) is not None:
                    score = self._plausible(run, got, True, before, after)
                    if score is not None and score > 0 and (best is None or score > best[0]):
                        best = (score, got, name)
            if (got := self._swapped(run)) is not None and got.strip():
                gain = sum(self.weight(c) if c > "\x7f" else self.most for c in got) - sum(map(self.weight, run))
                if all(map(self.known, got)) and all(c.isprintable() or c.isspace() for c in got) and gain > min(1.5, 0.4 * self.most) * len(run) and (best is None or gain / len(run) > best[0]):
                    best = (gain / len(run), got, "utf_16")
        if best is None:
            for name in SINGLE:  # characters that all lost a byte: affected, not to be had back
                if (name in self.learned or name in shown) and _BROKEN[name].fullmatch(run):
                    self.way[run] = "lost"
                    return LOST, name
        self.way[run] = way
        return best and best[1:]

    def restore(self, text: str) -> tuple[bool, str, list[str]]:
        """(garbled, text turned back, encodings) of a whole text."""
        how: set[str] = set()
        self.evidence = set()
        if _ODD.search(text) or (self.taught and self.taught.search(text)):
            first, how = self._pass(text, frozenset())
            shown = frozenset(n for h in how for n in h.split()) - self.learned
            if shown & {*SINGLE, *DOUBLE}:  # what long stretches prove holds for the short ones of the same text
                first, how = self._pass(text, shown)
            text = first
        lines = text.split("\n")
        for i, line in enumerate(lines):
            if not line.isascii() and (got := self.legacy(line)):
                lines[i] = got[0]
                how.add(got[1])
                self.evidence.add("pairs")
        if LOST in text:
            self.evidence.add("lost")
        return bool(how) or LOST in text, "\n".join(lines), sorted(how)

    def _pass(self, text: str, shown: frozenset[str]) -> tuple[str, set[str]]:
        out, at, how = [], 0, set()
        for m in _RUN.finditer(text):
            run = m[0]
            if (not _ODD.search(run) or not _SUSPECT.search(run)) and not (self.taught and self.taught.match(run)):
                continue
            key = (run, text[m.start() - 1 : m.start()], text[m.end() : m.end() + 1], shown)
            if len(run) > HELD_CHARS:
                got = self.turn_back(*key)
            else:
                if key not in self.memo:
                    if len(self.memo) > 100_000:
                        self.memo.clear()
                        self.way.clear()
                    self.memo[key] = self.turn_back(*key)
                got = self.memo[key]
            if got:
                out += [text[at : m.start()], got[0]]
                at = m.end()
                how.add(got[1])
                self.evidence.add(self.way.get(run, "bytes"))
                if len(run) > HELD_CHARS:
                    self.way.pop(run, None)
        return "".join(out) + text[at:], how


def _natural(runs: set[str]) -> set[str]:
    """The stretches that are not suspicious; none where those are most of a text's."""
    plain = {r for r in runs if not suspicious(r)}
    return plain if 2 * len(plain) >= len(runs) else set()


def _proven(run: str) -> str | None:
    """The first encoding that turns a suspicious stretch into six or more letters of one block beyond Latin; such a stretch proves itself."""
    for name in SINGLE:
        if re.fullmatch(f"(?:{_UNITS[name].pattern})+", run):
            text = bytes(TABLES[name].get(c, 0xFF) for c in run).decode("utf-8", "replace")
            if len(text) >= 6 and len({ord(c) >> 7 for c in text}) == 1 and text[0] > "\u024f" and all(unicodedata.category(c)[0] in "LM" for c in text):
                return name
    return None


def _features(word: str) -> tuple[int | None, int | None]:
    """The keys of a word as a garbled and as a clean one: what is left without its non-ASCII stretches, their lengths in bytes, and
    the bytes numbered as they first occur. Words with equal keys are turned into each other by one character a byte. None for words
    too poor in features, or that can't be garbled.
    """
    from xxhash import xxh64_intdigest

    parts = _PARTS.split(word)
    rest, runs = "\x01".join(parts[::2]), parts[1::2]
    raw = [r.encode("utf-8", "surrogatepass") for r in runs]
    whole = b"".join(raw)
    if len(whole) < WORD_BYTES and len(_LETTER.findall(rest)) < WORD_LETTERS:
        return None, None
    first = bytes(dict.fromkeys(whole))
    head = rest.encode()
    clean = xxh64_intdigest(b"%s\x00%s\x00%s" % (head, repr([*map(len, raw)]).encode(), whole.translate(bytes.maketrans(first, _COUNT[: len(first)]))))
    text = "".join(runs)
    seen = dict.fromkeys(text)
    if len(seen) > 128 or min(map(len, runs)) < 2:  # no byte of the upper half gives two characters; no character is one byte
        return None, clean
    order = text.translate(dict(zip(map(ord, seen), range(128)))).encode("latin-1")
    return xxh64_intdigest(b"%s\x00%s\x00%s" % (head, repr([*map(len, runs)]).encode(), order)), clean


class Units:
    """The words and whole lines of texts that can meet a twin, with their keys as a garbled and as a clean one. Words are parted by ASCII
    white space (a garbled byte may be another space), without ASCII punctuation at their ends, and looked at once a task."""

    def __init__(self):
        self.keys: dict[str, tuple[int | None, int | None]] = {}

    def of(self, text: str) -> Iterator[tuple[str, int | None, int]]:
        for w in {w.strip(_PUNCTUATION) for w in _UNIT.findall(text) if not w.isascii()}:
            if (keys := self.keys.get(w)) is None:
                if len(self.keys) > HELD_WORDS:
                    self.keys.clear()
                keys = _features(w)
                if len(w) <= HELD_CHARS:
                    self.keys[w] = keys
            if keys[1] is not None:
                yield w, *keys
        for line in text.split("\n"):
            if not line.isascii() and " " in line:
                keys = _features(line)
                if keys[1] is not None:
                    yield line, *keys


def survey(documents: DataFrame, text: str = "text", filter_bits: int = FILTER_BITS) -> DataFrame:
    """(seen, n, mask): in how many documents each non-ASCII character, and each pair of 8-bit letters, occurs outside suspicious
    stretches; as `!name`, the documents in which a stretch proves an encoding by itself; as `#i`, word i of a bit filter of the
    keys that occur both of garbled and of clean lines. Summed per task first; 2 ** filter_bits / 64 words at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        bits, clean, mask = bytearray(1 << (filter_bits - 3)), bytearray(1 << (filter_bits - 3)), (1 << filter_bits) - 1
        units, last = Units(), set()
        for batch in batches:
            for t in batch.column(0):
                t = t.as_py()
                if t and not t.isascii():
                    every = set(_RUN.findall(t))
                    runs = _natural(every)
                    n.update({c for r in runs for c in r})
                    n.update({r[i : i + 2] for r in runs for i in range(len(r) - 1) if r[i] in _LETTERS and r[i + 1] in _LETTERS})
                    if bad := {r for r in every - runs if suspicious(r)}:
                        n.update({f"!{name}" for r in bad if len(r) > 11 and (name := _proven(r))})
                    for w, *keys in units.of(t):
                        if w not in last:
                            if len(w) <= HELD_CHARS and " " not in w:
                                last.add(w)
                            for key, held in zip(keys, (bits, clean), strict=True):
                                if key is not None:
                                    held[(key & mask) >> 3] |= 1 << (key & 7)
                    if len(last) > HELD_WORDS:
                        last.clear()
        bits, clean = (np.frombuffer(held, np.uint64) for held in (bits, clean))
        words = np.flatnonzero(bits | clean)
        seen, counts = [*n, *[f"#{i}" for i in words]], [*n.values(), *[0] * len(words)]
        masks = [pa.array([*[0] * len(n), *held[words].astype(np.int64).tolist()], pa.int64()) for held in (bits, clean)]
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.string()), pa.array(counts, pa.int64()), *masks], names=["seen", "n", "mask", "clean"])

    counts = documents.select(F.col(text).cast("string").alias("t")).mapInArrow(run, "seen string, n long, mask long, clean long")
    sums = counts.groupBy("seen").agg(F.sum("n").alias("n"), F.bit_or("mask").bitwiseAND(F.bit_or("clean")).alias("mask"))
    return sums.where("n > 0 or mask <> 0")


def _utf8(runs: list[str], table: dict[str, int]) -> bool:
    """Whether all stretches are UTF-8 seen through the encoding."""
    try:
        return all(bytes(table[c] for c in r).decode("utf-8") for r in runs)
    except (KeyError, UnicodeDecodeError):
        return False


def _align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for garbled, clean in zip(b["garbled"], b["clean"], strict=True):
            if _RUN.sub("\x01", garbled) != _RUN.sub("\x01", clean):
                continue
            pairs = list(zip(_RUN.findall(garbled), _RUN.findall(clean), strict=True))
            if any(len(g) != len(c.encode()) for g, c in pairs):
                continue
            to, back = {}, {}  # one character a byte, and one byte a character
            if not all(to.setdefault(b, x) == x and back.setdefault(x, b) == b for g, c in pairs for x, b in zip(g, c.encode(), strict=True)):
                continue
            names = [n for n, table in TABLES.items() if all(table.get(x) == b for x, b in back.items())]
            if not names and (LOST in garbled or any(_utf8([g for g, _ in pairs], table) for table in TABLES.values())):
                continue
            for g, c in pairs:
                at = 0
                for x in c:
                    k = len(x.encode())
                    out.append((",".join(names) or TWIN, garbled, g[at : at + k], x))
                    at += k
        yield pd.DataFrame(out, columns=["names", "word", "seen", "original"])


def _explaining(units: dict[tuple[str, ...], int]) -> list[str]:
    """The fewest encodings that explain the units, given how many agree with each combination; one that a handful of many needs is not kept.

    Encodings share most of their characters, so a unit mostly agrees with several; only those that nothing else explains matter.
    """
    left = {k: n for k, n in units.items() if k != (TWIN,)}
    least, kept = max(1.0, RARE * sum(left.values())), []
    while left:
        count = Counter()
        for names, n in left.items():
            count.update(dict.fromkeys(names, n))
        best = min(count, key=lambda name: (-count[name], [*TABLES].index(name)))
        if count[best] < least:
            break
        kept.append(best)
        left = {names: n for names, n in left.items() if best not in names}
    return kept


def learn(documents: DataFrame, text: str = "text", found: list | None = None, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(name, seen, original, support): mappings inferred from near-twins, with the number of garbled words, or of lines, behind each.

    Only words whose key the filter of `survey` (its rows: found) may hold are shuffled. A key that several clean words share says
    nothing about a garbled one, so each garbled word meets one clean word at most: the join is as long as the garbled side.
    """
    found = survey(documents, text, filter_bits).where("seen like '#%'").collect() if found is None else found
    bits = np.zeros(1 << (filter_bits - 6), np.int64)
    for r in found:
        if r.seen[0] == "#" and len(r.seen) > 1:
            bits[int(r.seen[1:])] = r.mask
    shared = documents.sparkSession.sparkContext.broadcast(bits)  # 2 ** filter_bits / 8 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, units, mask = shared.value.tobytes(), Units(), (1 << filter_bits) - 1
        for batch in batches:
            rows = set()
            for t in batch.column(0):
                t = t.as_py()
                if t and not t.isascii():
                    for word, *keys in units.of(t):
                        rows |= {(k, word, dirty) for k, dirty in zip(keys, (True, False), strict=True) if k is not None and held[(k & mask) >> 3] >> (k & 7) & 1}
            keys, seen, dirt = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array([k - (1 << 64) if k >> 63 else k for k in keys], pa.int64()), pa.array(seen, pa.string()), pa.array(dirt, pa.bool_())], names=["key", "word", "dirty"])

    met = cut(documents.select(F.col(text).cast("string").alias("t")).mapInArrow(run, "key long, word string, dirty boolean").distinct())
    clean = met.where("not dirty").groupBy("key").agg(F.min("word").alias("clean"), F.max("word").alias("other")).where("clean = other").drop("other")
    pairs = met.where("dirty").select("key", F.col("word").alias("garbled")).join(clean, "key").select("garbled", "clean")
    aligned = cut(pairs.mapInPandas(_align, "names string, word string, seen string, original string"))
    fit = aligned.groupBy("names").agg(F.approx_count_distinct("word").alias("n")).collect()  # one row a combination of encodings
    kept = F.array(*map(F.lit, [*_explaining({tuple(r.names.split(",")): r.n for r in fit}), TWIN]))
    aligned = aligned.select(F.explode(F.array_intersect(F.split("names", ","), kept)).alias("name"), "word", "seen", "original")
    sums = aligned.groupBy("name", "seen", "original").agg(F.greatest(*[F.count_distinct(F.when(F.contains("word", F.lit(" ")) == line, F.col("word"))) for line in (False, True)]).alias("support"))
    rivals = F.sum("support").over(Window.partitionBy("name", "seen")) - F.col("support")  # few rows: the originals of one sequence
    return sums.withColumn("rivals", rivals).where((F.col("name") != TWIN) | ((F.col("support") > 1) & (F.col("support") > 2 * F.col("rivals")))).drop("rivals")


def restored(documents: DataFrame, key: str = "doc_id", text: str = "text", least_support: int = 1) -> DataFrame:
    """(key, original, encodings, evidence) of the garbled documents: the text as far as it can be had back, what it was read with, and
    by which ways that was found."""
    found = survey(documents, text).collect()
    mappings: dict[str, dict[str, str]] = {}
    for r in sorted(learn(documents, text, found).where(F.col("support") >= least_support).collect(), key=lambda r: (-r.support, r.original)):
        mappings.setdefault(r.name, {}).setdefault(r.seen, r.original)  # what most lines show
    counts = {r.seen: r.n for r in found if r.n}
    learned = {*mappings}
    known = {k: n for k, n in counts.items() if len(k) == 1}, learned, {k: n for k, n in counts.items() if len(k) == 2}, mappings
    shared = documents.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(*shared.value)
        for batch in batches:
            keep, originals, names, ways = [], [], [], []
            for i, t in enumerate(batch.column(1)):
                t = t.as_py()
                if t and not t.isascii():
                    bad, fixed, how = judge.restore(t)
                    if bad:
                        keep.append(i)
                        originals.append(fixed)
                        names.append(how)
                        ways.append(sorted(judge.evidence))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(originals, pa.string()), pa.array(names, pa.list_(pa.string())), pa.array(ways, pa.list_(pa.string()))], names=["k", "original", "encodings", "evidence"])

    rows = documents.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    kind = rows.schema["k"].dataType.simpleString()
    return rows.mapInArrow(run, f"k {kind}, original string, encodings array<string>, evidence array<string>").withColumnRenamed("k", key)


_WORDS = re.compile(r"[\w\ufffd\u200c\u0300-\u036f\u0900-\u0963\u0966-\u0d7f]+")


def _words(text: str) -> set[str]:
    """Words with a character beyond ASCII; U+FFFD and vowel signs belong to them."""
    return {w for w in _WORDS.findall(text) if not w.isascii()}


def _patterns(word: str) -> Iterator[str]:
    """The word with one or two neighbouring characters, or two single ones, given as lost."""
    n = len(word)
    for i in range(n):
        yield word[:i] + LOST + word[i + 1 :]
        if i + 2 <= n:
            yield word[:i] + LOST + word[i + 2 :]
        for j in range(i + 2, n):
            yield word[:i] + LOST + word[i + 1 : j] + LOST + word[j + 1 :]


def _place(pattern: str, bits: int) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(pattern) % (1 << bits)


def repair_lost(documents: DataFrame, turned: DataFrame, key: str = "doc_id", text: str = "text", share: float = 0.9, longest: int = 24, filter_bits: int = FILTER_BITS) -> DataFrame:
    """The rows of `restored` with lost characters filled in where clean words leave no doubt.

    A word with one or two lost places meets the clean words that fit it; the one with `share` of their documents is taken.
    A bit filter of the lost words keeps all other words out of the shuffle. Words over `longest` characters stay as they are.
    """
    rows = cut(turned.select(F.col(key).alias("k"), "original", "encodings", "evidence"))
    damaged = rows.where(F.contains("original", F.lit(LOST))).select("k", "original")

    def lost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, w) for i, t in enumerate(batch.column(1).to_pylist()) for w in _words(t) if 0 < w.count(LOST) <= 2 and 2 < len(w) <= longest]
            words = [w for _, w in found]
            at = [_place(w, filter_bits) for w in words]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i for i, _ in found], pa.int64())), pa.array(words, pa.string()), pa.array([p >> 6 for p in at], pa.int64()), pa.array([(1 << (p & 63)) - ((1 << 64) if p & 63 == 63 else 0) for p in at], pa.int64())], names=["k", "pattern", "word_no", "mask"])

    kind = rows.schema["k"].dataType.simpleString()
    wanted = cut(damaged.mapInArrow(lost, f"k {kind}, pattern string, word_no long, mask long"))
    bits = np.zeros(1 << (filter_bits - 6), np.int64)
    for r in wanted.groupBy("word_no").agg(F.bit_or("mask").alias("mask")).collect():  # 2 ** filter_bits / 64 rows at most
        bits[r.word_no] = r.mask
    shared = documents.sparkSession.sparkContext.broadcast(bits)

    def fitting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, held = Counter(), shared.value.view(np.uint64)

        def flush() -> pa.RecordBatch:
            out = [(p, w, c) for w, c in n.items() for p in set(_patterns(w)) if int(held[(a := _place(p, filter_bits)) >> 6]) >> (a & 63) & 1]
            n.clear()
            cols = zip(*out, strict=True) if out else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.string(), pa.int64()), strict=True)], names=["pattern", "word", "n"])

        for batch in batches:
            for t in batch.column(0):
                t = t.as_py()
                if t and not t.isascii():
                    n.update(w for w in _words(t) if LOST not in w and len(w) <= longest)
                if len(n) > HELD_WORDS:  # counts of a word in several parts are summed below
                    yield flush()
        yield flush()

    fits = documents.select(F.col(text).cast("string").alias("t")).mapInArrow(fitting, "pattern string, word string, n long").groupBy("pattern", "word").agg(F.sum("n").alias("n"))
    sure = fits.groupBy("pattern").agg(F.max(F.struct("n", "word")).alias("b"), F.sum("n").alias("all")).where(F.col("b.n") >= share * F.col("all")).select("pattern", F.col("b.word").alias("word"))
    fills = wanted.select("k", "pattern").distinct().join(sure, "pattern").groupBy("k").agg(F.sort_array(F.collect_list(F.struct((-F.length("pattern")).alias("short"), "pattern", "word"))).alias("fills"))
    filled = F.aggregate("fills", F.col("original"), lambda t, f: F.replace(t, f["pattern"], f["word"]))
    return rows.join(fills, "k", "left").select(F.col("k").alias(key), F.when(F.col("fills").isNull(), F.col("original")).otherwise(filled).alias("original"), "encodings", "evidence")
