from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
import pytest

from colloquy.llm import windows

TRAIN = "path string, duration double, n_frames long, offset_ms long, split string, block long, at long, clip string"
SEG = "clip_id string, seg_idx int, speaker string, start_ms long, end_ms long, path string, silence long"


def test_sparse_table():
    r = random.Random(1)
    for n in (1, 2, 3, 17, 64, 65):
        s = np.array([r.randrange(5) for _ in range(n)])
        t = windows.SparseTable(s)
        for lo in range(n):
            for hi in range(lo + 1, n + 1):
                assert t.argmax(lo, hi) == max(range(lo, hi), key=lambda i: (s[i], i))


def can_cut(begin, finish, at, limit, overlap):
    """Brute force: is there any chain of natural cuts that keeps every piece within the limit?"""

    @lru_cache(None)
    def ok(b, last):
        if finish - b <= limit:
            return True
        return any(c > last and c - b <= limit and c - overlap >= begin and ok(c - overlap, c) for c in at)

    return ok(begin, begin)


@pytest.mark.parametrize("seed", range(40))
def test_cuts_against_search(seed):
    r = random.Random(seed)
    begin, finish = 100, 100 + r.randrange(61, 400)
    at = sorted({r.randrange(begin + 1, finish) for _ in range(r.randrange(0, 25))})
    got = windows.cut_window(begin, finish, np.array(at, np.int64), np.array([r.randrange(9) for _ in at], np.int64), 60, 7, 30)
    assert got[0][0] == begin and got[-1][1] == finish
    assert all(e - s <= 60 for s, e, _ in got)
    assert all(b[0] == a[1] - 7 for a, b in zip(got, got[1:]))
    assert all(h or e in at for _, e, h in got[:-1])
    assert any(h for *_, h in got) == (not can_cut(begin, finish, tuple(at), 60, 7))


def test_pieces_on_dirty_rows(spark):
    z = (None, 0, 0, "x")
    train = [
        ("d/abcdefghijk_seg1_0001.wav", None, 5000, 0, *z), ("d\\abcdefghijk_seg1_0001.WAV ", 400.0, None, 0, *z), ("d/abcdefghijk_seg1_0002.wav", 180.0, None, 0, *z), ("d/nosegments__0003.wav", 181.0, None, 5, *z),
        (None, 900.0, None, 0, *z), ("d/abcdefghijk_seg1_0009.wav", None, None, 0, *z), ("plain", 500.0, None, 0, *z), ("d/abcdefghijk_seg1_0001.wav", None, 5000, 0, *z),
    ]
    segs = [("abcdefghijk_seg1", i, "A", i * 50_000 + 1, i * 50_000 + 30_000, "x", 1) for i in range(9)] + [("abcdefghijk_seg1", 99, "A", None, 5, "x", 1), (None, 1, "A", 1, 5, "x", 1)]
    out = windows.pieces(spark.createDataFrame(train, TRAIN), spark.createDataFrame(segs, SEG)).collect()
    kinds = {r.path: r.kind for r in out}
    assert kinds == {train[0][0]: "natural", train[1][0]: "natural", train[3][0]: "hard", "plain": "hard"}
    assert {r.clip_id for r in out} == {"abcdefghijk_seg1", "nosegments_", None}
    empty = windows.pieces(spark.createDataFrame([], TRAIN), spark.createDataFrame([], SEG))
    assert empty.count() == 0 and windows.pieces(spark.createDataFrame(train, TRAIN), spark.createDataFrame([], SEG)).count() > 0
