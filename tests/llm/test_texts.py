from __future__ import annotations

import math
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from colloquy.llm import mixture, repetition, tokens

if not Path(tokens.FOLDER).exists():
    pytest.skip("the tokenizers are not here", allow_module_level=True)
HARD = ["", None, " ", "\n\n", "<|endoftext|> a", "नमस्ते दुनिया 👍🏽❤️", "àé", "\x00\x07", "ß" * 5000, "x" * 100_000, "தமிழ்\r\n\ttext", "��"]
DOC = "doc_id long, text string, source string, ids string, k string, tokens string"


def brute_share(words, run=4):
    n, seen, marked = len(words), set(), set()
    for i in range(n - run + 1):
        g = tuple(words[i : i + run])
        if g in seen:
            marked |= set(range(i, i + run))
        seen.add(g)
    return len(marked) / n if n else 0.0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=40))
def test_share(words):
    assert math.isclose(repetition.repeated_share(words), brute_share(words))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["the", "dog", "नमस्ते", "unbelievable", "x", "வணக்கம்", "drummer"]), min_size=4, max_size=60), st.sampled_from([0.1, 0.3, 0.6]))
def test_band_is_necessary(words, share):
    tok = tokens.load()
    ids = [i for w in words for i in tok.encode(w, add_special_tokens=False).ids]
    if brute_share(words) >= share:
        assert repetition.entropy(ids) <= math.log2(len(ids)) - 2 * share * len(words) / len(ids) + 1e-9


def test_repetitive_rows(spark):
    talk = "One caller left a note, and the host read it aloud to us all last night."
    rows = [(1, " ".join(["round and round we go"] * 9)), (2, talk), (3, None), (4, ""), (5, "?!…"), (6, "a b c d"), (7, talk + "\n" + talk), (8, "A-b,c.D a B C d"), (9, "go " * 100_000)]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "audio_id long, transcript string, k string, words int")
    assert sorted(r.audio_id for r in repetition.repetitive(df).collect()) == [1, 7, 8, 9]
    m = {r.audio_id: r for r in repetition.measures(df, "audio_id", "transcript", share=0.0).collect()}
    assert len(m) == 9 and m[8].repeated_share == 0.5 and m[3].repeated_share == 0.0 and m[2].script == "latin"
    assert repetition.rejected(repetition.measures(df, "audio_id", "transcript")).count() == 9
    assert repetition.repetitive(df.limit(0)).count() == 0


def test_encoding_round_trip(spark):
    rows = [(i, t, None, "x", "y", "z") for i, t in enumerate([*HARD, HARD[5]])]
    df = spark.createDataFrame(rows, DOC)
    got = {r.doc_id: r.ids for r in tokens.encode(df).collect()}
    assert len(got) == len(rows) and got[0] == got[1] == []
    assert all(tokens.decode(got[i]) == (t or "") for i, t, *_ in rows)
    assert 50256 not in got[4]
    for r in tokens.encode_offsets(df).collect():
        text = rows[r.doc_id][1] or ""
        assert r.ids == got[r.doc_id] and all(0 <= a <= b <= len(text) for a, b in zip(r.starts, r.ends))
        assert not text or (min(r.starts) == 0 and max(r.ends) == len(text))
    n = {r.doc_id: r.tokens for r in tokens.count_tokens(df, "doc_id").collect()}
    assert n == {k: len(v) for k, v in got.items()}
    assert tokens.encode(df.limit(0)).count() == 0


ODD = st.sampled_from([" ", "  ", "\n", "\r\n", "\t", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "\u1680", "\u180e", "\u2003", "\u2028", "\u200b", "\u3000", "\ufeff", "a", "b'", "'s", "é", "\u0301", "नम", "7", "!", "?!", "<|endoftext|>", "\x00", "👍🏽"])


@given(st.one_of(st.text(max_size=40), st.lists(ODD, max_size=14).map("".join)))
@settings(max_examples=1500, deadline=None)
def test_pieces_give_the_ids_of_the_whole_text(text):
    got = np.frombuffer(tokens.Pieces().encode([text])[0], np.int32).tolist()
    assert got == tokens.load().encode(text, add_special_tokens=False).ids


def test_pieces_of_all_characters():
    """Every character beside a word, a space and a line break."""
    tok, pieces = tokens.load(), tokens.Pieces()
    texts = ["".join(f"a{chr(c)} {chr(c)}b\n{chr(c)}{chr(c)} " for c in range(lo, lo + 64) if not 0xD800 <= c < 0xE000) for lo in range(0, 0x11000, 64)]
    for got, e in zip(pieces.encode(texts), tok.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(got, np.int32).tolist() == e.ids


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_any_text_comes_back(text):
    tok = tokens.load()
    assert tokens.decode(tok.encode(text, add_special_tokens=False).ids) == text


def poisson_cdf(mean, most):
    """P(X <= k) for k = 0 .. most - 1, term by term."""
    total, out = 0.0, []
    for k in range(most):
        total += math.exp(k * math.log(mean) - mean - math.lgamma(k + 1))
        out.append(min(total, 1.0))
    return out


def test_cut_poisson():
    for rate, most in [(0.3, 1), (1.5, 2), (1.99, 2), (2.0, 2), (0.0, 3), (3.2, 9)]:
        mean = mixture.mean_for_rate(rate, most)
        if rate >= most:
            assert math.isinf(mean)
        else:
            assert math.isclose(sum(1 - c for c in poisson_cdf(mean, most)) if mean else 0.0, rate, abs_tol=1e-9)


def test_large_rates_keep_their_mean():
    for rate, most in [(600.0, 1000), (511.0, 513), (999.5, 1000), (5000.0, 20_000), (99_000.0, 100_000)]:
        mean = mixture.mean_for_rate(rate, most)
        assert math.isfinite(mean) and math.isclose(sum(1 - c for c in poisson_cdf(mean, most)), rate, rel_tol=1e-6)


@given(st.floats(0.01, 1e5), st.integers(1, 200_000), st.integers(0, 1000))
@settings(max_examples=60, deadline=None)
def test_draws_have_the_mean(rate, most, seed):
    mean = mixture.mean_for_rate(rate, most)
    u = (np.arange(4000) + 0.5) / 4000  # evenly spaced, so only the tails' rounding is left
    got = mixture.draw(u, mean, most)
    assert got.max() <= most and abs(got.mean() - min(rate, most)) <= 0.01 * math.sqrt(rate) + 0.01 and (np.diff(got) >= 0).all()


def plan(sources, total, shortfall="rescale"):
    """What each source is to give, by filling and setting aside full sources in turn."""
    open_ = [s for s in sources if s[1] > 0 and s[2] * s[3] > 0]
    want, left = {s[0]: 0.0 for s in sources}, total
    while open_:
        scale = left / sum(s[1] for s in open_) if shortfall == "rescale" else total / (sum(s[1] for s in sources) or 1)
        full = [s for s in open_ if s[1] * scale >= s[2] * s[3]]
        want |= {s[0]: min(s[1] * scale, s[2] * s[3]) for s in full or open_}
        if not full:
            break
        left -= sum(want[s[0]] for s in full)
        open_ = [s for s in open_ if s not in full]
    return want


def test_filling_up(spark):
    r = random.Random(8)
    cases = [[("a", 0.5, 1, 100), ("b", 0.3, 2, 1000), ("c", 0.1, 5, 1000), ("gone", 0.1, 3, 0)], [("a", 0.5, 1, 10), ("b", 0.5, 1, 10)], [(f"s{i}", r.random(), r.randrange(4), r.randrange(2000)) for i in range(300)]]
    for case in cases:
        df = spark.createDataFrame(case, "source string, weight double, most long, tokens long")
        for how in ("rescale", "leave"):
            want = plan(case, 1000.0 if len(case) < 9 else 200_000.0, how)
            got = {x.source: x.want for x in mixture.fill(df, 1000.0 if len(case) < 9 else 200_000.0, how).collect()}
            assert all(math.isclose(got[k], v, rel_tol=1e-9, abs_tol=1e-9) for k, v in want.items())


def test_mixture(spark):
    r = random.Random(1)
    rows = [(i, " ".join(r.choices(["alpha", "beta", "gamma"], k=r.randrange(1, 30))), s, "", "", "") for i, s in enumerate(["big"] * 1500 + ["small"] * 100 + ["none", None, "stray"])] + [(9999, None, "small", "", "", "")]
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.2, 2), ("gone", 0.1, 3), ("null", None, None), (None, 0.1, 1)], "source string, weight double, max_repeats int")
    docs = spark.createDataFrame(rows, DOC)
    used, shares = mixture.mix(docs, targets)
    got = used.collect()
    per = {x.source: x for x in shares.collect()}
    assert len(got) == 1601 and all(0 <= x.repeats <= {"big": 1, "small": 2}[x.source] for x in got)
    assert Counter(x.repeats for x in got if x.source == "small") == {2: 101}
    assert per["gone"].actual_share == 0 and per["big"].planned_share == pytest.approx(per["big"].rate * per["big"].tokens / per["big"].corpus_tokens)
    assert abs(per["big"].tokens_given / per["big"].corpus_tokens - per["big"].planned_share) < 0.05
    copies = mixture.shuffled_copies(used).collect()
    assert len(copies) == sum(x.repeats for x in got) and [x.place for x in copies] == sorted(x.place for x in copies)
    assert {(x.doc_id, x.repeats) for x in mixture.mix(docs, targets)[0].collect()} == {(x.doc_id, x.repeats) for x in got}
    assert mixture.mix(docs.limit(0), targets)[0].count() == 0
