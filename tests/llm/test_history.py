from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from colloquy.llm import history, naming

HEAD = "row_id long, batch_no int, vid string, url string, status string, key string, word string"
V = "aB3_-xyz01Q"


@pytest.mark.parametrize(
    ("vid", "url", "want"),
    [
        (V, None, V), (f" {V}\n", None, V), (f"vh:{V}", None, V), (f"https://vh.example/{V}", None, V), ("", f"https://www.a.example/watch?v={V}", V), (None, f"HTTPS://A.EXAMPLE/watch?x=1&v={V}#t=1", V),
        (None, f"a.example/watch?from=00000000000&v={V}&next=11111111111", V), (None, f"https://a.example/watch?f=p&amp;v={V}", V), (None, f"https://a.example/redirect?q=https%3A%2F%2Fa.example%2Fwatch%3Fv%3D{V}%26t%3D1", V),
        (None, f"https://a.example/shorts/{V}/", V), (None, f"https://a.example/embed/{V}?start=5", V), (None, f" https://vh.example/{V}?si=abc \n", V), (None, "https://a.example/watch?v=aB3%5F-xyz%301Q", V),
        (None, "https://a.example/watch?from=00000000000", None), (None, None, None), ("", "", None), ("short", "not an address", None),
    ],
)
def test_video_id(spark, vid, url, want):
    assert spark.createDataFrame([(vid, url)], "vid string, url string").select(naming.video_id(F.col("vid"), F.col("url")).alias("x")).first().x == want


def test_talk_words(spark):
    urls = ["https://t.example/talks/One-two_3?x=1", "m.t.example/amp/talks/one%20two+3/#c", "https://t.example/other", None, "https://t.example/talks/"]
    got = spark.createDataFrame([(u,) for u in urls], "url string").select(naming.talk_words(F.col("url")).alias("w")).collect()
    assert [r.w for r in got] == [["one", "two", "3"], ["one", "two", "3"], None, None, None]


def test_spelling_distance():
    def brute(a, b):
        d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]

    r = random.Random(3)
    for _ in range(1000):
        a, b = ("".join(r.choice("abc") for _ in range(r.randrange(8))) for _ in range(2))
        assert history.spelling_distance(a, b, 2) == min(3, brute(a, b)) and history.spelling_distance(a, b, 1) == min(2, brute(a, b))


def talk(*words):
    return "https://t.example/talks/" + "-".join(words)


def rows():
    base = ["kitchen", "electricity", "whisper", "calligraphy", "episode", "241"]
    slip = ["ktichen", "electricity", "whisper", "caligraphy", "episode", "241"]
    other = ["kitchen", "electricity", "whisper", "orchard", "episode", "241"]
    number = ["kitchen", "electricity", "whisper", "calligraphy", "episode", "214"]
    x = ("k", "w")
    return [
        (1, 0, V, None, "rejected", *x), (2, 0, V, None, "accepted", *x), (3, 0, V, None, "accepted", *x), (4, 0, None, talk(*base), "accepted", *x), (5, 0, None, None, "accepted", *x), (6, 0, V.lower(), None, "accepted", *x),
        (7, 1, None, f"https://a.example/watch?v={V}", "error", *x), (8, 1, None, talk(*slip), None, *x), (9, 1, None, talk(*other), "accepted", *x), (10, 1, None, talk(*number), "accepted", *x), (11, 1, V, None, "accepted", *x),
        (12, 2, None, talk(*[w.upper() for w in number]), "pending", *x), (13, 2, None, talk("kitchen"), "accepted", *x), (14, 3, None, talk("kitchens"), "accepted", *x), (15, 3, "z" * 11, None, "accepted", *x), (16, 4, "z" * 11, None, "x", *x),
        (17, 5, "z" * 11, None, "x", *x), (18, 6, V, None, "accepted", *x), (None, 6, V, None, "accepted", *x), (19, None, V, None, "accepted", *x),
    ]


def test_batches(spark):
    got = {tuple(r) for r in history.repeated_rows(spark.createDataFrame(rows(), HEAD)).collect()}
    assert got == {(2, 7), (4, 8), (2, 11), (10, 12), (13, 14), (15, 16), (15, 17), (2, 18)}
    assert history.repeated_rows(spark.createDataFrame([], HEAD)).count() == 0
    assert history.repeated_rows(spark.createDataFrame(rows()[:6], HEAD)).count() == 0


def test_runs_are_merged_in_tiers(spark, tmp_path):
    index = history.HistoryIndex(spark, f"file://{tmp_path}/h", fan=2, range_rows=2)
    df = spark.createDataFrame(rows(), HEAD)
    for b in range(4):
        index.take(b, df.where(F.col("batch_no") == b))
    assert [r["tier"] for r in index.accepted.runs] == [2]
    stored = index.accepted.all().collect()
    assert len({r.key for r in stored}) == len(stored) and {r.old_row for r in stored} == {2, 4, 6, 9, 10, 13, 15}
    assert all(n <= 2 for *_, n in index.accepted.runs[0]["files"])
    assert len([x for x in (tmp_path / "h/accepted").iterdir()]) == 1  # merged runs are deleted


def test_history_is_reopened(spark, tmp_path):
    folder, out = f"file://{tmp_path}/h", f"file://{tmp_path}/out"
    df = spark.createDataFrame(rows(), HEAD)
    history.repeated_rows(df.where("batch_no < 2"), folder, out)
    lost = history.HistoryIndex(spark, folder)  # a writer that stops before it commits changes nothing
    lost.accepted.append(spark.createDataFrame([("v:" + "q" * 11, 99, 1)], "key string, old_row long, old_batch int"))
    got = {tuple(r) for r in history.repeated_rows(df, folder, out).collect()}
    assert got == {(2, 7), (4, 8), (2, 11), (10, 12), (13, 14), (15, 16), (15, 17), (2, 18)}
    again = history.HistoryIndex(spark, folder)
    before = (again.number, again.accepted.rows())
    again.take(3, df.where("batch_no = 3"), out)  # taken before
    assert (again.number, again.accepted.rows()) == before and len(again.batches) == 7
    again.accepted.vacuum()
    assert {x.name for x in (tmp_path / "h/accepted").iterdir()} == {r["name"] for r in again.accepted.runs}
    with pytest.raises(FileExistsError):
        lost._commit()


def test_a_batch_reads_what_it_touches(spark, tmp_path):
    r = random.Random(9)
    vid = lambda: "".join(r.choice("abcdefghijklmnop0123456789_-") for _ in range(11))
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))
    read = []
    for size in (500, 4000):
        index = history.HistoryIndex(spark, f"file://{tmp_path}/h{size}", range_rows=20)
        old = [(i, 0, vid(), None, "accepted", "", "") for i in range(size)] + [(size + i, 0, None, talk(word(), str(i)), "accepted", "", "") for i in range(size // 10)]
        index.take(0, spark.createDataFrame(old, HEAD))
        new = [(9001, 1, old[3][2], None, "accepted", "", ""), (9002, 1, vid(), None, "accepted", "", ""), (9003, 1, None, old[size][3].replace("/talks/", "/talks/-").upper().replace("/TALKS/", "/talks/"), "x", "", "")]
        index.take(1, spark.createDataFrame(new, HEAD), f"file://{tmp_path}/o{size}")
        assert {tuple(x) for x in spark.read.parquet(f"{tmp_path}/o{size}/batch=1").collect()} == {(3, 9001), (size, 9003)}
        read.append(index.batches["1"])
    assert read[1]["accepted_read"] <= 3 * 20 and read[1]["accepted_held"] > 4000
    assert read[1]["spelling_read"] <= 2 * 20 and read[1]["spelling_held"] > 4000


def test_long_words_share_a_piece(spark):
    r = random.Random(7)
    pairs = []
    for n in [*range(20, 34), 90, 400] * 4:
        a = [r.choice("abcd") for _ in range(n)]
        b = list(a)
        for _ in range(2):
            i = r.randrange(len(b) - 1)
            how = r.randrange(4)
            if how == 0:
                b[i : i + 2] = b[i : i + 2][::-1]
            elif how == 1:
                del b[i]
            else:
                b[i : i + (how == 2)] = r.choice("abcd")
        pairs.append(("".join(a), "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    met = df.select("a", "b", *[F.arrays_overlap(history.spelling_keys(F.col(x), True), history.spelling_keys(F.col(y), False)).alias(x + y) for x, y in ("ab", "ba")])
    assert all(x.ab and x.ba for x in met.collect())
    assert df.select(F.max(F.size(history.spelling_keys(F.col("a"), True)))).first()[0] < 600


def test_two_misspellings_and_a_long_word(spark):
    long = "pneumonoultramicroscopicsilicovolcanoconiosis"
    data = [(1, 0, None, talk("calligraphy", long, "7"), "accepted"), (2, 1, None, talk("caligraphy", long[:20] + long[21:], "7"), "accepted"), (3, 2, None, talk("calligrahpy", long.replace("volc", "vocl"), "7"), "x"), (4, 2, None, talk("calligraphy", long[::-1], "7"), "x")]
    df = spark.createDataFrame([(*x, "k", "w") for x in data], "row_id long, batch_no int, vid string, url string, status string, key string, word string")
    assert {tuple(x) for x in history.repeated_rows(df).collect()} == {(1, 2), (1, 3)}


def test_every_near_word_shares_a_key(spark):
    r = random.Random(5)
    words = ["".join(r.choice("abcde") for _ in range(r.randrange(1, 8))) for _ in range(60)]
    keys = {x.w: set(x.k) for x in spark.createDataFrame([(w,) for w in set(words)], "w string").select("w", history.word_keys(F.col("w")).alias("k")).collect()}
    for a in keys:
        for b in keys:
            most = 2 if min(len(a), len(b)) >= 5 else 1
            if history.spelling_distance(a, b, most) <= most:
                assert keys[a] & keys[b], (a, b)
