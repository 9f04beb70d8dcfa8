"""Problem 2: checking new batches against all accepted history by multi-key sorted-neighbourhood runs.

A record is filed under a sort key: its 11-character id (`v:...`), or the words of its address (`t:...`). Accepted history is a
set of sorted runs (`SortedRuns`) with the smallest accepted row of each key. A sorted batch meets only the stretches of the runs
that hold its keys; around each new record the window of equal sort keys is compared, which after the reduction of history holds
one row. Then the batch's own accepted keys become a run, and full tiers of runs are merged.

Words may be slipped, so sort keys of word addresses are built from reduced words. The spelling index is a second set of sorted
runs: each known word is filed under many keys (the word with up to two letters left out, or pieces of a long word); a new word
is compared only with the words in the windows of its keys, by edit distance with transpositions: 2 at most, 1 for words under
five letters. It takes over the reduced form of its nearest word (then the more frequent, then the first in the alphabet). Two
words within that distance always share a key, so no window size can lose a pair.

A history lives in its folder: `HistoryIndex(spark, folder)` opens what is there. A batch is committed as a whole, by a list of
runs written under a new number; until then a crash leaves the history as it was, and a batch that is in the list is not
taken again. The rows that each batch read are noted in the list.

Defined results: rows naming no video match nothing; copies within a batch do not match each other; a null status counts as
not accepted; rows without batch number or row id are left out; an empty table gives no rows. One video holding many rows is
no hot group: history is reduced to one row per key before the join and the new side may be split by adaptive execution.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import cut, delete_path, list_names, read_text, shared_path, write_text_once
from .naming import talk_words, video_id
from .runs import FAN, RANGE_ROWS, SortedRuns

_ACCEPTED = "key string, old_row long, old_batch int"
_SPELT = "key string, other string, m long, form string"
LONG_WORD, PIECES = 24, 5


def spelling_distance(a: str, b: str, most: int) -> int:
    """Edit distance with transpositions of neighbours; most + 1 where it is larger than most. Only cells within most of the diagonal are filled."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    far = most + 1
    before, last = {}, {j: j for j in range(min(len(b), most) + 1)}
    for i, x in enumerate(a, 1):
        row = {0: i} if i <= most else {}
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            y = b[j - 1]
            d = min(last.get(j, far) + 1, row.get(j - 1, far) + 1, last.get(j - 1, far) + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before.get(j - 2, far) + 1)
            row[j] = d
        if not row or min(row.values()) > most:
            return far
        before, last = last, row
    return min(last.get(len(b), far), far)


def _near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        b["d"] = [spelling_distance(x, y, most) for x, y, most in zip(b["word"], b["other"], b["most"], strict=True)]
        yield b[b["d"] <= b["most"]].drop(columns="most")


def _may_be_near() -> Column:
    """Whether two words may be within `most` edits with transpositions, by their plain edit distance `lev` (every transposition saves one)."""
    lev, most = F.col("lev"), F.col("most")
    letters = lambda c: F.array_sort(F.split(F.col(c), ""))
    swaps = (F.abs(F.length("word") - F.length("other")) <= 2 * most - lev) & ((lev < 2 * most) | (letters("word") == letters("other")))
    return (lev >= 0) & ((lev <= most) | ((lev <= 2 * most) & swaps))


def _less_one(word: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))


def word_keys(word: Column) -> Column:
    """The word and the word with one letter left out; from five letters on also with two, as two edits need five letters."""
    one = _less_one(word)
    two = F.when(F.length(word) >= 5, F.flatten(F.transform(one, _less_one)))
    return F.array_distinct(F.concat(F.array(word), one, F.coalesce(two, F.array().cast("array<string>"))))


def _pieces(word: Column, lengths: Column, shifts: list[int]) -> Column:
    """Keys of a long word's pieces, as a word of each of the lengths is cut: its length, the piece's number and letters."""
    place = lambda n, k: F.floor(n * k / PIECES).cast("int")
    shifted = F.sequence(F.lit(shifts[0]), F.lit(shifts[-1]))

    def of_piece(n: Column, k: Column) -> Column:
        first, after = place(n, k), place(n, k + 1)
        return F.transform(shifted, lambda s: F.concat_ws(":", F.lit("#"), n, k, F.substring(word, first + 1 + s, after - first)))

    return F.flatten(F.transform(lengths, lambda n: F.flatten(F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), lambda k: of_piece(n, k)))))


def spelling_keys(word: Column, asked: bool) -> Column:
    """The keys a word is filed under, or (asked) looked up by; a word itself is always one of them.

    Leaving letters out makes as many keys as the square of a word's length, so words over LONG_WORD letters are filed by five
    pieces instead, and looked up by their pieces up to two places off: an edit changes two pieces at most (a transposition
    across their border), so two edits leave one whole. Words two letters around the bound are filed both ways.
    """
    none = F.array().cast("array<string>")
    short = F.when(F.length(word) <= LONG_WORD, word_keys(word)).otherwise(F.array(word))
    lengths = F.sequence(F.length(word) - 2, F.length(word) + 2) if asked else F.array(F.length(word))
    long = F.when(F.length(word) > LONG_WORD - 2, _pieces(word, lengths, [-2, -1, 0, 1, 2] if asked else [0]))
    return F.array_distinct(F.concat(short, F.coalesce(long, none)))


class SpellingIndex:
    """Known words with their reduced forms as sorted runs of (key, other, m, form): word `other`, seen m times, filed under key."""

    def __init__(self, runs: SortedRuns):
        self.runs = runs
        self.asked, self.filed = (F.explode(spelling_keys(F.col("word"), asked)).alias("key") for asked in (True, False))
        self.may_be_near = _may_be_near()

    def _settle(self, links: DataFrame) -> DataFrame:
        """(word, n, form): links that lead to other new words are followed to the end. They lead to more frequent or earlier words only, so this ends."""
        links = cut(links)
        while links.where("open").limit(1).count():
            onward = links.select(F.col("word").alias("form"), F.col("form").alias("next"), F.col("open").alias("more"))
            links = cut(links.join(onward, "form", "left").select("word", "n", F.when(F.col("open"), F.coalesce("next", "form")).otherwise(F.col("form")).alias("form"), (F.col("open") & F.coalesce("more", F.lit(False))).alias("open")))
        return links.select("word", "n", "form")

    def forms(self, words: DataFrame) -> DataFrame:
        """(word, form) of the words of (word, n); new ones are filed first."""
        own = self.runs.near(words.select(F.col("word").alias("key"))).where("key = other").select(F.col("other").alias("word"), "form")
        marked = cut(words.join(own, "word", "left").select("word", "n", "form"))
        new = marked.where("form is null").select("word", "n")
        if not new.limit(1).count():
            return marked.select("word", "form")
        asked = new.select("word", "n", self.asked)
        filed = new.select(self.filed, F.col("word").alias("other"), F.col("n").alias("m"), F.lit(None).cast("string").alias("form"))
        pairs = asked.join(filed.unionByName(self.runs.near(asked)), "key").where("word <> other and (form is not null or m > n or (m = n and other < word))")
        pairs = pairs.select("word", "other", "m", "form").distinct().withColumns({"lev": F.levenshtein("word", "other", 4), "most": F.when(F.least(F.length("word"), F.length("other")) >= 5, 2).otherwise(1)})
        near = pairs.where(self.may_be_near).drop("lev").mapInPandas(_near, "word string, other string, m long, form string, d int")
        best = near.groupBy("word").agg(F.min(F.struct("d", F.isnull("form").alias("unfiled"), (-F.col("m")).alias("rare"), "other", "form")).alias("b"))
        links = self._settle(new.join(best, "word", "left").select("word", "n", F.coalesce("b.form", "b.other", "word").alias("form"), F.coalesce(F.col("b.unfiled"), F.lit(False)).alias("open")))
        self.runs.append(links.select(self.filed, F.col("word").alias("other"), F.col("n").alias("m"), "form"))
        return marked.where("form is not null").select("word", "form").unionByName(links.select("word", "form"))


def _smallest(rows: DataFrame) -> DataFrame:
    """One row a key: the smallest accepted one."""
    return rows.groupBy("key").agg(F.min(F.struct("old_row", "old_batch")).alias("o")).select("key", "o.old_row", "o.old_batch")


class HistoryIndex:
    """Accepted history below `folder`: opened where it exists, else begun."""

    def __init__(self, spark: SparkSession, folder: str, fan: int = FAN, range_rows: int = RANGE_ROWS):
        self.spark, self.folder = spark, folder
        self.named = [
            F.col("row_id").cast("long").alias("row"), F.col("batch_no").cast("int").alias("batch"), F.coalesce(F.col("status") == "accepted", F.lit(False)).alias("accepted"),
            video_id(F.col("vid"), F.col("url")).alias("id"), talk_words(F.col("url")).alias("words"),
        ]
        self.number = self._newest()
        state = json.loads(read_text(spark, self._list(self.number))) if self.number else {"batches": {}, "accepted": [], "spelling": []}
        self.batches: dict[str, dict] = state["batches"]
        self.accepted = SortedRuns(spark, f"{folder}/accepted", _ACCEPTED, _smallest, fan, range_rows, state["accepted"])
        self.spelling = SpellingIndex(SortedRuns(spark, f"{folder}/spelling", _SPELT, fan=fan, range_rows=range_rows, runs=state["spelling"]))

    def _list(self, number: int) -> str:
        return f"{self.folder}/list-{number:09d}.json"

    def _newest(self) -> int:
        """The number of the list that holds; 0 where there is none."""
        return max((int(n[5:14]) for n in list_names(self.spark, self.folder) if n.startswith("list-") and n.endswith(".json")), default=0)

    def keyed(self, batch: DataFrame) -> DataFrame:
        """(row, batch, accepted, key) of the rows that name a video; new words are filed first."""
        rows = batch.select(*self.named).where("row is not null and batch is not null and (id is not null or words is not null)")
        rows = cut(rows)
        talks = rows.where("id is null")
        slugs = talks.groupBy("words").agg(F.count("*").alias("n"))
        words = slugs.select(F.explode("words").alias("word"), "n").where(~F.col("word").rlike(r"\p{N}")).groupBy("word").agg(F.sum("n").alias("n"))
        forms = self.spelling.forms(words)
        places = slugs.select("words", F.posexplode("words").alias("i", "word"))
        reduced = places.join(forms, "word", "left")
        keys = reduced.groupBy("words").agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("form", "word").alias("w")))).alias("f"))
        keys = keys.select("words", F.concat(F.lit("t:"), F.array_join(F.col("f.w"), " ")).alias("key"))
        return rows.where("id is not null").select("row", "batch", "accepted", F.concat(F.lit("v:"), F.col("id")).alias("key")).unionByName(talks.join(keys, "words").select("row", "batch", "accepted", "key"))

    def match(self, keyed: DataFrame) -> DataFrame:
        """(old_row, new_row): for each keyed row of a batch the smallest accepted row of an earlier batch with its key."""
        old = _smallest(self.accepted.near(keyed))
        return keyed.join(old, "key").where("old_batch < batch").select("old_row", F.col("row").alias("new_row"))

    def take(self, batch_no: int, batch: DataFrame, out: str | None = None) -> None:
        """Check a batch against the history (into the folder out), add its accepted rows, and commit; a batch taken before is left alone."""
        if str(batch_no) in self.batches:
            return
        before = self.accepted.rows_read, self.spelling.runs.rows_read
        keyed = cut(self.keyed(batch))
        if out:
            self.match(keyed).write.mode("overwrite").parquet(f"{out}/batch={batch_no}")
        fresh = keyed.where("accepted").select("key", F.col("row").alias("old_row"), F.col("batch").alias("old_batch"))
        self.accepted.append(_smallest(fresh))
        read = {"accepted_read": self.accepted.rows_read - before[0], "spelling_read": self.spelling.runs.rows_read - before[1]}
        self.batches[str(batch_no)] = read | {"accepted_held": self.accepted.rows(), "spelling_held": self.spelling.runs.rows()}
        self._commit()

    def _commit(self) -> None:
        if self._newest() != self.number:
            raise FileExistsError(f"{self.folder} has been written by someone else")
        state = {"batches": self.batches, "accepted": self.accepted.runs, "spelling": self.spelling.runs.runs}
        write_text_once(self.spark, self._list(self.number + 1), json.dumps(state))
        self.number += 1
        if self.number > 1:
            delete_path(self.spark, self._list(self.number - 1))
        self.accepted.forget()
        self.spelling.runs.forget()


def repeated_rows(videos: DataFrame, folder: str | None = None, out: str | None = None) -> DataFrame:
    """(old_row, new_row) over all batches in order, each checked only against the runs of the batches before.

    With a folder (and out), the history and the results of batches taken before are kept, and only new batches are checked.
    """
    spark = videos.sparkSession
    own, out = folder or shared_path(spark, "history"), out or shared_path(spark, "repeats")
    index = HistoryIndex(spark, own)
    batches = sorted(r.batch_no for r in videos.select("batch_no").where("batch_no is not null").distinct().collect())
    for b in batches:
        index.take(b, videos.where(F.col("batch_no") == b), out)
    if not folder:
        delete_path(spark, own)
    schema = "old_row long, new_row long"
    return spark.read.schema(schema).parquet(out).select("old_row", "new_row") if batches else spark.createDataFrame([], schema)
