"""Reading model replies: JSON inside fences or prose, error outcomes, text normalisation."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FENCE = "`" * 3


def json_text(reply: Column) -> Column:
    """The JSON object of a reply: without fences, or from the first { to the last }; null where neither parses."""
    lines = F.split(F.trim(reply), "\n")
    fence = lambda line: F.trim(line).startswith(FENCE)
    clean = F.array_join(F.filter(lines, lambda line: ~fence(line)), "\n")
    first, last = F.locate("{", reply), F.length(reply) - F.locate("}", F.reverse(reply)) + 1
    inner = F.when((first > 0) & F.contains(reply, F.lit("}")) & (last > first), F.substring(reply, first, last - first + 1))
    valid = lambda c: F.when(F.try_parse_json(c).isNotNull(), c)
    return F.coalesce(valid(clean), valid(inner))


def vote_of(reply: Column, schema: str) -> Column:
    """The reply as a struct; null where it holds no JSON."""
    return F.from_json(json_text(reply), schema)


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Canonical composition (no built-in does it)."""
    return text.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def in_vocabulary(text: Column, vocabulary: Column) -> Column:
    """The characters of a text that are in an array of characters."""
    return F.array_join(F.filter(F.split(text, ""), lambda c: F.array_contains(vocabulary, c)), "")


def outcome(value: Column, error: Column) -> Column:
    """struct<value, error>: what a stage that may fail hands on."""
    return F.struct(value.alias("value"), error.alias("error"))
