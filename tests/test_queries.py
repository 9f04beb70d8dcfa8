"""Registered queries against their SQL at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from colloquy import queries as core
from tests_compare import compare


@pytest.mark.parametrize("name", sorted(core.REGISTRY))
def test_core_query(spark, folder, name):
    compare(spark, folder, name, core.REGISTRY)


def test_entry(spark, folder):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_transcripts_hold_words_without_a_time(spark, folder):
    n = {name: core.REGISTRY[name][0](spark, folder).agg({"n_words": "sum"}).first()[0] for name in ("turns_text", "transcripts")}
    assert n["transcripts"] > n["turns_text"]
