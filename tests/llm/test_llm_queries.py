"""Registered queries against their SQL at the smallest scale."""

from __future__ import annotations

import pytest

from colloquy.llm import queries
from tests_compare import compare


@pytest.mark.parametrize("name", sorted(queries.REGISTRY))
def test_query(spark, folder, name):
    compare(spark, folder, name, queries.REGISTRY)
