"""Every llm query over empty tables and over odd ones."""

import os

import pytest

from scanloom.llm.queries import QUERIES
from tests.odd import empty, odd

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def test_empty_tables(spark, tmp_path):
    folder = empty(DATA, str(tmp_path))
    assert not {n: k for n, f in QUERIES.items() if (k := f(spark, folder).count())}


def test_odd_tables(spark, tmp_path):
    folder = odd(DATA, str(tmp_path))
    for f in QUERIES.values():
        f(spark, folder).count()
