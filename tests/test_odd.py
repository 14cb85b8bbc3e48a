"""Every query of the core over empty tables and over odd ones."""

import os

import pytest

from scanloom.plans import queries, tables
from tests.odd import empty, odd

DATA = "/root/testdata/sf0.001"
QUERIES = tables.QUERIES | queries.QUERIES
#: Results over empty tables that still have rows: one row of counts, and a fixed list of shapes.
CONSTANT = {"crosswalk_counts": 1, "audit_counts": 1, "layout_infer": 16}

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def test_empty_tables(spark, tmp_path):
    folder = empty(DATA, str(tmp_path))
    assert {n: k for n, f in QUERIES.items() if (k := f(spark, folder).count())} == CONSTANT


def test_odd_tables(spark, tmp_path):
    folder = odd(DATA, str(tmp_path))
    for name, f in QUERIES.items():
        if name == "crosswalk_assign":  # a scan twice in one batch is an error by definition
            with pytest.raises(RuntimeError):
                f(spark, folder)
        else:
            f(spark, folder).count()
