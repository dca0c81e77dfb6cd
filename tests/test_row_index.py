"""Rows deduplicated across refreshes."""

from __future__ import annotations

import pytest

from orebelt.plans.row_index import RowIndex
from orebelt.sources.commits import CommitConflict

SCHEMA = "a int, b string"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_each_row_stays_with_its_first_source(spark, tmp_path):
    index = RowIndex(str(tmp_path))
    make = lambda rows: spark.createDataFrame(rows, SCHEMA)
    first = make([(1, "x"), (1, "x"), (None, "1"), (2, None)])
    assert _rows(index.keep_new(first, "m1")) == _rows(first.distinct())
    second = [(1, "x"), (1, None), (3, "z"), (3, "z")]
    assert _rows(index.keep_new(make(second), "m2")) == _rows(make([(1, None), (3, "z")]))
    commits = index.table.commits.last(spark)
    # loaded again: the same rows, and nothing is committed
    assert _rows(index.keep_new(first, "m1")) == _rows(first.distinct())
    assert _rows(index.keep_new(make([]), "m3")) == []
    assert index.table.commits.last(spark) == commits and index.size(spark) == 5
    # a row gained since is new, one that another source holds is not
    assert _rows(index.keep_new(make([(1, "x"), (9, "n"), (3, "z")]), "m1")) == _rows(make([(1, "x"), (9, "n")]))
    index.table.compact(spark, 2)
    assert len(index.table.deltas(spark)) < 3 and index.size(spark) == 6


def test_the_writer_that_was_overtaken_fails(spark, tmp_path):
    index = RowIndex(str(tmp_path))
    rows = spark.createDataFrame([(1, "x")], SCHEMA)
    digests = rows.selectExpr("1L as _h1", "2L as _h2", "'m1' as source")
    base = index.table.commits.last(spark)
    index.keep_new(rows, "m1")
    with pytest.raises(CommitConflict):
        index.table.add(digests, base)
    assert index.size(spark) == 1
