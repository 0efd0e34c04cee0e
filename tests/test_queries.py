"""Every query with an oracle gives the rows of its SQL."""

import math
import re

import duckdb
import pytest

import __spark_entry__
from tidemark.plans import queries as plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)

    def plain(x):
        return None if isinstance(x, float) and math.isnan(x) else x

    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    con.execute("CREATE TABLE expected AS " + plans.SQL[name])
    expected_names = [r[0] for r in con.execute("SELECT column_name FROM information_schema.columns WHERE table_name = 'expected' ORDER BY ordinal_position").fetchall()]
    expected = con.execute("SELECT * FROM expected").fetchall()
    found = __spark_entry__.queries()[name](spark, SF)
    assert sorted(found.columns) == sorted(expected_names)
    assert rows_of(found.columns, found.collect()) == rows_of(expected_names, expected)
    assert expected


def test_every_query_reads_the_tables(spark):
    """None is made of fixed rows alone."""
    for name in plans.SQL:
        assert re.search(rf"\b({'|'.join(TABLES)})\b", plans.SQL[name]), name


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_native_overlap_has_no_python_and_no_shuffle(spark):
    plan = __spark_entry__.queries()["overlap_lines"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_overlap_is_computed_once(spark):
    """No filter on the exploded array reaches the scan with the whole expression in it."""
    plan = __spark_entry__.queries()["overlap_lines"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zip_with") <= 2 and "Filter (size(" not in plan


def test_subtitle_segments_are_computed_once(spark):
    """As above, for an explode that gives places: the whole parsing stood in a scan filter as well."""
    plan = __spark_entry__.queries()["subtitle_segments"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zip_with") <= 2 and "Filter (size(" not in plan
