"""Every query against its DuckDB twin on the small tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from verification.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def canonical(rows, names):
    def cell(v):
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f"{v:.9g}"
        return "" if v is None else str(v)

    return sorted(tuple(cell(r[n]) for n in names) for r in rows)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(entry_point.oracle_sql()) & set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_twin(spark, duck, name):
    df = entry_point.queries()[name](spark, SF)
    names = sorted(df.columns)
    twin = duck.sql(entry_point.oracle_sql()[name]).to_arrow_table()
    assert sorted(twin.column_names) == names
    got = canonical(df.toArrow().to_pylist(), names)
    assert got and got == canonical(twin.to_pylist(), names)


def test_flagship_query(spark):
    assert entry_point.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name, column", [
    ("alias_scores", "alias_invoice"), ("structural_scores", "structural_invoice"), ("largest_amounts", "largest_amount"),
    ("rejects", "error"), ("output_parity", "source_key"), ("two_buckets", "text")])
def test_queries_can_fail(spark, name, column):
    """Results that would hide a wrong operator: one value everywhere, or nothing but NULL."""
    assert entry_point.queries()[name](spark, SF).select(column).distinct().limit(2).count() == 2
