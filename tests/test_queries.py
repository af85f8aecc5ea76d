"""Every registered query against its SQL on the same files."""

import collections
import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from dimsmith.sources.readers import TABLE_NAMES

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def database(data_dir):
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{data_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(f"{value:.12g}")
    return value


def counted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return collections.Counter(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, data_dir, database, name):
    df = QUERIES[name](spark, data_dir)
    got = df.collect()
    cursor = database.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert counted(df.columns, got) == counted(names, cursor.fetchall())


def test_every_sql_text_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert not entry_point.entry(spark).isEmpty()


@pytest.mark.parametrize("name", ["sales_by_category", "sales_by_store"])
def test_lines_without_an_order_are_no_sales(spark, data_dir, tmp_path, name):
    con = duckdb.connect()
    for table in ("lineitem", "orders", "part", "supplier", "nation", "region"):
        path = f"{tmp_path}/{table}.parquet"
        rest = "WHERE o_orderkey % 3 > 0" if table == "orders" else ""
        con.execute(f"COPY (SELECT * FROM '{data_dir}/{table}.parquet' {rest}) TO '{path}' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, str(tmp_path))
    cursor = con.execute(ORACLES[name])
    assert counted(df.columns, df.collect()) == counted([d[0] for d in cursor.description], cursor.fetchall())
