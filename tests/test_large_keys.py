"""Keys as large tables have them: the queries against their SQL over made rows."""

import duckdb
import pytest

from ferrule.plans import catalogue


def both(spark, folder, name, table, select):
    con = duckdb.connect()
    con.execute(f"COPY ({select}) TO '{folder}/{table}.parquet'")
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    got = [tuple(r) for r in catalogue.QUERIES[name](spark, str(folder)).collect()]
    return sorted(got, key=str), sorted(con.execute(catalogue.ORACLE[name]).fetchall(), key=str)


@pytest.mark.parametrize("ids", ["(0), (2932896), (2932897), (9000000), (36000000)"])
def test_days_of_years_above_9999(spark, tmp_path, ids):
    got, want = both(spark, tmp_path, "date_scalars", "orders", f"SELECT col0::BIGINT AS o_orderkey, TIMESTAMP '1996-02-29' AS o_orderdate FROM (VALUES {ids})")
    assert got == want and any(r[4] == "10000-01-01" for r in got)


def test_order_keys_that_run_into_the_next_line(spark, tmp_path):
    rows = "(1, 5000000, 1, 10), (1, 100, 2, 20), (1, 200, 3, 30), (2, 7, 1, NULL), (2, 9, 1, 40), (3, NULL, 1, 50), (3, 5, NULL, 60), (4, 1, 1, NULL), (NULL, 3, 1, 70)"
    got, want = both(spark, tmp_path, "first_external_id", "lineitem", f"SELECT col0::BIGINT AS l_partkey, col1::BIGINT AS l_orderkey, col2::INTEGER AS l_linenumber, col3::BIGINT AS l_suppkey FROM (VALUES {rows})")
    assert got == want and (1, 20) in got


def test_first_of_rows_in_one_place(spark, tmp_path):
    rows = "(1, 1000005, 1, 90), (1, 5, 2, 20), (2, 7, 1, 60), (2, 7, 1, 30), (3, 8, 1, NULL), (3, 8, 1, 50), (3, 8, 1, 40)"
    select = "SELECT col0::BIGINT AS l_partkey, col1::BIGINT AS l_orderkey, col2::INTEGER AS l_linenumber, col3::BIGINT AS l_suppkey FROM (VALUES {})"
    got, want = both(spark, tmp_path, "first_external_id", "lineitem", select.format(rows))
    assert got == want == [(1, 90), (2, 60), (3, 50)]
    # files in the order of their names, whatever their sizes
    folder = tmp_path / "files"
    (folder / "lineitem.parquet").mkdir(parents=True)
    con = duckdb.connect(config={"threads": 1})
    con.execute(f"COPY ({select.format('(1, 7, 1, 80)')}) TO '{folder}/lineitem.parquet/a.parquet'")
    con.execute(f"COPY (SELECT i % 500 + 1 AS l_partkey, 7::BIGINT AS l_orderkey, 1 AS l_linenumber, i AS l_suppkey FROM range(100000) t(i)) TO '{folder}/lineitem.parquet/b.parquet'")
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{folder}/lineitem.parquet/*.parquet'")
    got = {tuple(r) for r in catalogue.QUERIES["first_external_id"](spark, str(folder)).collect()}
    assert got == set(con.execute(catalogue.ORACLE["first_external_id"]).fetchall()) and (1, 80) in got
