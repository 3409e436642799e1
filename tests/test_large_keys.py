"""Queries against their SQL on keys with more digits than the names have places for."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as e


def both(spark, folder, name, **tables):
    """Rows of a query and of its SQL over the given tables, sorted."""
    c = duckdb.connect()
    for table, frame in tables.items():
        frame.to_parquet(f"{folder}/{table}.parquet")
        c.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    d = e.queries()[name](spark, str(folder))
    cols = ", ".join(f'"{k}"' for k in d.columns)
    key = lambda r: tuple((v is None, v) for v in r)
    return sorted((tuple(r) for r in d.collect()), key=key), sorted(c.execute(f"select {cols} from ({e.oracle_sql()[name]})").fetchall(), key=key)


@pytest.mark.parametrize("name", ["parse_numbers", "parse_plane_name"])
def test_parts(spark, tmp_path, name):
    part = pd.DataFrame({"p_partkey": [0, 1, 2, 99999, 100000, 100001, 123456, 1234567, 3000000001], "p_size": pd.array([1, 50, 3, 4, 5, 6, 7, 8, 9], "int32")})
    got, want = both(spark, tmp_path, name, part=part)
    assert got == want and len(got) == len(part)


def test_find_planes(spark, tmp_path):
    """Planes whose names are equal once cut, with and without a file."""
    keys = [7, 1234, 12340, 12341, 12349, 99999, 123456, 3000000001, 3000000002]
    customer = pd.DataFrame({"c_custkey": keys, "c_nationkey": pd.array([3] * len(keys), "int32")})
    orders = pd.DataFrame({"o_custkey": [12340, 12340, 99999, 3000000002, 5]})
    got, want = both(spark, tmp_path, "find_planes", customer=customer, orders=orders)
    assert got == want and sum(path is not None for _, path in got) == 3
