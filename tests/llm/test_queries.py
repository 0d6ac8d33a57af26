"""The registered queries p1 to p10 on the smallest tables, and their SQL where there is some."""

import glob
import os

import duckdb
import pytest

from pagelathe.llm import queries

COLUMNS = {
    "p1_found": ["page_id", "line_num"],
    "p2_found": ["page_id_1", "page_id_2"],
    "p3_found": ["page_id", "line_num"],
    "p4_found": ["page_id"],
    "p5_found": ["page_id", "line_num"],
    "p6_found": ["page_id_1", "page_id_2"],
    "p7_found": ["seed", "page_id"],
    "p8_ids": ["doc_id", "ids"],
    "p10_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, data, name):
    rows = queries.queries()[name](spark, data)
    assert rows.columns == COLUMNS.get(name, rows.columns)
    got = [str(r) for r in rows.collect()]
    if name in COLUMNS and name != "p8_ids":
        assert len(got) == len(set(got))  # each case once


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = sorted(con.execute(queries.oracle_sql()[name]).fetchall())
    assert sorted(tuple(r) for r in queries.queries()[name](spark, folder).collect()) == want
