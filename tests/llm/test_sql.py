"""Queries with SQL give what DuckDB gives, on the smallest tables; all queries return the columns of their contract."""

import glob
import os

import duckdb
import pytest

from scriptorium.llm.queries import QUERIES, SQL
from test_catalogue import FOLDER, comparable

COLUMNS = {
    "op2": "doc_id piece start length ids_crc32 sequence_id offset", "op3": "doc_id held_out score predicted", "op4": "doc_id class_id",
    "op5": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next", "op6": "doc_id n_lines n_dropped kept_sha256",
    "op7": "vec_id n_links component_id kept", "op8": "doc_id n_words n_removed kept_sha256", "op9": "doc_id size text_crc32 law shard slot grown_shard",
    "op10": "doc_id size source_size target taken", "op1": "page_id",
}


def test_one_query_for_each_operator():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(f"op{n}" for n in range(1, 11))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    first = COLUMNS[name.split("_")[0]].split()
    assert list(got.columns)[: len(first)] == first and len(got)
    if name in SQL:
        db = duckdb.connect()
        for path in glob.glob(f"{FOLDER}/*.parquet"):
            db.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
        want = db.execute(SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert comparable(got) == comparable(want)
