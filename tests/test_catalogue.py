"""Every query with SQL gives what DuckDB gives, on the smallest tables."""

import glob
import os

import duckdb
import numpy as np
import pytest

from scriptorium.plans.catalogue import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


def comparable(frame):
    def cell(v):
        if isinstance(v, (bool, np.bool_)):
            return bool(v)
        return round(float(v), 5) if isinstance(v, (int, float, np.number)) else v

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(str([cell(v) for v in r]) for r in frame.where(frame.notna(), None).values.tolist())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    if name in SQL:
        db = duckdb.connect()
        for path in glob.glob(f"{FOLDER}/*.parquet"):
            db.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
        want = db.execute(SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert comparable(got) == comparable(want)
    else:
        assert len(got)


@pytest.mark.parametrize("text", ["here,###", "C#", "a &amp;&amp; b &quot;c&quot; &lt;d", "cut &amp", "&amp;lt;", "&#35; 1"])
def test_page_title(spark, tmp_path, text):
    html = [f"<title>{text}</title><h1>{text}</h1>", f"<title>{text}</title><p>x</p>"]
    spark.createDataFrame([(k, "https://x.org/", h) for k, h in enumerate(html)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["page_title"](spark, str(tmp_path)).toPandas()
    want = duckdb.sql(SQL["page_title"].replace("FROM pages", f"FROM '{tmp_path}/pages.parquet/*.parquet'")).df()
    assert comparable(got) == comparable(want)
