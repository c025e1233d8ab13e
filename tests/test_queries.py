"""Every query with SQL against DuckDB over the same tables."""

import math
import os
import uuid

import duckdb
import pytest

from formloom.plans import assemble, file_queries, more_queries, page_queries  # noqa: F401  each registers its queries
from formloom.plans.queries import ORACLE_SQL, QUERIES
from formloom.sources import documents, sinks

SF = "/root/testdata/sf0.001"


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLE_SQL) and len(QUERIES) > 45


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    want = duck.sql(ORACLE_SQL[name])
    columns = sorted(want.columns)
    assert sorted(df.columns) == columns
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    place = [want.columns.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in place) for r in want.fetchall())


def test_corrected_files_in_rounds(spark, tmp_path, monkeypatch):
    """More rows than a round has: only a round's files are there at once, none stay, and the result is that of one round."""
    seen, write = [], file_queries.sinks.write_documents
    held = lambda: sum(len(list(d.glob("form-*"))) for d in tmp_path.glob("formloom-*"))

    def watched(*args):
        before = held()
        written = write(*args)
        seen.append((written[0], before, held()))
        return written

    monkeypatch.setattr(file_queries.sinks, "write_documents", watched)
    monkeypatch.setattr(file_queries, "ROWS_AT_ONCE", 10**9, raising=False)
    monkeypatch.setattr(file_queries, "scratch", lambda _, name: f"file://{tmp_path}/formloom-{name}-{uuid.uuid4().hex}")
    whole = sorted(map(tuple, QUERIES["corrected_files"](spark, SF).collect()))
    assert held() == 0 and [s[0] for s in seen] == [len(whole)] * 2
    seen.clear()
    monkeypatch.setattr(file_queries, "ROWS_AT_ONCE", 2500)
    assert sorted(map(tuple, QUERIES["corrected_files"](spark, SF).collect())) == whole
    few = seen[::2]
    assert len(few) > 1 and sum(s[0] for s in few) == len(whole) and all(s[1] == 0 for s in few) and max(s[2] for s in seen) < len(whole)
    assert held() == 0
    seen.clear()
    monkeypatch.setattr(file_queries, "ROWS_AT_ONCE", 1)
    monkeypatch.setattr(file_queries, "MOST_ROUNDS", 8)
    spark.read.parquet(f"{SF}/lineitem.parquet").where("l_orderkey < 70").write.parquet(f"{tmp_path}/small/lineitem.parquet")  # three documents: some rounds have none
    assert QUERIES["corrected_files"](spark, f"{tmp_path}/small").count() == 3 and any(s[0] == 0 for s in seen)


def test_documents_are_made_once(spark, tmp_path, monkeypatch):
    """A document's JSON and a text's type stand once in a plan: a filter on what is written, or lambdas that name a value often, had made them many times."""
    frame, plans = type(spark.range(0)), []
    through = frame.mapInArrow

    def watched(self, *args, **more):
        plans.append(through(self, *args, **more))
        return plans[-1]

    monkeypatch.setattr(frame, "mapInArrow", watched)
    docs = documents.documents(spark, f"file://{tmp_path}").where("status = 'ok'").drop("status", "error").withColumnRenamed("file_name", "doc_id")
    assert sinks.write_documents(assemble.validated(assemble.corrected(docs)), f"file://{tmp_path}", "(-cor)?(-texts)?", "-corrected.json") == (0, 0)
    shown = plans[0]._jdf.queryExecution().optimizedPlan().toString().lower()
    assert shown.count("structstojson") == 1 or shown.count("to_json") == 1
    assert shown.count("[±]") <= 3  # its type, its violation, the example in the message


def test_files_without_name_or_content(spark, tmp_path):
    rows = [("a.txt", "x"), (None, "y"), ("c.txt", None), ("d.txt", "")]
    assert sinks.write_files(spark.createDataFrame(rows, "name string, content string"), f"file://{tmp_path}") == (2, 1)
    assert sorted(os.listdir(tmp_path)) == ["a.txt", "d.txt"]
