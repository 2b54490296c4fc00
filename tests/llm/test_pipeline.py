"""The registered queries and the pipeline on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from tallyloom.llm import importance, jaccard, pii, queries
from tallyloom.llm.scratch import written

from .helpers import awkward, classes, shingles
from .test_pii import base

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the driver's tables")
TABLES = ("documents", "pages", "labels")


def plain(df, columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(round(r[i], 6)) if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert plain(df, df.columns, df.collect()) == plain(df, columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_query_has_a_row_per_document(spark, name):
    df = queries.QUERIES[name](spark, SF)
    table = queries.table(spark, SF, "pages" if name.startswith("op10") else "documents")
    key = "page_id" if name.startswith("op10") else "doc_id"
    assert df.select(key).distinct().count() == table.count()
    assert name == "op6_packing" or df.count() == table.count()


def test_pipeline_stage_by_stage(spark):
    docs = queries.table(spark, SF, "documents")
    labels = queries.table(spark, SF, "labels")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = written(stage(spark, docs, SF), name)
        out[name] = docs
        if name != "packing":
            assert docs.columns == before.columns
        if name == "quality":
            want = {r.doc_id for r in importance.select(before, labels).filter("selected").collect()}
            assert {r.doc_id for r in docs.collect()} == want
        if name == "near_duplicates":
            comps = classes({r.doc_id: shingles(r.text) for r in before.collect()})
            assert sorted(r.doc_id for r in docs.collect()) == sorted(set(comps.values()))
            assert {r.doc_id: r.component for r in jaccard.join(before).collect()} == comps
        if name == "personal_data":
            old = {r.doc_id: r.text for r in before.collect()}
            for r in docs.collect():
                assert base(r.text) == [] and r.n_chars == len(r.text)
                assert r.text == old[r.doc_id] or pii.exact(old[r.doc_id])
        if name == "mixing":
            assert {r.doc_id for r in docs.collect()} <= {r.doc_id for r in before.collect()}
    rows = docs.groupBy("doc_id").sum("length").collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in out["mixing"].collect()}


def test_pipeline_awkward(spark, tmp_path):
    """Nulls, empty, repeated and clashing rows through all stages; and empty tables."""
    docs = awkward(spark)
    labels = "doc_id bigint, quality int, toxic int"
    for name, rows in (("full", docs), ("none", docs.limit(0))):
        rows.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (5, 1, 0), (None, 1, 1), (8, 0, None)] if name == "full" else [], labels).write.parquet(f"{tmp_path}/{name}/labels.parquet")
        sf, at = f"{tmp_path}/{name}", spark.read.parquet(f"{tmp_path}/{name}/documents.parquet")
        for stage_name, stage in corpus_pipeline.STAGES:
            before, at = at, written(stage(spark, at, sf), stage_name)
            if stage_name != "packing":
                assert at.columns == before.columns
            if stage_name == "near_duplicates":
                ids = [r.doc_id for r in at.select("doc_id").collect()]
                assert len(ids) == len(set(ids)) and 6 not in ids
        assert (at.count() == 0) == (name == "none")


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
