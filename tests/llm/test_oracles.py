"""The registered queries against their SQL, and the pipeline against plain Python."""

import os

import duckdb
import pytest

from lakesmith.llm import queries

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    res = con.execute(queries.ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    got, expect = sorted(map(tuple, df.select(cols).collect())), sorted(res.fetchall())
    assert got == expect and got


def test_entry_registers_all():
    import __spark_entry__ as e

    names = e.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names} and "pipeline" in names


def test_pipeline_against_plain_python(spark):
    import corpus_pipeline as p
    from lakesmith.llm import language_id

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rejected = {r.doc_id for r in language_id.language_id(docs).where("rejected").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in rejected]
    last = {}
    for i, t in rows:
        k = (t or "").translate(brute.LOWER)
        last[k] = max(last.get(k, i), i)
    rows = [(i, t) for i, t in rows if last[(t or "").translate(brute.LOWER)] == i]
    rows = [(i, t) for (i, t), (_, _, c) in zip(rows, brute.ngram_join(rows), strict=True) if c == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [(i, t) for (i, t), x in zip(rows, brute.decontaminate(rows, items), strict=True) if not x[2]]
    got = p.run(spark, SF).collect()
    assert {(r.doc_id, r.decoded_sha256) for r in got} == {(i, brute.sha(t)) for i, t in rows} and len(got) == len(rows)


def test_stages_edges(spark, odd_docs, no_docs):
    """Every stage takes odd and empty tables and hands the columns of documents on."""
    import corpus_pipeline as p

    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd_docs.select(cols), no_docs.select(cols)):
        for name, stage in p.STAGES:
            out = stage(spark, docs, SF)
            if name != "sentencepiece":
                assert out.columns == cols
            assert out.count() <= docs.count()
    assert p.exact_dedup(spark, odd_docs.select(cols), SF).groupBy("text").count().where("count > 1").count() == 0


def test_sentencepiece_tasks_keep_one_python_worker(spark, odd_docs, tmp_path, capsys):
    """Encoding and decoding do not share a task."""
    import corpus_pipeline

    odd_docs.write.parquet(f"{tmp_path}/docs")
    out = corpus_pipeline.sentencepiece(spark, spark.read.parquet(f"{tmp_path}/docs"), str(tmp_path))
    out.explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1 and out.count() == odd_docs.count()
