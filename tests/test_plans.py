"""Physical-plan checks: the shapes the scale design relies on."""

import pandas as pd
from pyspark.sql import functions as F

from lakesmith.operators.planning import batch_slice, not_yet_done
from lakesmith.operators.sinks import present_partitions, write_compacted
from lakesmith.plans.linktable import build_link_table
from lakesmith.sources.listings import page_links


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_presence_check_counts_nothing_first(spark):
    """No pre-check that gathers rows in one task: the plan is the anti-join and nothing else."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        work = spark.range(1000).withColumnRenamed("id", "k")
        done = spark.range(10).withColumnRenamed("id", "k")
        todo = not_yet_done(work, done, "k")
        plan = _plan(todo)
        assert "SinglePartition" not in plan and "Limit" not in plan and "LeftAnti" in plan
        assert todo.count() == 990
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_slices_do_not_gather_what_precedes_them(spark):
    plan = _plan(batch_slice(spark.range(1000).withColumnRenamed("id", "k"), ["k"], 900, 5))
    assert "SinglePartition" not in plan and "TakeOrdered" not in plan and "Limit" not in plan


def test_compaction_has_no_shuffle(spark, tmp_path):
    src, out = str(tmp_path / "many"), str(tmp_path / "few")
    spark.range(0, 1000, 1, 8).write.parquet(src)
    write_compacted(spark.read.parquet(src), out, 2)
    plan = _plan(spark.read.parquet(src).coalesce(2))
    assert "Exchange" not in plan
    import os

    assert 1 <= len([f for f in os.listdir(out) if f.startswith("part-")]) <= 2 and spark.read.parquet(out).count() == 1000


def test_link_table_scan_is_pruned_and_filtered(spark, tmp_path):
    lake = tmp_path / "lake"
    lake.mkdir()
    pd.DataFrame({"PMID": ["1"], "DOI": ["d"], "extra": ["x"]}).to_parquet(lake / "a.parquet")
    plan = build_link_table(spark, str(lake))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<PMID:string,DOI:string>" in plan or "struct<PMID:string,DOI:string>" in plan
    assert "EqualNullSafe(PMID,NOT_FOUND;INVALID_JOURNAL)" in plan
    # one shuffle: the distinct
    assert plan.count("Exchange hashpartitioning") == 1


def test_page_links_has_no_shuffle(spark):
    pages = spark.createDataFrame([(1, '<a href="x">x</a>')], "page_id bigint, html string")
    assert "Exchange" not in _plan(page_links(pages))


def test_present_partitions_from_listing(spark, tmp_path):
    out = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a", 1), (2, None, 2)], "k int, p string, q int")
    df.write.partitionBy("p", "q").parquet(out)
    got = sorted(((r.p, r.q) for r in present_partitions(spark, out, ["p", "q"], df.schema).collect()),
                 key=lambda t: t[1])
    assert got == [("a", 1), (None, 2)]
    assert dict(present_partitions(spark, out, ["p", "q"], df.schema).dtypes)["q"] == "int"


def test_per_input_sink_has_no_shuffle(spark, tmp_path):
    import gzip

    from lakesmith.plans.xml_ingest import xml_links

    d = tmp_path / "x"
    d.mkdir()
    with gzip.open(d / "f1.xml.gz", "wt") as f:
        f.write('<S><A><ArticleIdList><ArticleId IdType="pubmed">1</ArticleId>'
                '<ArticleId IdType="doi">d</ArticleId></ArticleIdList></A></S>')
    links = xml_links(spark, str(d))
    assert "Exchange" not in _plan(links)
    assert links.select(F.col("source_file")).first().source_file == "f1"
