"""Incremental ingestion: reruns add nothing, new files add only their rows,
bounded files per micro-batch, processed files archived."""

import gzip
import os

from lakesmith.streaming.ingest import stream_xml_links


def _article_file(path, first_id, n):
    arts = "".join(
        f'<PubmedArticle><PubmedData><ArticleIdList><ArticleId IdType="pubmed">{i}</ArticleId>'
        f'<ArticleId IdType="doi">10.1/{i}</ArticleId></ArticleIdList></PubmedData></PubmedArticle>'
        for i in range(first_id, first_id + n)
    )
    with gzip.open(path, "wt") as f:
        f.write(f"<PubmedArticleSet>{arts}</PubmedArticleSet>")


def test_rerun_and_new_file(spark, tmp_path):
    landing, lake, ckpt = tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "ckpt")
    landing.mkdir()
    _article_file(landing / "pubmed23n0001.xml.gz", 0, 5)
    _article_file(landing / "pubmed23n0002.xml.gz", 100, 3)
    assert stream_xml_links(spark, str(landing), lake, ckpt) >= 1
    assert spark.read.parquet(lake).count() == 8
    assert stream_xml_links(spark, str(landing), lake, ckpt) == 0     # nothing new
    assert spark.read.parquet(lake).count() == 8
    _article_file(landing / "pubmed23n0003.xml.gz", 200, 4)
    stream_xml_links(spark, str(landing), lake, ckpt)
    df = spark.read.parquet(lake)
    assert df.count() == 12
    assert {r.source_file for r in df.select("source_file").distinct().collect()} == {
        "pubmed23n0001", "pubmed23n0002", "pubmed23n0003"}


def test_max_files_per_trigger(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    for i in range(3):
        _article_file(landing / f"f{i}.xml.gz", i * 10, 2)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")       # the count does not come from there
    try:
        batches = stream_xml_links(spark, str(landing), str(tmp_path / "lake"), str(tmp_path / "ckpt"),
                                   max_files_per_trigger=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert batches == 3
    assert spark.read.parquet(str(tmp_path / "lake")).count() == 6


def test_clean_source_archives_processed_files(spark, tmp_path):
    landing, archive = tmp_path / "in", tmp_path / "archive"
    landing.mkdir()
    for i in range(3):
        _article_file(landing / f"g{i}.xml.gz", i * 10, 2)
    stream_xml_links(spark, str(landing), str(tmp_path / "lake"), str(tmp_path / "ckpt"),
                     max_files_per_trigger=1, clean_source="archive", archive_dir=str(archive))
    assert spark.read.parquet(str(tmp_path / "lake")).count() == 6
    moved = [f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".xml.gz")]
    left = [f for f in os.listdir(landing) if f.endswith(".xml.gz")]
    # best effort, one batch late: at least the earlier files have moved
    assert len(moved) >= 1 and len(moved) + len(left) == 3
