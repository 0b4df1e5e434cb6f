"""The command-line jobs, run in-process on small inputs."""

import gzip
import zipfile

import pandas as pd

from lakesmith.__main__ import run


def test_link_table_job(spark, tmp_path):
    lake = tmp_path / "lake"
    lake.mkdir()
    pd.DataFrame({"PMID": ["1", "1", "x", None], "DOI": ["a", "a", "b", "c"]}).to_parquet(lake / "f.parquet")
    out = run(spark, ["link-table", "--lake", str(lake), "--out", str(tmp_path / "t")])
    assert out["rows"] == 1


def test_xml_jobs(spark, tmp_path):
    xml = tmp_path / "xml"
    xml.mkdir()
    with gzip.open(xml / "p1.xml.gz", "wt") as f:
        f.write('<S><A><ArticleIdList><ArticleId IdType="pubmed">1</ArticleId>'
                '<ArticleId IdType="doi">d1</ArticleId></ArticleIdList></A></S>')
    assert run(spark, ["xml-ingest", "--xml", str(xml), "--lake", str(tmp_path / "l1")])["lake_rows"] == 1
    out = run(spark, ["xml-stream", "--xml", str(xml), "--lake", str(tmp_path / "l2"),
                      "--checkpoint", str(tmp_path / "ck")])
    assert out["batches"] == 1


def test_zip_ingest_job(spark, tmp_path):
    landing = tmp_path / "projects"
    landing.mkdir()
    for year in (1990, 1991):
        with zipfile.ZipFile(landing / f"{year}.zip", "w") as z:
            z.writestr(f"{year}.csv", f"id,v\n{year},x\n".encode("latin-1"))
    args = ["zip-ingest", "--landing", str(landing), "--lake", str(tmp_path / "lake"), "--type", "projects",
            "--first", "1990", "--last", "1990"]
    assert run(spark, args)["lake_rows"] == 1
    args[-1] = "1991"
    assert run(spark, args)["lake_rows"] == 2          # only 1991 is added


def test_fetch_plan_and_responses_jobs(spark, tmp_path):
    pages = tmp_path / "pages.parquet"
    pd.DataFrame({"page_id": [1], "html": ['<a href="a.xml.gz">a</a><a href="b.xml.gz">b</a>']}).to_parquet(pages)
    lake = tmp_path / "lake"
    lake.mkdir()
    pd.DataFrame({"PMID": ["1"], "DOI": ["d"]}).to_parquet(lake / "a.parquet")
    out = run(spark, ["fetch-plan", "--pages", str(pages), "--lake", str(lake), "--base-url", "https://h/",
                      "--out", str(tmp_path / "todo")])
    assert out["todo"] == 1
    assert spark.read.parquet(str(tmp_path / "todo")).first().url == "https://h/b.xml.gz"
    raw = tmp_path / "raw.parquet"
    pd.DataFrame({"doi": ["d1", "d2"], "raw": ['﻿({"a": 1})', 'cb({"a": 2})']}).to_parquet(raw)
    assert run(spark, ["responses", "--raw", str(raw), "--out", str(tmp_path / "docs")])["documents"] == 1


def test_fetch_plan_sees_partitioned_lake(spark, tmp_path):
    pages = tmp_path / "pages.parquet"
    pd.DataFrame({"page_id": [1], "html": ['<a href="a.xml.gz">a</a><a href="b.xml.gz">b</a>']}).to_parquet(pages)
    lake = str(tmp_path / "lake")
    spark.createDataFrame([("1", "d", "b")], "PMID string, DOI string, source_file string") \
        .write.partitionBy("source_file").parquet(lake)
    out = run(spark, ["fetch-plan", "--pages", str(pages), "--lake", lake, "--base-url", "https://h/",
                      "--out", str(tmp_path / "todo")])
    assert out["todo"] == 1
    assert spark.read.parquet(str(tmp_path / "todo")).first().stem == "a"


def test_zip_ingest_remove_loaded(spark, tmp_path):
    import os

    from lakesmith.plans.csv_ingest import fetch_plan, ingest_planned

    landing = tmp_path / "projects"
    landing.mkdir()
    for year in (1990, 1991):
        with zipfile.ZipFile(landing / f"{year}.zip", "w") as z:
            z.writestr(f"{year}.csv", f"id,v\n{year},x\n".encode("latin-1"))
    lake = ingest_planned(spark, fetch_plan(spark, ["projects"], 1990, 1991), str(landing),
                          str(tmp_path / "lake"), "projects", remove_loaded=True)
    assert lake.count() == 1
    assert sorted(os.listdir(landing)) == ["1991.zip"]     # only the loaded archive is gone
