"""Run the jobs from the command line: ``python -m lakesmith JOB ...`` or
``spark-submit --py-files lakesmith.zip lakesmith/__main__.py JOB ...``.

    python -m lakesmith link-table  --lake DIR --out DIR [--distinct-after-cast]
    python -m lakesmith xml-ingest  --xml DIR --lake DIR [--own-only] [--reload] [--remove-loaded]
    python -m lakesmith xml-stream  --xml DIR --lake DIR [--checkpoint DIR] [--max-files N] [--archive DIR]
    python -m lakesmith zip-ingest  --landing DIR --lake DIR --type T [--first Y --last Y] [--replace] [--remove-loaded]
    python -m lakesmith fetch-plan  --pages PARQUET --lake DIR --base-url URL --out DIR [--suffix S] [--start N] [--count N]
    python -m lakesmith responses   --raw PARQUET --out DIR

Every job prints one JSON line with what it did.  The session comes from
``SparkSession.builder.getOrCreate()``, so cluster settings (including
``spark.checkpoint.dir``) are whatever spark-submit passed.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lakesmith")
    sub = p.add_subparsers(dest="job", required=True)

    lt = sub.add_parser("link-table", help="lake of (PMID, DOI) files -> one clean typed table")
    lt.add_argument("--lake", required=True)
    lt.add_argument("--out", required=True)
    lt.add_argument("--distinct-after-cast", action="store_true")

    xi = sub.add_parser("xml-ingest", help="gzipped article XML -> (PMID, DOI) lake, one partition per file")
    xi.add_argument("--xml", required=True)
    xi.add_argument("--lake", required=True)
    xi.add_argument("--own-only", action="store_true")
    xi.add_argument("--reload", action="store_true", help="read files already in the lake again")
    xi.add_argument("--remove-loaded", action="store_true", help="delete input files once loaded")

    xs = sub.add_parser("xml-stream", help="incremental XML ingest (availableNow)")
    xs.add_argument("--xml", required=True)
    xs.add_argument("--lake", required=True)
    xs.add_argument("--checkpoint", help="default: the lake's own, which xml-ingest uses too")
    xs.add_argument("--max-files", type=int)
    xs.add_argument("--archive")

    zi = sub.add_parser("zip-ingest", help="planned zipped CSV archives -> typed parquet per archive")
    zi.add_argument("--landing", required=True)
    zi.add_argument("--lake", required=True)
    zi.add_argument("--type", required=True)
    zi.add_argument("--first", type=int)
    zi.add_argument("--last", type=int, help="last year, inclusive")
    zi.add_argument("--replace", action="store_true")
    zi.add_argument("--remove-loaded", action="store_true", help="delete archives once loaded")

    fp = sub.add_parser("fetch-plan", help="listing pages -> files still to load")
    fp.add_argument("--pages", required=True, help="parquet table (page_id, html)")
    fp.add_argument("--lake", required=True, help="lake whose parquet files count as present")
    fp.add_argument("--base-url", required=True)
    fp.add_argument("--out", required=True)
    fp.add_argument("--suffix", default=".xml.gz")
    fp.add_argument("--start", type=int, default=0)
    fp.add_argument("--count", type=int)

    rs = sub.add_parser("responses", help="landed JSONP responses (doi, raw) -> JSON documents")
    rs.add_argument("--raw", required=True)
    rs.add_argument("--out", required=True)
    return p


def run(spark: SparkSession, argv: list[str]) -> dict:
    from pyspark.sql import functions as F

    from lakesmith.session import ship_package

    a = _parser().parse_args(argv)
    ship_package(spark)
    if a.job == "link-table":
        from lakesmith.plans.linktable import publish_link_table

        rows = publish_link_table(spark, a.lake, a.out, a.distinct_after_cast)
        return {"job": a.job, "rows": rows, "out": a.out}
    if a.job == "xml-ingest":
        from lakesmith.plans.xml_ingest import ingest_xml

        lake = ingest_xml(spark, a.xml, a.lake, own_only=a.own_only, skip_present=not a.reload,
                          remove_loaded=a.remove_loaded)
        return {"job": a.job, "lake_rows": lake.count(), "lake": a.lake}
    if a.job == "xml-stream":
        from lakesmith.streaming.ingest import DEFAULT_MAX_FILES_PER_TRIGGER, stream_xml_links

        batches = stream_xml_links(spark, a.xml, a.lake, a.checkpoint,
                                   max_files_per_trigger=a.max_files or DEFAULT_MAX_FILES_PER_TRIGGER,
                                   clean_source="archive" if a.archive else None, archive_dir=a.archive)
        return {"job": a.job, "batches": batches, "lake": a.lake}
    if a.job == "zip-ingest":
        from lakesmith.plans.csv_ingest import FIRST_YEAR, LAST_YEAR_EXCLUSIVE, fetch_plan, ingest_planned, missing_archives

        first = a.first or FIRST_YEAR
        last_excl = (a.last + 1) if a.last else LAST_YEAR_EXCLUSIVE
        plan = fetch_plan(spark, [a.type], first, last_excl)
        lake = ingest_planned(spark, plan, a.landing, a.lake, a.type, replace=a.replace,
                              remove_loaded=a.remove_loaded)
        out = {"job": a.job, "lake_rows": lake.count(), "lake": a.lake}
        if not a.remove_loaded:   # else what was loaded is gone by now
            out["not_landed"] = missing_archives(spark, plan, a.landing, a.type).count()
        return out
    if a.job == "fetch-plan":
        from lakesmith.functions.paths import base_name, strip_suffix
        from lakesmith.plans.fetch_plan import plan_fetch
        from lakesmith.sources.listings import file_inventory

        from lakesmith.operators.sinks import present_partitions

        # present = a file <stem>.parquet (one file per input) or a partition
        # source_file=<stem>/ (this package's lakes)
        files = file_inventory(spark, a.lake, "*.parquet").select(
            strip_suffix(base_name(F.col("path")), ".parquet").alias("stem"))
        parts = present_partitions(spark, a.lake, ["source_file"]).select(F.col("source_file").alias("stem"))
        present = files.unionByName(parts).filter(F.col("stem") != "")
        todo = plan_fetch(spark.read.parquet(a.pages), present, suffix=a.suffix, base_url=a.base_url,
                          start=a.start, count=a.count, lake_prefix=a.lake)
        todo.write.mode("overwrite").parquet(a.out)
        return {"job": a.job, "todo": spark.read.parquet(a.out).count(), "out": a.out}
    if a.job == "responses":
        from lakesmith.plans.responses import ingest_responses

        counts = ingest_responses(spark.read.parquet(a.raw), a.out)
        return {"job": a.job, **counts, "out": a.out}
    raise SystemExit(f"unknown job {a.job}")


def main(argv: list[str] | None = None) -> None:
    spark = SparkSession.builder.appName("lakesmith").getOrCreate()
    print(json.dumps(run(spark, sys.argv[1:] if argv is None else argv)))


if __name__ == "__main__":
    main()
