"""lakesmith: Spark jobs that turn landed research-data files into clean, typed tables.

Public API is plain functions that take and return DataFrames (or Columns).
Sub-packages:

- ``sources``    scans: gzipped XML, zipped CSV, plain CSV, parquet lakes, HTML
                 link lists, file inventories, numbered series
- ``functions``  Column -> Column helpers (identifier casts, paths, JSONP, tokens)
- ``operators``  DataFrame -> DataFrame steps, planning helpers and sinks
- ``plans``      composite jobs (link table, XML ingest, CSV ingest, fetch plan,
                 response ingest)
- ``streaming``  incremental file ingestion with Structured Streaming
- ``fixtures``   renders the driver tables into the file shapes the sources read

The most used entry points are re-exported here.
"""

from lakesmith.session import fresh_dir, get_session, scratch_dir, ship_package


def __getattr__(name):
    # entry points, imported on first use so ``import lakesmith`` stays light
    entry_points = {
        "build_link_table": "lakesmith.plans.linktable",
        "publish_link_table": "lakesmith.plans.linktable",
        "ingest_xml": "lakesmith.plans.xml_ingest",
        "xml_links": "lakesmith.plans.xml_ingest",
        "read_zip_csv": "lakesmith.sources.zipcsv",
        "typed_rows": "lakesmith.plans.csv_ingest",
        "ingest_planned": "lakesmith.plans.csv_ingest",
        "fetch_plan": "lakesmith.plans.csv_ingest",
        "plan_fetch": "lakesmith.plans.fetch_plan",
        "ingest_responses": "lakesmith.plans.responses",
        "stream_xml_links": "lakesmith.streaming.ingest",
    }
    if name in entry_points:
        import importlib

        return getattr(importlib.import_module(entry_points[name]), name)
    raise AttributeError(name)


__all__ = ["fresh_dir", "get_session", "scratch_dir", "ship_package", "build_link_table",
           "publish_link_table", "ingest_xml", "xml_links", "read_zip_csv", "typed_rows",
           "ingest_planned", "fetch_plan", "plan_fetch", "ingest_responses", "stream_xml_links"]
