"""Parquet lakes: a directory of many small parquet files read as one table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINK_COLUMNS = ["PMID", "DOI"]


def read_lake(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All parquet files under ``path`` as one table, projected to ``columns``.

    The explicit projection drops writer artefacts such as a stored row index
    (``__index_level_0__``) and lets the scan read only those columns.
    """
    df = spark.read.option("recursiveFileLookup", "true").parquet(path)
    return df.select(*(columns or LINK_COLUMNS))


def read_link_lake(spark: SparkSession, path: str) -> DataFrame:
    """The (PMID, DOI) lake, both read as strings whatever a file stored.

    Spark merges the footers' schemas and one scan reads all files; if a
    column's type conflicts, files are read by their own schema.
    """
    try:
        lake = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(path)
    except Exception as e:  # noqa: BLE001 - Spark raises it from its footer job as well as from analysis
        if "MERGE" not in str(e):
            raise
        lake = read_drifting_lake(spark, path)
    return lake.select(*[F.col(c).cast("string").alias(c) for c in LINK_COLUMNS])


def union_drifting(frames: list[DataFrame]) -> DataFrame:
    """Union by column name across files whose columns drift.

    Missing columns become null.  A column whose type differs between frames
    is read as string in all of them, so the union never fails on a
    string-vs-number conflict (``mergeSchema`` would).
    """
    types: dict[str, set[str]] = {}
    for f in frames:
        for fld in f.schema.fields:
            types.setdefault(fld.name, set()).add(fld.dataType.simpleString())
    conflicting = {c for c, ts in types.items() if len(ts) > 1}

    def aligned(f: DataFrame) -> DataFrame:
        return f.select(*[F.col(c).cast("string").alias(c) if c in conflicting else F.col(c) for c in f.columns])

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [aligned(f) for f in frames])


def _footer_schemas(batches):
    import json

    import pandas as pd
    import pyarrow.parquet as pq

    from lakesmith.sources._fs import open_input

    for pdf in batches:
        out = []
        for path in pdf["path"]:
            with open_input(path) as f:
                schema = pq.read_schema(f)
            out.append((path, json.dumps([[fld.name, str(fld.type)] for fld in schema
                                          if not fld.name.startswith("__index_level_")])))
        yield pd.DataFrame(out, columns=["path", "schema"])


def file_schemas(spark: SparkSession, root: str) -> DataFrame:
    """``(path, schema)`` for every parquet file under ``root`` (schema as a
    JSON list of ``[column, arrow type]``); footers are read by the
    executors."""
    from lakesmith.sources.listings import file_inventory

    inv = file_inventory(spark, root, "*.parquet").select("path")
    return inv.mapInPandas(_footer_schemas, "path string, schema string")


def read_drifting_lake(spark: SparkSession, root_or_paths) -> DataFrame:
    """Parquet files whose columns drift, as one table.

    Given a folder, footers are read in a Spark job and only the distinct
    schemas (a handful) reach the driver.  If no column changes type, one
    ``mergeSchema`` scan of the folder reads everything (missing columns are
    null).  If a column's type conflicts, files are read per schema group and
    the conflicting columns are unioned as string; that path needs the file
    list per group on the driver - the same list Spark's file index keeps.
    Given a list of paths: one scan per path.
    """
    import json

    if isinstance(root_or_paths, (list, tuple)):
        return union_drifting([spark.read.parquet(p) for p in root_or_paths])
    schemas = file_schemas(spark, root_or_paths)
    distinct = [json.loads(r["schema"]) for r in schemas.select("schema").distinct().collect()]
    types: dict[str, set[str]] = {}
    for sch in distinct:
        for name, t in sch:
            types.setdefault(name, set()).add(t)
    if all(len(ts) == 1 for ts in types.values()):
        return (spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true")
                .parquet(root_or_paths).select(*types))
    groups: dict[str, list[str]] = {}
    for r in schemas.collect():
        groups.setdefault(r["schema"], []).append(r["path"])
    return union_drifting([spark.read.parquet(*sorted(paths)) for _, paths in sorted(groups.items())])
