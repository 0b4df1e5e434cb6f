"""Sinks: one output per input file, compaction to a few large files, JSON
documents, and idempotent publishing (skip what is there, or replace only the
partitions a run touches)."""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesmith.functions.paths import base_name, strip_last_extension

# Target size of one compacted output file.
TARGET_FILE_BYTES = 256 * 1024 * 1024


def with_source_file(df: DataFrame, column: str = "source_file", strip_ext: bool = True) -> DataFrame:
    """Add the input file's base name (from the scan's hidden ``_metadata``)."""
    name = base_name(F.col("_metadata.file_name"))
    return df.withColumn(column, strip_last_extension(name) if strip_ext else name)


def write_per_source(df: DataFrame, path: str, column: str = "source_file", mode: str = "append",
                     rebalance: bool = False) -> None:
    """One output partition (``column=<value>/``) per input file.

    No shuffle by default: gzip and zip inputs cannot be split, so each input
    file is read by exactly one task, and the partitioned writer's local sort
    then gives one file per partition directory.  ``rebalance=True`` (for
    splittable inputs) adds a rebalance on ``column``; unlike a hash
    repartition, AQE splits an oversized partition there, so one huge input
    file does not land on one task.
    """
    if rebalance:
        df = df.hint("rebalance", column)
    df.write.mode(mode).partitionBy(column).parquet(path)


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path``, summed by a Spark job over the
    file listing (content column never read)."""
    inv = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
           .load(path).select("length"))
    total = inv.agg(F.sum("length").alias("b")).first()["b"]
    return int(total or 0)


def files_for(total_bytes: int, target_bytes: int = TARGET_FILE_BYTES) -> int:
    return max(1, math.ceil(total_bytes / target_bytes))


def write_compacted(df: DataFrame, path: str, n_files: int, mode: str = "overwrite",
                    cluster_by: list[str] | None = None) -> None:
    """Write ``df`` as at most ``n_files`` files of similar size.

    Without ``cluster_by`` nothing is shuffled: the scan already packs small
    files into tasks, and ``coalesce`` joins neighbouring tasks into
    ``n_files`` (sized from the bytes, so one task writes one target file).
    ``cluster_by``: range-partition and sort on these columns instead, so each
    file holds a disjoint key range and parquet min/max statistics let readers
    skip files and row groups.  Give a column list that is unique per row
    (e.g. the whole key), so one hot leading value is still split across files.
    """
    if cluster_by:
        out = df.repartitionByRange(n_files, *cluster_by).sortWithinPartitions(*cluster_by)
    else:
        out = df.coalesce(n_files)
    out.write.mode(mode).parquet(path)


def write_json_documents(df: DataFrame, variant_col: str, path: str, mode: str = "overwrite") -> None:
    """One JSON document per line, exactly the parsed value (no wrapping key).

    ``write.json`` would nest the value under the column name; ``to_json`` of
    the variant and a text sink keep the document as it was.
    """
    df.select(F.to_json(F.col(variant_col)).alias("value")).write.mode(mode).text(path)


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None, replace: bool = False,
            checked: bool = False) -> None:
    """Idempotent publish of a table to ``path``.

    ``replace=False``: partitions already present under ``path`` are left as
    they are and only new partitions are added (a second run adds nothing).
    ``replace=True``: the partitions this ``df`` holds are overwritten, others
    are kept (dynamic partition overwrite).  Unpartitioned tables are skipped
    or overwritten whole.  ``checked=True``: the caller already removed
    present partitions, so rows are appended without a second check.
    """
    spark = df.sparkSession
    exists = _exists(spark, path)
    if not partition_by:
        if exists and not replace:
            return
        df.write.mode("overwrite").parquet(path)
        return
    if replace:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(*partition_by).parquet(path))
        return
    if exists and not checked:
        df = _new_partitions(df, present_partitions(spark, path, partition_by, df.schema), partition_by)
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


# Fixed value: the directory name Hive-style writers use for a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def present_partitions(spark: SparkSession, path: str, columns: list[str], schema=None) -> DataFrame:
    """Distinct partition values already under ``path``, from the file listing.

    One row per data file from the ``binaryFile`` listing (no file opened),
    values cut from the ``col=value`` path segments, unescaped, and cast to
    the column types of ``schema``.  Cheaper than scanning the table, which
    would open every file.  Null partitions are rows too.
    """
    from lakesmith.sources.listings import file_inventory

    inv = file_inventory(spark, path, "*.parquet")
    cols = []
    for c in columns:
        raw = F.regexp_extract(F.col("path"), f"/{re.escape(c)}=([^/]*)/", 1)
        v = F.when(raw != NULL_PARTITION, unescape_path(raw))
        if schema is not None:
            v = v.try_cast(schema[c].dataType)
        cols.append(v.alias(c))
    return inv.select(*cols).distinct()


def unescape_path(segment):
    """``%XX`` escapes of a partition directory's value -> the characters (a ``+`` is a plus)."""
    return F.coalesce(F.try_url_decode(F.replace(segment, F.lit("+"), F.lit("%2B"))), segment)


def _new_partitions(df: DataFrame, present: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of partitions that are not present.  Null is a value here, and an
    empty string lands in the null partition, as the partitioned writer puts it."""
    from lakesmith.operators.planning import not_yet_done

    keys = {f"_key_{i}": F.nullif(F.col(f"`{c}`"), F.lit("")) if df.schema[c].dataType.simpleString() == "string" else F.col(f"`{c}`")
            for i, c in enumerate(columns)}
    done = present.select(*[F.col(f"`{c}`").alias(k) for k, c in zip(keys, columns)])
    return not_yet_done(df.withColumns(keys), done, list(keys), null_safe=True).drop(*keys)


def _exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` already holds data files (anything but ``_``/``.``
    markers).  Checked on the filesystem without planning a read; if the
    driver cannot open that filesystem through ``pyarrow.fs`` (e.g. HDFS
    without libhdfs), a Spark file listing answers instead."""
    try:
        from pyarrow import fs as pafs

        from lakesmith.sources import _fs

        filesystem, inner = _fs.resolve(path)
        if filesystem.get_file_info(inner).type == pafs.FileType.NotFound:
            return False
        entries = filesystem.get_file_info(pafs.FileSelector(inner, recursive=False))
        return any(not e.base_name.startswith(("_", ".")) for e in entries)
    except Exception:  # noqa: BLE001 - fall back to Spark's own filesystem access
        from pyspark.errors import AnalysisException

        try:
            listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                       .load(path).select("path"))
            return not listing.filter(~F.col("path").rlike(r"/[_.][^/]*$")).isEmpty()
        except AnalysisException:
            return False


def _delete_paths(batches):
    import pyarrow as pa

    from lakesmith.sources import _fs

    for b in batches:
        paths = b.column("path").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array([_fs.delete_file(p) for p in paths], pa.bool_())],
            names=["path", "deleted"])


def remove_files(paths: DataFrame) -> int:
    """Delete the files listed in ``paths.path`` (raw inputs after a committed
    load), spread over tasks; returns how many were deleted.  Idempotent: a
    retried task finds its files already gone."""
    spread = paths.select("path").repartition("path")
    done = spread.mapInArrow(_delete_paths, "path string, deleted boolean")
    return done.filter(F.col("deleted")).count()
