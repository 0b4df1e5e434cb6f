"""A lake's small files packed to files of a target size, run after run.

``operators.sinks.write_compacted`` rewrites everything.  Here the lake stays as
it landed and a packed table beside it follows: files of half the target or more
are read where they are, smaller ones are packed into bins by their sizes, from
the file listing.  A run packs only files that are in no bin yet, with those of
bins that are under half full or have lost a member (a file removed or replaced);
all other bins stay untouched.  State is folders plus a commit log
(``operators.versions``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakesmith.operators.sinks import TARGET_FILE_BYTES, unescape_path
from lakesmith.operators.versions import commit, latest
from lakesmith.plans.xml_ingest import glob_escaped
from lakesmith.sources import _fs
from lakesmith.sources.listings import file_inventory

#: files that one task orders to put them into bins
FILES_PER_GROUP = 10_000
LISTED = "path string, version string, length bigint, folder string, bin bigint"
#: folder of the files that are read where they are
IN_PLACE = ""


def _bins(files: DataFrame, target_bytes: int) -> DataFrame:
    """``files`` with ``bin``: members of a bin add up to the target, give or take a file (which is under half of it).

    Files are dealt to groups by hash, and a running sum of the sizes in a group
    cuts it into bins; only a group's last bin may be less full.
    """
    groups = max(1, -(-files.count() // FILES_PER_GROUP))   # one small row per file
    group = F.pmod(F.xxhash64("path"), F.lit(groups))
    before = F.sum("length").over(Window.partitionBy("_group").orderBy("path").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("length")
    return files.withColumn("_group", group).withColumn("bin", F.col("_group") * (1 << 32) + F.floor(before / target_bytes)).drop("_group")


def compact_new(spark: SparkSession, lake_path: str, out_path: str, target_bytes: int = TARGET_FILE_BYTES) -> dict:
    """Bring the packed table up to the lake; returns ``{"packed": files packed now, "bins": bins written}``.

    Files are taken as written whole; one replaced in place counts as new by its
    length or time.  ``CommitConflict``: another run committed meanwhile.
    """
    number, before = latest(out_path)
    run = uuid.uuid4().hex
    folder, listed = f"pack-{run}", f"listed-{run}"
    files = file_inventory(spark, lake_path, "*.parquet").select(
        "path", F.concat_ws("/", "length", F.unix_micros("modificationTime")).alias("version"), "length")
    old = spark.read.schema(LISTED).parquet(_fs.join(out_path, before["listed"])) if before else spark.createDataFrame([], LISTED)
    held = old.withColumnRenamed("length", "old_length").join(files.withColumn("here", F.lit(True)), ["path", "version"], "left")
    whole = held.where(F.col("folder") != IN_PLACE).groupBy("folder", "bin").agg(
        F.every(F.col("here").isNotNull()).alias("all"), F.sum("old_length").alias("bytes")).where(F.col("all") & (2 * F.col("bytes") >= target_bytes))
    kept = held.where(F.col("folder") != IN_PLACE).join(whole.select("folder", "bin"), ["folder", "bin"], "left_semi").select("path", "version", "old_length", "folder", "bin").withColumnRenamed("old_length", "length")
    big = files.where(2 * F.col("length") >= target_bytes).select("path", "version", "length", F.lit(IN_PLACE).alias("folder"), F.lit(0).cast("long").alias("bin"))
    small = files.where(2 * F.col("length") < target_bytes).join(kept.select("path", "version"), ["path", "version"], "left_anti")
    small.write.parquet(_fs.join(out_path, f"small-{run}"))
    small = spark.read.parquet(_fs.join(out_path, f"small-{run}"))
    fresh = _bins(small, target_bytes).withColumn("folder", F.lit(folder))
    kept.unionByName(big).unionByName(fresh).select("path", "version", "length", "folder", "bin").write.parquet(_fs.join(out_path, listed))
    now = spark.read.schema(LISTED).parquet(_fs.join(out_path, listed))
    todo = now.where(F.col("folder") == folder).select("path", "bin")
    n = todo.agg(F.count(F.lit(1)).alias("files"), F.count_distinct("bin").alias("bins")).first()
    gone = bool(before) and not old.select("path", "version").exceptAll(now.select("path", "version")).isEmpty()
    if n["files"]:
        names = [r.path for r in todo.select("path").collect()]   # the list that the read needs anyway
        rows = spark.read.option("mergeSchema", "true").parquet(*map(glob_escaped, names))
        rows = rows.withColumn("_path", F.regexp_replace(unescape_path(F.col("_metadata.file_path")), "^file:/+", "file:/"))
        rows = rows.join(todo.withColumnsRenamed({"path": "_path", "bin": "_bin"}), "_path").drop("_path")
        # a bin is one task's, so one file
        rows.repartition(n["bins"], "_bin").write.partitionBy("_bin").parquet(_fs.join(out_path, folder))
    elif before and not gone and now.where(F.col("folder") == IN_PLACE).count() == old.where(F.col("folder") == IN_PLACE).count():
        return {"packed": 0, "bins": 0}
    used = [r.folder for r in now.select("folder").distinct().collect() if r.folder != IN_PLACE]   # one per run that packed
    commit(out_path, {"listed": listed, "folders": sorted([listed, *used])}, number)
    return {"packed": n["files"], "bins": n["bins"]}


def read_compacted(spark: SparkSession, out_path: str, number: int | None = None) -> DataFrame:
    """The lake's rows, from the packed files and the big ones where they are; columns by name, missing ones null."""
    _, record = latest(out_path, number)
    if not record:
        raise FileNotFoundError(f"{out_path} has no packed table")
    now = spark.read.schema(LISTED).parquet(_fs.join(out_path, record["listed"]))
    parts = []
    bins: dict[str, list[int]] = {}
    for r in now.where(F.col("folder") != IN_PLACE).select("folder", "bin").distinct().collect():   # one per packed file
        bins.setdefault(r.folder, []).append(r.bin)
    for folder, some in sorted(bins.items()):
        packed = spark.read.option("mergeSchema", "true").parquet(_fs.join(out_path, folder))
        parts.append(packed.where(F.col("_bin").isin(some)).drop("_bin"))
    big = [r.path for r in now.where(F.col("folder") == IN_PLACE).select("path").collect()]
    if big:
        parts.append(spark.read.option("mergeSchema", "true").parquet(*map(glob_escaped, big)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
