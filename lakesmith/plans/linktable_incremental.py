"""Link table kept up to date: only changed inputs are read, only touched parts rewritten.

``plans.linktable`` deduplicates the whole lake on every run.  Here the table
keeps, for every (PMID, DOI), the number of input units that hold it (its
support), and every unit's own distinct pairs.  A refresh finds the units that
were added, replaced or removed, takes the old pairs of those from the support
and adds the new ones; a pair is in the table while its support is positive.  So
a replaced input retracts what only it had said.

A unit is a source file of a lake with a manifest (``plans.xml_ingest``; its
version is the batch), or else a parquet file (its version is length and time).
The support is split into ranges of PMID, so newly published articles touch the
last few parts.  State is folders plus a commit log (``operators.versions``): a
refresh that fails changes nothing, and readers keep the version they opened.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesmith.functions.ids import python_int
from lakesmith.operators.sinks import TARGET_FILE_BYTES, files_for, unescape_path
from lakesmith.operators.versions import commit, latest
from lakesmith.plans.linktable import clean_links
from lakesmith.plans.xml_ingest import BATCH, EMPTY, FAILED, STORED_SCHEMA, glob_escaped, newest_records, read_records
from lakesmith.sources import _fs
from lakesmith.sources.lake import LINK_COLUMNS
from lakesmith.sources.listings import file_inventory

#: parts that growth of the PMIDs may add, as a multiple of the first parts; later ones share the last
GROWTH = 4
#: changed units that are read by name; beyond that the folder is scanned and filtered by a join
NAMED = 10_000
UNITS = "unit string, version string"
PAIRS = "unit string, PMID string, DOI string"
SUPPORT = "PMID string, DOI string, n bigint, part int"


def units(spark: SparkSession, lake_path: str) -> DataFrame:
    """``(unit, version)`` of the lake's inputs as they are now; from listings, no data file is opened."""
    records = read_records(spark, lake_path)
    if records is not None:
        live = newest_records(records.where(~F.col("status").eqNullSafe(FAILED)))
        return live.where(~F.col("status").eqNullSafe(EMPTY)).select(F.col("source_file").alias("unit"), F.coalesce("batch", F.lit("")).alias("version"))
    files = file_inventory(spark, lake_path, "*.parquet")
    return files.select(F.col("path").alias("unit"), F.concat_ws("/", "length", F.unix_micros("modificationTime")).alias("version"))


def _read_units(spark: SparkSession, lake_path: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
    """``(key, PMID, DOI)`` of the wanted units, read by name if they are few, or else of all; ``(key, unit)`` of the wanted; and whether they are few."""
    names = [r.unit for r in wanted.select("unit").limit(NAMED + 1).collect()]
    few = len(names) <= NAMED
    if read_records(spark, lake_path) is not None:
        stored = spark.read.schema(STORED_SCHEMA).parquet(lake_path)
        if few:
            stored = stored.where(F.col("source_file").isin(names))   # prunes partitions
        here = stored.select(F.col("source_file").alias("unit"), F.coalesce(BATCH, F.lit("")).alias("version"), *LINK_COLUMNS)
        return here.join(wanted, ["unit", "version"], "left_semi").select(F.col("unit").alias("key"), *LINK_COLUMNS), wanted.select(F.col("unit").alias("key"), "unit"), few
    if not names:
        return spark.createDataFrame([], PAIRS).withColumnRenamed("unit", "key"), wanted.select(F.col("unit").alias("key"), "unit"), few
    reader = spark.read.option("mergeSchema", "true")
    try:
        rows = reader.parquet(*map(glob_escaped, names)) if few else reader.option("recursiveFileLookup", "true").parquet(lake_path)
        rows = rows.select(*_as_text())
    except Exception as e:  # noqa: BLE001 - Spark raises it from its footer job as well as from analysis
        if "MERGE" not in str(e) or not few:
            raise
        one = [spark.read.parquet(glob_escaped(n)).select(*_as_text()) for n in names]   # types conflict: each file by its own
        rows = reduce(DataFrame.unionAll, one)
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(lake_path).select(F.col("_metadata.file_path").alias("key"))
    keys = listing.withColumn("unit", F.regexp_replace(unescape_path(F.col("key")), "^file:/+", "file:/"))   # the path as the file listing writes it
    return rows, keys.join(wanted.select("unit"), "unit", "left_semi"), few


def _pairs(spark: SparkSession, lake_path: str, wanted: DataFrame, keys_at: str) -> DataFrame:
    """``(unit, PMID, DOI)``, the distinct pairs of each wanted unit, together in a task.  Units are names of files, often
    long: rows carry numbers for them through the shuffle."""
    rows, keys, few = _read_units(spark, lake_path, wanted)
    keys.select("unit", "key", F.monotonically_increasing_id().alias("number")).write.parquet(keys_at)
    keys = spark.read.schema("unit string, key string, number bigint").parquet(keys_at)
    if few:
        keys = F.broadcast(keys)
    numbered = rows.join(keys.drop("unit"), "key").select("number", *LINK_COLUMNS).distinct().sortWithinPartitions("number")
    return numbered.join(keys.drop("key"), "number").select("unit", *LINK_COLUMNS)


def _as_text() -> list[Column]:
    return [F.col("_metadata.file_path").alias("key"), *[F.col(c).cast("string").alias(c) for c in LINK_COLUMNS]]


def _part(split: dict) -> Column:
    """Part of a pair: a range of PMIDs; texts that are no number have a part of their own."""
    number = python_int("PMID")
    place = F.floor((number.cast("double") - F.lit(float(split["first"]))) / F.lit(float(split["width"])))
    return F.when(number.isNull(), F.lit(-1)).otherwise(F.greatest(F.lit(0), F.least(place, F.lit(split["most"])))).cast("int")


def _split(pairs: DataFrame, total_bytes: int, part_bytes: int) -> dict:
    """Ranges of equal width over the bulk of the PMIDs (a few odd ones do not stretch them)."""
    n = files_for(total_bytes, part_bytes)
    low, high = pairs.select(python_int("PMID").alias("p")).agg(F.percentile_approx("p", [0.01, 0.99], 1000).alias("q")).first()["q"] or (0, 0)
    return {"first": low, "width": max(1, (high - low) // n + 1), "most": n * GROWTH}


def refresh_link_table(spark: SparkSession, lake_path: str, state_path: str, part_bytes: int = TARGET_FILE_BYTES) -> dict:
    """Bring the state up to the lake; returns ``{"units": changed units, "parts": rewritten parts}``.

    The first call builds everything.  ``CommitConflict`` tells that another
    refresh committed meanwhile; then the state is right and nothing is lost.
    """
    number, before = latest(state_path)
    run = uuid.uuid4().hex
    now_at, pairs_at, support_at = f"units-{run}", f"pairs-{run}", f"support-{run}"

    def at(folder: str) -> str:
        return _fs.join(state_path, folder)

    empty = spark.createDataFrame([], UNITS + ", pairs string")
    old = spark.read.schema(UNITS + ", pairs string").parquet(at(before["units"])) if before else empty
    now = units(spark, lake_path)
    both = now.join(old.withColumnsRenamed({"version": "old_version"}), "unit", "full").select(
        "unit", "version", "old_version", F.when(F.col("version").eqNullSafe(F.col("old_version")), F.col("pairs")).alias("kept_pairs"), F.col("pairs").alias("old_pairs"))
    both.write.parquet(at(now_at) + "-change")
    both = spark.read.parquet(at(now_at) + "-change")
    changed = both.where(~F.col("version").eqNullSafe(F.col("old_version")))
    n = changed.count()
    if before and not n:
        return {"units": 0, "parts": 0}

    _pairs(spark, lake_path, changed.where("version IS NOT NULL").select("unit", "version"), at(pairs_at) + "-keys").write.parquet(at(pairs_at))
    fresh = spark.read.schema(PAIRS).parquet(at(pairs_at))
    gone = changed.where("old_version IS NOT NULL").select("unit", F.col("old_pairs").alias("folder"))
    folders = [r.folder for r in gone.select("folder").distinct().collect()]   # one per refresh that loaded a changed unit
    retracted = spark.createDataFrame([], PAIRS)
    for f in folders:
        held = spark.read.schema(PAIRS).parquet(at(f))
        retracted = retracted.unionAll(held.join(gone.where(F.col("folder") == f).select("unit"), "unit", "left_semi").select("unit", *LINK_COLUMNS))

    split = before["split"] if before else _split(fresh, _bytes(spark, lake_path), part_bytes)
    signed = fresh.select(*LINK_COLUMNS, F.lit(1).alias("n")).unionAll(retracted.select(*LINK_COLUMNS, F.lit(-1).alias("n")))
    delta = signed.groupBy(*LINK_COLUMNS).agg(F.sum("n").alias("n")).where("n <> 0").withColumn("part", _part(split))
    delta.write.parquet(at(support_at) + "-delta")
    delta = spark.read.schema(SUPPORT).parquet(at(support_at) + "-delta")
    touched = {r.part for r in delta.select("part").distinct().collect()}   # at most as many as there are parts

    support: dict = dict(before["support"]) if before else {}
    held = {k: v for k, v in support.items() if int(k) in touched}
    merged = delta
    if held:   # the delta has each pair once
        merged = _support(spark, state_path, held).unionAll(delta).groupBy(*LINK_COLUMNS).agg(F.sum("n").alias("n"), F.max("part").alias("part"))
    # small parts lie in one file, so the files' number follows the bytes; filters on parts skip pages
    merged.where("n > 0").hint("rebalance", "part").sortWithinPartitions("part").select("PMID", "DOI", "n", "part").write.parquet(at(support_at))
    filled = {r.part for r in spark.read.schema(SUPPORT).parquet(at(support_at)).select("part").distinct().collect()}   # at most as many as there are parts
    for p in touched:
        support.pop(str(p), None)
        if p in filled:
            support[str(p)] = support_at
    kept = both.where("version IS NOT NULL").select("unit", "version", F.coalesce("kept_pairs", F.lit(pairs_at)).alias("pairs"))
    kept.write.parquet(at(now_at))
    used = [r.pairs for r in spark.read.schema(UNITS + ", pairs string").parquet(at(now_at)).select("pairs").distinct().collect()]
    commit(state_path, {"units": now_at, "split": split, "support": support, "folders": sorted({now_at, *used, *support.values()})}, number)
    return {"units": n, "parts": len(touched)}


def _bytes(spark: SparkSession, lake_path: str) -> int:
    return int(file_inventory(spark, lake_path, "*.parquet").agg(F.sum("length").alias("b")).first()["b"] or 0)


def _support(spark: SparkSession, state_path: str, support: dict) -> DataFrame:
    """The support's rows in the given parts, each from the folder of its last rewriting."""
    rows = spark.createDataFrame([], SUPPORT)
    for folder in sorted(set(support.values())):
        parts = [int(p) for p, f in support.items() if f == folder]
        here = spark.read.schema(SUPPORT).parquet(_fs.join(state_path, folder))
        rows = rows.unionAll(here.where(F.col("part").isin(parts)).select("PMID", "DOI", "n", "part"))
    return rows


def read_link_table(spark: SparkSession, state_path: str, number: int | None = None, distinct_after_cast: bool = False) -> DataFrame:
    """``(PMID bigint, DOI string)`` of the newest (or a given) refresh: what ``plans.linktable`` builds from the
    lake of that time.  Pairs are distinct already, so nothing is shuffled (but for ``distinct_after_cast``)."""
    _, record = latest(state_path, number)
    if not record:
        raise FileNotFoundError(f"{state_path} has no link table")
    pairs = _support(spark, state_path, record["support"]).select(*LINK_COLUMNS)
    return clean_links(pairs, distinct_after_cast, distinct=False)
