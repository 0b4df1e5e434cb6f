"""XML ingest: gzipped article files -> (PMID, DOI) lake, one output per input.

Batch and stream are one path: Structured Streaming's file source lists the
landing folder, remembers which files it has handed over, and gives them in
bounded micro-batches; ids are picked with built-in higher-order functions and
rows without both ids are dropped.

A micro-batch is committed by one record.  Its rows go to the partitions of
their files and carry the batch's id; then one manifest file, renamed into
place, names every file of the batch, also those without rows.  Readers take of
each file the rows of the batch that its newest record names, so a load that
ends between the two writes changes nothing, and a file delivered again without
rows has none.  Replaced rows are deleted afterwards.

A damaged file does not stop a load: a batch that fails on its data is bisected
until the file stands alone, which the manifest then lists with the reason
(``dead_letters``); it is read again when its length or time has changed.

A file's identity is its path below the landing folder without ``.xml`` /
``.xml.gz``, so equal names in different folders are different files, and an
unpacked copy beside its archive is the same one (the archive is read).
"""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesmith.functions.ids import DOI_ID_TYPE, PUBMED_ID_TYPE, first_id_of_type
from lakesmith.operators.sinks import unescape_path
from lakesmith.sources import _fs
from lakesmith.sources.xml import PART_BYTES, SPREAD_BYTES, read_id_lists

XML_SUFFIX = ".xml.gz"
# Landed article files: gzipped as published, or already unpacked.
XML_GLOB = "{*.xml.gz,*.xml}"
_XML_NAME_END = r"\.xml(\.gz)?$"
MANIFEST = "_manifest"
CHECKPOINT = "_checkpoint"
LAKE_SCHEMA = "PMID string, DOI string, source_file string"
BATCH = "_batch"
STORED_SCHEMA = f"PMID string, DOI string, {BATCH} string, source_file string"
LOADED, EMPTY, FAILED = "loaded", "empty", "failed"
MANIFEST_SCHEMA = T.StructType([
    T.StructField("source_file", T.StringType()), T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
    T.StructField("modified", T.TimestampType()), T.StructField("status", T.StringType()), T.StructField("reason", T.StringType()),
    T.StructField("batch", T.StringType()), T.StructField("loaded_at", T.TimestampType()),
])
# Spark's error conditions for a file that cannot be read or parsed.
DATA_FAULTS = ("FAILED_READ_FILE", "MALFORMED_RECORD_IN_PARSING", "MALFORMED_XML", "EOFException", "ZipException", "XMLStreamException", "incorrect header check", "not a gzip file", "DamagedFile")
# bits of one bitmap of the engine, which tells the files that gave rows
MOST_FILES = 1 << 15


def xml_stem(name):
    """File name without ``.xml.gz`` / ``.xml`` (a suffix, not a character set)."""
    return F.regexp_replace(name, _XML_NAME_END, "")


def file_identity(path: Column, root: str) -> Column:
    """Path below ``root`` without the file ending; the file name for files elsewhere."""
    inner = root.rstrip("/").removeprefix("file:").replace("//", "/")
    plain = unescape_path(path)
    at = F.instr(plain, f"{inner}/")
    below = F.when(at > 0, F.substring(plain, at + F.lit(len(inner) + 1), F.length(plain))).otherwise(
        F.element_at(F.split(plain, "/"), -1))
    return xml_stem(below)


def _text_or_null(c):
    # an empty element has no text (null), not an empty string
    return F.nullif(c, F.lit(""))


def extract_links(id_lists: DataFrame, identity: Column | None = None) -> DataFrame:
    """``(PMID, DOI, source_file)``: first pubmed id and first DOI of each list,
    rows with either missing dropped."""
    return id_lists.select(
        _text_or_null(first_id_of_type("ArticleId", PUBMED_ID_TYPE)).alias("PMID"),
        _text_or_null(first_id_of_type("ArticleId", DOI_ID_TYPE)).alias("DOI"),
        (xml_stem(F.col("source_file")) if identity is None else identity).alias("source_file"),
    ).dropna("any", subset=["PMID", "DOI"])


def xml_links(spark: SparkSession, xml_path: str, own_only: bool = False) -> DataFrame:
    return extract_links(read_id_lists(spark, xml_path, own_only))


def _identity_of(path: str, root: str) -> str:
    """``file_identity`` of a path as the file listing gives it (no escapes)."""
    inner = root.rstrip("/").removeprefix("file:").replace("//", "/") + "/"
    at = path.find(inner)
    return re.sub(_XML_NAME_END, "", path[at + len(inner):] if at >= 0 else path.rsplit("/", 1)[-1])


# ---------------------------------------------------------------- the lake's records

def read_records(spark: SparkSession, lake_path: str) -> DataFrame | None:
    """Every record of the manifest, or None before the first load.  It lies under ``_manifest/``
    in the lake, which Spark's readers skip (leading underscore)."""
    path = _fs.join(lake_path, MANIFEST)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path) if _fs.list_files(path) else None


def newest_records(records: DataFrame) -> DataFrame:
    """The newest record of each file."""
    order = Window.partitionBy("source_file").orderBy(F.col("loaded_at").desc(), F.col("batch").desc_nulls_last())
    return records.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


def load_manifest(spark: SparkSession, lake_path: str) -> DataFrame | None:
    """``(source_file, path, loaded_at)`` of every file whose rows the lake holds, or None before the first load."""
    records = read_records(spark, lake_path)
    if records is None:
        return None
    held = newest_records(records.where(~F.col("status").eqNullSafe(FAILED)))
    return held.where(~F.col("status").eqNullSafe(EMPTY)).select("source_file", "path", "loaded_at")


def dead_letters(spark: SparkSession, lake_path: str) -> DataFrame:
    """``(source_file, path, length, modified, reason, loaded_at)`` of the files that could not be read when last tried.
    What an earlier delivery of such a file gave stays in the lake."""
    records = read_records(spark, lake_path)
    if records is None:
        records = spark.createDataFrame([], MANIFEST_SCHEMA)
    return newest_records(records).where(F.col("status") == FAILED).select("source_file", "path", "length", "modified", "reason", "loaded_at")


def read_link_partitions(spark: SparkSession, lake_path: str) -> DataFrame:
    """The lake's committed rows; its partition column is a string whatever the file names look like.

    Rows without a batch of files without a record are those of writers that keep none.
    """
    stored, records = spark.read.schema(STORED_SCHEMA).parquet(lake_path), read_records(spark, lake_path)
    if records is not None:
        live = newest_records(records.where(~F.col("status").eqNullSafe(FAILED))).select("source_file", "batch", F.lit(True).alias("_known"))
        stored = stored.join(live, "source_file", "left").where(
            F.col(BATCH).eqNullSafe(F.col("batch")) & (F.col("_known").isNotNull() | F.col(BATCH).isNull()))
    return stored.select("PMID", "DOI", "source_file")


def _commit(lake_path: str, rows: list[dict], batch: str) -> None:
    """One manifest file, renamed into place: a reader sees all of the batch or nothing."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(MANIFEST_SCHEMA)
    folder = _fs.join(lake_path, MANIFEST)
    _fs.makedirs(folder)
    hidden = _fs.join(folder, f".{batch}.parquet")
    with _fs.open_output(hidden) as out:
        pq.write_table(pa.Table.from_pylist(rows, schema=schema), out)
    _fs.move(hidden, _fs.join(folder, f"{batch}.parquet"))


# ---------------------------------------------------------------- loading

def _is_data_fault(error: Exception) -> bool:
    """Whether a job failed on what a file holds, not on the cluster."""
    return any(x in str(error) for x in DATA_FAULTS)


def _reason(error: Exception) -> str:
    """The deepest cause that the error tells, on one line."""
    causes = re.findall(r"DamagedFile: ([^\n]+)", str(error)) or re.findall(r"Caused by: ([^\n]+)", str(error))
    return (causes[-1] if causes else str(error).split("\n")[0])[:500]


def glob_escaped(path: str) -> str:
    """A listed path as a pattern that matches only itself."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _write(spark: SparkSession, paths: list[str], lake_path: str, root: str, batch: str, own_only: bool, spread: int = 0) -> set[str]:
    """The links of the files into their partitions; returns the files that gave rows (told by the write itself)."""
    names = sorted({_identity_of(p, root) for p in paths})
    places = F.broadcast(spark.createDataFrame([(n, i + 1) for i, n in enumerate(names)], "source_file string, _place int"))   # one row per file of the batch
    lists = read_id_lists(spark, [glob_escaped(p) for p in paths], own_only, spread)
    links = extract_links(lists, file_identity(F.col("path"), root)).join(places, "source_file")
    seen = Observation()
    told = links.observe(seen, F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("bits"))
    told.select("PMID", "DOI", F.lit(batch).alias(BATCH), "source_file").write.mode("append").partitionBy("source_file").parquet(lake_path)
    bits = bytes(seen.get["bits"])
    return {n for i, n in enumerate(names) if bits[i >> 3] >> (i & 7) & 1}


def _bisected(paths: list[str], write) -> tuple[set[str], dict[str, str]]:
    """``(files with rows, reasons by path)``: halves are tried alone until each damaged file is."""
    filled, bad, todo = set(), {}, [paths[i:i + MOST_FILES] for i in range(0, len(paths), MOST_FILES)]
    while todo:
        some = todo.pop()
        try:
            filled |= write(some)
        except Exception as e:  # noqa: BLE001 - Spark raises data faults under several classes
            if not _is_data_fault(e):
                raise
            if len(some) == 1:
                bad[some[0]] = _reason(e)
            else:
                todo += [some[len(some) // 2:], some[:len(some) // 2]]
    return filled, bad


def load_files(spark: SparkSession, files: list, lake_path: str, root: str, own_only: bool = False) -> None:
    """Load the listed files ``(path, length, modificationTime)``, as many as a micro-batch has, and commit them."""
    newest: dict = {}
    for f in files:   # "x.xml.gz" sorts behind "x.xml"
        name = _identity_of(f["path"], root)
        if name not in newest or f["path"] > newest[name]["path"]:
            newest[name] = f
    if not newest:
        return
    batch = uuid.uuid4().hex   # an attempt that ends early leaves rows under an id that no record names
    known = read_records(spark, lake_path)
    again = [] if known is None else [r.source_file for r in known.where(F.col("source_file").isin(list(newest))).select("source_file").distinct().collect()]
    lengths = {f["path"]: f["length"] for f in newest.values()}

    def write(paths: list[str]) -> set[str]:
        spread = -(-sum(lengths[p] for p in paths if lengths[p] > SPREAD_BYTES) // PART_BYTES)
        try:
            return _write(spark, paths, lake_path, root, batch, own_only, spread)
        except Exception as e:  # noqa: BLE001 - see _bisected
            if not (spread and len(paths) == 1 and _is_data_fault(e)):
                raise
            return _write(spark, paths, lake_path, root, batch, own_only)   # its pieces may not be well-formed, but the whole

    filled, bad = _bisected(list(lengths), write)
    now = datetime.now(timezone.utc)
    rows = [{
        "source_file": n, "path": f["path"], "length": f["length"], "modified": f["modificationTime"].astimezone(timezone.utc),
        "status": FAILED if f["path"] in bad else LOADED if n in filled else EMPTY, "reason": bad.get(f["path"]), "batch": batch, "loaded_at": now,
    } for n, f in newest.items()]
    _commit(lake_path, rows, batch)
    replaced = [n for n in again if newest[n]["path"] not in bad]
    if replaced:
        _remove_replaced(spark, lake_path, replaced, batch)


def _remove_replaced(spark: SparkSession, lake_path: str, names: list[str], batch: str) -> None:
    """Delete what other batches gave for these files (their partitions alone are read); readers skip it already."""
    from lakesmith.operators.sinks import remove_files

    stored = spark.read.schema(STORED_SCHEMA).parquet(lake_path)
    old = stored.where(F.col("source_file").isin(names) & ~F.col(BATCH).eqNullSafe(batch))
    remove_files(old.select(unescape_path(F.col("_metadata.file_path")).alias("path")).distinct())


def retry_changed(spark: SparkSession, landing: str, lake_path: str, own_only: bool = False, at_once: int = 1000) -> int:
    """Load the dead letters whose files have changed since; returns the number of batches."""
    from lakesmith.sources.listings import file_inventory

    dead = dead_letters(spark, lake_path).select("path", F.col("length").alias("_length"), F.col("modified").alias("_modified"))
    if dead.isEmpty():
        return 0
    there = file_inventory(spark, landing, XML_GLOB).join(dead, "path")
    changed = there.where((F.col("length") != F.col("_length")) | (F.col("modificationTime") != F.col("_modified")))
    files = changed.select("path", "length", "modificationTime").collect()   # of the dead letters
    for i in range(0, len(files), at_once):
        load_files(spark, files[i:i + at_once], lake_path, landing, own_only)
    return -(-len(files) // at_once)


def ingest_xml(spark: SparkSession, xml_path: str, lake_path: str, own_only: bool = False,
               skip_present: bool = True, remove_loaded: bool = False) -> DataFrame:
    """Load the article files under ``xml_path`` into the lake
    (``source_file=<identity>/`` per input file) and return the lake read back.

    ``skip_present``: files already loaded are not read again (the lake's own
    checkpoint, shared with the stream, remembers them, also those that
    yielded no rows); of those that failed, the changed ones are read again.
    Otherwise all are read and replace what they gave.
    ``remove_loaded``: the input files that were there before the load are
    deleted after it is committed, so a failed load never loses input.
    """
    from lakesmith.operators.sinks import remove_files
    from lakesmith.operators.tables import stage
    from lakesmith.sources.listings import file_inventory
    from lakesmith.streaming.ingest import stream_xml_links

    there = stage(file_inventory(spark, xml_path, XML_GLOB).select("path"), "xmlwork") if remove_loaded else None
    name = CHECKPOINT if skip_present else f"{CHECKPOINT}-{uuid.uuid4().hex}"
    stream_xml_links(spark, xml_path, lake_path, _fs.join(lake_path, name), own_only=own_only)
    if there is not None:   # damaged files stay, for whoever mends them
        remove_files(there.join(dead_letters(spark, lake_path).select("path"), "path", "left_anti"))
    return read_link_partitions(spark, lake_path)
