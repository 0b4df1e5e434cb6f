"""Zipped, Latin-1, headered CSV archives -> string table, with the ``","``
fallback for badly quoted files.

Spark's CSV source cannot open a zip (it returns garbage rows, no error), so
the archives are read by Python inside ``mapInArrow`` (Arrow record batches
built directly, no pandas objects in between).  The work is still
Spark's: the file listing, one task per group of members (zip is not
splittable), and everything after the raw fields (header mapping, missing
tokens, type inference, casts, writes) is built-in expressions.

1. *list* - the archives' CSV members (zip central directory only), staged
   with their sizes; the bytes set the number of tasks.
2. *extract* - each member is examined, then read in the mode that fits it
   (``_records``), as ``(archive, member, row_no, fields)`` rows that carry a
   signature of their header.  No row is lost: what does not fit its header
   is kept in ``_bad_line``.  The rows are staged as parquet under the shared
   checkpoint folder, which also cuts the lineage back to the archives.
3. *map* - the distinct headers give the union of columns (one missing in
   one year is null there) and, per signature, where each column sits; rows
   look their positions up by signature.

Archives are opened by path through ``pyarrow.fs`` as seekable streams, so an
archive never has to fit in memory and no binary column passes through Arrow.
"""

from __future__ import annotations

import math
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesmith.session import fresh_dir
from lakesmith.sources import _records as R
from lakesmith.sources._fs import open_input

# Uncompressed bytes of members that one task reads.
TASK_BYTES = 64 * 1024 * 1024
# Archives whose member lists one task reads.
LISTED_PER_TASK = 100
# Member names read as CSV when an archive holds more than one file.
CSV_MEMBER_ENDINGS = (".csv", ".txt")


def _members(zf: zipfile.ZipFile):
    """The CSV members: an archive's only file whatever its name, else the
    ``.csv`` / ``.txt`` files (archive metadata folders skipped)."""
    files = [i.filename for i in zf.infolist() if not i.is_dir() and not i.filename.startswith("__MACOSX/")]
    if len(files) == 1:
        return files
    return [f for f in files if f.lower().endswith(CSV_MEMBER_ENDINGS)]


def _list_members(batches):
    """mapInArrow body: ``(archive, member, size)`` of each archive's CSV
    members, from the zip central directory only (no member is inflated)."""
    import pyarrow as pa

    for b in batches:
        rows = []
        for path in b.column("path").to_pylist():
            with open_input(path) as f, zipfile.ZipFile(f) as zf:
                rows += [(path, m, zf.getinfo(m).file_size) for m in _members(zf)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
             pa.array([r[2] for r in rows], pa.int64())], names=["archive", "member", "size"])


def _extract_members(batches):
    """mapInArrow body: the raw records of the listed ``(archive, member)``
    pairs; each archive is opened once per batch."""
    for b in batches:
        wanted: dict = {}
        for a, m in zip(b.column("archive").to_pylist(), b.column("member").to_pylist()):
            wanted.setdefault(a, []).append(m)
        for path in sorted(wanted):
            with open_input(path) as f, zipfile.ZipFile(f) as zf:
                for m in wanted[path]:
                    yield from R.chunks(lambda zf=zf, m=m: zf.open(m), path, m)


def spread(df: DataFrame, rows: int, work: float) -> DataFrame:
    """``df`` over as many tasks as its ``work`` fills, at least one per slot,
    at most one per row.  (A file scan alone would pack many small rows into
    one partition.)"""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, min(rows, max(slots, math.ceil(work)))))


def archive_paths(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """``path`` of every archive under ``path`` (content never read)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob).load(path).select("path"))


def extract_raw(archives: DataFrame) -> DataFrame:
    """Raw records of the archives listed in ``archives.path``.

    The unit of work is a member, not an archive: an archive of many files is
    parsed in parallel.
    """
    from pyspark.sql import Observation

    spark = archives.sparkSession
    n = archives.count()   # the work list: one small row per archive
    out, seen = fresh_dir(spark, "stage", "zipmembers"), Observation("zip_members")
    listing = spread(archives.select("path"), n, n / LISTED_PER_TASK).mapInArrow(
        _list_members, "archive string, member string, size bigint")
    listing.observe(seen, F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).write.parquet(out)
    work = (seen.get["bytes"] or 0) / TASK_BYTES
    return spread(spark.read.parquet(out), int(seen.get["n"]), work).mapInArrow(_extract_members, R.RAW_SCHEMA)


def union_columns(headers: list[list[str]]) -> list[str]:
    """Header names in first-seen order over the distinct headers (sorted);
    names that differ only in case are one column, by its first spelling."""
    cols: dict[str, str] = {}
    for header in sorted(headers):
        for h in header:
            cols.setdefault(h.casefold(), h)
    return list(cols.values())


def map_headers(staged: DataFrame) -> DataFrame:
    """Staged raw records as one string table: the engine's columns, the union
    of the headers' columns, ``_bad_line`` and ``_mode``.

    The distinct headers reach the driver, as the union of their columns is
    the schema; the positions by header go back to the tasks.
    """
    from lakesmith.operators.tables import column

    spark = staged.sparkSession
    heads = staged.filter(F.col(R.ROW_NO) == -1).select("_sig", "_fields").distinct().collect()
    columns = union_columns([h["_fields"] for h in heads])
    places = []
    for h in heads:
        at = {name.casefold(): i + 1 for i, name in enumerate(h["_fields"])}
        places.append((h["_sig"], [at.get(c.casefold()) for c in columns]))
    # as many rows as there are distinct headers, which the driver holds already
    mapping = F.broadcast(spark.createDataFrame(places, "_sig bigint, _idx array<int>"))
    rows = staged.filter(F.col(R.ROW_NO) >= 0).join(mapping, "_sig")
    fits = ~F.col("_ragged")
    values = [F.when(fits, F.try_element_at(F.col("_fields"), F.col("_idx")[i])).alias(c) for i, c in enumerate(columns)]
    line = (F.when(F.col(R.MODE) == R.SPLIT, F.array_join("_fields", R.FALLBACK_SEP)).otherwise(F.array_join("_fields", ",")))
    table = rows.select(R.ARCHIVE, R.MEMBER, R.ROW_NO, *values, F.when(~fits, line).alias(R.BAD_LINE), R.MODE)
    return table.select(*[column(c) for c in table.columns])


def stage_raw(raw: DataFrame) -> DataFrame:
    out = fresh_dir(raw.sparkSession, "stage", "csv")
    raw.write.parquet(out)
    return raw.sparkSession.read.parquet(out)


def read_zip_csv(spark: SparkSession, path: str | None = None, glob: str = "*.zip",
                 archives: DataFrame | None = None) -> DataFrame:
    """All CSV members of the archives (under ``path``, or the ``path``
    column of ``archives``) as one string table: ``_archive, _member,
    _row_no, <union of header columns>, _bad_line, _mode`` (``_mode`` tells
    how the member was parsed)."""
    if archives is None:
        archives = archive_paths(spark, path, glob)
    return map_headers(stage_raw(extract_raw(archives)))


def member_modes(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """Per member: how it is parsed (``standard`` / ``split`` / ``lines``), its
    rows, and how many of them were kept as ``_bad_line``."""
    return read_zip_csv(spark, path, glob).groupBy(F.col(R.ARCHIVE).alias("archive"), F.col(R.MEMBER).alias("member")).agg(
        F.first(R.MODE).alias("mode"), F.count(F.lit(1)).alias("rows"), F.count(R.BAD_LINE).alias("bad_lines"))
