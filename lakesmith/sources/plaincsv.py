"""Unzipped Latin-1 CSV.

``read_csv`` reads each file whole, by its own header, with the records of
the zip reader: files whose columns differ in order or number are mapped by
name, quoted newlines and unclosed quotes are handled, and every row with more
fields than its header is kept in ``_bad_line``.  A file of at most
``range_bytes`` is read by one task, a bigger one in such ranges of bytes, which
are dealt to tasks (``_ranges``), with the same rows.

``read_csv_lines`` is for big files of one record per line and one header: it
uses Spark's own CSV source, which splits them over tasks.  A file whose
header differs from the first one's fails the job.

All columns are strings (typing is a separate whole-column step,
``operators.tables.infer_and_cast``); a row shorter than the header is padded
with nulls, as CSV readers do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesmith.operators.tables import column
from lakesmith.sources import _records as R
from lakesmith.sources._fs import open_input
from lakesmith.sources._ranges import extract_ranges
from lakesmith.sources.zipcsv import TASK_BYTES, map_headers, spread, stage_raw

ENCODING = "ISO-8859-1"
_CORRUPT = "_corrupt_record"


def _extract_files(mode: str | None):
    def extract(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                yield from R.chunks(lambda path=path: open_input(path), path, "", mode)

    return extract


def _read(spark: SparkSession, path: str, glob: str | None, mode: str | None, range_bytes: int) -> DataFrame:
    from lakesmith.sources.listings import file_inventory

    files = file_inventory(spark, path, glob).select("path", "length")
    big = F.col("length") > range_bytes
    small, total = files.where(~big), files.agg(
        F.count_if(~big).alias("n"), F.sum(F.when(~big, F.col("length"))).alias("bytes"), F.count_if(big).alias("big")).first()
    raw = spread(small.select("path"), total["n"], (total["bytes"] or 0) / TASK_BYTES).mapInArrow(_extract_files(mode), R.RAW_SCHEMA)
    if total["big"]:
        raw = raw.unionAll(extract_ranges(files.where(big), range_bytes, mode))
    table = map_headers(stage_raw(raw))
    return table.drop(R.ARCHIVE, R.MEMBER, R.ROW_NO, R.MODE)


def read_csv(spark: SparkSession, path: str, glob: str | None = None, range_bytes: int = TASK_BYTES) -> DataFrame:
    """CSV files under ``path``: string columns named by the headers, plus ``_bad_line``."""
    return _read(spark, path, glob, None, range_bytes)


def read_quote_split_csv(spark: SparkSession, path: str, glob: str | None = None, range_bytes: int = TASK_BYTES) -> DataFrame:
    """The ``","`` split on plain files: one line per row, no quoting; outer
    quotes removed from header names and from the first and last value."""
    return _read(spark, path, glob, R.SPLIT, range_bytes)


def read_csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """One record per line and one header for all files: string columns plus ``_bad_line``.

    Spark flags short and long rows alike, so the fields are counted again on
    the flagged lines: a field is a quoted run or a run without commas.
    """
    def reader():
        return spark.read.option("header", True).option("encoding", ENCODING).option("quote", '"').option("escape", '"')

    names = reader().csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names] + [T.StructField(_CORRUPT, T.StringType())])
    df = reader().schema(schema).option("enforceSchema", False).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT).csv(path)
    commas = F.length(F.regexp_replace(F.regexp_replace(F.col(_CORRUPT), r'"(?:[^"]++|"")*+"', ""), r"[^,]++", ""))
    long_row = F.coalesce(commas >= len(names), F.lit(False))
    return df.select(*[F.when(~long_row, column(c)).alias(c) for c in names], F.when(long_row, F.col(_CORRUPT)).alias(R.BAD_LINE))


def write_csv(df: DataFrame, path: str, quote_all: bool = False) -> None:
    """Latin-1 CSV with a header (the counterpart of ``read_csv``)."""
    (df.write.mode("overwrite").option("header", True).option("encoding", ENCODING)
       .option("quoteAll", quote_all).option("escape", '"').csv(path))
