"""Zipped CSV ingest: fetch plan -> landed archives -> lake of cleaned text with a schema.

Steps: the types x years plan with a domain check, landed archives matched
to it, archives already in the lake skipped (anti-join), the zip reader
(fallback per badly quoted file), missing tokens -> null, one whole-column
type count, and one write partitioned by source archive.

The lake holds the cleaned text of every value; ``_schema`` beside it says
which columns there are and how their text reads.  Each run adds its columns
and widens types (bigint -> double -> string), so a column that was numeric in
one year and text in the next reads as the text that was loaded, nothing is
rewritten, and a run never loses another run's columns, also of a run at the
same time.  Read it with ``read_csv_lake``.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesmith.functions.ids import in_domain_or_fail
from lakesmith.functions.paths import base_name, join_url, strip_last_extension
from lakesmith.operators.planning import plan_grid
from lakesmith.operators.tables import apply_types, column, infer_types, nulls_for_tokens, stage, type_counts, type_of, wider_type
from lakesmith.sources import _fs
from lakesmith.sources._records import ARCHIVE, BAD_LINE, MEMBER, MODE, ROW_NO, SOURCE
from lakesmith.sources.zipcsv import read_zip_csv

# The four data types the source publishes, and its URL layout.
DATA_TYPES = ["projects", "abstracts", "publications", "linktables"]
FIRST_YEAR, LAST_YEAR_EXCLUSIVE = 1985, 2022
URL_BASE = "https://reporter.nih.gov/exporter"

ENGINE_COLUMNS = (ARCHIVE, MEMBER, ROW_NO, BAD_LINE, MODE)
SCHEMA = "_schema"


def fetch_plan(spark: SparkSession, data_types: list[str] | None = None,
               first: int = FIRST_YEAR, last_exclusive: int = LAST_YEAR_EXCLUSIVE,
               landing_root: str = "data", years: DataFrame | None = None) -> DataFrame:
    """``(data_type, data_year, url, landing_path)`` for every type x year.

    Years are ``[first, last_exclusive)`` or the ``data_year`` column of
    ``years``.  An unknown data type fails the job with the valid options in
    the message.
    """
    grid = plan_grid(spark, data_types or DATA_TYPES, first, last_exclusive, years=years)
    dt = in_domain_or_fail(F.col("data_type"), DATA_TYPES, "data_type")
    year = F.col("data_year").cast("string")
    return grid.select(
        dt.alias("data_type"),
        "data_year",
        join_url(URL_BASE, dt, "download", year).alias("url"),
        join_url(landing_root, dt, F.concat(year, F.lit(".zip"))).alias("landing_path"),
        "_kind_pos",
    ).orderBy("_kind_pos", "data_year").drop("_kind_pos")


def cleaned_rows(spark: SparkSession, landing_path: str | None = None, glob: str = "*.zip",
                 archives: DataFrame | None = None) -> DataFrame:
    """All archives under ``landing_path`` (or listed in ``archives``) as one
    string table, missing tokens null, with ``source_file`` (archive base name
    without ``.zip``) and the engine's columns."""
    raw = read_zip_csv(spark, landing_path, glob, archives=archives)
    cleaned = nulls_for_tokens(raw, [c for c in raw.columns if c not in ENGINE_COLUMNS])
    return cleaned.withColumn(SOURCE, strip_last_extension(base_name(F.col(ARCHIVE))))


def typed_rows(spark: SparkSession, landing_path: str | None = None, glob: str = "*.zip",
               archives: DataFrame | None = None) -> DataFrame:
    """``cleaned_rows`` with each column in its inferred type.

    The reader stages its raw rows in the shared folder, so the inference
    pass and the final cast read staged parquet, not the archives.
    """
    rows = cleaned_rows(spark, landing_path, glob, archives)
    return apply_types(rows, infer_types(rows, _value_columns(rows)))


def _value_columns(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c not in ENGINE_COLUMNS and c != SOURCE]


# ---------------------------------------------------------------- the lake's schema

def lake_schema(lake_path: str) -> dict[str, str]:
    """Columns of the lake and their types so far; empty before the first load."""
    return _schema_log(lake_path)[0]


def _schema_log(lake_path: str) -> tuple[dict[str, str], list[str]]:
    """The lake's schema and the files that it was read from.

    Every load adds a file with the schema it saw, widened by its own columns,
    and the names of the files it saw.  Widening only adds columns and goes up a
    chain of types, so it does not matter in which order loads merge: files that
    no other one covers (loads that ran at once) are merged when read, and none
    is lost.
    """
    folder = _fs.join(lake_path, SCHEMA)
    names = sorted(n for n in _fs.list_files(folder) if n.endswith(".json") and not n.startswith("."))
    covered: set[str] = set()
    found = []
    for name in reversed(names):   # the newest first: it covers nearly all others
        if name not in covered:
            with _fs.open_input(_fs.join(folder, name)) as f:
                told = json.loads(f.read().decode())
            if isinstance(told, dict):
                covered |= set(told["covers"])
                found.append(told["columns"])
            else:   # as earlier versions wrote it: each file holds the whole schema
                covered |= {n for n in names if n < name}
                found.append(told)
    schema: dict[str, str] = {}
    for columns in reversed(found):
        schema = widened(schema, dict(columns))
    return schema, names


def widened(old: dict[str, str], new: dict[str, str]) -> dict[str, str]:
    """``old`` with the columns of ``new`` added and types widened; names that
    differ only in case are one column, by its first spelling."""
    out = dict(old)
    spelling = {c.casefold(): c for c in out}
    for c, t in new.items():
        known = spelling.setdefault(c.casefold(), c)
        out[known] = wider_type(out[known], t) if known in out else t
    return out


def _save_schema(lake_path: str, schema: dict[str, str], covers: list[str]) -> None:
    """Add a file to the schema log; the number only keeps the order, the name is this load's alone."""
    told = {"columns": list(schema.items()), "covers": covers}
    _fs.write_new(_fs.join(lake_path, SCHEMA, f"{len(covers):08d}-{uuid.uuid4().hex}.json"), json.dumps(told).encode())


def read_csv_lake(spark: SparkSession, lake_path: str) -> DataFrame:
    """The lake as one typed table: every column any run has loaded, ``source_file``
    as string, and the engine's ``_member``, ``_row_no``, ``_bad_line`` and ``_mode``."""
    types = lake_schema(lake_path)
    strings = [T.StructField(c, T.StringType()) for c in types]
    engine = [T.StructField(MEMBER, T.StringType()), T.StructField(ROW_NO, T.LongType()), T.StructField(BAD_LINE, T.StringType()),
              T.StructField(MODE, T.StringType()), T.StructField(SOURCE, T.StringType())]
    return apply_types(spark.read.schema(T.StructType(strings + engine)).parquet(lake_path), types)


# ---------------------------------------------------------------- planned ingest

def landed_archives(spark: SparkSession, plan: DataFrame, landing_dir: str, data_type: str | None = None) -> DataFrame:
    """Plan rows joined to the archives landed in ``landing_dir``:
    ``(data_type, data_year, path, source_file)``; ``path`` is null for a
    planned archive that has not landed.

    With ``data_type``, ``landing_dir`` holds that type's archives; without,
    each type has its folder ``landing_dir/<type>/``.  An archive belongs to
    the year its name starts with; names without a year are not planned.
    """
    from lakesmith.sources.listings import file_inventory

    inv = file_inventory(spark, landing_dir, "*.zip")
    kind = F.lit(data_type) if data_type else F.element_at(F.split(F.col("path"), "/"), -2)
    landed = inv.select(
        "path", kind.alias("data_type"),
        strip_last_extension(F.col("name")).alias("source_file"),
        F.regexp_extract(F.col("name"), r"^([0-9]{4})", 1).try_cast("int").alias("data_year"),
    )
    wanted = plan if data_type is None else plan.filter(F.col("data_type") == data_type)
    return wanted.select("data_type", "data_year").join(landed, ["data_type", "data_year"], "left")


def missing_archives(spark: SparkSession, plan: DataFrame, landing_dir: str, data_type: str | None = None) -> DataFrame:
    """``(data_type, data_year)`` of planned archives that have not landed."""
    return landed_archives(spark, plan, landing_dir, data_type).filter(F.col("path").isNull()).select("data_type", "data_year")


def _load(spark: SparkSession, todo: DataFrame, lake_path: str, replace: bool) -> None:
    """Write the listed archives and then the schema that covers them."""
    from lakesmith.operators.sinks import publish

    rows = cleaned_rows(spark, archives=todo)
    values = _value_columns(rows)
    counts = type_counts(rows, values)
    before, seen = _schema_log(lake_path)
    schema = widened(before, {c: type_of(counts[c]) for c in values})
    spelling = {c.casefold(): c for c in schema}
    out = rows.drop(ARCHIVE).select(*[column(c).alias(spelling.get(c.casefold(), c) if c in counts else c) for c in rows.columns if c != ARCHIVE])
    _save_schema(lake_path, schema, seen)   # before the rows: it covers the old lake as well as the new
    publish(out, lake_path, [SOURCE], replace=replace, checked=True)


def ingest_planned(spark: SparkSession, plan: DataFrame, landing_dir: str, lake_path: str,
                   data_type: str, replace: bool = False, remove_loaded: bool = False) -> DataFrame:
    """Load the planned, landed archives of one type that the lake does not hold yet.

    The presence check comes first (nothing already loaded is read again),
    then one read of the remaining archives and one partitioned write.
    ``remove_loaded``: the loaded archives are deleted once the lake write is
    committed.  Returns the lake read back.  Planned archives that have not
    landed are skipped; ``missing_archives`` lists them.
    """
    from lakesmith.operators.planning import not_yet_done
    from lakesmith.operators.sinks import _exists, present_partitions, remove_files

    todo = landed_archives(spark, plan, landing_dir, data_type).filter(F.col("path").isNotNull())
    if not replace and _exists(spark, lake_path):
        todo = not_yet_done(todo, present_partitions(spark, lake_path, [SOURCE]), SOURCE)
    work = stage(todo.select("path").distinct(), "zipwork")   # the work list, fixed before any file is removed
    if not work.isEmpty():
        _load(spark, work, lake_path, replace)
        if remove_loaded:
            remove_files(work)
    return read_csv_lake(spark, lake_path)


def ingest_plan(spark: SparkSession, plan: DataFrame, landing_root: str, lake_root: str,
                data_types: list[str] | None = None, replace: bool = False) -> dict[str, DataFrame]:
    """The whole plan in one call: each type's archives (``landing_root/<type>/``)
    into its lake (``lake_root/<type>``).  Returns the lakes by type."""
    return {
        t: ingest_planned(spark, plan, _fs.join(landing_root, t), _fs.join(lake_root, t), t, replace=replace)
        for t in data_types or DATA_TYPES
    }


def ingest_zip_csv(spark: SparkSession, landing_path: str, lake_path: str, replace: bool = False) -> DataFrame:
    """Every archive under ``landing_path`` that the lake lacks (all with ``replace``), whatever its name."""
    from lakesmith.operators.planning import not_yet_done
    from lakesmith.operators.sinks import _exists, present_partitions
    from lakesmith.sources.listings import file_inventory

    todo = file_inventory(spark, landing_path, "*.zip").select("path", strip_last_extension(F.col("name")).alias(SOURCE))
    if not replace and _exists(spark, lake_path):
        todo = not_yet_done(todo, present_partitions(spark, lake_path, [SOURCE]), SOURCE)
    work = stage(todo.select("path"), "zipwork")
    if not work.isEmpty():
        _load(spark, work, lake_path, replace)
    return read_csv_lake(spark, lake_path)
