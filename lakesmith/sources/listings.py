"""Work-list sources: links on HTML listing pages, inventories of present files,
numbered file series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesmith.functions.paths import base_name
from lakesmith.functions.text import clean_link, raw_links


def page_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``(page_id, pos, link)``: every link on every page in listing order.

    ``pos`` is the 0-based position on the page; repeated links are kept.
    One generator per row, no shuffle; each link is cleaned after the
    explode with plain string expressions (whole-stage codegen).
    """
    exploded = pages.select(id_col, F.posexplode(raw_links(F.col(html_col))).alias("pos", "_raw"))
    return exploded.select(id_col, "pos", clean_link(F.col("_raw")).alias("link"))


def file_inventory(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``(path, name, length, modificationTime)`` of files under ``path``.

    The ``binaryFile`` source lists files; selecting no ``content`` means no
    file is opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", base_name(F.col("path")).alias("name"), "length", "modificationTime")


def numbered_series(spark: SparkSession, base_url: str, pattern: str, first: int, last_inclusive: int) -> DataFrame:
    """``(id, url)`` for ``id`` in ``[first, last_inclusive]``; ``pattern`` is a
    ``printf`` format for one integer, e.g. ``'pubmed23n%04d.xml.gz'``."""
    return spark.range(first, last_inclusive + 1).select(
        "id", F.concat(F.lit(base_url), F.format_string(pattern, F.col("id"))).alias("url")
    )


def numbered_names(ids: DataFrame, base_url: str, pattern: str, id_col: str = "id") -> DataFrame:
    """``(id, url)`` for the ids of a table (the same naming as ``numbered_series``)."""
    return ids.select(id_col, F.concat(F.lit(base_url), F.format_string(pattern, F.col(id_col))).alias("url"))
