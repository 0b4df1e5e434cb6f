"""Path and URL columns: base name, parent folders, extension and suffix removal,
lake-path mapping, URL building.  Pure Column -> Column, all built-ins."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakesmith.functions._util import as_col


def base_name(path) -> Column:
    """Text after the last ``/`` (the whole string when there is none)."""
    return F.element_at(F.split(as_col(path), "/"), -1)


def parent(path, levels: int = 1) -> Column:
    """Drop the last ``levels`` ``/``-separated parts; empty string when none remain."""
    parts = F.split(as_col(path), "/")
    keep = F.greatest(F.size(parts) - F.lit(levels), F.lit(0))
    return F.array_join(F.slice(parts, F.lit(1), keep), "/")


def strip_last_extension(name) -> Column:
    """``a.b.c`` -> ``a.b``; a name without a dot is returned as is."""
    return F.regexp_replace(as_col(name), r"\.[^./]*$", "")


def strip_suffix(name, suffix: str) -> Column:
    """Remove ``suffix`` once from the end, as a suffix (not a character set)."""
    return F.regexp_replace(as_col(name), re.escape(suffix) + "$", "")


def has_suffix(col, suffix: str) -> Column:
    """``str.endswith`` on a column; ``.xml.gz.md5`` does not end in ``.xml.gz``."""
    return F.endswith(as_col(col), F.lit(suffix))


def lake_path(input_path, lake_prefix: str, suffix: str | None = None, ext: str = ".parquet") -> Column:
    """Map an input file path to its parquet path in the lake.

    ``suffix`` given: remove that exact suffix from the base name; otherwise
    remove the last extension.
    """
    name = base_name(input_path)
    stem = strip_suffix(name, suffix) if suffix else strip_last_extension(name)
    return F.concat(F.lit(lake_prefix.rstrip("/") + "/"), stem, F.lit(ext))


def join_url(*parts) -> Column:
    """Join parts with ``/`` (strings are literals, Columns are used as is)."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.concat_ws("/", *cols)


def concat_url(base: str, tail) -> Column:
    """``base + tail`` exactly as given (no separator added)."""
    return F.concat(F.lit(base), as_col(tail))
