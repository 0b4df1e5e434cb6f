"""Identifier columns: pick an id out of an XML id list, cast id text to integers,
drop a sentinel while keeping nulls.  All built-in expressions (codegen), no UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakesmith.functions._util import as_col

# Fixed values that must equal the source data's conventions.
# Placeholder the upstream id service writes when a journal cannot be resolved.
SENTINEL_PMID = "NOT_FOUND;INVALID_JOURNAL"
# IdType attribute values of the two identifiers kept from an id list.
PUBMED_ID_TYPE = "pubmed"
DOI_ID_TYPE = "doi"

# Characters Python's int() strips around a number (str.isspace() set), as one
# regex class that both Java regex and RE2 (the DuckDB oracle) understand.
PY_SPACE = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
# Python int() literal: optional sign, ASCII digits, single underscores between digits.
PY_INT_PATTERN = rf"^{PY_SPACE}*([+-]?[0-9]+(?:_[0-9]+)*){PY_SPACE}*$"


def python_int(text) -> Column:
    """String -> bigint with Python ``int()`` acceptance rules; null when it fails.

    Plain ``cast`` raises under ANSI mode and ``try_cast`` alone rejects
    ``1_000``; the regex guard gives the Python rule, ``try_cast`` the overflow
    rule (values beyond 2^63-1 become null instead of wrapping).
    """
    digits = F.regexp_extract(as_col(text), PY_INT_PATTERN, 1)
    return F.when(digits != "", F.regexp_replace(digits, "_", "").try_cast("bigint"))


def first_id_of_type(id_list, id_type: str, type_field: str = "_IdType", value_field: str = "_VALUE") -> Column:
    """Text of the first element of ``id_list`` whose type attribute equals ``id_type``.

    Null when the list is null/empty or no element matches (the element-lookup
    failure case), and null when the matching element is empty.
    """
    ids = as_col(id_list)
    # position of the first matching type (0 when absent), then that value;
    # plain array expressions, so the step stays inside whole-stage codegen
    first = F.array_position(ids[type_field], F.lit(id_type))
    return F.try_element_at(ids[value_field], F.nullif(first, F.lit(0)).cast("int"))


def not_equal_keep_null(col, value) -> Column:
    """``col != value`` that keeps null rows (pandas ``!=`` semantics).

    SQL ``!=`` is null for a null operand and ``filter`` drops it; the
    null-safe form keeps it.
    """
    return ~as_col(col).eqNullSafe(F.lit(value))


def in_domain_or_fail(col, allowed: list[str], what: str = "value") -> Column:
    """Returns ``col`` unchanged, failing the job on any value outside ``allowed``.

    The error names the valid options, as a domain check should.
    """
    c = as_col(col)
    msg = F.concat(F.lit(f"unknown {what} "), F.coalesce(c.cast("string"), F.lit("NULL")), F.lit(f"; expected one of {', '.join(allowed)}"))
    return F.when(c.isin(*allowed), c).otherwise(F.raise_error(msg))


def in_domain(col, allowed: list[str]) -> Column:
    """Boolean predicate for the reject-rows variant of the domain check."""
    return as_col(col).isin(*allowed)
