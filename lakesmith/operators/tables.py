"""DataFrame -> DataFrame steps: null handling, naming, projection, distinct,
row counts, whole-column type inference, header cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakesmith.functions.text import na_to_null

# Integer text as a CSV reader types it: optional sign and ASCII digits.
_INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
# Decimal text: digits with a point and an exponent, or an infinity.  A cast
# alone would also take Java's suffixes (``1D``, ``2F``).
_NUMBER_TEXT = r"^\s*[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+|(?i:inf|infinity))(?:[eE][+-]?[0-9]+)?\s*$"
# The spellings a CSV reader with default settings reads as
# booleans (pandas ``read_csv`` true/false values).
TRUE_TOKENS = ["True", "TRUE", "true"]
FALSE_TOKENS = ["False", "FALSE", "false"]


def drop_any_null(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a null in any (or any of ``subset``) column."""
    return df.dropna("any", subset=subset)


def name_columns(df: DataFrame, *names: str) -> DataFrame:
    """Name positional columns.  Works on an empty frame too (no row needed)."""
    return df.toDF(*names)


def keep_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def project_rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Select ``mapping`` keys in order, renamed to its values."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct; nulls compare equal.  Partial aggregate on the map
    side, so only one row per distinct value and partition crosses the shuffle."""
    return df.dropDuplicates()


def observe_count(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by whichever action runs next.

    Costs no second pass: read ``obs.get["rows"]`` after the write/collect.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def counts_by(df: DataFrame, *keys: str, name: str = "rows") -> DataFrame:
    """Row count per key (bigint)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias(name))


def clean_header_names(df: DataFrame, quote: str = '"') -> DataFrame:
    """Remove the quote character from every column name."""
    return df.toDF(*[c.replace(quote, "") for c in df.columns])


def column(name: str):
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]


def nulls_for_tokens(df: DataFrame, columns: list[str] | None = None, tokens: list[str] | None = None) -> DataFrame:
    """Replace missing-value tokens by null in string columns."""
    cols = set(columns if columns is not None else string_columns(df))
    return df.select(*[na_to_null(column(c), tokens).alias(c) if c in cols else column(c) for c in df.columns])


def type_counts(df: DataFrame, columns: list[str] | None = None) -> dict[str, dict[str, int]]:
    """Per string column how many values there are (``n``) and how many read as
    ``bigint``, as integers of any size (``digits``), ``double`` and ``boolean``.

    One aggregate pass over all columns at once; the result is one small row,
    so it is the only thing brought to the driver.
    """
    cols = columns if columns is not None else string_columns(df)
    if not cols:
        return {}
    aggs = []
    for i, c in enumerate(cols):
        v = column(c)
        digits = v.rlike(_INT_TEXT)
        aggs += [
            F.count(v).alias(f"n{i}"),
            F.count(F.when(digits, F.trim(v).try_cast("bigint"))).alias(f"bigint{i}"),
            F.count_if(digits).alias(f"digits{i}"),
            F.count(F.when(v.rlike(_NUMBER_TEXT), F.trim(v).try_cast("double"))).alias(f"double{i}"),
            F.count_if(v.isin(*TRUE_TOKENS, *FALSE_TOKENS)).alias(f"boolean{i}"),
        ]
    row = df.agg(*aggs).first()
    return {c: {k: row[f"{k}{i}"] for k in ("n", "bigint", "digits", "double", "boolean")} for i, c in enumerate(cols)}


def type_of(counts: dict[str, int]) -> str:
    """A type if every value reads as it, else string; an all-null column is ``void``.

    Integer text beyond ``bigint`` keeps its column a string: as doubles,
    different ids would become equal.
    """
    n = counts["n"]
    if n == 0:
        return "void"
    if counts["bigint"] == n:
        return "bigint"
    if counts["double"] == n and counts["digits"] == counts["bigint"]:
        return "double"
    return "boolean" if counts["boolean"] == n else "string"


def wider_type(a: str, b: str) -> str:
    """The type that holds what both hold: void < bigint < double < string; boolean only with itself."""
    if a == b or b == "void":
        return a
    if a == "void":
        return b
    return "double" if {a, b} == {"bigint", "double"} else "string"


def infer_types(df: DataFrame, columns: list[str] | None = None) -> dict[str, str]:
    """Whole-column type of string columns: ``bigint``, ``double``,
    ``boolean`` or ``string``.

    A column gets a type only if every non-null value reads as it; an
    all-null column stays string.
    """
    return {c: "string" if (t := type_of(k)) == "void" else t for c, k in type_counts(df, columns).items()}


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast string columns to the inferred types (values already checked)."""
    def typed(c):
        t = types.get(c)
        if t in (None, "string", "void"):
            return column(c)
        if t == "boolean":
            return F.when(column(c).isin(*TRUE_TOKENS), F.lit(True)).when(
                column(c).isin(*FALSE_TOKENS), F.lit(False)).alias(c)
        return F.trim(column(c)).try_cast(t).alias(c)

    return df.select(*[typed(c) for c in df.columns])


def infer_and_cast(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing-value tokens -> null, then whole-column inference, then cast."""
    cleaned = nulls_for_tokens(df, columns)
    return apply_types(cleaned, infer_types(cleaned, columns))


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to a fresh folder under the shared checkpoint
    directory and read it back: later passes (type inference, the final
    cast) read columnar parquet instead of re-parsing the source, and the
    lineage to the source is cut."""
    from lakesmith.session import fresh_dir

    out = fresh_dir(df.sparkSession, "stage", name)
    df.write.mode("overwrite").parquet(out)
    return df.sparkSession.read.parquet(out)
