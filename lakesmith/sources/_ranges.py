"""One big CSV file on many tasks (helper of ``plaincsv``).

1. Each byte range yields the function it has on a CSV reader's state
   (``_quotes``).
2. Per file, the functions are composed in order.  That gives the state before
   each range, and whether the text is well formed at all, which decides how it
   is read, as ``_records.decide`` does for a whole text.  The group holds one
   number per range, so the size of the file over that of a range.
3. Files that parse but whose first line is quoted from end to end are read in
   the split mode if a row is longer than the header: the ranges are parsed once
   for the longest row.
4. Each range is parsed from its first record; the last record may run on into
   the next range.  The rows are those of one reader over the whole file.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesmith.session import fresh_dir
from lakesmith.sources import _quotes as Q
from lakesmith.sources import _records as R
from lakesmith.sources._fs import open_input
from lakesmith.sources.zipcsv import TASK_BYTES, spread

PARTS = "path string, part bigint, at bigint, end bigint"
PLAN = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("part", T.LongType()), T.StructField("at", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("state", T.IntegerType()), T.StructField("mode", T.StringType()), T.StructField("check", T.BooleanType()), T.StructField("head_at", T.LongType()),
    T.StructField("width", T.IntegerType()), T.StructField("sig", T.LongType()), T.StructField("split_width", T.IntegerType()), T.StructField("split_sig", T.LongType()),
])
#: a row's number is its range's number and its place there: in order, not consecutive
PLACE_BITS = 40


class Lines:
    """The lines of a stream from byte ``at`` on; ``at`` moves to the start of the next one."""

    def __init__(self, raw, at: int):
        raw.seek(at)
        self.at, self.text = at, R.text_of(raw)

    def __iter__(self) -> Iterator[str]:
        return self

    def __next__(self) -> str:
        line = next(self.text)
        self.at += len(line)   # Latin-1: a character is a byte
        return line


def placed(lines: Lines, mode: str, end: int | None = None) -> Iterator[tuple[int, list[str], bool]]:
    """``(start, fields, whole)`` of the records that start before byte ``end``."""
    reader = csv.reader(lines) if mode == R.STANDARD else None
    while end is None or lines.at < end:
        start = lines.at
        if reader is not None:
            rec, whole = next(reader, None), True
        else:
            line = next(lines, None)
            rec, whole = (None, True) if line is None else next(R.records([line], mode), ([], True))
        if rec is None:
            return
        if rec:
            yield start, rec, whole


def _first_start(raw, at: int, end: int, state: int, mode: str) -> int | None:
    """Where the first record (line, if the text is read by lines) of a range starts; None if none does."""
    if at == 0 or mode == R.STANDARD and state == Q.RECORD:
        return at
    for size in (Q.BLOCK, end - at):
        n = min(size, end - at)
        if mode == R.STANDARD:
            raw.seek(at)
            found, base = Q.first_record(raw.read(n), state), at
        else:
            raw.seek(at - 1)
            data = raw.read(n)   # a line starts behind the byte before it
            found, base = min((i + 1 for i in (data.find(b"\n"), data.find(b"\r")) if i >= 0), default=None), at - 1
        if found is not None:
            return base + found
    return None


def _functions(batches):
    import pyarrow as pa

    for b in batches:
        out = []
        for path, at, end in zip(b.column("path").to_pylist(), b.column("at").to_pylist(), b.column("end").to_pylist(), strict=True):
            with open_input(path) as f:
                out.append(Q.function_of_range(f, at, end))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int32())], names=["path", "part", "at", "end", "function"])


def _head(path: str, mode: str) -> tuple[int, int, int] | None:
    """``(start, width, signature)`` of a file's header; None if it has no record."""
    with open_input(path) as f:
        for start, rec, _ in placed(Lines(f, 0), mode):
            names, sig = R.header(rec, mode)
            return start, len(names), sig
    return None


def _quoted(path: str) -> bool:
    with open_input(path) as f:
        for line in Lines(f, 0):
            if line.strip("\r\n"):
                return R.quoted_line(line)
    return False


def _plan(forced: str | None, schema):
    def plan(table):
        import pyarrow as pa

        table = table.sort_by("part")
        path, n = table.column("path")[0].as_py(), table.num_rows
        states, mode, check = [Q.RECORD] * (n + 1), forced, False
        if forced is None:
            states, quoted = Q.starts(table.column("function").to_pylist()), _quoted(path)
            whole = states[-1] not in (Q.QUOTED, Q.BAD)
            mode, check = (R.STANDARD, quoted) if whole else (R.SPLIT if quoted else R.LINES, False)
        head = _head(path, mode)
        if head is None:
            return pa.table({f.name: pa.array([], f.type) for f in schema}, schema=schema)
        split = _head(path, R.SPLIT) if check else (None, None, None)
        cols = {c: table.column(c) for c in ("path", "part", "at", "end")}
        same = {"mode": mode, "check": check, "head_at": head[0], "width": head[1], "sig": head[2], "split_width": split[1], "split_sig": split[2]}
        cols |= {"state": pa.array(states[:n], pa.int32())} | {k: pa.array([v] * n, schema.field(k).type) for k, v in same.items()}
        return pa.table([cols[f.name].cast(f.type) for f in schema], schema=schema)

    return plan


def _range_rows(r: dict):
    with open_input(r["path"]) as f:
        start = _first_start(f, r["at"], r["end"], r["state"], r["mode"])
        if start is None or start >= r["end"]:
            return
        for n, (at, rec, whole) in enumerate(placed(Lines(f, start), r["mode"], r["end"])):
            yield -1 if at == r["head_at"] else (r["part"] << PLACE_BITS) + n, rec, not whole or len(rec) > r["width"]


def _too_long(batches):
    import pyarrow as pa

    for b in batches:
        found = [r["path"] for r in b.to_pylist() if any(odd for _, _, odd in _range_rows(r))]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["path"])


def _extract(batches):
    for b in batches:
        for r in b.to_pylist():
            yield from R.batched(_range_rows(r), r["path"], "", r["mode"], r["sig"])


def extract_ranges(files: DataFrame, range_bytes: int, forced: str | None = None) -> DataFrame:
    """Raw records (``_records.RAW_SCHEMA``) of the files ``(path, length)``, cut into ranges of ``range_bytes``.

    A task takes as many ranges as fill it (``zipcsv.TASK_BYTES``), one after another.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = files.sparkSession
    out = fresh_dir(spark, "stage", "csvranges")
    files.select("path", F.explode(F.expr(f"sequence(0L, (length - 1) div {range_bytes})")).alias("part"), "length").select(
        "path", "part", (F.col("part") * range_bytes).alias("at"), F.least("length", (F.col("part") + 1) * range_bytes).alias("end"),
    ).write.parquet(f"{out}/parts")
    parts = spark.read.parquet(f"{out}/parts")

    def dealt(df: DataFrame) -> DataFrame:
        """Ranges dealt to tasks, whatever file they are of (written before, so counting the small rows is cheap)."""
        n = df.agg(F.count(F.lit(1)).alias("ranges"), F.sum(F.col("end") - F.col("at")).alias("bytes")).first()
        return spread(df, n["ranges"], (n["bytes"] or 0) / TASK_BYTES)

    numbered = dealt(parts).mapInArrow(_functions, PARTS + ", function int") if forced is None else parts
    schema = to_arrow_schema(PLAN)
    numbered.groupBy("path").applyInArrow(_plan(forced, schema), PLAN).write.parquet(f"{out}/plan")
    plan = spark.read.parquet(f"{out}/plan")
    dealt(plan.where("check")).mapInArrow(_too_long, "path string").distinct().write.parquet(f"{out}/ragged")
    ragged = spark.read.schema("path string").parquet(f"{out}/ragged").withColumn("ragged", F.lit(True))
    final = plan.join(ragged, "path", "left").withColumns({
        "mode": F.when(F.col("ragged"), R.SPLIT).otherwise(F.col("mode")),
        "width": F.when(F.col("ragged"), F.col("split_width")).otherwise(F.col("width")),
        "sig": F.when(F.col("ragged"), F.col("split_sig")).otherwise(F.col("sig")),
    }).drop("ragged")
    return dealt(final).mapInArrow(_extract, R.RAW_SCHEMA)
