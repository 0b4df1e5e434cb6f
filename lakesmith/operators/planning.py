"""Work-list operators: what is already done (anti-join), the types x years grid,
and the offset/limit batch slice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def not_yet_done(work: DataFrame, done: DataFrame, key, null_safe: bool = False) -> DataFrame:
    """Rows of ``work`` whose ``key`` is not in ``done`` (presence check).

    ``key``: a column name present in both frames, or a list of names.  Null
    keys in ``work`` are kept (nothing can be present for them); with
    ``null_safe`` a null key is a key like any other.  No size is checked
    beforehand: that would read both sides twice, and adaptive execution picks
    the join from the sizes it meets.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not null_safe:
        return work.join(done.select(*keys).dropna(), keys, "left_anti")
    held = done.select(*[F.col(f"`{k}`").alias(f"_done_{i}") for i, k in enumerate(keys)])
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_done_{i}")) for i, k in enumerate(keys)]
    return work.join(held, reduce(lambda x, y: x & y, same), "left_anti")


def plan_grid(spark: SparkSession, kinds: list[str], first: int | None = None, last_exclusive: int | None = None,
              kind_col: str = "data_type", year_col: str = "data_year", years: DataFrame | None = None) -> DataFrame:
    """Every kind for every year, kinds outer.

    Years are ``[first, last_exclusive)`` or the ``year_col`` column of
    ``years``.  The kinds are a literal array exploded per year row: a
    generator, not a join, so the grid is built where the years are.
    """
    if years is None:
        years = spark.range(first, last_exclusive).select(F.col("id").cast("int").alias(year_col))
    else:
        years = years.select(F.col(year_col).cast("int").alias(year_col))
    kinds_arr = F.array(*[F.struct(F.lit(i).alias("k"), F.lit(k).alias("v")) for i, k in enumerate(kinds)])
    return (
        years.select(F.inline(kinds_arr), year_col)
        .select(F.col("v").alias(kind_col), year_col, F.col("k").alias("_kind_pos"))
    )


def with_position(df: DataFrame, order: list) -> DataFrame:
    """Add ``_seq``, the 0-based position of each row in ``order``.

    Distributed, no single-partition window over the data:

    1. range-partition on the order and sort inside each partition, tag each
       row with its partition and ``monotonically_increasing_id`` (partition
       number in the high bits, row number in the partition in the low bits),
       and checkpoint that once to the shared checkpoint folder, so every
       later read sees the same partitions and the lineage is cut;
    2. count rows per partition: one small row per partition (bounded by the
       partition count, not by the data) comes to the driver and becomes a
       running offset;
    3. position = partition offset + row number in the partition, with the
       offsets broadcast.
    """
    from lakesmith.session import scratch_dir

    spark = df.sparkSession
    scratch_dir(spark)  # make sure a checkpoint folder is set
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    tagged = (
        df.repartitionByRange(n, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_local", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33))
        .checkpoint(eager=True)
    )
    counts = sorted((r["_part"], r["_n"]) for r in
                    tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).collect())
    offsets, running = [], 0
    for part, cnt in counts:
        offsets.append((part, running))
        running += cnt
    off = spark.createDataFrame(offsets or [(0, 0)], "_part int, _offset bigint")
    return (
        tagged.join(F.broadcast(off), "_part")
        .withColumn("_seq", F.col("_offset") + F.col("_local"))
        .drop("_part", "_offset", "_local")
    )


#: places of the leading order column at which rows are counted to find a slice
EDGES = 64


def _around(counts: list[tuple], start: int, end: int | None) -> tuple:
    """``(low, base, high)`` of the edges about positions ``start .. end``: ``base`` rows lie below ``low``
    (None: the beginning), and no wanted row at or above ``high`` (None: the end)."""
    low, base = max(((e, n) for e, n in counts if n <= start), key=lambda x: x[1], default=(None, 0))
    return low, base, None if end is None else min((e for e, n in counts if n >= end), default=None)


def batch_slice(df: DataFrame, order: list, start: int, count: int | None = None) -> DataFrame:
    """Rows ``start .. start+count-1`` of ``df`` in ``order`` (all from ``start`` if no count).

    The rows are staged once.  If the order begins with a numeric column,
    ascending, a mergeable sketch of it gives edges, and the rows below each
    edge are counted (one row to the driver).  That locates the slice: only the
    rows between the edges about it are sorted, and of an open slice only those
    about its start; the rest is filtered, not shuffled.  Otherwise all rows get
    positions.
    """
    from lakesmith.operators.tables import stage

    end, key = None if count is None else start + count, order[0]
    if not isinstance(key, str) or not isinstance(df.schema[key].dataType, T.NumericType):
        return _within(stage(df, "slice"), order, start, end)
    c, seen = F.col(f"`{key}`"), Observation()
    sketch = F.percentile_approx(c, [i / EDGES for i in range(EDGES + 1)], 10_000)
    staged = stage(df.observe(seen, sketch.alias("e")), "slice")   # the sketch is made while the rows are written
    told = seen.get["e"]
    edges = sorted({e for e in told or [] if e == e})
    if not edges:
        return _within(staged, order, start, end)
    below = staged.agg(*[F.count_if(c.isNull() | (c < F.lit(e))).alias(f"n{i}") for i, e in enumerate(edges)]).first()   # nulls come first
    counts = list(zip(edges, below, strict=True))
    low, base, high = _around(counts, start, end if end is not None else start + 1)
    after = F.lit(True) if low is None else c >= F.lit(low)
    near = after if high is None else after & F.coalesce(c < F.lit(high), F.lit(True))
    here = _within(staged.where(near), order, start - base, None if end is None else end - base)
    return here if end is not None or high is None else here.unionAll(staged.where(c >= F.lit(high)))


def _within(df: DataFrame, order: list, start: int, end: int | None) -> DataFrame:
    at = F.col("_seq")
    within = at >= start if end is None else (at >= start) & (at < end)
    return with_position(df, order).filter(within).drop("_seq")
