"""Hard negatives by Four-Russians scoring.

The inner product of an anchor and a candidate is taken without multiplying:
components go in groups of eight, and for each group the anchor has a table of
its 256 subset sums.  A candidate is stored as bit planes: the bits of one
weight of eight components are one byte, which indexes the table.  Doubling the
running score and adding the looked-up sums, plane by plane from the sign plane
down, gives the full exact score.

Anchors are a stated query set.  They are written to the shared folder and read
back block by block by every task, which holds a bounded number of candidates
and scores a block's anchors against them.  Only the best rows of each anchor
leave a task; a window merges them.  Positives are scored against rows of the
anchor's label, negatives against the others, so no pair is scored twice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakesmith.llm._vectors import finite, limit, matrix, whole
from lakesmith.session import fresh_dir

GROUP = 8
#: candidates that a task holds while it reads all anchors
HELD = 65_536
#: anchors scored at once, and candidates in one step: their scores stay in the cache
ANCHORS, STEP = 128, 2048

_BITS = ((np.arange(256)[:, None] >> np.arange(GROUP)) & 1).astype(np.int64)   # byte -> its eight bits


def bit_planes(x: np.ndarray) -> np.ndarray:
    """Bytes ``[plane, group, row]`` of integer rows: plane 0 has the weight of the sign, the last that of 1."""
    n, dims = x.shape
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    bits = max(high.bit_length(), (-low - 1).bit_length() if low < 0 else 0) + 1   # two's complement
    padded = np.zeros((n, -(-dims // GROUP) * GROUP), np.int64)
    padded[:, :dims] = x
    out = np.empty((bits, padded.shape[1] // GROUP, n), np.uint8)
    for p in range(bits):
        plane = ((padded >> (bits - 1 - p)) & 1).astype(np.uint8)
        out[p] = np.packbits(plane, axis=1, bitorder="little").T
    return out


def subset_sums(anchors: np.ndarray, kind=np.int64) -> np.ndarray:
    """Tables ``[group, byte, anchor]``: the sum of an anchor's components in a group whose bits the byte has."""
    n, dims = anchors.shape
    padded = np.zeros((n, -(-dims // GROUP) * GROUP), np.int64)
    padded[:, :dims] = anchors
    return np.stack([(_BITS @ padded[:, g:g + GROUP].T).astype(kind) for g in range(0, padded.shape[1], GROUP)]) if dims else np.zeros((0, 256, n), kind)


def scores(planes: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Exact inner products ``[row, anchor]`` by shifts, look-ups and additions."""
    bits, groups, n = planes.shape
    out = np.zeros((n, tables.shape[2]), tables.dtype)
    for p in range(bits):
        if p:
            out <<= 1
        for g in range(groups):
            if p:
                out += tables[g].take(planes[p, g], axis=0)
            else:   # the sign's weight is negative
                out -= tables[g].take(planes[p, g], axis=0)
    return out


class Candidates:
    """A task's held rows, in order of label, then id (nulls last): a label is a slice, and position breaks ties."""

    def __init__(self, row: np.ndarray, ids: pa.Array, label: np.ndarray, x: np.ndarray):
        import pyarrow.compute as pc

        by_id = np.asarray(pc.sort_indices(ids, null_placement="at_end"))
        order = by_id[np.argsort(label[by_id], kind="stable")]
        self.row, self.label, self.ids = row[order], label[order], ids.take(pa.array(order))
        self.rank = np.empty(len(order), np.int64)   # place of the id alone, for ties over labels
        self.rank[np.argsort(order)[by_id]] = np.arange(len(order))
        self.planes, self.most = bit_planes(x[order]), int(np.abs(x).max(initial=0))

    def slice(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.label, label)), int(np.searchsorted(self.label, label, "right"))

    def score(self, anchors: np.ndarray, ranges) -> tuple[np.ndarray, np.ndarray]:
        """``(positions, scores [anchor, position])`` of ranges of the held rows."""
        bound = self.most * int(np.abs(anchors).max(initial=0)) * max(anchors.shape[1], 1)
        tables = subset_sums(anchors, np.int32 if bound < 1 << 29 else np.int64)
        at = np.concatenate([np.arange(a, b) for a, b in ranges]) if ranges else np.zeros(0, np.int64)
        parts = [scores(self.planes[:, :, i:min(i + STEP, b)], tables) for a, b in ranges for i in range(a, b, STEP)]
        return at, np.ascontiguousarray(np.concatenate(parts).T) if parts else np.zeros((len(anchors), 0), np.int64)

    def best(self, at: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
        """Of positions ``at`` those of the ``n`` highest scores; ties by smaller id."""
        if len(score) > n:
            least = np.partition(score, len(score) - n)[len(score) - n]
            near = np.flatnonzero(score >= least)
        else:
            near = np.arange(len(score))
        return near[np.lexsort((self.rank[at[near]], -score[near].astype(np.int64)))][:n]


def _groups(batches, dims: int, held: int):
    """A task's rows as ``Candidates`` of at most ``held`` rows."""
    parts, n = [], 0
    for batch in batches:
        for a in range(0, batch.num_rows, held):
            part = batch.slice(a, held)
            if n and n + part.num_rows > held:
                yield _joined(parts, dims)
                parts, n = [], 0
            parts.append(part)
            n += part.num_rows
    if n:
        yield _joined(parts, dims)


def _joined(parts: list, dims: int) -> Candidates:
    t = pa.Table.from_batches(parts).combine_chunks()
    return Candidates(t.column("row").to_numpy(), t.column("id").combine_chunks(), t.column("label").to_numpy(), matrix(t.column("x"), dims))


def _anchors(folder: str, block: int):
    """The written anchors, ``block`` rows at a time."""
    import pyarrow.parquet as pq

    from lakesmith.sources import _fs

    for name in sorted(_fs.list_files(folder)):
        if name.endswith(".parquet"):
            with _fs.open_input(_fs.join(folder, name)) as f:
                yield from pq.ParquetFile(f).iter_batches(batch_size=block)


def _positives(batches, folder: str, dims: int, most: int, held: int, block: int, schema: pa.Schema):
    """Per anchor the best rows of its label among each group of the task's rows."""
    for group in _groups(batches, dims, held):
        for anchors in _anchors(folder, block):
            label, row, x = anchors.column("label").to_numpy(), anchors.column("row").to_numpy(), matrix(anchors.column("x"), dims)
            out = {"anchor": [], "at": [], "score": []}
            for one in np.unique(label):
                a, b = group.slice(one)
                of = np.flatnonzero(label == one)
                at, score = group.score(x[of], [(a, b)] if a < b else [])
                for k, anchor in enumerate(row[of]):
                    near = group.best(at, score[k], most + 1)
                    near = near[group.row[at[near]] != anchor][:most]   # the row itself is none of its positives
                    out["anchor"] += [anchor] * len(near)
                    out["at"] += at[near].tolist()
                    out["score"] += score[k, near].tolist()
            if out["at"]:
                place = pa.array(out["at"], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(out["anchor"], pa.int64()), pa.array(group.row).take(place), group.ids.take(place).cast(schema.field("positive_id").type), pa.array(out["score"], pa.int64())], schema=schema)


def _negatives(batches, folder: str, dims: int, most: int, share: tuple[int, int], held: int, block: int, schema: pa.Schema):
    """Per anchor and positive score the best rows of other labels whose scores lie in its band."""
    low, high = share
    for group in _groups(batches, dims, held):
        for anchors in _anchors(folder, block):
            label, row, x = anchors.column("label").to_numpy(), anchors.column("row").to_numpy(), matrix(anchors.column("x"), dims)
            wanted = anchors.column("positive_scores").to_pylist()
            out = {"anchor": [], "positive": [], "at": [], "score": []}
            for one in np.unique(label):
                a, b = group.slice(one)
                of = np.flatnonzero(label == one)
                at, score = group.score(x[of], [r for r in ((0, a), (b, len(group.row))) if r[0] < r[1]])
                for k, i in enumerate(of):
                    s = score[k]
                    bands = [(-(-low * p // high), p) for p in sorted(wanted[i])]   # low * p <= high * s <= high * p
                    within = np.flatnonzero((s >= min(v for v, _ in bands)) & (s <= bands[-1][1]))
                    for least, p in bands:
                        some = within[(s[within] >= least) & (s[within] <= p)]
                        near = some[group.best(at[some], s[some], most)]
                        out["anchor"] += [row[i]] * len(near)
                        out["positive"] += [p] * len(near)
                        out["at"] += at[near].tolist()
                        out["score"] += s[near].tolist()
            if out["at"]:
                place = pa.array(out["at"], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(out["anchor"], pa.int64()), pa.array(out["positive"], pa.int64()), group.ids.take(place).cast(schema.field("negative_id").type), pa.array(out["score"], pa.int64())], schema=schema)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, *, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
    positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100), held: int = HELD, block: int = ANCHORS,
) -> DataFrame:
    """Per anchor, positive and rank: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Scores are inner products of ``floor(256 * x)``.  An anchor's positives are
    its ``positives`` best other rows of its label; for each, the ``negatives``
    best rows of other labels with ``share[0] * positive_score <= share[1] *
    negative_score <= share[1] * positive_score`` are returned (for a negative
    positive score there is none).  Higher scores come first, ties by smaller
    id, null ids last.  A row with a null label, a null vector or a null,
    non-finite or out-of-range (``_vectors.limit``) component takes no part; a
    null ``is_anchor`` is false.  Vectors of different lengths compare as if
    padded with zeros.  Repeated rows are rows of their own, also as anchors.
    Empty tables, or no anchors, give an empty result.  Other columns are not read.
    """
    spark = vectors.sparkSession
    path = fresh_dir(spark, "hard_negatives")
    ids = vectors.schema[id_col].dataType
    size = F.size(F.col(vector_col))
    dims = max(0, vectors.agg(F.max(size).alias("n")).first()["n"] or 0)
    taken = vectors.where(F.col(label_col).isNotNull() & finite(F.col(vector_col), limit(dims)))
    taken.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(label_col).cast("long").alias("label"),
        whole(F.col(vector_col)).alias("x"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    ).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    anchors = rows.where("is_anchor").select("row", "id", "label", "x")
    anchors.sortWithinPartitions("label").write.parquet(f"{path}/anchors")
    anchors = spark.read.parquet(f"{path}/anchors")
    narrow = rows.select("row", "id", "label", "x")

    found = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("positive", T.LongType()), T.StructField("positive_id", ids), T.StructField("positive_score", T.LongType())])
    found_arrow, folder = to_arrow_schema(found), f"{path}/anchors"
    merged = narrow.mapInArrow(lambda it: _positives(it, folder, dims, positives, held, block, found_arrow), found)
    order = Window.partitionBy("anchor").orderBy(F.col("positive_score").desc(), F.col("positive_id").asc_nulls_last(), "positive")
    merged.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives).write.parquet(f"{path}/positives")
    chosen = spark.read.parquet(f"{path}/positives")

    bands = chosen.groupBy("anchor").agg(F.collect_set("positive_score").alias("positive_scores"))   # a few per anchor
    anchors.join(bands, anchors["row"] == bands["anchor"]).select("row", "label", "x", "positive_scores").sortWithinPartitions("label").write.parquet(f"{path}/bands")
    near = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("positive_score", T.LongType()), T.StructField("negative_id", ids), T.StructField("negative_score", T.LongType())])
    near_arrow, wanted = to_arrow_schema(near), f"{path}/bands"
    merged = narrow.mapInArrow(lambda it: _negatives(it, wanted, dims, negatives, share, held, block, near_arrow), near)
    order = Window.partitionBy("anchor", "positive_score").orderBy(F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last())
    merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).write.parquet(f"{path}/negatives")
    ranked = spark.read.parquet(f"{path}/negatives")

    named = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return chosen.join(ranked, ["anchor", "positive_score"]).join(named, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
