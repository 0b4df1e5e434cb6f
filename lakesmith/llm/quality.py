"""Quality by co-training of two views: the text's content and the page's metadata.

A text classifier (words, and shapes of words with their shares) and a metadata
classifier (source, language, length) start from the labelled rows.  In every
round each view labels all the unlabelled documents that it is sure of, and the
other view learns from them: tasks count its features (in a fixed number of
buckets) in those documents by label, and the log ratio of the counts joins the
view's model as one more column, weighted on the labelled rows.  So a feature
that no labelled row has counts too.  In the end both views are calibrated on
out-of-fold margins of the labelled rows and combined.

A text is scanned once: the places of its features, a fraction of its size, are
written to the shared folder, and the rounds and the scoring read those.

Models are fitted on at most ``LABELLED`` labelled rows; all unlabelled
documents take part in every round, and all documents are scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesmith.llm._linear import Logistic, best_threshold, sigmoid
from lakesmith.llm._words import PUNCT, SPACE, U, mix, pieces, scan
from lakesmith.llm.toxicity import FOLDS, choose_words, fold_of, labelled_sample, word_index
from lakesmith.session import fresh_dir

LABELLED = 20_000
FEATURES = 2048
ROUNDS = 4
#: how sure a view must be of a row that it labels
SURE = 0.95
#: buckets that the features of the text and of the metadata are counted in
BUCKETS = (1 << 13, 1 << 12)
PIECE_BYTES = 4_000_000
#: the written places (in the vocabularies and in the buckets, per view), and how many rows of them are taken at once
PLACES = {"words": np.uint16, "tokens": np.int32, "text_buckets": np.uint16, "meta_buckets": np.uint16}
ROWS = 1000
#: a feature says that a shape makes up more than this share of the words
SHARES = (0.0, 1 / 64, 1 / 16, 1 / 4)

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123], _SHAPE[65:91], _SHAPE[48:58], _SHAPE[128:] = 97, 65, 48, 97


def text_features(texts: pa.Array):
    """``(a, b, row, feature)``: the words, and which word shapes (case, digits, punctuation) exceed which shares of them."""
    for a, b, off, raw in pieces(texts, PIECE_BYTES):
        flat = _SHAPE[raw]
        keep = np.ones(len(flat), bool)
        keep[1:] = flat[1:] != flat[:-1]
        keep[off[:-1][off[:-1] < len(flat)]] = True
        short = np.concatenate([[0], np.cumsum(keep)])[off]
        w = scan(short, flat[keep], SPACE, False)
        row = np.repeat(np.arange(b - a), np.diff(w.first))
        order = np.lexsort((w.hash, row))
        row, shape = row[order], w.hash[order]
        start = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (shape[1:] != shape[:-1])])) if len(row) else np.zeros(0, np.int64)
        share = np.diff(np.append(start, len(row))) / np.maximum(np.diff(w.first), 1)[row[start]]
        rows, feats = [], []
        for i, least in enumerate(SHARES):
            over = share > least
            rows.append(row[start][over])
            feats.append(mix(shape[start][over] + U(i)))
        w = scan(off, raw, PUNCT, True)
        rows.append(np.repeat(np.arange(b - a), np.diff(w.first)))
        feats.append(mix(w.hash + U(len(SHARES))))
        r, f = np.concatenate(rows), np.concatenate(feats)
        order = np.lexsort((f, r))
        r, f = r[order], f[order]
        new = np.ones(len(r), bool)
        new[1:] = (r[1:] != r[:-1]) | (f[1:] != f[:-1])
        r, f = r[new], f[new]
        yield a, b, r, f


def meta_tokens(meta: dict[str, Column]) -> Column:
    """Hashes of ``name=value`` for each metadata column; numbers count by their binary logarithm."""
    return F.array(*[F.xxhash64(F.lit(n), c) for n, c in meta.items()])


def bucketed(row: np.ndarray, feature: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of each row's features."""
    place = np.unique(row.astype(np.int64) * buckets + ((feature >> U(40)) % U(buckets)).astype(np.int64))
    return place // buckets, place % buckets


def log_ratio(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Per bucket, from its documents ``counts`` among the ``n`` of labels 0 and 1; 0 if a label has none."""
    if not n.all():
        return np.zeros(counts.shape[1])
    low, high = (np.log((counts[y] + 0.5) / (n[y] + 1)) for y in (0, 1))
    return high - low


def mean_ratio(ratio: np.ndarray, row: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
    """Each row's mean log ratio, as a column."""
    return (np.bincount(row, ratio[bucket], n) / np.maximum(np.bincount(row, minlength=n), 1))[:, None]


@dataclass
class Pair:
    """One model per view, and the log ratios that the other view's labels have given."""

    models: list
    ratios: list

    def margins(self, features: list, buckets: list, n: int) -> list[np.ndarray]:
        """Per view, from the ``(row, place)`` that ``placed`` gives."""
        return [self.models[v].margin(*features[v], n, mean_ratio(self.ratios[v], *buckets[v], n)) for v in range(2)]


@dataclass
class Views:
    pair: Pair
    scale: list                 # (slope, offset) per view: margin -> calibrated log odds
    prior: float
    cut: float


def _calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt scaling by Newton steps with smoothed targets; margins that hardly differ, as of a view that the labels tell nothing about, keep the slope 1."""
    hi, lo = (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2)
    t, x = np.where(y > 0, hi, lo), np.column_stack([margin, np.ones(len(y))])
    theta, ridge = np.array([1.0, 0.0]), np.array([1.0, 1e-3])
    for _ in range(25):
        p = sigmoid(x @ theta)
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        theta -= np.linalg.solve(h, x.T @ (p - t) + ridge * (theta - [1, 0]))
    return float(theta[0]), float(theta[1])


def features_of(batch: pa.RecordBatch):
    """``(a, b, features, buckets)`` of rows ``a:b``, both per view, from the columns ``text`` and ``meta``."""
    for a, b, row, word in text_features(batch.column("text")):
        lists = batch.column("meta").slice(a, b - a)
        tokens = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(U)
        owner = np.repeat(np.arange(b - a), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        found = [(row, word), (owner, tokens)]
        yield a, b, found, [bucketed(*found[v], BUCKETS[v]) for v in range(2)]


def _packed(row: np.ndarray, place: np.ndarray, n: int, kind) -> pa.Array:
    """Each row's places as bytes."""
    ends = np.searchsorted(row, np.arange(n + 1)) * np.dtype(kind).itemsize
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(place.astype(kind))])


def _unpacked(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """``(row, place)`` of what ``_packed`` wrote."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False) // np.dtype(kind).itemsize
    return np.repeat(np.arange(len(column)), sizes), np.frombuffer(b"".join(column.to_pylist()), kind).astype(np.int64)


def with_places(rows: DataFrame, vocabulary: list) -> DataFrame:
    """``rows`` with the places of their features instead of ``text`` and ``meta``."""
    from pyspark.sql.types import BinaryType, StructField, StructType

    keep = [c for c in rows.columns if c not in ("text", "meta")]
    sent = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def emit(batches):
        for batch in batches:
            for a, b, found, buckets in features_of(batch):
                n = b - a
                places = [*(word_index(sent.value[v], *found[v]) for v in range(2)), *buckets]
                packed = [_packed(*x, n, kind) for x, kind in zip(places, PLACES.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, n) for c in keep), *packed], names=[*keep, *PLACES])

    schema = StructType([*(rows.schema[c] for c in keep), *(StructField(c, BinaryType()) for c in PLACES)])
    return rows.select(*keep, "text", "meta").mapInArrow(emit, schema)


def placed(batches):
    """``(rows, features, buckets)`` of a few rows at a time, both per view, from the columns of ``with_places``."""
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            rows = batch.slice(k, ROWS)
            found = [_unpacked(rows.column(c), kind) for c, kind in PLACES.items()]
            yield rows, found[:2], found[2:]


def count_sure(free: DataFrame, vocabulary: list, pairs: list[Pair]) -> list:
    """Per pair and view ``(counts, n)`` by label and bucket: the documents of ``free`` (as read, or ``with_places``) that the other view is sure of."""
    width = [1 + x for x in BUCKETS]                            # in front the number of documents
    sent = free.sparkSession.sparkContext.broadcast(pairs)
    if "text" in free.columns:
        free = with_places(free, vocabulary)

    def emit(batches):
        models = sent.value
        sums = [np.zeros((len(models), 2, w), np.int64) for w in width]
        for rows, found, buckets in placed(batches):
            for k, pair in enumerate(models):
                for v, margin in enumerate(pair.margins(found, buckets, rows.num_rows)):
                    p, other = sigmoid(margin), 1 - v
                    label = np.where(p >= SURE, 1, np.where(1 - p >= SURE, 0, 2))          # 2: not sure
                    row, bucket = buckets[other]
                    sums[other][k, :, 0] += np.bincount(label, minlength=3)[:2]
                    sums[other][k, :, 1:] += np.bincount(label[row] * BUCKETS[other] + bucket, minlength=3 * BUCKETS[other]).reshape(3, -1)[:2]
        flat = np.concatenate([x.ravel() for x in sums])
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(flat[at], pa.int64())], names=["place", "k"])

    # as many rows as there are buckets, whatever the input
    got = free.select(*PLACES).mapInArrow(emit, "place int, k long").groupBy("place").agg(F.sum("k").alias("k")).toArrow()
    flat = np.zeros(len(pairs) * 2 * sum(width))
    flat[got.column("place").to_numpy()] = got.column("k").to_numpy()
    text, meta = np.split(flat, [len(pairs) * 2 * width[0]])
    views = [text.reshape(len(pairs), 2, width[0]), meta.reshape(len(pairs), 2, width[1])]
    return [[(views[v][k, :, 1:], views[v][k, :, 0]) for v in range(2)] for k in range(len(pairs))]


def fit_pairs(spark: SparkSession, sample, ratios: list) -> list[Pair]:
    """A pair per fold, fitted without its rows, and one on all rows; each model is fitted by a task of its own.

    ``sample``: the labelled rows, broadcast; ``ratios``: per pair and view what the other view's labels have given.
    """
    sent = spark.sparkContext.broadcast(ratios)

    def fit(batches):
        features, buckets, sizes, y, fold = sample.value
        for batch in batches:
            for i in batch.column("id").to_pylist():
                k, view = i >> 1, i & 1
                use = fold != k if k < FOLDS else np.ones(len(y), bool)      # the rows that it may learn from
                row, col = (x.astype(np.int64) for x in features[view])
                place, pick = np.cumsum(use) - 1, use[row]
                dense = mean_ratio(sent.value[k][view], *(x.astype(np.int64) for x in buckets[view]), len(y))
                m = Logistic(sizes[view], 1).fit(place[row[pick]], col[pick], y[use], dense[use], centre=1.0)
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([m.w]), pa.array([m.v]), pa.array([float(m.b)])], names=["id", "w", "v", "b"])

    n = 2 * len(ratios)
    got = spark.range(0, n, 1, n).mapInArrow(fit, "id long, w array<double>, v array<double>, b double").toArrow().to_pylist()   # a row per model
    models = {}
    for r in got:
        m = models[r["id"]] = Logistic(len(r["w"]), 1)
        m.w, m.v, m.b = np.array(r["w"]), np.array(r["v"]), r["b"]
    sent.unpersist()
    return [Pair([models[2 * k], models[2 * k + 1]], some) for k, some in enumerate(ratios)]


def cotrain(features: list, buckets: list, vocabulary: list, y: np.ndarray, fold: np.ndarray, free: DataFrame) -> Views:
    """``features`` (places in the vocabularies) and ``buckets``: per view ``(row, place)`` of the labelled rows; ``free``: the unlabelled ones."""
    n = len(y)
    narrow = [[(row.astype(np.int32), place.astype(np.int32)) for row, place in kind] for kind in (features, buckets)]
    sample = free.sparkSession.sparkContext.broadcast((*narrow, [len(x) for x in vocabulary], y, fold))

    none = [np.zeros(b) for b in BUCKETS]
    pairs = fit_pairs(free.sparkSession, sample, [none] * (FOLDS + 1))
    if len(np.unique(y)) == 2:
        for _ in range(ROUNDS):
            counted = count_sure(free, vocabulary, pairs)
            pairs = fit_pairs(free.sparkSession, sample, [[log_ratio(*counted[k][v]) for v in range(2)] for k in range(len(pairs))])
    margins = np.zeros((2, n))
    for f in range(FOLDS):
        for v in range(2):
            m = pairs[f].models[v].margin(*features[v], n, mean_ratio(pairs[f].ratios[v], *buckets[v], n))
            margins[v, fold == f] = m[fold == f]
    prior = float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    scale = [_calibrate(margins[v], y) if n else (1.0, 0.0) for v in range(2)]
    both = sum(s * margins[v] + o for v, (s, o) in enumerate(scale)) - prior
    return Views(pairs[-1], scale, prior, best_threshold(sigmoid(-both), 1 - y))


def unlabelled(base: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """Rows of ``base`` whose id no label has.  Up to ``limit`` ids are broadcast; for more, the rows are joined once and written."""
    ids = labels.dropna().distinct()
    if ids.limit(limit + 1).count() <= limit:
        return base.join(F.broadcast(ids), "id", "left_anti").drop("id")
    path = f"{fresh_dir(base.sparkSession, 'quality')}/unlabelled"
    base.hint("merge").join(ids, "id", "left_anti").drop("id").write.option("compression", "zstd").parquet(path)
    return base.sparkSession.read.parquet(path)


def quality(
    docs: DataFrame, labels: DataFrame, good: Column, meta: dict[str, Column], *, id_col: str = "doc_id", text_col: str = "text",
    labelled: int = LABELLED,
) -> DataFrame:
    """Per document: id, ``p_text``, ``p_meta``, ``score`` (probability of good quality) and ``keep``.

    ``good`` is a condition on ``labels``; ``meta`` maps names to columns of
    ``docs``.  Null and empty texts have no text features, null metadata is a
    value of its own; labels with a null or without a document are not used,
    a repeated label counts once (any of them); without labels the prior
    decides.  Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), meta_tokens(meta).alias("meta"))
    known = labelled_sample(docs, labels, id_col, text_col, {"good": good}, labelled).select("id", "good", "key")
    known = base.join(F.broadcast(known.select("id", "good", "key")), "id")                       # at most ``labelled`` rows
    text_words = choose_words(known.select("text", "good"), ["good"], FEATURES, text_features)

    def index(batches):
        for batch in batches:
            for a, b, found, buckets in features_of(batch):
                n, out = b - a, []
                places = [word_index(text_words, *found[0]), (found[1][0], found[1][1].view(np.int64)), *buckets]
                for (row, place), kind in zip(places, (pa.int32(), pa.int64(), pa.int16(), pa.int16()), strict=True):
                    out.append(pa.ListArray.from_arrays(np.searchsorted(row, np.arange(n + 1)).astype(np.int32), pa.array(place, kind)))
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(a, n), batch.column("good").slice(a, n), *out], names=["key", "good", "words", "tokens", "text_buckets", "meta_buckets"])

    spec = "key long, good int, words array<int>, tokens array<long>, text_buckets array<smallint>, meta_buckets array<smallint>"
    rows = known.select("key", "good", "text", "meta").mapInArrow(index, spec).orderBy("key").toArrow()       # at most ``labelled`` rows

    def flat(name):
        lists = rows.column(name).combine_chunks() if rows.num_rows else pa.array([], pa.list_(pa.int64()))
        return np.repeat(np.arange(rows.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)

    meta_row, meta_hash = flat("tokens")
    meta_words = np.unique(meta_hash.view(U))
    y = rows.column("good").to_numpy().astype(float)
    vocabulary, path = [text_words, meta_words], f"{fresh_dir(spark, 'quality')}/places"
    with_places(base, vocabulary).write.option("compression", "zstd").parquet(path)
    every = spark.read.parquet(path)
    free = unlabelled(every, labels.select(F.col(id_col).alias("id")), labelled)
    model = cotrain(
        [flat("words"), word_index(meta_words, meta_row, meta_hash.view(U))], [flat("text_buckets"), flat("meta_buckets")],
        vocabulary, y, fold_of(rows.column("key").to_numpy()), free)
    sent = spark.sparkContext.broadcast(model)

    def score(batches):
        m = sent.value
        for some, found, buckets in placed(batches):
            odds = [slope * margin + offset for (slope, offset), margin in zip(m.scale, m.pair.margins(found, buckets, some.num_rows), strict=True)]
            both = odds[0] + odds[1] - m.prior
            yield pa.RecordBatch.from_arrays([some.column("id"), pa.array(sigmoid(odds[0])), pa.array(sigmoid(odds[1])), pa.array(sigmoid(both)), pa.array(sigmoid(-both) <= m.cut)],
                                             names=["id", "p_text", "p_meta", "score", "keep"])

    kind = docs.schema[id_col].dataType.simpleString()
    return every.mapInArrow(score, f"id {kind}, p_text double, p_meta double, score double, keep boolean").withColumnRenamed("id", id_col)
