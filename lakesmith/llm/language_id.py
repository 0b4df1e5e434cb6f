"""Language ID: nearest centroid of normalised TF-IDF n-gram vectors, several centroids per language.

Texts are lower-cased, all but letters becomes a space, and n-grams of 1 to 3
bytes are hashed into ``DIMS`` dimensions.  Document frequencies cover every
training document.  A bounded sample per language (``PER_LANGUAGE``, by hash
of the row) is clustered by spherical k-means into ``CLUSTERS`` centroids; the
centroids are the model.  A text takes the language of the centroid with the
highest cosine; it is rejected if it is further from that centroid than nearly
all training texts, with room left for short texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesmith.llm._words import BASE, U, pieces

DIMS = 1 << 12
GRAMS = 3
CLUSTERS = 4
#: most texts of a language that its centroids are fitted on
PER_LANGUAGE = 2000
#: text and rows whose counts are held at once (a row has ``DIMS`` counts, however short its text)
PIECE_BYTES, PIECE_ROWS = 1 << 20, 256
IDF_PARTS = 8
#: quantile of the training texts' cosine, and the share of it that is still accepted
REJECT_QUANTILE, REJECT_SHARE = 0.01, 0.5
UNKNOWN = "und"

_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def counts(texts: pa.Array):
    """Yields ``(a, b, matrix)``: n-gram counts of rows ``a:b``."""
    for a, b, off, raw in pieces(pc.utf8_lower(pc.fill_null(texts, "")), PIECE_BYTES, PIECE_ROWS):
        flat = _LETTER[raw]
        blank = flat == 0x20
        keep = np.ones(len(flat), bool)
        keep[1:] = ~(blank[1:] & blank[:-1])                   # one space between words
        row = np.repeat(np.arange(b - a), np.diff(off))[keep]
        flat = flat[keep].astype(U)
        total, code = np.zeros((b - a) * DIMS, np.int64), np.zeros(len(flat), U)
        for n in range(1, GRAMS + 1):
            if len(flat) < n:
                break
            code = (code[:len(flat) - n + 1] << U(8)) | flat[n - 1:]
            whole = row[:len(code)] == row[n - 1:]
            if n == 1:
                whole &= flat != 0x20
            slot = ((code + U(n << 40)) * U(BASE)) >> U(64 - (DIMS - 1).bit_length())
            total += np.bincount(row[:len(code)][whole] * DIMS + slot[whole].astype(np.int64), minlength=len(total))
        yield a, b, total.reshape(b - a, DIMS)


def vectors(matrix: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of unit length: (1 + log count) x idf."""
    x = np.where(matrix > 0, 1 + np.log(np.maximum(matrix, 1)), 0).astype(np.float32) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _frequencies(batches):
    total, n = np.zeros(DIMS, np.int64), 0
    for batch in batches:
        for a, b, m in counts(batch.column(0)):
            total += (m > 0).sum(axis=0)
            n += b - a
    parts = total.reshape(IDF_PARTS, -1)
    yield pa.RecordBatch.from_arrays([
        pa.array(range(IDF_PARTS), pa.int32()), pa.array([n] * IDF_PARTS, pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "n", "df"])


def _add_up(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c.as_py(), np.int64) for c in table.column("df"))
    return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int32()), "n": pa.array([pc.sum(table.column("n")).as_py()], pa.int64()), "df": pa.array([total.tobytes()], pa.binary())})


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """Smoothed idf of each dimension over all rows of ``texts(text)``; a result of fixed size."""
    rows = texts.mapInArrow(_frequencies, "part int, n long, df binary").groupBy("part").applyInArrow(_add_up, "part int, n long, df binary").collect()
    df, n = np.zeros((IDF_PARTS, DIMS // IDF_PARTS), np.int64), 0
    for part, n, blob in rows:
        df[part] = np.frombuffer(blob, np.int64)
    return (np.log((1 + n) / (1 + df.ravel())) + 1).astype(np.float32)


def _sample_vectors(batches, idf):
    for batch in batches:
        for a, b, m in counts(batch.column("text")):
            x = vectors(m, idf)
            filled = np.flatnonzero(m.any(axis=1))
            slots = [np.flatnonzero(x[i]).astype(np.uint16) for i in filled]
            yield pa.RecordBatch.from_arrays([
                batch.column("lang").slice(a, b - a).take(pa.array(filled)), pa.array([s.tobytes() for s in slots], pa.binary()),
                pa.array([x[i, s].tobytes() for i, s in zip(filled, slots, strict=True)], pa.binary())], names=["lang", "slots", "weights"])


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """At most ``k`` unit centroids; starts from the texts least like the centroids so far."""
    start = x.mean(axis=0)
    near = x @ (start / max(np.linalg.norm(start), 1e-12))
    chosen = [int(np.argmax(near))]
    best = x @ x[chosen[0]]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin(best)))
        best = np.maximum(best, x @ x[chosen[-1]])
    c = x[chosen]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        c = np.stack([x[own == i].sum(axis=0) for i in range(len(c)) if (own == i).any()])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def _cluster(table: pa.Table, clusters: int) -> pa.Table:
    """Centroids of one language and the least cosine that each accepts."""
    x = np.zeros((table.num_rows, DIMS), np.float32)
    for i, (s, w) in enumerate(zip(table.column("slots").to_pylist(), table.column("weights").to_pylist(), strict=True)):
        x[i, np.frombuffer(s, np.uint16)] = np.frombuffer(w, np.float32)
    x = x[np.lexsort(x[:, :8].T)]                               # the order of rows must not matter
    c = spherical_kmeans(x, clusters)
    best = (x @ c.T).max(axis=1)
    least = REJECT_SHARE * float(np.quantile(best, REJECT_QUANTILE))
    k = len(c)
    return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * k, pa.string()), "centroid": pa.array([v.tobytes() for v in c], pa.binary()), "least": pa.array([least] * k, pa.float64())})


@dataclass
class Model:
    langs: list[str]
    centroids: np.ndarray
    least: np.ndarray
    idf: np.ndarray


def fit(train: DataFrame, lang_col: str = "lang", text_col: str = "text", per_language: int = PER_LANGUAGE, clusters: int = CLUSTERS) -> Model:
    """Model of the rows with a language and a letter; its size is languages x clusters x ``DIMS``."""
    spark = train.sparkSession
    rows = train.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where(has_letter(F.col("text")) & F.col("lang").isNotNull())
    idf = inverse_frequencies(rows.select("text"))
    from pyspark.sql import Window

    keyed = rows.select("lang", F.xxhash64("text").alias("h")).distinct()          # copies once
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    cuts = keyed.withColumn("nth", nth).where(F.col("nth") <= per_language).groupBy("lang").agg(F.max("h")).collect()   # one row per language
    chosen = F.lit(False)
    for lang, cut in cuts:
        chosen = chosen | ((F.col("lang") == lang) & (F.xxhash64("text") <= cut))
    sent = spark.sparkContext.broadcast(idf)
    sample = rows.where(chosen).dropDuplicates(["lang", "text"])
    found = (
        sample.mapInArrow(lambda it: _sample_vectors(it, sent.value), "lang string, slots binary, weights binary")
        .groupBy("lang").applyInArrow(lambda t: _cluster(t, clusters), "lang string, centroid binary, least double").orderBy("lang", "centroid").collect()
    )
    c = np.stack([np.frombuffer(r.centroid, np.float32) for r in found]) if found else np.zeros((0, DIMS), np.float32)
    return Model([r.lang for r in found], c, np.array([r.least for r in found]), idf)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _predict(batches, m: Model):
    for batch in batches:
        texts, letters = batch.column(1), batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        n = batch.num_rows
        pred, score, rejected = [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
        if m.langs:
            for a, b, counted in counts(texts):
                near = vectors(counted, m.idf) @ m.centroids.T
                best = np.argmax(near, axis=1)
                cosine = near[np.arange(b - a), best]
                for i in np.flatnonzero(letters[a:b]):
                    pred[a + i] = m.langs[best[i]]
                score[a:b] = np.where(letters[a:b], np.clip(cosine, 0, 1), 0)
                rejected[a:b] = ~letters[a:b] | (cosine < m.least[best])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_()), *batch.columns[3:]],
                                         names=["row", "lang_pred", "score", "rejected", *batch.schema.names[3:]])


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or the columns ``keep`` of it) as struct ``row``, with ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected``.

    Null texts and texts without a letter are ``und`` with score 0, and
    rejected; so is everything if there was nothing to learn from.  Ties go to
    the first language in alphabetical order.  Columns of ``docs`` travel in
    the struct, so any names are fine.
    """
    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

    sent = docs.sparkSession.sparkContext.broadcast(model)
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("row"), text.alias("text"), has_letter(text).alias("letters"))
    schema = StructType([rows.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())])
    return rows.mapInArrow(lambda it: _predict(it, sent.value), schema)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def language_id(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learns from the rows that are not held out, predicts all: id, ``held_out``, ``lang_pred``, ``score``, ``rejected``."""
    keyed = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model = fit(keyed.where(~F.col("held_out")))
    out = predict(keyed.select("id", "held_out", "text"), model, keep=["id", "held_out"])
    return out.select(F.col("row.id").alias(id_col), "row.held_out", "lang_pred", "score", "rejected")
