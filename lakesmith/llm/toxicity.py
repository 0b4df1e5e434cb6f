"""Toxicity by a classifier chain.

Categories are predicted in a stated order by linear models over words; each
model also sees the probabilities of the categories before it.  In training
those are out-of-fold predictions, so a later model learns from probabilities
as honest as the ones it meets when scoring.

The models are fitted on a bounded sample of labelled rows (``LABELLED``);
the words they use are chosen by counts over that whole sample.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesmith.llm._linear import Logistic, best_threshold, sigmoid
from lakesmith.llm._words import PUNCT, U, pieces, scan

#: most labelled rows used for fitting, smallest hash first
LABELLED = 20_000
#: words per category at most, and how many standard deviations their rate must be off
WORDS, LEAST_Z = 4096, 5.0
FOLDS = 5
PIECE_BYTES = 4_000_000


def distinct_words(texts: pa.Array):
    """``(a, b, row, word)``: the distinct words (64-bit hashes) of rows ``a:b``."""
    for a, b, off, raw in pieces(texts, PIECE_BYTES):
        w = scan(off, raw, PUNCT, True)
        row = np.repeat(np.arange(b - a), np.diff(w.first))
        order = np.lexsort((w.hash, row))
        row, word = row[order], w.hash[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (word[1:] != word[:-1])
        yield a, b, row[new], word[new]


def word_index(vocabulary: np.ndarray, row: np.ndarray, word: np.ndarray):
    """Rows and places in the sorted ``vocabulary`` of the words it has."""
    if not len(vocabulary):
        return row[:0], np.zeros(0, np.int64)
    at = np.searchsorted(vocabulary, word)
    at[at == len(vocabulary)] = 0
    hit = vocabulary[at] == word
    return row[hit], at[hit]


def choose_words(sample: DataFrame, flags: list[str], words: int, features=distinct_words) -> np.ndarray:
    """The ``words`` features of ``sample(text, *flags)`` that part each flag best, by a z score of their rates; chance words of a small sample stay below ``LEAST_Z``."""
    def emit(batches):
        for batch in batches:
            ys = np.stack([batch.column(1 + i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(len(flags))])
            for a, _, row, word in features(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), *[pa.array(y[a + row]) for y in ys]], names=["word", *flags])

    counts = sample.select("text", *flags).mapInArrow(emit, "word long, " + ", ".join(f"{f} long" for f in flags))
    totals = sample.agg(F.count(F.lit(1)).alias("n"), *[F.sum(f).alias(f) for f in flags]).first()
    n = totals["n"] or 0
    if not n:
        return np.zeros(0, U)
    per = counts.groupBy("word").agg(F.count(F.lit(1)).alias("k"), *[F.sum(f).alias(f) for f in flags]).where("k > 1")
    found = set()
    for f in flags:
        rate = (totals[f] or 0) / n
        if 0 < rate < 1:
            z = F.abs(F.col(f) - F.col("k") * rate) / F.sqrt(F.col("k") * F.lit(rate * (1 - rate)))
            found |= {r[0] for r in per.select("word", z.alias("z")).where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "word").limit(words).collect()}
    return np.sort(np.array(sorted(found), np.int64).view(U))


def fold_of(key: np.ndarray, folds: int = FOLDS) -> np.ndarray:
    return (key.astype(U) % U(folds)).astype(np.int64)


@dataclass
class Chain:
    names: list[str]
    vocabulary: np.ndarray
    models: list[Logistic]
    cuts: list[float]


def fit_chain(names: list[str], vocabulary: np.ndarray, row, col, y: np.ndarray, fold: np.ndarray) -> Chain:
    """``y``: one column per category, in chain order."""
    n = len(y)
    seen = np.zeros((n, 0))                                     # out-of-fold margins of the categories so far
    models, cuts = [], []
    for k in range(len(names)):
        out = np.zeros(n)
        for f in range(FOLDS):
            rest = fold != f
            place = np.cumsum(rest) - 1
            used = rest[row]
            m = Logistic(len(vocabulary), seen.shape[1]).fit(place[row[used]], col[used], y[rest, k], seen[rest])
            here = ~rest
            place = np.cumsum(here) - 1
            out[here] = m.margin(place[row[~used]], col[~used], int(here.sum()), seen[here])
        cuts.append(best_threshold(sigmoid(out), y[:, k]))
        models.append(Logistic(len(vocabulary), seen.shape[1]).fit(row, col, y[:, k], seen))
        seen = np.column_stack([seen, sigmoid(out)])
    return Chain(names, vocabulary, models, cuts)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, flags: dict[str, Column], limit: int) -> DataFrame:
    """``(text, key, *flags)`` of at most ``limit`` labelled documents."""
    chosen = labels.select(F.col(id_col).alias("id"), *[c.cast("int").alias(n) for n, c in flags.items()]).dropna().dropDuplicates(["id"])
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(limit)
    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        .join(F.broadcast(chosen), "id").withColumn("key", F.xxhash64("id"))     # at most ``limit`` narrow rows
    )


def toxicity(
    docs: DataFrame, labels: DataFrame, categories: dict[str, Column], *, id_col: str = "doc_id", text_col: str = "text",
    limit: int = LABELLED, words: int = WORDS,
) -> DataFrame:
    """Per document: id and, for each category in chain order, ``p_<name>`` and the decision ``<name>``.

    ``categories`` maps names to conditions on ``labels``.  Null and empty
    texts have no words and get the prior; labels with a null or without a
    document are not used; a repeated label counts once (any of them); without
    labels, or with one class only, a category's prior decides.  The cut is
    that of the best F1 on out-of-fold predictions.  Other columns are not
    read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    names = list(categories)
    sample = labelled_sample(docs, labels, id_col, text_col, categories, limit)
    vocabulary = choose_words(sample, names, words)

    def index(batches):
        for batch in batches:
            for a, b, row, word in distinct_words(batch.column(0)):
                r, c = word_index(vocabulary, row, word)
                first = np.searchsorted(r, np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), pa.ListArray.from_arrays(first, pa.array(c, pa.int32())), *[batch.column(2 + i).slice(a, b - a) for i in range(len(names))]],
                                                 names=["key", "words", *names])

    # at most ``limit`` rows of at most ``words`` places per category
    rows = sample.select("text", "key", *names).mapInArrow(index, "key long, words array<int>, " + ", ".join(f"{n} int" for n in names)).orderBy("key").toArrow()
    lists = rows.column("words").combine_chunks() if rows.num_rows else pa.array([], pa.list_(pa.int32()))
    col = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(rows.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    y = np.stack([rows.column(n).to_numpy().astype(float) for n in names], axis=1)
    chain = fit_chain(names, vocabulary, row, col, y, fold_of(rows.column("key").to_numpy()))
    sent = spark.sparkContext.broadcast(chain)

    def score(batches):
        m = sent.value
        for batch in batches:
            for a, b, row, word in distinct_words(batch.column(1)):
                r, c = word_index(m.vocabulary, row, word)
                seen, out = np.zeros((b - a, 0)), []
                for model, cut in zip(m.models, m.cuts, strict=True):
                    p = model.probability(r, c, b - a, seen)
                    seen = np.column_stack([seen, p])
                    out += [pa.array(p), pa.array(p >= cut)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *out], names=["id", *[x for n in names for x in (f"p_{n}", n)]])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        score, f"id {kind}, " + ", ".join(f"p_{n} double, {n} boolean" for n in names)
    )
    return out.withColumnRenamed("id", id_col)
