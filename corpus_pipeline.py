"""Corpus cleaning pipeline: language ID, exact dedup, n-gram Jaccard join, decontamination, SentencePiece.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, which is written as Parquet and reread as
the next stage's ``docs``.  All but the last return the columns of documents,
for the documents that they keep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesmith.llm import decontaminate as _decontaminate
from lakesmith.llm import exact_dedup as _exact
from lakesmith.llm import language_id as _language
from lakesmith.llm import ngram_join as _ngram
from lakesmith.llm import piece_encoding as _pieces
from lakesmith.llm.queries import PIECE_MODEL
from lakesmith.session import fresh_dir, ship_package


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the documents that are not held out; rejected documents go (no letter, or far from all centroids)."""
    ship_package(spark)
    model = _language.fit(docs.where(~_language.held_out("doc_id")))
    return _language.predict(docs, model).where(~F.col("rejected")).select("row.*").select(docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row of the largest doc_id stays; of rows that repeat an id and its text, one."""
    ship_package(spark)
    kept = _exact.exact_dedup(docs).where("kept").select("doc_id", "digest").distinct()
    keyed = docs.withColumn("digest", _exact.text_digest(F.col("text")))
    same = keyed["doc_id"].eqNullSafe(kept["doc_id"]) & (keyed["digest"] == kept["digest"])
    return keyed.hint("merge").join(kept, same, "left_semi").dropDuplicates(["doc_id", "digest"]).select(docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one of the smallest doc_id stays; a null id ranks above all others."""
    ship_package(spark)
    stand_in = F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    keyed = docs.withColumn("key", F.coalesce(F.col("doc_id").cast("long"), stand_in))
    groups = _ngram.ngram_jaccard_join(keyed, id_col="key")
    return keyed.hint("merge").join(groups.where("key = component_id").select("key"), "key", "left_semi").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    ship_package(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _decontaminate.decontaminate(docs, benchmark, carry=True).where("n_hit = 0").select("row.*").select(docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, and the digest of the text that they decode to.

    The ids are written before they are decoded: a task that did both would keep two Python workers.
    """
    ship_package(spark)
    pieces = _pieces.load_pieces(PIECE_MODEL)
    path = fresh_dir(spark, "corpus_pipeline")
    _pieces.encode(docs, pieces, keep=["doc_id"]).select("row.doc_id", "ids").write.option("compression", "zstd").parquet(f"{path}/ids")
    encoded = spark.read.parquet(f"{path}/ids")
    decoded = _pieces.decode(encoded, pieces, keep=["doc_id", "ids"])
    return decoded.select("row.doc_id", F.size("row.ids").cast("long").alias("n_pieces"), "row.ids", F.sha2("text", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("decontaminate", decontaminate),
    ("sentencepiece", sentencepiece),
]
#: the learned language model and the piece lattice have no SQL form; tests hold the stages against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written to the shared folder and reread."""
    path = fresh_dir(spark, "corpus_pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{k}_{name}")
        docs = spark.read.parquet(f"{path}/{k}_{name}")
    return docs
