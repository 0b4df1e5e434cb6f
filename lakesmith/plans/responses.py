"""Response ingest: a table of landed JSONP responses -> JSON documents.

raw text -> strip BOM -> unwrap ``(...)`` -> strict parse to VARIANT (null
when the text is not exactly one JSON value) -> documents by id, and rejects.
All column expressions; no Python on the data path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakesmith.functions.paths import concat_url
from lakesmith.functions.text import strict_json, strip_bom, unwrap_jsonp
from lakesmith.session import fresh_dir


def response_urls(dois: DataFrame, base_url: str, doi_col: str = "doi") -> DataFrame:
    """``(doi, url)`` with ``url = base_url + doi`` (the service base comes from config)."""
    return dois.select(doi_col, concat_url(base_url, F.col(doi_col)).alias("url"))


def unwrap_responses(raw: DataFrame, raw_col: str = "raw") -> DataFrame:
    """Adds ``body`` (unwrapped text) and ``doc`` (VARIANT or null)."""
    body = unwrap_jsonp(strip_bom(F.col(raw_col)))
    return raw.withColumn("body", body).withColumn("doc", strict_json(F.col("body")))


def ingest_responses(raw: DataFrame, out_path: str, rejects_path: str | None = None, doi_col: str = "doi",
                     raw_col: str = "raw") -> dict[str, int]:
    """Write the parsed documents, the documents with their ids, and the rejects.

    ``out_path`` gets one JSON document per line; beside it, ``<out_path>_by_doi``
    gets ``(doi, document)`` as parquet, so each document can be tied to its id,
    and ``rejects_path`` (default ``<out_path>_rejects``) gets ``(doi, raw)`` of
    the responses that are not exactly one JSON value.  Returns the counts.

    The responses are read and parsed once, into a staged table split by
    validity, which the counts are taken from on the way; the three outputs are
    copies of its parts.
    """
    spark, base, staged = raw.sparkSession, out_path.rstrip("/"), fresh_dir(raw.sparkSession, "stage", "responses")
    parsed = unwrap_responses(raw, raw_col).select(F.col(doi_col).alias("id"), F.to_json("doc").alias("document"), F.col(raw_col).alias("raw"))
    known = F.col("document").isNotNull()
    seen = Observation()
    split = parsed.select("id", "document", F.when(~known, F.col("raw")).alias("raw"), known.alias("valid")).observe(
        seen, F.count_if("valid").alias("documents"), F.count_if(~F.col("valid")).alias("rejects"))
    split.write.partitionBy("valid").parquet(staged)
    rows = spark.read.schema(split.schema).parquet(staged)
    ok, bad = rows.where("valid"), rows.where("NOT valid")
    ok.select(F.col("id").alias(doi_col), "document").write.mode("overwrite").parquet(f"{base}_by_doi")
    bad.select(F.col("id").alias(doi_col), F.col("raw").alias(raw_col)).write.mode("overwrite").parquet(rejects_path or f"{base}_rejects")
    ok.select(F.col("document").alias("value")).write.mode("overwrite").text(out_path)
    return {"documents": int(seen.get["documents"]), "rejects": int(seen.get["rejects"])}
