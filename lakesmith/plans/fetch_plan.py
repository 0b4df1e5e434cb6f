"""Fetch plan: listing pages -> the files that still need loading.

links on the listing (in order) -> keep the wanted suffix -> resume from
``start`` (optionally a batch of ``count``) -> drop files whose lake output is
already present -> download URL and lake path.  The slice is taken before
the presence check, so a batch may hold fewer than ``count`` files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesmith.functions.paths import base_name, concat_url, has_suffix, strip_suffix
from lakesmith.operators.planning import batch_slice, not_yet_done
from lakesmith.sources.listings import page_links

# Suffix of the wanted archives, the listing's base URL.
XML_SUFFIX = ".xml.gz"
BASELINE_URL = "https://ftp.ncbi.nlm.nih.gov/pubmed/baseline/"


def plan_fetch(pages: DataFrame, present_stems: DataFrame, suffix: str = XML_SUFFIX,
               base_url: str = BASELINE_URL, start: int = 0, count: int | None = None,
               lake_prefix: str = "lake") -> DataFrame:
    """``(page_id, pos, link, stem, url, lake_path)`` still to load.

    ``present_stems`` has one column ``stem``: base names (without ``suffix``)
    of files already in the lake, e.g. from ``file_inventory`` of the lake.
    """
    links = page_links(pages).filter(has_suffix(F.col("link"), suffix))
    links = batch_slice(links, ["page_id", "pos"], start, count)
    links = links.withColumn("stem", strip_suffix(base_name(F.col("link")), suffix))
    todo = not_yet_done(links, present_stems, "stem")
    return todo.select(
        "page_id", "pos", "link", "stem",
        concat_url(base_url, F.col("link")).alias("url"),
        F.concat(F.lit(lake_prefix.rstrip("/") + "/"), F.col("stem"), F.lit(".parquet")).alias("lake_path"),
    )
