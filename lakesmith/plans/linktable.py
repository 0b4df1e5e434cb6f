"""Link-table build: a lake of many small (PMID, DOI) files -> one clean typed
table ``PMID bigint, DOI string``.

Plan (one lazy chain, one shuffle):
scan (2 columns) -> distinct (partial agg, shuffle, final agg) -> keep-null
sentinel filter (Catalyst pushes it under the aggregate) -> Python-int cast
-> not-null -> project.  ``distinct_after_cast=True`` dedupes on the integer,
so ``007`` and ``7`` with one DOI give one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesmith.functions.ids import SENTINEL_PMID, not_equal_keep_null, python_int
from lakesmith.operators.sinks import files_for, input_bytes, write_compacted
from lakesmith.operators.tables import keep_not_null, project_rename
from lakesmith.sources.lake import read_link_lake


def clean_links(lake: DataFrame, distinct_after_cast: bool = False, distinct: bool = True) -> DataFrame:
    """(PMID string, DOI string) -> (PMID bigint, DOI string), cleaned; ``distinct=False``: the pairs are distinct already."""
    df = lake.dropDuplicates() if distinct and not distinct_after_cast else lake
    df = df.filter(not_equal_keep_null("PMID", SENTINEL_PMID))
    df = df.withColumn("PMID_int", python_int("PMID"))
    df = keep_not_null(df, "PMID_int")
    df = project_rename(df, {"PMID_int": "PMID", "DOI": "DOI"})
    return df.dropDuplicates() if distinct_after_cast else df


def lake_links(spark: SparkSession, lake_path: str) -> DataFrame:
    """``(PMID, DOI)`` as strings; of a lake with a manifest, the committed rows."""
    from lakesmith.plans.xml_ingest import MANIFEST, read_link_partitions
    from lakesmith.sources import _fs

    if _fs.list_files(_fs.join(lake_path, MANIFEST)):
        return read_link_partitions(spark, lake_path).select("PMID", "DOI")
    return read_link_lake(spark, lake_path)


def build_link_table(spark: SparkSession, lake_path: str, distinct_after_cast: bool = False) -> DataFrame:
    return clean_links(lake_links(spark, lake_path), distinct_after_cast)


def publish_link_table(spark: SparkSession, lake_path: str, out_path: str, distinct_after_cast: bool = False) -> int:
    """Build and write the table as files of ~256 MB each (sized from the
    lake's bytes; the lake is larger than the output, so this errs on fewer,
    bigger files), range-partitioned and sorted on ``(PMID, DOI)``: each file
    covers a disjoint PMID range, so lookups by PMID skip the rest, and a
    PMID with very many DOIs still spreads over files.  Returns the final row
    count, observed during the write (no second pass)."""
    from lakesmith.operators.tables import observe_count

    df, obs = observe_count(build_link_table(spark, lake_path, distinct_after_cast))
    write_compacted(df, out_path, files_for(input_bytes(spark, lake_path)), cluster_by=["PMID", "DOI"])
    return int(obs.get["rows"])
