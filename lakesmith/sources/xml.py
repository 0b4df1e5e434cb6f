"""Gzipped XML article files -> one row per identifier list.

A gzip file cannot be split, so each file is unpacked by one task.  The task also
reads it (``_articles``), or, where a file is big, only cuts it into pieces of
some MB, which are dealt to tasks and read there.  Files of a store that only
Spark opens are read by Spark's XML source, with the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesmith.sources import _articles as A

ID_ELEMENT = T.StructType([
    T.StructField("_IdType", T.StringType()),
    T.StructField("_VALUE", T.StringType()),
])
ID_LIST_SCHEMA = T.StructType([T.StructField("ArticleId", T.ArrayType(ID_ELEMENT))])
ARTICLE_SCHEMA = T.StructType([
    T.StructField("PubmedData", T.StructType([T.StructField("ArticleIdList", ID_LIST_SCHEMA)])),
])
# Bytes of a file that one task reads by itself, and of a bigger one, as it lies there, for each task that reads its pieces.
SPREAD_BYTES = 1 << 22
PART_BYTES = 1 << 20
_FILE = "path string, source_file string, file_path string"


def read_id_lists(spark: SparkSession, path: str | list[str], own_only: bool = False, spread: int = 0) -> DataFrame:
    """One row per ``ArticleIdList`` element: column ``ArticleId`` (array of
    ``{_IdType, _VALUE}``) plus ``source_file`` (the file's name) and ``path``.

    ``own_only=False`` matches the element at any depth (lists nested in
    reference lists too).  ``own_only=True`` keeps only each article's own
    list (``PubmedArticle/PubmedData/ArticleIdList``).  ``path`` is a folder
    or a list of files.  ``spread``: tasks for the pieces of files beyond
    ``SPREAD_BYTES``, each of which must be well-formed; 0 reads every file in one.
    """
    files = spark.read.format("binaryFile").load(path).select(
        "path", F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_path").alias("file_path"), "length")
    if not _opens(files):
        return id_lists(xml_reader(spark.read, own_only).load(path), own_only)
    if spread:
        big = F.col("length") > SPREAD_BYTES
        found = _whole(files.where(~big), own_only).unionAll(_in_pieces(files.where(big), own_only, spread))
    else:
        found = _whole(files, own_only)
    return found.select(F.explode("ArticleIds").alias("ArticleId"), "source_file", F.col("file_path").alias("path"))


def _opens(files: DataFrame) -> bool:
    """Whether tasks can open the files by their paths."""
    from lakesmith.sources import _fs

    one = files.first()
    try:
        return one is None or bool(_fs.resolve(one["path"]))
    except Exception:  # noqa: BLE001 - an unknown store, or one without its library here
        return False


def _whole(files: DataFrame, own_only: bool) -> DataFrame:
    def read(batches):
        for b in batches:
            for file in b.to_pylist():
                for lists in A.lists_of_file(file["path"], own_only):
                    yield _row(file, {"ArticleIds": lists})

    return files.drop("length").mapInArrow(read, f"{_FILE}, {A.LISTS_SCHEMA}").drop("path")


def _in_pieces(files: DataFrame, own_only: bool, tasks: int) -> DataFrame:
    def cut(batches):
        import pyarrow as pa

        for b in batches:
            for file in b.to_pylist():
                for number, (head, piece, last) in enumerate(A.pieces(file["path"])):
                    values = {"number": number, "head": head, "piece": piece, "last": last}
                    yield pa.RecordBatch.from_pylist([file | values], schema=pa.schema([
                        *[(c, pa.string()) for c in file], ("number", pa.int32()), ("head", pa.binary()), ("piece", pa.binary()), ("last", pa.bool_())]))

    def read(batches):
        from xml.parsers import expat

        for b in batches:
            for i in range(b.num_rows):
                p = b.slice(i, 1).to_pylist()[0]
                try:
                    lists = A.lists_of(p["head"], p["piece"], p["last"], own_only)
                except expat.ExpatError as e:
                    raise A.DamagedFile(f"{p['path']}: piece {p['number']}: {e}") from None
                yield _row({k: p[k] for k in ("path", "source_file", "file_path")}, {"ArticleIds": lists})

    found = files.drop("length").mapInArrow(cut, f"{_FILE}, number int, head binary, piece binary, last boolean")
    return found.repartition(tasks, "path", "number").mapInArrow(read, f"{_FILE}, {A.LISTS_SCHEMA}").drop("path")


def _row(file: dict, values: dict):
    """One row of a file's names and, in each other column, a whole array."""
    import pyarrow as pa

    arrays = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in values.values()]
    return pa.RecordBatch.from_arrays([*[pa.array([v], pa.string()) for v in file.values()], *arrays], names=[*file, *values])


def xml_reader(read, own_only: bool = False):
    """``read`` (batch or stream) set up for the id lists."""
    tag, schema = ("PubmedArticle", ARTICLE_SCHEMA) if own_only else ("ArticleIdList", ID_LIST_SCHEMA)
    return (
        read.format("xml")
        .option("rowTag", tag)
        # a file with a second root element would otherwise yield only the first
        .option("mode", "FAILFAST")
        # identifiers are kept exactly as written, outer spaces included
        .option("ignoreSurroundingSpaces", False)
        .schema(schema)
    )


def id_lists(df: DataFrame, own_only: bool = False) -> DataFrame:
    ids = F.col("PubmedData.ArticleIdList.ArticleId") if own_only else F.col("ArticleId")
    return df.select(ids.alias("ArticleId"), F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_path").alias("path"))
