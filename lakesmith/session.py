"""Session and shared-folder helpers.

Everything a job writes between steps (rendered fixtures, compaction output,
stream checkpoints) goes under the folder the cluster names in
``spark.checkpoint.dir``.  That folder is shared by every executor, so a lost
executor's work can be redone by any other.  Only when the setting is unset
(local tests) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "lakesmith") -> SparkSession:
    """Session used by tests and bench: AQE on, UI off, UTC, Arrow on."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def _checkpoint_root(spark: SparkSession) -> str | None:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    return spark.sparkContext.getCheckpointDir()


def scratch_dir(spark: SparkSession, *parts: str) -> str:
    """Folder under the shared checkpoint directory.

    Reads ``spark.checkpoint.dir`` from the session.  If it is unset we only
    invent one in local mode; on a cluster a machine-local folder would be
    lost with its executor, so we refuse instead.
    """
    root = _checkpoint_root(spark)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is unset: point it at a folder every executor can reach"
            )
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakesmith-"))
        root = _checkpoint_root(spark)   # the folder Spark made, as later calls will see it
    root = root.removeprefix("file:")
    path = os.path.join(root, "lakesmith", *parts) if parts else os.path.join(root, "lakesmith")
    return path


def fresh_dir(spark: SparkSession, *parts: str) -> str:
    """A new, never-used folder under the shared scratch area."""
    return scratch_dir(spark, *parts, uuid.uuid4().hex)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the Python workers, wherever they run.

    Steps that run Python in tasks (``mapInArrow`` / ``mapInPandas``) pickle
    functions by module reference, so the workers must import ``lakesmith``.
    The package is zipped once per Spark context into the shared folder and
    added with ``addPyFile``, which puts it on every worker's path (local or
    cluster).  Cheap and idempotent.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import io
    import zipfile

    from lakesmith.sources import _fs

    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    folder = scratch_dir(spark, "pyfiles", key)
    _fs.makedirs(folder)
    out = _fs.join(folder, "lakesmith.zip")
    with _fs.open_output(out) as sink:
        sink.write(buf.getvalue())
    sc.addPyFile(out)
    _SHIPPED.add(key)
