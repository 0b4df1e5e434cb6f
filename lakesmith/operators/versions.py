"""Tables that are replaced whole: versioned folders and a log of commits.

Each version is written to a folder of its own.  A commit is one small file
with the next number, made only if there is none of that number yet; it says
which folders make up the table.  So a write that fails changes nothing, two
writers cannot both build on one version unnoticed, and who reads an older
version goes on reading it until it is removed (``remove_old_versions``).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from lakesmith.sources import _fs

COMMITS = "_commits"


class CommitConflict(RuntimeError):
    """Another writer committed first."""


def _numbers(path: str) -> list[int]:
    return sorted(int(n[:-5]) for n in _fs.list_files(_fs.join(path, COMMITS)) if n.endswith(".json") and not n.startswith("."))


def _name(path: str, number: int) -> str:
    return _fs.join(path, COMMITS, f"{number:012d}.json")


def latest(path: str, number: int | None = None) -> tuple[int, dict]:
    """``(number, record)`` of the newest (or a given) commit; ``(0, {})`` before the first."""
    if number is None:
        numbers = _numbers(path)
        if not numbers:
            return 0, {}
        number = numbers[-1]
    with _fs.open_input(_name(path, number)) as f:
        return number, json.loads(f.read().decode())


def commit(path: str, record: dict, after: int) -> int:
    """Commit ``record`` as the successor of ``after``; ``CommitConflict`` if that has one already."""
    try:
        _fs.write_new(_name(path, after + 1), json.dumps(record).encode())
    except FileExistsError as e:
        raise CommitConflict(f"{path}: commit {after + 1} is another writer's") from e
    return after + 1


def publish_version(df: DataFrame, path: str, replace: bool = True) -> int:
    """Publish ``df`` as the table's next version; returns its number.

    ``replace=False``: a table that has a version stays as it is.  A table that
    is replaced whole does not depend on the version before, so a lost race is
    simply tried again.
    """
    number, _ = latest(path)
    if number and not replace:
        return number
    folder = f"data-{uuid.uuid4().hex}"
    df.write.parquet(_fs.join(path, folder))
    while True:
        try:
            return commit(path, {"folders": [folder]}, latest(path)[0])
        except CommitConflict:
            continue


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The newest (or a given) version of a published table."""
    _, record = latest(path, number)
    if not record:
        raise FileNotFoundError(f"{path} has no published version")
    return spark.read.parquet(*[_fs.join(path, f) for f in record["folders"]])


def remove_old_versions(path: str, keep: int = 2) -> int:
    """Delete the commits before the newest ``keep`` and the folders that no kept one names; returns how many folders went.

    Folders of writes that never committed go too, so no write may be under way.
    """
    from pyarrow import fs as pafs

    numbers = _numbers(path)
    kept = numbers[-keep:]
    used = {f for n in kept for f in latest(path, n)[1]["folders"]}
    filesystem, inner = _fs.resolve(path)
    gone = 0
    for n in numbers[:-keep]:
        _fs.delete_file(_name(path, n))
    for e in filesystem.get_file_info(pafs.FileSelector(inner)):
        if e.type == pafs.FileType.Directory and "-" in e.base_name and not e.base_name.startswith(("_", ".")) and e.base_name not in used:
            filesystem.delete_dir(e.path)
            gone += 1
    return gone
