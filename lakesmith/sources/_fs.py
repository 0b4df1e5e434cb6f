"""File access by the paths Spark reports, from the driver or inside a task.

Local paths, ``file:`` URIs and any URI ``pyarrow.fs`` knows (hdfs://, s3://,
gs://, ...) resolve to the same calls, so code that writes a marker or opens
an archive works the same on a laptop and against a cluster's shared store.
"""

from __future__ import annotations

# Schemes of Hadoop's connectors and what pyarrow.fs calls the
# same store.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def store_uri(path: str) -> str:
    """The URI under the scheme that ``pyarrow.fs`` knows.

    The old blob endpoint becomes the file-system endpoint of the same
    account, as its connector does.
    """
    scheme, rest = path.split("://", 1)
    known = SCHEMES.get(scheme.lower(), scheme)
    if scheme.lower() in ("wasb", "wasbs"):
        rest = rest.replace(".blob.core.windows.net", ".dfs.core.windows.net", 1)
    return f"{known}://{rest}"


def resolve(path: str):
    """``(filesystem, path inside it)`` for ``path``."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    if "://" in path:
        return fs.FileSystem.from_uri(store_uri(path))
    return fs.LocalFileSystem(), path


def open_input(path: str):
    """Seekable input stream."""
    filesystem, inner = resolve(path)
    return filesystem.open_input_file(inner)


def open_output(path: str):
    """Output stream of the bytes as they are (pyarrow would compress by the file's ending)."""
    filesystem, inner = resolve(path)
    return filesystem.open_output_stream(inner, compression=None)


def exists(path: str) -> bool:
    from pyarrow import fs

    filesystem, inner = resolve(path)
    return filesystem.get_file_info(inner).type != fs.FileType.NotFound


def makedirs(path: str) -> None:
    filesystem, inner = resolve(path)
    filesystem.create_dir(inner, recursive=True)


def touch(path: str) -> None:
    with open_output(path):
        pass


def move(src: str, dst: str) -> None:
    """Rename within one filesystem (atomic on POSIX and HDFS)."""
    filesystem, a = resolve(src)
    _, b = resolve(dst)
    filesystem.move(a, b)


def move_new(src: str, dst: str) -> None:
    """Rename within one filesystem; ``FileExistsError`` if ``dst`` is there already, which stays as it is.

    Atomic where a rename refuses an existing target (HDFS) and on POSIX (a
    hard link does); on an object store without such a call the check comes first.
    """
    import os

    from pyarrow import fs

    filesystem, a = resolve(src)
    _, b = resolve(dst)
    if isinstance(filesystem, fs.LocalFileSystem):
        os.link(a, b)
        os.unlink(a)
        return
    if exists(dst):
        raise FileExistsError(dst)
    try:
        filesystem.move(a, b)
    except OSError as e:
        if exists(src):   # refused: another writer was first
            raise FileExistsError(dst) from e
        raise


def write_new(path: str, data: bytes) -> None:
    """Write a file that appears whole, and only if there is none of its name (else ``FileExistsError``)."""
    import uuid

    folder, name = path.rsplit("/", 1)
    makedirs(folder)
    hidden = join(folder, f".{uuid.uuid4().hex}.{name}")
    with open_output(hidden) as f:
        f.write(data)
    try:
        move_new(hidden, path)
    except FileExistsError:
        delete_file(hidden)
        raise


def join(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *[p.strip("/") for p in parts]])


def list_files(path: str) -> list[str]:
    """Names of the files in a folder; none if it does not exist."""
    from pyarrow import fs

    filesystem, inner = resolve(path)
    if filesystem.get_file_info(inner).type != fs.FileType.Directory:
        return []
    return [e.base_name for e in filesystem.get_file_info(fs.FileSelector(inner)) if e.type == fs.FileType.File]


def list_folders(path: str) -> list[str]:
    """Names of the folders in a folder; none if it does not exist."""
    from pyarrow import fs

    filesystem, inner = resolve(path)
    if filesystem.get_file_info(inner).type != fs.FileType.Directory:
        return []
    return [e.base_name for e in filesystem.get_file_info(fs.FileSelector(inner)) if e.type == fs.FileType.Directory]


def delete_file(path: str) -> bool:
    """Delete one file; False if it was already gone."""
    from pyarrow import fs

    filesystem, inner = resolve(path)
    if filesystem.get_file_info(inner).type == fs.FileType.NotFound:
        return False
    filesystem.delete_file(inner)
    return True
