"""File access inside tasks for paths that executors reach directly (local, mounted) or
through a URI (``file://``, ``hdfs://``, ``s3://``, ``gs://`` ... via pyarrow filesystems)."""

from __future__ import annotations

import os


def _split(path: str):
    if path.startswith("file:/") and not path.startswith("file://"):  # as Spark writes local paths
        return None, path[len("file:"):]
    if "://" in path:
        from pyarrow import fs

        filesystem, inner = fs.FileSystem.from_uri(path)
        return filesystem, inner
    return None, path


def open_input(path: str):
    """A binary stream of the whole file."""
    filesystem, inner = _split(path)
    return open(inner, "rb") if filesystem is None else filesystem.open_input_stream(inner)


def open_random_access(path: str):
    """A seekable binary file object (zip archives need random access)."""
    filesystem, inner = _split(path)
    if filesystem is None:
        return open(inner, "rb")
    return filesystem.open_input_file(inner)


def open_output(path: str):
    filesystem, inner = _split(path)
    if filesystem is None:
        os.makedirs(os.path.dirname(inner) or ".", exist_ok=True)
        return open(inner, "wb")
    filesystem.create_dir(os.path.dirname(inner), recursive=True)
    return filesystem.open_output_stream(inner)


def move(src: str, dst: str) -> None:
    filesystem, s = _split(src)
    if filesystem is None:
        os.replace(s, dst)
        return
    _, d = _split(dst)
    filesystem.move(s, d)
