"""Plain files in a shared folder, written and read by tasks."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyarrow import fs


def system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path within it."""
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:"):
            return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


@contextmanager
def written(path: str) -> Iterator:
    """A stream to write; the file gets its name only when it is whole.

    A task that is run again, or twice at a time, replaces the file by an equal one.
    """
    store, name = system(path)
    store.create_dir(os.path.dirname(name), recursive=True)
    part = f"{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part, compression=None) as stream:
        yield stream
    store.move(part, name)


def array(path: str, kind: np.dtype, skip: int = 0) -> np.ndarray:
    """The numbers of a flat file from byte ``skip``: memory-mapped where it is local."""
    store, name = system(path)
    kind = np.dtype(kind)
    if isinstance(store, fs.LocalFileSystem):
        if os.path.getsize(name) - skip < kind.itemsize:
            return np.empty(0, kind)
        return np.memmap(name, kind, "r", offset=skip)
    with store.open_input_file(name) as file:
        return np.frombuffer(file.read()[skip:], kind)
