"""Files as tasks open them themselves, for what Spark has no reader for."""

from __future__ import annotations

from typing import IO

import pyarrow as pa
from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """Store and place of a path as Spark names it, in any store that Arrow knows."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = f"file://{path.removeprefix('file:')}"  # Spark names local files file:/a/b
    return fs.FileSystem.from_uri(path)


def open_stream(path: str) -> IO[bytes]:
    """The file from its beginning to its end, as stored."""
    store, place = located(path)
    return store.open_input_stream(place, compression=None)


def open_file(path: str) -> pa.NativeFile:
    """The file for reads at any place, such as of a footer."""
    store, place = located(path)
    return store.open_input_file(place)
