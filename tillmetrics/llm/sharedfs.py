"""Files in the shared folder, opened from tasks."""

from __future__ import annotations

import os
from typing import BinaryIO
from urllib.parse import unquote, urlsplit


def _local(uri: str) -> str | None:
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return unquote(parts.path) if parts.scheme else uri
    return None


def open_new(uri: str) -> BinaryIO:
    """A new file for writing; its folder is made where needed."""
    path = _local(uri)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path)


def open_old(uri: str) -> BinaryIO:
    path = _local(uri)
    if path is not None:
        return open(path, "rb")
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_stream(path)
