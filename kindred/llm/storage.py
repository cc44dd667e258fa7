"""Files that tasks write and read themselves, through any store that pyarrow knows (local, HDFS, S3)."""

from __future__ import annotations

import os
from typing import BinaryIO

import pyarrow.fs as pafs


def _resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def write_bytes(uri: str, data: bytes) -> None:
    fs, path = _resolve(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    with fs.open_output_stream(path) as out:
        out.write(data)


def open_write(uri: str) -> BinaryIO:
    fs, path = _resolve(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    return fs.open_output_stream(path)


def read_bytes(uri: str) -> bytes:
    fs, path = _resolve(uri)
    with fs.open_input_stream(path) as f:
        return f.read()


def open_seekable(uri: str) -> BinaryIO:
    """For reading parts of a file, wherever they lie."""
    fs, path = _resolve(uri)
    return fs.open_input_file(path)
