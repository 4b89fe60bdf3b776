"""Numpy arrays in the shared folder: written by one task, memory-mapped by others."""

from __future__ import annotations

import io
import mmap
import sys
import tempfile
import uuid
from typing import IO

import numpy as np
from pyarrow import fs


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write(path: str, array: np.ndarray) -> None:
    """Write an array as .npy. A task that runs again replaces the file as a whole."""
    system, name = _filesystem(path)
    system.create_dir(name.rpartition("/")[0], recursive=True)
    aside = f"{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(aside) as out:
        buffer = io.BytesIO()
        np.lib.format.write_array_header_1_0(buffer, np.lib.format.header_data_from_array_1_0(array))
        out.write(buffer.getvalue())
        out.write(memoryview(np.ascontiguousarray(array).reshape(-1).view(np.uint8)))
    system.move(aside, name)


def mapped(path: str) -> np.ndarray:
    """A memory-mapped array, empty if there is no such file.

    From a store that is no mounted folder it is first copied to an unnamed local file, which
    goes with the process. The mapping outlives its file handle, so that a task can map any
    number of shards.
    """
    system, name = _filesystem(path)
    if system.get_file_info(name).type == fs.FileType.NotFound:
        return np.zeros(0, np.uint64)
    if isinstance(system, fs.LocalFileSystem):
        with open(name, "rb") as file:
            return _view(file)
    with tempfile.TemporaryFile() as local:
        with system.open_input_stream(name) as source:
            while block := source.read(1 << 24):
                local.write(block)
        local.flush()
        local.seek(0)
        return _view(local)


def _view(file: IO[bytes]) -> np.ndarray:
    np.lib.format.read_magic(file)
    shape, _, kind = np.lib.format.read_array_header_1_0(file)
    if not np.prod(shape):
        return np.zeros(shape, kind)
    # Without trackfd (Python 3.13) a mapping would keep a handle of its own.
    own = {"trackfd": False} if sys.version_info >= (3, 13) else {}
    memory = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ, **own)
    return np.frombuffer(memory, kind, offset=file.tell()).reshape(shape)


def packed(sorted_keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as steps, byte by byte, so that the shuffle compresses them."""
    steps = np.diff(sorted_keys.astype(np.uint64), prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1), dtype=np.uint64)


def merged(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different keys in order, and the sums of their counts."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    sums = [np.add.reduceat(c[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64) for c in counts]
    return keys[first], *sums


def mixed(keys: np.ndarray) -> np.ndarray:
    """A well spread 64-bit hash of 64-bit keys."""
    x = keys.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))
