"""Numpy arrays in the cluster's shared folder, memory-mapped by workers."""

from __future__ import annotations

import io
import os
import tempfile
import uuid

import numpy as np
from pyarrow import fs


def _place(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root)


def write_array(root: str, name: str, array: np.ndarray) -> None:
    """Writes under a name of its own and then moves, so that a repeated task does no harm."""
    system, path = _place(root)
    system.create_dir(path, recursive=True)
    own = f"{path}/.{name}-{uuid.uuid4().hex}"
    buffer = io.BytesIO()
    np.save(buffer, np.ascontiguousarray(array))
    with system.open_output_stream(own) as out:
        out.write(buffer.getbuffer())
    system.move(own, f"{path}/{name}.npy")


_open: dict[tuple[str, str], np.ndarray] = {}


def open_array(root: str, name: str) -> np.ndarray:
    """The mapped array; a worker keeps it open."""
    key = (root, name)
    if key not in _open:
        _open[key] = map_array(root, name)
    return _open[key]


def map_array(root: str, name: str) -> np.ndarray:
    """The array, mapped as long as someone holds it.

    On a local or mounted file system the file itself is mapped, else a copy that has no name any
    more and so goes with the mapping.
    """
    system, path = _place(root)
    if isinstance(system, fs.LocalFileSystem):
        return np.load(f"{path}/{name}.npy", mmap_mode="r")
    handle, copy = tempfile.mkstemp(suffix=".npy")
    try:
        with os.fdopen(handle, "wb") as out, system.open_input_stream(f"{path}/{name}.npy") as src:
            while chunk := src.read(1 << 24):
                out.write(chunk)
        return np.load(copy, mmap_mode="r")
    finally:
        os.unlink(copy)
