"""Files that tasks write and read in the shared folder.

A task writes a file under a name of its own and reports it in a row; only reported files belong to the
result. A task that runs twice, or dies half-way, leaves a file that nothing refers to.
"""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs


def _at(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def new_name(folder: str, part: int, suffix: str) -> str:
    return f"{folder}/part-{part:05d}-{uuid.uuid4().hex}{suffix}"


def create(path: str):
    system, place = _at(path)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    return system.open_output_stream(place, compression=None)


def open_ranges(path: str):
    """A file for reads at offsets."""
    system, place = _at(path)
    return system.open_input_file(place)
