"""Paths as Spark writes them, opened by Arrow's file systems on whichever machine a task runs."""

from __future__ import annotations

import uuid
from contextlib import contextmanager


def place(path: str):
    """File system and path of a path as Spark writes it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if "://" not in path else fs.FileSystem.from_uri(path)


def opened(path: str):
    system, at = place(path)
    return system.open_input_file(at)


@contextmanager
def created(path: str):
    """A stream whose file appears under its name when all is written."""
    system, at = place(path)
    system.create_dir(at.rsplit("/", 1)[0], recursive=True)
    part = f"{at}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(part) as out:
        yield out
    system.move(part, at)
