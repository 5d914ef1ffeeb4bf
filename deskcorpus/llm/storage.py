"""Files of our own formats in a shared folder, written and read by tasks."""

from __future__ import annotations

import uuid


def filesystem(path: str):
    """The file system and the path in it of a plain path or a URI (file, hdfs, s3, gs)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("/") else fs.FileSystem.from_uri(f"file:{path}")


def make_folder(path: str) -> None:
    files, inner = filesystem(path)
    files.create_dir(inner, recursive=True)


def fresh_name(folder: str, part: int, number: int, suffix: str) -> str:
    """Every attempt of a task writes files of its own name; only those that the finished
    attempt reports are read."""
    return f"{folder.rstrip('/')}/part-{part:06d}-{number:04d}-{uuid.uuid4().hex}{suffix}"


def write_bytes(path: str, parts: list) -> int:
    files, inner = filesystem(path)
    with files.open_output_stream(inner, compression=None) as out:
        for p in parts:
            out.write(p)
    return sum(memoryview(p).nbytes for p in parts)


def open_input(path: str):
    files, inner = filesystem(path)
    return files.open_input_file(inner)
