"""Small text files on any file system that pyarrow knows: a path is local unless it names a scheme."""

from __future__ import annotations

import uuid

from pyarrow import fs


def place_of(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def read_text(path: str) -> str | None:
    """The file's text, or None if there is none."""
    place, where = place_of(path)
    if place.get_file_info(where).type != fs.FileType.File:
        return None
    with place.open_input_stream(where, compression=None) as f:
        return f.read().decode()


def write_text(path: str, text: str) -> None:
    """Written beside and then moved, so that no reader meets half of it."""
    place, where = place_of(path)
    place.create_dir(where.rpartition("/")[0] or ".", recursive=True)
    fresh = f"{where}.{uuid.uuid4().hex}"
    with place.open_output_stream(fresh, compression=None) as f:
        f.write(text.encode())
    place.move(fresh, where)


def names(folder: str) -> list[str]:
    place, where = place_of(folder)
    return sorted(i.base_name for i in place.get_file_info(fs.FileSelector(where, allow_not_found=True)))
