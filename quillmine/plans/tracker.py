"""What a driver-side job has done already, in a JSON file, for small jobs outside the spine."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from itertools import islice

from quillmine.files import read_text, write_text


def batched(items: Iterable, size: int) -> Iterator[list]:
    if size < 1:
        raise ValueError("a batch has at least one item")
    it = iter(items)
    while batch := list(islice(it, size)):
        yield batch


class Processed:
    """Ids that are done; saved whole, by replacing the file."""

    def __init__(self, path: str):
        self.path, self.ids = path, set(json.loads(read_text(path) or "[]"))

    def left(self, ids: Iterable[str]) -> list[str]:
        return [i for i in ids if i not in self.ids]

    def done(self, ids: Iterable[str]) -> None:
        self.ids |= set(ids)
        write_text(self.path, json.dumps(sorted(self.ids)))
