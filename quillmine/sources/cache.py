"""Responses kept by namespace and parameters, one file each, on any file system that driver and executors reach."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable

from pyarrow import fs


class ResponseCache:
    """Values are text.  One is expired when it is older than ``ttl`` seconds; reading it then deletes it."""

    def __init__(self, path: str, ttl: float | None = None, clock: Callable[[], float] = time.time):
        self.place, self.root = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        self.ttl, self.clock = ttl, clock

    def _where(self, namespace: str, params: str) -> str:
        return f"{self.root.rstrip('/')}/{namespace}/{hashlib.md5(f'{namespace}:{params}'.encode()).hexdigest()}.json"

    def _load(self, where: str) -> dict | None:
        if self.place.get_file_info(where).type != fs.FileType.File:
            return None
        with self.place.open_input_stream(where, compression=None) as f:
            return json.loads(f.read())

    def _expired(self, entry: dict) -> bool:
        return self.ttl is not None and self.clock() - entry["created_at"] > self.ttl

    def get(self, namespace: str, params: str) -> str | None:
        where = self._where(namespace, params)
        entry = self._load(where)
        if entry is not None and self._expired(entry):
            self.place.delete_file(where)
            return None
        return entry and entry["value"]

    def has(self, namespace: str, params: str) -> bool:
        return self.get(namespace, params) is not None

    def put(self, namespace: str, params: str, value: str) -> None:
        """A file of its own is written and then moved, so that no reader meets half of one."""
        where = self._where(namespace, params)
        self.place.create_dir(where.rpartition("/")[0], recursive=True)
        fresh = f"{where}.{uuid.uuid4().hex}"
        with self.place.open_output_stream(fresh, compression=None) as f:
            f.write(json.dumps({"value": value, "created_at": self.clock()}).encode())
        self.place.move(fresh, where)

    def clear(self, namespace: str | None = None, older_than: float | None = None) -> int:
        """Delete a namespace's entries or all, and of them those older than so many seconds; how many went."""
        folder, gone = self.root if namespace is None else f"{self.root.rstrip('/')}/{namespace}", 0
        for info in self.place.get_file_info(fs.FileSelector(folder, allow_not_found=True, recursive=True)):
            if info.type != fs.FileType.File or not info.path.endswith(".json"):
                continue
            if older_than is None or self.clock() - (self._load(info.path) or {"created_at": 0})["created_at"] > older_than:
                self.place.delete_file(info.path)
                gone += 1
        return gone
