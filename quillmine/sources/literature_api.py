"""A literature API as a Spark data source: each window of a query's results is a partition.

The transport is a function that the caller names, so the source can be run without a network
(``quillmine.sources.eutils:call`` is one over HTTP).  A transport takes

* ("search", term, start_date, end_date) and gives a count, or a session: {count, web_env, query_key},
* ("ids", term, start_date, end_date, start, size) and gives a list of ids,
* ("fetch", term, start_date, end_date, start, size) and gives a batch's XML,
* ("fetch_ids", ids) and gives their XML.

A day with more results than may be paged through is fetched by its ids.  Answers can be kept in a cache.
A window that fails for good gives a row with an error in place of data, for the caller to count.
"""

from __future__ import annotations

import importlib
import json
import random
import time
from collections.abc import Callable, Iterator
from datetime import date

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quillmine.plans.fetch import LIMIT, id_chunks, plan_queries
from quillmine.sources.cache import ResponseCache

# The formats that the API gives for each mode.
FORMATS = {"xml": {"abstract", "medline", "full", ""}, "text": {"abstract", "medline", "uilist", ""}, "json": {"uilist", ""}}
RETRY = {408, 429, 500, 502, 503, 504}


class TransportError(Exception):
    def __init__(self, status: int, message: str = ""):
        super().__init__(f"{status} {message}")
        self.status = status


def check_format(mode: str, kind: str) -> None:
    if mode not in FORMATS or kind not in FORMATS[mode]:
        raise ValueError(f"no format {kind!r} in mode {mode!r}")


def transport(name: str) -> Callable:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


class RateLimit:
    """At most ``rate`` calls a second, evenly spaced after a first burst of ``rate``."""

    def __init__(self, rate: float, clock=time.monotonic, sleep=time.sleep):
        self.rate, self.clock, self.sleep, self.left, self.at = rate, clock, sleep, rate, clock()

    def wait(self) -> None:
        now = self.clock()
        self.left, self.at = min(self.rate, self.left + (now - self.at) * self.rate), now
        if self.left < 1:
            self.sleep((1 - self.left) / self.rate)
            self.left, self.at = 1.0, self.clock()
        self.left -= 1


def with_retries(call: Callable, *args, tries: int = 5, sleep=time.sleep, retry: set[int] = RETRY):
    """Try again after passing errors, waiting longer each time; other errors are raised at once."""
    for n in range(tries):
        try:
            return call(*args)
        except TransportError as e:
            if e.status not in retry or n == tries - 1:
                raise
        except (ConnectionError, TimeoutError):
            if n == tries - 1:
                raise
        sleep(min(60.0, 2.0**n + random.random()))


_limiters: dict[float, RateLimit] = {}


def limiter(rate: float) -> RateLimit:
    """The limiter of this process, which all windows that it reads share."""
    return _limiters.setdefault(rate, RateLimit(rate))


def list_ids(call: Callable, term: str, start: date, end: date, total: int, page: int = LIMIT) -> list[str]:
    """The ids of a query's results, page by page."""
    return [i for at in range(0, total, page) for i in with_retries(call, "ids", term, start, end, at, min(page, total - at))]


class Window(InputPartition):
    def __init__(self, term: str, start: date, end: date, at: int, size: int, batch: str, ids: list[str] | None = None):
        self.term, self.start, self.end, self.at, self.size, self.batch, self.ids = term, start, end, at, size, batch, ids


class Reader(DataSourceReader):
    def __init__(self, options):
        self.options = options
        self.size = int(options.get("batch", 200))
        check_format(options.get("mode", "xml"), options.get("type", ""))

    def _call(self) -> Callable:
        """The transport with retries, behind the cache if there is one."""
        call = transport(self.options["transport"])
        if not self.options.get("cache"):
            return lambda *args: with_retries(call, *args)
        kept = ResponseCache(self.options["cache"], float(self.options["ttl"]) if self.options.get("ttl") else None)

        def cached(kind: str, *args):
            key = json.dumps([self.options["transport"], *args], default=str)
            if (held := kept.get(kind, key)) is not None:
                return json.loads(held)
            answer = with_retries(call, kind, *args)
            kept.put(kind, key, json.dumps(answer))
            return answer

        return cached

    def partitions(self) -> list[InputPartition]:
        call, term = self._call(), self.options["term"]

        def count(a: date, b: date) -> int:
            found = call("search", term, a, b)
            return int(found["count"] if isinstance(found, dict) else found)

        start, end = (date.fromisoformat(self.options[k]) for k in ("start", "end"))
        out = []
        for n, (a, b, total) in enumerate(plan_queries(start, end, count)):
            if total > LIMIT:  # a single day
                chunks = id_chunks(list_ids(call, term, a, b, total), self.size)
                out += [Window(term, a, b, k, len(ids), f"{n}_{k}", ids) for k, ids in enumerate(chunks)]
            else:
                out += [Window(term, a, b, at, self.size, f"{n}_{k}") for k, at in enumerate(range(0, total, self.size))]
        return out

    def read(self, window: Window) -> Iterator[tuple]:
        limiter(float(self.options.get("rate", 3)) / max(1, int(self.options.get("readers", 1)))).wait()
        data, error = None, None
        try:
            data = self._call()(*(("fetch_ids", window.ids) if window.ids else ("fetch", window.term, window.start, window.end, window.at, window.size)))
        except (TransportError, ConnectionError, TimeoutError) as e:
            error = f"{type(e).__name__}: {e}"
        yield f"{window.term} {window.start}:{window.end}", window.batch, window.at, window.size, self.options.get("timestamp", ""), data, error


class LiteratureSource(DataSource):
    """spark.dataSource.register(LiteratureSource); spark.read.format("literature").option(...).load()"""

    @classmethod
    def name(cls) -> str:
        return "literature"

    def schema(self) -> str:
        return "query string, batch_id string, retstart long, retmax long, timestamp string, data string, error string"

    def reader(self, schema) -> Reader:
        return Reader(self.options)
