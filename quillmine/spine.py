"""The spine: one table of papers in versioned Parquet folders, with row order kept in ``_pos``.

A commit writes a new folder and then a state file of the next number, which no other writer can have
made; the readable state of the largest number counts.  So readers never see half a write, a crash
leaves the state before it, and of two writers at once one fails.  Appends commit the old folders and a
new one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Writer options: small row groups and pages let readers skip, zstd suits XML and JSON text.
WRITER = {"compression": "zstd", "parquet.compression.codec.zstd.level": "3", "parquet.block.row.count.limit": "50000", "parquet.page.size": str(1 << 20)}
POS = "_pos"


KEPT = 10  # state files that stay


class ConcurrentCommit(RuntimeError):
    """Another writer has committed since the state was read."""


def with_positions(df: DataFrame, after: int = 0, hold: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The frame with ``_pos``: a row's place in the frame, from ``after`` on, without one task seeing all rows.

    Places follow from the sizes of partitions.  ``hold`` writes the frame and reads it again, so that it
    is computed once; without it, the frame must give the same partitions twice."""
    marked = df.withColumn("__id", F.monotonically_increasing_id()).withColumn("__part", F.shiftright("__id", 33))
    marked = hold(marked) if hold else marked
    sizes = marked.groupBy("__part").agg(F.count("*").alias("__n"))
    base = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))  # one row a partition
    starts = sizes.select("__part", F.coalesce(base, F.lit(0)).alias("__base"))
    placed = marked.join(F.broadcast(starts), "__part", "left")
    known = F.coalesce("__base", F.raise_error(F.lit("a partition has changed while its rows were numbered")).cast("long"))
    return placed.withColumn(POS, known + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)) + F.lit(after)).drop("__id", "__part", "__base")


def first_per_key(df: DataFrame, *keys: str, order: str = POS) -> DataFrame:
    """Of each key the row that stands first; dropDuplicates would keep any."""
    row = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("__row", row).where("__row = 1").drop("__row")


def upsert_columns(old: DataFrame, new: DataFrame, on: str = "pmid") -> DataFrame:
    """Columns of ``new`` by key, one row a key: nulls leave the old value, keys that ``old`` lacks are left out."""
    columns = [c for c in new.columns if c != on]
    joined = old.join(new.select(on, *[F.col(c).alias(f"__{c}") for c in columns]), on, "left")
    kept = [F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in old.columns]
    return joined.select(*kept, *[F.col(f"__{c}").alias(c) for c in columns if c not in old.columns])


def replace_columns(old: DataFrame, new: DataFrame, on: str = "pmid") -> DataFrame:
    """Columns of ``new`` by key in place of the old ones; keys that ``new`` lacks become null."""
    columns = [c for c in new.columns if c != on]
    return old.drop(*columns).join(new, on, "left").select(*old.columns, *[c for c in columns if c not in old.columns])


def remove_keys(df: DataFrame, keys: DataFrame, on: str = "pmid") -> DataFrame:
    return df.join(keys.select(on).distinct(), on, "left_anti")


def union_evolving(main: DataFrame, more: DataFrame) -> DataFrame:
    """Union by name: the main frame's columns first, what either lacks is null, numbers are widened."""
    return main.unionByName(more, allowMissingColumns=True)


class Spine:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _states(self) -> list[int]:
        """The numbers of the state files, the largest first."""
        folder = self._path(self.path)
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return sorted((int(n.removeprefix("_state-")) for n in names if n.removeprefix("_state-").isdigit()), reverse=True)

    def _read_state(self) -> tuple[dict, int]:
        """The state that counts and the largest number; a file that a crash cut short doesn't count."""
        numbers = self._states()
        for n in numbers:
            stream = self._fs.open(self._path(f"{self.path}/_state-{n}"))
            try:
                return json.loads(bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()), numbers[0]
            except ValueError:
                continue
            finally:
                stream.close()
        return {"main": [], "staging": []}, numbers[0] if numbers else 0

    def _read_pointer(self) -> dict:
        return self._read_state()[0]

    def _commit(self, since: int | None = None, **change) -> None:
        """Write the next state; with ``since``, fail if there is one of a larger number."""
        state, number = self._read_state()
        if since is not None and number != since:
            raise ConcurrentCommit(f"state {number} was committed after state {since} was read")
        where = self._path(f"{self.path}/_state-{number + 1}")
        try:
            stream = self._fs.create(where, False)
        except Exception as e:
            raise ConcurrentCommit(f"state {number + 1} exists already") from e
        stream.write(bytearray(json.dumps(state | change).encode()))
        stream.close()
        for old in self._states()[KEPT:]:
            self._fs.delete(self._path(f"{self.path}/_state-{old}"), False)

    def _placed(self, df: DataFrame, after: int = 0) -> str:
        """The folder of the rows with their positions."""
        held = f"{self.path}/rows-{uuid.uuid4().hex}"

        def hold(marked: DataFrame) -> DataFrame:
            marked.write.options(**WRITER).parquet(held)
            return self.spark.read.schema(marked.schema).parquet(held)

        try:
            return self._save(with_positions(df, after, hold))
        finally:
            self._fs.delete(self._path(held), True)

    def _save(self, df: DataFrame) -> str:
        folder = f"{self.path}/v-{uuid.uuid4().hex}"
        df.write.options(**WRITER).parquet(folder)
        return folder

    def _load(self, folders: list[str]) -> DataFrame | None:
        return self.spark.read.option("mergeSchema", "true").parquet(*folders) if folders else None

    def exists(self) -> bool:
        return bool(self._read_pointer()["main"])

    def table(self) -> DataFrame:
        found = self._load(self._read_pointer()["main"])
        if found is None:
            raise FileNotFoundError(f"no spine at {self.path}")
        return found

    def read(self, columns: list[str] | None = None, where=None) -> DataFrame:
        """The rows; unknown columns are passed over, unless none is known."""
        df = self.table()
        if where is not None:
            df = df.where(where)
        if columns is None:
            return df
        known = [c for c in columns if c in df.columns]
        if not known:
            raise ValueError(f"none of the columns exists: {columns}")
        return df.select(*known)

    def scan(self, columns: list[str]) -> DataFrame:
        """The rows; an unknown column is an error."""
        df = self.table()
        if missing := [c for c in columns if c not in df.columns]:
            raise ValueError(f"columns missing: {missing}")
        return df.select(*columns)

    def preview(self, columns: list[str], n: int = 10) -> DataFrame:
        return self.read(columns).limit(n)

    def count(self) -> int:
        return self.table().count() if self.exists() else 0

    def keys(self, staged: bool = True) -> DataFrame:
        """The distinct keys of main and staging rows."""
        state = self._read_pointer()
        folders = state["main"] + (state["staging"] if staged else [])
        df = self._load(folders)
        return df.select("pmid").distinct() if df is not None else self.spark.createDataFrame([], "pmid string")

    def inspect(self) -> dict:
        if not self.exists():
            return {"exists": False, "rows": 0, "columns": 0, "schema": {}, "size_mb": 0.0}
        df = self.table()
        size = sum(self._fs.getContentSummary(self._path(f)).getLength() for f in self._read_pointer()["main"])
        return {"exists": True, "rows": df.count(), "columns": len(df.columns), "schema": dict(df.dtypes), "size_mb": round(size / 1e6, 2)}

    def year_range(self) -> tuple[int | None, int | None]:
        """The least and the largest year, from the footers' statistics alone where Spark can use them."""
        pushed = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text"}
        before = {k: self.spark.conf.get(k, None) for k in pushed}
        for k, v in pushed.items():
            self.spark.conf.set(k, v)
        try:
            found = [self.spark.read.parquet(folder) for folder in self._read_pointer()["main"]]  # each with the schema of its own files
            ends = [tuple(df.agg(F.min("year"), F.max("year")).first()) for df in found if "year" in df.columns]
            known = [x for pair in ends for x in pair if x is not None]
            return (min(known), max(known)) if known else (None, None)
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)

    def write(self, df: DataFrame) -> None:
        since = self._read_state()[1]
        self._commit(since, main=[self._save(df) if POS in df.columns else self._placed(df)])

    def _next(self, folders: list[str]) -> int:
        """The position after the last of the folders' rows."""
        last = self._load(folders).agg(F.max(POS)).first()[0] if folders else None
        return 0 if last is None else last + 1

    def append(self, df: DataFrame) -> None:
        state, since = self._read_state()
        self._commit(since, main=[*state["main"], self._placed(df.drop(POS), self._next(state["main"]))])

    def append_staging(self, df: DataFrame) -> None:
        state, since = self._read_state()
        self._commit(since, staging=[*state["staging"], self._placed(df.drop(POS))])

    def merge_staging(self) -> int:
        """Staged rows go to the end of the main ones, in the order of their batches; the whole count.

        One commit takes all staged folders over, so a merge that breaks off has done nothing."""
        state, since = self._read_state()
        if state["staging"]:
            after, added = self._next(state["main"]), []
            for folder in state["staging"]:
                staged = self.spark.read.parquet(folder)
                added.append(self._save(staged.withColumn(POS, F.col(POS) + F.lit(after))))  # staged rows are numbered from 0
                after += staged.count()
            self._commit(since, main=[*state["main"], *added], staging=[])
        return self.count()

    def add_columns(self, new: DataFrame, on: str = "pmid") -> None:
        if new.groupBy(on).count().where("count > 1").limit(1).count():
            raise ValueError("a key occurs twice among the new values")
        self.write(upsert_columns(self.table(), new, on))

    def update_columns(self, new: DataFrame, on: str = "pmid") -> None:
        self.write(replace_columns(self.table(), new, on))

    def remove_rows(self, keys: DataFrame) -> int:
        before, left = self.count(), remove_keys(self.table(), keys)
        self.write(left)
        return before - self.count()

    def migrate(self) -> int:
        """Rewrite all rows in one folder with the writer's options; the old folders stay if the count differs."""
        since, df = self._read_state()[1], self.table()
        folder, count = self._save(df), df.count()
        if self.spark.read.parquet(folder).count() != count:
            raise RuntimeError("the rewritten spine has another number of rows")
        self._commit(since, main=[folder])
        return count


def storage(files: list[str]) -> dict:
    """Rows, row groups, columns, size and codecs of Parquet files, from their footers alone."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    out = {"rows": 0, "row_groups": 0, "size_bytes": 0, "columns": [], "codecs": set()}
    for uri in files:
        place, path = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
        with place.open_input_file(path) as f:
            meta = pq.ParquetFile(f).metadata
            out["rows"], out["row_groups"], out["size_bytes"] = out["rows"] + meta.num_rows, out["row_groups"] + meta.num_row_groups, out["size_bytes"] + f.size()
            out["columns"] = out["columns"] or meta.schema.to_arrow_schema().names
            out["codecs"] |= {meta.row_group(g).column(c).compression for g in range(meta.num_row_groups) for c in range(meta.num_columns)}
    return out | {"codecs": sorted(out["codecs"])}
