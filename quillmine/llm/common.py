"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Select ``new_name=existing_name`` columns; every other column is left behind.

    Columns whose names differ only in case, or that occur twice, do not disturb the choice:
    the first column with exactly the wanted name is taken.
    """
    names = df.columns
    if len({n.lower() for n in names}) < len(names):
        df = df.toDF(*[f"_{i}" for i in range(len(names))])
        return df.select(*[F.col(f"_{names.index(old)}").alias(new) for new, old in columns.items()])
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def tune(spark: SparkSession) -> None:
    """Keep Arrow batches small: texts can be very long, and workers hold a batch at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 << 20))
    except Exception:  # noqa: BLE001  a Spark without that setting
        pass


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only where it is unset and Spark runs in this process alone, as in tests, a temporary folder is made
    and set; on a cluster it would be each machine's own.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and the executors share")
        where = "file://" + tempfile.mkdtemp(prefix="quillmine-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


class _Made(threading.local):
    """The paths that this thread has made."""

    def __init__(self):
        self.paths: list[str] = []


_made = _Made()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    _made.paths.append(f"{shared_dir(spark)}/quillmine/{name}-{uuid.uuid4().hex}")
    return _made.paths[-1]


def _on_disk(spark: SparkSession, where: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def goes_with_driver(spark: SparkSession, where: str) -> None:
    """Have what was written to a scratch path deleted when the driver ends; frames may read it until then."""
    files, path = _on_disk(spark, where)
    files.deleteOnExit(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables that this thread makes inside are deleted at the end; for callers that write their
    result inside, since frames that are still to be computed may read them."""
    before = len(_made.paths)
    try:
        yield
    finally:
        for where in _made.paths[before:]:
            files, path = _on_disk(spark, where)
            files.delete(path, True)
        del _made.paths[before:]


def settle(df: DataFrame, name: str, compression: str = "uncompressed") -> DataFrame:
    """Write a frame to the shared folder and read it again: it is computed once, its lineage is cut,
    and a lost executor costs no more than the tasks that it ran.  Ids and hashes hardly compress;
    frames with texts should name a codec.  The table goes when the driver ends."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", compression).parquet(path)
    goes_with_driver(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(id_column: Column, divisor: int, remainder: int) -> Column:
    """Whether crc32 of the id as text has this remainder; false for a null id."""
    return F.coalesce(F.crc32(id_column.cast("string")) % divisor == remainder, F.lit(False))


def give_back() -> None:
    """Return what this worker has freed to the system; workers are used again and wait beside others."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def map_arrow(df: DataFrame, schema: str, f: Callable[[dict[str, pa.Array]], dict]) -> DataFrame:
    """mapInArrow with a function from one batch's columns to the result's columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(f(dict(zip(batch.schema.names, batch.columns, strict=True))))
        give_back()

    return df.mapInArrow(run, schema)


def small(df: DataFrame, most: int = 500_000) -> DataFrame:
    """A written frame of ids or hashes, marked for broadcast if it has at most ``most`` rows (some 40 MB)."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def by_size(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """A batch's rows in slices of at most ``most`` bytes of a text column, or of one row."""
    lengths, begin, held = pc.binary_length(batch.column(column)).fill_null(0).to_pylist(), 0, 0
    for i, n in enumerate(lengths):
        if i > begin and held + n > most:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += n
    if batch.num_rows:
        yield batch.slice(begin)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(column: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(column, UPPER, LOWER)
