"""Row functions that Catalyst can't express, run on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def with_columns(df: DataFrame, source: list[str], added: str, f: Callable[..., tuple]) -> DataFrame:
    """The frame with columns that ``f`` makes, a row at a time, of the ``source`` columns.

    ``added`` is their schema.  Batches stay small, since cells such as XML are wide; all other
    columns pass through as Arrow data, untouched.  Columns of the same names are replaced.
    """
    new = StructType.fromDDL(added)
    names = [n.name for n in new]
    held = df.drop(*[n for n in names if n not in source])
    keep = [c for c in held.columns if c not in names]
    schema = ", ".join([f"`{c}` {held.schema[c].dataType.simpleString()}" for c in keep] + [f"`{n.name}` {n.dataType.simpleString()}" for n in new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(n.dataType) for n in new]
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                made = [f(*row) for row in zip(*[part.column(c).to_pylist() for c in source], strict=True)]
                columns = list(zip(*made, strict=True)) if made else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], *[pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]], [*keep, *names])

    return held.mapInArrow(run, schema)
