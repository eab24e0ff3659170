"""Row-wise work on Arrow batches: given columns pass through unchanged, new ones are added."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

FEW = 512  # texts that a step holds as Python objects, where it takes them one by one

Make = Callable[[pa.RecordBatch], dict[str, list]]


def give_back() -> None:
    """Free memory of a task that ends goes back to the system, as its worker process lives on."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library is glibc
    if trim:
        trim(0)


def add_columns(rows: DataFrame, added: str, begin: Callable[[], Make], drop: tuple[str, ...] = (), most: int | None = None) -> DataFrame:
    """``rows`` without ``drop`` and with the columns ``added`` (a schema in DDL).

    ``begin`` is called once in each task; what it returns gets every batch, or its slices of
    ``most`` rows, and returns the new columns by name.
    """
    new = StructType.fromDDL(added)
    kept = [f for f in rows.schema if f.name not in drop]
    types = [(f.name, to_arrow_type(f.dataType)) for f in new]
    names = [f.name for f in kept] + new.names

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, most or max(batch.num_rows, 1)):
                yield batch.slice(start, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = None
        for batch in slices(batches):
            make = make or begin()
            made = make(batch)
            arrays = [batch.column(f.name) for f in kept]
            for name, kind in types:
                values = made[name]
                arrays.append(values if isinstance(values, pa.Array) else pa.array(values, kind))
            yield pa.RecordBatch.from_arrays(arrays, names)
        batch = make = made = arrays = values = None
        give_back()

    return rows.mapInArrow(run, StructType(kept + new.fields))
