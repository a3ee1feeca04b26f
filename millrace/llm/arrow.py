"""Arrow helpers: carried columns beside computed ones, byte-bounded batches."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Texts handed to one call of the worker code hold about this many bytes, or are one text.
CHUNK_BYTES = 1 << 20


def named_apart(columns: Iterable[str], results: Iterable[str]) -> list[str]:
    """The columns whose names none of the results takes (names are compared without case)."""
    taken = {r.lower() for r in results}
    return [c for c in columns if c.lower() not in taken]


def pieces(batch: pa.RecordBatch, weigh: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with about `limit` bytes in column `weigh`; long texts stand alone."""
    if not batch.num_rows:
        return
    sizes = pa.compute.binary_length(batch.column(batch.schema.get_field_index(weigh)))
    start, held = 0, 0
    for i, size in enumerate(sizes.to_pylist()):
        size = size or 0
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    yield batch.slice(start)


def release() -> None:
    """Give memory that a task no longer uses back to the machine; workers live on for other tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def released(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The task's code, after which what it held is freed first and then given back."""

    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        release()

    return run


def released_group(work: Callable) -> Callable:
    """The same for code that is called once per group."""

    def run(group):
        made = work(group)
        release()
        return made

    return run


def carry_map(
    df: DataFrame,
    start: Callable[[], Callable[[pa.RecordBatch], list]],
    inputs: dict[str, Column],
    results: T.StructType,
    carry: list[str],
    weigh: str,
) -> DataFrame:
    """One result row per row: carried columns unchanged, then what the worker code computes.

    `start()` runs once per task and returns the code that maps a slice with the columns of
    `inputs` to one Arrow array (or list) per result field. Carried columns that a result's name
    takes are left out.
    """
    carried = named_apart(carry, results.names)
    sent = df.select(
        *[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(carried)],
        *[c.alias(name) for name, c in inputs.items()],
    )
    fields = {f.name.lower(): f for f in df.schema.fields}
    out = T.StructType(
        [T.StructField(c, fields[c.lower()].dataType) for c in carried] + results.fields
    )
    names, n, shape = list(inputs), len(carried), to_arrow_schema(results)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            for part in pieces(batch, weigh):
                made = step(part.select(names))
                made = [
                    a if isinstance(a, pa.Array) else pa.array(a, type=f.type)
                    for a, f in zip(made, shape)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(n)] + made, names=carried + shape.names
                )

    return sent.mapInArrow(released(work), out)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]
