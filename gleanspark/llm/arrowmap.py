"""Row-aligned Arrow passes shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import zlib
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Characters of text that one slice holds at most, unless a single text is longer.
SLICE_CHARS = 4_000_000


def trim() -> None:
    """Gives memory that is free inside this worker back to the machine; workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that each piece has about `limit` bytes of `column`, one row at least."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    first, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > first and total + size > limit:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += size
    yield batch.slice(first)


def map_texts(
    df: DataFrame, keep: list[str], text: str, schema: str, start: Callable[[], Callable[[list], dict[str, Any]]]
) -> DataFrame:
    """Adds columns that a Python function makes of the texts, without a shuffle.

    `start()` runs once in each task and returns a function from a list of texts (None for null)
    to {column: values}. `keep` are the columns carried along; `schema` names all output columns,
    `keep` first. Other columns of `df`, whatever their names, are pruned before Python.
    """
    names = list(dict.fromkeys([*keep, text]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for part in slices(batch, text):
                made = work(part.column(text).to_pylist())
                columns = [part.column(k) for k in keep]
                yield pa.RecordBatch.from_arrays(
                    [*columns, *(v if isinstance(v, pa.Array) else pa.array(v) for v in made.values())], names=[*keep, *made]
                )
        del work
        trim()

    return df.select(*names).mapInArrow(run, schema)


def filter_rows(df: DataFrame, text: str, start: Callable[[], Callable[[list], list[bool]]]) -> DataFrame:
    """Keeps the rows whose text the function accepts; all columns stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accepts = start()
        for batch in batches:
            for part in slices(batch, text):
                yield part.filter(pa.array(accepts(part.column(text).to_pylist()), pa.bool_()))
        del accepts
        trim()

    return df.mapInArrow(run, df.schema)


def fresh(taken: list[str], names: list[str]) -> list[str]:
    """The names, each with as many underscores before it as it takes to be none of those taken."""
    lower, made = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in lower:
            name = f"_{name}"
        made.append(name)
    return made


def ascii_lower(text: str) -> str:
    """Lower-cases A-Z alone, so positions stay the same."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def crc32_of(value: Any) -> int:
    return zlib.crc32(str(value).encode())
