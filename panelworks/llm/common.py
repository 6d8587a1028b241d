"""Helpers shared by the operators: staging, shipping code to workers, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelworks.session import ship
from panelworks.session import stored as stage

__all__ = [
    "ARRAY_BYTES",
    "BYTES",
    "FACTOR",
    "SLICE_BYTES",
    "SPACES",
    "WORDS",
    "batch",
    "map_batches",
    "merged",
    "mix",
    "powers",
    "ship",
    "slices",
    "stage",
    "text_key",
    "utf8",
    "word_table",
]

# White space that separates words, and the words between (fixed by the queries' contract).
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"

# Bytes of text a worker turns into arrays at once; a longer document is a slice of its own.
SLICE_BYTES = 1 << 20
# The same where there are several 64-bit numbers per byte.
ARRAY_BYTES = 1 << 18


def map_batches(df: DataFrame, function, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with this package shipped to the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def text_key(text: Column) -> Column:
    """Tells the rows of one id, or without an id, apart by their texts."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``limit`` bytes in each; no row is cut."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        upto = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = upto[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(upto, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts of a string column as UTF-8 bytes."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    arrays = [
        x if isinstance(x, pa.Array) else pa.array(x, schema.field(name).type)
        for name, x in ((f.name, columns[f.name]) for f in schema)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (the constants are those of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# An odd factor for polynomial hashes modulo 2 ** 64, and what each byte counts in them.
FACTOR = np.uint64(0x9E3779B97F4A7C15)
BYTES = mix(np.arange(1, 257, dtype=np.uint64) * FACTOR)
_powers: list[np.ndarray] = []


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of :data:`FACTOR` and of its inverse modulo 2 ** 64."""
    if not _powers or len(_powers[0]) < size:
        _powers.clear()
        for factor in (int(FACTOR), pow(int(FACTOR), -1, 1 << 64)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers.append(np.cumprod(steps))
    return _powers[0][:size], _powers[1][:size]


_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def word_table(texts: list[bytes | None]):
    """(raw, base, sizes, begin, end, hashes) of the words of a list of texts.

    ``raw`` holds the texts with a line end after each, ``base`` and ``sizes`` where they are;
    ``begin`` and ``end`` are the places of the words in it, ``hashes`` a 64-bit hash of each
    word with A-Z lower-cased.
    """
    whole = b"\n".join([text or b"" for text in texts]) + b"\n"
    sizes = np.array([len(text or b"") for text in texts], np.int64)
    base = np.cumsum(sizes + 1) - sizes - 1
    raw = np.frombuffer(whole, np.uint8)
    space = _SPACE[raw]
    begin = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    end = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    up, down = powers(len(raw) + 1)
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTES[_LOWER[raw]] * up[: len(raw)])])
    hashes = mix((upto[end] - upto[begin]) * down[begin])
    return raw, base, sizes, begin, end, hashes


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges [start, end) in ascending order, those that meet joined."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out
