"""Column expressions and byte-level word splitting that several operators share."""

from __future__ import annotations

import ctypes
import string
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, StructField, StructType

# Space and the controls \x09-\x0D; fixed by the contracts.
BLANKS = " \t\n\x0b\x0c\r"
BATCH_BYTES = 4 << 20


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z, and only these, in lower case."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

IS_BLANK = np.zeros(256, dtype=bool)
IS_BLANK[[32, 9, 10, 11, 12, 13]] = True

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_PLACE = _RNG.integers(0, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def release_memory() -> None:
    """Give free memory back to the system; Python workers live on for other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_pieces(batch: pa.RecordBatch, name: str = "text", most: int = BATCH_BYTES
                ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into row slices of about ``most`` text bytes: (rows, bytes, row offsets).

    A null text has no bytes. One row is never cut, so a slice holds at least one row.
    """
    col = batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary())
    col = col.fill_null(b"") if col.null_count else col
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset: col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(col):
        end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        end = min(max(end, at + 1), len(col))
        yield (batch.slice(at, end - at), raw[offsets[at]: offsets[end]],
               (offsets[at: end + 1] - offsets[at]).astype(np.int64))
        at = end


def word_spans(raw: np.ndarray, offsets: np.ndarray, apart: np.ndarray,
               cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte ranges of words and, per row, the number of words before it.

    ``apart`` marks the byte values that separate words; a row's end ends a word too, and so
    does each position in ``cuts``.
    """
    inside = np.zeros(len(raw) + 2, dtype=bool)
    np.logical_not(apart[raw], out=inside[1:-1])
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offsets] = True
    if cuts is not None:
        edge[cuts] = True
    starts = np.flatnonzero(inside[1:] & (edge | ~inside[:-1]))
    ends = np.flatnonzero(inside[:-1] & (edge | ~inside[1:]))
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range; ranges are in order and do not overlap."""
    lens = ends - starts
    if not len(lens):
        return np.zeros(0, dtype=np.uint64)
    first = np.zeros(len(lens), dtype=np.int64)
    np.cumsum(lens[:-1], out=first[1:])
    place = np.arange(int(lens.sum()), dtype=np.int64)
    where = place + np.repeat(starts - first, lens)
    place -= np.repeat(first, lens)
    value = _BYTE[raw[where]]
    if int(lens.max()) > 4096:
        value = mix64(value + (place >> 12).astype(np.uint64))
    value *= _PLACE[place & 4095]
    return mix64(np.add.reduceat(value, first) ^ (lens.astype(np.uint64) << np.uint64(40)))


def code_points(raw: np.ndarray) -> np.ndarray:
    """Code points of UTF-8 bytes."""
    return np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"),
                         dtype=np.uint32)


def add_columns(docs: DataFrame, added: Mapping[str, DataType], work, text: str = "text",
                most: int = BATCH_BYTES) -> DataFrame:
    """``docs`` with columns computed in Python from slices of whole texts.

    ``work(rows, raw, offsets)`` gets a slice as an Arrow batch, the bytes of its texts and
    their row offsets, and returns one Arrow array per added column. Columns of the added names
    are replaced, all others are kept; rows move through in batches, without a shuffle.
    """
    keep = [f for f in docs.schema.fields if f.name not in added]
    at = next(i for i, f in enumerate(docs.schema.fields) if f.name == text)
    inner = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)])
    passed = [i for i, f in enumerate(docs.schema.fields) if f.name not in added]
    types = list(added.values())
    out = StructType([inner.fields[i] for i in passed] + [StructField(f"a{i}", t) for i, t in enumerate(types)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw, offsets in text_pieces(batch, f"c{at}", most):
                arrays = [rows.column(i) for i in passed] + list(work(rows, raw, offsets))
                yield pa.RecordBatch.from_arrays(arrays, names=out.fieldNames())
        release_memory()

    named = docs.toDF(*inner.fieldNames())
    return named.mapInArrow(run, out).toDF(*[f.name for f in keep], *added)


def keep_where(docs: DataFrame, mark, condition: str, needed: tuple[str, ...]) -> DataFrame:
    """The rows for which ``condition`` holds on columns that ``mark`` adds, otherwise unchanged.

    Columns but the ``needed`` ones go by other names meanwhile, so none can clash.
    """
    names = [c if c in needed else f"_c{i}" for i, c in enumerate(docs.columns)]
    return mark(docs.toDF(*names)).where(condition).select(*names).toDF(*docs.columns)
