"""Batches of whole texts as flat Arrow and numpy arrays.

A word or chunk that occurs often in a batch is looked at once: texts are split in Arrow, the pieces are
dictionary-encoded, and results of the distinct pieces are spread by their codes.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

SLICE_BYTES = 6 << 20
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back():
    """Hands free memory back to the system: workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def parts(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """The batch in runs of rows with about `limit` bytes of text each; a longer text is a run of its own."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(size) - size) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)
            give_back()


def strings(array: pa.Array) -> pa.Array:
    """The texts of a batch; null is the empty text."""
    return pc.fill_null(array.cast(pa.string()), "")


def coded(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(offsets, codes, values): piece j of text i is values[codes[offsets[i] + j]]; empty pieces go."""
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().dictionary_encode()
    codes, values = flat.indices.to_numpy(zero_copy_only=False), flat.dictionary
    empty = pc.index(values, "").as_py()
    if empty >= 0:
        keep = codes != empty
        counts = np.add.reduceat(np.append(keep, False), np.append(0, np.cumsum(counts))[:-1], dtype=np.int64) * (counts > 0)
        codes = codes[keep]
    return np.append(0, np.cumsum(counts)), codes, values


def words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The words between ASCII white space, as `coded` gives them; `lower` changes A-Z only."""
    return coded(pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts))


def spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions start[i], start[i] + 1, ... for length[i] places, one run after the other."""
    ends = np.cumsum(length)
    return np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0, dtype=start.dtype)


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under names of our own: `picked(df, key="doc_id")`. Others cannot clash."""
    return df.select(*[F.col(f"`{name}`").alias(own) for own, name in columns.items()])


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as no column of `df` has (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
        taken.add(name.lower())
    return out


def folds(key: Column) -> Column:
    """The remainder of the crc32 of the key's text, 0 to 2."""
    return F.crc32(key.cast("string").cast("binary")) % 3


def few(df: DataFrame, key: Column, count: int) -> DataFrame:
    """At most `count` rows, the first by the hash of `key`, without many times as many going to the driver.

    A share of the hashes, sized by the number of rows, is sorted; it holds `count` rows but for odd luck.
    """
    share = min(1.0, 1.2 * count / max(df.count(), 1) + 1e-6)
    place = F.pmod(F.xxhash64(key), F.lit(1_000_000_007))
    return df.filter(place < int(share * 1_000_000_007) + 1).orderBy(place, key).limit(count)
