"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space, the only characters that separate words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
Batches = Iterator[pa.RecordBatch]


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    return f"_{stem}_{uuid.uuid4().hex[:12]}"


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the whole text (null: empty) of every row; other columns are left out."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and all other letters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_OTHER_SPACES = str.maketrans(dict.fromkeys(SPACES, " "))


def lower_words(text: str) -> list[str]:
    """Words between ASCII white space of the text, with A-Z in lower case."""
    if text.isascii():
        words = text.lower().split()
        # str.split also cuts at U+001C to U+001F, which are no white space here.
        if not any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return words
    return [w for w in text.translate(_LOWER).translate(_OTHER_SPACES).split(" ") if w]


def list_array(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    """An Arrow list column from concatenated values and the length of each row."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def bounds(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """First and last position of stretches of about ``size`` bytes of text, one text at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield start, stop
        start = stop


_TRIM = None
with suppress(OSError, TypeError):  # not every system's C library has it
    _TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return to the system what this process has freed: Spark goes on using a worker, stage after stage, which would else keep the peaks of them all."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def in_slices(batches: Batches, size: int = 8_000_000) -> Batches:
    """The same rows in batches of about ``size`` bytes of text, to bound a worker's memory.

    What the slices of a batch took is given back before the next one comes.
    """
    for batch in batches:
        for start, stop in bounds(batch.column("text"), size):
            yield batch.slice(start, stop - start)
        del batch
        give_back()


def split_words(texts: pa.Array) -> pa.Array:
    """Lists of what stands between the ASCII white space of each text, empty strings included.

    Arrow's own split at white space depends on the locale and can cut a letter in two.
    """
    for space in SPACES[1:]:
        texts = pc.replace_substring(texts, space, SPACES[0])
    return pc.split_pattern(texts, SPACES[0])


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of the texts, one text after the other, and each text's number of words.

    Words are what stands between ASCII white space, with A-Z in lower case.
    """
    # Lower case first: Arrow's ascii_lower misplaces slices of large strings.
    words = split_words(pc.ascii_lower(texts).cast(pa.large_string()))
    offsets = words.offsets.to_numpy()
    flat = words.flatten()
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(real)])
    per_text = before[offsets[1:] - offsets[0]] - before[offsets[:-1] - offsets[0]]
    coded = flat.filter(pa.array(real)).dictionary_encode()
    known = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
    return known[coded.indices.to_numpy()] if len(known) else known, per_text


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads all bits (multiply and shift, twice)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
