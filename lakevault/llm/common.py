"""Helpers shared by the text operators: staged tables, slices of batches, tables of distinct words."""
from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from lakevault.session import remove, run_folder

# A slice of a batch holds about so many text bytes (or one text), which bounds a task's memory.
SLICE_BYTES = 4 << 20
# A worker's table of distinct words is started anew when it holds so many words or characters.
CACHE_WORDS = 200_000
CACHE_CHARS = 16 << 20


# Lists that note the tables staged while they are here.
_noting: list[list[str]] = []


@contextmanager
def staged_paths() -> Iterator[list[str]]:
    """Note the folders of all tables that are staged inside the block."""
    paths: list[str] = []
    _noting.append(paths)
    try:
        yield paths
    finally:
        _noting.remove(paths)


def stage(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: it is computed once, and the lineage ends there."""
    path = run_folder(frame.sparkSession, f"llm-{label}")
    for paths in _noting:
        paths.append(path)
    frame.write.parquet(path)
    staged = frame.sparkSession.read.schema(frame.schema).parquet(path)
    staged.staged_at = path
    return staged


def unstage(*frames: DataFrame) -> None:
    """Delete staged tables that nothing will read any more."""
    for frame in frames:
        remove(frame.sparkSession, frame.staged_at)


# What a worker keeps from one task to the next, for one operator at a time.
_kept: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]) -> object:
    """An object that a worker keeps between the tasks of an operator. What another operator kept goes."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


def forget(name: str | None) -> None:
    """Drop what operators other than the named one have left in this worker."""
    if any(other != name for other in _kept):
        _kept.clear()
        give_back()


def give_back() -> None:
    """Hand free memory back to the machine: workers live on between tasks, and allocators hold on to what was freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], name: str | None = None) -> Callable:
    """``run`` for a worker that other operators use, too: what they kept goes before it, and what it freed afterwards."""

    def task(batches):
        forget(name)
        yield from run(batches)
        give_back()

    return task


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in order, in slices of about ``limit`` bytes of the column; no empty slice."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a slice; null counts as empty."""
    return [text or "" for text in batch.column(column).to_pylist()]


def sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of values; run k ends before ``ends[k]``, runs may be empty."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends] - total[np.concatenate([[0], ends[:-1]])]


class Codes(dict):
    """Numbers words from 0 in order of appearance and lists those seen for the first time."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []
        self.chars = 0

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        self.fresh.append(word)
        self.chars += len(word)
        return code


class WordTable:
    """Value lists of distinct words, each computed once; words repeat, so texts become lookups.

    ``compute`` gets the new words and returns all their values in a row and how many each has. A table that
    has outgrown its bounds is started anew and the full one kept for reference, so frequent words are not
    computed again; results never depend on what is remembered.
    """

    def __init__(self, compute: Callable, dtype=np.int32, words: int = CACHE_WORDS, chars: int = CACHE_CHARS):
        self.compute, self.dtype, self.words, self.chars = compute, dtype, words, chars
        self.codes = Codes()
        self.reset()

    def reset(self) -> None:
        none = np.empty(0, np.int64)
        self.older = (self.codes, self.flat, self.starts, self.lengths) if self.codes else ({}, np.empty(0, self.dtype), none, none)
        self.codes = Codes()
        self.flat = np.empty(0, self.dtype)
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)

    def encode(self, split: Callable[[str], list], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all words of the texts, and for each text where its codes end."""
        if len(self.codes) > self.words or self.codes.chars > self.chars:
            self.reset()
        look = self.codes.__getitem__
        parts = [np.fromiter(map(look, split(text)), np.int32) for text in texts]
        if self.codes.fresh:
            self.learn()
        return np.concatenate(parts) if parts else np.empty(0, np.int32), np.cumsum([len(part) for part in parts], dtype=np.int64)

    def learn(self) -> None:
        fresh, self.codes.fresh = self.codes.fresh, []
        seen, *values = self.older
        before = np.fromiter((seen.get(word, -1) for word in fresh), np.int64, len(fresh))
        known, unknown = np.flatnonzero(before >= 0), np.flatnonzero(before < 0)
        old, old_lengths = ragged(*values, before[known])
        new, new_lengths = self.compute([fresh[at] for at in unknown]) if len(unknown) else (old[:0], old_lengths[:0])
        # Values in the order of the codes.
        # (Of one type before they meet: numpy would turn signed and unsigned numbers into floats.)
        both, sizes = np.concatenate([old, np.asarray(new, self.dtype)]), np.concatenate([old_lengths, np.asarray(new_lengths, np.int64)])
        place = np.empty(len(fresh), np.int64)
        place[np.concatenate([known, unknown])] = np.arange(len(fresh))
        values, lengths = ragged(both, np.cumsum(sizes) - sizes, sizes, place)
        starts = len(self.flat) + np.cumsum(lengths) - lengths
        self.flat = np.concatenate([self.flat, values]).astype(self.dtype, copy=False)
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])

    def gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of all coded words in a row, and the number of values of each word."""
        return ragged(self.flat, self.starts, self.lengths, codes)


def rows_of(rows: list, dtype=np.int32) -> tuple[np.ndarray, np.ndarray]:
    """Values of all rows one after the other, and the rows' lengths."""
    return np.array([value for row in rows for value in row], dtype), np.fromiter(map(len, rows), np.int64, len(rows))


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate chosen rows of a ragged table; also their lengths."""
    counts = lengths[rows]
    before = np.cumsum(counts) - counts
    index = np.repeat(starts[rows] - before, counts)
    index += np.arange(len(index))
    return flat[index], counts


def lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from consecutive runs of values."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
