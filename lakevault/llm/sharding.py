"""Shards of near-equal size by a histogram sort.

Rows get a key; shard k takes the keys between two splitters. Splitters are found without moving rows:

1. probe keys are drawn from the key ranges in which splitters still lie,
2. every task adds up the exact bytes and rows between probes; only these sums travel,
3. each splitter's range shrinks to the two probes around its target, until a probe meets the tolerance or
   one row alone lies between them.

A round narrows each range about ``PROBES`` times, so a few passes over the narrow keyed table suffice at any
size. Then rows are exchanged once, straight to where they belong. Keys are unique (the row's number in the
staged table comes last), so no group of equal texts, which sort next to each other, makes a shard too large. A splitter
inside a group moves to the nearer end of it, if the shard stays within a looser tolerance: groups are cut only where
sizes would suffer.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.llm.common import stage

# Probes for each open splitter and round.
PROBES = 32
# A shard is sorted in pieces of about so many rows, one task each.
PIECE_ROWS = 500_000


def _keys(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """Keys of a batch as byte strings that sort like the tuples of signed numbers they stand for."""
    columns = [batch.column(f"key{k}").to_numpy(zero_copy_only=False).view(np.uint64) ^ np.uint64(1 << 63) for k in range(width)]
    return np.ascontiguousarray(np.stack(columns, 1).astype(">u8")).view(f"S{8 * width}")[:, 0]


def _pad(keys: list[bytes], width: int) -> np.ndarray:
    return np.array([key.ljust(8 * width, b"\0") for key in keys], f"S{8 * width}")


def _histogram(keyed: DataFrame, probes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows below each probe, and of all rows at the end."""

    def count(batches):
        sizes, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            at = np.searchsorted(probes, _keys(batch, width), side="right")
            np.add.at(sizes, at, batch.column("size").to_numpy(zero_copy_only=False))
            rows += np.bincount(at, minlength=len(rows))
        used = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sizes[used]), pa.array(rows[used])], ["bin", "size", "n"])

    found = keyed.mapInArrow(count, "bin long, size long, n long").groupBy("bin").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).collect()
    sizes, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    for row in found:
        sizes[row["bin"]], rows[row["bin"]] = row["size"], row["n"]
    return np.cumsum(sizes), np.cumsum(rows)


def _candidates(keyed: DataFrame, ranges: list[tuple[bytes, bytes | None]], share: float, seed: int, width: int) -> np.ndarray:
    """Keys drawn from inside the ranges, about ``PROBES`` for each."""
    lows = _pad([low for low, _ in ranges], width)
    highs = np.array([b"\xff" * (8 * width + 1) if high is None else high.ljust(8 * width, b"\0") for _, high in ranges], f"S{8 * width + 1}")

    def inside(batches):
        for batch in batches:
            keys = _keys(batch, width)
            at = np.searchsorted(lows, keys, side="left") - 1  # the last range that begins below the key
            keep = (at >= 0) & (keys < highs[np.maximum(at, 0)])
            yield pa.RecordBatch.from_arrays([pa.array([key.ljust(8 * width, b"\0") for key in keys[keep].tolist()], pa.binary())], ["key"])

    drawn = keyed if share >= 1 else keyed.sample(share, seed)
    return np.unique(_pad([bytes(row["key"]) for row in drawn.mapInArrow(inside, "key binary").collect()], width))


def splitters(keyed: DataFrame, parts: int, tolerance: float, width: int) -> tuple[list[bytes], list[int]]:
    """Keys at which parts 1, 2, … begin, and the exact rows below each.

    ``keyed`` holds key0, key1, … and size. A splitter is off by at most ``tolerance`` of a part's bytes, or by
    half of the one row that straddles its target.
    """
    zero = b"\0" * (8 * width)
    sizes, rows = _histogram(keyed, _pad([], width), width)
    total, count = int(sizes[-1]), int(rows[-1])
    targets = [total * k / parts for k in range(1, parts)]
    low = [(zero, 0, 0)] * len(targets)  # key, bytes below, rows below
    high: list[tuple] = [(None, total, count)] * len(targets)
    open_, seed = set(range(len(targets))) if count else set(), 1
    while open_:
        ranges = sorted({(low[k][0], high[k][0]) for k in open_})
        left = sum({(low[k][0]): high[k][2] - low[k][2] for k in open_}.values())
        wanted = PROBES * len(open_)
        probes = _candidates(keyed, ranges, 1.0 if left <= 2 * wanted else min(1.0, wanted / left), seed, width)
        seed += 1
        if not len(probes):
            continue
        sizes, rows = _histogram(keyed, probes, width)
        padded = [key.ljust(8 * width, b"\0") for key in probes.tolist()]
        for k in list(open_):
            at = int(np.searchsorted(sizes[:-1], targets[k], side="right"))
            if at and sizes[at - 1] >= low[k][1]:
                low[k] = max(low[k], (padded[at - 1], int(sizes[at - 1]), int(rows[at - 1])))
            if at < len(probes) and (high[k][0] is None or padded[at] < high[k][0]):
                high[k] = (padded[at], int(sizes[at]), int(rows[at]))
            nearest = min(abs(low[k][1] - targets[k]), abs(high[k][1] - targets[k]))
            if nearest <= tolerance * total / parts or high[k][2] - low[k][2] <= 1:
                open_.discard(k)
    last = b"\xff" * (8 * width)
    chosen = [min(low[k], high[k], key=lambda end: abs(end[1] - targets[k])) for k in range(len(targets))]
    return [last if key is None else key for key, _, _ in chosen], [below for _, _, below in chosen]


def to_group_borders(keyed: DataFrame, found: list[bytes], below: list[int], group: int, tolerance: float, width: int) -> tuple[list[bytes], list[int]]:
    """The splitters with those moved to an end of their group that are off there by at most ``tolerance`` of a part's bytes.

    A group are the rows that agree in the first ``group`` keys. One more pass counts the exact bytes below the ends.
    """
    ends = []
    for key in found:
        number = int.from_bytes(key.ljust(8 * width, b"\0")[: 8 * group], "big")
        after = min(number + 1, 2 ** (64 * group) - 1)
        ends.append([value.to_bytes(8 * group, "big") + b"\0" * (8 * (width - group)) for value in (number, after)])
    probes = np.unique(_pad([end for pair in ends for end in pair], width))
    sizes, rows = _histogram(keyed, probes, width)
    place = {key.ljust(8 * width, b"\0"): at for at, key in enumerate(probes.tolist())}
    parts, total = len(found) + 1, int(sizes[-1])
    moved, counts = list(found), list(below)
    for k, pair in enumerate(ends):
        target = total * (k + 1) / parts
        end = min(pair, key=lambda end: abs(int(sizes[place[end]]) - target))
        if abs(int(sizes[place[end]]) - target) <= tolerance * total / parts:
            moved[k], counts[k] = end, int(rows[place[end]])
    return moved, counts


def shard(
    frame: DataFrame, size: Column, keys: list[Column], shards: int = 40, tolerance: float = 0.002, piece_rows: int = PIECE_ROWS,
    group: int = 0, group_tolerance: float = 0.02,
) -> DataFrame:
    """All rows and columns of ``frame`` with size, shard (0 to shards-1) and slot (gapless from 0 in key order).

    ``keys`` are long columns that give the order (nulls first); shards get near-equal sums of ``size``
    (positive or zero longs, null is zero). Rows that agree in the first ``group`` keys stay in one shard where the sizes then
    are off by at most ``group_tolerance`` of a shard. Rows that agree in all keys are ordered as the staged copy has
    them. An empty frame gives an empty result; with fewer rows than shards some shards stay empty. Columns of
    the frame called size, shard, slot or key0, key1, … are replaced.
    """
    width = len(keys) + 1
    mine = {"size", "shard", "slot", "piece", "before"} | {f"key{k}" for k in range(width)}
    kept = [F.col(f"`{name}`") for name in frame.columns if name not in mine]
    lowest = F.lit(-(2**63))
    numbered = [F.coalesce(key.cast("long"), lowest).alias(f"key{k}") for k, key in enumerate(keys)]
    numbered.append(F.monotonically_increasing_id().alias(f"key{width - 1}"))
    keyed = stage(frame.select(*kept, F.coalesce(size.cast("long"), F.lit(0)).alias("size"), *numbered), "shards")
    names = [f"key{k}" for k in range(width)]
    narrow = keyed.select(*names, "size")
    rows = narrow.count()
    pieces = max(1, -(-rows // (shards * piece_rows)))
    keys_, below = splitters(narrow, shards * pieces, tolerance / pieces, width)
    if group and keys_ and rows:
        keys_, below = to_group_borders(narrow, keys_, below, group, group_tolerance / pieces, width)
    cuts = _pad(keys_, width)
    starts = np.array([0, *below], np.int64)
    starts -= starts[np.arange(len(starts)) // pieces * pieces]

    def place(batches):
        for batch in batches:
            piece = np.searchsorted(cuts, _keys(batch, width), side="right")
            more = [pa.array(piece.astype(np.int32)), pa.array((piece // pieces).astype(np.int32)), pa.array(starts[piece])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "piece", "shard", "before"])

    schema = T.StructType([*keyed.schema, T.StructField("piece", T.IntegerType()), T.StructField("shard", T.IntegerType()), T.StructField("before", T.LongType())])
    placed = keyed.mapInArrow(place, schema)
    order = Window.partitionBy("piece").orderBy(*names)
    return placed.withColumn("slot", F.row_number().over(order) - 1 + F.col("before")).drop("piece", "before", *names)
