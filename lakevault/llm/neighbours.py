"""Nearest vectors by inner product with a permutation index.

A bounded sample of rows serves as pivots. A vector is represented by its nearest pivots in order; it is posted
under each of them with the pivot's rank. For a query only the postings of its own pivots are read: the footrule
distance of two such lists (pivots that one of them lacks count as just behind its end) falls with every pivot
they share, the more so the further ahead it stands in both. The vectors of smallest distance are reranked by
their exact inner product.

Lists tell directions apart, not lengths, but long vectors have large inner products. So a shard is cut into bands of
about equal length, each with an index and candidates of its own; a query goes through them from the longest on and
stops where a band's length times its own bounds all scores below those found.

The index is cut by vector into shards of about ``SHARD_ROWS`` rows; each task holds the postings of one shard at a
time and streams all queries past it, so memory does not grow with vectors or queries.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakevault.llm.common import empty, stage

PIVOTS, PREFIX = 256, 96
SHARD_ROWS = 20_000
# Candidates of a band that are reranked: a share of its rows, and a number at least.
SHARE, LEAST = 0.05, 1000
# The longest vector of a band is longer than the shortest by this factor at most.
BAND = 1.25
RESULT = "query_id long, rank int, vec_id long, score double"


def usable(vector: str) -> Column:
    """Neither null nor zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def permutations(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Numbers of each vector's nearest pivots, nearest first, ties to the smaller number."""
    found = np.empty((len(vectors), min(prefix, len(pivots))), np.int16)
    for start in range(0, len(vectors), 4096):
        near = -(vectors[start : start + 4096] @ pivots.T)
        found[start : start + 4096] = np.argsort(near, axis=1, kind="stable")[:, : found.shape[1]]
    return found


class Shard:
    """Postings of some vectors: rows by pivot, each with the pivot's rank for it."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, prefix: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        lists = permutations(self.vectors, pivots, prefix)
        self.prefix = lists.shape[1]
        flat = lists.reshape(-1)
        by_pivot = np.argsort(flat, kind="stable")
        self.rows = (by_pivot // self.prefix).astype(np.int64)
        self.ranks = (by_pivot % self.prefix).astype(np.int32)
        self.borders = np.searchsorted(flat[by_pivot], np.arange(len(pivots) + 1))

    def search(self, own: int, vector: np.ndarray, own_list: np.ndarray, wanted: int, candidates: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the nearest found, best first; rows with the query's own id are left out."""
        size = len(self.ids)
        shared = np.zeros(size, np.int64)
        for rank, pivot in enumerate(own_list.tolist()):
            part = slice(self.borders[pivot], self.borders[pivot + 1])
            # Footrule distance = constant - 2 * sum of this.
            shared[self.rows[part]] += self.prefix - np.maximum(self.ranks[part], rank)
        shared[self.ids == own] = -1
        # Equal distances: smaller ids first (rows are sorted by id).
        key = shared * size + np.arange(size - 1, -1, -1)
        rows = np.argpartition(key, size - candidates)[size - candidates :] if candidates < size else np.arange(size)
        rows = np.sort(rows[shared[rows] >= 0])
        scores = (self.vectors[rows] * vector).sum(1)
        best = np.lexsort((self.ids[rows], -scores))[:wanted]
        return self.ids[rows[best]], scores[best]


def norms(vectors: np.ndarray) -> np.ndarray:
    top = np.abs(vectors).max(1, keepdims=True)
    return top[:, 0] * np.sqrt(((vectors / top) ** 2).sum(1))


class Bands:
    """Shards of vectors of about equal length, the longest first, each with the length that none of it exceeds."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, prefix: int):
        lengths = norms(vectors)
        order = np.argsort(-lengths, kind="stable")
        self.bands, start = [], 0
        while start < len(order):
            end = int(np.searchsorted(-lengths[order], -lengths[order[start]] / BAND, side="right"))
            rows = order[start:end]
            self.bands.append((float(lengths[order[start]]), Shard(ids[rows], vectors[rows], pivots, prefix)))
            start = end

    def search(self, own: int, vector: np.ndarray, own_list: np.ndarray, wanted: int, share: float, least: int) -> tuple[np.ndarray, np.ndarray]:
        ids, scores = np.empty(0, np.int64), np.empty(0)
        length = float(norms(vector[None])[0])
        for longest, shard in self.bands:
            # (A little more than the bound, for rounding.)
            if len(ids) == wanted and scores[-1] > longest * length * (1 + 1e-9):
                break
            found = shard.search(own, vector, own_list, wanted, max(least, int(share * len(shard.ids)), wanted + 1))
            ids, scores = np.concatenate([ids, found[0]]), np.concatenate([scores, found[1]])
            best = np.lexsort((ids, -scores))[:wanted]
            ids, scores = ids[best], scores[best]
        return ids, scores


def nearest(vectors: DataFrame, queries: DataFrame, wanted: int = 20, pivots: int = PIVOTS, prefix: int = PREFIX, shard_rows: int = SHARD_ROWS, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """The ``wanted`` nearest rows of ``vectors`` found for each row of ``queries``: query_id, rank (from 1), vec_id, score.

    Both have vec_id and embedding (a list of numbers); other columns are not read. A query's own id is no
    candidate. Scores are inner products in double precision; ties go to the smaller id. Vectors that are null,
    zero, not finite or of another length than most take no part, nor do null ids; repeated rows count once.
    Without vectors or queries the result is empty; with fewer candidates than ``wanted`` a query gets them all.
    """
    spark = vectors.sparkSession
    # (Cast to double first: every given number is kept exactly.)
    plain = [F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")]
    rows = vectors.select(*plain).where(F.col("vec_id").isNotNull() & usable("embedding"))
    lengths = rows.groupBy(F.size("embedding").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if lengths is None:
        return empty(spark, RESULT)
    width = lengths["width"]
    rows = rows.where(F.size("embedding") == width)
    # Copies and multiples of a vector are one direction: they must not take each other's seats.
    scaled = rows.select(F.transform("embedding", lambda x: x / F.array_max(F.transform("embedding", F.abs))).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x))
    directions = scaled.select(F.transform("v", lambda x: F.round(x / norm, 6)).alias("v")).distinct()
    sample = directions.orderBy(F.xxhash64("v"), "v").limit(pivots).collect()
    anchors = np.array([row["v"] for row in sample])
    anchors /= np.sqrt((anchors**2).sum(1, keepdims=True))
    shards = max(1, -(-rows.count() // shard_rows))
    index = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), "vec_id", "embedding")
    asked = queries.select(*plain).where(F.col("vec_id").isNotNull() & usable("embedding") & (F.size("embedding") == width)).distinct()
    asked = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "vec_id", "embedding")
    # Each shard's vectors come before the queries.
    spread = index.unionByName(asked).repartition("shard").sortWithinPartitions("shard", "kind", "vec_id")

    def run(batches):
        current, shard, ids, parts = None, None, [], []

        def built():
            all_ids, all_vectors = np.concatenate(ids), np.concatenate(parts)
            keep = np.ones(len(all_ids), bool)  # rows come by id, so repeated ones stand together
            keep[1:] = (all_ids[1:] != all_ids[:-1]) | (all_vectors[1:] != all_vectors[:-1]).any(1)
            return Bands(all_ids[keep], all_vectors[keep], anchors, prefix)

        for batch in batches:
            if not batch.num_rows:
                continue
            number, kind = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            borders = np.flatnonzero(np.concatenate([[True], (number[1:] != number[:-1]) | (kind[1:] != kind[:-1])])).tolist()
            for start, end in zip(borders, [*borders[1:], batch.num_rows]):
                own, block = batch.column("vec_id").slice(start, end - start).to_numpy(), matrix(batch.column("embedding").slice(start, end - start), width)
                if number[start] != current:
                    current, shard, ids, parts = number[start], None, [], []
                if kind[start] == 0:
                    ids.append(own)
                    parts.append(block)
                    continue
                if not ids:
                    continue
                shard = shard or built()
                found = [shard.search(own[k], block[k], own_list, wanted, share, least) for k, own_list in enumerate(permutations(block, anchors, prefix))]
                asked = np.repeat(own, [len(part) for part, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked), pa.array(np.concatenate([part for part, _ in found])), pa.array(np.concatenate([scores for _, scores in found]))], ["query_id", "vec_id", "score"]
                )

    found = spread.mapInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted).select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, vectors: DataFrame, queries: DataFrame, wanted: int = 20) -> float:
    """Share of the true nearest that were found, with as many pivots read and candidates kept as there are rows (a scan of all)."""
    truth = nearest(vectors, queries, wanted, share=1.0)
    hit = truth.join(found.select("query_id", "vec_id"), ["query_id", "vec_id"], "left_semi").count()
    return hit / max(1, truth.count())
