"""Groups of documents whose sets of word shingles are similar: an exact Jaccard self-join by prefix filtering.

A node is a set, named by a 64-bit digest of its shingles; texts with the same set are one node from the start. Shingles
are ordered rarest first, by how often they occur in the corpus (counted by hash bucket; one order for all documents, so
results do not depend on it). Two sets of the wanted similarity share one of the first n - ceil(t n) + 1 shingles of each;
only these are exchanged. A pair that meets at a shingle goes on if

* length: the smaller set is at least t times the larger,
* position: the shingles left behind the meeting point can still make up the overlap,
* signature: bits that say of which hash classes a set holds an odd number differ in no more places than the sets may
  have members apart,

and is verified once, in the exchanged texts: first by the suffix filter (halves around a pivot bound the
overlap), then by counting the overlap.

Connected groups need not all their pairs. Each shingle's sets meet one leader per band of lengths, and each set is compared
with the leader that it shares most shingles with. Then those outside a shingle's largest component meet the member of it
whose signature is nearest to theirs, and each is compared with the one that it met most often, until that links little
more. Last, each shingle's sets of
*different* components are compared with each other, which is complete: what it leaves out is connected already.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakevault.llm.common import lean, slices, stage, unstage
from lakevault.llm.components import components
from lakevault.llm.shingles import by_row, mix, windows

# Hash buckets in which shingles are counted for the order; 8 MB in every task, whatever the input.
BUCKETS, PARTS = 1 << 21, 16
SHIFT = np.uint64(64 - 21)
COUNTED = 1 << 19  # shingles that are added to the buckets at once
# Counts become ranks of 16 bits on a logarithmic scale.
LOG_STEPS = 2047
SIGNATURE_BITS = 1024
NEAR = 64  # members of a component whose signatures a set outside is held against
FEW = 8  # sets of a shingle whose pairs are all looked at, however many components they are of
FADED = 32  # a round of single pairs is the last one if it links less than this part of what another one did
MEMBERS = 256  # sets that meet one copy of a leader's text
REMEMBERED = 1 << 18  # digests of sets that a task remembers, so as not to post them again


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, sorted."""
    return [np.unique(windows(found, size)) for found in by_row(column)]


def digest(found: np.ndarray) -> int:
    """What names a set: the sum of its mixed shingle hashes, as a signed number."""
    return int(mix(found).sum(dtype=np.uint64).astype(np.int64)) if len(found) else 0


def signature(found: np.ndarray) -> bytes:
    """For each class of hashes, whether the set has an odd number of members in it."""
    classes = (found >> np.uint64(20)) & np.uint64(SIGNATURE_BITS - 1)
    return np.packbits((np.bincount(classes.astype(np.int64), minlength=SIGNATURE_BITS) & 1).astype(bool)).tobytes()


def rarest_first(found: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """A sorted set of shingle hashes with the rarest first, equally rare ones by hash."""
    return found[np.argsort(ranks[(found >> SHIFT).astype(np.int64)], kind="stable")]


def needed(total: np.ndarray | int, percent: int):
    """Smallest overlap of two sets of ``total`` members together that makes them similar."""
    return -(-percent * total // (100 + percent))


def describe(docs: DataFrame, size: int) -> tuple[DataFrame, np.ndarray]:
    """Per row: doc_id, n, node and signature of its set, as a staged table; and the rank of each bucket's shingles."""
    names = ["doc_id", "n", "node", "signature", "part", "counts"]

    def run(batches):
        counts = np.zeros(BUCKETS, np.uint32)
        waiting, many = [], 0
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"), size)
            waiting += [(found >> SHIFT).astype(np.int32) for found in sets]
            many += sum(map(len, sets))
            if many > COUNTED:
                counts += np.bincount(np.concatenate(waiting), minlength=BUCKETS).astype(np.uint32)
                waiting, many = [], 0
            columns = [
                batch.column("doc_id"), pa.array([len(found) for found in sets], pa.int64()), pa.array([digest(found) for found in sets], pa.int64()),
                pa.array([signature(found) if len(found) else None for found in sets], pa.binary()), pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)
        if waiting:
            counts += np.bincount(np.concatenate(waiting), minlength=BUCKETS).astype(np.uint32)
        if counts.any():
            few = np.minimum(counts, 65535).astype(np.uint16).reshape(PARTS, -1)
            parts = [zlib.compress(part.tobytes(), 1) for part in few]
            empty = pa.nulls(PARTS, pa.int64())
            yield pa.RecordBatch.from_arrays([empty, empty, empty, pa.nulls(PARTS, pa.binary()), pa.array(range(PARTS), pa.int32()), pa.array(parts, pa.binary())], names)

    found = stage(docs.mapInArrow(lean(run), "doc_id long, n long, node long, signature binary, part int, counts binary"), "sets")

    def add(key, rows):
        total = np.zeros(BUCKETS // PARTS, np.int64)
        for value in rows.column("counts").to_pylist():
            total += np.frombuffer(zlib.decompress(value), np.uint16)
        ranks = np.minimum(np.log2(total + 1.0) * LOG_STEPS, 65535).astype(np.uint16).tobytes()
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([ranks], pa.binary())})

    # PARTS rows, one for each range of buckets.
    summed = found.where("part is not null").select("part", "counts").groupBy("part").applyInArrow(add, "part int, counts binary").collect()
    ranks = np.zeros((PARTS, BUCKETS // PARTS), np.uint16)
    for row in summed:
        ranks[row["part"]] = np.frombuffer(row["counts"], np.uint16)
    return found, ranks.reshape(-1)


def postings(docs: DataFrame, ranks: np.ndarray, size: int, percent: int) -> DataFrame:
    """Prefix shingles of every different set of a task: token, node, n, at (place in the set's order)."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        ranks, met = shared.value, set()
        for batch in slices(batches, "text"):
            tokens, nodes, numbers, places = [], [], [], []
            if len(met) > REMEMBERED:
                met = set()
            for doc, found in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text"), size)):
                n = len(found)
                node = digest(found)
                if not n or doc is None or node in met:
                    continue
                met.add(node)
                keep = n - -(-percent * n // 100) + 1
                tokens.append(rarest_first(found, ranks)[:keep].view(np.int64))
                nodes.append(np.full(keep, node, np.int64))
                numbers.append(np.full(keep, n, np.int32))
                places.append(np.arange(keep, dtype=np.int32))
            if tokens:
                columns = [pa.array(np.concatenate(part)) for part in (tokens, nodes, numbers, places)]
                yield pa.RecordBatch.from_arrays(columns, ["token", "node", "n", "at"])

    return docs.mapInArrow(lean(run), "token long, node long, n int, at int")


def _table(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [batch.column(k).to_numpy(zero_copy_only=False) for k in range(batch.num_columns)]


def leaders(spread: DataFrame, percent: int) -> DataFrame:
    """Postings of shingles that several documents share, and pairs of a document with its shingle's leader.

    ``spread`` is exchanged by token once and sorted by token, n and node; rows stream by, so a shingle that
    very many documents share needs no more memory than another. The leader is the first of a band of lengths
    in which sets can be similar; leaders of neighbouring bands are paired, too. Rows with a doc are postings,
    those with a leader are pairs.
    """
    steps = -np.log(percent / 100)

    def run(batches):
        # The last row seen, whether it shares its token, and its band's and its token's previous leader.
        held, shares = None, False
        leader, ahead = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = _table(batch)
            if held is not None:
                columns = [np.concatenate([[before], column]) for before, column in zip(held, columns)]
            # Several tasks may have posted the same set.
            once = np.ones(len(columns[0]), bool)
            once[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
            columns = [column[once] for column in columns]
            token, doc, n, at = columns
            if held is not None and len(token) == 1:
                continue
            fresh = 0 if held is None else 1
            same = token[1:] == token[:-1]
            several = np.zeros(len(token), bool)
            several[1:] = same
            several[:-1] |= same
            several[0] |= shares
            band = np.floor(np.log(n) / steps + 1e-9).astype(np.int64)
            start = np.ones(len(token), bool)
            start[1:] = ~same | (band[1:] != band[:-1])
            if fresh:
                start[0] = False
            # Which row leads each row; -1 is the leader carried over from the batch before.
            lead = np.maximum.accumulate(np.where(start, np.arange(len(token)), -1))
            carried = leader if leader is not None else (0, 0, 0, 0)
            pick = [np.where(lead < 0, carried[k], column[lead]) for k, column in enumerate(columns)]
            wanted = np.arange(len(token)) >= fresh
            inner = wanted & ~start
            pairs = [(pick[1], pick[2], pick[3], inner)]
            # A band's first row against the leader of the band before, if that has the same token.
            opens = np.flatnonzero(start & wanted)
            if len(opens):
                before = opens - 1
                old = [np.where(before < 0, 0, column[np.maximum(before, 0)]) for column in pick]
                old_token = np.where(before < 0, -1, token[np.maximum(before, 0)])
                near = (old_token == token[opens]) & (before >= 0)
                across = [np.zeros(len(token), column.dtype) for column in pick[1:]]
                for target, source in zip(across, old[1:]):
                    target[opens] = source
                mask = np.zeros(len(token), bool)
                mask[opens[near]] = True
                pairs.append((*across, mask))
            for other, other_n, other_at, mask in pairs:
                least = needed(n.astype(np.int64) + other_n, percent)
                close = mask & (doc != other) & (1 + np.minimum(n - at, other_n - other_at) - 1 >= least) & (100 * np.minimum(n, other_n) >= percent * np.maximum(n, other_n).astype(np.int64))
                if close.any():
                    found = np.unique(np.stack([other[close], doc[close]], 1), axis=0)
                    none = pa.nulls(len(found), pa.int64()), pa.nulls(len(found), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [none[0], pa.array(found[:, 1]), none[1], none[1], pa.array(found[:, 0])], ["token", "node", "n", "at", "leader"]
                    )
            leader = tuple(int(column[-1]) for column in pick)
            done = several[:-1]
            if fresh:
                done = done.copy()
            if done.any():
                kept = [column[:-1][done] for column in columns]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kept[0]), pa.array(kept[1]), pa.array(kept[2].astype(np.int32)), pa.array(kept[3].astype(np.int32)), pa.nulls(int(done.sum()), pa.int64())],
                    ["token", "node", "n", "at", "leader"],
                )
            held, shares = tuple(column[-1] for column in columns), bool(several[-1])
        if held is not None and shares:
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(held[0])]), pa.array([int(held[1])]), pa.array([int(held[2])], pa.int32()), pa.array([int(held[3])], pa.int32()), pa.nulls(1, pa.int64())],
                ["token", "node", "n", "at", "leader"],
            )

    return spread.mapInArrow(lean(run), "token long, node long, n int, at int, leader long")


def apart(signatures: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many bits the signatures of rows x and y differ: the sets have at least so many members not in common."""
    return np.bitwise_count(signatures[x] ^ signatures[y]).sum(1, dtype=np.int64)


def crossing(spread: DataFrame, percent: int, rays: bool) -> DataFrame:
    """Pairs of sets of different components that meet at a shingle and pass the filters.

    ``spread`` has the columns token, node, n, at, component, signature, and is exchanged by token and sorted by token, n and
    node. With ``rays`` not all pairs for shingles of more than ``FEW`` sets: each set outside the largest component with the
    one inside whose signature is nearest; a pair may come back more than once.
    """

    def close(n, at, signatures, x, y):
        least = needed(n[x] + n[y], percent)
        good = (np.minimum(n[x] - at[x], n[y] - at[y]) >= least) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))
        x, y, least = x[good], y[good], least[good]
        good = apart(signatures, x, y) <= n[x] + n[y] - 2 * least
        return x[good], y[good]

    def nearest(token, node, n, at, component, signatures):
        kinds, sizes = np.unique(component, return_counts=True)
        largest = kinds[np.lexsort((mix((kinds ^ token).view(np.uint64)), sizes))[-1]]
        major, minor = np.flatnonzero(component == largest), np.flatnonzero(component != largest)
        low = np.searchsorted(n[major], -(-percent * n[minor] // 100), side="left")
        high = np.searchsorted(n[major], 100 * n[minor] // percent, side="right")
        minor, low, high = minor[low < high], low[low < high], high[low < high]
        for part in range(0, len(minor), 256):
            rows, first, last = (values[part : part + 256] for values in (minor, low, high))
            # At most NEAR members, evenly spread over those of fitting lengths.
            steps = first[:, None] + (np.arange(NEAR)[None, :] * (last - first)[:, None]) // NEAR
            others = major[steps]
            differ = np.bitwise_count(signatures[rows][:, None, :] ^ signatures[others]).sum(2, dtype=np.int64)
            x, y = close(n, at, signatures, rows, others[np.arange(len(rows)), differ.argmin(1)])
            if len(x):
                yield node[y], node[x]

    def group(node, n, at, component, signatures):
        kinds, sizes = np.unique(component, return_counts=True)
        # The largest component is compared with the others, the others with all: pairs inside it never arise.
        minor = np.flatnonzero(component != kinds[sizes.argmax()])
        for start in range(0, len(minor), 64):
            rows = minor[start : start + 64]
            low = np.searchsorted(n, -(-percent * int(n[rows].min()) // 100), side="left")
            high = np.searchsorted(n, 100 * int(n[rows].max()) // percent, side="right")
            for left in range(low, high, 1 << 10):
                others = np.arange(left, min(high, left + (1 << 10)))
                x, y = np.nonzero(component[rows][:, None] != component[others][None, :])
                x, y = close(n, at, signatures, rows[x], others[y])
                if len(x):
                    yield node[x], node[y]

    def run(batches):
        waiting: list[list] = []

        def finish():
            columns = [np.concatenate(parts) for parts in zip(*waiting)]
            token, node, component = columns[0], columns[1], columns[4]
            n, at = columns[2].astype(np.int64), columns[3].astype(np.int64)
            borders = np.concatenate([[0], np.flatnonzero(np.diff(token)) + 1, [len(token)]])
            sizes = np.diff(borders)
            mixed = np.minimum.reduceat(component, borders[:-1]) != np.maximum.reduceat(component, borders[:-1])
            # Small groups all at once: each row with the next ones of its group.
            few = np.flatnonzero(np.repeat(mixed & (sizes <= FEW), sizes))
            met = [few[:0]], [few[:0]]
            for step in range(1, FEW):
                x, y = few[:-step], few[step:]
                both = (token[x] == token[y]) & (component[x] != component[y])
                for part, found in zip(met, close(n, at, columns[5], x[both], y[both])):
                    part.append(found)
            x, y = (node[np.concatenate(part)] for part in met)
            if len(x):
                found = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1), axis=0) if not rays else np.stack([np.minimum(x, y), np.maximum(x, y)], 1)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["leader", "node"])
            for k in np.flatnonzero(mixed & (sizes > FEW)).tolist():
                part = slice(borders[k], borders[k + 1])
                own = node[part], n[part], at[part], component[part], columns[5][part]
                for x, y in nearest(token[borders[k]], *own) if rays else group(*own):
                    found = np.stack([x, y], 1) if rays else np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["leader", "node"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = _table(batch.drop_columns(["signature"]))
            columns.append(np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint64).reshape(batch.num_rows, -1))
            # Whole groups go; the last one may continue in the next batch.
            cut = int(np.searchsorted(columns[0], columns[0][-1], side="left"))
            if cut:
                waiting.append([column[:cut] for column in columns])
                yield from finish()
                waiting = []
            elif waiting and waiting[-1][0][-1] != columns[0][0]:
                yield from finish()
                waiting = []
            waiting.append([column[cut:] for column in columns])
        if waiting:
            yield from finish()

    return spread.mapInArrow(lean(run), "leader long, node long")


def bound(x: np.ndarray, y: np.ndarray, depth: int = 3) -> int:
    """At most so many members are common to two sorted sets (suffix filter: halves around a pivot)."""
    if not depth or min(len(x), len(y)) < 8:
        return min(len(x), len(y))
    middle = len(y) // 2
    at = int(np.searchsorted(x, y[middle]))
    return bound(x[:at], y[:middle], depth - 1) + bound(x[at:], y[middle:], depth - 1)


def best_leader(pairs: DataFrame) -> DataFrame:
    """For each node the leader that it was paired with most often (of equals the smallest), as pairs leader, node."""
    counts = pairs.select("leader", "node").repartition("node").groupBy("node", "leader").agg(F.count("*").alias("times"))
    return counts.groupBy("node").agg(F.max_by("leader", F.struct("times", F.bitwise_not("leader"))).alias("leader")).select("leader", "node")


def verify(pairs: DataFrame, names: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those pairs (leader, node; each once) whose sets are similar, as links a, b.

    ``names`` has one doc_id of each node. Texts are brought to their pairs: a leader's text is sent once for about
    ``MEMBERS`` nodes, so a node that leads very many is spread over many tasks. Of texts that share an id only the one
    with the node's set counts.
    """
    salted = pairs.groupBy("leader").agg(F.count("*").alias("many")).join(pairs, "leader")
    salted = salted.withColumn("salt", F.pmod(F.xxhash64("node"), F.greatest(F.lit(1), F.ceil(F.col("many") / MEMBERS)).cast("long")).cast("int")).drop("many")
    salted = stage(salted, "pairs")
    heads = salted.select("leader", F.col("leader").alias("node"), "salt").distinct()
    wanted = salted.select("leader", "node", "salt").unionByName(heads).join(names, "node")
    rows = wanted.join(docs, "doc_id").select("leader", "salt", "node", "text")
    rows = rows.repartition("leader", "salt").sortWithinPartitions("leader", "salt", (F.col("node") != F.col("leader")), "node")

    def run(batches):
        current, first = None, None
        for batch in slices(batches, "text"):
            a, b = [], []
            sets = shingle_sets(batch.column("text"), size)
            keys = zip(batch.column("leader").to_pylist(), batch.column("salt").to_pylist(), batch.column("node").to_pylist())
            for (leader, salt, node), found in zip(keys, sets):
                if digest(found) != node:
                    continue
                if node == leader:
                    current, first = (leader, salt), found
                    continue
                least = needed(len(first) + len(found), percent)
                if current != (leader, salt) or bound(first, found) < least:
                    continue
                small, large = (first, found) if len(first) < len(found) else (found, first)
                place = np.searchsorted(large, small)
                if int((large[np.minimum(place, len(large) - 1)] == small).sum()) >= least:
                    a.append(leader)
                    b.append(node)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    links = stage(rows.mapInArrow(lean(run), "a long, b long"), "links")
    unstage(salted)
    return links


def several_components(posted: DataFrame, joined: DataFrame) -> DataFrame:
    """The postings of those shingles whose sets are of several components, with the component."""
    marked = posted.select("token", "node", "n", "at").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    whole = Window.partitionBy("token")
    ends = {"least": F.min("component").over(whole), "most": F.max("component").over(whole)}
    return marked.withColumns(ends).where("least != most").select("token", "node", "n", "at", "component")


def similar_groups(docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row's set size and the smallest id it is linked with, over any number of links: doc_id, n_shingles, component_id.

    Two documents link if 100 * intersection >= ``percent`` * union of their sets of shingles of ``size`` words.
    With fewer words the whole sequence is the one shingle; null and blank texts have none and link with
    nothing. One row for each row; rows that share an id are one document with all their texts' links. A null id
    links with nothing and has a null component.
    """
    rows = docs.selectExpr(f"cast(`{id_column}` as long) as doc_id", f"cast(`{text_column}` as string) as text")
    described, ranks = describe(rows, size)
    info = described.where("part is null").select("doc_id", "n", "node")
    named = info.where("n > 0 and doc_id is not null")
    names = named.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    signatures = described.where("n > 0 and doc_id is not null").groupBy("node").agg(F.min("signature").alias("signature"))
    # Rows that share an id are one document.
    twice = named.groupBy("doc_id").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first != last")
    links = named.join(twice, "doc_id").where("node != first").select(F.col("first").alias("a"), F.col("node").alias("b"))

    spread = postings(rows, ranks, size, percent).repartition("token").sortWithinPartitions("token", "n", "node")
    met = stage(leaders(spread, percent), "postings")
    pairs = stage(best_leader(met.where("leader is not null")), "pairs")
    first = verify(pairs, names, rows, size, percent)
    joined = components(first.unionByName(links))
    tried = pairs

    posted, rays, linked, most = met.where("leader is null"), True, 1, 0
    while True:
        if linked:
            last, met = met, stage(several_components(posted, joined), "postings")
            unstage(last)
            posted = met
        spread = met.join(signatures, "node").select("token", "node", "n", "at", "component", "signature").repartition("token")
        pairs = crossing(spread.sortWithinPartitions("token", "n", "node"), percent, rays)
        pairs = best_leader(pairs) if rays else pairs.distinct()
        # A pair is looked at once, whichever of the two led.
        either = tried.unionByName(tried.select(F.col("node").alias("leader"), F.col("leader").alias("node")))
        pairs = stage(pairs.join(either, ["leader", "node"], "left_anti"), "pairs")
        tried = tried.unionByName(pairs)
        linked = 0
        if not pairs.isEmpty():
            more = verify(pairs, names, rows, size, percent)
            linked = more.count()
            if linked:
                joined = components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
            unstage(more)
        if not rays:
            break
        # Two large components that can be joined give a link for each set of one of them. Few links in a round say that
        # only small ones are left, of which all pairs can be looked at.
        most = max(most, linked)
        rays = linked * FADED > most
    unstage(met)
    # A component is called by its smallest document.
    grouped = named.join(joined, "node", "left").select("doc_id", "node", F.coalesce("component", "node").alias("component"))
    least = grouped.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    known = grouped.select("node", "component").distinct().join(least, "component").select("node", "component_id")
    found = info.join(known.select(F.col("node"), F.col("component_id")), "node", "left")
    alone = F.col("doc_id").isNull() | (F.col("n") == 0)
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
