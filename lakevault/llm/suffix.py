"""Exact removal of repeated passages with a run-length compressed index of suffixes.

A byte goes if a string of ``LENGTH`` bytes over it starts earlier, too. Indexing all suffixes of a corpus in one
place does not scale, so strings are brought together by their content first:

1. *Anchors.* Of the ``GRAM``-byte grams inside a string, the one of smallest hash is its anchor (the leftmost of
   equal ones). Equal strings have equal anchors at equal places, and neighbouring strings mostly share theirs:
   the strings of one anchor form a fragment. About one fragment in 35 bytes is exchanged, as two hashes.
2. *Equal fragments.* The first of them in document order stays, the strings of the others are repeats.
3. *Different fragments of one anchor* lie where repeats begin or end, or share the gram by chance. Their bytes are
   exchanged by anchor and indexed in blocks: suffixes are sorted, the Burrows-Wheeler transform is kept as runs,
   and the earliest position of a string is sampled only where its suffixes do not lie inside one run (inside a
   run, all are preceded by the same byte, so the string one byte further left starts one position earlier).
   Every fragment is then streamed through the runs from right to left; this yields for each position whether
   ``LENGTH`` bytes match and where they start first.

An anchor with very many different fragments (``HOT``) is settled string by string instead, by hashes, in the
exchange of step 2: equal strings meet, and no task has to hold them.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.llm.common import lean, stage
from lakevault.llm.shingles import VALUES, bytes_of, mix, powers
from lakevault.operators.merge import fits_broadcast

LENGTH, GRAM = 100, 32
CHUNK = 1 << 19  # bytes handled at once; positions in a chunk need 20 bits
BLOCK = 2 << 20  # bytes of an index block; one anchor's fragments are not split
HOT = 20_000
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))

_powers: list[np.ndarray] = []


def power_tables() -> tuple[np.ndarray, np.ndarray]:
    if not _powers:
        _powers.extend((powers(BASE, CHUNK + LENGTH + 1), powers(INVERSE, CHUNK + LENGTH + 1)))
    return _powers[0], _powers[1]


class Stretch:
    """Hashes of any substring of a chunk of bytes."""

    def __init__(self, data: np.ndarray):
        up, self.down = power_tables()
        self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(VALUES_FULL[data] * up[: len(data)], dtype=np.uint64)])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.down[start])


# Letters of both cases differ here.
VALUES_FULL = VALUES.copy()
VALUES_FULL[65:91] = np.random.default_rng(7_340_033).integers(1, 2**64, 26, np.uint64)


def chunks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of several texts, or of part of a long one: data, doc ids, where each begins in the data, its offset in the text.

    Parts of a text overlap by LENGTH - 1 bytes, so every string lies in exactly one part.
    """
    data, borders = bytes_of(batch.column("text"))
    ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
    docs, begins, offsets, parts, filled = [], [], [], [], 0
    for row, (start, end) in enumerate(zip(borders[:-1].tolist(), borders[1:].tolist())):
        offset = 0
        while end - start - offset >= LENGTH:
            size = min(end - start - offset, CHUNK)
            if filled + size > CHUNK and docs:
                yield np.concatenate(parts), np.array(docs), np.array(begins), np.array(offsets)
                docs, begins, offsets, parts, filled = [], [], [], [], 0
            docs.append(ids[row])
            begins.append(filled)
            offsets.append(offset)
            parts.append(data[start + offset : start + offset + size])
            filled += size
            offset += size - LENGTH + 1
    if docs:
        yield np.concatenate(parts), np.array(docs), np.array(begins), np.array(offsets)


def fragments(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, ...]:
    """Fragments of a chunk: anchor hash, fragment hash, first string, strings, and the text each is in."""
    stretch = Stretch(data)
    ends = np.append(begins[1:], len(data))
    grams = len(data) - GRAM + 1
    place = np.arange(grams)
    hashes = stretch.hash(place, place + GRAM)
    low = np.uint64(20)
    best = hashes >> low << low | place.astype(np.uint64)
    # Least over LENGTH - GRAM + 1 neighbours, doubling the reach.
    reach, wanted = 1, LENGTH - GRAM + 1
    while 2 * reach <= wanted:
        best = np.minimum(best[: len(best) - reach], best[reach:])
        reach *= 2
    rest = wanted - reach
    best = np.minimum(best[: len(best) - rest], best[rest:]) if rest else best
    strings = np.arange(len(best))
    owner = np.repeat(np.arange(len(begins)), ends - begins)[: len(best)]
    valid = strings + LENGTH <= ends[owner]
    strings, owner = strings[valid], owner[valid]
    anchor = (best[valid] & np.uint64((1 << 20) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]))
    many = np.diff(first, append=len(anchor))
    start, anchor, owner = strings[first], anchor[first], owner[first]
    shape = ((anchor - start) << 32 | many).astype(np.uint64)
    print_ = mix(stretch.hash(start, start + many + LENGTH - 1) ^ mix(shape))
    return hashes[anchor], print_, start, many, owner


def find_fragments(docs: DataFrame) -> DataFrame:
    """Fragments of all texts: anchor, frag (hashes), doc_id, number, start (of the first string), many (strings), key (to deal them out by).

    Of equal fragments in one chunk only the first has to meet others. The rest are repeats already: they have no
    anchor and are dealt out evenly, so a fragment that is everywhere makes no task larger than a chunk's firsts do.
    """

    def run(batches):
        for batch in batches:
            keys = [batch.column(name).to_numpy(zero_copy_only=False) for name in ("doc_id", "number")]
            rows = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), batch.column("text")], ["doc_id", "text"])
            for data, ids, begins, offsets in chunks(rows):
                anchor, frag, start, many, owner = fragments(data, begins)
                doc, number = (key[ids[owner]] for key in keys)
                start = start - begins[owner] + offsets[owner]
                order = np.lexsort((start, number, doc, frag, anchor))
                repeat = np.zeros(len(order), bool)
                repeat[order], _ = repeats_of(anchor[order], frag[order], doc[order], number[order], start[order], None)
                key = np.where(repeat, mix(frag ^ mix((doc.view(np.uint64) ^ mix(number.view(np.uint64))) + start.astype(np.uint64))), anchor)
                columns = [
                    pa.array(anchor.view(np.int64), mask=repeat), pa.array(frag.view(np.int64)), pa.array(doc), pa.array(number),
                    pa.array(start), pa.array(many.astype(np.int32)), pa.array(key.view(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "frag", "doc_id", "number", "start", "many", "key"])

    return docs.mapInArrow(lean(run), "anchor long, frag long, doc_id long, number long, start long, many int, key long")


def repeats_of(anchor: np.ndarray, frag: np.ndarray, doc: np.ndarray, number: np.ndarray, start: np.ndarray, first: tuple | None) -> tuple[np.ndarray, tuple]:
    """Of sorted fragments those that an equal one precedes, and (anchor, frag, doc, number, start) of the last group's first.

    ``first`` is that of the rows before. The same place (of a row that occurs twice) does not precede itself.
    """
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (frag[1:] != frag[:-1])
    new[0] = first is None or (anchor[0], frag[0]) != first[:2]
    lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
    own = first or (0, 0, 0, 0, 0)
    first_doc, first_number, first_start = (np.where(lead < 0, before, values[lead]) for before, values in zip(own[2:], (doc, number, start)))
    at = lead[-1]
    return ~new & ((doc != first_doc) | (number != first_number) | (start != first_start)), own if at < 0 else (anchor[at], frag[at], doc[at], number[at], start[at])


def settle(found: DataFrame) -> DataFrame:
    """Of equal fragments the first stays; rows: repeats (anchor null), and for anchors of several fragments those that stay.

    Rows stream by in the order of anchor, fragment and place, so the number of equal ones does not matter.
    """

    def run(batches):
        held, several, first = None, False, None
        names = ["anchor", "doc_id", "number", "start", "many"]

        def out(columns, mask, keep_anchor):
            size = int(mask.sum())
            anchor = pa.array(columns[0][mask]) if keep_anchor else pa.nulls(size, pa.int64())
            return pa.RecordBatch.from_arrays([anchor, *(pa.array(columns[k][mask]) for k in (2, 3, 4)), pa.array(columns[5][mask].astype(np.int32))], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            known = batch.column("anchor").is_valid().to_numpy(zero_copy_only=False)
            if not known.all():  # they come first
                repeats_ = [batch.column(k).filter(pa.array(~known)).to_numpy(zero_copy_only=False) for k in range(6)]
                yield out(repeats_, np.ones(int((~known).sum()), bool), False)
                batch = batch.filter(pa.array(known))
                if not batch.num_rows:
                    continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(6)]
            anchor, frag, doc, number, start, _ = columns
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (frag[1:] != frag[:-1])
            new[0] = first is None or (anchor[0], frag[0]) != first[:2]
            repeat, first = repeats_of(anchor, frag, doc, number, start, first)
            if repeat.any():
                yield out(columns, repeat, False)
            kept = [column[new] for column in columns]
            if held is not None:
                kept = [np.concatenate([[before], column]) for before, column in zip(held, kept)]
            if not len(kept[0]):
                continue
            same = kept[0][1:] == kept[0][:-1]
            mixed = np.zeros(len(kept[0]), bool)
            mixed[1:] = same
            mixed[:-1] |= same
            mixed[0] |= several and held is not None
            held, several = [column[-1] for column in kept], bool(mixed[-1])
            mixed[-1] = False
            if mixed.any():
                yield out(kept, mixed, True)
        if held is not None and several:
            yield out([np.array([value]) for value in held], np.array([True]), True)

    spread = found.repartition("key").sortWithinPartitions("anchor", "frag", "doc_id", "number", "start")
    return spread.mapInArrow(lean(run), "anchor long, doc_id long, number long, start long, many int")


def place_type(size: int) -> type:
    """The shortest type that holds places and ranks in so many bytes: arrays of them are most of an index's memory."""
    return np.int32 if size < 2**31 - 1 else np.int64


class RunIndex:
    """Run-length compressed Burrows-Wheeler transform of fragments in document order, with sampled string positions."""

    def __init__(self, data: np.ndarray, borders: np.ndarray):
        size = len(data)
        kind = place_type(size)
        self.borders = borders = borders.astype(kind)
        lengths = np.diff(borders)
        left = np.repeat(borders[1:], lengths)  # bytes to the end of the fragment
        left -= np.arange(size, dtype=kind)
        order, rank = self.sort(data, left)
        self.row_of = np.empty(size, kind)
        self.row_of[order] = np.arange(size, dtype=kind)
        # The byte before each suffix; at a fragment's start there is none (a number of its own).
        before = data[order - 1].astype(np.int16)
        before[self.row_of[borders[:-1][lengths > 0]]] = -1
        edge = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]])).astype(kind)
        self.run_start, run_symbol = edge, before[edge]
        del before
        run_length = np.diff(edge, append=kind(size))
        # Where the rows of a run go when their byte is put in front: runs of a byte keep their order.
        by_symbol = np.argsort(run_symbol, kind="stable")
        first_row = np.searchsorted(data[order], np.arange(256))  # rows are sorted by first byte
        self.target = np.zeros(len(edge), kind)
        sorted_symbol, sorted_length = run_symbol[by_symbol], run_length[by_symbol]
        ahead = np.cumsum(sorted_length, dtype=kind) - sorted_length
        group = np.searchsorted(sorted_symbol, sorted_symbol, side="left")
        # A fragment's last byte starts a suffix that no row's byte leads to: shorter suffixes come first in a bucket.
        last = borders[1:] - 1
        lone = np.bincount(data[last], minlength=256)
        base = np.where(sorted_symbol >= 0, first_row[np.maximum(sorted_symbol, 0)] + lone[np.maximum(sorted_symbol, 0)], -1)
        self.target[by_symbol] = base + ahead - ahead[group]
        # Classes: rows whose suffixes agree in LENGTH bytes.
        long_ = left[order] >= LENGTH
        fresh = np.ones(size, bool)
        rank = rank[order]
        fresh[1:] = (rank[1:] != rank[:-1]) | ~long_[1:]
        del rank
        self.class_start = np.flatnonzero(fresh).astype(kind)
        class_end = np.append(self.class_start[1:], kind(size))
        least = np.minimum.reduceat(order, self.class_start)
        del order, fresh, left
        # A class is the image of another if that lies in one run, holds whole strings, and has as many rows.
        run = np.searchsorted(self.run_start, self.class_start, side="right").astype(kind) - 1
        inside = (class_end <= np.append(self.run_start[1:], kind(size))[run]) & long_[self.class_start] & (run_symbol[run] >= 0)
        run = run[inside]
        image = self.target[run] + self.class_start[inside] - self.run_start[run]
        del run
        at = np.searchsorted(self.class_start, image, side="right").astype(kind) - 1
        exact = (self.class_start[at] == image) & (class_end[at] - self.class_start[at] == (class_end - self.class_start)[inside])
        derived = np.zeros(len(self.class_start), bool)
        derived[at[exact]] = True
        self.sampled = np.flatnonzero(~derived).astype(kind)
        self.samples = least[self.sampled]

    @staticmethod
    def sort(data: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix order (to fragment ends, equal ones by position), and ranks by the first LENGTH bytes.

        Only the numbers being sorted take eight bytes, and what a pass no longer needs is given up before the next one sorts.
        """
        size, kind = len(data), place_type(len(data))
        if not size:
            return np.empty(0, kind), np.empty(0, kind)
        # Seven bytes and how many of them there are fit one number.
        width = 7

        def beginning():
            padded = np.concatenate([data, np.zeros(width, np.uint8)])
            key = np.zeros(size, np.int64)
            for k in range(width):
                key <<= 8
                key |= np.where(left > k, padded[k : size + k], np.uint8(0))
            key <<= 3
            key |= np.minimum(left, width)
            return key

        def changes(values):
            fresh = np.ones(len(values), bool)
            np.not_equal(values[1:], values[:-1], out=fresh[1:])
            return fresh

        def ranked(key):
            order = np.argsort(key).astype(kind)
            steps = np.cumsum(changes(key[order]), dtype=kind)
            steps -= 1
            rank = np.empty(size, kind)
            rank[order] = steps
            return rank, int(steps[-1]), order

        def ahead(rank, shift):
            """Rank of what follows ``shift`` bytes later in the fragment, from 1; 0 if nothing does."""
            other = np.zeros(size, kind)
            other[: max(size - shift, 0)] = rank[shift:]
            other += 1
            other[left <= shift] = 0
            return other

        def joined(rank, kinds, shifts):
            key = rank.astype(np.int64)
            for shift in shifts:
                key *= kinds
                key += ahead(rank, shift)
            return key

        rank, most, order = ranked(beginning())
        by_length, top = None, int(left.max())
        while width < max(top, LENGTH):
            kinds = most + 2
            if by_length is None and 2 * width >= LENGTH:
                by_length = rank, LENGTH - width  # LENGTH bytes are two overlapping stretches of ``width``
            three = by_length is None and 3 * width < LENGTH and kinds**3 < 2**63 or by_length is not None and 2 * width < top and kinds**3 < 2**63
            shifts = [width, 2 * width] if three else [width]
            width += shifts[-1]
            del order
            rank, most, order = ranked(joined(rank, kinds, shifts))
        if most < size - 1:
            del order
            key = rank.astype(np.int64)
            key *= size
            key += np.arange(size, dtype=kind)
            order = np.argsort(key).astype(kind)
            del key
        # Suffixes that agree in LENGTH bytes lie side by side.
        short, shift = by_length
        del rank
        fresh = changes(short[order])
        fresh |= changes(ahead(short, shift)[order])
        same = np.empty(size, kind)
        same[order] = np.cumsum(fresh, dtype=kind) - kind(1)
        return order, same

    def earliest(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every string of the fragments: fragment, place in the data, place where an equal string starts first."""
        ends = self.borders[1:]
        alive = np.flatnonzero(np.diff(self.borders) >= LENGTH).astype(self.borders.dtype)
        place = ends[alive] - LENGTH
        row = self.row_of[place]
        first = np.zeros(len(alive), row.dtype)
        out = []
        while len(alive):
            own = np.searchsorted(self.class_start, row, side="right").astype(row.dtype) - 1
            at = np.searchsorted(self.sampled, own)
            known = (at < len(self.sampled)) & (self.sampled[np.minimum(at, len(self.sampled) - 1)] == own)
            first = np.where(known, self.samples[np.minimum(at, len(self.samples) - 1)], first - 1)
            out.append((alive, place, first))
            more = place > self.borders[alive]
            alive, place, row, first = alive[more], place[more] - 1, row[more], first[more]
            run = np.searchsorted(self.run_start, row, side="right") - 1
            row = self.target[run] + row - self.run_start[run]
        return tuple(np.concatenate(parts) for parts in zip(*out)) if out else (np.empty(0, np.int64),) * 3


def index_block(docs: np.ndarray, starts: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Repeats among the strings of fragments: doc ids, first strings, numbers of strings."""
    order = np.lexsort((starts, docs))
    docs, starts, texts = docs[order], starts[order], [texts[at] for at in order]
    borders = np.concatenate([[0], np.cumsum([len(text) for text in texts])]).astype(np.int64)
    fragment, place, first = RunIndex(np.frombuffer(b"".join(texts), np.uint8), borders).earliest()
    own = np.searchsorted(borders, first, side="right") - 1
    # The same place of a document is not earlier than itself.
    start, origin = starts[fragment] + place - borders[fragment], starts[own] + first - borders[own]
    repeat = (first < place) & ((docs[own] != docs[fragment]) | (origin != start))
    fragment, start = fragment[repeat], start[repeat]
    order = np.lexsort((start, fragment))
    fragment, start = fragment[order], start[order]
    if not len(start):
        return docs[:0], starts[:0], starts[:0]
    new = np.flatnonzero(np.concatenate([[True], (fragment[1:] != fragment[:-1]) | (start[1:] != start[:-1] + 1)]))
    return docs[fragment[new]], start[new], np.diff(new, append=len(start))


def resolve(pieces: DataFrame) -> DataFrame:
    """Repeats among different fragments (anchor, doc_id, number, start, bytes): doc_id, number, start, many."""

    def run(batches):
        docs, starts, texts, filled, last = [], [], [], 0, None

        def finish():
            keys, place = np.unique(np.array(docs, np.int64).reshape(-1, 2), axis=0, return_inverse=True)  # in document order
            found = index_block(place.reshape(-1), np.array(starts), texts)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys[found[0], 0]), pa.array(keys[found[0], 1]), pa.array(found[1]), pa.array(found[2].astype(np.int32))], ["doc_id", "number", "start", "many"]
            )

        for batch in batches:
            for anchor, doc, number, start, text in zip(*[batch.column(k).to_pylist() for k in range(5)]):
                if anchor != last and filled >= BLOCK:
                    yield finish()
                    docs, starts, texts, filled = [], [], [], 0
                last = anchor
                docs.append((doc, number))
                starts.append(start)
                texts.append(text)
                filled += len(text)
        if docs:
            yield finish()

    spread = pieces.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "number", "start")
    return spread.mapInArrow(lean(run), "doc_id long, number long, start long, many int")


def cut_out(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of wanted fragments (anchor, doc_id, number, start, many, hot); of hot anchors the hash of each string instead.

    Rows: anchor, doc_id, number, start, bytes (null: a single string of a hot anchor), frag.
    """
    lists = wanted.groupBy("doc_id", "number").agg(F.collect_list(F.struct("anchor", "start", "many", "hot")).alias("wanted"))
    joined = docs.join(lists, ["doc_id", "number"]).select("doc_id", "number", "text", "wanted")

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                data, borders = bytes_of(one.column("text"))
                data = data[borders[0] : borders[1]]
                out: dict[str, list] = {"anchor": [], "doc_id": [], "number": [], "start": [], "bytes": [], "frag": []}
                doc, number = one.column("doc_id")[0].as_py(), one.column("number")[0].as_py()
                for want in one.column("wanted")[0].as_py():
                    part = data[want["start"] : want["start"] + want["many"] + LENGTH - 1]
                    if want["hot"]:
                        at = np.arange(want["many"])
                        found = Stretch(part).hash(at, at + LENGTH).view(np.int64).tolist()
                        for k, value in enumerate(found):
                            out["anchor"].append(want["anchor"])
                            out["doc_id"].append(doc)
                            out["number"].append(number)
                            out["start"].append(want["start"] + k)
                            out["bytes"].append(None)
                            out["frag"].append(value)
                    else:
                        out["anchor"].append(want["anchor"])
                        out["doc_id"].append(doc)
                        out["number"].append(number)
                        out["start"].append(want["start"])
                        out["bytes"].append(part.tobytes())
                        out["frag"].append(None)
                if out["anchor"]:
                    yield pa.RecordBatch.from_pydict(out, schema=PIECES)

    return joined.mapInArrow(lean(run), "anchor long, doc_id long, number long, start long, bytes binary, frag long")


PIECES = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64()), ("number", pa.int64()), ("start", pa.int64()), ("bytes", pa.binary()), ("frag", pa.int64())])


def repeats(docs: DataFrame) -> DataFrame:
    """Strings of LENGTH bytes that start earlier, too, as runs: doc_id, number, start of the first string, many strings."""
    settled = stage(settle(find_fragments(docs)), "fragments")
    mixed = settled.where("anchor is not null")
    hot = mixed.groupBy("anchor").count().where(F.col("count") > HOT).select("anchor", F.lit(True).alias("hot"))
    wanted = mixed.join(hot, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    pieces = stage(cut_out(docs, wanted), "fragment-bytes")
    indexed = resolve(pieces.where("bytes is not null").select("anchor", "doc_id", "number", "start", "bytes"))
    # Strings of a hot anchor are dealt out by their own hash; equal ones still meet.
    single = settle(pieces.where("bytes is null").select("anchor", "frag", "doc_id", "number", "start", F.lit(1).alias("many"), F.col("frag").alias("key"))).where("anchor is null")
    plain = settled.where("anchor is null").select("doc_id", "number", "start", "many")
    return plain.unionByName(indexed).unionByName(single.select("doc_id", "number", "start", "many"))


def numbered(docs: DataFrame, key: Column, text: Column) -> DataFrame:
    """All rows with _key and _number, which order and tell apart the documents.

    Rows without a key have the lowest one and negative numbers of their own; they are staged, so that these stay. Other
    numbers are 0, or the hash of the text where texts differ under one key.
    """
    lowest, digest = -(2**63), F.shiftrightunsigned(F.xxhash64(text), 1)
    none = stage(docs.where(key.isNull()).withColumns({"_key": F.lit(lowest), "_number": F.monotonically_increasing_id() + F.lit(lowest)}), "no-key")
    rows = docs.where(key.isNotNull()).withColumn("_key", key)
    by_key = rows.groupBy("_key").agg(F.min(digest).alias("least"), F.max(digest).alias("most"))
    several = stage(by_key.where("least != most").select("_key", F.lit(True).alias("_several")), "several-texts")
    many = several.count()
    if many:
        rows = rows.join(F.broadcast(several) if fits_broadcast(many) else several, "_key", "left")
        rows = rows.withColumn("_number", F.when(F.col("_several"), digest).otherwise(F.lit(0).cast("long"))).drop("_several")
    else:
        rows = rows.withColumn("_number", F.lit(0).cast("long"))
    return rows.unionByName(none)


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All columns of ``docs`` with n_bytes, n_removed, n_spans (maximal removed runs) and kept (the bytes that stay).

    One row for each row. Bytes are those of UTF-8, a null text has none, so a kept text may begin inside a
    character. Documents come in the order of their ids, null first. Every row without an id is a document; rows
    that share id and text are one, and an equal place in it is not earlier; rows that share the id alone are several. Matches never cross texts. Columns with the new names are replaced.
    """
    new = ("n_bytes", "n_removed", "n_spans", "kept")
    kept = [F.col(f"`{name}`") for name in docs.columns if name not in new]
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    rows = numbered(docs.select(*kept), F.col(f"`{id_column}`").cast("long"), text)
    spans = repeats(rows.select(F.col("_key").alias("doc_id"), F.col("_number").alias("number"), text.alias("text")))
    spans = spans.groupBy(F.col("doc_id").alias("_key"), F.col("number").alias("_number")).agg(F.collect_list(F.struct("start", "many")).alias("_spans"))
    rows = rows.join(spans, ["_key", "_number"], "left").drop("_key", "_number")

    def run(batches):
        for batch in batches:
            column = batch.column(text_column)
            data, borders = bytes_of(column if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column.cast(pa.string()))
            spans = batch.column("_spans")
            sizes, removed, runs, left = [], [], [], []
            for row, (start, end) in enumerate(zip(borders[:-1].tolist(), borders[1:].tolist())):
                part, found = data[start:end], spans[row]
                sizes.append(len(part))
                if not found.is_valid:
                    removed.append(0)
                    runs.append(0)
                    left.append(part.tobytes())
                    continue
                starts = found.values.field("start").to_numpy(zero_copy_only=False)
                many = found.values.field("many").to_numpy(zero_copy_only=False)
                cover = np.zeros(len(part) + 1, np.int64)
                np.add.at(cover, starts, 1)
                np.add.at(cover, starts + many + LENGTH - 1, -1)
                gone = np.cumsum(cover)[:-1] > 0
                removed.append(int(gone.sum()))
                runs.append(int((gone & ~np.concatenate([[False], gone[:-1]])).sum()))
                left.append(part[~gone].tobytes())
            others = [batch.column(k) for k, name in enumerate(batch.schema.names) if name != "_spans"]
            names = [name for name in batch.schema.names if name != "_spans"]
            more = [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(left, pa.binary())]
            yield pa.RecordBatch.from_arrays([*others, *more], [*names, *new])

    fields = [field for field in rows.schema if field.name != "_spans"]
    more = [T.StructField(name, T.LongType()) for name in new[:3]] + [T.StructField("kept", T.BinaryType())]
    return rows.mapInArrow(lean(run), T.StructType([*fields, *more]))
