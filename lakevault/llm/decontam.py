"""Benchmark questions in documents, also with other numbers, names and units: template canonicalisation.

Words become template tokens: numbers, units behind numbers and names (words with a capital in front, inside a sentence) turn
into typed placeholders, other words lose case and outer marks. Windows of ``WINDOW`` template tokens of documents
and benchmark items meet in a hash join. Along one alignment of a document with an item, each value of the item
has to stand for one value of the document (and the other way round): a question whose numbers were exchanged
keeps its pattern of equal and different values, chance hits do not. Windows with a value that breaks this are torn out.

Whether a word with a capital is a name depends on the text around it (a sentence end in front, all capitals), so
windows of items come in every reading of such words; those of documents in one. An item also counts when only a part
of it, or an edited copy, stands in one stretch of the document.
"""
from __future__ import annotations

import re
import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakevault.llm.common import WordTable, kept, lean, slices, stage, texts
from lakevault.llm.shingles import LACKING, mix, windows

WINDOW = 5
LITERALS = 3  # a window says something if so many of its tokens are words
COVERED = 0.8  # of an item's windows
PARTLY, STRETCH = 0.35, 4  # or this share, and so many windows, in one stretch
SHIFT = 10  # words put in or left out between two neighbouring alignments of a stretch
BITS, PARTS = 1 << 24, 16  # of the filter that spares windows no item can have the exchange: 2 MB, whatever the benchmark's size

# Fixed values.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen half".split()
)
UNITS = frozenset(
    "% mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons lb lbs pound pounds oz ounce ounces "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months "
    "year years $ € £ cent cents dollar dollars euro euros percent km/h mph m/s degrees c f k w kw v a hz".split()
)
NUMBER = re.compile(r"[-+$€£]?\d[\d.,:/]*(%|st|nd|rd|th)?")
OUTER = re.compile(r"^[^\w$€£%+-]+|[^\w%]+$")

LITERAL, NUMERIC, UNIT, CAPITAL = range(4)
MARKS = mix(np.arange(101, 105, dtype=np.uint64))  # hashes of the placeholders, by kind


def describe(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each raw word: the hash of its plain form, then its kind, (in bit 2) whether a sentence ends with it and (in bit 3) whether it may be a name elsewhere."""
    found = np.zeros((len(words), 2), np.uint64)
    for at, word in enumerate(words):
        bare = OUTER.sub("", word)
        plain = bare.lower()
        if NUMBER.fullmatch(plain) or plain in NUMBER_WORDS:
            kind = NUMERIC
        elif plain in UNITS:
            kind = UNIT
        elif bare[:1].isupper() and (len(bare) == 1 or not bare.isupper()):  # words all in capitals tell nothing
            kind = CAPITAL
        else:
            kind = LITERAL
        ends = word.rstrip("\"')]}»”")[-1:] in (".", "!", "?", ":")
        found[at, 0] = xxhash.xxh3_64_intdigest(plain.encode(errors="replace"))
        either = kind in (LITERAL, CAPITAL) and (bare[:1].isupper() or len(bare) == 1)
        found[at, 1] = kind | ends << 2 | either << 3
    return found.reshape(-1), np.full(len(words), 2)


def _table() -> WordTable:
    return WordTable(describe, np.uint64)


def template(plain: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the template tokens of one text, and which of them are placeholders (their kind, else 0)."""
    kind, ends = marks & 3, marks >> 2 & 1
    numeric = kind == NUMERIC
    before = np.concatenate([[False], numeric[:-1]])
    inside = np.concatenate([[False], ends[:-1] == 0])
    slot = np.where(numeric, NUMERIC, np.where((kind == UNIT) & before, UNIT, np.where((kind == CAPITAL) & inside, CAPITAL, 0)))
    return np.where(slot > 0, MARKS[slot], plain), slot


def readings(plain: np.ndarray, tokens: np.ndarray, slot: np.ndarray, either: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and slots of one window in every reading of the words that may be names; those that say nothing are left out."""
    names = np.flatnonzero(either)
    choices = np.array(list(product((0, CAPITAL), repeat=len(names))), np.int64).reshape(2 ** len(names), len(names))
    slots = np.repeat(slot[None], len(choices), 0)
    slots[:, names] = choices
    found = np.repeat(tokens[None], len(choices), 0)
    found[:, names] = np.where(choices > 0, MARKS[CAPITAL], plain[names])
    lacking = np.full((len(choices), WINDOW - found.shape[1]), LACKING, np.uint64)
    hashes = np.concatenate([windows(row, WINDOW) for row in np.concatenate([found, lacking], 1)])
    telling = (slots == 0).sum(1) >= min(LITERALS, len(plain))
    return hashes[telling], slots[telling]


def _windows(rows: DataFrame, key: str, keep: np.ndarray | None) -> DataFrame:
    """Windows of the texts: key, window (hash), at, total (windows of the text that say something), slots.

    With ``keep``, a bitmap of hash prefixes, other windows are left out; without, windows come in all readings.
    """
    shared = rows.sparkSession.sparkContext.broadcast(keep)

    def run(batches):
        table, keep = kept("decontam", _table), shared.value
        for batch in slices(batches, "text"):
            codes, ends = table.encode(str.split, texts(batch, "text"))
            values = table.flat.reshape(-1, 2)
            words = None
            out: dict[str, list] = {"key": [], "window": [], "at": [], "total": [], "slots": []}
            for number, (start, end) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
                if start == end:
                    continue
                found = values[codes[start:end]]
                marks = found[:, 1].astype(np.int64)
                tokens, slot = template(found[:, 0], marks)
                hashes = windows(tokens, WINDOW)
                literal = np.concatenate([[0], np.cumsum(slot == 0)])
                width = min(WINDOW, end - start)
                telling = literal[width:] - literal[: len(literal) - width] >= min(LITERALS, width)
                hit = telling if keep is None else telling & (keep[(hashes >> np.uint64(43)).astype(np.int64)] >> (hashes >> np.uint64(40) & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                places = np.flatnonzero(hit)
                if not len(places):
                    continue
                if words is None:
                    words = list(table.codes)
                doc = batch.column("key")[number].as_py()
                total = int(telling.sum())
                for at in places.tolist():
                    part = slice(at, at + width)
                    for window, kinds in zip(*(readings(found[part, 0], tokens[part], slot[part], marks[part] >> 3 > 0) if keep is None else (hashes[at : at + 1], slot[None, part]))):
                        out["key"].append(doc)
                        out["window"].append(int(window.astype(np.int64)))
                        out["at"].append(at)
                        out["total"].append(total)
                        out["slots"].append([f"{kind}{OUTER.sub('', words[codes[start + at + k]]).lower()}" for k, kind in enumerate(kinds.tolist()) if kind])
            if out["key"]:
                yield pa.RecordBatch.from_pydict(out, schema=WINDOW_ARROW)

    texts_ = rows.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    return texts_.mapInArrow(lean(run, "decontam"), "key long, window long, at long, total long, slots array<string>")


WINDOW_ARROW = pa.schema([("key", pa.int64()), ("window", pa.int64()), ("at", pa.int64()), ("total", pa.int64()), ("slots", pa.list_(pa.string()))])


def _bitmap(items: DataFrame) -> np.ndarray:
    """Which 24-bit hash prefixes the items' windows have; ``PARTS`` pieces are merged apart from each other."""

    def run(batches):
        bits = np.zeros(BITS // 8, np.uint8)
        for batch in batches:
            hashes = batch.column("window").to_numpy(zero_copy_only=False).view(np.uint64)
            np.bitwise_or.at(bits, (hashes >> np.uint64(43)).astype(np.int64), np.uint8(1) << (hashes >> np.uint64(40) & np.uint64(7)).astype(np.uint8))
        if bits.any():
            pieces = [zlib.compress(piece.tobytes(), 1) for piece in bits.reshape(PARTS, -1)]
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(pieces, pa.binary())], ["part", "bits"])

    def merge(key, rows):
        bits = np.zeros(BITS // 8 // PARTS, np.uint8)
        for value in rows.column("bits").to_pylist():
            bits |= np.frombuffer(zlib.decompress(value), np.uint8)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary())})

    found = np.zeros((PARTS, BITS // 8 // PARTS), np.uint8)
    for row in items.select("window").mapInArrow(run, "part int, bits binary").groupBy("part").applyInArrow(merge, "part int, bits binary").collect():
        found[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return found.reshape(-1)


def leaks(docs: DataFrame, benchmark: DataFrame, covered: float = COVERED, partly: float = PARTLY) -> DataFrame:
    """Benchmark items found in documents: doc_id, item_id, matched, windows, coverage, changed, first_word, last_word.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are not read. A row says that at
    least ``covered`` of the item's windows occur in the document with consistent slots, or ``partly`` of them (and
    ``STRETCH`` windows) in one stretch, which lies along one alignment or along neighbouring ones. In a stretch
    an alignment that is inconsistent elsewhere gives only windows with the item's own values. ``changed`` counts
    slots with another value than in the item, the last columns give the stretch in words.
    Windows with fewer than three words that are no placeholders say nothing and are left out on both sides.
    Null and blank texts match nothing; an item of fewer than five words matches a document of the same words
    only. Null ids take no part. Repeated rows change nothing; an item with the text of another is found with it.
    """
    items = stage(_windows(benchmark.where("item_id is not null"), "item_id", None), "item-windows")
    items = items.select(F.col("key").alias("item_id"), "window", F.col("at").alias("item_at"), F.col("total").alias("windows"), F.col("slots").alias("item_slots"))
    found = _windows(docs.where("doc_id is not null"), "doc_id", _bitmap(items))
    found = found.select(F.col("key").alias("doc_id"), "window", "at", "slots").join(items, "window")
    hits = stage(found.withColumn("line", F.col("at") - F.col("item_at")), "leak-windows")
    # Along one alignment a value of the item stands for one of the document, and the other way round.
    lines, one = ["doc_id", "item_id", "line"], ["doc_id", "item_id"]
    slots = hits.where(F.size("slots") == F.size("item_slots")).select(*lines, "at", F.explode(F.arrays_zip("slots", "item_slots")).alias("pair"))
    slots = slots.select(*lines, "at", F.col("pair.slots").alias("value"), F.col("pair.item_slots").alias("item_value"))
    pairs = slots.drop("at").distinct()
    by_item = pairs.groupBy(*lines, "item_value").agg(F.count("*").alias("n")).where("n > 1")
    by_doc = pairs.groupBy(*lines, "value").agg(F.count("*").alias("n")).where("n > 1")
    exchanged = pairs.where("value != item_value")
    broken = exchanged.join(by_item, [*lines, "item_value"], "left_semi").unionByName(exchanged.join(by_doc, [*lines, "value"], "left_semi"))
    broken = stage(broken.distinct(), "leak-values")
    torn = slots.join(broken, [*lines, "value", "item_value"], "left_semi").select(*lines, "at").distinct()
    changed = pairs.groupBy(*one).agg(F.count_if(F.col("value") != F.col("item_value")).alias("changed"))
    loose = broken.select(*lines).distinct().withColumn("loose", F.lit(True))
    held = stage(hits.join(torn, [*lines, "at"], "left_anti").join(loose, lines, "left"), "leak-kept")
    place = [F.min("at").alias("first_word"), (F.max("at") + WINDOW - 1).alias("last_word")]
    counted = held.groupBy(*one).agg(F.countDistinct("item_at").alias("matched"), F.max("windows").alias("windows"), *place)
    whole = counted.withColumn("coverage", F.col("matched") / F.col("windows")).where(F.col("coverage") >= covered)
    # Alignments close to each other form one stretch.
    order = Window.partitionBy(*one).orderBy("line", "at", "item_at")
    firm = held.where(F.col("loose").isNull() | (F.col("slots") == F.col("item_slots")))
    firm = firm.withColumn("apart", (F.col("line") - F.lag("line").over(order) > SHIFT).cast("long"))
    firm = firm.withColumn("stretch", F.sum(F.coalesce("apart", F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    parts = firm.groupBy(*one, "stretch").agg(F.countDistinct("item_at").alias("matched"), F.max("windows").alias("windows"), *place)
    parts = parts.withColumn("coverage", F.col("matched") / F.col("windows")).where((F.col("coverage") >= partly) & (F.col("matched") >= STRETCH))
    # The longest stretch; of equal ones the first.
    shown = F.struct("matched", "windows", "coverage", "first_word", "last_word")
    longest = parts.groupBy(*one).agg(F.min_by(shown, F.struct(-F.col("matched"), F.col("first_word"))).alias("best")).select(*one, "best.*")
    counted = whole.unionByName(longest.join(whole.select(*one), one, "left_anti"), allowMissingColumns=False)
    return counted.join(changed, one, "left").select(
        *one, "matched", "windows", "coverage", F.coalesce("changed", F.lit(0)).alias("changed"), "first_word", "last_word"
    )
