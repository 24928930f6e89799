"""Token identifiers in a compact file: frequency ranks in byte-aligned variable-length code.

A written folder holds two Parquet tables. ``ranks`` lists the identifiers by falling frequency; a token is
stored as its rank there, so frequent tokens take one byte. ``blocks`` holds whole documents in ascending id
order, about ``BLOCK_TOKENS`` tokens to a block:

    part, block   where the block stands; parts follow each other in id order
    first         tokens of the part before the block
    doc_ids       identifiers of the block's documents
    sizes         their token counts
    control       two bits for each token, four tokens to a byte, lowest bits first: bytes of its rank, less one
    data          the ranks' bytes, lowest first, without the zero bytes above

Readers look up each control byte in a table of four lengths and take all ranks of a block at once. Spark
writes and commits the tables, so a lost executor leaves no torn file and any file system Spark knows will do.
"""
from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.llm.common import WordTable, ragged, rows_of, slices, sums, texts

BLOCK_TOKENS = 1 << 16
# Bytes of the four ranks under each control byte.
LENGTHS = np.array([[1 + (byte >> 2 * k & 3) for k in range(4)] for byte in range(256)], np.uint8)
# Texts are cut at blanks. Four control characters that are blanks to ``str.split`` are none to the tokenizer.
PIECE = re.compile("[^ \t\n\r]+")
CONTROLS = "\x1c\x1d\x1e\x1f"


def pieces(text: str) -> list[str]:
    """The pieces of a text in lower case, letter by letter as the tokenizer has it."""
    text = text.replace("Σ", "σ").lower()
    return PIECE.findall(text) if any(control in text for control in CONTROLS) else text.split()


# Letter words of a call to the tokenizer; calls cost more than words.
JOINED = 256
WORD_END = "</w>"


# A worker's table of distinct pieces holds so many; a piece takes about 200 bytes.
TABLE_PIECES, TABLE_CHARS = 400_000, 32 << 20


class Pieces:
    """Encodes pieces between blanks with the public tokenizer.

    Special strings are cut out of the original text, before it is lower-cased, and travel as pieces of their own with a
    blank in front, which no other piece has. In all other pieces their letters are ordinary text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        # These two would make a text's tokens depend on its length.
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder().items()
        if any(token.single_word or token.lstrip or token.rstrip or token.normalized for _, token in added):
            raise ValueError(f"{path} has special strings that depend on what is around them")
        self.special = {f" {token.content}": number for number, token in added}
        strings = sorted((token.content for _, token in added), key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, strings))})") if strings else None
        self.openings = tuple({string[:2] for string in strings})
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.closes = np.zeros(self.size, bool)
        self.closes[[number for token, number in vocabulary.items() if token.endswith(WORD_END)]] = True

    def split(self, text: str) -> list[str]:
        if not any(opening in text for opening in self.openings):
            return pieces(text)
        found = []
        for at, part in enumerate(self.cut.split(text)):
            found += [f" {part}"] if at % 2 else pieces(part)
        return found

    def plain(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return rows_of([[self.special[piece]] if piece in self.special else found.ids for piece, found in zip(pieces, encoded)])

    def joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters alone, encoded in one text; each one's last token says that it ends a word."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.int32)
        lengths = np.diff(np.flatnonzero(self.closes[ids]) + 1, prepend=0)
        return (ids, lengths) if len(lengths) == len(words) else self.plain(words)

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letters, and the full stops and commas behind them, never merge: they are encoded apart, each kind once."""
        words: dict[str, int] = {}
        others: dict[str, int] = {"": 0}
        heads, tails = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        for at, piece in enumerate(pieces):
            word = piece.rstrip(".,")
            if word.isalpha():
                heads[at] = words.setdefault(word, len(words))
                if len(word) < len(piece):
                    tails[at] = others.setdefault(piece[len(word) :], len(others))
            else:
                heads[at] = -1
                tails[at] = others.setdefault(piece, len(others))
        listed = list(words)
        parts = [self.joined(listed[at : at + JOINED]) for at in range(0, len(listed), JOINED)] + [self.plain(list(others))]
        lengths = np.concatenate([part for _, part in parts])
        flat, starts = np.concatenate([part for part, _ in parts]), np.cumsum(lengths) - lengths
        nothing = len(listed)  # the empty piece
        rows = np.stack([np.where(heads < 0, nothing, heads), nothing + tails], 1)
        values, _ = ragged(flat, starts, lengths, rows.reshape(-1))
        return values, lengths[rows].sum(1)


_tables: dict[str, tuple[WordTable, Pieces]] = {}


def _table(path: str) -> tuple[WordTable, Pieces]:
    if path not in _tables:
        coder = Pieces(path)
        _tables[path] = WordTable(coder.encode, words=TABLE_PIECES, chars=TABLE_CHARS), coder
    return _tables[path]


COUNTS = pa.list_(pa.struct([("id", pa.int32()), ("n", pa.int64())]))
TOKENS = "doc_id long, n_tokens long, ids binary"
COUNTED = f"{TOKENS}, counted array<struct<id: int, n: bigint>>"


def tokenize(
    docs: DataFrame, path: str, end_id: int = 1, width: int = 4, id_column: str = "doc_id", text_column: str = "text", count: bool = False
) -> DataFrame:
    """Identifiers of every whole text under a vocabulary that drops white space, with ``end_id`` at the end.

    One row for each row: doc_id, n_tokens, ids (little-endian unsigned numbers of ``width`` bytes, 2 or 4). Such a vocabulary never
    joins what blanks separate, so each distinct piece between blanks is encoded once per worker. A null text
    counts as empty and gets the end id alone.

    With ``count`` there is one more column, ``counted``, and one more row for each task that had rows: how often it gave
    out each identifier, for ``write_tokens``. Only such rows have it; their other columns are null.
    """

    def encode(batches):
        table, coder = _table(path)
        total = np.zeros(max(coder.size, end_id + 1), np.int64)
        for batch in slices(batches, "text"):
            codes, ends = table.encode(coder.split, texts(batch, "text"))
            values, counts = table.gather(codes)
            stops = np.cumsum(sums(counts, ends))
            values = np.insert(values, stops, end_id)
            if count:
                total += np.bincount(values, minlength=len(total))
            values = values.astype(f"<u{width}")
            stops = stops + np.arange(1, len(stops) + 1)
            offsets = pa.py_buffer(np.concatenate([[0], width * stops]).astype(np.int64))
            ids = pa.Array.from_buffers(pa.large_binary(), len(stops), [None, offsets, pa.py_buffer(values)]).cast(pa.binary())
            columns = [batch.column("doc_id"), pa.array(np.diff(stops, prepend=0)), ids]
            if count:
                columns.append(pa.nulls(len(ids), COUNTS))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "counted"][: len(columns)])
        if total.any():
            seen = np.flatnonzero(total)
            pairs = pa.StructArray.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["id", "n"])
            counted = pa.ListArray.from_arrays(pa.array([0, len(seen)], pa.int32()), pairs)
            none = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.nulls(1, pa.binary()), counted], ["doc_id", "n_tokens", "ids", "counted"])

    rows = docs.selectExpr(f"cast(`{id_column}` as long) as doc_id", f"cast(`{text_column}` as string) as text")
    return rows.mapInArrow(encode, COUNTED if count else TOKENS)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit ranks."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    codes = ((ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)).astype(np.uint8)
    padded = np.zeros(-(-len(codes) // 4) * 4, np.uint8)
    padded[: len(codes)] = codes
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= codes[:, None]]
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, size: int) -> np.ndarray:
    """The ``size`` ranks behind control and data bytes."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:size]
    stored = np.frombuffer(data, np.uint8)
    at = np.cumsum(lengths, dtype=np.int64) - lengths
    ranks = stored[at].astype(np.uint32)
    for k in range(1, 4):
        longer = np.flatnonzero(lengths > k)
        ranks[longer] |= stored[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


def frequencies(encoded: DataFrame, width: int = 4) -> DataFrame:
    """How often each identifier occurs, from the counts that ``tokenize`` kept or, without them, from the rows."""
    if "counted" in encoded.columns:
        kept = encoded.where("counted is not null").select(F.explode("counted").alias("one"))
        return kept.groupBy(F.col("one.id").cast("long").alias("id")).agg(F.sum("one.n").alias("n"))

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for value in batch.column("ids"):
                found = np.bincount(np.frombuffer(value.as_buffer(), f"<u{width}"))
                if len(found) > len(total):
                    found, total = total, found
                total[: len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    return encoded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_tokens(encoded: DataFrame, path: str, width: int = 4) -> None:
    """Write ``tokenize`` rows (read more than once, so stage them first) as a token folder.

    Rows are exchanged once, into ranges of ids; null ids come first, equal ids in the order of their tokens.
    ``width`` is that of ``tokenize``. Only the ranks, at most as many as the vocabulary has entries, pass the driver.
    """
    spark = encoded.sparkSession
    ordered = frequencies(encoded, width).orderBy(F.desc("n"), "id").collect()
    ids = np.array([row["id"] for row in ordered], np.int64)
    counts = [row["n"] for row in ordered]
    listed = [(rank, int(token), n) for rank, (token, n) in enumerate(zip(ids, counts))]
    spark.createDataFrame(listed, "rank int, id long, n long").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint32)
    rank_of[ids] = np.arange(len(ids), dtype=np.uint32)

    def blocks(batches):
        part, number, first = TaskContext.get().partitionId(), 0, 0
        docs, sizes, waiting = [], [], []

        def block():
            nonlocal number, first, docs, sizes, waiting
            tokens = np.concatenate(waiting)
            control, data = pack(rank_of[tokens])
            row = {"part": part, "block": number, "first": first, "n_tokens": len(tokens), "doc_ids": docs, "sizes": sizes, "control": control, "data": data}
            number, first, docs, sizes, waiting = number + 1, first + len(tokens), [], [], []
            return pa.RecordBatch.from_pylist([row], schema=BLOCK_ARROW)

        filled = 0
        for batch in batches:
            for doc, value in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                tokens = np.frombuffer(value.as_buffer(), f"<u{width}")
                docs.append(doc)
                sizes.append(len(tokens))
                waiting.append(tokens)
                filled += len(tokens)
                if filled >= BLOCK_TOKENS:
                    yield block()
                    filled = 0
        if docs:
            yield block()

    rows = encoded.where("counted is null") if "counted" in encoded.columns else encoded
    ranged = rows.select("doc_id", "ids").repartitionByRange(F.col("doc_id").asc_nulls_first())
    ranged = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")
    ranged.mapInArrow(blocks, BLOCK_SCHEMA).write.parquet(f"{path}/blocks")


BLOCK_SCHEMA = "part int, block int, first long, n_tokens long, doc_ids array<long>, sizes array<int>, control binary, data binary"
BLOCK_ARROW = pa.schema(
    [("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
     ("sizes", pa.list_(pa.int32())), ("control", pa.binary()), ("data", pa.binary())]
)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a token folder: doc_id, start (tokens of all documents before it), n_tokens, ids (little-endian unsigned 32-bit numbers)."""
    ranks = spark.read.schema("rank int, id long, n long").parquet(f"{path}/ranks").select("rank", "id").collect()
    id_of = np.zeros(max(1, len(ranks)), "<u4")
    id_of[[row["rank"] for row in ranks]] = [row["id"] for row in ranks]
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    # One row for each written part: its tokens, of which running sums give where it starts.
    sizes = sorted(tuple(row) for row in blocks.groupBy("part").agg(F.sum("n_tokens")).collect())
    before = dict(zip([part for part, _ in sizes], np.cumsum([0, *(n for _, n in sizes)]).tolist()))

    def decode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                tokens = id_of[unpack(row["control"], row["data"], row["n_tokens"])]
                sizes = np.array(row["sizes"], np.int64)
                ends = np.cumsum(sizes)
                starts = before[row["part"]] + row["first"] + ends - sizes
                ids = [tokens[end - size : end].tobytes() for size, end in zip(sizes.tolist(), ends.tolist())]
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(starts), pa.array(sizes), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])

    return blocks.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")
