"""Token counts by heap-and-linked-list byte-pair merging; no token identifiers are made.

A word starts as its bytes, linked in a list. A heap holds the adjacent pairs that can merge; the pair of
lowest rank (of equal ones the leftmost) is popped and merged again and again. The word's count is its
number of bytes minus its number of merges. A merge never crosses a word, so each distinct word is counted
once per worker and looked up afterwards.
"""
from __future__ import annotations

import heapq
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from lakevault.llm.common import CACHE_WORDS, WordTable, slices, sums, texts

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

# White space as Unicode defines it (fixed values).
SPACE = "\t-\r \x85\xa0  -     　"
# A run of white space but for the last before a word; a word with one blank before it; other white space.
COARSE = re.compile(f"[{SPACE}]+(?![^{SPACE}])| ?[^{SPACE}]+|[{SPACE}]+")
# The byte-level split of the public vocabulary (fixed pattern), inside one coarse piece.
FINE = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+")


def printable_bytes() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it prints, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in shown]
    names = dict(zip(shown, map(chr, shown))) | {byte: chr(256 + k) for k, byte in enumerate(hidden)}
    return [names[byte] for byte in range(256)]


class Merges:
    """The merge rules of a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, split = content["model"], content["pre_tokenizer"]
        plain = model["type"] == "BPE" and not model.get("ignore_merges") and content["normalizer"] is None
        if not plain or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
            raise ValueError(f"{path} is no plain byte-level vocabulary")
        added = content["added_tokens"]
        if any(token[flag] for token in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path} has added tokens that take in their surroundings")
        self.added = [token["content"] for token in added]
        numbers = {name: byte for byte, name in enumerate(printable_bytes())}
        # Pair of symbols -> rank, and rank -> merged symbol.
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, (left, right) in enumerate(model["merges"]):
            self.merged.append(numbers.setdefault(left + right, len(numbers)))
            self.ranks.setdefault(numbers[left] << 20 | numbers[right], rank)
        self.words: dict[str, int] = {}

    def count(self, word: bytes) -> int:
        """Tokens of one word: symbols minus merges."""
        symbols, rank_of = list(word), self.ranks.get
        size = len(symbols)
        heap = []
        left = symbols[0]
        for at in range(1, size):
            right = symbols[at]
            rank = rank_of(left << 20 | right)
            if rank is not None:
                heap.append(rank << 36 | at - 1)
            left = right
        if not heap:
            return size
        heapq.heapify(heap)
        pop, push, merged = heapq.heappop, heapq.heappush, self.merged
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        merges = 0
        while heap:
            entry = pop(heap)
            rank, at = entry >> 36, entry & 0xFFFFFFFFF
            right = after[at]
            # Out of date: one of the two has merged with another neighbour since.
            if symbols[at] < 0 or right >= size or rank_of(symbols[at] << 20 | symbols[right]) != rank:
                continue
            merges += 1
            symbol = symbols[at] = merged[rank]
            symbols[right] = -1
            follow = after[at] = after[right]
            if follow < size:
                before[follow] = at
                rank = rank_of(symbol << 20 | symbols[follow])
                if rank is not None:
                    push(heap, rank << 36 | at)
            ahead = before[at]
            if ahead >= 0:
                rank = rank_of(symbols[ahead] << 20 | symbol)
                if rank is not None:
                    push(heap, rank << 36 | ahead)
        return size - merges

    def count_word(self, word: str) -> int:
        found = self.words.get(word)
        if found is None:
            found = self.count(word.encode())
            if len(word) <= 64:
                if len(self.words) >= CACHE_WORDS:
                    self.words.clear()
                self.words[word] = found
        return found

    def count_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Counts of coarse pieces; each is split into words first."""
        counts = [1 if piece in self.added else sum(map(self.count_word, FINE.findall(piece))) for piece in pieces]
        return np.array(counts, np.int32), np.ones(len(pieces), np.int64)

    def splitter(self):
        """Splits a text into coarse pieces; strings of added tokens are pieces of their own."""
        if not self.added:
            return COARSE.findall
        cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        added = set(self.added)

        def split(text: str) -> list[str]:
            if not any(token in text for token in added):
                return COARSE.findall(text)
            return [piece for part in cut.split(text) for piece in ([part] if part in added else COARSE.findall(part))]

        return split


# Tables of one worker by vocabulary file; kept between the tasks it runs.
_tables: dict[str, tuple] = {}


def _table(path: str) -> tuple:
    if path not in _tables:
        merges = Merges(path)
        _tables[path] = (merges.splitter(), WordTable(merges.count_pieces))
    return _tables[path]


def token_counts(docs: DataFrame, path: str, limit: int = 1024, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Tokens of every whole text under a byte-level vocabulary file.

    One row for each row of ``docs``, repeated ones included. A null text counts as empty: 0 bytes, 0 tokens.
    Null ids stay null. Other columns are not read. Memory is bounded by a slice of texts and the worker's
    word table; there is no shuffle.
    """

    def count(batches):
        split, table = _table(path)
        for batch in slices(batches, "text"):
            codes, ends = table.encode(split, texts(batch, "text"))
            values, _ = table.gather(codes)  # one value each
            tokens = sums(values.astype(np.int64), ends)
            size = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), size, pa.array(tokens), pa.array(tokens > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

    rows = docs.selectExpr(f"cast(`{id_column}` as long) as doc_id", f"cast(`{text_column}` as string) as text")
    return rows.mapInArrow(count, SCHEMA)
