"""Fill-in-the-middle: texts cut at unit borders into prefix, middle and suffix, and put in another order.

A unit is a run of the letters A-Z and a-z or any other single code point. Each text is divided into fixed blocks of
bytes; a Fenwick tree over the blocks holds how many units and how many code points begin in each. The place where a
given unit begins is found by binary lifting down the tree, which ends at its block, and then inside that block alone.
"""
from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import slices

BLOCK = 1 << 10
# Blocks whose bytes are looked at at once, which bounds the memory of a very long text.
STRETCH = 1 << 10
PLAIN, PSM, SPM = "plain", "psm", "spm"
# Marks in front of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")

LETTER = np.zeros(256, bool)
LETTER[ord("A") : ord("Z") + 1] = True
LETTER[ord("a") : ord("z") + 1] = True


class BlockTree:
    """Units and code points of one UTF-8 text, by block, as a Fenwick tree."""

    def __init__(self, data: bytes, block: int = BLOCK):
        self.data, self.block = np.frombuffer(data, np.uint8), block
        many = -(-len(data) // block)
        sums = np.zeros((many + 1, 2), np.int64)
        for start in range(0, many, STRETCH):
            units, points = self.begins(start * block, min(len(data), (start + STRETCH) * block))
            cuts = np.arange(0, len(units), block)
            rows = slice(start + 1, start + 1 + len(cuts))
            sums[rows, 0], sums[rows, 1] = np.add.reduceat(units, cuts, dtype=np.int64), np.add.reduceat(points, cuts, dtype=np.int64)
        sums = np.cumsum(sums, axis=0)
        self.units, self.points = int(sums[-1, 0]), int(sums[-1, 1])
        # Node i sums up the blocks behind i without its lowest bit, up to i.
        at = np.arange(many + 1)
        self.tree = (sums - sums[at & (at - 1)]).tolist()
        self.top = 1 << (many.bit_length() - 1) if many else 0

    def begins(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of the bytes begin a unit, and which a code point."""
        part = self.data[start:end]
        points = (part & 0xC0) != 0x80
        letters = LETTER[part]
        behind = np.empty_like(letters)
        behind[1:] = letters[:-1]
        behind[:1] = start > 0 and LETTER[self.data[start - 1]]
        return points & ~(letters & behind), points

    def place(self, unit: int) -> tuple[int, int]:
        """Bytes and code points in front of a unit (counted from 0); of the whole text if it has no such unit."""
        if unit >= self.units:
            return len(self.data), self.points
        node, units, points, step = 0, 0, 0, self.top
        while step:
            ahead = node + step
            if ahead < len(self.tree) and units + self.tree[ahead][0] <= unit:
                node, units, points = ahead, units + self.tree[ahead][0], points + self.tree[ahead][1]
            step >>= 1
        start = node * self.block
        begins, code = self.begins(start, min(len(self.data), start + self.block))
        inside = int(np.flatnonzero(begins)[unit - units])
        return start + inside, points + int(np.count_nonzero(code[:inside]))


def numbers(seed: str, key) -> list[int]:
    """Four 32-bit numbers that seed and key decide."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def check_marks(marks: tuple[str, str, str]) -> None:
    """Marks must stay apart: none inside another one, and none that ends with the beginning of one."""
    if len(set(marks)) < 3 or not all(marks):
        raise ValueError("three different marks are needed")
    for a in marks:
        for b in marks:
            if (a != b and b in a) or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))):
                raise ValueError(f"the marks {a!r} and {b!r} can run into each other")


def transform(
    docs: DataFrame, seed: str = "1", plain_percent: int = 10, spm_percent: int = 20, marks: tuple[str, str, str] = MARKS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Every text with its middle moved to the end: doc_id, n (units), form, prefix_chars, middle_chars, output.

    Form ``psm`` is prefix, suffix, middle, each behind its mark, ``spm`` suffix, prefix, middle; ``plain`` leaves the
    text as it is, which befalls empty texts, texts that contain a mark and ``plain_percent`` of the others. Of the
    rest ``spm_percent`` become spm. Seed and id alone decide, so rows that share an id are cut by the same rule
    and any order or partition of the rows gives the same; a null id counts as an empty one. A null text counts as empty
    (n 0, plain, an empty output). The character counts are null if plain. One row for each row, no other columns.
    """
    check_marks(marks)
    signs = [mark.encode() for mark in marks]

    def cut(batches):
        for batch in slices(batches, "text"):
            rows = []
            for key, value in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                text = value.as_py() or b""
                tree = BlockTree(text)
                h1, h2, h3, h4 = numbers(seed, key)
                if not text or h3 % 100 >= 100 - plain_percent or any(sign in text for sign in signs):
                    rows.append((tree.units, PLAIN, None, None, text))
                    continue
                first, second = sorted((h1 % (tree.units + 1), h2 % (tree.units + 1)))
                (start, before), (end, until) = tree.place(first), tree.place(second)
                prefix, middle, suffix = signs[0] + text[:start], signs[2] + text[start:end], signs[1] + text[end:]
                spm = h4 % 100 < spm_percent
                rows.append((tree.units, SPM if spm else PSM, before, until - before, (suffix + prefix if spm else prefix + suffix) + middle))
            n, form, before, middle, output = zip(*rows)
            columns = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()), pa.array(middle, pa.int64())]
            written = pa.array(output, pa.binary())
            text = pa.StringArray.from_buffers(len(written), written.buffers()[1], written.buffers()[2])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, text], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.selectExpr(f"cast(`{id_column}` as long) as doc_id", f"cast(`{text_column}` as string) as text")
    return rows.mapInArrow(cut, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text behind an output and its form. Only texts without marks were cut, so the marks divide an output into its parts."""
    parts = F.split(output, "|".join(map(re.escape, marks)), -1)
    return (
        F.when(form == PSM, F.concat(parts[1], parts[3], parts[2]))
        .when(form == SPM, F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )
