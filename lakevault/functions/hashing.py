"""Business-key digests.

Fixed recipe, equal in the batch and the event layer so that both feed the same hubs: every part as
text, spaces trimmed at both ends, upper case, null as the empty text; parts joined by ``||``;
SHA-256 in lower-case hex. Two consequences are part of the recipe: changes of letter case or outer
spaces are no changes, and a value that contains ``||`` can collide with its split form.
"""
from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SEPARATOR = "||"


def canonical(name: str) -> Column:
    """The comparable text of one key part."""
    text = F.upper(F.trim(F.col(name).cast("string")))
    return F.coalesce(text, F.lit(""))


def comparable(names: Iterable[str]) -> Column:
    """The text that ``digest`` digests."""
    return F.concat_ws(SEPARATOR, *(canonical(name) for name in names))


def digest(names: Iterable[str]) -> Column:
    """SHA-256 over the canonical parts."""
    return F.sha2(comparable(names), 256)


def packed(hex_digest: str | Column) -> Column:
    """A digest in half the bytes; sorts like its text."""
    return F.unhex(hex_digest)


def brief(digest_bytes: str | Column) -> Column:
    """The first 128 bits of a packed digest: enough to tell keys apart and to sort them, where the digest itself is not shown."""
    return F.substring(digest_bytes, 1, 16)


def unpacked(digest_bytes: str) -> Column:
    """The text of a packed digest."""
    return F.lower(F.hex(digest_bytes))


def all_present(names: Iterable[str]) -> Column:
    """True when no named column is null; true for no columns at all."""
    return reduce(Column.__and__, (F.col(name).isNotNull() for name in names), F.lit(True))


def fingerprint(rows: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a row: what rows that are compared as a whole meet by, much shorter than the row.

    A hash passes over nulls, so each value goes in beside the word whether it is one.
    """
    leaves = []
    for field in rows.schema.fields:
        inner = field.dataType.names if isinstance(field.dataType, StructType) else None
        leaves += [F.col(f"`{field.name}`")] if inner is None else [F.col(f"`{field.name}`.`{name}`") for name in inner]
    parts = [part for leaf in leaves for part in (leaf.isNull(), leaf)]
    return [F.xxhash64(F.lit(seed), *parts).alias(f"_row_{seed}") for seed in (1, 2)]
