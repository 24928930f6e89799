"""How each kind of vault table takes in a batch. All three ways can be repeated without effect."""
from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakevault.functions.hashing import all_present, comparable, digest, packed, unpacked
from lakevault.operators.history import VERSION_ORDER, decisions
from lakevault.operators.model import IDENTITY, first_row, modelled, own_key, vault_rows
from lakevault.operators.specs import VaultTable
from lakevault.operators.store import RETIRED_TABLE, SEEN_TABLE, VaultStore, compact
from lakevault.session import release

# A batch may be broadcast as a list of keys only while rows x bytes stays below the limit; a
# 64-character hash with its row overhead takes well under 256 bytes.
BROADCAST_BYTES = 64 * 1024 * 1024
KEY_ROW_BYTES = 256

# A first load goes through so many rows at a time, by their keys: the disk holds one slice's shuffle beside the tables.
SLICE_ROWS = 64_000_000

# Actions on stored versions, which are noted beside the table.
NOTED = ("retire", "revive")

# Below this share of different keys some rows of a batch are likely to be no versions; a count is within 5 % or so.
REPEATED = 0.8


@dataclass(frozen=True)
class Written:
    table: str
    kind: str
    staged_rows: int
    appended_rows: int


def fits_broadcast(rows: int) -> bool:
    return rows * KEY_ROW_BYTES <= BROADCAST_BYTES


def missing_rows(rows: DataFrame, stored: DataFrame, key: list[str], small_batch: bool) -> DataFrame:
    """One row per key the table does not have."""
    return lacking(first_row(rows, key), rows, stored, key, small_batch)


def lacking(unique: DataFrame, rows: DataFrame, stored: DataFrame, key: list[str], small_batch: bool) -> DataFrame:
    """Of one row per key of the batch ``rows`` those the table does not have.

    For a small batch the stored table is scanned where it lies: first narrowed to the batch's own
    keys, which leaves at most one row per batch key, then subtracted. A large batch is joined by
    shuffle, or bucket by bucket when the table is bucketed.
    """
    known = stored.select(*key)
    if small_batch:
        known = F.broadcast(known.join(F.broadcast(rows.select(*key)), key, "left_semi"))
    return unique.join(known, key, "left_anti")


def sliced(rows: DataFrame, number: int, slices: int) -> DataFrame:
    """One of so many slices of source rows; all rows of a key are in the same one."""
    return rows if slices == 1 else rows.where(F.pmod(F.xxhash64(IDENTITY), F.lit(slices)) == number)


def insert_missing(store: VaultStore, table: VaultTable, rows: DataFrame, batch_rows: int, first: bool | None = None) -> int:
    """Hubs and links: one row per key, keys already stored stay as they are. With ``first`` none of the keys is stored."""
    plain = IDENTITY in rows.columns
    own = [*table.payload, "load_dts", "record_source"]
    rest = [name for name in rows.columns if name not in (*own, IDENTITY)]
    unique = first_row(rows, [IDENTITY], [*own, *rest]) if plain else first_row(rows, table.key)
    if store.is_empty(table.name) if first is None else first:
        return store.append(table, modelled(unique, table))
    stored, small = store.read(table.name), fits_broadcast(batch_rows)
    if small or store.buckets or not plain:
        missing = lacking(modelled(unique, table), modelled(rows, table), stored, table.key, small)
    elif set(table.identity) <= set(table.payload):  # a hub's rows name their business key, much shorter than its digest
        known = stored.select(comparable(table.identity).alias(IDENTITY))
        missing = modelled(unknown(rows, known, IDENTITY, [*own, *rest]), table)
    else:  # of a batch row only the key is digested before it meets the stored keys
        known = stored.select(packed(table.key[0]).alias("_packed"))
        named = rows.withColumn("_packed", packed(own_key())).drop(IDENTITY)
        missing = modelled(unknown(named, known, "_packed", [*own, *rest]), table, unpacked("_packed"))
    return store.append(table, missing)


def unknown(rows: DataFrame, known: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row by ``order`` of each key that is not among the known ones, by one shuffle of rows and known keys together."""
    both = rows.withColumn("_new", F.lit(True)).unionByName(known.withColumn("_new", F.lit(False)), allowMissingColumns=True)
    return first_row(both, [key], ["_new", *order]).where("_new").drop("_new")


def append_versions(store: VaultStore, table: VaultTable, rows: DataFrame, batch_rows: int, first: bool | None = None) -> int:
    """Satellites: versions that differ from the row before them, in any order of arrival.

    Rows that are no versions are remembered beside the table, and versions that a late row made superfluous are noted as
    retired; ``store.versions`` leaves those out. Beside stored rows, where there are notes already or keys repeat in the batch,
    decisions are worked out once and parked for the writes of versions and notes. Else versions are appended first and counted together
    with what else there is to note, so a batch of new versions alone needs no second look. A load that dies in between and
    is repeated comes to the same, because the notes then follow from the stored tables. With ``first`` none of the keys is stored.

    Rows are compared under packed keys and hashdiffs, those of a first batch of source rows under their identities.
    """
    small, key = fits_broadcast(batch_rows), table.key[0]
    first, plain = store.is_empty(table.name) if first is None else first, IDENTITY in rows.columns
    most_rows = batch_rows if first else batch_rows + store.rows(table.name).count()
    remembered = None if first else store.noted(table, SEEN_TABLE)
    most_rows += remembered.count() if remembered is not None else 0
    by_identity = first and plain

    if plain:
        incoming = rows.withColumnRenamed(IDENTITY, key) if by_identity else rows.withColumn(key, packed(own_key())).drop(IDENTITY)
        hashdiff = packed(digest(table.compared_columns))
    else:
        incoming, hashdiff = compact(rows, table), None

    def decided(observed: Observation | None = None) -> DataFrame:
        known = {}
        if not first:
            stored = store.compact_versions(table.name) if small else compact(store.rows(table.name), table)
            known = {"live": stored, "retired": store.retired(table)}
            known["seen"] = None if remembered is None else compact(remembered, table)
        found = decisions(incoming, key, **known, small_batch=small, most_rows=most_rows, hashdiff=hashdiff)
        if observed is not None:
            kinds = [F.count_if(F.col("action") == kind).alias(kind) for kind in ("version", "seen", *NOTED)]
            found = found.observe(observed, *kinds)
        return found

    def whole(found: DataFrame) -> DataFrame:
        return found.withColumns({key: own_key(key) if by_identity else unpacked(key), "hashdiff": unpacked("hashdiff")})

    def note(found: Callable[[], DataFrame], left: dict[str, int]) -> None:
        if left.get("seen"):
            store.append(store.ensure_note(table, SEEN_TABLE), whole(found().where("action = 'seen'")))
        if any(left.get(kind) for kind in NOTED):
            notes = whole(found().where(F.col("action").isin(*NOTED)))
            notes = notes.select(key, *VERSION_ORDER, (F.col("action") == "retire").alias("dead"), F.lit(time.time_ns()).alias("turn"))
            store.append(store.ensure_note(table, RETIRED_TABLE), notes)

    observed = Observation()
    likely = not first and (remembered is not None or store.noted(table, RETIRED_TABLE) is not None or repeats(incoming, key, batch_rows))
    if not likely:
        appended = store.append(table, whole(decided(observed).where("action = 'version'")))
        note(decided, observed.get)
        return appended
    found = decided(observed)
    if hashdiff is not None:  # of rows that carry what is digested the hashdiff need not be written
        found = found.withColumn("hashdiff", F.when(F.col("action").isin(*NOTED), F.col("hashdiff")))
    with store.parked(found) as kept:
        if hashdiff is not None:
            kept = kept.withColumn("hashdiff", F.coalesce("hashdiff", hashdiff))
        left = observed.get
        appended = store.append(table, whole(kept.where("action = 'version'"))) if left.get("version") else 0
        note(lambda: kept, left)
    return appended


def repeats(rows: DataFrame, key: str, total: int) -> bool:
    """Does a batch bring many rows of one key? About: it only decides how decisions are written."""
    return rows.agg(F.approx_count_distinct(key)).first()[0] < REPEATED * total


def upsert(store: VaultStore, table: VaultTable, rows: DataFrame, batch_rows: int) -> int:
    """References: a row that differs from the stored one, or has none, becomes the newest."""
    unique = first_row(rows, table.key)
    if not store.is_empty(table.name):
        columns = [*table.natural_key, *table.payload]
        same = [F.col(f"n.{name}").eqNullSafe(F.col(f"o.{name}")) for name in columns]
        unique = unique.alias("n").join(store.read(table.name).alias("o"), same, "left_anti")
    return store.append(table, unique)


def keep_up(store: VaultStore, table: VaultTable, rows: DataFrame, batch_rows: int) -> Written:
    """Take a batch of source rows into a table that is kept up from them, such as averages over all batches."""
    ready = vault_rows(rows, table)
    store.ensure_table(table, ready.schema)
    if batch_rows == 0:
        return Written(table.name, table.kind, 0, 0)
    with store.lease(table.name):
        kept = table.upkeep(store.spark, f"{store.root}/{table.name}_kept", table.key, list(table.payload))
        changed, batches = kept.take(rows.where(all_present(table.identity)) if table.prepare is None else rows)
        appended = upsert(store, table, changed.where(all_present(table.identity)).select(*ready.columns), batch_rows)
        kept.close(batches)
    return Written(table.name, table.kind, batch_rows, appended)


STRATEGIES = {
    "hub": insert_missing,
    "link": insert_missing,
    "satellite": append_versions,
    "reference": upsert,
}


def write(store: VaultStore, table: VaultTable, rows: DataFrame, batch_rows: int) -> Written:
    """Take a batch into a table by the strategy of its kind; ``rows`` are its vault rows, or better their ``source_rows``."""
    if table.kind not in STRATEGIES:
        raise ValueError(f"unknown kind of vault table: {table.kind}")
    store.ensure_table(table, modelled(rows, table).schema)
    if batch_rows == 0:
        return Written(table.name, table.kind, 0, 0)
    with store.lease(table.name):
        slices = -(-batch_rows // SLICE_ROWS) if IDENTITY in rows.columns and store.is_empty(table.name) else 1
        if slices == 1:
            return Written(table.name, table.kind, batch_rows, STRATEGIES[table.kind](store, table, rows, batch_rows))
        appended = 0
        for number in range(slices):
            appended += STRATEGIES[table.kind](store, table, sliced(rows, number, slices), batch_rows, first=True)
            release(store.spark)
    return Written(table.name, table.kind, batch_rows, appended)
