"""From dataset rows to vault rows."""
from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakevault.functions.hashing import all_present, comparable, digest
from lakevault.operators.specs import VaultTable

# Position of a row among the versions of its key: when it became valid, then a tie-break. Kept in
# every satellite, so that versions are ordered by what happened and not by when a job ran.
SEQ_SCHEMA = StructType().add("at", "timestamp").add("tie", "string")


def sequence(at: str, tie: str) -> Column:
    """The ``seq`` column from a timestamp-like and a text-like column."""
    return F.struct(F.col(at).cast("timestamp").alias("at"), F.col(tie).cast("string").alias("tie")).alias("seq")


def stamped(df: DataFrame, record_source: str, load_dts: dt.datetime) -> DataFrame:
    """Add one load time for the whole batch (a literal, the same in every table) and the source."""
    return df.withColumns(
        {"load_dts": F.lit(load_dts).cast("timestamp"), "record_source": F.lit(record_source)}
    )


def hashdiff_name(table: VaultTable) -> str:
    return f"{table.name}_hashdiff"


def hashed(df: DataFrame, tables: Iterable[VaultTable]) -> DataFrame:
    """Add every hash key and hashdiff the tables need, each one once.

    Written to the staged batch, they are read back as plain columns by all tables and joins that
    use them instead of being computed again in each.
    """
    columns = {}
    for table in tables:
        columns.update({name: digest(parts) for name, parts in table.digests.items()})
        if table.kind == "satellite":
            columns[hashdiff_name(table)] = digest(table.compared_columns)
    return df.withColumns({name: column for name, column in columns.items() if name not in df.columns})


def vault_rows(df: DataFrame, table: VaultTable) -> DataFrame:
    """The rows a dataset contributes to one vault table, lazily; duplicates are settled by the merge."""
    source = table.prepare(df) if table.prepare else hashed(df, [table])
    if table.kind == "reference" and "seq" in source.columns:
        # Of the rows of a key the newest counts, of equally new ones the first by content.
        source = first_row(source.where(all_present(table.identity)), table.key, [F.desc("seq"), *table.payload])
    columns = [*table.digests, *table.natural_key, *table.payload]
    if table.kind == "satellite":
        columns += [F.col(hashdiff_name(table)).alias("hashdiff"), "seq"]
    return source.where(all_present(table.identity)).select(*columns, "load_dts", "record_source")


# The comparable text of a row's business key: what the table's own key digests, and a good deal shorter.
IDENTITY = "_identity"


def source_rows(df: DataFrame, table: VaultTable) -> DataFrame:
    """What a hub, link or satellite needs of a dataset's rows, before any digest.

    Digests are most of a vault row's bytes and hardly compress, so rows travel without them: equal identities have equal
    keys, and ``modelled`` adds the digests to the rows that are left.
    """
    others = [name for names in list(table.digests.values())[1:] for name in names]
    columns = dict.fromkeys([*others, *table.payload, *(("seq",) if table.kind == "satellite" else ()), "load_dts", "record_source"])
    return df.where(all_present(table.identity)).select(*columns, comparable(table.identity).alias(IDENTITY))


def own_key(identity: str = IDENTITY) -> Column:
    """A table's own key, from the comparable text of its business key."""
    return F.sha2(identity, 256)


def modelled(rows: DataFrame, table: VaultTable, key: Column | None = None) -> DataFrame:
    """The vault rows of ``source_rows``, or of such without identity if ``key`` says what their own key is; rows that are
    vault rows already stay as they are."""
    if key is None and IDENTITY not in rows.columns:
        return rows
    name, *others = table.digests
    columns = [(own_key() if key is None else key).alias(name), *(digest(table.digests[name]).alias(name) for name in others), *table.natural_key, *table.payload]
    if table.kind == "satellite":
        columns += [digest(table.compared_columns).alias("hashdiff"), "seq"]
    return rows.select(*columns, "load_dts", "record_source")


def first_row(df: DataFrame, key: list[str], order: list | None = None) -> DataFrame:
    """Exactly one row per key: the smallest by the given order, by default by all other columns.

    The rank filter becomes a group limit before the shuffle, so each task sends at most one row
    per key however often a key repeats.
    """
    by = order or [name for name in df.columns if name not in key] or key
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*by)))
    return ranked.where("_rank = 1").drop("_rank")
