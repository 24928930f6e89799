"""Versions of a satellite: which rows are new, which stop being versions, and which one is current.

A version counts when its hashdiff differs from the row right before it in ``seq`` order. The order comes from the data,
and every row ever taken in stays known: as a version, as a retired one (a late row before it says the same), or as a
remembered unchanged row. So the versions are those of one load of all rows, whatever the order and the batches the
rows came in.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakevault.operators.model import first_row

# A key with more rows than this has its timeline split over several tasks.
HOT_KEY_ROWS = 1_000_000

VERSION_ORDER = ["seq", "hashdiff"]

# Borders of hot keys' slices are broadcast up to this size.
BORDER_BYTES = 64 * 1024 * 1024


def current(versions: DataFrame, key: str) -> DataFrame:
    """The newest version of every key."""
    newest = [F.desc(name) for name in (*VERSION_ORDER, "load_dts") if name in versions.columns]
    return first_row(versions, [key], newest)


def moment() -> Column:
    """``seq.at`` as a number that sorts like it, a missing time first."""
    return F.coalesce(F.unix_micros("seq.at"), F.lit(-(2**63)))


def first_moments(incoming: DataFrame, key: str) -> DataFrame:
    """(key, floor): the earliest incoming moment of each key."""
    return incoming.groupBy(key).agg(F.min(moment()).alias("floor"))


def neighbours(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """The stored versions that can decide about a small batch: (key, seq, hashdiff).

    Per key that is the last stored version before the first incoming one, and everything stored
    after it. A batch in order therefore fetches one stored row per key, however long the history,
    and the aggregate picks it on the map side.
    """
    version = F.struct(*VERSION_ORDER)
    near = stored.select(key, *VERSION_ORDER).join(F.broadcast(first_moments(incoming, key)), key)
    return (
        near.groupBy(key, F.when(moment() >= F.col("floor"), version).alias("later"))
        .agg(F.max(version).alias("version"))
        .select(key, "version.*")
    )


def known_later(known: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Known rows of a small batch's keys that lie at or after their first incoming row."""
    return known.join(F.broadcast(first_moments(incoming, key)), key).where(moment() >= F.col("floor")).drop("floor")


# What a row of a timeline is, and of copies of one row the first one to look at.
RETIRED, LIVE, SEEN, FRESH = 0, 1, 2, 3


def decisions(
    incoming: DataFrame,
    key: str,
    live: DataFrame | None = None,
    retired: DataFrame | None = None,
    seen: DataFrame | None = None,
    small_batch: bool = False,
    hot_key_rows: int = HOT_KEY_ROWS,
    most_rows: int | None = None,
    hashdiff: Column | None = None,
) -> DataFrame:
    """What a batch changes: rows with a column ``action``.

    ``version``  an incoming or remembered row that is a version the store does not have
    ``seen``     an incoming row that is no version and not known yet
    ``retire``   a stored version that no longer differs from the row before it (key, seq and hashdiff only)
    ``revive``   a retired one that does again

    ``live`` are the stored versions, ``retired`` those taken back, ``seen`` the remembered rows; None stands for an empty
    table. A small batch fetches the versions next to its own; a large one is laid beside the keys, times and hashdiffs of
    all versions, which takes a single shuffle: its ``live`` may still hold the retired ones, and remembered rows before the
    first incoming one, which change nothing, are not looked for, because that would take shuffles of their own. ``most_rows`` is a known upper bound of all rows involved; when it already
    rules out a hot key, none is looked for. Incoming rows may come without hashdiff, if ``hashdiff`` says what it is: then
    it is worked out behind the shuffle. Only rows of hot keys take the way over slices.
    """
    narrow = [key, *VERSION_ORDER]
    parts = [incoming.withColumn("_state", F.lit(FRESH))]
    if live is not None:
        stored = neighbours(live, incoming, key) if small_batch else live.select(*narrow)
        parts.append(stored.withColumn("_state", F.lit(LIVE)))
    if retired is not None:
        taken_back = retired.select(*narrow)
        parts.append((known_later(taken_back, incoming, key) if small_batch else taken_back).withColumn("_state", F.lit(RETIRED)))
    if seen is not None:
        parts.append((known_later(seen, incoming, key) if small_batch else seen).withColumn("_state", F.lit(SEEN)))
    timeline = parts[0]
    for part in parts[1:]:
        timeline = timeline.unionByName(part, allowMissingColumns=True)
    def complete(rows: DataFrame) -> DataFrame:
        if hashdiff is None:
            return rows
        known = F.coalesce("hashdiff", hashdiff) if "hashdiff" in rows.columns else hashdiff
        return rows.withColumn("hashdiff", known)

    borders = None
    if most_rows is None or most_rows > hot_key_rows:
        borders = slice_borders(timeline, key, hot_key_rows, complete)
    if borders is None:
        compared = beside(complete(timeline.repartition(key)), key)
    else:
        hot = borders.select(key)
        rest = timeline.join(hot, key, "left_anti").repartition(key)
        compared = beside(complete(rest), key).unionByName(beside_sliced(complete(timeline.join(hot, key, "left_semi")), key, borders))
    same = F.col("_before").eqNullSafe(F.col("hashdiff"))
    state = F.col("_state")
    action = (
        F.when(~same & (state >= SEEN), "version").when(~same & (state == RETIRED), "revive")
        .when(same & (state == LIVE), "retire").when(same & (state == FRESH), "seen")
    )
    return compared.where(~F.col("_copy")).withColumn("action", action).where("action is not null").drop("_before", "_copy", "_state")


def new_versions(
    incoming: DataFrame,
    stored: DataFrame | None,
    key: str,
    small_batch: bool = False,
    hot_key_rows: int = HOT_KEY_ROWS,
    most_rows: int | None = None,
) -> DataFrame:
    """Incoming rows that are versions the store does not have yet; ``stored`` is None for an empty table."""
    found = decisions(incoming, key, stored, small_batch=small_batch, hot_key_rows=hot_key_rows, most_rows=most_rows)
    return found.where("action = 'version'").drop("action")


def beside(timeline: DataFrame, key: str) -> DataFrame:
    """Every row with the hashdiff of the row before it (``_before``) and whether that is a copy of it (``_copy``)."""
    along = Window.partitionBy(key).orderBy(*VERSION_ORDER, "_state")
    place = F.struct(*VERSION_ORDER)
    return timeline.withColumns({"_before": F.lag("hashdiff").over(along), "_copy": F.coalesce(F.lag(place).over(along) == place, F.lit(False))})


# Sampled rows to a slice of a hot key, and slices to ``hot_key_rows`` rows: sizes scatter by about a quarter.
SAMPLED, FINER = 20, 2
# Steps of the search for a row's slice: so many slices of one key can be told apart.
STEPS = 24


# Keys are counted in so many buckets first: a key is hot only if its bucket is.
KEY_BUCKETS = 65536


def slice_borders(timeline: DataFrame, key: str, hot_key_rows: int, complete: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame | None:
    """(key, borders) of every key with more rows than the limit; None if there is none.

    Borders are rows (seq, hashdiff) by rank in a sample of the key's rows, so slices are about even whatever the times
    are, equal ones included. The sample is taken by a hash of the row, the same in every run. ``complete`` adds the
    hashdiff to rows that lack it.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS))
    full = timeline.select(bucket.alias("_bucket")).groupBy("_bucket").count().where(F.col("count") > hot_key_rows)
    suspects = [row["_bucket"] for row in full.collect()]  # one row per bucket at most
    if not suspects:
        return None
    chosen = timeline.sparkSession.createDataFrame([(number,) for number in suspects], "_bucket bigint")
    candidates = timeline.withColumn("_bucket", bucket).join(F.broadcast(chosen), "_bucket", "left_semi").drop("_bucket")
    hot = candidates.groupBy(key).count().where(F.col("count") > hot_key_rows).select(key, "count")
    total = hot.agg(F.sum("count").alias("rows"), F.count("*").alias("keys")).first()
    if not total["keys"]:
        return None
    small = total["keys"] * 256 <= BORDER_BYTES
    share = max(1, hot_key_rows // FINER)
    chosen = F.pmod(F.xxhash64(*VERSION_ORDER), F.lit(share)) < SAMPLED
    # A row is taken once, however many copies of it there are.
    sample = complete(candidates.join(F.broadcast(hot) if small else hot, key)).where(chosen).select(key, *VERSION_ORDER).distinct()
    place = F.row_number().over(Window.partitionBy(key).orderBy(*VERSION_ORDER))
    ranked = sample.withColumn("_place", place).where(F.col("_place") % SAMPLED == 0)
    borders = ranked.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*VERSION_ORDER))).alias("_borders"))
    return F.broadcast(borders) if total["rows"] // share * 256 <= BORDER_BYTES else borders


def slice_number() -> Column:
    """How many of the ascending ``_borders`` a row does not precede, by halving steps; 0 without borders."""
    row, borders = F.struct(*VERSION_ORDER), F.col("_borders")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(STEPS))])
    return F.aggregate(
        steps, F.lit(0),
        lambda at, step: F.when((at + step <= F.size(borders)) & (F.get(borders, at + step - 1) <= row), at + step).otherwise(at),
    )


def beside_sliced(timeline: DataFrame, key: str, borders: DataFrame) -> DataFrame:
    """Same columns as ``beside`` gives, with the timeline of a key spread over slices; copies are left out.

    Copies go first, on the map side. Inside a slice a row is compared with the row before it; the
    first row of a slice is compared with the last hashdiff of the slice before, for which only one
    row per key and slice has to meet. Rows already decided travel in lanes of their own.
    """
    distinct = first_row(timeline, [key, *VERSION_ORDER], ["_state"])
    sliced = distinct.join(borders, key, "left").withColumn("_slice", F.when(F.col("_borders").isNotNull(), slice_number()).otherwise(0)).drop("_borders")
    inside = Window.partitionBy(key, "_slice").orderBy(*VERSION_ORDER)
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    decided = sliced.withColumns(
        {
            "_inner": F.lag("hashdiff").over(inside),
            "_head": F.row_number().over(inside) == 1,
            "_tail": F.last("hashdiff").over(whole),
        }
    ).withColumn("_lane", F.when(~F.col("_head"), F.hash("_slice", "hashdiff", "seq")))
    heads = Window.partitionBy(key, "_head", "_lane").orderBy("_slice", *VERSION_ORDER)
    outer = F.lag("_tail").over(heads)
    return (
        decided.withColumn("_outer", outer)
        .withColumns({"_before": F.when(F.col("_head"), F.col("_outer")).otherwise(F.col("_inner")), "_copy": F.lit(False)})
        .drop("_slice", "_inner", "_outer", "_head", "_tail", "_lane")
    )
