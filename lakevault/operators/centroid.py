"""One point per zip prefix, worked out from all points or kept up as points come in."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakevault.operators.batchlog import BatchLog

# Degrees with 14 decimals: sums do not depend on the order in which partitions are combined.
DEGREES = "decimal(27,14)"
SUM = "decimal(38,14)"

ZIP = "geolocation_zip_code_prefix"
PLACE = [ZIP, "geolocation_city", "geolocation_state", "record_source"]
VALUES = [ZIP, "geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state", "record_source"]
ADDED = ["n", "lat_sum", "lat_n", "lng_sum", "lng_n"]


def zip_centroids(points: DataFrame) -> DataFrame:
    """Average position, smallest city and state, newest load and smallest source of each zip prefix.

    Two aggregates on purpose. The first keeps only number and date buffers, so it runs as a hash
    aggregate with map-side combine over the raw points and a zip with very many points shrinks
    before the shuffle; the text minima then work on the few distinct rows that remain. A point that was
    landed more than once counts once, as it was landed last.
    """
    newest = [F.desc(name) for name in ("seq", "load_dts") if name in points.columns]
    others = [F.asc(name) for name in points.columns if name not in ("geolocation_id", "seq", "load_dts")]
    keyed = F.col("geolocation_id").isNotNull()
    place = F.row_number().over(Window.partitionBy("geolocation_id").orderBy(*newest, *others))
    last = points.where(keyed).withColumn("_place", place).where("_place = 1").drop("_place")
    points = last.unionByName(points.where(~keyed))
    zip_code = ZIP
    lat, lng = F.col("geolocation_lat").cast(DEGREES), F.col("geolocation_lng").cast(DEGREES)
    distinct_places = points.groupBy(zip_code, "geolocation_city", "geolocation_state", "record_source").agg(
        F.sum(lat).alias("lat_sum"),
        F.count(lat).alias("lat_n"),
        F.sum(lng).alias("lng_sum"),
        F.count(lng).alias("lng_n"),
        F.max("load_dts").alias("load_dts"),
    )
    return _centroids(distinct_places)


def _centroids(places: DataFrame) -> DataFrame:
    """One row per zip prefix from sums and counts by zip prefix, city, state and source."""
    return places.groupBy(ZIP).agg(
        (F.sum("lat_sum").cast("double") / F.nullif(F.sum("lat_n"), F.lit(0))).alias("geolocation_lat"),
        (F.sum("lng_sum").cast("double") / F.nullif(F.sum("lng_n"), F.lit(0))).alias("geolocation_lng"),
        F.min("geolocation_city").alias("geolocation_city"),
        F.min("geolocation_state").alias("geolocation_state"),
        F.max("load_dts").alias("load_dts"),
        F.min("record_source").alias("record_source"),
    )


class KeptPoints(BatchLog):
    """Zip centroids under points that come in any order, move, change their zip or are repeated.

    ``points`` is a log of the newest row of each point: an entry holds the row and, where it replaced one, the old
    row, whose share it takes back. ``sums`` holds, for each batch of the log, how much it adds to and takes from the
    sums of every place, worked out from the log alone. A centroid is the total of its zip's sums; no point is read for
    it. A batch is open until its zips' new rows are stored (``close``), so the next one carries on what a job that died
    has left.
    """

    def take(self, rows: DataFrame) -> tuple[DataFrame, list[str]]:
        """Take in a batch of points (with ``seq``): the new rows of the zip prefixes of all open batches, and these batches.

        A prefix that lost all its points comes back as a row of nulls, its source included.
        """
        newest = self._newest_of(rows)
        logged = self.read("points")
        if logged is None:
            changed = newest.withColumn("old", F.lit(None).cast(newest.schema["now"].dataType))
        else:
            last = F.max_by("now", F.struct("now.seq", "now.weight")).alias("old")
            known = logged.select("point", "now").join(newest.select("point"), "point", "left_semi").groupBy("point").agg(last)
            later = (F.col("now.seq") > F.col("old.seq")) | (F.col("now.weight") > F.col("old.weight"))
            changed = newest.join(known, "point", "left").where(F.col("old").isNull() | later)
        batches = self.add("points", changed)
        for batch in batches:
            self._add_up(batch)
        touched = self.spark.read.schema(self._fields()).parquet(*[f"{self.path}/sums/batch={batch}" for batch in batches])
        places = touched.groupBy(ZIP).agg(F.max("load_dts").alias("stored_at"))
        found = places.join(self.centroids(places).drop("load_dts"), ZIP, "left").withColumnRenamed("stored_at", "load_dts")
        return found, batches

    def centroids(self, of: DataFrame | None = None) -> DataFrame:
        """The centroid of every zip prefix that has points, or of those named."""
        rows = self.read("sums", self._fields())
        if of is not None:
            rows = rows.join(of.select(ZIP), ZIP, "left_semi")
        kept = rows.groupBy(*PLACE).agg(*[F.sum(name).alias(name) for name in ADDED], F.max("load_dts").alias("load_dts"))
        return _centroids(kept.where("n > 0"))

    def _newest_of(self, rows: DataFrame) -> DataFrame:
        """(point, now): of each point the newest row; rows without an id are one point per file and content, with their number."""
        content = [F.col(name) for name in VALUES]
        nameless = F.concat(F.lit("content "), F.sha2(F.to_json(F.struct(*content, "seq.tie"), {"ignoreNullFields": "false"}), 256))
        keyed = rows.withColumn("point", F.coalesce(F.concat(F.lit("id "), F.col("geolocation_id").cast("string")), nameless))
        # Of rows as new as each other the first by content counts, as in ``zip_centroids``.
        picked = keyed.groupBy("point", F.col("geolocation_id").isNull().alias("nameless"), "seq").agg(
            F.min(F.struct(*content)).alias("first"), F.max("load_dts").alias("load_dts"), F.count(F.lit(1)).alias("times")
        )
        weight = F.when(F.col("nameless"), F.col("times")).otherwise(F.lit(1).cast("bigint"))
        now = F.struct("seq", *[F.col(f"first.{name}").alias(name) for name in VALUES], "load_dts", weight.alias("weight"))
        return picked.groupBy("point").agg(F.max_by(now, "seq").alias("now"))

    def _add_up(self, batch: str) -> None:
        """The sums of one batch of the log: what new rows add, less what the rows they replace had added."""
        log = self.spark.read.parquet(f"{self.path}/points/batch={batch}")
        added = log.select("now.*").withColumn("sign", F.lit(1))
        taken = log.where("old is not null").select("old.*", F.col("now.load_dts").alias("since")).withColumn("sign", F.lit(-1))
        taken = taken.drop("load_dts").withColumnRenamed("since", "load_dts")
        rows = added.unionByName(taken).withColumn("times", F.col("weight") * F.col("sign"))
        lat, lng = F.col("geolocation_lat").cast(DEGREES), F.col("geolocation_lng").cast(DEGREES)

        def total(value: Column) -> Column:
            return F.coalesce(F.sum((value * F.col("times").cast("decimal(10,0)")).cast(SUM)), F.lit(0)).cast(SUM)

        sums = rows.groupBy(*PLACE).agg(
            F.sum("times").alias("n"), total(lat).alias("lat_sum"), F.sum(F.when(lat.isNotNull(), F.col("times")).otherwise(0)).alias("lat_n"),
            total(lng).alias("lng_sum"), F.sum(F.when(lng.isNotNull(), F.col("times")).otherwise(0)).alias("lng_n"),
            F.max("load_dts").alias("load_dts"),
        )
        sums.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/sums/batch={batch}")

    def _fields(self) -> str:
        fields = [f"{ZIP} string", "geolocation_city string", "geolocation_state string", "record_source string", "n bigint"]
        return ", ".join([*fields, f"lat_sum {SUM}", "lat_n bigint", f"lng_sum {SUM}", "lng_n bigint", "load_dts timestamp"])
