"""Provided tables as sightings (``events``) and preference changes (``customer``).

Event times are compressed 60-fold so that windows hold many rows, and arrival
disorder, duplicates and invalid records are injected by the row number ``n``.
``registry/oracle.py`` holds the same mapping as SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.functions.times import iso_z
from sightline.operators.dedup import dedup_first
from sightline.session import configure, stage

EPOCH_US = 1_704_067_200_000_000


def _spread(df: DataFrame) -> DataFrame:
    """A table of few file splits over all cores; a large one stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed sightings in arrival order ``(arrival_us, seq)``."""
    configure(spark)
    events = _spread(spark.read.parquet(f"{sf_dir}/events.parquet"))
    rows = events.select(
        F.col("event_id").alias("n"),
        F.col("user_id").alias("uid"),
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.expr(
            f"{EPOCH_US} + (unix_micros(CAST(ts AS TIMESTAMP)) - {EPOCH_US}) div 60"
        ).alias("et_us"),
    )
    return rows.selectExpr(
        "n AS seq",
        "uid",
        "event_type",
        "et_us",
        """et_us + CASE WHEN n % 17 = 0 THEN 650000000
                        WHEN n % 13 = 0 THEN 172000000 ELSE 0 END AS arrival_us""",
        """CASE WHEN n % 37 = 0 THEN ''
                WHEN n % 11 = 3 THEN concat('evt_', n - 1)
                ELSE concat('evt_', n) END AS event_id""",
        "CASE WHEN n % 29 = 0 THEN '' ELSE concat('user_', uid % 40) END AS user_id",
        "CASE WHEN n % 31 = 0 THEN '' ELSE event_type END AS species_code",
        "concat('loc_', k % 3) AS location_id",
        "CAST(37 + k % 3 AS DOUBLE) + CAST(uid % 100 AS DOUBLE) / 100 AS lat",
        "CAST(-122 - k % 3 AS DOUBLE) - CAST(n % 100 AS DOUBLE) / 100 AS lng",
        """CAST(CASE WHEN n % 41 = 0 THEN -3
                     WHEN n % 997 = 0 THEN 9223372036854775807
                     WHEN n % 1009 = 1 THEN 100000000000000000000000000007
                     ELSE CAST(floor(value) AS BIGINT) % 8 END AS DECIMAL(38,0)) AS cnt""",
    )


def clean(spark: SparkSession, sf_dir: str, once: bool = False) -> DataFrame:
    """Valid first arrivals, typed: the table the metric and alert jobs read.

    It is written out for jobs that pass over it more than once.
    """
    valid = sightings(spark, sf_dir).filter(
        "user_id <> '' AND species_code <> '' AND event_id <> '' AND cnt >= 0"
    )
    columns = ["event_id", "user_id", "species_code", "location_id", "et_us", "cnt", "lat", "lng"]
    first = dedup_first(valid.select("arrival_us", "seq", *columns))
    return first if once else stage(first, "clean")


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed preference changes, one per customer, spread over the span of the events.

    They are written out: their history takes several passes.
    """
    configure(spark)
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(
        "concat('user_', c_custkey % 40) AS user_id",
        """element_at(array('click', 'error', 'purchase', 'signup', 'view'),
                      CAST(1 + c_nationkey % 5 AS INT)) AS species_code""",
        """element_at(array('low', 'medium', 'high'),
                      CAST(1 + length(c_mktsegment) % 3 AS INT)) AS priority""",
        "c_acctbal >= 0 AS active",
        """CAST(CASE WHEN c_custkey % 89 = 0 THEN 40030 WHEN c_custkey % 83 = 0 THEN 25000
                     ELSE 5 + 2 * c_nationkey END AS DOUBLE) AS radius_km""",
        f"""{EPOCH_US} + (c_custkey % 1000000) * 26843545601L % 43200000000L AS arrival_us""",
        "CAST(c_custkey AS BIGINT) AS seq",
    )
    return stage(rows, "changes")


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sightings as a stream at rest: JSON text with injected corruption."""
    number = F.col("seq").cast("string")
    rows = sightings(spark, sf_dir).withColumn("number", number)
    text = F.concat(
        # Ids that are numbers, no location, no event time.
        F.lit('{"event_id":'), F.expr("CASE WHEN seq % 79 = 0 THEN CAST(seq + 1 AS STRING) ELSE concat('\"', event_id, '\"') END"),
        F.lit(',"user_id":'), F.expr("CASE WHEN seq % 83 = 0 THEN CAST(uid % 40 + 1 AS STRING) ELSE concat('\"', user_id, '\"') END"),
        F.lit(',"species_code":"'), "species_code",
        F.lit('","common_name":"'), "event_type",
        F.lit('","location_id":"'), F.when(F.col("seq") % 73 != 0, F.col("location_id")).otherwise(""),
        F.lit('","lat":'), F.expr("37 + CAST(right(location_id, 1) AS INT)"),
        F.expr("concat('.', lpad(CAST(uid % 100 AS STRING), 2, '0'))"),
        F.lit(',"lng":'), F.expr("-122 - CAST(right(location_id, 1) AS INT)"),
        F.expr("concat('.', lpad(CAST(seq % 100 AS STRING), 2, '0'))"),
        F.when(F.col("seq") % 71 == 0, "").otherwise(
            F.concat(
                F.lit(',"event_time":"'),
                F.when(F.col("seq") % 61 == 0, "not-a-timestamp").otherwise(iso_z(F.col("et_us"))),
                F.lit('"'),
            )
        ),
        F.expr(
            """CASE WHEN seq % 59 = 0 THEN ''
                    WHEN seq % 67 = 0 THEN ',"count":2.0'
                    ELSE concat(',"count":', cnt) END"""
        ),
        F.expr("CASE WHEN seq % 53 = 0 THEN ',\"confidence\":1.5' ELSE ',\"confidence\":0.92' END"),
        F.lit(',"source":"manual_log"'),
        F.when(F.col("seq") % 43 == 0, "").otherwise("}"),
    )
    text = F.when(F.col("seq") % 47 == 0, F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    return rows.select(
        F.col("location_id").cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        "arrival_us",
        "seq",
    )


def preference_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The preference changes as a stream at rest, some of them unusable."""
    fields = F.struct(
        F.when(F.col("seq") % 7 != 3, F.col("user_id")).alias("user_id"),
        "species_code",
        F.when(F.col("seq") % 11 == 1, F.lit("urgent")).otherwise(F.col("priority")).alias("priority"),
        F.when(F.col("seq") % 13 == 1, -F.col("radius_km")).otherwise(F.col("radius_km")).alias("radius_km"),
        "active",
        iso_z(F.col("arrival_us")).alias("updated_at"),
    )
    return changes(spark, sf_dir).select(
        F.col("user_id").cast("binary").alias("key"),
        F.to_json(fields).cast("binary").alias("value"),
        "arrival_us",
        "seq",
    )
