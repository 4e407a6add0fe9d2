"""Topics as DataFrames: ``(key, value, arrival_us, seq)``, from Kafka or a folder.

A folder topic is Parquet in that layout, the same for batch and streaming reads.
Kafka needs the connector package on the class path.
"""

from __future__ import annotations

import datetime
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from sightline.schemas import ARRIVAL, LOG
from sightline.session import configure

# Folders are partitioned by topic and by day of arrival.
DAY = "arrival_day"

# Offsets of one partition stay below 2^48.
_OFFSET_BITS = 48


def bootstrap_servers() -> str:
    """Broker address from the environment."""
    return os.environ.get("KAFKA_BOOTSTRAP_SERVERS", "localhost:19092")


def with_arrival(kafka: DataFrame, *more: str) -> DataFrame:
    """Kafka rows in topic layout: append time, then partition and offset.

    Arrival is the time the broker appended a record, so topics need
    ``message.timestamp.type=LogAppendTime``. A row that carries the producer's clock
    instead (``timestampType`` 0) would silently follow another order: it is an error.
    """
    seq = F.shiftleft(F.col("partition").cast("bigint"), _OFFSET_BITS) + F.col("offset")
    wrong = F.raise_error(F.lit("the topic needs message.timestamp.type=LogAppendTime"))
    appended = F.when(F.col("timestampType") == 1, F.col("timestamp")).otherwise(wrong.cast("timestamp"))
    return kafka.select(
        *more, "key", "value", F.unix_micros(appended).alias("arrival_us"), seq.alias("seq")
    )


def kafka_options(topics: list[str]) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": bootstrap_servers(),
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
    }


def _span_options(since_us: int | None, until_us: int | None) -> dict[str, str]:
    """Kafka options for a span of append times; the broker keeps milliseconds."""
    options = {}
    if since_us is not None:
        options["startingTimestamp"] = str(since_us // 1000)
    if until_us is not None:
        options["endingTimestamp"] = str(-(-until_us // 1000))
    return options


def _in_span(rows: DataFrame, since_us: int | None, until_us: int | None) -> DataFrame:
    """Rows that arrived from ``since_us`` on and before ``until_us``.

    In a folder the days prune directories; files of no day are read.
    """
    if since_us is not None:
        rows = rows.filter(F.col("arrival_us") >= F.lit(since_us))
    if until_us is not None:
        rows = rows.filter(F.col("arrival_us") < F.lit(until_us))
    if DAY not in rows.columns:
        return rows
    for bound, of in ((since_us, "__ge__"), (until_us, "__le__")):
        if bound is not None:
            within = getattr(F.col(DAY), of)(F.lit(_day_of(bound)))
            rows = rows.filter(F.col(DAY).isNull() | within)
    return rows


def read_topic(
    spark: SparkSession,
    topic: str,
    folder: str | None = None,
    since_us: int | None = None,
    until_us: int | None = None,
) -> DataFrame:
    """The topic as a bounded table, for replay; or what arrived in a span of time.

    Of a span only its days are read from a folder, and only its offsets from Kafka.
    """
    configure(spark)
    if folder is None:
        options = kafka_options([topic]) | _span_options(since_us, until_us)
        return _in_span(with_arrival(spark.read.format("kafka").options(**options).load()), since_us, until_us)
    return _folder_topic(_in_span(spark.read.schema(_ROUTED).parquet(folder), since_us, until_us), topic)


def stream_topic(
    spark: SparkSession, topic: str, folder: str | None = None, **options: str
) -> DataFrame:
    """The topic as a stream, from its start; a checkpoint then keeps the position."""
    configure(spark)
    if folder is None:
        source = spark.readStream.format("kafka").options(**kafka_options([topic]), **options)
        return with_arrival(source.load())
    source = spark.readStream.schema(_ROUTED).options(**options)
    return _folder_topic(source.parquet(folder), topic)


def stream_topics(spark: SparkSession, topics: list[str], folder: str | None = None, **options: str) -> DataFrame:
    """Several topics as one stream, with a column ``topic``.

    One source takes its batches from all of them together.
    """
    configure(spark)
    if folder is None:
        rows = spark.readStream.format("kafka").options(**kafka_options(topics), **options).load()
        return with_arrival(rows, "topic")
    rows = spark.readStream.schema(_ROUTED).options(**options).parquet(folder)
    return rows.filter(F.col("topic").isin(topics)).select("topic", "key", "value", *ARRIVAL)


_ROUTED = T.StructType([*LOG.fields, T.StructField("topic", T.StringType()), T.StructField(DAY, T.DateType())])


def _folder_topic(rows: DataFrame, topic: str) -> DataFrame:
    # The filter prunes directories.
    return rows.filter(F.col("topic") == topic).select("key", "value", *ARRIVAL)


def message(topic: str, key: Column, value: Column) -> Column:
    """One outgoing record as a struct."""
    return F.struct(
        F.lit(topic).alias("topic"),
        key.cast("binary").alias("key"),
        value.cast("binary").alias("value"),
    )


def json_value(fields: dict[str, Column]) -> Column:
    """Compact JSON object of the fields; null fields are left out."""
    return F.to_json(F.struct(*[column.alias(name) for name, column in fields.items()]))


def with_payload(value: Column, payload: Column) -> Column:
    """Append ``payload``, JSON text kept as it came, to a JSON object."""
    head = F.substring(value, F.lit(1), F.length(value) - 1)
    return F.concat(head, F.lit(',"payload":'), F.coalesce(payload, F.lit("null")), F.lit("}"))


def records(df: DataFrame, topic: str, key: str = "key") -> DataFrame:
    """All columns but the key and the arrival order as one JSON record per row."""
    fields = {c: F.col(c) for c in df.columns if c not in (key, *ARRIVAL)}
    order = [c for c in ARRIVAL if c in df.columns]
    routed = df.select(message(topic, F.col(key), json_value(fields)).alias("m"), *order)
    return routed.select("m.*", *order)


def _day_of(arrival_us: int) -> datetime.date:
    return datetime.date(1970, 1, 1) + datetime.timedelta(days=arrival_us // 86_400_000_000)


def _dated(routed: DataFrame) -> tuple[DataFrame, list[str]]:
    """Rows that carry their arrival get its day, and the columns to partition by."""
    if ARRIVAL[0] not in routed.columns:
        return routed, ["topic"]
    day = F.to_date(F.timestamp_micros(F.col(ARRIVAL[0])))
    return routed.withColumn(DAY, day), ["topic", DAY]


def write_topics(routed: DataFrame, folder: str | None = None, mode: str = "append") -> None:
    """Write routed rows ``(topic, key, value, …)`` of a bounded table."""
    if folder is None:
        options = {"kafka.bootstrap.servers": bootstrap_servers()}
        routed.select("topic", "key", "value").write.format("kafka").options(**options).save()
    else:
        dated, parts = _dated(routed)
        dated.write.mode(mode).partitionBy(*parts).parquet(folder)


def topic_writer(
    routed: DataFrame, checkpoint: str, folder: str | None = None
) -> DataStreamWriter:
    """A stream writer for routed rows; start it with the trigger of choice."""
    if folder is None:
        writer = routed.select("topic", "key", "value").writeStream.format("kafka")
        writer = writer.option("kafka.bootstrap.servers", bootstrap_servers())
    else:
        dated, parts = _dated(routed)
        writer = dated.writeStream.format("parquet").partitionBy(*parts).option("path", folder)
    return writer.outputMode("append").option("checkpointLocation", checkpoint)
