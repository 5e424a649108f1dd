"""Streams of binary key/value messages into the lake.

The source is a parameter: Kafka in production, files of the same shape elsewhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

MESSAGE = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType())])


def kafka_options(servers: str, topic: str, starting_offsets: str = "latest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }


def read_messages(
    spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str
) -> DataFrame:
    """Unbounded frame with binary ``key`` and ``value``; file formats need a ``path``."""
    reader = spark.readStream.format(fmt).options(**options)
    return reader.load() if path is None else reader.schema(MESSAGE).load(path)


def raw_text(messages: DataFrame, into: str = "raw_json") -> DataFrame:
    """The payload as text, untouched."""
    return messages.selectExpr(f"CAST(value AS STRING) AS {into}")


def key_value_text(messages: DataFrame) -> DataFrame:
    return messages.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")


def decode_json(raw: DataFrame, schema: T.StructType | str, column: str = "raw_json") -> DataFrame:
    """Payload fields next to the raw text; ``corrupt`` marks text that does not fit the schema."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kind = T.StructType([*kind.fields, T.StructField("_bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = raw.withColumn("_p", F.from_json(F.col(column), kind, options))
    fields = [F.col(f"_p.{f.name}").alias(f.name) for f in kind.fields[:-1]]
    corrupt = F.col("_p").isNull() | F.col("_p._bad").isNotNull()
    return parsed.select(column, *fields, corrupt.alias("corrupt"))


def split_corrupt(decoded: DataFrame, column: str = "raw_json") -> tuple[DataFrame, DataFrame]:
    """Readable rows without the raw text, and the raw text of the rest."""
    good = decoded.filter(~F.col("corrupt")).drop("corrupt", column)
    return good, decoded.filter("corrupt").select(column)


def split_stream(
    messages: DataFrame, schema: T.StructType | str, path: str, checkpoint: str,
    available_now: bool = False, column: str = "raw_json",
) -> StreamingQuery:
    """Decode a stream of raw text and keep readable and corrupt rows apart, each row once.

    A micro-batch is decoded and written in one pass, readable rows under ``corrupt=false`` without
    the raw text, others under ``corrupt=true`` with nothing else. Its folder is named by the batch
    id and replaced as a whole, so a batch that a restart runs again doubles neither side.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        decoded = decode_json(batch.select(column), schema, column)
        rows = decoded.withColumn(column, F.when(F.col("corrupt"), F.col(column)))
        rows.write.mode("overwrite").partitionBy("corrupt").parquet(f"{path}/batch={batch_id}")

    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_split(
    spark: SparkSession, path: str, schema: T.StructType | str, column: str = "raw_json"
) -> tuple[DataFrame, DataFrame]:
    """Readable rows, and the raw text of corrupt ones, of all batches so far."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = [T.StructField(column, T.StringType()), *kind.fields]
    ends = [T.StructField("batch", T.LongType()), T.StructField("corrupt", T.BooleanType())]
    rows = spark.read.schema(T.StructType([*fields, *ends])).parquet(path)
    good = rows.filter(~F.col("corrupt")).select(*[f.name for f in kind.fields])
    return good, rows.filter("corrupt").select(column)


def append_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    available_now: bool = False,
) -> StreamingQuery:
    """Append to a lake folder; the checkpoint keeps a restart from writing rows twice."""
    writer = (
        stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def console_stream(stream: DataFrame, fmt: str = "console", **options: str) -> StreamingQuery:
    return stream.writeStream.format(fmt).options(**options).outputMode("append").start()


def run_to_end(query: StreamingQuery) -> None:
    """Wait until everything available now is written; a failed query raises."""
    query.awaitTermination()
