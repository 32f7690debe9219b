"""Stream parsing and scoring.  Every function takes a DataFrame that may be streaming or batch, so the same
plan runs incrementally on a Kafka or file source and as a batch job on a stored table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.schemas import ENVELOPE_SCHEMA, FLAT_PAYLOAD_SCHEMA


PARSE_ERROR = "parse_error"


def unwrap_envelope(df: DataFrame, value_col: str = "value", schema: T.StructType = ENVELOPE_SCHEMA) -> DataFrame:
    """Envelope JSON -> the transaction fields of ``data`` (transaction id as text) and ``parse_error``: null, or why
    the record has no transaction.  Broken records stay, with null fields; see :func:`well_formed` and
    :func:`dead_letters`."""
    # inline(array(struct)) is a Generate: a filter on what was parsed stays above it, so each record is parsed once
    envelope = F.from_json(F.col(value_col).cast("string"), T.StructType([schema["data"]]))
    parsed = df.select(F.inline(F.array(F.struct(envelope.alias("e")))), *df.columns)
    data_fields = [f.name for f in schema["data"].dataType.fields]
    error = (F.when(F.col(value_col).isNull(), "no value").when(F.col("e.data").isNull(), "not an envelope with data"))
    return parsed.select(
        F.col("e.data.transaction_id").cast("string").alias("transaction_id"),
        *[F.col(f"e.data.{f}").alias(f) for f in data_fields if f != "transaction_id"],
        *[c for c in df.columns if c != value_col], F.col(value_col).cast("string").alias("raw_value"),
        error.alias(PARSE_ERROR))


def well_formed(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(PARSE_ERROR).isNull()).drop(PARSE_ERROR, "raw_value")


def dead_letters(parsed: DataFrame) -> DataFrame:
    """The records that could not be parsed, as they came, with the reason: the side table of a stream job."""
    return (parsed.filter(F.col(PARSE_ERROR).isNotNull())
            .select("kafka_key", "raw_value", "kafka_timestamp", "offset", "partition", PARSE_ERROR))


def parse_stream(df: DataFrame, schema: T.StructType = FLAT_PAYLOAD_SCHEMA, nested: bool = False,
                 keep_broken: bool = False) -> DataFrame:
    """Kafka-shaped rows (key, value, topic, partition, offset, timestamp) -> payload fields plus
    kafka_key, kafka_timestamp, offset, partition.  ``nested`` parses the replay envelope instead; ``keep_broken``
    keeps records that don't parse, with ``raw_value`` and ``parse_error``."""
    meta = df.select(F.col("key").cast("string").alias("kafka_key"), F.col("value").cast("string").alias("value"),
                     F.col("timestamp").alias("kafka_timestamp"), "offset", "partition")
    if nested:
        out = unwrap_envelope(meta)
    else:
        t = meta.select("*", F.from_json("value", schema, {"columnNameOfCorruptRecord": "_broken"}).alias("t"))
        error = F.when(F.col("value").isNull(), "no value").when(
            F.coalesce(*[F.col(f"t.{f.name}").cast("string") for f in schema.fields]).isNull(), "not a payload")
        out = t.select("t.*", "kafka_key", "kafka_timestamp", "offset", "partition", F.col("value").alias("raw_value"),
                       error.alias(PARSE_ERROR))
    return out if keep_broken else well_formed(out)


def predictions_output(scored: DataFrame) -> DataFrame:
    """The prediction topic's columns from a scored flat payload."""
    return scored.select("transaction_id", "tx_amount", "account_id", "merchant_id", "timestamp", "fraud_prediction",
                         "fraud_label", "fraud_probability", "kafka_timestamp", "offset", "partition")


def to_envelope(df: DataFrame, sent_at: Column | None = None, message_no: Column | None = None,
                data_columns: list[str] | None = None, producer_id: str = "replay", tps_target: int = 50,
                topic: str = "transactions-input") -> Column:
    """Replay envelope JSON around the row; null fields of the row are left out.

    ``sent_at``: time the message is sent (default: now), as ISO text in ``stream_timestamp``; the message id is made of
    it and ``message_no`` (default: the row's transaction id), so it is not the transaction's own id."""
    sent = (sent_at if sent_at is not None else F.current_timestamp()).cast("timestamp_ntz")
    number = message_no if message_no is not None else F.col("transaction_id")
    micros = F.unix_micros(sent.cast("timestamp"))
    body = F.struct(F.concat_ws("_", F.lit("tx"), micros.cast("string"), number.cast("string")).alias("transaction_id"),
                    F.date_format(sent, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("stream_timestamp"),
                    F.lit(producer_id).alias("producer_id"),
                    F.struct(F.lit(tps_target).alias("tps_target"), F.lit(topic).alias("topic")).alias("producer_config"),
                    F.struct(*[F.col(c) for c in data_columns or df.columns]).alias("data"))
    return F.to_json(body, {"ignoreNullFields": "true"})


def score_with_heuristic_udf(df: DataFrame, amount: str = "tx_amount", key: str = "transaction_id",
                             large: float = 5000.0, random_rate: float = 0.1, salt: str = "stream") -> DataFrame:
    """The stream heuristic as a vectorised pandas UDF (Arrow batches); same answers as the native expression."""
    from ledgerlens.streaming.udfs import heuristic_udf
    res = heuristic_udf(large, random_rate, salt)(F.col(amount), F.col(key).cast("string"))
    from ledgerlens.functions.scoring import fraud_label
    return (df.withColumn("ml_result", res)
            .withColumn("fraud_prediction", F.col("ml_result.prediction"))
            .withColumn("fraud_probability", F.col("ml_result.probability"))
            .withColumn("fraud_label", fraud_label(F.col("fraud_prediction")))
            .drop("ml_result"))


def windowed_rates(df: DataFrame, ts: str, width: str = "5 minutes", watermark: str = "10 minutes",
                   label: str | None = None) -> DataFrame:
    """Addition (not a reference operator): tumbling event-time counts per window (and label), with a
    watermark so state for closed windows is dropped; in append mode each window is emitted once it closes."""
    d = df.withWatermark(ts, watermark)
    keys = [F.window(F.col(ts), width).alias("w")] + ([F.col(label)] if label else [])
    g = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *([label] if label else []), "n")
