"""Fixed schemas of the transaction data and the stream payloads."""

from pyspark.sql import types as T

# Raw transaction text: nine comma-separated fields, no usable header (fixed field list and types).
TRANSACTION_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.IntegerType(), True),
    T.StructField("tx_datetime", T.StringType(), True),
    T.StructField("customer_id", T.IntegerType(), True),
    T.StructField("terminal_id", T.IntegerType(), True),
    T.StructField("tx_amount", T.DoubleType(), True),
    T.StructField("tx_time_seconds", T.IntegerType(), True),
    T.StructField("tx_time_days", T.IntegerType(), True),
    T.StructField("tx_fraud", T.IntegerType(), True),
    T.StructField("tx_fraud_scenario", T.IntegerType(), True),
])

CORRUPT_COLUMN = "_corrupt_record"

# Flat stream payload parsed by the scoring job (fixed field list).
FLAT_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType(), True),
    T.StructField("tx_amount", T.DoubleType(), True),
    T.StructField("tx_fraud", T.IntegerType(), True),
    T.StructField("account_id", T.StringType(), True),
    T.StructField("merchant_id", T.StringType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("tx_time_seconds", T.IntegerType(), True),
    T.StructField("tx_time_days", T.IntegerType(), True),
    T.StructField("merchant_category", T.StringType(), True),
    T.StructField("customer_age", T.IntegerType(), True),
    T.StructField("customer_city", T.StringType(), True),
    T.StructField("customer_state", T.StringType(), True),
])

# Envelope written by the replay producer: ids and stream metadata around the transaction row.
ENVELOPE_DATA_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.LongType(), True),
    T.StructField("tx_datetime", T.StringType(), True),
    T.StructField("customer_id", T.LongType(), True),
    T.StructField("terminal_id", T.LongType(), True),
    T.StructField("tx_amount", T.DoubleType(), True),
    T.StructField("tx_time_seconds", T.IntegerType(), True),
    T.StructField("tx_time_days", T.IntegerType(), True),
    T.StructField("tx_fraud", T.IntegerType(), True),
    T.StructField("tx_fraud_scenario", T.IntegerType(), True),
])

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType(), True),
    T.StructField("stream_timestamp", T.StringType(), True),
    T.StructField("producer_id", T.StringType(), True),
    T.StructField("producer_config", T.StructType([
        T.StructField("tps_target", T.IntegerType(), True),
        T.StructField("topic", T.StringType(), True),
    ]), True),
    T.StructField("data", ENVELOPE_DATA_SCHEMA, True),
])

# Click record: ISO time text, user and page; the page id is the message key.
CLICK_SCHEMA = T.StructType([
    T.StructField("ts", T.StringType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("page_id", T.LongType(), True),
])

# Columns of a Kafka source row; the file-backed replay keeps the same columns so one parser serves both.
KAFKA_RECORD_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])
