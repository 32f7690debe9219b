"""Batch file sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.schemas import CORRUPT_COLUMN, TRANSACTION_SCHEMA


def read_transactions(spark: SparkSession, path: str, schema: T.StructType = TRANSACTION_SCHEMA,
                      sep: str = ",", drop_header_rows: bool = True) -> DataFrame:
    """Headerless transaction text with an explicit schema; malformed lines are dropped.

    A line is malformed when it has more or fewer fields than the schema or a field that doesn't parse as its type
    (a header line doesn't); an empty field is null, and a quoted field may hold the separator.  So the rows are
    those of the CSV reader in DROPMALFORMED mode over all columns, whichever columns later steps read: the parser fills
    the corrupt-record column for every line here and the filter on it comes after the whole line was parsed.
    """
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + f", `{CORRUPT_COLUMN}` string"
    lines = spark.read.text(path).filter(F.length("value") > 0)
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    # inline(array(struct)) is a Generate: neither later filters nor column pruning go below it, so each line is parsed
    # once and as a whole
    parsed = lines.select(F.inline(F.array(F.from_csv(F.col("value"), ddl, options))))
    good = parsed.filter(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)
    return drop_header(good, schema.fields[0].name) if drop_header_rows else good


def drop_header(df: DataFrame, id_col: str = "transaction_id") -> DataFrame:
    """Keep rows whose id parsed (header lines inside the data have a null id)."""
    return df.filter(F.col(id_col).isNotNull())


def read_csv_inferred(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """CSV with a header line and inferred types (one extra pass over the data; prefer an explicit schema)."""
    return spark.read.option("header", str(header).lower()).option("inferSchema", "true").csv(path)


def read_csv_comment(spark: SparkSession, path: str, schema: str = "field INT", comment: str = "#") -> DataFrame:
    """CSV with comment lines and a DDL schema."""
    return spark.read.option("comment", comment).schema(schema).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def repartition_convert(spark: SparkSession, src: str, dst: str, n_parts: int | None = None,
                        schema: T.StructType = TRANSACTION_SCHEMA, sep: str = ",") -> DataFrame:
    """Text/CSV -> Parquet files of even size (a round-robin shuffle into ``n_parts``, or without it into as many as
    adaptive execution finds right for the data); returns the written table."""
    df = read_transactions(spark, src, schema, sep)
    (df.repartition(n_parts) if n_parts else df.hint("rebalance")).write.mode("overwrite").parquet(dst)
    return spark.read.parquet(dst)


def copy_dataset(spark: SparkSession, src: str, dst: str, fmt: str = "parquet", file: str | None = None) -> DataFrame:
    """Bulk copy of a dataset between stores as a Spark job (parallel read and write, no driver copy).

    ``file`` copies that one file of the folder ``src`` instead of all of them.
    """
    df = spark.read.format(fmt).load(f"{src.rstrip('/')}/{file}" if file else src)
    df.write.mode("overwrite").format(fmt).save(dst)
    return spark.read.format(fmt).load(dst)
