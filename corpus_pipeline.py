"""The training-data pipeline: five stages over the documents, each one of the numbered operators.

Every stage works on all rows its predecessor kept; each is written as Parquet to the shared folder and read again
before the next.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.decontam import leaks
from ledgerlens.llm.mixing import mix
from ledgerlens.llm.near_dedup import near_duplicates
from ledgerlens.llm.registry import table
from ledgerlens.llm.token_store import store_and_digest
from ledgerlens.llm.toxicity import THRESHOLD, fitted
from ledgerlens.session import scratch_path


def keyed(docs: DataFrame) -> DataFrame:
    """(_row, _doc): every row with a key of its own, from its file and its place there, so rows that agree in all columns,
    or have no id, are told apart in every pass.  Rows that don't come straight from files are written first."""
    place = [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
    row = lambda df: df.select(F.xxhash64(*place).alias("_row"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"))
    try:
        return row(docs)
    except AnalysisException:
        path = scratch_path(docs.sparkSession, "rows")
        docs.write.parquet(path)
        return row(docs.sparkSession.read.parquet(path))


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents of ``rows`` whose key is not in ``gone`` (_row)."""
    return rows.join(gone.select("_row").distinct(), "_row", "left_anti").select("_doc.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects go.

    Every row is judged by its text alone, whatever its id; null and empty texts get the score of no features.
    """
    return fitted(spark, sf_dir).keep_below(docs, THRESHOLD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (similarity 0.8) stays: one with the smallest id.

    Exact copies are of one group, whether their ids agree, differ or are null (a null id is last); null texts and texts
    without words are linked with nothing and stay.
    """
    rows = keyed(docs)
    path = scratch_path(spark, "dedup-groups")
    (near_duplicates(rows.select("_row", "_doc.text"), 80, id_col="_row").withColumnRenamed("id", "_row")
     .join(rows.select("_row", F.col("_doc.doc_id").alias("doc_id")), "_row").select("_row", "component_id", "doc_id")
     .write.parquet(path))
    groups = spark.read.parquet(path)
    first = (groups.groupBy("component_id").agg(F.min(F.struct(F.isnull("doc_id").alias("null"), "doc_id", "_row")).alias("first"),
                                                F.count(F.lit(1)).alias("n")).filter("n > 1"))
    return without(rows, groups.join(first, "component_id").filter(F.col("_row") != F.col("first._row")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Items of fewer than five tokens don't count: such words stand in clean texts, too.  Every row is judged alone, also
    among rows with one id or none; null and empty texts stay.
    """
    rows = keyed(docs)
    found = leaks(rows.select("_row", "_doc.text"), table(spark, sf_dir, "benchmark"), id_col="_row").filter("NOT short")
    return without(rows, found)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document taken c times stands c times.

    Null sources are one source; documents without words are in no copy the words pay for.  Rows with one id and text draw
    the same number.  All columns pass through, whatever their names.
    """
    mixed = mix(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"), "doc_id", "source", "text"))
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("_copy")
    return mixed.filter("copies > 0").select("_doc", copy).select("_doc.*")


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-ID files, and per document its place in them, its tokens and their checksum.

    Null ids come first, rows with one id in the order of their texts' hash; null and empty texts have the end id alone.
    """
    return store_and_digest(docs)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing),
          ("token_output", token_output)]

#: the toxicity stage trains a model, which SQL can't express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of ``sf_dir``; an empty table gives none, other columns pass through all
    stages but the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        path = scratch_path(spark, f"stage-{name}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
