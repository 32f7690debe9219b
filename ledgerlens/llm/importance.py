"""Importance resampling towards a target: documents drawn by how much their n-grams look like the target's.

Words and n-grams come from Arrow kernels: ``ascii_lower``, ``split_pattern_regex``, ``list_flatten`` and
``dictionary_encode`` turn a slice of texts into dictionary indices; an n-gram is an (n-1)-gram's index beside the index
of the next word, and the CRC-32 of each *distinct* pair is carried on from its first part.  A feature is a bucket
``crc32 modulo buckets``.  One pass counts the buckets of the corpus and of the target (each task sends its sums), a
second takes every document's gains by index and adds them up by segments.

The draw is Gumbel top-k: a document's weight plus noise that depends on its id alone, highest first, so a retried task
draws the same.  Ranks come from a range partitioning and the places within it; no task sees all documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.arrays import release_memory, slices, text_bytes
from ledgerlens.llm.registry import register, table
from ledgerlens.session import scratch_path

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MAX_BUCKETS = 1 << 20                # the gains (8 bytes each) go to every task: at most 8 MB
SLICE_BYTES = 1 << 21


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(index of each word, distinct words, document of each word)."""
    parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), SEPARATORS)
    words, doc = pc.list_flatten(parts), pc.list_parent_indices(parts)
    some = pc.not_equal(words, "")                 # a text that starts or ends with a separator
    coded = pc.dictionary_encode(words.filter(some))
    return (coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary,
            doc.filter(some).to_numpy(zero_copy_only=False).astype(np.int64))


def feature_buckets(texts: pa.Array, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, its document, words of each document) for runs of 1 to ``n`` words; documents ascend."""
    index, distinct, doc = _words(texts)
    word_bytes = [w.encode() for w in distinct.to_pylist()]
    crc = np.array([zlib.crc32(w) for w in word_bytes], np.int64)
    found, owners = [crc[index] % buckets if len(index) else index], [doc]
    gram, of = index, crc
    for k in range(1, n):
        if len(index) <= k:
            break
        pair = gram[:len(index) - k] * len(word_bytes) + index[k:]
        inside = doc[k:] == doc[:-k]
        seen, back = np.unique(pair, return_inverse=True)
        first, last = np.divmod(seen, len(word_bytes))
        of = np.array([zlib.crc32(word_bytes[w], zlib.crc32(b" ", c)) for c, w in zip(of[first].tolist(), last.tolist())],
                      np.int64)
        gram = back
        found.append((of[gram] % buckets)[inside])
        owners.append(doc[:-k][inside])
    words = np.bincount(doc, minlength=len(texts))
    if n > 1:
        flat, owner = np.concatenate(found), np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return flat[order], owner[order], words
    return found[0], doc, words


def _parts(column: pa.Array):
    """(first row, texts) of slices of a bounded number of bytes, or one longer text."""
    for i, j in slices(text_bytes(column)[1], SLICE_BYTES):
        yield i, column.slice(i, j - i)


def bucket_counts(docs: DataFrame, text_col: str = "text", n: int = 1, buckets: int = 10_000) -> DataFrame:
    """(bucket, n): features of all texts; null and empty texts have none.  A task sends one row a bucket."""
    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, texts in _parts(b.column(0)):
                total += np.bincount(feature_buckets(texts, n, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["bucket", "n"])
        release_memory()
    return (docs.select(F.col(text_col).cast("string")).mapInArrow(run, "bucket bigint, n bigint")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text", n: int = 1,
          buckets: int = 10_000) -> DataFrame:
    """(bucket, gain) of every bucket: floor(1000 * ln of the smoothed share in the target over that in the corpus)."""
    if not 0 < buckets <= MAX_BUCKETS:
        raise ValueError(f"1 to {MAX_BUCKETS} buckets")
    spark = docs.sparkSession
    s = bucket_counts(docs, text_col, n, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).cast("bigint").alias("t"))
    t = bucket_counts(target, target_col, n, buckets).select("bucket", F.lit(0).cast("bigint").alias("s"), F.col("n").alias("t"))
    every = spark.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).cast("bigint").alias("s"),
                                        F.lit(0).cast("bigint").alias("t"))
    path = scratch_path(spark, "buckets")
    every.union(s).union(t).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).write.parquet(path)
    sums = spark.read.parquet(path)
    both = sums.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect()[0]
    share = ((F.col("t") + 1).cast("double") * F.lit(float(both["s"] + buckets))
             / ((F.col("s") + 1).cast("double") * F.lit(float(both["t"] + buckets))))
    return sums.select("bucket", F.floor(F.lit(1000.0) * F.ln(share)).cast("bigint").alias("gain"))


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", n: int = 1) -> DataFrame:
    """(id, n_words, n_features, weight) of every row: the floored mean of the gains of its features, 0 without any."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            words, features, weight = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            for i, texts in _parts(b.column(1)):
                bucket, doc, w = feature_buckets(texts, n, len(gain))
                j = i + len(texts)
                words[i:j], features[i:j] = w, np.bincount(doc, minlength=len(texts))
                before = np.append(0, np.cumsum(gain[bucket]))
                ends = np.cumsum(features[i:j])
                weight[i:j] = before[ends] - before[ends - features[i:j]]
            weight = np.floor_divide(weight, np.maximum(features, 1))
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, (words, features, weight))],
                                             names=["id", "n_words", "n_features", "weight"])
        release_memory()
    return (docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
            .mapInArrow(run, "id bigint, n_words bigint, n_features bigint, weight bigint"))


def gumbel(id_col: Column, seed: int) -> Column:
    """floor(-1000 * ln(-ln u)), u from the first 32 bits of sha256("seed:id"); a null id counts as an empty one."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def ranked(scored: DataFrame, eligible: Column, order: list[Column], percent: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, ... in ``order`` for floor(percent of the eligible rows), null for the others.

    Rows are dealt by ranges of the order and written with their place; the ranges before (a row each) give the rest.
    """
    spark = scored.sparkSession
    path = scratch_path(spark, "ranked")
    first = F.col("_eligible").desc()
    (scored.withColumn("_eligible", F.coalesce(eligible, F.lit(False))).repartitionByRange(first, *order)
     .sortWithinPartitions(first, *order).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path))
    rows = (spark.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
            .withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))))
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_eligible").cast("bigint")).alias("e"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    drawn = F.floor(rows.agg(F.sum(F.col("_eligible").cast("bigint")).alias("e")).scalar() * percent / 100).cast("bigint")
    place = F.col("_base") + F.col("_at") + 1
    return (rows.join(parts, "_part").withColumn("rank", F.when(F.col("_eligible") & (place <= drawn), place))
            .drop("_eligible", "_at", "_part", "_base"))


def importance_sample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      target_col: str = "text", n: int = 1, buckets: int = 10_000, percent: int = 10, min_words: int = 20,
                      seed: int = 2024) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every document; rank is null where it isn't drawn.

    Features are runs of 1 to ``n`` words; drawn are the floor(percent) highest scores of those with ``min_words`` words.
    Null and empty texts have no features, weight 0 and are never drawn (for ``min_words`` > 0); a text of any length is
    weighed whole.  Rows with one id have the same noise and each its own weight; ties go to the smaller id, a null id
    last, then to the larger number of features.  Other columns are ignored; empty tables give an empty result, an empty
    target one in which rare features gain.
    """
    rows = gains(docs, target, text_col, target_col, n, buckets).collect()      # bounded by ``buckets``
    gain = np.zeros(buckets, np.int64)
    gain[[r["bucket"] for r in rows]] = [r["gain"] for r in rows]
    path = scratch_path(docs.sparkSession, "weights")            # the texts are weighed once, the ranges sample this
    weigh(docs, gain, id_col, text_col, n).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)).write.parquet(path)
    scored = docs.sparkSession.read.parquet(path)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features").desc(), F.col("weight").desc()]
    return ranked(scored, F.col("n_words") >= min_words, order, percent)


OP13_SQL = r"""
WITH RECURSIVE crc_table(i, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_table WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM crc_table WHERE k = 8),
words AS (SELECT 'd' AS kind, doc_id AS id, unnest(w) AS word FROM (SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)
          UNION ALL SELECT 'b', item_id, unnest(w) FROM (SELECT item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)),
coded AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM words)),
bucket AS (SELECT word, CAST(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(h), 2),
             lambda p: CAST(instr('0123456789ABCDEF', h[p + 1]) * 16 + instr('0123456789ABCDEF', h[p + 2]) - 17 AS BIGINT))),
             lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295::BIGINT) % 10000 AS BIGINT) AS bucket
           FROM coded, crc),
n AS (SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t
      FROM words JOIN bucket USING (word) GROUP BY bucket),
gain AS (SELECT bucket, CAST(floor(1000 * ln(((t + 1)::DOUBLE * ((SELECT sum(s) FROM n) + 10000)::DOUBLE)
           / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM n) + 10000)::DOUBLE))) AS BIGINT) AS gain FROM n),
weight AS (SELECT id, count(*) AS n, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS w
           FROM words JOIN bucket USING (word) JOIN gain USING (bucket) WHERE kind = 'd' GROUP BY id),
scored AS (SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(w, 0) AS weight,
             coalesce(w, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
             / 4294967296::DOUBLE))) AS BIGINT) AS score FROM documents d LEFT JOIN weight ON id = d.doc_id),
drawn AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) FROM drawn) * 10 // 100 THEN rank END AS rank
FROM scored LEFT JOIN drawn USING (doc_id)
"""


@register("op13_importance_sample", OP13_SQL)
def op13_importance_sample(spark, sf_dir):
    found = importance_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")
