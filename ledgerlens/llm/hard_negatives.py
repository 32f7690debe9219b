"""Hard negatives: for each anchor and each of its positives, the best rows of another label in a window of scores.

Scores are integer inner products, made tile by tile (anchors x candidates) with Strassen's recursion: seven products of
half the side instead of eight, odd sides padded with zeros, additions in int64.  Int64 arithmetic is exact modulo 2**64,
so a product is exact wherever its result fits, whatever its intermediate sums do; a tile whose bound doesn't fit is
multiplied in Python integers and clamped.

A tile leaves a heap an anchor: first the best rows of the anchor's label (the positives), then, with the windows that
their scores open, the best rows of other labels for each window.  Heaps merge by (score, id), so Spark deals
(block of anchors) x (shard of candidates) to tasks and ranks what they return.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.registry import register, table
from ledgerlens.llm.topk import TOP, _largest, usable
from ledgerlens.session import scratch_path

SMALL = 16                           # sides up to this are multiplied plainly
TILE = (256, 4096)                   # anchors x candidates scored at a time


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of int64 matrices, modulo 2**64."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= SMALL:
        return a @ b
    if m % 2 or k % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
    if k % 2 or n % 2:
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, h = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :h], b[:j, h:], b[j:, :h], b[j:, h:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * i, 2 * h), np.int64)
    out[:i, :h] = p1 + p4 - p5 + p7
    out[:i, h:] = p3 + p5
    out[i:, :h] = p2 + p4
    out[i:, h:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` exactly; results beyond 63 bits are clamped to the largest or smallest of them."""
    if _largest(a) * _largest(b) * a.shape[1] <= TOP:
        return strassen(np.ascontiguousarray(a), np.ascontiguousarray(b))
    exact = a.astype(object) @ b.astype(object)
    return np.clip(exact, -TOP, TOP).astype(np.int64)


class Heaps:
    """The ``k`` best (score, id) of every slot; ids are offered in ascending order, so a later tie never enters."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.need = np.full(slots, -TOP - 1)             # what a full slot's candidate has to exceed

    def offer(self, slots: np.ndarray, scores: np.ndarray, fit: np.ndarray, ids: np.ndarray) -> None:
        """Rows of ``scores`` go to ``slots``, its columns are ``ids``; only ``fit`` places count."""
        fit = fit & (scores > self.need[slots][:, None])
        if np.count_nonzero(fit) > 4 * self.k * len(slots) and scores.shape[1] > self.k:
            least = np.partition(np.where(fit, scores, -TOP - 1), -self.k, axis=1)[:, -self.k]
            fit &= scores >= least[:, None]
        row, col = np.nonzero(fit)
        if not len(row):
            return
        self.slot = np.concatenate([self.slot, slots[row]])
        self.score = np.concatenate([self.score, scores[row, col]])
        self.id = np.concatenate([self.id, ids[col]])
        order = np.lexsort((self.id, -self.score, self.slot))
        slot = self.slot[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        order = order[place < self.k]
        self.slot, self.score, self.id = self.slot[order], self.score[order], self.id[order]
        last = np.flatnonzero(place[place < self.k] == self.k - 1)
        self.need[self.slot[last]] = self.score[last]


def _matrix(vectors, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.int64)
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


def _tiles(asks: pd.DataFrame, docs: pd.DataFrame):
    """(first anchor, ids, anchors' labels, candidates' labels, same id, scores) of every tile; candidates by id."""
    docs = docs.sort_values("id", kind="stable")
    dims = max(max((len(v) for v in side["v"]), default=0) for side in (asks, docs))
    a, c = _matrix(asks["v"].to_list(), dims), _matrix(docs["v"].to_list(), dims)
    code, _ = pd.factorize(pd.concat([asks["label"], docs["label"]]))
    la, lc = code[:len(asks)], code[len(asks):]
    own, ids = asks["id"].to_numpy(np.int64), docs["id"].to_numpy(np.int64)
    for i in range(0, len(a), TILE[0]):
        for j in range(0, len(c), TILE[1]):
            s, t = slice(i, i + TILE[0]), slice(j, j + TILE[1])
            yield i, ids[t], la[s][:, None], lc[t][None, :], own[s][:, None] == ids[t][None, :], products(a[s], c[t].T)


def _deal(candidates: DataFrame, anchors: DataFrame, blocks: int, shards: int, run, schema: str) -> DataFrame:
    """Every block of anchors meets every shard of candidates in a task of its own."""
    spread = lambda key, count: F.pmod(F.xxhash64(key), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = anchors.withColumn("block", spread("anchor", blocks)).withColumn("shard", every(shards))
    right = candidates.withColumn("shard", spread("id", shards)).withColumn("block", every(blocks))
    return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(
        lambda asks, docs: run(asks, docs), schema)


def _heap_rows(heaps: Heaps, anchors: np.ndarray, windows: int = 1) -> pd.DataFrame:
    return pd.DataFrame({"anchor": anchors[heaps.slot // windows], "window": heaps.slot % windows, "id": heaps.id,
                         "score": heaps.score}, dtype="int64")


def hard_negatives(rows: DataFrame, anchors: DataFrame, id_col: str = "vec_id", label_col: str = "label",
                   vec_col: str = "vector", positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   of: int = 100, shard_rows: int = 16384, block_rows: int = 4096) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank).

    An anchor's positives are its ``positives`` best rows of the same label; a positive's negatives are the ``negatives``
    best rows of another label with low * positive score <= of * score <= high * positive score.  Better is the higher
    score, then the smaller id.  Rows of the anchor's own id are never candidates.  Rows with a null id, label or vector
    take no part; components one side lacks count as 0; scores beyond 63 bits are clamped.  Rows with one id are
    candidates of their own; an anchor that stands several times with one label and vector is one anchor, otherwise each
    is one, and its rows stand beside each other.  Empty tables give an empty result; other columns are ignored.
    """
    spark = rows.sparkSession
    plain = lambda df: (df.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("string").alias("label"),
                                  F.col(vec_col).cast("array<bigint>").alias("v")).dropna())
    rows = plain(rows)
    anchors = plain(anchors).withColumn("anchor", F.xxhash64("id", "label", "v")).dropDuplicates(["anchor", "id"])
    blocks, shards = (max(1, -(-df.count() // size)) for df, size in ((anchors, block_rows), (rows, shard_rows)))

    def best(asks: pd.DataFrame, docs: pd.DataFrame) -> pd.DataFrame:
        heaps = Heaps(len(asks), positives)
        for i, ids, la, lc, own, scores in _tiles(asks, docs):
            heaps.offer(np.arange(i, i + len(scores)), scores, (la == lc) & ~own, ids)
        return _heap_rows(heaps, asks["anchor"].to_numpy())

    found = _deal(rows, anchors, blocks, shards, best, "anchor bigint, window bigint, id bigint, score bigint")
    by = Window.partitionBy("anchor").orderBy(F.col("score").desc(), F.col("id"))
    path = scratch_path(spark, "positives")
    (found.withColumn("place", F.row_number().over(by)).filter(F.col("place") <= positives)
     .select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
     .write.parquet(path))
    chosen = spark.read.parquet(path)
    opened = chosen.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("w"))
    asked = anchors.join(opened.select("anchor", F.col("w.positive_score").alias("p")), "anchor")

    def within(asks: pd.DataFrame, docs: pd.DataFrame) -> pd.DataFrame:
        lows, highs = np.full((2, len(asks), positives), 0)
        lows[:] = 1                                          # an empty window
        for row, scores in enumerate(asks["p"]):
            for k, p in enumerate(scores):
                lows[row, k], highs[row, k] = max(-TOP, -(-low * int(p) // of)), min(TOP, high * int(p) // of)
        heaps = Heaps(len(asks) * positives, negatives)
        for i, ids, la, lc, own, scores in _tiles(asks, docs):
            j = i + len(scores)
            other = (la != lc) & ~own
            for k in range(positives):
                fit = other & (scores >= lows[i:j, k, None]) & (scores <= highs[i:j, k, None])
                heaps.offer(np.arange(i, j) * positives + k, scores, fit, ids)
        return _heap_rows(heaps, asks["anchor"].to_numpy(), positives)

    found = _deal(rows, asked, blocks, shards, within, "anchor bigint, window bigint, id bigint, score bigint")
    by = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), F.col("id"))
    kept = found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= negatives)
    kept = kept.withColumn("place", (F.col("window") + 1).cast("int")).drop("window")
    return (kept.join(chosen, ["anchor", "place"]).join(anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score"), F.col("place").alias("positive_rank")))


OP12_SQL = """
WITH ok AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v
            FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
             CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM ok a JOIN ok c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM (SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
        row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same) WHERE place <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY anchor_id, place ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
      FROM p JOIN s USING (anchor_id)
      WHERE NOT same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


@register("op12_hard_negatives", OP12_SQL)
def op12_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").filter(usable(F.col("embedding"))).select(
        "vec_id", label.alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("bigint")).alias("vector"))
    found = hard_negatives(rows, rows.filter(F.col("vec_id") % 50 == 0))
    return found.drop("positive_rank")
