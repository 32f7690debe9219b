"""Exact top-k search by MaxScore over shards of postings.

A vector is a document whose terms are its components, split by sign: term (d, +) lists the vectors with a positive
component d, (d, -) those with a negative one, each with its integer value; zeros have no posting.  For a query only
the terms whose contributions are positive can lift a score; each has an upper bound in the shard.  Terms are ordered
by bound; while the bounds of the smallest ones together stay below the k-th best score so far they are
non-essential: a vector found in none of the essential postings cannot enter.  Essential postings are traversed term
by term, then the non-essential ones and those that lower the score are probed for the vectors that are still
competitive (partial score plus what is left of the bounds reaches the threshold).  A shard is worked through in blocks
of vectors, so the threshold of the first block prunes the next.

Spark deals (shard of vectors) x (block of queries) to tasks; the k best of every shard are merged by rank.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.registry import register, table

BLOCK = 4096                         # vectors of a shard that are scored at a time
FIRST = 256                          # and in the first block, which has no threshold yet
TOP = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """No null, no null or non-finite component."""
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda x: F.coalesce(ok(x.cast("double")), F.lit(False))),
                                           F.lit(False))


class Shard:
    """Postings of the vectors of one shard, block by block; ids ascend."""

    def __init__(self, ids: np.ndarray, vectors: list[np.ndarray]):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.dims = max((len(v) for v in vectors), default=0)
        wide = np.zeros((len(ids), self.dims), np.int64)
        for row, i in enumerate(order):
            wide[row, :len(vectors[i])] = vectors[i]
        self.rows = wide
        self.blocks = []
        self.largest = _largest(wide)
        for a, b in pairwise([*range(0, min(len(ids), FIRST), FIRST), *range(FIRST, len(ids), BLOCK), len(ids)]):
            part = wide[a:b]
            lists = []
            for d in range(self.dims):
                col = part[:, d]
                lists.append(tuple((p, col[p]) for p in (np.flatnonzero(col > 0), np.flatnonzero(col < 0))))
            self.blocks.append((a, part, lists, part.max(0, initial=0), part.min(0, initial=0)))

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best vectors but ``own``; ties to the smaller id."""
        best = np.zeros(0, np.int64)
        best_at = np.zeros(0, np.int64)
        q = np.zeros(self.dims, np.int64)
        q[:min(len(query), self.dims)] = query[:self.dims]
        used = np.flatnonzero(q)
        if self.largest * _largest(q) * self.dims > TOP:
            return self._search_wide(q, own, k)
        for a, part, lists, high, low in self.blocks:
            bound = np.where(q > 0, q * high, q * low)        # 0 or more
            terms = used[np.argsort(-bound[used], kind="stable")]
            terms = terms[bound[terms] > 0]
            tail = np.append(np.cumsum(bound[terms][::-1])[::-1], 0)
            full = len(best) >= k
            need = best[-1] if full else None
            # later ids lose ties, so a vector of a later block must score more than the k-th best
            essential = int(np.searchsorted(-tail, -need, "left")) if full and need >= 0 else len(terms)
            if full:
                score = np.zeros(len(part), np.int64)
                for d in terms[:essential]:
                    at, value = lists[d][0 if q[d] > 0 else 1]
                    score[at] += q[d] * value
                live = np.flatnonzero(score + tail[min(essential, len(terms))] > need)
                sums = score[live]
                for j in range(essential, len(terms)):
                    if not len(live):
                        break
                    value = part[live, terms[j]] * q[terms[j]]
                    sums = sums + np.maximum(value, 0)
                    keep = sums + tail[j + 1] > need
                    live, sums = live[keep], sums[keep]
            else:
                live = np.arange(len(part))
            live = live[self.ids[live + a] != own]
            if not len(live):
                continue
            score = part[live][:, used] @ q[used]
            if len(score) > 8 * k:
                keep = score >= np.partition(score, len(score) - k)[len(score) - k]
                live, score = live[keep], score[keep]
            at = live + a
            best = np.concatenate([best, score])
            best_at = np.concatenate([best_at, at])
            top = np.lexsort((self.ids[best_at], -best))[:k]
            best, best_at = best[top], best_at[top]
        return self.ids[best_at], best

    def _search_wide(self, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The same in Python integers, for scores that may not fit; those beyond 63 bits are clamped."""
        at = np.flatnonzero(self.ids != own)
        score = np.clip(self.rows[at].astype(object) @ q.astype(object), -TOP, TOP).astype(np.int64)
        top = np.lexsort((self.ids[at], -score))[:k]
        return self.ids[at[top]], score[top]


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "vector",
           shard_rows: int = 16384, query_rows: int = 16384) -> DataFrame:
    """(query_id, rank, id, score) of the k highest integer inner products of each query with all rows but its own.

    ``vec_col`` holds array<bigint>.  Null or unusable vectors, and null ids, take no part; equal vectors all do; ties
    go to the smaller id; fewer than k candidates give all.  Components that one side lacks count as 0.  Of rows with
    equal ids each is a candidate of its own, and none is a candidate for a query of that id.  Scores beyond 63 bits are
    clamped to the largest or smallest of them.
    """
    plain = lambda df: (df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("v"))
                        .filter(F.col("id").isNotNull() & F.col("v").isNotNull()))
    vectors, queries = plain(vectors), plain(queries).dropDuplicates(["id", "v"])
    n, m = vectors.count(), queries.count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-m // query_rows))
    spread = lambda side, count: F.pmod(F.xxhash64(F.col("id"), F.lit(side)), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = vectors.withColumn("shard", spread(1, shards)).withColumn("block", every(blocks))
    right = queries.withColumn("block", spread(2, blocks)).withColumn("shard", every(shards))

    def run(_, docs: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "id": [], "score": []}
        if len(docs) and len(asks):
            shard = Shard(docs["id"].to_numpy(np.int64), [np.asarray(v, np.int64) for v in docs["v"]])
            for own, v in zip(asks["id"], asks["v"]):
                ids, scores = shard.search(np.asarray(v, np.int64), own, k)
                out["query_id"] += [own] * len(ids)
                out["id"] += ids.tolist()
                out["score"] += scores.tolist()
        return pd.DataFrame(out, dtype="int64")

    found = (left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
             .applyInPandas(run, "query_id bigint, id bigint, score bigint"))
    by = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id"))
    return (found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"))


def floor_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    return (df.filter(usable(F.col(vec_col)))
            .select(id_col, F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
                    .alias("vector")))


OP4_SQL = """
WITH ok AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v
            FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM ok q JOIN ok c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@register("op4_maxscore_topk", OP4_SQL)
def op4_maxscore_topk(spark, sf_dir):
    vectors = floor_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return search(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)
