"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

The labelled documents are dealt by a hash of their id into three parts.  From the first comes a lexicon: words and
word beginnings (three to six letters, so that inflected forms count) whose presence tells toxic documents from
others, weighted by log odds.  On the second, boosted trees learn from dense features: densities of the learned and of
a fixed lexicon, hits near a second-person pronoun, capitals, punctuation and obfuscation rates.  On the third, an
isotonic regression turns the trees' output into a probability.

Fitting takes at most ``FIT_ROWS`` labelled documents (those of the smallest hash); scoring reads every whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.arrays import release_memory
from ledgerlens.llm.registry import register, table
from ledgerlens.session import scratch_path

FIT_ROWS = 30_000                    # bound of the labelled sample
LEXICON = 500                        # learned entries kept
NEAR = 5                             # words between a pronoun and a hit
#: fixed values: common insults, and second-person words of the four languages
INSULTS = ("idiot", "moron", "stupid", "scum", "trash", "loser", "pathetic", "worthless", "disgusting", "clown", "dumb",
           "ugly", "hate", "kill", "damn", "hell", "crap", "jerk", "fool", "creep", "pig", "freak", "vermin", "imbecile",
           "idiota", "estúpido", "basura", "asco", "odio", "imbécil", "connard", "ordure", "débile", "crétin", "haine",
           "dummkopf", "abschaum", "hass", "widerlich", "arschloch")
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "tu", "tus", "te", "ti", "usted", "ustedes", "vosotros",
                 "toi", "ton", "ta", "tes", "vous", "votre", "vos", "du", "dich", "dir", "dein", "deine", "euch", "ihr")
_WORD = re.compile(r"[^\W\d_]+")
_ODD = re.compile(r"[^\W\d_]+[@$*0-9!]+[^\W\d_]+")
_LEET = str.maketrans("@$013457!*", "asoieasti*")
_REPEAT = re.compile(r"(.)\1\1")
FEATURES = ("insults", "learned_mean", "learned_max", "learned_share", "learned_count", "learned_distinct", "near_you",
            "second_person", "capitals", "capital_words", "exclaim", "question", "punctuation", "digits", "obfuscated",
            "obfuscated_insults", "repeats", "length", "word_length")


def word_parts(word: str) -> list[str]:
    """The word, and its beginnings of three to six letters marked with a star."""
    return [word, *(word[:k] + "*" for k in (3, 4, 5, 6) if len(word) >= k)]


class Lexicon:
    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.known: dict[str, float] = {}

    def weight(self, word: str) -> float:
        w = self.known.get(word)
        if w is None:
            if len(self.known) > 100_000:
                self.known.clear()
            w = self.known[word] = max((self.weights.get(p, 0.0) for p in word_parts(word)), default=0.0)
        return w


_INSULTS, _YOU = frozenset(INSULTS), frozenset(SECOND_PERSON)


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The dense features of a whole text; all zero for one without words."""
    raw_words = _WORD.findall(text)
    words = "\n".join(raw_words).lower().split("\n") if raw_words else []
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    count = Counter(words)
    weighed = [(w, lexicon.weight(w)) for w in count]
    hits = {w: x for w, x in weighed if x > 0}
    total, most = sum(hits[w] * count[w] for w in hits), max(hits.values(), default=0.0)
    found = sum(count[w] for w in hits)
    you = sum(count[w] for w in _YOU & count.keys())
    strong = {w for w, x in hits.items() if x >= 2.0} | (_INSULTS & count.keys())
    near = 0
    if you and strong:
        last = -NEAR - 1
        places = [(i, w in strong) for i, w in enumerate(words) if w in strong or w in _YOU]
        for at in (places, [(-i, s) for i, s in reversed(places)]):
            last = None
            for i, s in at:
                if not s:
                    last = i
                elif last is not None and i - last <= NEAR:
                    near += 1
    size = len(text)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    chars = np.bincount(raw, minlength=256)
    odd = _ODD.findall(text) if (chars[48:58].any() or chars[[33, 36, 42, 64]].any()) else []
    capital = sum(w.isupper() and len(w) > 1 for w in raw_words)
    return [sum(count[w] for w in _INSULTS & count.keys()) / n, total / n, most, found / n, math.log1p(found),
            math.log1p(len(strong)), near / n, you / n, float(chars[65:91].sum()) / size, capital / n,
            float(chars[33]) / size, float(chars[63]) / size, float(chars[33:48].sum() + chars[58:65].sum()) / size,
            float(chars[48:58].sum()) / size, len(odd) / n,
            sum(lexicon.weight(w.lower().translate(_LEET)) >= 2.0 or w.lower().translate(_LEET) in _INSULTS for w in odd) / n,
            len(_REPEAT.findall(text)) / n, math.log1p(n), size / n]


def dense(df: DataFrame, lexicon: dict[str, float], text_col: str = "text") -> DataFrame:
    """``df`` with the features of its text as ``x`` (array<double>); its columns pass through.  The text may be a field of
    a struct column (``row.text``)."""
    column, _, field = text_col.partition(".")
    at = df.columns.index(column)
    ddl = ", ".join(f"`{c}` {t}" for c, t in df.dtypes) + ", x array<double>"

    def run(batches: Iterator[pa.RecordBatch]):
        lex = Lexicon(lexicon)
        for b in batches:
            for i in range(0, b.num_rows, 200):
                part = b.slice(i, 200)
                text = part.column(at).field(field) if field else part.column(at)
                x = [features(t or "", lex) for t in text.to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(x, pa.list_(pa.float64()))],
                                                 names=[*part.schema.names, "x"])
        release_memory()

    return df.mapInArrow(run, ddl)


class ToxicityModel:
    """``transform`` adds ``score`` to (.., x)."""

    def __init__(self, lexicon: dict[str, float], trees=None, calibration=None, constant: float = 0.0):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def raw(self, df: DataFrame) -> DataFrame:
        v = df.withColumn("v", array_to_vector("x"))
        return self.trees.transform(v).withColumn("margin", vector_to_array("probability")[1])

    def _scored(self, df: DataFrame) -> DataFrame:
        """(.., x) with ``score``."""
        if self.trees is None:
            return df.withColumn("score", F.lit(self.constant))
        out = self.calibration.transform(self.raw(df))
        score = F.least(F.greatest(F.coalesce("prediction_iso", F.lit(self.constant)), F.lit(0.0)), F.lit(1.0))
        return out.withColumn("score", score)

    def score(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, score) of every row; null and empty texts get the score of no features.

        Texts of any length are read whole; rows that repeat an id or a text are each scored, equal texts alike; null ids
        stay; other columns are ignored; an empty table gives an empty result.
        """
        src = dense(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), self.lexicon).drop("text")
        return self._scored(src).select(F.col("id").alias(id_col), "score")

    def keep_below(self, df: DataFrame, threshold: float, text_col: str = "text") -> DataFrame:
        """The rows of ``df`` whose score is below the threshold: a filter without a join or a shuffle."""
        src = dense(df.select(F.struct("*").alias("row")), self.lexicon, f"row.{text_col}")
        return self._scored(src).filter(F.col("score") < threshold).select("row.*")


def learned_lexicon(rows: DataFrame, size: int = LEXICON) -> dict[str, float]:
    """Entry -> log odds of its presence in toxic documents; the ``size`` entries that tell most.

    Counted by Spark; only the entries kept (a bounded number) come to the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            parts, label = [], []
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = {p for w in set(_WORD.findall((t or "").lower())) for p in word_parts(w)}
                parts += own
                label += [y] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.string()), pa.array(label, pa.int32())],
                                             names=["part", "y"])

    sums = rows.agg(F.sum("y").alias("p"), F.count(F.lit(1)).alias("n")).collect()[0]
    pos, neg = sums["p"] or 0, (sums["n"] or 0) - (sums["p"] or 0)
    if not pos or not neg:
        return {}
    counts = (rows.select("text", "y").mapInArrow(run, "part string, y int").groupBy("part")
              .agg(F.sum("y").alias("p"), F.count(F.lit(1)).alias("n")).filter("p >= 3"))
    rate = F.col("p") / F.lit(pos)
    other = (F.col("n") - F.col("p")) / F.lit(neg)
    odds = F.log((F.col("p") + 0.5) / (pos + 1.0)) - F.log((F.col("n") - F.col("p") + 0.5) / (neg + 1.0))
    spread = F.sqrt((rate * (1 - rate) + 0.01) / pos + (other * (1 - other) + 0.01) / neg)
    best = (counts.select("part", odds.alias("w"), ((rate - other) / spread).alias("z")).filter("z > 2.5 AND w > 1.5")
            .orderBy(F.desc("z"), "part").limit(size).collect())
    return {r["part"]: r["w"] for r in best}


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, trees: int = 20, depth: int = 3) -> ToxicityModel:
    """Learn from ``labels`` (doc_id, toxic) of ``docs`` (doc_id, text).

    Null labels and ids take no part; without both labels in every part the model is the share of toxic rows, or 0.
    """
    spark = docs.sparkSession
    chosen = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("y"))
              .withColumn("h", F.xxhash64("doc_id", F.lit(11))).orderBy("h", "doc_id").limit(fit_rows)
              .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(10)).cast("int")))
    path = scratch_path(spark, "toxicity-sample")
    # at most fit_rows ids are broadcast; the texts of those rows are all that is written
    # the sample goes to a few files: training runs many small jobs over it
    (docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id", "y", "part")), "doc_id")
     .select("text", "y", "part").repartition(max(1, fit_rows // 2500)).write.parquet(path))
    rows = spark.read.parquet(path)
    lexicon = learned_lexicon(rows.filter("part < 5"))
    path = scratch_path(spark, "toxicity-features")
    dense(rows.filter("part >= 5"), lexicon).drop("text").coalesce(4).write.parquet(path)
    known = spark.read.parquet(path)
    seen = {(r["grow"], r["y"]): r["count"] for r in known.groupBy((F.col("part") < 8).alias("grow"), "y").count().collect()}
    share = sum(c for (_, y), c in seen.items() if y) / max(1, sum(seen.values()))
    if len(seen) < 4:
        return ToxicityModel(lexicon, constant=float(share))
    grow = known.filter("part < 8").select(array_to_vector("x").alias("v"), F.col("y").cast("double").alias("y"))
    model = ToxicityModel(lexicon, GBTClassifier(featuresCol="v", labelCol="y", maxIter=trees, maxDepth=depth, stepSize=0.3,
                                                 maxBins=32, seed=1).fit(grow), constant=float(share))
    iso = model.raw(known.filter("part >= 8")).select("margin", F.col("y").cast("double").alias("y"))
    model.calibration = IsotonicRegression(featuresCol="margin", labelCol="y", predictionCol="prediction_iso").fit(iso)
    # predictions of the trees and of the calibration live side by side
    model.trees.setPredictionCol("prediction_trees")
    return model


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fitted(spark, sf_dir: str) -> ToxicityModel:
    """The model of the tables in ``sf_dir``, learned from the rows that are not held out."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return fit(table(spark, sf_dir, "documents"), labels.filter(~held_out(F.col("doc_id"))))


THRESHOLD = 0.7


@register("op1_toxicity_gbt")
def op1_toxicity_gbt(spark, sf_dir):
    scored = fitted(spark, sf_dir).score(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
