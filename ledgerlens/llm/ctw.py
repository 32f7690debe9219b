"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions; each decision has a context tree of its own whose nodes are the last 0 to ``DEPTH``
bytes.  A node's Krichevsky-Trofimov estimate is mixed with what its deeper contexts say, with the weights of context-
tree weighting: P_w = (P_kt + product of the children's P_w) / 2.  The counts and weights come from the training rows
and stay fixed while texts are scored; where a context was not seen in training, the mixture ends at the last one that
was.  A text is its lower-cased bytes (A-Z) and an end mark; before its first byte stand pad marks.

Everything is counted over all rows, and no model is sent around whole:

1. The texts are dealt into chunks of some ``CHUNK_BYTES``.  Each chunk asks for the (context, byte) grams and the words it
   holds and tells how often its training rows do: sorted arrays, one a chunk and part of the keys.
2. Grams are dealt to parts by their nearest two context bytes, so a part has whole subtrees from depth 2 on.  A first pass
   gives the weighted probabilities at depth 2; the levels above it have at most 256 contexts of 255 nodes and are
   finished on the driver.  A second pass prices every gram and answers each chunk, in the order of its keys.
3. Words are dealt to parts by their hash and added up likewise, for the add-one unigram base score.
4. Each chunk meets its answers and scores its texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.arrays import lowered, mix64, release_memory, slices, span_hashes, text_bytes, word_bounds
from ledgerlens.llm.registry import register, table
from ledgerlens.session import scratch_path

DEPTH = 5                            # context bytes; a gram is they and the byte behind them, in 48 bits
CHUNK_BYTES = 12 << 20
PAD, END = 0xFE, 0xFF                # never part of UTF-8
_LN2, _LOG_PI = math.log(2), math.log(math.pi)
_HALF = np.concatenate([[0.5 * _LOG_PI], 0.5 * _LOG_PI + np.cumsum(np.log(np.arange(4096) + 0.5))])


def _stirling(x: np.ndarray) -> np.ndarray:
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x ** 3)


def _lgamma_half(n: np.ndarray) -> np.ndarray:
    """log Gamma(n + 1/2) of whole numbers."""
    return np.where(n < len(_HALF), _HALF[np.minimum(n, len(_HALF) - 1)], _stirling(np.maximum(n, 100) + 0.5))


_FACT = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 4097)))])


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the KT block probability of so many zeros and ones."""
    n = zeros + ones
    fact = np.where(n < len(_FACT), _FACT[np.minimum(n, len(_FACT) - 1)], _stirling(np.maximum(n, 100) + 1.0))
    return _lgamma_half(zeros) + _lgamma_half(ones) - fact - _LOG_PI


def _stop(kt: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Weight of a node's own estimate against its children's."""
    return 1 / (1 + np.exp(np.clip(below - kt, -700, 700)))


class Level:
    """The nodes of one depth for one of the eight bits: which one each gram uses, counts, weighted probability."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, depth: int, bit: int):
        sym = codes & 0xFF
        key = ((codes >> (8 * (DEPTH + 1 - depth))) << 8) | (1 << bit) | (sym >> (8 - bit))
        self.keys, self.first, self.of = np.unique(key, return_index=True, return_inverse=True)
        one = ((sym >> (7 - bit)) & 1).astype(bool)
        n = len(self.keys)
        self.ones = np.bincount(self.of[one], counts[one], n).astype(np.int64)
        self.zeros = np.bincount(self.of[~one], counts[~one], n).astype(np.int64)
        self.kt = log_kt(self.zeros, self.ones)

    def weigh(self, deeper: Level | None) -> None:
        if deeper is None:
            self.weighted, self.stop = self.kt, np.ones(len(self.keys))
        else:
            below = np.bincount(self.of[deeper.first], deeper.weighted, len(self.keys))
            self.weighted = np.where(self.zeros + self.ones > 0, np.logaddexp(self.kt, below) - _LN2, 0.0)
            self.stop = _stop(self.kt, below)


def _subtrees(codes: np.ndarray, counts: np.ndarray, bit: int) -> list[Level]:
    """Levels 2 to DEPTH of whole subtrees."""
    levels = [Level(codes, counts, d, bit) for d in range(2, DEPTH + 1)]
    for d in range(len(levels) - 1, -1, -1):
        levels[d].weigh(levels[d + 1] if d + 1 < len(levels) else None)
    return levels


def depth_two(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, weighted, zeros, ones): depth-2 nodes summed by their depth-1 node (nearest byte << 8 | node)."""
    keys, sums = [], []
    for bit in range(8):
        top = _subtrees(codes, counts, bit)[0]
        keys.append((top.keys >> 16 << 8) | (top.keys & 0xFF))
        sums.append((top.weighted, top.zeros, top.ones))
    if not len(codes):
        return (np.zeros(0, np.int64), np.zeros(0)) + (np.zeros(0, np.int64),) * 2
    key, of = np.unique(np.concatenate(keys), return_inverse=True)
    total = [np.bincount(of, np.concatenate(x), len(key)) for x in zip(*sums)]
    return key, total[0], total[1].astype(np.int64), total[2].astype(np.int64)


class Top:
    """Depths 0 and 1: counts and stop weights, as dense arrays (256 contexts x 256 nodes)."""

    def __init__(self, key: np.ndarray, weighted: np.ndarray, zeros: np.ndarray, ones: np.ndarray):
        below = np.zeros(1 << 16)
        n0, n1 = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        below[key], n0[key], n1[key] = weighted, zeros, ones
        kt = log_kt(n0, n1)
        own = np.where(n0 + n1 > 0, np.logaddexp(kt, below) - _LN2, 0.0)
        self.n = [(n0.reshape(256, 256).sum(0), n1.reshape(256, 256).sum(0)), (n0, n1)]
        self.stop = [_stop(log_kt(*self.n[0]), own.reshape(256, 256).sum(0)), _stop(kt, below)]


def price(codes: np.ndarray, counts: np.ndarray, top: Top) -> np.ndarray:
    """log10 probability of the byte of each gram in its context (distinct grams, whole subtrees)."""
    total = np.zeros(len(codes))
    sym, near = codes & 0xFF, codes >> (8 * DEPTH)
    for bit in range(8):
        one = ((sym >> (7 - bit)) & 1).astype(bool)
        node = (1 << bit) | (sym >> (8 - bit))
        steps = [(*(x[at] for x in top.n[d]), top.stop[d][at]) for d, at in enumerate((node, near << 8 | node))]
        steps += [(x.zeros[x.of], x.ones[x.of], x.stop[x.of]) for x in _subtrees(codes, counts, bit)]
        p, left, last = np.zeros(len(codes)), np.ones(len(codes)), np.full(len(codes), 0.5)
        for zeros, ones, stop in steps:
            seen = zeros + ones > 0
            own = (np.where(one, ones, zeros) + 0.5) / (zeros + ones + 1.0)
            p += left * np.where(seen, stop * own, last)
            left = np.where(seen, left * (1 - stop), 0.0)
            last = np.where(seen, own, last)
        total += np.log10(p + left * last)
    return total


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The grams of documents' lower-cased bytes, document by document: one for each byte and one for the end mark."""
    n = len(offsets) - 1
    spread = np.full(int(offsets[-1]) + (DEPTH + 1) * n, PAD, np.uint8)
    # document k: DEPTH pads, its bytes, the end mark
    shift = np.repeat(np.arange(n) * (DEPTH + 1) + DEPTH, np.diff(offsets))
    spread[np.arange(int(offsets[-1])) + shift] = np.minimum(data[:offsets[-1]], PAD - 1)
    spread[offsets[1:] + np.arange(1, n + 1) * (DEPTH + 1) - 1] = END
    code = spread[DEPTH:].astype(np.int64)
    for k in range(1, DEPTH + 1):
        code |= spread[DEPTH - k:len(spread) - k].astype(np.int64) << (8 * (DEPTH + 1 - k))
    return code[spread[DEPTH:] != PAD]


def _documents(column: pa.Array, most: int = 1 << 21):
    """(first row, last row, grams, end places, word hashes, document of each word) of ranges of rows."""
    data, offsets = text_bytes(column)
    for i, j in slices(offsets, most):
        part, at = lowered(data[offsets[i]:offsets[j]]), offsets[i:j + 1] - offsets[i]
        starts, ends, doc = word_bounds(part, at)
        yield i, j, grams(part, at), at[1:] + np.arange(1, j - i + 1), span_hashes(part, starts, ends).view(np.int64), doc


def _tally(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(keys) == 1:
        return keys[0], counts[0]
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")               # merges runs that are sorted already
    key, count = key[order], count[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[first], np.add.reduceat(count, first) if len(first) else count


class _Sums:
    """Distinct keys and their counts in training rows, added slice by slice."""

    def __init__(self):
        self.keys, self.counts, self.rows = [], [], 0

    def add(self, keys: np.ndarray, trained: np.ndarray) -> None:
        for part, count in ((keys[trained], True), (keys[~trained], False)):
            if len(part):
                key, n = np.unique(part, return_counts=True)
                self.keys.append(key)
                self.counts.append(n.astype(np.int64) if count else np.zeros(len(key), np.int64))
                self.rows += len(key)
        if self.rows > 4_000_000:
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        key, count = _tally(self.keys, self.counts)
        self.keys, self.counts, self.rows = [key], [count], len(key) // 2
        return key, count


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def _unpacked(raw: bytes, n: int, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(raw, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind) if n else np.zeros(0, kind)


def _part_of(kind: int, key: np.ndarray, parts: int) -> np.ndarray:
    """The part that answers for a key: subtrees of two context bytes stay together, words go by their hash."""
    root = key >> (8 * (DEPTH - 1)) if kind == 0 else key
    return (mix64(root.view(np.uint64)) % np.uint64(parts)).astype(np.int64)


def _dealt(kind: int, key: np.ndarray, parts: int):
    """(part, places of its keys in order) for every part that has some."""
    part = _part_of(kind, key, parts)
    order = np.argsort(part, kind="stable")
    cut = np.append(np.flatnonzero(np.append(True, np.diff(part[order]) != 0)), len(order)) if len(order) else [0]
    for s, e in zip(cut[:-1], cut[1:]):
        yield int(part[order[s]]), order[s:e]


# ---------------------------------------------------------------------------------------------- Spark steps


def with_chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, id, text, train): chunks by the input file and the id's hash, the same whenever they are computed."""
    src = docs.withColumn("file", F.input_file_name())
    sums = src.groupBy("file").agg(F.sum(F.octet_length("text")).alias("b")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("b").alias("b")).collect()[0]
    parts = max(1, -(-(sums["b"] or 0) // (chunk_bytes * max(1, sums["files"]))))
    return src.select(F.xxhash64("file", F.pmod(F.xxhash64("id", "text"), F.lit(parts))).alias("chunk"), "id", "text", "train")


_ASKED = pa.schema([("kind", pa.int8()), ("part", pa.int32()), ("chunk", pa.int64()), ("n", pa.int32()),
                    ("keys", pa.binary()), ("counts", pa.binary())])


def _asked(docs: DataFrame, parts: int) -> DataFrame:
    """(kind, part, chunk, n, keys, counts): the grams (kind 0) and words (kind 1) of every chunk and how often its training
    rows hold them, keys in order; a file that is read in several splits gives several rows a chunk and part."""
    def run(batches: Iterator[pa.RecordBatch]):
        sums: dict[int, tuple[_Sums, _Sums]] = {}
        for b in batches:
            chunk = b.column(0).to_numpy()
            order = np.argsort(chunk, kind="stable")
            cut = np.append(np.flatnonzero(np.append(True, np.diff(chunk[order]) != 0)), len(order)) if len(order) else [0]
            for s, e in zip(cut[:-1], cut[1:]):
                rows = order[s:e]
                part = b.take(pa.array(rows)) if len(cut) > 2 else b
                train = part.column(2).to_numpy(zero_copy_only=False)
                own = sums.setdefault(int(chunk[rows[0]]), (_Sums(), _Sums()))
                for i, j, codes, ends, words, doc in _documents(part.column(1)):
                    own[0].add(codes, np.repeat(train[i:j], np.diff(np.append(0, ends))))
                    own[1].add(words, train[i:j][doc])
        for chunk, pair in sums.items():
            for kind, s in enumerate(pair):
                key, n = s.total()
                rows = [(kind, p, chunk, len(at), _packed(np.diff(key[at], prepend=0)), _packed(n[at]))
                        for p, at in _dealt(kind, key, parts)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ASKED)], schema=_ASKED)
        sums.clear()
        release_memory()
    return docs.select("chunk", "text", "train").mapInArrow(
        run, "kind tinyint, part int, chunk bigint, n int, keys binary, counts binary")


def _part_keys(t: pa.Table) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    """(distinct keys, their counts, chunk -> the keys it asked for) of a part; all keys in order."""
    keys, counts, asked = [], [], {}
    for chunk, n, k, c in zip(*(t[x].to_pylist() for x in ("chunk", "n", "keys", "counts"))):
        keys.append(np.cumsum(_unpacked(k, n, np.int64)))
        counts.append(_unpacked(c, n, np.int64))
        asked.setdefault(chunk, []).append(keys[-1])
    key, count = _tally(keys, counts)
    return key, count, {c: x[0] if len(x) == 1 else np.unique(np.concatenate(x)) for c, x in asked.items()}


_SUMS = pa.schema([("key", pa.int64()), ("w", pa.float64()), ("n0", pa.int64()), ("n1", pa.int64())])


def _depth_two_rows(asked: DataFrame) -> DataFrame:
    def run(t: pa.Table) -> pa.Table:
        key, count, _ = _part_keys(t)
        return pa.table([pa.array(x, f.type) for x, f in zip(depth_two(key, count), _SUMS)], schema=_SUMS)
    return (asked.filter("kind = 0").groupBy("part").applyInArrow(run, "key bigint, w double, n0 bigint, n1 bigint")
            .groupBy("key").agg(F.sum("w").alias("w"), F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))


_ANSWERS = pa.schema([("chunk", pa.int64()), ("kind", pa.int8()), ("part", pa.int32()), ("n", pa.int32()),
                      ("values", pa.binary()), ("distinct", pa.int64()), ("total", pa.int64())])
_ANSWERS_DDL = "chunk bigint, kind tinyint, part int, n int, values binary, distinct bigint, total bigint"


def _answer_rows(kind: int, part: int, key, values, asked, distinct: int = 0, total: int = 0) -> pa.Table:
    rows = [(chunk, kind, part, len(k), _packed(values[np.searchsorted(key, k)]), 0, 0) for chunk, k in asked.items()]
    rows.append((0, 2, part, 0, b"", distinct, total))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), _ANSWERS)], schema=_ANSWERS)


def _priced(asked: DataFrame, top: Top) -> DataFrame:
    """The log10 probabilities of the grams that each chunk asked a part for, in the order of its keys."""
    def run(t: pa.Table) -> pa.Table:
        key, count, of = _part_keys(t)
        return _answer_rows(0, t["part"][0].as_py(), key, price(key, count, top), of)
    return asked.filter("kind = 0").groupBy("part").applyInArrow(run, _ANSWERS_DDL).filter("kind = 0")


def _word_totals(asked: DataFrame) -> DataFrame:
    """How often training rows hold the words that each chunk asked a part for, in the order of its keys; a row of kind 2
    a part has its distinct and all words of training rows."""
    def run(t: pa.Table) -> pa.Table:
        key, count, of = _part_keys(t)
        return _answer_rows(1, t["part"][0].as_py(), key, count, of, int((count > 0).sum()), int(count.sum()))
    return asked.filter("kind = 1").groupBy("part").applyInArrow(run, _ANSWERS_DDL)


_OUT = "id {}, n_tokens bigint, n_known bigint, base_score double, score double, n_bytes bigint"


def _scored(docs: DataFrame, answers: DataFrame, parts: int, total: int, distinct: int, trained: int) -> DataFrame:
    """Texts meet the answers to their chunk; one chunk is one group of a bounded number of bytes."""
    kind_of_id = dict(docs.dtypes)["id"]

    def answered(kind: int, key: np.ndarray, rows: dict, dtype) -> np.ndarray:
        """The values of the chunk's distinct keys (in order)."""
        value = np.zeros(len(key), dtype)
        for part, at in _dealt(kind, key, parts):
            n, raw = rows[kind, part]
            if n != len(at):
                raise ValueError("a chunk isn't what it was when it asked; the input has changed")
            value[at] = _unpacked(raw, n, dtype)
        return value

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["id", "n_tokens", "n_known", "base_score", "score", "n_bytes"]
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]
        if not left.num_rows:
            return pa.table([left["id"], *(pa.array([], k) for k in kinds)], names=names)
        text = left["text"].combine_chunks()
        rows = {(k, p): (n, v) for k, p, n, v in zip(*(right[c].to_pylist() for c in ("kind", "part", "n", "values")))}
        # once over the texts for the keys, as when the chunk asked, and once more to score: nothing per byte is held
        sums = _Sums(), _Sums()
        for i, j, codes, _, words, _ in _documents(text, 1 << 20):
            for s, keys in zip(sums, (codes, words)):
                s.add(keys, np.zeros(len(keys), bool))
        gram, word = (s.total()[0] for s in sums)
        cost, count = answered(0, gram, rows, np.float64), answered(1, word, rows, np.int64)
        del rows, sums
        base = -math.log10(total + distinct + 1)
        out = [[] for _ in range(5)]
        for i, j, codes, ends, words, doc in _documents(text, 1 << 20):
            of, codes = pd.factorize(codes)
            score = np.add.reduceat(cost[np.searchsorted(gram, codes)][of], np.append(0, ends[:-1]))
            of, words = pd.factorize(words)
            c = count[np.searchsorted(word, words)][of] if len(words) else np.zeros(0, np.int64)
            n = np.bincount(doc, minlength=j - i)
            known = np.bincount(doc[c > 0], minlength=j - i) + (trained > 0)
            points = np.bincount(doc, np.log10(c + 1.0), j - i) + math.log10(trained + 1) + (n + 1) * base
            for o, x in zip(out, (n + 1, known, points, score, np.diff(np.append(0, ends)) - 1)):
                o.append(x)
        release_memory()
        return pa.table([left["id"], *(pa.array(np.concatenate(o)) for o in out)], names=names)

    return (docs.select("chunk", "id", "text").groupBy("chunk").cogroup(answers.groupBy("chunk"))
            .applyInArrow(run, _OUT.format(kind_of_id)))


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
                chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte) of every row.

    ``train``: the rows to learn from (null: not).  ``score`` is log10 of the model's probability of the text and its end,
    ``bits_per_byte`` the code length over its bytes and the end mark.  Null and empty texts are the end mark alone.
    Without training rows every bit costs one bit and the base score is that of nothing known.  Rows are scored one by
    one, so equal rows get equal scores; null ids are kept; other columns are not read.  Words are told apart by a 64-bit
    hash.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                      F.coalesce(train, F.lit(False)).alias("train"))
    chunks = with_chunks(src, chunk_bytes)
    path = scratch_path(spark, "ctw-asked")
    _asked(chunks, parts).write.parquet(path)
    asked = spark.read.parquet(path)
    path = scratch_path(spark, "ctw-words")
    _word_totals(asked).write.parquet(path)
    words = spark.read.parquet(path)
    sums = words.filter("kind = 2").agg(F.sum("distinct").alias("d"), F.sum("total").alias("t")).collect()[0]
    trained = src.agg(F.sum(F.col("train").cast("bigint")).alias("t")).collect()[0]["t"] or 0
    total, distinct = (sums["t"] or 0) + trained, (sums["d"] or 0) + (trained > 0)
    # at most 256 * 255 rows: the nodes of depth 1
    rows = _depth_two_rows(asked).toPandas()
    top = Top(rows["key"].to_numpy(np.int64), rows["w"].to_numpy(float), rows["n0"].to_numpy(np.int64),
              rows["n1"].to_numpy(np.int64))
    answers = _priced(asked, top).union(words.filter("kind = 1"))
    out = _scored(chunks, answers, parts, total, distinct, trained)
    bits = -F.col("score") * math.log2(10) / (F.col("n_bytes") + 1)
    return out.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"),
                      "base_score", "score", "n_bytes", bits.alias("bits_per_byte"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


@register("op7_ctw_score")
def op7_ctw_score(spark, sf_dir):
    out = score_texts(table(spark, sf_dir, "documents"), ~held_out(F.col("doc_id")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score", "n_bytes", "bits_per_byte")
