"""Token-ID output: documents to files of Simple-8b blocks, in ascending document order, and back.

``write_tokens`` encodes with the tokenizers library, appends an end id to each document and writes a folder of Parquet
files through Spark's own committer (so a lost executor's half-written file is never seen).  One row is one block:

    part, seq      place of the block: range partition of the ids, and its number there
    part_start     ids of the same part before the block
    n_ids          ids in the block
    doc_ids        the documents of the block, in order (array<long>, nulls kept)
    lengths        ids of each (uint32, little-endian)
    offsets        word offset of every group of 512 ids (uint32, little-endian)
    words          the Simple-8b words (uint64, little-endian)

A block holds whole documents and is closed at ``block_ids`` ids.  ``read_tokens`` decodes blocks independently.

White space never joins tokens in the vocabularies this is used with, so texts are cut at ASCII white space and each
distinct word goes to the library once per worker while its table has room.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm import simple8b
from ledgerlens.llm.arrays import lowered, release_memory, slices, span_hashes, text_bytes, word_bounds
from ledgerlens.llm.registry import register, table
from ledgerlens.llm.token_count import _model_path
from ledgerlens.session import scratch_path

MAX_CACHED = 500_000                 # words whose ids a worker keeps (some 40 bytes each)
_LETTERS = re.compile("[a-z\xdf-\xf6\xf8-\xff]+")
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_ENCODERS: dict[str, WordEncoder] = {}


class WordEncoder:
    """Whole texts to ids through a table of words.

    The vocabularies this is used with lower-case, drop white space and never join letters with other characters, so
    the ids of a text are those of its words, one after the other.  Texts are cut at ASCII white space, and before ASCII
    punctuation between a letter and white space; A-Z are lower-cased in words of ASCII and Latin-1 characters (in others
    a combining mark could tell the cases apart).  Distinct words go to the library once while the table has room;
    words of letters alone skip its normaliser and splitting rules, which would leave them as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.comma = self.plain.encode(",", add_special_tokens=False).ids
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if len(self.comma) != 1 or not all(t.startswith("<|") for t in special):
            raise ValueError("words can't be set apart with this vocabulary")
        self.clear()

    def clear(self) -> None:
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _library(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, how many each has)."""
        simple = np.array([_LETTERS.fullmatch(w) is not None for w in words], bool)
        size = np.zeros(len(words), np.int64)
        mine = np.flatnonzero(simple)
        parts = []
        # letters never give the comma's id: it marks the ends of words in one long string
        for k in range(0, len(mine), 1000):
            text = " , ".join([words[i] for i in mine[k:k + 1000]]) + " ,"
            parts.append(np.array(self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32))
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        ends = np.flatnonzero(ids == self.comma[0])
        size[mine] = np.diff(np.append(-1, ends)) - 1
        simple_ids = ids[ids != self.comma[0]]
        other = np.flatnonzero(~simple)
        found = [e.ids for k in range(0, len(other), 1000) for e in self.tokenizer.encode_batch_fast(
            [words[i] for i in other[k:k + 1000]], add_special_tokens=False)]
        size[other] = [len(x) for x in found]
        at = np.cumsum(size) - size
        flat = np.zeros(int(size.sum()), np.uint32)
        for where, values in ((mine, simple_ids), (other, np.array([i for x in found for i in x], np.uint32))):
            flat[_spread(at[where], size[where])] = values
        return flat, size

    def _words(self, raw: np.ndarray, offsets: np.ndarray):
        """(bytes, start, end, document) of the words."""
        starts, ends, doc = word_bounds(raw, offsets)
        low = lowered(raw)
        if len(starts):
            # the punctuation at a word's end is a word of its own if a letter stands before it
            last = np.maximum.accumulate(np.where(_PUNCTUATION[low], -1, np.arange(len(low))))[ends - 1]
            letter = (low[np.maximum(last, 0)] >= 97) & (low[np.maximum(last, 0)] <= 122)
            special = np.flatnonzero((raw[:-1] == 0x3C) & (raw[1:] == 0x7C))     # may be special tokens: as they are
            whole = np.zeros(len(starts), bool)
            whole[np.searchsorted(starts, special, "right") - 1] = True
            cut = np.flatnonzero((last >= starts) & (last < ends - 1) & letter & ~whole)
            if len(cut):
                starts, ends, doc = (np.concatenate([starts, last[cut] + 1]), np.concatenate([ends, ends[cut]]),
                                     np.concatenate([doc, doc[cut]]))
                ends[cut] = last[cut] + 1
                order = np.argsort(starts, kind="stable")
                starts, ends, doc = starts[order], ends[order], doc[order]
            keep = np.append(0, np.cumsum(raw >= 0xC4))
            case = keep[ends] > keep[starts]             # words whose capitals stay
            case[np.searchsorted(starts, special, "right") - 1] = True
            if case.any():
                at = _spread(starts[case], (ends - starts)[case])
                low[at] = raw[at]
        return low, starts, ends, doc

    def ids(self, raw: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of the documents: without special tokens of the library's own adding, then ``end_id``."""
        low, starts, ends, doc = self._words(raw, offsets)
        key, first, of = np.unique(span_hashes(low, starts, ends), return_index=True, return_inverse=True)
        new = np.flatnonzero(~np.isin(key, self.keys, assume_unique=True))
        if len(self.keys) + len(new) > MAX_CACHED:
            self.clear()
            new = np.arange(len(key))
        if len(new):
            text = low.tobytes()
            flat, size = self._library([text[s:e].decode("utf-8", "replace") for s, e in
                                        zip(starts[first[new]].tolist(), ends[first[new]].tolist())])
            at = np.cumsum(size) - size + len(self.flat)
            keys = np.concatenate([self.keys, key[new]])
            order = np.argsort(keys, kind="stable")
            self.keys, self.at, self.size = keys[order], np.append(self.at, at)[order], np.append(self.size, size)[order]
            self.flat = np.append(self.flat, flat)
        where = np.searchsorted(self.keys, key)
        size, at = self.size[where][of], self.at[where][of]
        n = len(offsets) - 1
        bounds = np.append(0, np.cumsum(np.bincount(doc, size, n).astype(np.int64) + 1))
        out = np.full(int(bounds[-1]), end_id, np.uint32)
        # a word's ids stand behind those of the words before it and the end ids of the documents before its own
        out[_spread(np.cumsum(size) - size + doc, size)] = self.flat[_spread(at, size)]
        return out, bounds


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ..."""
    total = np.cumsum(size)
    return np.arange(int(total[-1]) if len(total) else 0) + np.repeat(start - (total - size), size)


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


_BLOCK = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("part_start", pa.int64()), ("n_ids", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.binary()), ("offsets", pa.binary()),
                    ("words", pa.binary())])
_BLOCK_DDL = ("part int, seq bigint, part_start bigint, n_ids bigint, doc_ids array<bigint>, lengths binary, "
              "offsets binary, words binary")


def write_tokens(df: DataFrame, path: str, model: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 block_ids: int = 1 << 18) -> None:
    """Write the tokens of ``df`` to the folder ``path``.

    A null text counts as empty: its document has the end id alone.  Null ids come first; rows with equal ids stand in
    order of their texts' hash, so a repeated id can be dealt over several partitions.
    """
    src = df.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    src = src.withColumn("tie", F.xxhash64("text"))
    ordered = src.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text").drop("tie")

    def run(batches: Iterator[pa.RecordBatch]):
        enc, part = encoder(_model_path(model)), TaskContext.get().partitionId()
        docs, ids, held, seq, start = [], [], 0, 0, 0

        def block():
            nonlocal docs, ids, held, seq, start
            flat = np.concatenate(ids)
            words, offsets = simple8b.encode(flat)
            row = [part, seq, start, held, docs, np.array([len(x) for x in ids], "<u4").tobytes(),
                   offsets.astype("<u4").tobytes(), words.astype("<u8").tobytes()]
            docs, ids, seq, start, held = [], [], seq + 1, start + held, 0
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCK)], schema=_BLOCK)

        for b in batches:
            data, offsets = text_bytes(b.column(1))
            for i, j in slices(offsets, 1 << 21):
                flat, bounds = enc.ids(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], end_id)
                for doc, s, e in zip(b.column(0).slice(i, j - i).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    docs.append(doc)
                    ids.append(flat[s:e])
                    held += e - s
                    if held >= block_ids:
                        yield block()
        if docs:
            yield block()
        release_memory()

    ordered.mapInArrow(run, _BLOCK_DDL).write.parquet(path)


def _decoded(b: pa.RecordBatch):
    """(row, doc_ids, lengths, ids) of each block of a batch."""
    col = {n: b.column(k) for k, n in enumerate(b.schema.names)}
    for i in range(b.num_rows):
        lengths = np.frombuffer(col["lengths"][i].as_py(), "<u4").astype(np.int64)
        offsets = np.frombuffer(col["offsets"][i].as_py(), "<u4").astype(np.int64)
        words = np.frombuffer(col["words"][i].as_py(), "<u8")
        yield i, col, lengths, simple8b.decode(words, int(lengths.sum()), offsets)


def part_starts(blocks: DataFrame) -> DataFrame:
    """(part, base): ids in all parts before; one row per file of the store."""
    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(part, at, doc_id, ids array<bigint>) of every document of the store; ``at`` is its first place in the part."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for i, col, lengths, ids in _decoded(b):
                at = np.append(0, np.cumsum(lengths))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(lengths), col["part"][i].as_py(), np.int32)),
                     pa.array(at[:-1] + col["part_start"][i].as_py()), col["doc_ids"][i].values,
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int64)))],
                    names=["part", "at", "doc_id", "ids"])
    return spark.read.parquet(path).mapInArrow(run, "part int, at bigint, doc_id bigint, ids array<bigint>")


def digest_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the store's blocks.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is the CRC-32 of the ids as little-endian
    unsigned 32-bit integers.  The sums of the parts (a row per file) are joined to the documents.
    """
    blocks = spark.read.parquet(path)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for i, col, lengths, ids in _decoded(b):
                raw, at = memoryview(ids.astype("<u4").tobytes()), np.append(0, np.cumsum(lengths))
                crc = [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(lengths), col["part"][i].as_py(), np.int32)),
                     pa.array(at[:-1] + col["part_start"][i].as_py()), pa.array(col["doc_ids"][i].as_py(), pa.int64()),
                     pa.array(lengths), pa.array(crc, pa.int64())], names=["part", "at", "doc_id", "n_tokens", "crc"])

    rows = blocks.mapInArrow(run, "part int, at bigint, doc_id bigint, n_tokens bigint, crc bigint")
    return (rows.join(part_starts(blocks), "part")
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", F.col("crc").alias("ids_crc32")))


def store_and_digest(df: DataFrame, model: str = "word_bpe_49k.json", end_id: int = 2) -> DataFrame:
    path = scratch_path(df.sparkSession, "tokens")
    write_tokens(df, path, model, end_id)
    return digest_tokens(df.sparkSession, path)


@register("op8_simple8b_tokens")
def op8_simple8b_tokens(spark, sf_dir):
    return store_and_digest(table(spark, sf_dir, "documents"))
