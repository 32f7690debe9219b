"""Substring dedup: words in any window of ``window`` consecutive words whose sequence also starts somewhere else.

A difference cover D modulo v has, for every shift, two members that far apart.  Sequences of ``anchor_words`` words are
hashed only where their place in the document modulo v is in D.  Two equal windows of anchor_words + v - 1 words at
places p and q share an anchor at one offset below v, whatever p and q are: some offset brings both into the cover.  So
only windows that hold an anchor seen elsewhere can repeat; those are extended to the full length and compared by 96
bits.  For 35 words: v is 13, D has 4 members, an anchor is 23 words.

Documents are dealt to chunks by their place in the input files, a function of file and row, so every pass and retry
forms the same chunks.  A chunk asks by part of the hash space and sends each distinct hash once, however often it holds
it, so a passage in a third of all documents costs a part one entry a chunk.  Answers return to the chunk:

    anchors -> (hashes seen elsewhere) -> windows around them -> (which repeat) -> words removed

The texts are shuffled to their chunks; both later passes read that one shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.arrays import U64, mix64, release_memory, slices, span_hashes, text_bytes, word_bounds
from ledgerlens.llm.registry import register, table
from ledgerlens.session import scratch_path

#: perfect difference sets: fixed values, period -> cover
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
_A, _B = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)


def cover_for(window: int) -> tuple[int, tuple[int, ...], int]:
    """(period, cover, words of an anchor) for windows of that many words: the longest period of at most half of them."""
    period = max(p for p in COVERS if p <= max(1, (window + 1) // 2))
    return period, COVERS[period], window - period + 1


def run_hashes(words: np.ndarray, n: int, mult=_A) -> np.ndarray:
    """A hash of the ``n`` words from each place on (fewer places than words): runs double, the last two overlap."""
    if len(words) < n:
        return np.zeros(0, U64)
    h, size = words, 1
    while 2 * size <= n:
        h = mix64((h[:-size] * mult) ^ h[size:])
        size *= 2
    rest = n - size
    return mix64((h[:len(h) - rest] * _B) ^ (h[rest:] + U64(n))) if rest else h


class Slice:
    """Words of some documents, and where windows and anchors of them start."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int):
        self.data, self.window = data, window
        self.starts, self.ends, doc = word_bounds(data, offsets)
        self.doc = doc
        self.words = span_hashes(data, self.starts, self.ends)
        self.sizes = np.bincount(doc, minlength=len(offsets) - 1)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.period, cover, self.anchor_words = cover_for(window)
        self.in_cover = np.zeros(self.period, bool)
        self.in_cover[list(cover)] = True

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(place, hash) of the anchors of documents that have a window."""
        h = run_hashes(self.words, self.anchor_words)
        doc = self.doc[:len(h)]
        place = np.arange(len(h)) - self.first[doc]
        at = np.flatnonzero(self.in_cover[place % self.period] & (place + self.anchor_words <= self.sizes[doc])
                            & (self.sizes[doc] >= self.window))
        return at, h[at]

    def windows(self, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, hash, second hash) of the windows that hold an anchor at one of ``hits``."""
        n = len(self.words) - self.window + 1
        if n <= 0 or not len(hits):
            return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, U64)
        edge = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(edge, np.maximum(hits - self.period + 1, 0), 1)
        np.add.at(edge, hits + 1, -1)
        near = np.cumsum(edge)[:n] > 0
        whole = self.doc[:n] == self.doc[self.window - 1:]
        at = np.flatnonzero(near & whole)
        return at, run_hashes(self.words, self.window)[at], run_hashes(self.words, self.window, _B)[at] >> U64(32)

    def covered(self, repeated: np.ndarray) -> np.ndarray:
        """Whether each word lies in one of the windows that start at ``repeated``."""
        edge = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(edge, repeated, 1)
        np.add.at(edge, repeated + self.window, -1)
        return np.cumsum(edge)[:-1] > 0

    def kept(self, gone: np.ndarray) -> list[str]:
        """The words that stay of every document, joined by one space."""
        take = np.flatnonzero(~gone)
        size = self.ends[take] - self.starts[take] + 1
        doc = self.doc[take]
        out = np.full(int(size.sum()), 0x20, np.uint8)
        place = np.cumsum(size) - size
        inside = np.arange(len(out)) - np.repeat(place, size)
        letter = inside < np.repeat(size - 1, size)
        out[letter] = self.data[(np.repeat(self.starts[take], size) + inside)[letter]]
        bounds = np.append(0, np.cumsum(np.bincount(doc, size, len(self.sizes)).astype(np.int64)))
        raw = out.tobytes()
        return [raw[s:max(s, e - 1)].decode("utf-8", "replace") for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _slices(texts: pa.Array, window: int, most: int = 1 << 22):
    """(first row, last row, Slice) over all rows of a text column."""
    data, offsets = text_bytes(texts)
    for i, j in slices(offsets, most):
        yield i, j, Slice(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], window)


def distinct(first: np.ndarray, second: np.ndarray | None = None):
    """(places of the distinct values in order, which occurrence has which, how many each has)."""
    order = np.argsort(first, kind="stable") if second is None else np.lexsort((second, first))
    new = np.ones(len(order), bool)
    if len(order):
        f = first[order]
        new[1:] = f[1:] != f[:-1]
        if second is not None:
            s = second[order]
            new[1:] |= s[1:] != s[:-1]
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    return order[new], of, np.diff(np.append(np.flatnonzero(new), len(order)))


def _joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


_ASKS = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("n", pa.int32()), ("first", pa.binary()),
                   ("second", pa.binary()), ("many", pa.binary())])
_ASKS_DDL = "part int, chunk bigint, n int, first binary, second binary, many binary"


def _ask(chunk: int, first: np.ndarray, second: np.ndarray | None, parts: int) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """(a row for each part that is asked, the occurrences' places in the order asked, that order)."""
    at, of, count = distinct(first, second)
    part = (first[at] % U64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    cut = np.append(np.flatnonzero(np.diff(part[order], prepend=-1)), len(order))
    rows = []
    for s, e in zip(cut[:-1].tolist(), cut[1:].tolist()):
        mine = at[order[s:e]]
        rows.append((int(part[order[s]]), chunk, e - s, first[mine].tobytes(),
                     b"" if second is None else second[mine].astype("<u4").tobytes(),
                     np.packbits(count[order[s:e]] > 1).tobytes()))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return rows, place[of], part[order]


def _ask_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ASKS)], schema=_ASKS)


_ANSWERS = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("kind", pa.int8()), ("n", pa.int32()),
                      ("values", pa.binary())])
_ANSWERS_DDL = "chunk bigint, part int, kind tinyint, n int, values binary"


def _answer(asks: DataFrame, kind: int) -> DataFrame:
    """What a part says to each chunk: hashes that stand more than once (kind 0), or a bit for each hash asked (kind 1)."""
    def run(t: pa.Table) -> pa.Table:
        n = t["n"].to_numpy()
        first = _joined([np.frombuffer(x, "<u8") for x in t["first"].to_pylist()], U64)
        second = None if kind == 0 else _joined([np.frombuffer(x, "<u4") for x in t["second"].to_pylist()], np.uint32)
        many = _joined([np.unpackbits(np.frombuffer(x, np.uint8), count=int(k)) for x, k in zip(t["many"].to_pylist(), n)], np.uint8)
        _, of, count = distinct(first, second)
        seen = (np.bincount(of, many, len(count)) + count > 1)[of] if len(of) else np.zeros(0, bool)
        ends = np.cumsum(n)
        rows = []
        for chunk, part, s, e in zip(t["chunk"].to_pylist(), t["part"].to_pylist(), (ends - n).tolist(), ends.tolist()):
            if kind == 0:
                hit = first[s:e][seen[s:e]]
                if len(hit):
                    rows.append((chunk, part, 0, len(hit), hit.tobytes()))
            else:
                rows.append((chunk, part, 1, e - s, np.packbits(seen[s:e]).tobytes()))
        release_memory()
        return pa.table([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_ANSWERS)], schema=_ANSWERS)
    return asks.groupBy("part").applyInArrow(run, _ANSWERS_DDL)


def _chunked(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int, part_bytes: int) -> tuple[DataFrame, int]:
    """(chunk, id, text) and the number of parts.  Rows that don't come straight from files are written first."""
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    try:
        src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"),
                          F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
                          F.col("_metadata.row_index").alias("row"))
    except AnalysisException:
        path = scratch_path(spark, "texts")
        plain.write.parquet(path)
        src = spark.read.parquet(path).select("id", "text", F.col("_metadata.file_path").alias("file"), F.col(
            "_metadata.file_size").alias("size"), F.col("_metadata.row_index").alias("row"))
    # bytes of text for a byte of file, of the file that has most: chunks of any file are bounded by it
    files = src.groupBy("file").agg(F.sum(F.octet_length("text")).alias("bytes"), F.max("size").alias("size"))
    sums = files.agg(F.max(F.col("bytes") / F.col("size")).alias("ratio"), F.sum("bytes").alias("bytes")).collect()[0]
    chunks = F.greatest(F.lit(1), F.ceil(F.col("size") * F.lit(float(sums["ratio"] or 0) / chunk_bytes)))
    chunk = F.xxhash64("file", F.pmod(F.xxhash64("row"), chunks))
    return src.select(chunk.alias("chunk"), "id", "text"), max(1, -(-int(sums["bytes"] or 0) // part_bytes))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35,
                   chunk_bytes: int = 8 << 20, part_bytes: int = 16 << 20) -> DataFrame:
    """(id, n_words, n_removed, kept, spans) of every document; ``kept`` is what stays, its words joined by one space.

    Words are cut at ASCII white space and compared as they are.  A word goes if it lies in a window of ``window`` words
    whose sequence starts at another place, too, in any document or the same one; windows are judged on the input.
    ``spans`` are the runs of words removed, [first, last + 1).  Null and empty texts have no words and keep the empty
    text; a document shorter than a window loses nothing; texts of any length are compared whole.  Rows that repeat an
    id are documents of their own, equal ones remove each other; null ids stay null.  Other columns are ignored and an
    empty table gives an empty result.

    ``chunk_bytes`` of text (or one longer document) and the hashes of ``part_bytes`` of text are held by a task; on a
    large corpus raise both with the memory of a task, as chunks x parts bounds the number of rows that are sent.
    """
    src, parts = _chunked(docs, id_col, text_col, chunk_bytes, part_bytes)

    def anchors(batches: Iterator[pa.RecordBatch]):
        held: dict[int, list[np.ndarray]] = {}
        for b in batches:
            owner = b.column(0).to_numpy()
            for i, j, part in _slices(b.column(1), window):
                at, h = part.anchors()
                chunk = owner[i:j][part.doc[at]]
                at, of, _ = distinct(chunk.astype(np.int64))
                order = np.argsort(of, kind="stable")
                for c, mine in zip(chunk[at].tolist(), np.split(h[order], np.cumsum(np.bincount(of))[:-1] if len(of) else [])):
                    held.setdefault(c, []).append(mine)
        for c in sorted(held):
            rows, _, _ = _ask(c, np.concatenate(held.pop(c)), None, parts)
            if rows:
                yield _ask_batch(rows)
        release_memory()

    seen = _answer(src.select("chunk", "text").mapInArrow(anchors, _ASKS_DDL), 0)

    def candidates(texts: pa.Array, answers: pa.Table):
        """(first row, last row, Slice, places, hash, second hash) of the windows around anchors seen elsewhere."""
        kind = answers["kind"].to_numpy()
        known = np.sort(_joined([np.frombuffer(x, "<u8") for x, k in zip(answers["values"].to_pylist(), kind) if k == 0], U64))
        for i, j, part in _slices(texts, window):
            at, h = part.anchors()
            if len(known):
                spot = np.minimum(np.searchsorted(known, h), len(known) - 1)
                at = at[known[spot] == h]
            else:
                at = at[:0]
            yield i, j, part, *part.windows(at)

    def text_of(t: pa.Table) -> pa.Array:
        column = t["text"].combine_chunks()
        return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column

    def asked(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found = [x[4:] for x in candidates(text_of(left), right)] if left.num_rows else []
        rows, _, _ = _ask(key[0].as_py(), _joined([x[0] for x in found], U64), _joined([x[1] for x in found], U64), parts)
        release_memory()
        return pa.Table.from_batches([_ask_batch(rows)] if rows else [], schema=_ASKS)

    def cleaned(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found = list(candidates(text_of(left), right)) if left.num_rows else []
        _, place, part = _ask(key[0].as_py(), _joined([x[4] for x in found], U64), _joined([x[5] for x in found], U64), parts)
        bits = [(p, np.unpackbits(np.frombuffer(v, np.uint8), count=n)) for p, k, n, v in zip(
            *(right[c].to_pylist() for c in ("part", "kind", "n", "values"))) if k == 1]
        said = _joined([b for _, b in sorted(bits, key=lambda x: x[0])], np.uint8)
        if len(said) != len(part):
            raise RuntimeError(f"chunk {key[0]}: {len(part)} windows asked, {len(said)} answered")
        hit = said[place].astype(bool) if len(place) else np.zeros(0, bool)
        n_words, n_removed, kept, spans, used = [], [], [], [], 0
        for i, j, s, at, _, _ in found:
            gone = s.covered(at[hit[used:used + len(at)]])
            used += len(at)
            n_words.append(s.sizes)
            n_removed.append(np.bincount(s.doc[gone], minlength=j - i))
            kept += s.kept(gone)
            new = np.append(True, s.doc[1:] != s.doc[:-1]) if len(gone) else gone
            first = np.flatnonzero(gone & (new | ~np.append(False, gone[:-1])))
            last = np.flatnonzero(gone & np.append(new[1:] | ~gone[1:], True)) + 1 if len(gone) else first
            of = s.doc[first]
            pairs = np.stack([first - s.first[of], last - s.first[of]], 1).tolist()
            ends = np.cumsum(np.bincount(of, minlength=j - i)).tolist()
            spans += [pairs[a:b] for a, b in zip([0] + ends[:-1], ends)]
        release_memory()
        return pa.table([left["id"], pa.array(_joined(n_words, np.int64), pa.int64()), pa.array(_joined(n_removed, np.int64), pa.int64()),
                         pa.array(kept, pa.string()), pa.array(spans, pa.list_(pa.list_(pa.int64())))],
                        names=["id", "n_words", "n_removed", "kept", "spans"])

    texts = src.groupBy("chunk")
    windows = texts.cogroup(seen.groupBy("chunk")).applyInArrow(asked, _ASKS_DDL)
    both = seen.unionByName(_answer(windows, 1))
    return texts.cogroup(both.groupBy("chunk")).applyInArrow(
        cleaned, "id bigint, n_words bigint, n_removed bigint, kept string, spans array<array<bigint>>")


OP11_SQL = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
place AS (SELECT r, unnest(range(1, len(w) - 33)) AS i FROM w),
h AS (SELECT r, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS h FROM place JOIN w USING (r)),
again AS (SELECT h FROM h GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM h JOIN again USING (h)),
lost AS (SELECT r, list(p) AS p, count(*) AS n FROM gone GROUP BY r),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM w),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN lost USING (r) LEFT JOIN kept USING (r)
"""


@register("op11_difference_cover", OP11_SQL)
def op11_difference_cover(spark, sf_dir):
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
