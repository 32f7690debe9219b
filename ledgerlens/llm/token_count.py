"""Token counts by rank-synchronous array merging.

The texts of a batch are cut into pre-tokens (a run of word-start marks and the characters up to the next mark: no
piece of the vocabulary goes across such a cut, which is checked when the model is loaded).  The distinct ones that are
not known yet lie in one ragged numpy array of symbols; every round merges, in all sequences at once, the pair of
lowest rank of each, until no pair of the vocabulary is left.  The surviving symbols are counted; a symbol outside the
vocabulary counts as its UTF-8 bytes (byte fallback).  Counts of pre-tokens are kept per Python worker, up to a bound.

Rounds over the whole array cost its length each.  That is cheap for words, but not for a pre-token of a megabyte, so
the long ones keep their pairs in buckets by rank, and a round touches only the places that merge (and their
neighbours, which are linked by arrays).
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.registry import register, table

MARK = "▁"
MAX_CACHED = 400_000                 # pre-tokens whose counts a worker keeps
LONG = 400                           # characters from which a pre-token's pairs are kept by rank; same counts either way
LONG_TOGETHER = 1_000_000            # characters of long pre-tokens that are merged at once (or one longer pre-token)
_RUN = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_NO_RANK = np.int64(1 << 40)
_LOADED: dict[str, PieceMerger] = {}


class PieceMerger:
    """The merge table of a sentencepiece BPE model with byte fallback and identity normalisation."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, scores = {}, {}
        for i in range(sp.get_piece_size()):
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                pieces[sp.id_to_piece(i)] = i
                scores[sp.id_to_piece(i)] = sp.get_score(i)
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("a piece of this model goes across a word start")
        self.symbols = {p: k for k, p in enumerate(sorted({*pieces, *(c for p in pieces for c in p)}))}
        names = list(self.symbols)
        # equal scores share a rank: the leftmost of them goes first
        rank_of = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs = [(self.symbols[p[:i]] * len(names) + self.symbols[p[i:]], rank_of[scores[p]], self.symbols[p])
                 for p in pieces if len(p) > 1 for i in range(1, len(p))
                 if p[:i] in self.symbols and p[i:] in self.symbols]
        pairs.sort()
        self.keys, self.ranks, self.merged = (np.array(x, np.int64) for x in zip(*pairs))
        self.n = len(names)
        self.cost = np.array([1 if p in pieces else len(p.encode()) for p in names], np.int64)
        self.known: dict[str, int] = {}

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of pairs; symbols below 0 pair with nothing."""
        key = left * self.n + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], _NO_RANK), np.where(hit, self.merged[at], -1)

    def count(self, sequences: list[str]) -> np.ndarray:
        """Tokens of each (non-empty) pre-token."""
        total = np.zeros(len(sequences), np.int64)
        size = np.array([len(s) for s in sequences], np.int64)
        text = "".join(sequences)
        get = self.symbols.get
        sym = np.fromiter((get(c, -1) for c in text), np.int64, len(text))
        seq = np.repeat(np.arange(len(sequences)), size)
        if (foreign := np.flatnonzero(sym < 0)).size:
            np.add.at(total, seq[foreign], [len(text[i].encode("utf-8", "replace")) for i in foreign])
        while len(sym):
            # pair i is (i, i + 1); the last symbol of a sequence has none
            joined = seq[:-1] == seq[1:]
            rank, into = self._look_up(sym[:-1], sym[1:])
            rank = np.where(joined, rank, _NO_RANK)
            rank, into = np.append(rank, _NO_RANK), np.append(into, -1)
            first = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            length = np.diff(np.append(first, len(sym)))
            low = np.repeat(np.minimum.reduceat(rank, first), length)
            over = low == _NO_RANK
            if over.any():                       # these sequences are finished
                done = over & (sym >= 0)
                np.add.at(total, seq[done], self.cost[sym[done]])
                keep = ~over
                sym, seq, rank, into, low = sym[keep], seq[keep], rank[keep], into[keep], low[keep]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == low)
            # of overlapping pairs in a row, every second one from the left
            run = np.append(True, np.diff(at) != 1)
            begin = np.flatnonzero(run)
            at = at[(np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))) % 2 == 0]
            at = self._independent(sym, seq, into, low, at)
            sym[at] = into[at]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            sym, seq = sym[stay], seq[stay]
        return total

    def _independent(self, sym, seq, into, low, at) -> np.ndarray:
        """Of the pairs about to merge at once, only the leftmost in sequences where merging it first could open a
        pair of the same or a lower rank: there the order matters."""
        new = into[at]
        left = np.where(at > 0, sym[np.maximum(at - 1, 0)], -1)
        hit = np.isin(at - 2, at)                # the left neighbour is itself merged just before
        left = np.where(hit, into[np.maximum(at - 2, 0)], left)
        left = np.where((at > 0) & (seq[np.maximum(at - 1, 0)] == seq[at]), left, -1)
        last = len(sym) - 1
        right = np.where((at + 2 <= last) & (seq[np.minimum(at + 2, last)] == seq[at]), sym[np.minimum(at + 2, last)], -1)
        limit = low[at]
        risky = (self._look_up(left, new)[0] <= limit) | (self._look_up(new, right)[0] <= limit)
        if not risky.any():
            return at
        bad = np.isin(seq[at], seq[at[risky]])
        leftmost = np.append(True, seq[at][1:] != seq[at][:-1])
        return at[~bad | leftmost]

    def count_long(self, sequences: list[str]) -> np.ndarray:
        """Tokens of each (non-empty) pre-token, at a cost that follows the merges instead of rounds x length.

        Place i holds a symbol and ``rank[i]`` the rank of its pair with the next living place.  Sequences don't touch
        each other, so the lowest rank of all goes first, in all of them.
        """
        size = np.array([len(s) for s in sequences], np.int64)
        text = "".join(sequences)
        n, get = len(text), self.symbols.get
        sym = np.fromiter((get(c, -1) for c in text), np.int64, n)
        seq = np.repeat(np.arange(len(sequences)), size)
        total = np.zeros(len(sequences), np.int64)
        if (foreign := np.flatnonzero(sym < 0)).size:
            np.add.at(total, seq[foreign], [len(text[i].encode("utf-8", "replace")) for i in foreign])
        sym = np.append(sym, -1)                 # place n stands for "none"
        end = np.cumsum(size)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[end - 1], before[end - size] = n, n
        rank = self._look_up(sym[:n], sym[after[:n]])[0]
        alive = np.ones(n, bool)
        waiting: dict[int, list[np.ndarray]] = {}
        lowest: list[int] = []

        def wait(places: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cut = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for r, group in zip(ranks[np.append(0, cut)].tolist(), np.split(places, cut)):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(lowest, r)
                waiting[r].append(group)

        if (open_ := np.flatnonzero(rank < _NO_RANK)).size:
            wait(open_, rank[open_])
        while lowest:
            r = heapq.heappop(lowest)
            groups = waiting.pop(r)
            at = groups[0] if len(groups) == 1 else np.unique(np.concatenate(groups))
            every = at = at[rank[at] == r]       # others have merged or changed since
            if not len(at):
                continue
            # of overlapping pairs in a row, every second one from the left
            run = np.append(True, at[1:] != after[at[:-1]])
            if not run.all():
                begin = np.flatnonzero(run)
                at = at[(np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))) % 2 == 0]
            into = self._look_up(sym[at], sym[after[at]])[1]
            # up to the first one that opens a pair of the same or a lower rank: that pair may come before the rest
            left = sym[before[at]]
            hit = np.flatnonzero(before[at[1:]] == after[at[:-1]]) + 1
            left[hit] = into[hit - 1]
            opens = np.minimum(self._look_up(left, into)[0], self._look_up(into, sym[after[after[at]]])[0]) <= r
            if opens.any():
                k = int(opens.argmax()) + 1
                at, into = at[:k], into[:k]
                if (rest := every[every > at[-1]]).size:
                    wait(rest, rank[rest])
            gone = after[at]
            beyond = after[gone]
            sym[at], after[at], before[beyond] = into, beyond, at
            alive[gone], rank[gone] = False, _NO_RANK
            touched = before[at]
            touched = np.unique(np.append(at, touched[touched < n]))
            now = self._look_up(sym[touched], sym[after[touched]])[0]
            rank[touched] = now
            if (more := now < _NO_RANK).any():
                wait(touched[more], now[more])
        left = np.flatnonzero(alive & (sym[:n] >= 0))
        np.add.at(total, seq[left], self.cost[sym[left]])
        return total

    def count_texts(self, texts: list[str]) -> list[int]:
        cut = []
        for t in texts:
            words = t.replace(MARK, " ").split(" ") if t else []
            if "" in words:                      # runs of blanks: mark runs belong to the word behind them
                cut.append([w[1:] for w in _RUN.findall(MARK + t.replace(" ", MARK))])
            else:
                cut.append(words)
        known = self.known
        new = list({w for words in cut for w in words}.difference(known))
        if len(known) + len(new) > MAX_CACHED:
            known.clear()
            new = list({w for words in cut for w in words})
        short = [w for w in new if len(w) < LONG]
        for i in range(0, len(short), 20_000):
            part = short[i:i + 20_000]
            known.update(zip(part, self.count([MARK + w for w in part]).tolist()))
        part, n = [], 0
        for w in (w for w in new if len(w) >= LONG):
            part.append(w)
            n += len(w)
            if n >= LONG_TOGETHER:
                known.update(zip(part, self.count_long([MARK + w for w in part]).tolist()))
                part, n = [], 0
        if part:
            known.update(zip(part, self.count_long([MARK + w for w in part]).tolist()))
        return [sum(map(known.__getitem__, words)) for words in cut]


def merger(path: str) -> PieceMerger:
    if path not in _LOADED:
        _LOADED[path] = PieceMerger(path)
    return _LOADED[path]


def count_tokens(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row; ``model`` names a file of the public tokenizers package or a path.

    A null or empty text has 0 bytes and 0 tokens.  Rows are independent (no shuffle); other columns are not read.
    """
    src = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]):
        m = merger(_model_path(model))
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                texts = part.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(t.encode("utf-8", "replace")) for t in texts], pa.int64()),
                     pa.array(m.count_texts(texts), pa.int64())], names=["id", "n_bytes", "n_tokens"])

    out = src.mapInArrow(run, f"id {dict(src.dtypes)['id']}, n_bytes bigint, n_tokens bigint")
    return out.withColumnRenamed("id", id_col)


def _model_path(name: str) -> str:
    if "/" in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


@register("op6_token_count")
def op6_token_count(spark, sf_dir):
    return (count_tokens(table(spark, sf_dir, "documents"), "piece_bpe_32k.model")
            .withColumn("over_limit", F.col("n_tokens") > 4096))
