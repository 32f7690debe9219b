"""Secret scans: Aho-Corasick keyword prefilter, anchored regular expressions near its hits, embedded checksums.

One pass of the automaton over the ASCII-lower-cased text finds every place a keyword stands; the regular expression
of that keyword's kind is then tried at that place only.  Hex runs have no keyword; their expression starts at runs
of 32.  Tokens of formats that carry a checksum (base-62 CRC-32 in the last six characters) count only if it holds.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.registry import register, table

#: Order of the kinds in span lists; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "hosting", "registry")
_ASSIGN = re.compile(r"(?a:(?i:(password|passwd|secret|token|api_?key)))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_HOSTING = re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
_REGISTRY = re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_KEYWORDS = {"assign": ("password", "passwd", "secret", "token", "apikey", "api_key"), "access": ("akia",),
             "hosting": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "registry": ("npm_",)}
_AUTOMATON = []


def _base62(n: int, width: int = 6) -> str:
    out = ""
    while n:
        n, r = divmod(n, 62)
        out = _DIGITS[r] + out
    return out.rjust(width, "0")


def checksum_holds(token: str) -> bool:
    """The last six characters are the base-62 CRC-32 of the 30 before them."""
    body = token.split("_", 1)[1]
    return _base62(zlib.crc32(body[:-6].encode())) == body[-6:]


def _automaton():
    if not _AUTOMATON:
        import ahocorasick
        a = ahocorasick.Automaton()
        for kind, words in _KEYWORDS.items():
            for w in words:
                a.add_word(w, (kind, len(w)))
        a.make_automaton()
        _AUTOMATON.append(a)
    return _AUTOMATON[0]


_RULES = {"assign": (_ASSIGN, lambda m: len(m[2]) >= 8), "access": (_ACCESS, lambda m: len(m[0]) >= 16),
          "hosting": (_HOSTING, lambda m: checksum_holds(m[0])),
          "registry": (_REGISTRY, lambda m: checksum_holds(m[0]))}


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind.

    Matches of a kind are leftmost and do not overlap; a match that fails its length or checksum is dropped after it
    has consumed its text, as a plain left-to-right scan would do.
    """
    low = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    spans, free = [], dict.fromkeys(_RULES, 0)
    # hits come by their end; a keyword is a prefix of its match, so sort by start
    for start, kind in sorted((end - n + 1, kind) for end, (kind, n) in _automaton().iter(low)):
        if start < free[kind]:
            continue
        rule, passes = _RULES[kind]
        if m := rule.match(text, start):
            free[kind] = m.end()
            if passes(m):
                spans.append((kind, start, m.end()))
    spans += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end>>) for every row; a null text counts as empty (no spans).

    Rows are independent: no shuffle, equal rows give equal results, other columns are not read.
    """
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in find_spans(t)] if t else []
                     for t in (x.as_py() for x in b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], names=["id", "spans"])

    out = src.mapInArrow(run, f"id {dict(src.dtypes)['id']}, spans array<struct<kind:string,start:bigint,end:bigint>>")
    return out.withColumnRenamed("id", id_col)


@register("op3_secret_scan")
def op3_secret_scan(spark, sf_dir):
    found = scan_secrets(table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))
    return found.select("doc_id", *(count(k) for k in KINDS[:3]), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
