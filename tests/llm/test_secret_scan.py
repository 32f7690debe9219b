"""Secret scan against plain left-to-right regular expressions."""

import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm.secret_scan import _base62, find_spans, op3_secret_scan, scan_secrets
from tests.conftest import SF_ORACLE

ASSIGN = re.compile(r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
                    r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def plain(text):
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def base(text):
    return [s for s in find_spans(text) if s[0] in ("assign", "access", "hex")]


PIECES = ["password", "PassWD", "secret", "token", "api_key", "ApiKey", "AKIA", "akia", ":", "=", " ", '"', "'", "abcdefgh",
          "A1B2C3D4E5F6", "0123456789abcdef", "é", "ſecret", "toKen", "\n", "\t", "x", "İ", "ghp_", "\U0001f600", "=="]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25))
def test_random_pieces(parts):
    assert base("".join(parts)) == plain("".join(parts))


def test_long_text():
    r = random.Random(1)
    text = "".join(r.choice(PIECES) for _ in range(50_000))
    assert base(text) == plain(text)


def test_checksums():
    body = "abcdefghijABCDEFGHIJ0123456789"
    good = body + _base62(zlib.crc32(body.encode()))
    bad = body + "000000"
    assert find_spans(f"é ghp_{good} npm_{good}.") == [("hosting", 2, 42), ("registry", 43, 83)]
    assert find_spans(f"ghp_{bad} npm_{bad} ghp_{good}x GHP_{good}") == []


def test_whole_table(spark):
    want = {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    import hashlib
    for r in op3_secret_scan(spark, SF_ORACLE).collect():
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in want[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.spans == text
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[0] == k for s in want[r.doc_id])
                                                     for k in ("assign", "access", "hex")]
    assert any(want.values())


def test_nulls_empty_repeats(spark):
    rows = spark.createDataFrame([(1, None, 0), (None, "", 0), (2, "token=abcdefgh", 1), (2, "token=abcdefgh", 1)],
                                 "doc_id long, text string, spans int")
    got = [(r.doc_id, [tuple(s) for s in r.spans]) for r in scan_secrets(rows).collect()]
    assert got == [(1, []), (None, []), (2, [("assign", 0, 14)]), (2, [("assign", 0, 14)])]
    assert scan_secrets(rows.limit(0)).collect() == []
