"""Near-duplicates against all pairs of shingle sets."""

import random
import re

import numpy as np
import pytest

from ledgerlens.llm import near_dedup
from ledgerlens.llm.components import connected_components
from ledgerlens.llm.near_dedup import confirmed, least_agreement, near_duplicates
from tests.conftest import SF_ORACLE


def shingle_set(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if len(words) >= k else {tuple(words)}


def brute(rows, percent):
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    by = {}
    for at, (_, s) in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(at)
    for at, (i, s) in enumerate(sets):
        shared = {}
        for x in s:
            for o in by[x]:
                if o > at:
                    shared[o] = shared.get(o, 0) + 1
        for o, c in shared.items():
            if 100 * c >= percent * (len(s) + len(sets[o][1]) - c):
                a, b = sorted((root(i), root(sets[o][0])))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets}


def check(spark, rows, percent):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: (r.n_shingles, r.component_id) for r in near_duplicates(df, percent).collect()}
    want = brute(rows, percent)
    wrong = {i: (got.get(i), want[i]) for i in want if got.get(i) != want[i]}
    assert not wrong and len(got) == len(want)


def variants(seed, n, words, edits):
    """Copies of one text with a few words changed in each."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(words)] = f"x{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("percent", [85, 80])
def test_whole_table(spark, percent):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()]
    check(spark, rows, percent)


def test_families_near_the_threshold(spark):
    texts = [t for s in range(25) for t in variants(s, 12, 30 + 11 * s, 1 + s // 4)]
    texts += ["a b c", "A b  c", "a b c d", "", " \n", "a", None, "a b c d e", "a b c d e f"]
    check(spark, list(enumerate(texts)), 85)


def test_crowded_regions_and_large_families(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "REGION", 24)
    monkeypatch.setattr(near_dedup, "FAMILY_SHINGLES", 100_000)
    texts = variants(1, 150, 120, 3) + variants(2, 60, 300, 2) + ["same text of seven words or so"] * 80
    # sets of 10,000 shingles that differ in one: all places of the signature agree
    long = [f"v{i}" for i in range(10_000)]
    texts += [" ".join([*long, f"end{k}"]) for k in range(60)]
    check(spark, [(1000 - i, t) for i, t in enumerate(texts)], 85)


@pytest.mark.parametrize("shingles", [100_000, 3_000])
def test_star_around_a_middle_id(spark, monkeypatch, shingles):
    """Each variant is linked with the hub only, in a family and regions far above REGION."""
    monkeypatch.setattr(near_dedup, "REGION", 24)
    monkeypatch.setattr(near_dedup, "FAMILY_SHINGLES", shingles)
    r = random.Random(3)
    hub = [f"w{i}" for i in range(204)]
    texts = []
    for n in range(240):
        w = list(hub)
        for at in r.sample(range(5, 199, 6), 3):
            w[at] = f"x{n}-{at}"
        texts.append(" ".join(w))
    texts.insert(120, " ".join(hub))
    rows = list(enumerate(texts))
    assert {c for _, c in brute(rows, 85).values()} == {0}
    check(spark, rows, 85)


def test_pairs_across_parts_are_all_tested(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "REGION", 4)
    rows = [(g, 100 * g + i, 100 * g + (0 if i < 9 else i), 1) for g in range(3) for i in range(9 if g == 2 else 30)]
    tasks = {}
    for x in near_dedup.crossing(spark.createDataFrame(rows, "grp long, id long, part long, n long")).collect():
        tasks.setdefault(x.task, []).append((x.side, x.part, x.id))
    got = set()
    for t in tasks.values():
        side, part = np.array([x[0] for x in t]), np.array([x[1] for x in t])

        def linked(i, rest):
            got.update(frozenset((t[i][2], t[j][2])) for j in rest)  # noqa: B023
            return np.zeros(len(rest), bool)
        assert not list(near_dedup.walk_across(side, part, linked))
    assert got == {frozenset((a[1], b[1])) for a in rows for b in rows if a[0] == b[0] and a[2] != b[2]}


def test_odd_ids_and_columns(spark):
    text = "one two three four five six"
    df = spark.createDataFrame([(None, text, 1, "n"), (7, text, 2, "n"), (7, text, 2, "n"), (3, text + " .", 1, "n"),
                                (9, None, 1, "n"), (8, "", 1, "n")], "doc_id long, text string, id int, n string")
    got = sorted((r.id or -1, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, 50).collect())
    assert got == [(-1, 2, None, True), (3, 3, 3, True), (7, 2, 3, False), (7, 2, 3, False), (8, 0, 8, True), (9, 0, 9, True)]
    assert near_duplicates(df.limit(0)).collect() == []


def test_components(spark):
    r = random.Random(5)
    links = [(r.randrange(400), r.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(500, 700)]
    links += [(900, 800 + i) for i in range(50)] + [(None, 1), (3, 3)]
    got = {x.id: x.component for x in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}
    for a, b in links:
        if a is not None and a != b:
            for x in (a, b):
                parent.setdefault(x, x)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        if a is not None and a != b:
            lo, hi = sorted((root(a), root(b)))
            parent[hi] = lo
    assert got == {x: root(x) for x in parent}


def test_signatures_estimate_similarity():
    r = np.random.default_rng(1)
    a = np.unique(r.integers(0, 2**63, 2000).astype(np.uint64))
    b = np.unique(np.concatenate([a[:1800], r.integers(0, 2**63, 200).astype(np.uint64)]))
    s = near_dedup.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
    j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((s[0] == s[1]).mean() - j) < 0.12 and (s[0] == s[1]).sum() >= least_agreement(j)
    assert [(int(x), y.tolist()) for x, y in confirmed(np.array([4, 9]), [a, b], 80)] == [(4, [9])]


def test_a_large_family_has_about_a_link_a_member(spark, monkeypatch):
    """Regions of a family have different roots; its links don't come once for every tree."""
    seen = []

    def counted(links):
        seen.append(links.count())
        return connected_components(links)

    monkeypatch.setattr(near_dedup, "REGION", 24)
    monkeypatch.setattr(near_dedup, "connected_components", counted)
    texts = variants(1, 300, 200, 1)
    got = near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 80).collect()
    assert {r.component_id for r in got} == {0}
    assert seen and max(seen) <= 2 * 300


def test_thinned_links_have_the_same_components(spark):
    r = random.Random(5)
    links = [tuple(sorted(r.sample(range(60), 2))) for _ in range(50)] * 2 + [(7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    few = near_dedup.thinned(df)
    parts = lambda d: sorted(map(tuple, connected_components(d).collect()))
    assert parts(few) == parts(df) and few.count() <= len(set(links)) - 1
