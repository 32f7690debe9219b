"""The pipeline, stage by stage, against brute force on each stage's own input."""

import duckdb
import pytest

import corpus_pipeline
from ledgerlens.llm.mixing import OP5_SQL
from ledgerlens.llm.toxicity import THRESHOLD, op1_toxicity_gbt
from ledgerlens.session import scratch_path
from tests.conftest import SF_ORACLE
from tests.llm.test_decontam import words_of
from tests.llm.test_near_dedup import brute
from tests.llm.test_token_store import expected


@pytest.fixture(scope="module")
def chain(spark):
    """(stage name, its input, its output), each written and read again."""
    docs, out = spark.read.parquet(f"{SF_ORACLE}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, docs, SF_ORACLE).write.parquet(path)
        out.append((name, docs, spark.read.parquet(path)))
        docs = out[-1][2]
    return {name: (before, after) for name, before, after in out}


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_names_and_columns(chain):
    assert list(chain) == ["toxicity", "near_dedup", "decontamination", "mixing", "token_output"]
    first = chain["toxicity"][0]
    for name in list(chain)[:-1]:
        assert chain[name][1].dtypes == first.dtypes


def test_toxicity(spark, chain):
    before, after = map(rows, chain["toxicity"])
    bad = {r.doc_id for r in op1_toxicity_gbt(spark, SF_ORACLE).filter(f"score >= {THRESHOLD}").collect()}
    assert bad and set(after) == set(before) - bad
    clean = {r.doc_id for r in spark.read.parquet(f"{SF_ORACLE}/labels.parquet").filter("toxic = 0").collect()}
    assert len(clean & set(before) - set(after)) <= 0.02 * len(clean)


def test_near_dedup(chain):
    before, after = map(rows, chain["near_dedup"])
    groups = brute(list(before.items()), 80)
    assert set(after) == {i for i, (_, c) in groups.items() if c == i} and len(after) < len(before)


def test_decontamination(spark, chain):
    before, after = map(rows, chain["decontamination"])
    items = [words_of(r.text) for r in spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet").collect()]
    windows = {tuple(w[k:k + 8]) for w in items for k in range(len(w) - 7)}
    whole, some = set(), set()
    for d, t in before.items():
        w = words_of(t)
        if any(tuple(w[k:k + 8]) in windows for k in range(len(w) - 7)):
            some.add(d)
            if any(" " + " ".join(i) + " " in " " + " ".join(w) + " " for i in items):
                whole.add(d)
    gone = set(before) - set(after)
    assert whole and whole <= gone <= some


def test_mixing(chain):
    before, after = chain["mixing"]
    con = duckdb.connect()
    docs = before.toPandas()
    con.register("documents", docs)
    want = con.execute(f"SELECT doc_id, CASE WHEN size > 0 THEN taken // size ELSE 0 END AS c, size FROM ({OP5_SQL})").df()
    got = after.groupBy("doc_id").count().toPandas().set_index("doc_id")["count"]
    for r in want[want["size"] > 0].itertuples():
        assert got.get(r.doc_id, 0) == r.c


def test_token_output(chain):
    before, after = chain["token_output"]
    want = expected((r.doc_id, r.text) for r in before.orderBy("doc_id").collect())
    assert sorted(tuple(r) for r in after.select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == want


def test_run_is_the_chain(spark, chain):
    assert corpus_pipeline.ORACLE_SQL is None
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF_ORACLE).collect()))
    assert got == sorted(map(tuple, chain["token_output"][1].collect()))


def test_edge_rows(spark):
    docs = spark.createDataFrame([(None, None, "en", None, 0), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "a b", None, "t", 3),
                                  (3, "word " * 5000, "en", "t", 9), (None, "x y z", "en", "s", 5)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        for df in (docs, docs.limit(0)):
            out = stage(spark, df, SF_ORACLE)
            assert out.count() <= 3 * df.count() and (name == "token_output" or out.columns == docs.columns)


def test_copies_with_one_id_or_none_and_clashing_columns(spark):
    import random
    r = random.Random(2)
    prose = " ".join(f"w{r.randrange(10**6)}" for _ in range(60))
    item = spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(1, prose), (1, prose), (None, prose), (7, prose), (None, f"Now: {item}"), (9, "short and clean"), (None, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "s", 1, 2, "r", 3.5, 4, k) for k, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, source string, size int, target long, _row string, taken double, id int, n int")
    path = scratch_path(spark, "clash")
    docs.write.parquet(path)
    for df in (docs, spark.read.parquet(path)):
        left = corpus_pipeline.near_dedup(spark, df, SF_ORACLE)
        assert left.dtypes == docs.dtypes
        kept = [x.n for x in left.collect()]
        assert len(kept) == 5 and len({0, 1} & set(kept)) == 1 and {4, 5, 6, 7} <= set(kept)
        left = corpus_pipeline.decontamination(spark, df, SF_ORACLE)
        assert left.dtypes == docs.dtypes and sorted(x.n for x in left.collect()) == [0, 1, 2, 3, 5, 6, 7]
        left = corpus_pipeline.mixing(spark, df, SF_ORACLE)
        assert left.dtypes == docs.dtypes
        assert all((x["size"], x["target"], x["_row"], x["id"]) == (1, 2, "r", 4) for x in left.collect())
        left = corpus_pipeline.toxicity(spark, df, SF_ORACLE)
        assert left.dtypes == docs.dtypes
