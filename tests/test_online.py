"""Online table by increments: what a push rewrites, retries, crashes, two writers, arrivals, bucketed lookups."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import online as O
from ledgerlens.operators.joins import latest_per_key
from ledgerlens.session import scratch_path

SCHEMA = "k long, ts timestamp_ntz, v double, e long, extra string"


def _t(day, hour=0):
    return datetime(2024, 1, day, hour)


def _rows(spark, *rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)


def _table(spark, buckets=8, path=None):
    return O.OnlineTable(spark, path or scratch_path(spark, "online-test"), ["k"], "ts", ["v"], "e", buckets)


def _content(t):
    return sorted((r.k, r.ts, r.v, r.e) for r in t.read().collect())


def test_newest_row_stays_with_ties_nulls_and_repeats(spark):
    t = _table(spark)
    t.push(_rows(spark, (1, _t(3), 1.0, 1), (1, _t(3), 2.0, 2), (1, _t(3), 2.0, 2), (None, _t(9), 9.0, 9), (2, None, 3.0, 3),
                 (3, _t(1), None, 4)), "a")
    assert _content(t) == [(1, _t(3), 2.0, 2), (3, _t(1), None, 4)]
    t.push(_rows(spark, (1, _t(2), 7.0, 9), (3, _t(1), 5.0, 3)), "older")
    assert _content(t) == [(1, _t(3), 2.0, 2), (3, _t(1), None, 4)]
    assert t.read().columns == ["k", "ts", "v", "e"]


def test_a_push_rewrites_its_buckets_only(spark):
    t = _table(spark)
    t.push(spark.range(1000).selectExpr("id AS k", "timestamp_ntz'2024-01-01' AS ts", "1.0D AS v", "id AS e"), "load")
    before = t.head()
    after = t.push(_rows(spark, (17, _t(2), 5.0, 1)), "one")
    changed = [b for b in after.places if after.places[b] != before.places[b]]
    assert len(before.places) == 8 and len(changed) == 1
    assert t.read().count() == 1000 and t.read().filter("k = 17").first().v == 5.0
    fs, folder = t._fs(f"{t.path}/data/{after.places[changed[0]]}")
    assert [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()] == [f"_bucket={changed[0]}"]


def test_a_push_again_changes_nothing(spark):
    t = _table(spark)
    t.push(_rows(spark, (1, _t(1), 1.0, 1)), "a")
    head = t.push(_rows(spark, (1, _t(2), 2.0, 2)), "b")
    assert t.push(_rows(spark, (1, _t(3), 3.0, 3)), "a") == head
    assert t.head() == head and _content(t) == [(1, _t(2), 2.0, 2)]


def test_empty_pushes(spark):
    t = _table(spark)
    with pytest.raises(LookupError):
        t.read()
    t.push(_rows(spark), "none")
    assert _content(t) == []
    t.push(_rows(spark, (1, _t(1), 1.0, 1)), "a")
    places = t.head().places
    t.push(_rows(spark), "none again")
    assert t.head().places == places and _content(t) == [(1, _t(1), 1.0, 1)]


def test_a_driver_lost_before_the_commit_leaves_the_table_as_it_was(spark, monkeypatch):
    t = _table(spark)
    t.push(_rows(spark, (1, _t(1), 1.0, 1)), "a")
    with monkeypatch.context() as m:
        m.setattr(t, "_commit", lambda c: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            t.push(_rows(spark, (1, _t(2), 2.0, 2)), "b")
    again = _table(spark, path=t.path)
    assert _content(again) == [(1, _t(1), 1.0, 1)]
    again.push(_rows(spark, (1, _t(2), 2.0, 2)), "b")
    assert _content(again) == [(1, _t(2), 2.0, 2)]
    again.vacuum(keep=1)
    fs, folder = t._fs(f"{t.path}/data")
    assert {s.getPath().getName() for s in fs.listStatus(folder)} == set(again.head().places.values())
    assert _content(again) == [(1, _t(2), 2.0, 2)]


def test_two_writers_lose_no_push(spark, monkeypatch):
    first, second = _table(spark, buckets=1), None
    first.push(_rows(spark, (1, _t(1), 1.0, 1)), "load")
    second = _table(spark, buckets=1, path=first.path)
    merge, beaten = first._merge, []

    def slow(*args):
        if not beaten:
            beaten.append(second.push(_rows(spark, (2, _t(2), 2.0, 2)), "other"))
        return merge(*args)

    monkeypatch.setattr(first, "_merge", slow)
    first.push(_rows(spark, (3, _t(3), 3.0, 3)), "mine")
    assert [r[0] for r in _content(first)] == [1, 2, 3]
    assert first.head().pushes == ("load", "other", "mine")


def test_increments_with_late_rows_equal_one_run(spark):
    rows = [(k, _t(d, k % 5), float(100 * d + k), d * 100 + k, _t(min(d + 3 * (k % 4 == 0), 28)).date()) for d in range(1, 25)
            for k in range(30)]
    path = scratch_path(spark, "arrivals")
    src = spark.createDataFrame(rows, "k long, ts timestamp_ntz, v double, e long, arrived date")
    src.write.partitionBy("arrived").parquet(path)
    src, t = spark.read.parquet(path), _table(spark)
    for end in ("2024-01-07", "2024-01-15", "2024-01-15", "2024-01-10", "2024-01-22"):
        t.materialize(src, "arrived", end)
    want = latest_per_key(src.filter("arrived <= DATE'2024-01-22'"), ["k"], "ts", ["v", "e"], "e").select("k", "ts", "v", "e")
    assert _content(t) == sorted(tuple(r) for r in want.collect())
    assert t.head().mark == "2024-01-22" and t.head().number == 3


def test_an_increment_reads_new_partitions_only(spark):
    path = scratch_path(spark, "arrivals")
    spark.range(40).selectExpr("id AS k", "date_add(DATE'2024-01-01', CAST(id % 10 AS INT)) AS arrived").write.partitionBy(
        "arrived").parquet(path)
    got = O.arrivals(spark.read.parquet(path), "arrived", "2024-01-03", "2024-01-05")
    plan = got._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[(.*?)\], Pushed", plan).group(1)
    assert "arrived" in filters and "> 2024-01-03" in filters and "<= 2024-01-05" in filters
    assert {str(r.arrived) for r in got.collect()} == {"2024-01-04", "2024-01-05"}
    assert len({f for f in got.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}) <= 2 * 8


def test_lookup_reads_the_buckets_asked_for(spark):
    t = _table(spark)
    t.push(spark.range(1000).selectExpr("id AS k", "timestamp_ntz'2024-01-01' AS ts", "id * 1.0D AS v", "id AS e"), "load")
    asked = spark.createDataFrame([(5, "a"), (5, "b"), (None, "c"), (5000, "d")], "k long, v string")
    out = t.lookup(asked.withColumnRenamed("v", "note"))
    assert sorted((r.note, r.k, r.v) for r in out.collect()) == [("a", 5, 5.0), ("b", 5, 5.0), ("c", None, None),
                                                                 ("d", 5000, None)]
    files = [f for f in out.inputFiles() if t.path.removeprefix("file:") in f]
    assert 1 <= len({re.search("_bucket=([0-9]+)", f).group(1) for f in files}) <= 2
    assert t.lookup(asked).columns == ["k", "ts", "v", "e"]   # a request column named like a value gives way


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_bucketed_lookup_moves_requests_not_the_table(spark, threshold):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        name = f"online_lookup_test_{'all' if threshold == '-1' else 'small'}"
        online = spark.range(500).selectExpr("id AS k", "id * 2.0D AS v")
        O.publish_buckets(online, name, scratch_path(spark, name), ["k"], 8)
        asked = spark.range(3000).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id END AS k", "id AS r")   # a third for one key
        out = O.bucketed_lookup(asked, name, ["k"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        # between the scan of the table and its join there are only filters and the sort of a bucket
        lines = plan.split("\n")
        scan = next(i for i, x in enumerate(lines) if "Bucketed: true" in x)
        join = max(i for i in range(scan) if "SortMergeJoin" in lines[i])
        depth = re.search(r"[+:]- ", lines[scan]).start()
        above, at = [], depth
        for i in range(scan - 1, join, -1):
            d = re.search(r"[+:]- ", lines[i]).start()
            if d < at:
                above.append(lines[i])
                at = d
        assert above and not any("Exchange" in x for x in above)
        got = out.toPandas()
        assert len(got) == 3000 and got.r.is_unique
        known = got.k.notna() & (got.k < 500)
        assert (got.v[known] == got.k[known] * 2).all() and got.v[~known].isna().all()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
