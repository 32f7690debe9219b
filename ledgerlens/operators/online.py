"""Online feature table by increments: pushes rewrite only the key buckets they touch, materialisation reads only what
arrived since the last one, lookups read only the buckets asked for or join co-located buckets.

Under ``path``::

    data/<push>-<attempt>/_bucket=<b>/   a bucket as that push left it
    commits/<n>.json                     where each bucket is now, the high-water mark, the schema, the latest pushes

A push writes its buckets first and its commit last, by a rename that fails if the number is taken.  Readers take the
newest commit, so they see a push as a whole or not at all, and what a lost driver left behind is never read.  Merging
keeps the newest row of a key, so a push that is tried again changes nothing.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlens.operators.joins import latest_per_key
from ledgerlens.session import scratch_path

KNOWN_PUSHES = 1000   # ids of the latest pushes a commit carries; an older one tried again is merged again, to no effect


class TakenError(RuntimeError):
    """Another writer committed first."""


@dataclass(frozen=True)
class Commit:
    number: int = 0
    places: dict[int, str] = field(default_factory=dict)   # bucket -> folder of the push that wrote it last
    mark: str | None = None                                # arrivals up to here are in the table
    schema: str | None = None
    pushes: tuple[str, ...] = ()


class OnlineTable:
    """One row per key: keys, ``ts``, ``columns`` and the tie-breaker, in ``buckets`` buckets by hash of the keys.

    A bucket is merged by one task and is one file: choose ``buckets`` so that it holds 100 to 200 MB.  Its number is
    fixed for the life of the table.  Rows with a null in a key or in ``ts`` belong to nobody and are left out.  Equal
    times go to the larger tie-breaker, then to the larger values.  Columns that aren't named are ignored."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], ts: str, columns: list[str],
                 tie_breaker: str | None = None, buckets: int = 64):
        self.spark, self.path, self.keys, self.ts, self.buckets = spark, path.rstrip("/"), list(keys), ts, int(buckets)
        self.tie_breaker = tie_breaker
        extra = [tie_breaker] if tie_breaker else []
        self.columns = [c for c in dict.fromkeys([*columns, *extra]) if c not in (*keys, ts)]
        if "_bucket" in (*self.keys, ts, *self.columns):
            raise ValueError("_bucket is the table's own column")

    # ---- commits ----------------------------------------------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def head(self) -> Commit:
        """The newest commit; an empty one for a new table."""
        fs, folder = self._fs(f"{self.path}/commits")
        if not fs.exists(folder):
            return Commit()
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        numbers = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
        if not numbers:
            return Commit()
        text = self.spark.read.text(f"{folder}/{max(numbers)}.json", wholetext=True).first()[0]
        c = json.loads(text)
        return Commit(c["number"], {int(b): p for b, p in c["places"].items()}, c["mark"], c["schema"], tuple(c["pushes"]))

    def _commit(self, c: Commit) -> Commit:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        fs, tmp = self._fs(f"{self.path}/commits/.{c.number}-{uuid.uuid4().hex}")
        out = fs.create(tmp, False)
        try:
            out.write(bytearray(json.dumps({**c.__dict__, "pushes": c.pushes[-KNOWN_PUSHES:]}).encode()))
        finally:
            out.close()
        target = jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits/{c.number}.json")
        no_options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(tmp.toUri(), conf).rename(tmp, target, no_options)
        except Exception as e:
            if fs.exists(target):
                raise TakenError(f"commit {c.number} of {self.path} is taken") from e
            raise
        return c

    # ---- reading ----------------------------------------------------------------------------------------------

    def _key_bucket(self):
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets))

    def _of(self, c: Commit, buckets=None) -> DataFrame:
        schema = StructType.fromJson(json.loads(c.schema))
        at = [f"{self.path}/data/{c.places[b]}/_bucket={b}" for b in sorted(c.places) if buckets is None or b in buckets]
        return self.spark.read.schema(schema).parquet(*at) if at else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        """All rows as of the newest commit."""
        c = self.head()
        if c.schema is None:
            raise LookupError(f"nothing was pushed to {self.path}")
        return self._of(c)

    def lookup(self, requests: DataFrame) -> DataFrame:
        """Every request row with the current values of its key (nulls if there are none).  Only files of buckets that
        some request falls into are read; request columns named like a value column are replaced by it."""
        c = self.head()
        if c.schema is None:
            raise LookupError(f"nothing was pushed to {self.path}")
        asked = requests.dropna(subset=self.keys).select(self._key_bucket().alias("b")).distinct()
        buckets = {r["b"] for r in asked.collect()}   # at most ``buckets`` rows
        return _with_values(requests, self._of(c, buckets), self.keys)

    # ---- writing ----------------------------------------------------------------------------------------------

    def push(self, rows: DataFrame, push_id: str, mark: str | None = None, tries: int = 5) -> Commit:
        """Merge ``rows`` and return the commit; known push ids and pushes without a row leave all buckets as they are.
        If another writer commits first, the merge is done again on what it left."""
        head = self.head()
        if push_id in head.pushes:
            return head
        cols = [*self.keys, self.ts, *self.columns]
        rows = rows.select(*cols) if head.schema is None else rows.select(
            *[F.col(f.name).cast(f.dataType) for f in StructType.fromJson(json.loads(head.schema))])
        # a hot key leaves each task as one row; what is left of the push is kept, so its source is read once
        newest = latest_per_key(rows.dropna(subset=[*self.keys, self.ts]), self.keys, self.ts, self.columns, self.tie_breaker)
        staged = scratch_path(self.spark, "push")
        newest.select(*cols, self._key_bucket().alias("_bucket")).write.parquet(staged)
        new = self.spark.read.parquet(staged)
        touched = {r["_bucket"] for r in new.select("_bucket").distinct().collect()}   # at most ``buckets`` rows
        schema = head.schema or new.drop("_bucket").schema.json()
        for left in range(tries, 0, -1):
            try:
                return self._merge(head, new, touched, push_id, mark, schema)
            except TakenError:
                if left == 1:
                    raise
                head = self.head()
                if push_id in head.pushes:
                    return head

    def _merge(self, head: Commit, new: DataFrame, touched: set[int], push_id: str, mark: str | None, schema: str) -> Commit:
        folder = f"{push_id}-{uuid.uuid4().hex[:12]}"
        if touched:
            if head.schema is not None:
                new = new.unionByName(self._of(head, touched).withColumn("_bucket", self._key_bucket()))
            # grouped by (bucket, keys) after dealing by bucket: one shuffle, one file a bucket
            dealt = new.repartition(len(touched), "_bucket")
            merged = latest_per_key(dealt, ["_bucket", *self.keys], self.ts, self.columns, self.tie_breaker)
            merged.write.partitionBy("_bucket").parquet(f"{self.path}/data/{folder}")
        marks = [m for m in (head.mark, mark) if m is not None]
        return self._commit(Commit(head.number + 1, {**head.places, **dict.fromkeys(sorted(touched), folder)},
                                   max(marks) if marks else None, schema, (*head.pushes, push_id)))

    def materialize(self, source: DataFrame, arrived: str, end: str) -> Commit:
        """Take in the rows of ``source`` with stored mark < ``arrived`` <= ``end`` (ISO dates or times of one width) and
        move the mark.  ``arrived`` says when a row came in and is the partition column of the source, so older partitions
        stay unread; a late row is in a new partition and corrects the table if it is newer than the key's row."""
        head = self.head()
        if head.mark is not None and end <= head.mark:
            return head
        return self.push(arrivals(source, arrived, head.mark, end), f"until-{_slug(end)}", mark=end)

    def vacuum(self, keep: int = 2) -> None:
        """Delete the commits before the newest ``keep`` and the folders none of the kept ones names.  Not beside a push
        or a reader of an older commit."""
        newest = self.head().number
        kept = []
        for n in range(max(1, newest - keep + 1), newest + 1):
            text = self.spark.read.text(f"{self.path}/commits/{n}.json", wholetext=True).first()[0]
            kept += json.loads(text)["places"].values()
        fs, folder = self._fs(f"{self.path}/commits")
        for s in fs.listStatus(folder):
            name = s.getPath().getName()
            if name.endswith(".json") and name[:-5].isdigit() and int(name[:-5]) <= newest - keep:
                fs.delete(s.getPath(), False)
        fs, folder = self._fs(f"{self.path}/data")
        for s in fs.listStatus(folder) if fs.exists(folder) else ():
            if s.getPath().getName() not in kept:
                fs.delete(s.getPath(), True)


def _slug(text: str) -> str:
    return "".join(ch if ch.isalnum() or ch in "-_" else "_" for ch in text)


def arrivals(source: DataFrame, arrived: str, start: str | None, end: str) -> DataFrame:
    """Rows with ``start`` < ``arrived`` <= ``end`` (no start: from the first)."""
    kind = source.schema[arrived].dataType
    rows = source.filter(F.col(arrived) <= F.lit(end).cast(kind))
    return rows if start is None else rows.filter(F.col(arrived) > F.lit(start).cast(kind))


def _with_values(requests: DataFrame, values: DataFrame, keys: list[str]) -> DataFrame:
    """Left join through the distinct keys asked for.  The values meet each key once; the requests of a hot key meet them
    in a second join, whose left side the engine may split."""
    named = [c for c in values.columns if c not in keys]
    found = requests.dropna(subset=keys).select(*keys).distinct().join(values, keys, "inner")
    return requests.drop(*named).join(found, keys, "left")


def publish_buckets(online: DataFrame, name: str, path: str, keys: list[str], buckets: int = 64) -> DataFrame:
    """Save an online table as catalog table ``name`` at ``path``, bucketed and sorted by its keys, and return it."""
    (online.repartition(buckets, *keys).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return online.sparkSession.table(name)


def bucketed_lookup(requests: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Every request row with the values of its key in a table of ``publish_buckets``: the distinct keys asked for are
    dealt to the table's buckets and the table itself isn't moved.  Null and unknown keys get nulls."""
    return _with_values(requests, requests.sparkSession.table(table).hint("merge"), keys)
