"""URL filters: host and path rules, and a Bloom filter cascade for listed keys.

The cascade answers "is this key listed?" without a join and without error for every key of its universe.  Level 1 is a
Bloom filter of the listed keys; level 2 one of the unlisted keys of the universe that level 1 takes for listed; level
3 one of the listed keys that level 2 takes for those; and so on until a level makes no mistakes.  A key is listed if
the first level that does not hold it is an even one, or no level is left after an odd number of them.

Built and applied with DataFrame functions only: bit positions come from xxhash64, words of 64 bits are or-ed together
by word number (partial aggregation first), and a level is one array of words.  Keys are dealt by hash into shards, so
that a shard's level never has more than ``shard_bits`` bits however long the list is: with one shard the levels are
scalar subqueries (constants inside the generated code), with more they are looked up by shard number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.registry import register, table
from ledgerlens.session import scratch_path

SHARD_BITS = 1 << 22                 # 512 kB a level and shard


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, paths that start with ``path`` (which starts with a slash)."""
    host: str
    path: str
    block: bool

    @property
    def name(self) -> str:
        return self.host + self.path


#: fixed values: the rules of the registered query
RULES = (Rule("net", "/", True), Rule("example.net", "/en/", False), Rule("example.com", "/de/", True),
         Rule("org", "/fr/", False))

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``.  Other letters keep their case."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _LETTERS, _LETTERS.lower()), path


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct<name, block> of the longest rule that fits, else null; of rules of one length the first."""
    out = F.lit(None)
    for r in sorted(rules, key=lambda r: len(r.name)):           # the longest becomes the outermost test
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.block).alias("block"))).otherwise(out)
    return out


def _hash(key: Column, seed: int) -> Column:
    return F.xxhash64(key, F.lit(seed))


def _bit(key: Column, level: int, k: int, bits: Column) -> Column:
    return F.pmod(_hash(key, 1000 * level + k), bits)


def _hits(key: Column, level: int, n_hashes: int, bits: Column, words: Column) -> Column:
    """The filter of ``level`` holds ``key``."""
    out = F.lit(True)
    for k in range(n_hashes):
        b = _bit(key, level, k, bits)
        word = F.get(words, F.floor(b / 64).cast("int"))
        out = out & F.coalesce(F.getbit(word, (b % 64).cast("int")) == 1, F.lit(False))
    return out


class Cascade:
    """A cascade written to a shared folder, one table a level: (shard, bits, words)."""

    def __init__(self, spark: SparkSession, paths: list[str], shards: int, n_hashes: list[int]):
        self.spark, self.paths, self.shards, self.n_hashes = spark, paths, shards, n_hashes

    def shard_of(self, key: Column) -> Column:
        return F.pmod(_hash(key, 7), F.lit(self.shards)).cast("int")

    def contains(self, df: DataFrame, key: Column, out: str) -> DataFrame:
        """``df`` with the boolean column ``out``: the key is listed.  Null keys are not."""
        levels = []
        if self.shards == 1:
            for path, h in zip(self.paths, self.n_hashes):
                one = lambda c: self.spark.read.parquet(path).select(c).scalar()  # noqa: B023, E731
                levels.append((h, one("bits"), one("words")))
            return df.withColumn(out, self._verdict(key, levels))
        # few rows of bounded size each: the engine joins them by shard and splits a shard that is asked for too often
        df = df.select(F.struct("*").alias("_row"), key.alias("_key")).withColumn("_shard", self.shard_of(F.col("_key")))
        for i, (path, h) in enumerate(zip(self.paths, self.n_hashes)):
            level = self.spark.read.parquet(path).select(F.col("shard").alias("_shard"),
                                                         F.struct("bits", "words").alias(f"_level{i}"))
            df = df.join(level, "_shard", "left").withColumn(
                f"_hit{i}", F.coalesce(_hits(F.col("_key"), i, h, F.col(f"_level{i}.bits"), F.col(f"_level{i}.words")),
                                       F.lit(False))).drop(f"_level{i}")
        hits = [F.col(f"_hit{i}") for i in range(len(self.paths))]
        return df.withColumn("_out", self._fold(hits)).select("_row.*", F.col("_out").alias(out))

    def _verdict(self, key: Column, levels) -> Column:
        return F.coalesce(self._fold([_hits(key, i, h, bits, words) for i, (h, bits, words) in enumerate(levels)]),
                          F.lit(False)) & key.isNotNull()

    @staticmethod
    def _fold(hits: list[Column]) -> Column:
        out = F.lit(len(hits) % 2 == 1)
        for i in range(len(hits) - 1, -1, -1):
            out = F.when(hits[i], out).otherwise(F.lit(i % 2 == 1))
        return out


def build_cascade(keys: DataFrame, key_col: str = "key", listed_col: str = "listed", shard_bits: int = SHARD_BITS,
                  hashes: int = 3) -> Cascade:
    """The cascade over a universe of keys (``listed``: boolean).

    Null keys take no part; a repeated key is listed if one of its rows says so; an empty universe gives no levels, and
    then no key is listed.
    """
    spark = keys.sparkSession
    path = scratch_path(spark, "url-universe")
    (keys.filter(F.col(key_col).isNotNull()).groupBy(F.col(key_col).alias("key"))
     .agg(F.max(F.coalesce(F.col(listed_col), F.lit(False))).alias("listed")).write.parquet(path))
    universe = spark.read.parquet(path)
    n = universe.filter("listed").count()
    # bits a key: three hashes at load 1/4 let about 2 % through
    per_key = max(1, round(hashes / 0.29))
    shards = max(1, -(-n * per_key // shard_bits))
    cascade = Cascade(spark, [], shards, [])
    universe = universe.withColumn("shard", cascade.shard_of(F.col("key")))
    inside = universe.filter("listed")                   # keys this level has to hold
    outside = universe.filter("NOT listed")
    while inside.limit(1).count():
        level = len(cascade.paths)
        path = scratch_path(spark, f"url-level{level}")
        _write_level(inside, level, hashes, per_key, path)
        cascade.paths.append(path)
        cascade.n_hashes.append(hashes)
        rows = spark.read.parquet(path)
        wrong_path = scratch_path(spark, f"url-wrong{level}")
        if shards == 1:
            bits, words = (rows.select(c).scalar() for c in ("bits", "words"))
            wrong = outside.filter(_hits(F.col("key"), level, hashes, bits, words))
        else:
            wrong = (outside.join(rows, "shard").filter(_hits(F.col("key"), level, hashes, F.col("bits"), F.col("words")))
                     .select(*outside.columns))
        wrong.write.parquet(wrong_path)
        inside, outside = spark.read.parquet(wrong_path), inside
    return cascade


def _write_level(inside: DataFrame, level: int, hashes: int, per_key: int, path: str) -> None:
    """One row (shard, bits, words) for each shard with keys; words is a dense array, so at most ``bits`` / 64 longs."""
    sizes = inside.groupBy("shard").agg((F.ceil(F.count(F.lit(1)) * per_key / 64) * 64).cast("bigint").alias("bits"))
    sizes_path = path + "-sizes"
    sizes.write.parquet(sizes_path)
    sizes = inside.sparkSession.read.parquet(sizes_path)
    bit = F.explode(F.array(*(_bit(F.col("key"), level, k, F.col("bits")) for k in range(hashes))))
    set_words = (inside.join(sizes, "shard").select("shard", bit.alias("b"))
                 .groupBy("shard", F.floor(F.col("b") / 64).alias("word"))
                 .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("b") % 64).cast("int"))).alias("v")))
    no_words = sizes.select("shard", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                        (F.col("bits") / 64 - 1).cast("bigint"))).alias("word"), F.lit(0).cast("bigint").alias("v"))
    (set_words.union(no_words.select("shard", "word", "v")).groupBy("shard", "word").agg(F.bit_or("v").alias("v"))
     .groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("word", "v"))).alias("w"))
     .select("shard", F.transform("w", lambda x: x["v"]).alias("words")).join(sizes, "shard")
     .select("shard", "bits", "words").write.parquet(path))


def judge_urls(df: DataFrame, cascade: Cascade, rules=RULES, url_col: str = "url") -> DataFrame:
    """``df`` with host, path, rule, listed and verdict.

    Verdict: the rule's if one fits, else ``block`` for a listed key (host and path), else ``allow``.  A null url, or
    one without ``://``, has empty host and path, no rule and no key: ``allow``.  Columns of those names are replaced.
    """
    host, path = host_and_path(F.col(url_col))
    keep = [c for c in df.columns if c not in ("host", "path", "rule", "listed", "verdict")]
    df = (df.select(*keep, host.alias("host"), path.alias("path"))
          .withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules)))
    df = cascade.contains(df, url_key(F.col("host"), F.col("path")), "listed")
    blocked = F.coalesce(F.col("rule.block"), F.col("listed"))
    return df.select(*keep, "host", "path", F.col("rule.name").alias("rule"), "listed",
                     F.when(blocked, F.lit("block")).otherwise(F.lit("allow")).alias("verdict"))


def url_key(host: Column, path: Column) -> Column:
    return F.when(host != "", F.concat(host, path))


def tracked(url: Column) -> Column:
    """The url carries a campaign or referrer parameter."""
    return F.coalesce(F.rlike(url, F.lit(r"[?&](utm_[a-z]+|ref)=")), F.lit(False))


def tracked_keys(pages: DataFrame) -> DataFrame:
    """The list of the registered query, over the complete key universe of the pages: a key (host and path) is listed
    if it was reached through a tracking link."""
    host, path = host_and_path(F.col("url"))
    return pages.select(url_key(host, path).alias("key"), tracked(F.col("url")).alias("listed"))


OP2_SQL = r"""
WITH p AS (SELECT page_id, url, CASE WHEN coalesce(instr(url, '://'), 0) > 0
                                     THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r AS (SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
                     WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
                     WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
                     WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM h),
l AS (SELECT *, host <> '' AND coalesce(bool_or(regexp_matches(url, '[?&](utm_[a-z]+|ref)='))
                                        OVER (PARTITION BY host || path), FALSE) AS listed FROM r)
SELECT page_id, host, path, rule, listed,
       CASE WHEN rule IN ('net/', 'example.com/de/') OR (rule IS NULL AND listed) THEN 'block' ELSE 'allow' END AS verdict
FROM l
"""


@register("op2_url_cascade", OP2_SQL)
def op2_url_cascade(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, build_cascade(tracked_keys(pages))).drop("url")
