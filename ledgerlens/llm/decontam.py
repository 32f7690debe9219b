"""Benchmark decontamination by template canonicalisation.

Numbers, units and names of a text are replaced by typed placeholders, the rest is lower-cased and stripped of
punctuation; what is left is the text's template.  Windows of 8 template tokens of the documents are hash-joined to
those of the benchmark items; windows whose template has too few plain tokens are joined by their plain tokens, so they
are found word for word only.  For every alignment of a document with an item the values in the slots (the tokens
behind the placeholders) must be consistent: one value of the item always stands for one value of the document.  So an
item is found both as it is and re-parameterised, while a chance agreement of templates is not.  A document holds an
item if the windows of consistent alignments cover at least half of the item's windows, or of those with enough plain
tokens, or if one of them covers RUN consecutive tokens of it.  Items of fewer than SHORTEST tokens are found word for
word and marked, as such words may well stand there by chance.

All of it is DataFrame expressions.  Templates cost several passes over a text, so documents are sifted first by plain
tokens: of each item, more windows than a document may lack, and one in every so many consecutive ones, are given an
anchor (their rarest plain token), so a document without any anchor can't hold the item.  Two Bloom filters (bit arrays of
a checked size: constants of the plan) do that: one of the anchors sifts documents, one of the benchmark's windows sifts
the windows of those that are left inside their array, before rows are made of them.  Neither changes the result; if the
benchmark is too large for the checked size, the step is left out.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.registry import register, table
from ledgerlens.llm.url_filter import _hits, _write_level
from ledgerlens.session import scratch_path

WINDOW = 8                           # tokens; windows are built by doubling, so a power of two
SHORTEST = 5                         # an item with fewer tokens can't be told from ordinary text: found, and marked so
PLAIN = 4                            # tokens of a template's window that must not be placeholders
FILTER_BITS = 1 << 24
SAMPLE = 5000                        # documents that tell which words are rare
COVER = 0.5                          # share of an item's windows that makes a leak
RUN = 50                             # consecutive tokens of an item that make a leak, whatever their share
NUMBER, UNIT, NAME = "", "", ""
#: fixed values: words taken for units
UNITS = ("mm", "cm", "m", "km", "in", "inch", "inches", "ft", "feet", "foot", "yard", "yards", "mile", "miles", "mg", "g",
         "kg", "oz", "lb", "lbs", "pound", "pounds", "ton", "tons", "ml", "l", "liter", "liters", "litre", "litres",
         "gallon", "gallons", "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hr", "hour", "hours",
         "day", "days", "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "cent", "cents", "euro",
         "euros", "usd", "eur", "percent", "degree", "degrees", "mph", "kmh", "watt", "watts", "meter", "meters",
         "metre", "metres")
_NAME_RE = r"(?<=[\p{Ll}\p{Nd},;:)] )\p{Lu}[\p{L}'’-]*"
_NUMBER_RE = r"(?<!\S)[(\[\"'$€£+-]*\d[\d.,:/%-]*[)\]\"'.,;:!?%]*(?!\S)"
# a unit counts as one only behind a number
_UNIT_RE = rf"(?<=[{NUMBER}0-9] )(?:{'|'.join(UNITS)})(?=[.,;:!?)]*(?:\s|$))"
_MARKS = ".,;:!?\"'()[]{}“”‘’«»…¿¡"


def _without_marks(text: Column) -> Column:
    return F.regexp_replace(text, "[" + re.escape(_MARKS) + "]+", "")


def _bare(text: Column) -> Column:
    """Lower case without punctuation marks."""
    return _without_marks(F.lower(text))


def _split(text: Column) -> Column:
    """Tokens between white space; none of an empty text."""
    return F.array_remove(F.split(text, r"\s+"), "")


def _quick(text: Column) -> Column:
    """The plain tokens of a text and some empty ones; cheaper than ``plain_tokens``."""
    text = _bare(text)
    for c in "\n\t\r\f\v":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.split(text, " ")


def plain_tokens(text: Column) -> Column:
    return _split(_bare(text))


def template_tokens(text: Column) -> Column:
    """As many tokens as ``plain_tokens``, numbers, units and names replaced by placeholders."""
    masked = F.regexp_replace(text, _NAME_RE, NAME)
    masked = F.regexp_replace(masked, _NUMBER_RE, NUMBER)
    masked = F.regexp_replace(F.lower(masked), _UNIT_RE, UNIT)
    return _split(_without_marks(masked))


def once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """``df`` with a column that is computed once a row: the optimizer doesn't copy an expression past a generator."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def with_windows(df: DataFrame, tokens: str, name: str, length: int = WINDOW) -> DataFrame:
    """``df`` with the hash of the window that starts at each token; the last ones are cut off."""
    df, k = once(df, F.transform(tokens, lambda t: F.xxhash64(t)), f"{name}1"), 1
    while k < length:
        h = F.col(f"{name}{k}")
        k *= 2
        df = once(df, F.zip_with(h, F.slice(h, k // 2 + 1, F.size(h)), lambda x, y: F.xxhash64(x, y)),
                  f"{name}{k}").drop(f"{name}{k // 2}")
    return once(df, F.slice(f"{name}{k}", 1, F.greatest(F.size(tokens) - (length - 1), F.lit(0))), name).drop(f"{name}{k}")


def short_hash(tokens: Column) -> Column:
    """Hash of a whole short token list."""
    return F.xxhash64(F.lit("whole"), F.array_join(tokens, " "))


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(key, item, at, template, own, plain, windows, typed): the windows of every item.

    An item of fewer than WINDOW tokens is one window of its own length.  ``plain``: the template has enough plain
    tokens (``typed`` of the item's ``windows``); else, and for items of fewer than SHORTEST tokens, the window's own
    tokens stand for its template.  A capital at the start of an item is no name there, but is one behind a document's
    words: the first window has that key, too.
    """
    src = items.select(F.col(id_col).cast("bigint").alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    src = once(once(src, template_tokens(F.col("text")), "t"), plain_tokens(F.col("text")), "p")
    src = src.filter(F.size("t") > 0)
    behind = template_tokens(F.concat(F.lit("x "), F.regexp_replace("text", r"^\s+", "")))
    src = once(src, F.slice(behind, 2, WINDOW), "b")
    row = lambda at, key, template, own, exact: F.struct(
        at.alias("at"), key.alias("key"), template.alias("template"), own.alias("own"), F.lit(exact).alias("exact"))
    t, p, b = F.col("t"), F.col("p"), F.col("b")
    whole = F.array(row(F.lit(0), short_hash(t), t, p, False), row(F.lit(0), short_hash(p), p, p, True),
                    row(F.lit(0), short_hash(b), t, p, False))
    src = with_windows(with_windows(with_windows(src, "t", "h"), "p", "e"), "b", "f")
    cut = lambda h, first, exact: F.transform(h, lambda x, i: row(
        i, x, F.slice(first, i + 1, WINDOW), F.slice("p", i + 1, WINDOW), exact))
    rows = (once(src, F.when(F.size("t") < WINDOW, whole)
                 .otherwise(F.concat(cut("h", "t", False), cut("e", "p", True), cut("f", "t", False))), "w")
            .select("item", F.explode("w").alias("w")).select("item", "w.*"))
    enough = ((F.size(F.filter("template", lambda t: ~t.isin(NUMBER, UNIT, NAME))) >= F.lit(PLAIN))
              & (F.size("template") >= SHORTEST))
    path = scratch_path(items.sparkSession, "benchmark-windows")
    rows.filter(F.col("exact") | enough).distinct().write.parquet(path)
    rows = items.sparkSession.read.parquet(path)
    at = rows.groupBy("item", "at").agg(F.max(~F.col("exact")).alias("plain"))
    sizes = at.groupBy("item").agg(F.count(F.lit(1)).alias("windows"), F.count_if("plain").alias("typed"))
    return rows.join(at, ["item", "at"]).filter(F.col("exact") != F.col("plain")).drop("exact").join(sizes, "item")


def anchors(wanted: DataFrame, cover: float, sample: DataFrame) -> DataFrame | None:
    """(key): a plain token of more than (1 - cover) of every item's windows, and of its windows that have enough plain
    tokens, and of one in each half run of windows; None if an item has too few of them.

    A window of the latter kind offers the plain tokens of its template, the others are found by all their tokens.  Only
    tokens that no mask has touched count: of "U.S." behind a lower-case word the template keeps a rest, which no document
    has among its plain tokens.

    Each window offers the token that fewest documents of ``sample`` (text) have, of those the longest, and the windows
    with the rarest go first; so the sample has a say in how much is sifted out, never in what is found.
    """
    same = F.zip_with("template", "own", lambda t, o: F.when(t == o, t))
    plain = wanted.select("item", "windows", "typed", "plain", "at",
                          F.explode(F.array_distinct(F.array_compact(same))).alias("t"))
    seen = (sample.select(F.explode(F.array_distinct(_quick(F.col("text")))).alias("t"))
            .join(plain.select("t").distinct(), "t", "left_semi").groupBy("t").agg(F.count(F.lit(1)).alias("docs")))
    best = (plain.join(seen, "t", "left").groupBy("item", "windows", "typed", "plain", "at")
            .agg(F.min(F.struct(F.coalesce("docs", F.lit(0)).alias("n"), -F.length("t"), "t")).alias("a")))
    # one row a window of an item: as many as the item has tokens
    needs = [F.floor(F.col(c) * (1 - cover)) + 1 for c in ("windows", "typed")]
    first = [F.row_number().over(Window.partitionBy(*by).orderBy("a")) <= need
             for by, need in zip((["item"], ["item", "plain"]), needs)]
    # of any RUN tokens' windows in a row, all of one block are among them
    half = (RUN - WINDOW + 2) // 2
    blocks = F.when(F.col("windows") > RUN - WINDOW, F.floor(F.col("windows") / half)).otherwise(0)
    best = best.withColumn("block", F.when(F.floor(F.col("at") / half) < blocks, F.floor(F.col("at") / half)))
    one = F.col("block").isNotNull() & (F.row_number().over(Window.partitionBy("item", "block").orderBy("a")) == 1)
    path = scratch_path(sample.sparkSession, "anchors")
    (best.withColumn("any", first[0]).withColumn("same", F.col("plain") & first[1]).withColumn("one", one)
     .filter("any OR same OR one").write.parquet(path))
    best = sample.sparkSession.read.parquet(path)
    full = (best.groupBy("item", "windows", "typed")
            .agg(F.count_if("any").alias("n"), F.count_if("same").alias("m"), F.count_if("one").alias("o"))
            .filter((F.col("n") >= needs[0]) & ((F.col("typed") == 0) | (F.col("m") >= needs[1])) & (F.col("o") >= blocks)))
    if wanted.join(full, "item", "left_anti").limit(1).count():
        return None
    return best.select(F.col("a.t").alias("key")).distinct()


def sieve(keys: DataFrame, per_key: int):
    """A function Column -> Column: a Bloom filter of the keys, or None if it would be larger than FILTER_BITS."""
    n = keys.count()
    if not 0 < n * per_key <= FILTER_BITS:
        return None
    path = scratch_path(keys.sparkSession, "sieve")
    _write_level(keys.withColumn("shard", F.lit(0)), 0, 3, per_key, path)
    # a constant of at most FILTER_BITS / 8 bytes; array functions can't hold a subquery
    level = keys.sparkSession.read.parquet(path).select("bits", F.array_join("words", ",").alias("w")).collect()[0]
    bits, words = F.lit(level["bits"]), F.split(F.lit(level["w"]), ",").cast("array<bigint>")
    return lambda key: _hits(key, 0, 3, bits, words)


def longest_run(places: str) -> Column:
    """The most consecutive numbers among distinct ones."""
    start = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("now"), F.lit(0).alias("best"))

    def step(a, x):
        now = F.when(x == a["last"] + 1, a["now"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), now.alias("now"), F.greatest(a["best"], now).alias("best"))
    return F.aggregate(F.array_sort(places), start, step, lambda a: a["best"])


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", cover: float = COVER) -> DataFrame:
    """(id, item, windows, item_windows, cover, changed, run, short) of every document that holds an item.

    ``windows``: distinct windows of the item found in consistent alignments, ``item_windows``: all it has; or both
    without those that have too few plain tokens, where that is the larger share.  ``changed``: some slot has another value
    than in the item.  ``run``: the most consecutive tokens of the item in one alignment.  ``short``: the item has fewer
    than SHORTEST tokens; callers who don't want a document judged by such few words drop those rows.

    Null and empty texts hold nothing and are not held.  Every row is judged on its own: of rows with one id (null ids,
    too) that hold an item, the one with the largest share is returned; repeated items give a row each id.  Either table
    may be empty; other columns are not read.
    """
    spark = docs.sparkSession
    wanted = benchmark_windows(items, item_col, item_text_col)
    path = scratch_path(spark, "windows")
    wanted.write.parquet(path)
    wanted = spark.read.parquet(path)
    # as long an array of windows as the shortest items need: their lengths, at most three
    lengths = sorted(r[0] for r in wanted.select(F.size("template").alias("s")).filter(F.col("s") < WINDOW).distinct()
                     .collect())
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # rows that agree in id and text hold the same
    src = src.select(F.struct("id", F.xxhash64("text").alias("row")).alias("id"), "text")
    part = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-docs.count() // SAMPLE)))) == 0
    keys = anchors(wanted, cover, src.filter(part).select("text"))
    holds = sieve(keys, 128) if keys is not None else None
    if holds is not None:
        src = once(src, _quick(F.col("text")), "quick").filter(F.exists("quick", holds)).select("id", "text")
    src = once(src, template_tokens(F.col("text")), "t")
    at_key = lambda h, i, length: F.struct(i.alias("at"), h.alias("key"), F.lit(length).alias("length"))
    src = once(src, plain_tokens(F.col("text")), "p")
    src = with_windows(with_windows(src, "t", "h"), "p", "e")
    known = sieve(wanted.select("key").distinct(), 16)
    thin = (lambda a: F.filter(a, lambda x: known(x["key"]))) if known is not None else (lambda a: a)
    found = F.concat(*(thin(F.transform(c, lambda h, i: at_key(h, i, WINDOW))) for c in ("h", "e")))
    for length in lengths:
        for c in ("t", "p"):
            short = F.transform(F.sequence(F.lit(0), F.greatest(F.size(c) - length, F.lit(-1))), lambda i: at_key(
                short_hash(F.slice(c, i + 1, F.lit(length))), i, length))  # noqa: B023
            found = F.concat(found, thin(F.when(F.size(c) >= length, short).otherwise(F.array().cast(
                "array<struct<at:int,key:bigint,length:int>>"))))
    src = once(src, F.array_distinct(found), "hits").select("id", "hits", "p").filter(F.size("hits") > 0)
    src = once(src, F.transform("hits", lambda x: F.struct(x["at"].alias("at"), x["key"].alias("key"),
                                                           F.slice("p", x["at"] + 1, x["length"]).alias("mine"))), "h")
    hits = src.select("id", F.explode("h").alias("h")).select("id", F.col("h.at").alias("place"), "h.key", "h.mine")
    # equal keys of different tokens (a hash collision) differ in a plain token
    slot = lambda t: t.isin(NUMBER, UNIT, NAME)
    both = hits.join(wanted, "key").withColumn("pairs", F.zip_with(
        "template", F.arrays_zip("own", "mine"), lambda t, v: F.struct(t.alias("t"), v["own"].alias("a"), v["mine"].alias("b"))))
    both = both.filter(F.forall("pairs", lambda p: slot(p["t"]) | (p["a"] == p["b"])))
    both = both.withColumn("slots", F.filter("pairs", lambda p: slot(p["t"])))
    # one alignment has at most as many slots as the item has tokens
    aligned = (both.groupBy("id", "item", "windows", "typed", (F.col("place") - F.col("at")).alias("shift"))
               .agg(F.collect_set(F.struct("at", "plain")).alias("ats"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots")))
    values = F.transform("slots", lambda p: F.struct(p["t"], p["a"]))
    good = aligned.filter(F.size("slots") == F.size(F.array_distinct(values)))
    good = good.withColumn("changed", F.exists("slots", lambda p: p["a"] != p["b"])).withColumn("run", longest_run("ats.at"))
    by_item = (good.select("id", "item", "windows", "typed", "changed", "run", F.explode("ats").alias("w"))
               .groupBy("id", "item", F.col("windows").alias("all"), "typed")
               .agg(F.countDistinct("w.at").alias("n"), F.countDistinct(F.when(F.col("w.plain"), F.col("w.at"))).alias("m"),
                    F.max("changed").alias("changed"), F.max("run").alias("run")))
    share = lambda n, of: F.struct((F.col(n) / F.col(of)).alias("cover"), F.col(n).alias("windows"),
                                   F.col(of).alias("item_windows"))
    # greatest() skips a null
    by_item = by_item.withColumn("best", F.greatest(share("n", "all"), F.when(F.col("typed") > 0, share("m", "typed"))))
    # all windows of an item are of one width
    width = wanted.groupBy("item").agg(F.max(F.size("template")).alias("width"))
    by_item = by_item.join(width, "item").withColumn("run", (F.col("run") + F.col("width") - 1).cast("int"))
    kept = by_item.filter((F.col("best.cover") >= cover) | (F.col("run") >= RUN))
    kept = (kept.groupBy(F.col("id.id").alias("id"), "item", (F.col("width") < SHORTEST).alias("short"))
            .agg(F.max(F.struct("best", "run", "changed")).alias("m")))
    return kept.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "m.best.windows", "m.best.item_windows",
                       "m.best.cover", "m.changed", "m.run", "short")


@register("op10_template_leaks")
def op10_template_leaks(spark, sf_dir):
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
