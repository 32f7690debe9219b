"""Near-duplicates by an LSH forest over MinHash signatures.

Steps, each a Spark job over the output of the one before (kept in the shared folder):

1. One pass over the texts: distinct word shingles as 64-bit hashes, their number, a 128-bit fingerprint of the set and
   a signature of 128 minima.
2. Documents with equal sets are one class; its smallest id stands for it from here on.
3. The forest: ``TREES`` orders of the signature's places.  In each order the classes are sorted by their signature;
   a region is a run with a common prefix of ``DEPTHS[0]`` values.  Regions of more than ``REGION`` members are cut by
   longer and longer prefixes, so the depth adapts to how crowded a region is.
4. Neighbours within a region whose signatures agree often enough (5 standard deviations below the threshold) are
   tied together; ties that close over all regions give families.  No link is tested here, and only the ties that
   span a region are kept, never all its pairs.
5. Links are confirmed on the full shingle sets: inside a family if it is small, else first inside every region of its
   members.  Each is a breadth-first walk that compares one set with all that are not yet reached.
6. What the cuts keep apart is tested as well: in a crowded region all pairs of different families (signatures, before
   step 5), in a large family all pairs of different components (full sets, after it).  ``crossing`` deals them into
   tasks of two blocks of about ``REGION`` members; members that are joined already are not compared again.

So a pair is missed only if no tree brings it into one region of ``DEPTHS[0]`` places, or its signatures disagree by
chance (``least_agreement``): (1 - s^5)^24 is 1 in 1,300,000 at s = 0.85, 1 in 14,000 at s = 0.80.  The deeper cuts only
save work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.arrays import U64, batch_shingles, mix64, release_memory
from ledgerlens.llm.components import connected_components
from ledgerlens.llm.registry import register, table
from ledgerlens.session import scratch_path

PLACES = 128
TREES = 24
DEPTHS = (5, 7, 10, 15, 25, 50, PLACES)
REGION = 1024                        # members of a region or family that are compared in one task
FAMILY_SHINGLES = 4_000_000          # and their shingles
_MASKS = mix64(np.arange(1, 2 * PLACES + 1, dtype=U64))
_XOR, _MUL = _MASKS[:PLACES], _MASKS[PLACES:] | U64(1)
_ORDERS = [np.random.default_rng(1000 + t).permutation(PLACES) for t in range(TREES)]


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Minima (documents x places, uint32) of the shingle sets; a document without shingles has zeros."""
    out = np.zeros((len(bounds) - 1, PLACES), np.uint32)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        starts = bounds[full]
        for k in range(PLACES):
            out[full, k] = np.minimum.reduceat(((hashes ^ _XOR[k]) * _MUL[k]) >> U64(32), starts)
    return out


def prefix_keys(sig: np.ndarray, tree: int, depth: int) -> np.ndarray:
    """A 64-bit key of the first ``depth`` places of each signature in the order of a tree."""
    h = np.full(len(sig), tree * 1000 + depth, U64)
    for place in _ORDERS[tree][:depth]:
        h = mix64(h * U64(0x9E3779B97F4A7C15) + sig[:, place])
    return h.view(np.int64)


def least_agreement(similarity: float) -> int:
    """Places in which two sets of that similarity agree, but for chances of about 1 in 5 million."""
    return int(PLACES * similarity - 5.1 * (PLACES * similarity * (1 - similarity)) ** 0.5)


# ---------------------------------------------------------------------------------------------- Spark steps


def sketch_documents(df: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(id, n, f1, f2, sig) of every row."""
    src = df.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for i, j, hashes, bounds in batch_shingles(b.column(1), k):
                n = np.diff(bounds)
                sums = [np.append(U64(0), np.cumsum(h)) for h in (hashes, mix64(hashes ^ U64(0xABCDEF)))]
                f1, f2 = ((s[bounds[1:]] - s[bounds[:-1]]).view(np.int64) for s in sums)
                sig = signatures(hashes, bounds)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(n), pa.array(f1), pa.array(f2), _binary(sig)],
                    names=["id", "n", "f1", "f2", "sig"])
        release_memory()

    return src.mapInArrow(run, "id bigint, n bigint, f1 bigint, f2 bigint, sig binary")


def _binary(rows: np.ndarray) -> pa.Array:
    """A binary column of the rows of a contiguous matrix."""
    width = rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [
        None, pa.py_buffer(np.arange(0, (len(rows) + 1) * width, width, dtype=np.int32).tobytes()
                           if len(rows) else np.zeros(1, np.int32).tobytes()), pa.py_buffer(rows.tobytes())])


def _matrix(column: pa.Array, kind) -> np.ndarray:
    if not len(column):
        return np.zeros((0, PLACES), kind)
    at = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0]:at[-1]].view(kind).reshape(len(column), PLACES)


def forest_entries(classes: DataFrame, depth: int) -> DataFrame:
    """(id, tree, key) of every class in every tree, at a depth."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            sig = _matrix(b.column(1), "<u4")
            for t in range(TREES):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(np.full(b.num_rows, t, np.int32)), pa.array(prefix_keys(sig, t, depth))],
                    names=["id", "tree", "key"])
    return classes.select("id", "sig").mapInArrow(run, "id bigint, tree int, key bigint")


def deeper_entries(crowded: DataFrame, classes: DataFrame, depth: int) -> DataFrame:
    """(id, tree, parent, key) at a deeper depth of the members (id, tree, parent) of crowded regions."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            sig, tree = _matrix(b.column(3), "<u4"), b.column(1).to_numpy()
            key = np.zeros(len(tree), np.int64)
            for t in np.unique(tree):
                key[tree == t] = prefix_keys(sig[tree == t], t, depth)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(key)],
                                             names=["id", "tree", "parent", "key"])
    rows = crowded.join(classes.select("id", "sig"), "id").select("id", "tree", "parent", "sig")
    return rows.mapInArrow(run, "id bigint, tree int, parent bigint, key bigint")


def _dealt(rows: DataFrame, level: int) -> DataFrame:
    """(region, id) of groups (tree, key) of n rows, in parts of about ``REGION`` that share the group's least id."""
    parts = F.ceil(F.col("n") / REGION)
    region = lambda p: F.xxhash64("tree", F.lit(level), "key", p.cast("bigint")).alias("region")
    shared = (rows.filter(F.col("n") > REGION).select("tree", "key", "n", F.col("least").alias("id")).distinct()
              .withColumn("p", F.explode(F.sequence(F.lit(0).cast("bigint"), parts.cast("bigint") - 1))))
    return (rows.select(region(F.pmod(F.xxhash64("id"), parts)), "id")
            .union(shared.select(region(F.col("p")), "id")))


def forest_regions(classes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(region, id): the members of every region of two or more, none with many more than ``REGION``; and (grp, id) of
    the regions that were cut, or None.

    A crowded region is cut by the next depth into smaller ones, and one member of each of those (its smallest id; a
    member that is alone stands for itself) forms a region, too: so the pieces of a crowd stay in touch, as neighbours
    in the sorted order would.  Where even whole signatures are shared by more than ``REGION`` (their sets are all but
    equal), or a crowd falls into more pieces than that, the members are dealt into parts that share the smallest id.
    """
    spark = classes.sparkSession
    out, entries, cut = [], forest_entries(classes, DEPTHS[0]), None
    for level, depth in enumerate(DEPTHS):
        sums = [F.count(F.lit(1)).alias("n"), F.min("id").alias("least")]
        counts = entries.groupBy("tree", "key").agg(*sums, *([F.min("parent").alias("parent")] if level else []))
        path = scratch_path(spark, f"regions{level}")
        if level:
            pieces = counts.select("tree", F.col("parent").alias("key"), F.col("least").alias("id"))
            sizes = pieces.groupBy("tree", "key").agg(*sums)
            pieces.join(sizes.filter("n >= 2"), ["tree", "key"]).write.parquet(path + "-pieces")
            out.append(_dealt(spark.read.parquet(path + "-pieces"), -level))
        entries.join(counts.filter("n >= 2").drop("parent"), ["tree", "key"]).write.parquet(path)
        members = spark.read.parquet(path)
        crowded = members.filter(F.col("n") > REGION)
        if depth == PLACES or not crowded.limit(1).count():
            out.append(_dealt(members, level))
            break
        out.append(_dealt(members.filter(F.col("n") <= REGION), level))
        if not level:
            cut = crowded.select(F.xxhash64("tree", "key").alias("grp"), "id")
        entries = deeper_entries(crowded.select("id", "tree", F.col("key").alias("parent")), classes, DEPTHS[level + 1])
    regions = out[0]
    for more in out[1:]:
        regions = regions.union(more)
    return regions, cut


def crossing(members: DataFrame) -> DataFrame:
    """(task, side, part, id): tasks that bring together all pairs of different parts of a group.

    ``members`` has (grp, id, part, n), n the shingles of the id.  The largest part of a group needs no test inside, so
    the others are dealt into blocks of about ``REGION`` members (and ``FAMILY_SHINGLES``), and so is the largest; a
    task is one block of the others against itself (one side) or against another block.  Groups of one part are left out.
    """
    parts = members.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("ids"), F.sum("n").alias("n"))
    groups = (parts.groupBy("grp").agg(F.count(F.lit(1)).alias("parts"), F.sum("ids").alias("ids"), F.sum("n").alias("n"),
                                       F.max(F.struct("ids", "n", "part")).alias("top")).filter("parts >= 2"))
    blocks = lambda ids, n: F.greatest(F.ceil(ids / REGION), F.ceil(n / FAMILY_SHINGLES), F.lit(1)).cast("bigint")
    groups = groups.select("grp", F.col("top.part").alias("top"),
                           blocks(F.col("ids") - F.col("top.ids"), F.col("n") - F.col("top.n")).alias("few"),
                           blocks(F.col("top.ids"), F.col("top.n")).alias("rest"))
    rows = members.select("grp", "id", "part").join(groups, "grp")
    at, is_top = F.xxhash64(F.lit("block"), "id"), F.col("part") == F.col("top")
    rows = rows.withColumn("block", F.when(is_top, F.col("few") + F.pmod(at, F.col("rest"))).otherwise(F.pmod(at, F.col("few"))))
    last = F.when(is_top, F.col("few")).otherwise(F.col("few") + F.col("rest")) - 1
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    return rows.select(F.xxhash64("grp", F.least("block", "other"), F.greatest("block", "other")).alias("task"),
                       (F.col("block") > F.col("other")).cast("int").alias("side"), "part", "id")


def _by_group(batches: Iterator[pa.RecordBatch], most_rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Batches that end where a value of the first column ends (rows come sorted by it)."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        key = b.column(0).to_numpy()
        if not len(key):
            continue
        last = int(np.searchsorted(key, key[-1]))
        if last and held or held and held[-1].column(0)[-1].as_py() != key[0]:
            head = pa.concat_batches([*held, b.slice(0, last)])
            held = [b.slice(last)]
            yield head
        elif last:
            held = [b.slice(last)]
            yield b.slice(0, last)
        else:
            held.append(b)
    if held:
        yield pa.concat_batches(held)


def _starts(key: np.ndarray) -> np.ndarray:
    return np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))


def tied_pairs(regions: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """(a, b): ties that span, within each region, the classes whose signatures agree in ``least`` places or more."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in _by_group(batches):
            region, ids, sketch = b.column(0).to_numpy(), b.column(1).to_numpy(), _matrix(b.column(2), np.uint8)
            starts = _starts(region)
            size = np.diff(starts)
            left, right = [], []
            pair = starts[:-1][size == 2]
            for part in np.array_split(pair, max(1, len(pair) // 20_000)):
                hit = part[(sketch[part] == sketch[part + 1]).sum(1) >= least]
                left.append(ids[hit])
                right.append(ids[hit + 1])
            for g in np.flatnonzero(size > 2):
                order = starts[g] + np.argsort(ids[starts[g]:starts[g + 1]])
                own, sk = ids[order], sketch[order]
                for a, rest in walk(len(own), lambda i, rest: (sk[rest] == sk[i]).sum(1) >= least):  # noqa: B023
                    left.append(np.full(len(rest), own[a]))
                    right.append(own[rest])
            a, c = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, c)), pa.array(np.maximum(a, c))], names=["a", "b"])

    low_bytes = _low_bytes(classes)
    rows = regions.join(low_bytes, "id").select("region", "id", "sketch")
    return thinned(rows.repartition("region").sortWithinPartitions("region").mapInArrow(run, "a bigint, b bigint"))


def thinned(links: DataFrame) -> DataFrame:
    """Fewer links (a, b) with the same components: each b stays with its smallest a, and its other ones are linked with
    that a instead of b.

    The roots of a large family differ from region to region, so its members come with up to a root a tree; the links
    among those few roots are mostly the same ones.  Needs a < b, where b has no more links than it has regions."""
    first = F.min("a").over(Window.partitionBy("b"))
    links = links.filter("a <> b").select("a", "b", first.alias("first"))
    return links.select(F.col("first").alias("a"), F.when(F.col("a") == F.col("first"), F.col("b")).otherwise(F.col("a"))
                        .alias("b")).distinct()


def _low_bytes(classes: DataFrame) -> DataFrame:
    """(id, sketch): the lowest byte of every place of the signature."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _binary(_matrix(b.column(1), "<u4").astype(np.uint8))],
                                             names=["id", "sketch"])
    return classes.select("id", "sig").mapInArrow(run, "id bigint, sketch binary")


def walk(n: int, linked) -> Iterator[tuple[int, np.ndarray]]:
    """(root, nodes that can be reached from it), in pieces; ``linked(i, rest)`` tells which of ``rest`` i links to.

    The root is the first node of its component, so with ascending ids the same few roots come up in all regions.
    """
    rest = np.arange(n)
    while len(rest):
        root, rest = int(rest[0]), rest[1:]
        queue = [root]
        while queue and len(rest):
            hit = linked(queue.pop(), rest)
            if hit.any():
                yield root, rest[hit]
                queue += rest[hit].tolist()
                rest = rest[~hit]


def walk_across(side: np.ndarray, part: np.ndarray, linked) -> Iterator[tuple[int, int]]:
    """Linked nodes of different parts, each pair of which joins two parts; ``part`` is overwritten.

    Pairs of one node of either side are tested, or all if there is one side only.
    """
    one = side.min() == side.max()
    for i in np.flatnonzero(side == side.min()):
        rest = np.flatnonzero((part != part[i]) & ((np.arange(len(side)) > i) if one else (side != side[i])))
        hit = rest[linked(i, rest)] if len(rest) else rest
        for j in hit:
            if part[j] != part[i]:
                part[part == part[j]] = part[i]
                yield int(i), int(j)


def set_links(sets: list[np.ndarray], percent: int):
    """A function (i, rest): which sets of ``rest`` have 100 * intersection >= percent * union with set i."""
    size = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    names, flat = np.unique(flat, return_inverse=True)
    bounds = np.append(0, np.cumsum(size))
    mark = np.zeros(len(names), bool)

    def linked(i: int, rest: np.ndarray) -> np.ndarray:
        near = (100 * np.minimum(size[rest], size[i]) >= percent * np.maximum(size[rest], size[i])) & (size[rest] > 0)
        out = np.zeros(len(rest), bool)
        mine = flat[bounds[i]:bounds[i + 1]]
        mark[mine] = True
        for at in np.flatnonzero(near):
            j = rest[at]
            both = int(np.count_nonzero(mark[flat[bounds[j]:bounds[j + 1]]]))
            out[at] = 100 * both >= percent * (size[i] + size[j] - both)
        mark[mine] = False
        return out

    return linked


def confirmed(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(id, ids that links reach from it): links are 100 * intersection >= percent * union, compared in full."""
    for a, rest in walk(len(ids), set_links(sets, percent)):
        yield ids[a], ids[rest]


def confirmed_links(groups: DataFrame, percent: int, k: int) -> DataFrame:
    """(a, b): confirmed links that span each group; ``groups`` has (grp, id, text), a bounded number of rows a group."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in _by_group(batches):
            key, ids = b.column(0).to_numpy(), b.column(1).to_numpy()
            starts, left, right = _starts(key), [], []
            for s, e in zip(starts[:-1], starts[1:]):
                if e - s < 2:
                    continue
                sets = []
                for _, _, hashes, bounds in batch_shingles(b.column(2).slice(s, e - s), k):
                    sets += [hashes[x:y] for x, y in zip(bounds[:-1], bounds[1:])]
                order = np.argsort(ids[s:e], kind="stable")
                for a, rest in confirmed(ids[s:e][order], [sets[i] for i in order], percent):
                    left.append(np.full(len(rest), a))
                    right.append(rest)
            a, c = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c)], names=["a", "b"])
        release_memory()
    return (groups.repartition("grp").sortWithinPartitions("grp").select("grp", "id", "text")
            .mapInArrow(run, "a bigint, b bigint"))


def _across(rows: DataFrame, value: str, linker) -> DataFrame:
    """(a, b): links that join parts, of the tasks of ``crossing`` with a column ``value``; ``linker`` makes
    ``linked(i, rest)`` of an array of its values."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in _by_group(batches):
            task, side, part, ids = (b.column(i).to_numpy() for i in range(4))
            starts, left, right = _starts(task), [], []
            for s, e in zip(starts[:-1], starts[1:]):
                own = part[s:e].copy()
                if (own == own[0]).all():
                    continue
                for i, j in walk_across(side[s:e], own, linker(b.column(4).slice(s, e - s))):
                    left.append(ids[s + i])
                    right.append(ids[s + j])
            yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.int64)) for x in (left, right)], names=["a", "b"])
        release_memory()
    return (rows.select("task", "side", "part", "id", value).repartition("task").sortWithinPartitions("task")
            .mapInArrow(run, "a bigint, b bigint"))


def crossing_ties(cut: DataFrame, families: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """(a, b): ties of classes of one crowded region (grp, id) that are in different families (id, component)."""
    def linker(column: pa.Array):
        sk = _matrix(column, np.uint8)
        return lambda i, rest: (sk[rest] == sk[i]).sum(1) >= least

    part = F.coalesce("component", "id").alias("part")
    members = cut.join(families, "id", "left").select("grp", "id", part, F.lit(0).alias("n"))
    return _across(crossing(members).join(_low_bytes(classes), "id"), "sketch", linker)


def crossing_links(members: DataFrame, texts: DataFrame, percent: int, k: int) -> DataFrame:
    """(a, b): confirmed links of ``members`` (grp, id, part, n) of one group in different parts; texts has (id, text)."""
    def linker(column: pa.Array):
        sets = []
        for _, _, hashes, bounds in batch_shingles(column, k):
            sets += [hashes[x:y] for x, y in zip(bounds[:-1], bounds[1:])]
        return set_links(sets, percent)

    return _across(crossing(members).join(texts, "id"), "text", linker)


def near_duplicates(df: DataFrame, percent: int = 80, k: int = 5, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row: documents with 100 * |A & B| >= percent * |A | B| are linked.

    ``component_id`` is the smallest id that links reach, ``kept`` tells whether it is the row's own.  Null and empty
    texts, and texts of white space, have no shingles and are linked with nothing.  A row without an id is its own
    component (null) and kept.  Rows with one id count as one document with the links of all its texts.  An empty table
    gives an empty result; other columns are not read.
    """
    spark = df.sparkSession

    def kept(frame: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    docs = kept(sketch_documents(df, id_col, text_col, k), "signatures")
    known = docs.filter("n > 0 AND id IS NOT NULL")
    members = kept(known.groupBy("n", "f1", "f2").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("docs")), "classes")
    classes = kept(members.select("id", "n", "f1", "f2").join(known.select("id", "n", "f1", "f2", "sig"),
                                                               ["id", "n", "f1", "f2"])
                   .select("id", "n", "sig").dropDuplicates(["id", "n", "sig"]), "class-signatures")
    regions, cut = forest_regions(classes)
    least = least_agreement(percent / 100)
    ties = tied_pairs(regions, classes, least)
    if cut is not None:
        ties = kept(ties, "ties")
    families = connected_components(ties)
    if cut is not None:
        more = kept(crossing_ties(cut, families, classes, least), "crossing-ties")
        if more.limit(1).count():
            families = connected_components(ties.union(more))
    families = families.join(classes.groupBy("id").agg(F.sum("n").alias("n")), "id")
    weight = families.groupBy("component").agg(F.count(F.lit(1)).alias("ids"), F.sum("n").alias("shingles"))
    small = (F.col("ids") <= REGION) & (F.col("shingles") <= FAMILY_SHINGLES)
    families = kept(families.join(weight.select("component", small.alias("small")), "component")
                    .select("id", "component", "small", "n"), "families")
    texts = df.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    large = families.filter("NOT small")
    has_large = large.limit(1).count() > 0
    found = texts.join(families, "id")
    links = confirmed_links(found.filter("small").select(F.col("component").alias("grp"), "id", "text"), percent, k)
    if has_large:
        inside = regions.join(large.select("id"), "id").select(F.col("region").alias("grp"), "id")
        big = kept(found.filter("NOT small").select("id", "text"), "large-family-texts")
        links = kept(thinned(links.union(confirmed_links(inside.join(big, "id").select("grp", "id", "text"), percent, k))), "links")
    components = connected_components(links)
    if has_large:
        joined = components.withColumnRenamed("component", "part")
        apart = (large.join(joined, "id", "left")
                 .select(F.col("component").alias("grp"), "id", F.coalesce("part", "id").alias("part"), "n"))
        more = kept(crossing_links(apart, big, percent, k), "crossing-links")
        if more.limit(1).count():
            components = connected_components(links.union(more))
    return _assigned(docs, members, components)


def _assigned(docs: DataFrame, members: DataFrame, components: DataFrame) -> DataFrame:
    """Give every document its class's component.

    Classes that hold more than a thousandth of the documents (fewer than 1000, whatever the input) are broadcast; the
    rest have few enough documents each to be shuffled.  Documents already answered go under a key of their own.
    """
    total = docs.agg(F.count(F.lit(1)).alias("c")).collect()[0]["c"]
    classes = (members.join(components, "id", "left")
               .select("n", "f1", "f2", "docs", F.coalesce("component", "id").alias("component")))
    path = scratch_path(docs.sparkSession, "class-components")
    classes.write.parquet(path)
    classes = docs.sparkSession.read.parquet(path)
    often = F.col("docs") * 1000 > total
    hot = classes.filter(often).select("n", "f1", "f2", F.col("component").alias("c1"))
    rest = classes.filter(~often).select(F.col("n").alias("rn"), F.col("f1").alias("r1"), F.col("f2").alias("r2"),
                                         F.col("component").alias("c2"))
    out = docs.drop("sig").join(F.broadcast(hot), ["n", "f1", "f2"], "left")
    out = out.withColumn("c1", F.when((F.col("n") == 0) | F.col("id").isNull(), F.coalesce("id", F.lit(-1)))
                         .otherwise(F.col("c1")))
    alone = F.col("c1").isNotNull()
    out = (out.withColumn("k1", F.when(alone, F.xxhash64("id", "f1")).otherwise(F.col("f1")))
           .withColumn("kn", F.when(alone, F.lit(-1)).otherwise(F.col("n"))))
    out = out.join(rest, (F.col("kn") == F.col("rn")) & (F.col("k1") == F.col("r1")) & (F.col("f2") == F.col("r2")), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("c1", "c2"))
    return out.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      (F.col("id").isNull() | (F.col("id") == component)).alias("kept"))


OP9_PERCENT = 85

OP9_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                          'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                             lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
               ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * c >= {OP9_PERCENT} * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT e.b, r.c FROM r JOIN e ON r.doc_id = e.a)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id, r.doc_id = min(r.c) AS kept
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


@register("op9_lsh_forest", OP9_SQL)
def op9_lsh_forest(spark, sf_dir):
    out = near_duplicates(table(spark, sf_dir, "documents"), OP9_PERCENT)
    return out.withColumnRenamed("id", "doc_id")
