"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence.

The incidence matrix is dealt to tasks by blocks of its columns (n-grams). Only the columns
that a size-derived bound asks for enter the product: in one order of all n-grams, two sets
of Jaccard similarity t or more have ``k`` in common among the first ``n - ceil(t n) + k``
n-grams of each; here ``k`` is a twentieth of n. The order puts n-grams seen often last, so
that passages of many documents seldom enter. Overlaps found in the blocks are summed per
pair, and pairs below the smaller ``k`` are dropped; what remains is counted over the whole
sets.

Documents of equal sets are one class. Columns of up to ``SHORT`` classes give all their
pairs. Longer ones first give pairs with the class that shares most, the centre of a group,
which link its members; then every pair whose documents are not in one component by then. So large groups don't give all their pairs, and no group is split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import components, mixed, saved, shingle_sets, slices

#: Kept n-grams of a task before it counts them, and the least count that it reports. With a
#: larger one, n-grams found seldom by each task are taken for rare in the end, however many tasks find them.
HELD, REPORTED = 4_000_000, 2
#: Classes of a column that gives all its pairs at once.
SHORT = 12
#: Classes of a block of the product, and of those the ones whose pairs are looked at together.
BLOCK, STRIP = 2048, 256
#: One part in so many of a set that a partner has among its first n-grams.
COMMON = 20


def fingerprint(grams: np.ndarray) -> int:
    """64 bits that stand for a whole set; 0 for the empty one."""
    total = mixed(grams + np.uint64(1)).sum(dtype=np.uint64, keepdims=True) ^ np.uint64(len(grams))
    return int(mixed(total).view(np.int64)[0]) if len(grams) else 0


def _reported(grams: np.ndarray) -> pa.RecordBatch:
    """The n-grams found ``REPORTED`` times, with counts; ``grams`` is sorted in place, as a copy would hold as much again."""
    grams.sort()
    first = grams[: max(0, len(grams) - REPORTED + 1)]
    values = np.unique(first[first == grams[REPORTED - 1 :]])
    counts = np.searchsorted(grams, values, "right") - np.searchsorted(grams, values)
    return pa.record_batch([pa.array(values.view(np.int64)), pa.array(counts)], ["gram", "n"])


def _often(texts: DataFrame, size: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The at most ``most`` n-grams seen most, with counts: an order only, results never depend on it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, seen = np.empty(HELD, np.uint64), 0, set()
        for batch in batches:
            for part in slices(batch, 0):
                for grams in shingle_sets(part.column(0), size):
                    mark = fingerprint(grams)
                    if mark in seen:
                        continue
                    if n + len(grams) > len(held):
                        yield _reported(held[:n])
                        n, seen = 0, set()
                        if len(grams) > len(held):
                            held = np.empty(len(grams), np.uint64)
                    seen.add(mark)
                    held[n : n + len(grams)] = grams
                    n += len(grams)
        yield _reported(held[:n])

    counts = texts.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    rows = counts.orderBy(F.desc("n"), "gram").limit(most).toArrow()
    grams = rows["gram"].to_numpy().astype(np.int64).view(np.uint64)
    at = np.argsort(grams)
    return grams[at], rows["n"].to_numpy()[at]


def needed(n: int, percent: int) -> int:
    """Least overlap of a set of n with any set that it may link with."""
    return -(-percent * n // 100)


def common(n: int) -> int:
    """Least overlap that the first n-grams of a set of n must have."""
    return -(-n // COMMON)


def ngram_jaccard(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 75,
    often: int = 200_000,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``.

    Two documents link when ``100 * |A & B| >= percent * |A | B|`` over their sets of
    ``size``-word shingles; ``component_id`` is the least id reachable by links, the
    document's own included. ``often`` bounds the table of frequent n-grams that is handed
    to the tasks (16 bytes each).

    Null or empty texts and texts without words have no shingle and link with nothing. Rows
    that repeat an id give a row each. A null id gives a row with a component of its own
    (null). Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known, weight = _often(texts.select("text"), size, often)
    shared = spark.sparkContext.broadcast((known, weight))

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in slices(batch, 1)):
            sets = shingle_sets(part.column(1), size)
            yield pa.record_batch(
                [part.column(0), pa.array(list(map(len, sets)), pa.int64()), pa.array(list(map(fingerprint, sets)), pa.int64())], ["doc_id", "n", "mark"]
            )

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weight = shared.value
        seen: set[int] = set()
        for part in (part for batch in batches for part in slices(batch, 1)):
            sets = shingle_sets(part.column(1), size)
            marks, sizes, firsts = [], [], []
            for grams in sets:
                n, mark = len(grams), fingerprint(grams)
                if not n or mark in seen:
                    continue
                if len(seen) >= 1_000_000:  # forgotten ones are told again and meet below
                    seen.clear()
                seen.add(mark)
                first = n - int(needed(n, percent)) + int(common(n))
                at = np.searchsorted(known, grams)
                hot = np.zeros(n, bool) if not len(known) else known[np.minimum(at, len(known) - 1)] == grams
                cold = grams[~hot]
                if len(cold) < first:
                    last = grams[hot][np.lexsort((grams[hot], weight[at[hot]]))]
                    cold = np.concatenate((cold, last))
                marks.append(mark)
                sizes.append(n)
                firsts.append(cold[:first].view(np.int64))
            if marks:
                lengths = list(map(len, firsts))
                yield pa.record_batch(
                    [pa.array(np.concatenate(firsts)), pa.array(np.repeat(np.array(marks, np.int64), lengths)), pa.array(np.repeat(np.array(sizes, np.int32), lengths))],
                    ["gram", "mark", "n"],
                )

    table = saved(texts.mapInArrow(summary, "doc_id long, n long, mark long"))
    classes = table.where("n > 0 and doc_id is not null").groupBy("mark").agg(F.min("doc_id").alias("rep"))

    # the columns of the product: one row for a class and n-gram, and of those only columns
    # of two classes or more; (n, mark) orders the classes alike in every column
    columns = texts.where("doc_id is not null").mapInArrow(prefixes, "gram long, mark long, n int")
    columns = columns.withColumn("at", F.struct("n", "mark")).drop("n", "mark")
    order = Window.partitionBy("gram").orderBy("at")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    columns = columns.select(
        "gram", "at", F.lag("at").over(order).alias("before"), F.first("at").over(whole).alias("head"),
        F.last("at").over(whole).alias("tail"), F.count(F.lit(1)).over(whole).alias("classes"),
    )
    columns = saved(columns.where("head != tail and (before is null or before != at)").drop("tail", "before"))

    # summed overlaps of pairs, and the bound
    alike = lambda a, b: F.least(a, b) * 100 >= F.greatest(a, b) * percent
    short = columns.where(F.col("classes") <= SHORT).groupBy("gram").agg(F.array_sort(F.collect_list("at")).alias("all"))
    pair = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    later = lambda x, i: F.transform(F.filter(F.slice("all", i + 2, SHORT), lambda y: alike(x["n"], y["n"])), lambda y: pair(x, y))
    told = short.select(F.explode(F.flatten(F.transform("all", later))).alias("p"), F.lit(1).alias("overlap"))
    long = columns.where(F.col("classes") > SHORT)
    # the more of a class is shared, and by more, the nearer it is to a group's centre
    own, column = Window.partitionBy("at.mark"), Window.partitionBy("gram")
    rows = long.select("gram", "at", F.count(F.lit(1)).over(own).alias("m"), F.sum("classes").over(own).alias("shared"))
    rows = rows.where(F.col("m") >= F.ceil(F.col("at.n") * percent / (100 * COMMON)))
    rows = saved(rows.withColumn("head", F.max(F.struct("shared", "at")).over(column)["at"]))
    near = rows.where("head != at").where(alike(F.col("head.n"), F.col("at.n"))).select(pair(F.col("head"), F.col("at")).alias("p")).distinct()
    near = near.withColumn("overlap", F.lit(0))
    in_long = long.groupBy(F.col("at.mark").alias("mark")).agg(F.count(F.lit(1)).alias("m"))
    found = told.unionByName(near).groupBy("p").agg(F.sum("overlap").alias("overlap"))
    found = found.select(F.col("p.x.mark").alias("a"), F.col("p.x.n").alias("na"), F.col("p.y.mark").alias("b"), F.col("p.y.n").alias("nb"), "overlap")
    for side in "ab":
        found = found.join(in_long.select(F.col("mark").alias(side), F.col("m").alias("m" + side)), side, "left")
    # in columns that did not give all pairs, a pair has at most what both have there
    least = F.least(*(F.ceil(F.col(n) / COMMON) for n in ("na", "nb")))
    past = F.greatest(*(F.ceil(F.col(n) * percent / 100) - F.ceil(F.col(n) / COMMON) for n in ("na", "nb")))
    asked = F.greatest(least, F.ceil((F.col("na") + F.col("nb")) * percent / (100 + percent)) - past)
    unseen = F.least(F.coalesce("ma", F.lit(0)), F.coalesce("mb", F.lit(0)))
    found = saved(found.where(F.col("overlap") + unseen >= asked).select("a", "b"))
    links = _verified(found, classes, texts, size, percent)
    part = saved(components(links))

    # every other pair of the long columns: first with the centre of what is not in the
    # component of the column's centre, then of all documents of different components
    for last in (False, True):
        named = part.select(F.col("node").alias("mark"), F.col("component").alias("c"))
        labelled = rows.select("gram", "at.mark", "at", "shared", F.col("head.mark").alias("top"), "m").join(named, "mark", "left")
        labelled = labelled.withColumn("c", F.coalesce("c", "mark"))
        if last:
            break
        top = F.max(F.when(F.col("mark") == F.col("top"), F.col("c"))).over(column)
        apart = labelled.withColumn("of_top", top).where("c != of_top")
        apart = apart.withColumn("head", F.max(F.struct("shared", "at")).over(column)["at"]).where("head != at")
        apart = apart.where(alike(F.col("head.n"), F.col("at.n"))).select(F.col("head.mark").alias("a"), F.col("mark").alias("b"))
        apart = apart.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        more = _verified(saved(apart), classes, texts, size, percent)
        part = saved(components(part.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)))
    labelled = labelled.select("gram", "mark", "at.n", "c", "top", F.col("m"))
    labelled = labelled.withColumns({"x": F.min("c").over(column), "y": F.max("c").over(column)})
    labelled = labelled.where("x != y").drop("x", "y")
    # columns of one centre are a block of the product; its documents are cut into blocks too
    held = labelled.groupBy("top").agg(F.count_distinct("mark").alias("classes")).where(F.col("classes") > BLOCK)
    held = held.select("top", F.ceil(F.col("classes") / BLOCK).cast("int").alias("blocks"))
    blocks = labelled.join(held, "top", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    blocks = blocks.withColumn("own", F.pmod(F.xxhash64("mark"), F.col("blocks")).cast("int"))
    blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = blocks.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    blocks = blocks.select("top", "low", "high", "own", "gram", "mark", "n", "c", "m")
    blocks = blocks.repartition("top", "low", "high").sortWithinPartitions("top", "low", "high", "gram")
    pairs = blocks.mapInArrow(lambda batches: _product(batches, percent), "a long, b long").distinct()
    more = _verified(saved(pairs), classes, texts, size, percent)
    linked = part.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
    final = components(linked).withColumnRenamed("node", "mark")

    # components are named by a fingerprint so far: name them by their least document
    named = classes.join(final, "mark").groupBy("component").agg(F.min("rep").alias("component_id"))
    named = final.join(named, "component").select("mark", "component_id")
    of_class = classes.join(named, "mark", "left").select("mark", F.coalesce("component_id", "rep").alias("component_id"))
    out = table.select("doc_id", "n", "mark").join(of_class, "mark", "left")
    own = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def _product(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of classes of different components that the overlaps in one block don't rule out."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy() for c in batch.columns]
        starts = np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:3]]))))
        for low, high in zip(starts, [*starts[1:], batch.num_rows]):
            piece = [c[low:high] for c in columns]
            if held is not None and all(x[0] == y[0] for x, y in zip(held[:3], piece[:3])):
                held = [np.concatenate(z) for z in zip(held, piece)]
                continue
            if held is not None:
                yield from _block_pairs(held, percent)
            held = piece
    if held is not None:
        yield from _block_pairs(held, percent)


def _block_pairs(block: list[np.ndarray], percent: int) -> Iterator[pa.RecordBatch]:
    _, low, high, own, gram, mark, n, c, m = block
    names, first, row = np.unique(mark, return_index=True, return_inverse=True)
    own, n, c, m = own[first], n[first].astype(np.int64), c[first], m[first]
    k = len(names)
    _, column = np.unique(gram, return_inverse=True)
    overlap = np.zeros((k, k), np.float32)
    strips = [slice(at, at + STRIP) for at in range(0, k, STRIP)]
    width = max(1, 8_000_000 // k)
    for start in range(0, int(column.max()) + 1, width):
        some = (column >= start) & (column < start + width)
        part = np.zeros((k, min(width, int(column.max()) + 1 - start)), np.float32)
        part[row[some], column[some] - start] = 1
        for strip in strips:
            overlap[strip, strip.start :] += part[strip] @ part[strip.start :].T
    outside = m - np.bincount(row, minlength=k)  # columns of a class in other blocks
    least = -(-n // COMMON)
    past = -(-n * percent // 100) - least
    for strip in strips:
        a, b = np.nonzero(np.triu(overlap[strip] > 0, strip.start + 1))
        a += strip.start
        asked = np.maximum(np.minimum(least[a], least[b]), -(-(n[a] + n[b]) * percent // (100 + percent)) - np.maximum(past[a], past[b]))
        keep = (c[a] != c[b]) & (overlap[a, b] + np.minimum(outside[a], outside[b]) >= asked)
        keep &= np.minimum(n[a], n[b]) * 100 >= np.maximum(n[a], n[b]) * percent
        if low[0] != high[0]:
            keep &= own[a] != own[b]
        yield pa.record_batch([pa.array(names[a[keep]]), pa.array(names[b[keep]])], ["a", "b"])


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for part in (part for batch in batches for part in slices(batch, 1)):
        sets = shingle_sets(part.column(1), size)
        yield pa.record_batch(
            [pa.array([fingerprint(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())],
            ["mark", "grams"],
        )


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets meet the similarity."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                small, big = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(big, small), len(big) - 1)
                overlap = int((big[at] == small).sum())
                keep.append(100 * overlap >= percent * (len(x) + len(y) - overlap))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("mark")).distinct().join(classes, "mark")
    # written, so that its size is known: beside few ids the texts stay where they are
    wanted = saved(wanted.select(F.col("rep").alias("doc_id")))
    sets = saved(
        texts.join(wanted, "doc_id", "left_semi")
        .select("doc_id", "text")
        .mapInArrow(lambda batches: _sets(batches, size), "mark long, grams binary")
    )
    with_a = pairs.join(sets.select(F.col("mark").alias("a"), F.col("grams").alias("x")), "a")
    with_b = with_a.join(sets.select(F.col("mark").alias("b"), F.col("grams").alias("y")), "b")
    return saved(with_b.select("a", "b", "x", "y").mapInArrow(count, "a long, b long"))
