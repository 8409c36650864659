"""Mixing sources to target weights, as a min-cost flow over membership patterns.

Documents that belong to the same set of sources form a pattern. Words flow from a pattern,
once for free and again at a cost that rises with each repetition, to the sources that it
belongs to, up to their quotas. The network has a node per pattern and source, never one
per document. Each pattern's flow is then drawn from its documents in an order given by a
seeded hash: cut at a place found from sums per range of hashes, so no task sees a whole
pattern. A document that no longer fits is left out and the draw goes on after it among
those that fit, until there is none.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallyward.llm.common import saved

#: Bits of the hash that one level of sums resolves, and the levels.
STEP, LEVELS = 12, 2
#: Place after all rows.
LAST = ((1 << 63) - 1, (1 << 63) - 1)


def words_in(text: Column) -> Column:
    """Runs of anything but blanks and U+0009 to U+000D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def target_words(sizes: dict[str | None, int], weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, total: int | None = None) -> dict[str | None, float]:
    """Words wanted of each source.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share``
    of ``total`` (all sizes). No target is above ``most`` times its source's size; what is
    over is shared again by weight among those below, until none is above.
    """
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(names)}
    left = share * (sum(sizes.values()) if total is None else total)
    out: dict[str | None, float] = {}
    while rest := [s for s in names if s not in out]:
        unit = left / sum(weight[s] for s in rest)
        over = [s for s in rest if unit * weight[s] > most * sizes[s]]
        for s in over or rest:
            out[s] = most * sizes[s] if over else unit * weight[s]
        left -= sum(out[s] for s in over)
        if not over:
            break
    return out


def route(patterns: dict[tuple, int], quotas: dict, repeats: int) -> dict[tuple, int]:
    """Words to take of each pattern: a flow of most words and, of those, least cost.

    The k-th repetition of a word costs k - 1. Paths of least cost are filled one after the
    other, with potentials, so the number of searches follows that of arcs.
    """
    nodes = ["S", "T", *(("p", p) for p in patterns), *(("q", q) for q in quotas)]
    index = {n: i for i, n in enumerate(nodes)}
    arcs: list[list] = []  # to, room, cost; the reverse arc of i is i ^ 1
    out: list[list[int]] = [[] for _ in nodes]

    def arc(a, b, room: int, cost: int) -> int:
        out[index[a]].append(len(arcs))
        arcs.append([index[b], room, cost])
        out[index[b]].append(len(arcs))
        arcs.append([index[a], 0, -cost])
        return len(arcs) - 2

    supply: dict[tuple, list[int]] = {}
    for p, size in patterns.items():
        supply[p] = [arc("S", ("p", p), size, k) for k in range(repeats)]
        for q in p:
            arc(("p", p), ("q", q), size * repeats, 0)
    for q, quota in quotas.items():
        arc(("q", q), "T", quota, 0)
    height = [0] * len(nodes)
    while True:
        dist, via = [None] * len(nodes), [None] * len(nodes)
        dist[0] = 0
        queue = [(0, 0)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > dist[a]:
                continue
            for i in out[a]:
                b, room, cost = arcs[i]
                if room > 0 and (dist[b] is None or d + cost + height[a] - height[b] < dist[b]):
                    dist[b], via[b] = d + cost + height[a] - height[b], i
                    heapq.heappush(queue, (dist[b], b))
        if dist[1] is None:
            break
        height = [h + (d if d is not None else dist[1]) for h, d in zip(height, dist)]
        path, b = [], 1
        while b:
            path.append(via[b])
            b = arcs[via[b] ^ 1][0]
        amount = min(arcs[i][1] for i in path)
        for i in path:
            arcs[i][1] -= amount
            arcs[i ^ 1][1] += amount
    return {p: sum(arcs[i ^ 1][1] for i in held) for p, held in supply.items()}


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    repeats: int = 2,
    seed: int = 0,
    carry: bool = False,
) -> tuple[DataFrame, dict, dict]:
    """(doc_id, sources, size, taken) of all rows, and words and target of each source.

    With ``carry`` each row also has ``row``, the whole row of ``docs`` as a struct.

    ``source_col`` is a name or an array of names; null, or an empty array, is the source
    null. ``size`` is the number of words (null or empty text: 0), ``taken`` the words that
    the mix takes: whole documents, each at most ``repeats`` times. A pattern's words miss
    its flow by less than any of its documents that could be taken once more. The draw depends on the seed, id
    and text alone; rows equal in both are interchangeable, ties between others fall by
    hash. An empty table gives no rows. Sources and patterns are small sets: their sums are
    handled on the driver. Other columns are ignored.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[source_col]
    sources = F.array_sort(F.array_distinct(source_col)) if kind.startswith("array") else F.array(source_col)
    sources = F.when(F.size(sources) > 0, sources).otherwise(F.array(F.lit(None).cast("string")))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), sources.alias("sources"), words_in(F.col(text_col)).alias("size"),
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_col, text_col), 1).alias("u"), *([F.struct("*").alias("row")] if carry else []),
    )
    rows = rows.withColumn("pattern", F.to_json(F.struct(F.col("sources").alias("s"))))
    rows = saved(rows.withColumn("tie", F.monotonically_increasing_id()))

    sums = rows.groupBy("pattern").agg(F.sum("size").alias("size")).collect()
    patterns = {tuple(json.loads(r["pattern"])["s"]): r["size"] for r in sums}
    key = {tuple(json.loads(r["pattern"])["s"]): r["pattern"] for r in sums}
    words: dict[str | None, int] = {}
    for p, size in patterns.items():
        for q in p:
            words[q] = words.get(q, 0) + size
    targets = target_words(words, weights, share, float(repeats), sum(patterns.values()))
    flow = route(patterns, {q: round(t) for q, t in targets.items()}, repeats)

    # whole rounds of a pattern, and the words that a part of it gives once more
    full = {key[p]: flow[p] // size if size else 0 for p, size in patterns.items()}
    gaps = {key[p]: flow[p] - full[key[p]] * size for p, size in patterns.items()}
    gaps = {p: gap for p, gap in gaps.items() if gap > 0}
    stretches: dict[str, list[tuple]] = {p: [] for p in full}
    starts = dict.fromkeys(gaps, (-1, -1))
    sized = rows.where("size > 0").select("pattern", "u", "tie", "size")
    while gaps:
        free = sized.join(_table(spark, {p: (gap, *starts[p]) for p, gap in gaps.items()}, "gap long, u0 long, t0 long"), "pattern")
        free = free.where("size <= gap").where(_after("u0", "t0"))
        left, ends = {}, _first_too_many(spark, free, gaps)
        for p, (end, before) in ends.items():
            stretches[p].append((*starts[p], *end, gaps[p]))
            if end != LAST and gaps[p] > before:
                left[p], starts[p] = gaps[p] - before, end
        gaps = left
    table = _table(spark, {p: (full[p], stretches[p]) for p in full}, "full long, stretches array<struct<u0:long,t0:long,u1:long,t1:long,most:long>>")
    chosen = rows.join(table, "pattern")
    drawn = F.exists("stretches", lambda s: (F.col("size") <= s["most"]) & _after(s["u0"], s["t0"]) & ~_after(s["u1"], s["t1"], True))
    out = chosen.withColumn("more", F.when((F.col("size") > 0) & drawn, 1).otherwise(0))
    taken = (F.col("size") * (F.col("full") + F.col("more"))).cast("long")
    return out.select("doc_id", "sources", "size", taken.alias("taken"), *(["row"] if carry else [])), words, targets


def _table(spark: SparkSession, values: dict[str, tuple], schema: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(p, *v) for p, v in values.items()], f"pattern string, {schema}"))  # it comes from the driver


def _after(u: Column | str, tie: Column | str, also: bool = False) -> Column:
    """Whether a row comes after a place in the order of the draw, or ``also`` lies at it."""
    u, tie = (F.col(c) if isinstance(c, str) else c for c in (u, tie))
    return (F.col("u") > u) | ((F.col("u") == u) & (F.col("tie") >= tie if also else F.col("tie") > tie))


def _first_too_many(spark: SparkSession, free: DataFrame, gaps: dict[str, int]) -> dict[str, tuple]:
    """Per pattern with rows: place of the first row whose running sum is over the gap, and the sum before it.

    ``LAST`` where all rows fit. Sums per range of hashes narrow the place down, so only the
    rows of one range are put in order.
    """
    place = lambda level: F.shiftright("u", 63 - STEP * level)
    whole = Window.partitionBy("pattern")
    upto = lambda *order: F.sum("n").over(whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out: dict[str, tuple] = {}
    lows = {p: (0, 0) for p in gaps}  # the range that the gap ends in, and the sum before it
    for level in range(1, LEVELS + 1):
        cells = free.join(_table(spark, lows, "low long, before long"), "pattern").where(F.lit(level == 1) | (place(level - 1) == F.col("low")))
        cells = cells.groupBy("pattern", "gap", "before", place(level).alias("cell")).agg(F.sum("size").alias("n"))
        cells = cells.withColumn("upto", F.col("before") + upto("cell"))
        over = F.when(F.col("upto") > F.col("gap"), F.struct("cell", (F.col("upto") - F.col("n")).alias("sum")))
        cuts = cells.groupBy("pattern").agg(F.min(over).alias("cut"), F.max("upto").alias("all")).collect()
        lows = {r["pattern"]: tuple(r["cut"]) for r in cuts if r["cut"] is not None}
        out |= {r["pattern"]: (LAST, r["all"]) for r in cuts if r["cut"] is None}
        if not lows:
            return out
    edge = free.join(_table(spark, lows, "low long, before long"), "pattern").where(place(LEVELS) == F.col("low")).withColumn("n", F.col("size"))
    edge = edge.withColumn("upto", F.col("before") + upto("u", "tie")).where("upto > gap")
    edge = edge.groupBy("pattern").agg(F.min(F.struct("u", "tie", (F.col("upto") - F.col("n")).alias("sum"))).alias("cut")).select("pattern", "cut.*")
    return out | {r["pattern"]: ((r["u"], r["tie"]), r["sum"]) for r in edge.collect()}
