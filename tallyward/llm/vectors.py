"""Near-duplicate vectors and nearest neighbours.

Near duplicates: normalised vectors are hashed by p-stable projections cut into cells; a
table's bucket is a run of such cells, and several tables are used. Vectors of one bucket
are compared by exact cosine. A pair that met in an earlier table is not counted again, so
links are counted without listing pairs; a bucket hands on a tree of its linked vectors.
Large buckets are cut into blocks, and every two blocks are a task.

Neighbours: rows are dealt to blocks, each with a kd-tree over projections to few
dimensions. A query takes the leaves in the order of their projected distance and measures
exact distances, until the chi-square law of projected distances says that what is left
holds a nearer row with a small chance only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import components, saved

#: Cell width, random vectors met per bucket, chance to miss a pair at the limit, rows of a block.
WIDTH, MET, MISSED, BLOCK = 2.0, 100, 1e-4, 2048


def usable(vector: Column) -> Column:
    """Not null, not zero, all components finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def same_cell(distance: float, width: float = WIDTH) -> float:
    """Chance that two points at a distance fall into one cell of a p-stable hash."""
    r = width / distance
    normal = 0.5 * (1 + math.erf(-r / math.sqrt(2)))
    return 1 - 2 * normal - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_sizes(rows: int, min_cosine: float) -> tuple[int, int]:
    """Cells per table, so that a bucket holds ``MET`` random vectors, and tables, so that few pairs are missed."""
    near, far = same_cell(math.sqrt(2 - 2 * min_cosine)), same_cell(math.sqrt(2))
    cells = max(4, math.ceil(math.log(max(rows, 2) / MET) / -math.log(far)))
    return cells, math.ceil(math.log(MISSED) / math.log(1 - near**cells))


def _matrix(lists: pa.Array) -> np.ndarray:
    """Lists of one length as rows of doubles."""
    return np.asarray(lists.flatten().cast(pa.float64())).reshape(len(lists), -1)


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", min_cosine: float = 0.9, seed: int = 0) -> DataFrame:
    """Per row: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Two vectors link if their cosine, in double precision, is ``min_cosine`` or more; pairs
    at the limit are found with a chance of 1 - ``MISSED``, nearer ones with a higher one,
    and no pair below it links. Equal vectors are one class that is compared once. Vectors
    that are null, empty, zero or hold null or non-finite components, and rows with a null
    id, link with nothing; vectors of different lengths never link. Rows that repeat an id
    count one by one. ``component_id`` is the least id reachable by links, ``kept`` marks
    the row whose id that is.
    """
    vector = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("v"))
    ok = usable(F.col("v")) & F.col("vec_id").isNotNull()
    keys = [F.when(ok, F.xxhash64(F.lit(i), F.size("v"), "v")).alias(f"k{i}") for i in (1, 2)]
    members = saved(rows.select("vec_id", *keys))
    classes = saved(rows.where(ok).select("vec_id", "v", *keys).groupBy("k1", "k2").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v")))
    cells, tables = table_sizes(classes.count(), min_cosine)

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[int, tuple] = {}
        mix = np.random.default_rng(seed + 1).integers(1, 1 << 62, cells, dtype=np.int64) | 1
        for batch in batches:
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size)) if len(np.unique(sizes)) > 1 else batch
                if size not in cache:
                    random = np.random.default_rng([seed, size])
                    cache[size] = random.standard_normal((size, tables * cells)), random.uniform(0, WIDTH, tables * cells)
                lines, shift = cache[size]
                x = _matrix(part.column(2))
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                for low in range(0, len(x), 2048):
                    some = x[low : low + 2048]
                    cell = np.floor((some @ lines + shift) / WIDTH).astype(np.int64).reshape(len(some), tables, cells)
                    with np.errstate(over="ignore"):
                        marks = (cell * mix).sum(axis=2)
                        marks ^= (marks >> 29) * np.int64(0x5851F42D4C957F2D)
                        marks ^= marks >> 32
                    short = marks.astype(np.int32)
                    m = len(some)
                    rep = np.repeat(np.arange(m), tables)
                    ends = lambda width, count: pa.array((np.arange(count + 1) * width).astype(np.int32))
                    yield pa.record_batch(
                        [
                            pa.array(np.tile(np.arange(tables, dtype=np.int32), m)),
                            pa.array(marks.ravel() ^ size),
                            part.column(0).slice(low, m).take(pa.array(rep)),
                            part.column(1).slice(low, m).take(pa.array(rep)),
                            pa.ListArray.from_arrays(ends(tables, m * tables), pa.array(short[rep].ravel())),
                            pa.ListArray.from_arrays(ends(size, m * tables), pa.array(some[rep].ravel())),
                        ],
                        ["t", "bucket", "id", "n", "marks", "x"],
                    )

    dealt = classes.select("id", "n", "v").mapInArrow(buckets, "t int, bucket long, id long, n long, marks array<int>, x array<double>")
    counts = dealt.groupBy("t", "bucket").agg(F.count(F.lit(1)).alias("size"))
    large = saved(counts.where(F.col("size") > BLOCK).withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).drop("size"))
    dealt = dealt.join(large, ["t", "bucket"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    dealt = dealt.repartition("t", "bucket", "low", "high").sortWithinPartitions("t", "bucket", "low", "high", "own")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the group that the last batch ended in
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("t", "bucket", "low", "high", "own", "id", "n")]
            lists = [(np.asarray(c.flatten()), np.diff(c.offsets.to_numpy())) for c in (batch.column("marks"), batch.column("x"))]
            group = np.flatnonzero(np.concatenate(([True], *[np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:4]])])))
            starts = [np.concatenate(([0], np.cumsum(size))) for _, size in lists]
            for low, high in zip(group, [*group[1:], batch.num_rows]):
                piece = [c[low:high] for c in columns] + [flat[s[low] : s[high]].reshape(high - low, -1) for (flat, _), s in zip(lists, starts)]
                if held is not None:
                    if all(a[0] == b[0] for a, b in zip(held[:4], piece[:4])) and held[8].shape[1] == piece[8].shape[1]:
                        held = [np.concatenate(z) for z in zip(held, piece)]
                        continue
                    yield from linked(held)
                held = piece
        if held is not None:
            yield from linked(held)

    def linked(group: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        t, _, low, high, own, ids, n, marks, x = group
        if len(ids) < 2:
            return
        near = x @ x.T >= min_cosine
        np.fill_diagonal(near, False)
        if low[0] != high[0]:  # two blocks: pairs inside one are met elsewhere
            near &= own[:, None] != own[None, :]
        if not near.any():
            return
        a, b = np.nonzero(near)
        new = np.ones(len(a), bool)
        for i in range(0, len(a), 1 << 18):
            some = slice(i, i + (1 << 18))
            new[some] = ~(marks[a[some], : t[0]] == marks[b[some], : t[0]]).any(axis=1)
        links = np.bincount(a[new], weights=n[b[new]], minlength=len(ids)).astype(np.int64)
        root = ids.copy()
        while True:
            least = root.copy()
            np.minimum.at(least, a, root[b])
            if (least == root).all():
                break
            root = least
        tell = np.flatnonzero((links > 0) | (root != ids))
        yield pa.record_batch([pa.array(ids[tell]), pa.array(links[tell]), pa.array(root[tell])], ["id", "links", "root"])

    found = saved(dealt.mapInArrow(compare, "id long, links long, root long"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    part = components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "id")
    told = classes.select("k1", "k2", "id", "n").join(links, "id", "left").join(part, "id", "left")
    told = told.select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = members.join(told, ["k1", "k2"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


# --- nearest neighbours ---------------------------------------------------------------

#: Projected dimensions (even), rows of a block and of a leaf, queries of a block.
DIMENSIONS, ROWS, LEAF, QUERIES = 8, 16384, 64, 4096


def chi_square(share: float, dimensions: int = DIMENSIONS) -> float:
    """The value below which a chi-square variable of an even number of dimensions falls with that chance."""
    low, high = 0.0, 1e4
    for _ in range(200):
        x = (low + high) / 2
        below = 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dimensions // 2))
        low, high = (x, high) if below < share else (low, x)
    return high


def kd_leaves(points: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Rows of each leaf of a kd-tree: halves by the widest dimension."""
    out, stack = [], [np.arange(len(points))]
    while stack:
        rows = stack.pop()
        if len(rows) <= leaf:
            out.append(rows)
            continue
        own = points[rows]
        by = own[:, np.argmax(own.max(axis=0) - own.min(axis=0))]
        order = np.argpartition(by, len(rows) // 2)
        stack += [rows[order[len(rows) // 2 :]], rows[order[: len(rows) // 2]]]
    return out


def search_block(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int, share: float, seed: int) -> pd.DataFrame:
    """The k nearest rows of a block for each query: query_id, vec_id, score."""
    lines = np.random.default_rng([seed, x.shape[1]]).standard_normal((x.shape[1], DIMENSIONS))
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    with np.errstate(over="ignore", invalid="ignore"):
        p, pq = x @ lines, q @ lines
    leaves = kd_leaves(p)
    limit = chi_square(share)
    width = max(map(len, leaves))
    table = np.full((len(leaves), width), -1, np.int64)
    for i, rows in enumerate(leaves):
        table[i, : len(rows)] = np.sort(rows)
    low, high = (np.array([f(p[rows], axis=0) for rows in leaves]) for f in (np.min, np.max))
    out = []
    for start in range(0, len(q), 256):
        qs, ps, names = q[start : start + 256], pq[start : start + 256], query_ids[start : start + 256]
        away = np.zeros((len(qs), len(leaves)))
        for d in range(DIMENSIONS):
            away += np.maximum(0, np.maximum(low[:, d] - ps[:, d, None], ps[:, d, None] - high[:, d])) ** 2
        turn = np.argsort(away, axis=1, kind="stable")
        best = np.full((len(qs), k), np.inf)
        best_row = np.full((len(qs), k), len(ids))
        live = np.arange(len(qs))
        for step in range(len(leaves)):
            leaf = turn[live, step]
            # the chance that a row beyond the next leaf's distance is nearer than the k-th
            live = live[away[live, leaf] <= limit * best[live, -1] ** 2]
            if not len(live):
                break
            leaf = turn[live, step]
            rows = table[leaf]
            with np.errstate(over="ignore"):
                gap = np.sqrt(((x[rows] - qs[live, None, :]) ** 2).sum(axis=2))
            gap[(rows < 0) | (ids[rows] == names[live, None])] = np.inf
            both = np.concatenate((best[live], gap), axis=1)
            both_row = np.concatenate((best_row[live], np.where(np.isfinite(gap), rows, len(ids))), axis=1)
            by_row = np.argsort(both_row, axis=1, kind="stable")  # rows are in the order of ids
            both, both_row = np.take_along_axis(both, by_row, 1), np.take_along_axis(both_row, by_row, 1)
            nearest = np.argsort(both, axis=1, kind="stable")[:, :k]
            best[live], best_row[live] = np.take_along_axis(both, nearest, 1), np.take_along_axis(both_row, nearest, 1)
        at, place = np.nonzero(best_row < len(ids))
        out.append(pd.DataFrame({"query_id": names[at], "vec_id": ids[best_row[at, place]], "score": best[at, place]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def nearest(df: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, share: float = 0.9, seed: int = 0) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows found of each row where ``queries`` holds.

    Nearness is the Euclidean distance in double precision, ties go to the smaller id. Every
    row but those of the query's id is a candidate; with fewer than k, all are returned.
    ``share`` is the chance with which a nearer row is looked for beyond the stopping point.
    Vectors that are null, empty, zero or hold null or non-finite components, and rows with
    a null id, take no part; vectors of different lengths are not compared. Rows that repeat
    an id are candidates one by one, and one of them is the query. The projections, leaves
    and blocks cover every row.
    """
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = saved(rows.where(usable(F.col("v")) & F.col("vec_id").isNotNull()))
    asked = rows.where("asks").groupBy("vec_id").agg(F.min("v").alias("v"))
    data_blocks = max(1, -(-rows.count() // ROWS))
    query_blocks = max(1, -(-asked.count() // QUERIES))
    blocks = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    deal = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int")
    data = rows.select("vec_id", "v", F.size("v").alias("size"), deal(data_blocks).alias("block"), blocks(query_blocks).alias("part"))
    asked = asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.size("v").alias("size"), deal(query_blocks).alias("part"), blocks(data_blocks).alias("block"))

    def one_block(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            x, q = (_matrix(t.column(c).combine_chunks()) for t, c in ((left, "v"), (right, "q")))
            found = search_block(left.column("vec_id").to_numpy(), x, right.column("query_id").to_numpy(), q, k, share, seed)
        else:
            found = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return pa.table({"query_id": pa.array(found["query_id"], pa.int64()), "vec_id": pa.array(found["vec_id"], pa.int64()), "score": pa.array(found["score"], pa.float64())})

    keys = ["block", "part", "size"]
    found = data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(one_block, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
