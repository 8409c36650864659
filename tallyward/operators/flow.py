"""Flow between states over the stages of a study."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions import all_true, is_in, percent_text, ratio, recode
from tallyward.operators.dimensions import with_dimension


def stage_edges(
    rows: DataFrame,
    *,
    id_cols: Sequence[str],
    stages: Sequence[tuple[Column, Column]],
    origin: Column | None = None,
    weight: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Edges from each entity's states at a stage to its states at the next, in one pass.

    A stage is ``(rows of the stage, state)``; any state counts. Every row of a stage
    meets every row of its entity at the stage before; one without such a row, or without
    an id, has a null source. Rows without an id lead to no later stage, rows without a
    state make no edge. Rows of the first stage come from ``origin``, if there is one.
    ``weight`` is the number of rows that a row stands for.

    States are counted per entity and become one vector of stages, whose counts are
    multiplied, so entities with many rows cost no more than others and the rows are
    read once for all stages.
    """
    keys = list(dict.fromkeys([*by, *id_cols]))
    one = F.lit(1).cast("long") if weight is None else F.col(weight)
    before = F.lit(None).cast("string") if origin is None else origin
    told = [
        F.when(
            in_stage & state.isNotNull(),
            F.struct(
                F.lit(k).alias("stage"),
                state.alias("state"),
                (before if k == 0 else F.lit(None).cast("string")).alias("origin"),
            ),
        )
        for k, (in_stage, state) in enumerate(stages)
    ]
    told = rows.select(*keys, one.alias("_n"), F.explode(F.array_compact(F.array(*told))).alias("_s"))
    counts = told.groupBy(*keys, "_s").agg(F.sum("_n").alias("n"))
    own = F.struct(F.col("_s.state").alias("state"), F.col("_s.origin").alias("origin"), "n")
    listed = counts.groupBy(*keys).agg(
        *(
            F.collect_list(F.when(F.col("_s.stage") == k, own)).alias(f"_stage{k}")
            for k in range(len(stages))
        )
    )
    none = F.array(
        F.struct(
            F.lit(None).cast("string").alias("state"),
            F.lit(None).cast("string").alias("origin"),
            F.lit(1).cast("long").alias("n"),
        )
    )
    known = all_true(F.col(c).isNotNull() for c in id_cols)

    def edge(source: Column, target: Column, n: Column) -> Column:
        return F.struct(source.alias("source"), target.alias("target"), n.alias("weight"))

    def step(k: int) -> Column:
        sources = F.when((F.size(f"_stage{k - 1}") > 0) & known, F.col(f"_stage{k - 1}"))
        pairs = F.transform(
            F.coalesce(sources, none),
            lambda f: F.transform(
                F.col(f"_stage{k}"), lambda t: edge(f["state"], t["state"], f["n"] * t["n"])
            ),
        )
        return F.flatten(pairs)

    steps = [step(k) for k in range(1, len(stages))]
    if origin is not None:
        first = F.transform(F.col("_stage0"), lambda t: edge(t["origin"], t["state"], t["n"]))
        steps = [first, *steps]
    return listed.select(*by, F.inline(F.concat(*steps)))


def link_states(
    rows: DataFrame,
    *,
    id_cols: Sequence[str],
    first: tuple[Column, Column],
    second: tuple[Column, Column],
    by: Sequence[str] = (),
) -> DataFrame:
    """Edges from each entity's state at one stage to its state at the next."""
    return stage_edges(rows, id_cols=id_cols, stages=(first, second), by=by)


def path_edges(
    paths: DataFrame, states: Sequence[str], *, start: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Edges of paths that hold one column per stage; a path ends at its first null.

    ``start`` is a common source put before the first stage. States after a null make
    no edge. One scan gives all stages.
    """
    cols = [F.col(s) for s in states]
    if start is not None:
        cols = [F.lit(start), *cols]
    steps, going = [], F.lit(True)
    for a, b in zip(cols, cols[1:], strict=False):
        going = going & a.isNotNull()
        steps.append(
            F.struct(
                a.alias("source"),
                F.when(going, b).alias("target"),
                F.lit(1).cast("long").alias("weight"),
            )
        )
    return paths.select(*by, F.inline(F.array(*steps))).where(F.col("target").isNotNull())


Ranks = Mapping[str, int] | DataFrame
"""Node -> rank, or a table of ``node`` and ``rank``."""


def _with_rank(edges: DataFrame, node: str, ranks: Ranks | None) -> DataFrame:
    rank = f"{node}_rank"
    if not isinstance(ranks, DataFrame):
        return edges.withColumn(rank, recode(F.col(node), ranks or {}).cast("int"))
    dim = ranks.select("node", F.col("rank").cast("int").alias(rank))
    return with_dimension(edges, dim, {node: "node"}, [rank])


def state_flow(
    stages: Sequence[DataFrame],
    *,
    source_rank: Ranks | None = None,
    target_rank: Ranks | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Weight of each edge over all stages, with totals per source and per target.

    Stages hold ``source``, ``target`` and, where a row stands for several, ``weight``.
    Nodes are ordered by rank, which a mapping or a table of ``node`` and ``rank`` gives;
    those without a rank come last.
    """
    one = F.lit(1).cast("long").alias("weight")
    cols = [*by, "source", "target"]
    parts = [s.select(*cols, "weight" if "weight" in s.columns else one) for s in stages]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    edges = rows.groupBy(*cols).agg(F.sum("weight").alias("weight"))
    # From here on there is one row per edge: those of a group meet once, for both totals.
    edges = edges.repartition(*by) if by else edges.repartition(1)
    return (
        edges.withColumns(
            {
                "source_total": F.sum("weight").over(Window.partitionBy(*by, "source")),
                "target_total": F.sum("weight").over(Window.partitionBy(*by, "target")),
            }
        )
        .transform(_with_rank, "source", source_rank)
        .transform(_with_rank, "target", target_rank)
        .orderBy(
            *by,
            F.asc_nulls_last("source_rank"),
            F.asc_nulls_last("target_rank"),
            F.asc_nulls_last("source"),
            F.asc_nulls_last("target"),
        )
    )


def with_flow_text(
    edges: DataFrame,
    *,
    one_source: Collection[str] = (),
    one_target: Collection[str] = (),
) -> DataFrame:
    """Edge text: its weight, and its share of the source, of the target, or of both.

    The share of the target is left out for targets fed by one source only
    (``one_source``), the share of the source for sources that feed one target only
    (``one_target``).
    """

    def share(total: str, node: str) -> Column:
        return F.concat(
            percent_text(ratio(F.col("weight"), F.col(total))), F.lit(" of "),
            F.col(total).cast("string"), F.lit(" "), F.lower(F.col(node)),
        )

    head = F.concat(
        F.lit("<b>"), F.col("source"), F.lit(" -> "), F.col("target"), F.lit(":</b><br>N = "),
        F.col("weight").cast("string"), F.lit("<br>"),
    )
    of_source, of_target = share("source_total", "source"), share("target_total", "target")
    return edges.withColumn(
        "flow_text",
        F.when(is_in(F.col("target"), one_source), F.concat(head, of_source))
        .when(is_in(F.col("source"), one_target), F.concat(head, of_target))
        .otherwise(F.concat(head, of_source, F.lit("<br>"), of_target)),
    )
