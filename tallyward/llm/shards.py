"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions only.

Each shard has virtual nodes on a ring of slots; a key belongs to the next node clockwise.
Shard loads are bounded by the mean, rounded up for the first shards as often as needed to
hold all rows and down for the others, so counts are at most one apart. A shard keeps its
own keys up to its bound; those over it continue clockwise to the next shard with room.

Which keys move where follows from counts alone: rows are counted per cell (a slot, split by
a second hash), the counts of a fixed number of cells give each cell's quota at home and its
place in the line of moving keys, and a fold over the ring deals that line out to the room
left. Rows are then ranked within their cell only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyward.llm.common import saved

#: Slots of the ring, virtual nodes of a shard, cells of a slot.
SLOTS, NODES, CELLS = 4096, 96, 4


def _ring(spark: SparkSession, shards: int) -> tuple[DataFrame, DataFrame]:
    """(slot, home) for all slots, and (slot, owner, node) of the virtual nodes."""
    nodes = spark.range(shards * NODES).select((F.col("id") % shards).cast("int").alias("owner"), (F.col("id") / shards).cast("int").alias("node"))
    nodes = nodes.withColumn("slot", F.pmod(F.xxhash64(F.lit("node"), "owner", "node"), F.lit(SLOTS)).cast("int"))
    first = nodes.groupBy("slot").agg(F.min(F.struct("node", "owner")).alias("first"))
    slots = spark.range(SLOTS).select(F.col("id").cast("int").alias("slot")).join(first, "slot", "left")
    ahead = Window.orderBy("slot").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    home = F.coalesce(F.first("first.owner", True).over(ahead), F.first("first.owner", True).over(whole))
    return slots.select("slot", home.alias("home")), nodes


def slot_of(key: Column) -> Column:
    return F.pmod(key, F.lit(SLOTS)).cast("int")


def shard_rows(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 8 (null: 8); ``text_crc32`` is that of the text
    (null for null); ``law`` is ``rows``: counts of shards are at most one apart. ``slot``
    numbers a shard's rows from 0 without gaps. ``grown_shard`` is null, as with bounded
    loads a row's shard depends on the others too.

    The key is the id (null is a key like any other). Rows of one id spread by their text
    over the cells of a slot, and over shards if they exceed a shard's room. Rows equal in
    id and text are interchangeable. Empty input gives no rows. Other columns are ignored.
    """
    if not 0 < shards <= SLOTS // 8:
        raise ValueError("shards")
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.lit("key"), id_col).alias("key"),
        F.xxhash64(F.lit("order"), id_col, text_col).alias("order"),
    )
    rows = rows.withColumn("slot", slot_of(F.col("key")))
    rows = saved(rows.withColumn("cell", F.pmod("order", F.lit(CELLS)).cast("int")))
    homes, nodes = _ring(spark, shards)

    cells = rows.groupBy("slot", "cell").agg(F.count(F.lit(1)).alias("n")).join(homes, "slot")
    total = F.sum("n").over(Window.partitionBy())
    cells = cells.withColumn("total", total)
    room = (F.expr(f"total div {shards}") + F.when(F.col("home") < F.expr(f"total % {shards}"), 1).otherwise(0)).alias("room")
    in_home = Window.partitionBy("home").orderBy("slot", "cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("slot", "cell", "home", "n", room, F.coalesce(F.sum("n").over(in_home), F.lit(0)).alias("start"))
    stay = F.greatest(F.lit(0), F.least(F.col("n"), F.col("room") - F.col("start")))
    in_line = Window.orderBy("slot", "cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("stay", stay).withColumn("line", F.coalesce(F.sum(F.col("n") - F.col("stay")).over(in_line), F.lit(0)))
    cells = saved(cells)

    pieces = _moves(cells, nodes, shards)
    order = Window.partitionBy("slot", "cell").orderBy("order", "doc_id", "size", "text_crc32")
    ranked = rows.withColumn("rank", (F.row_number().over(order) - 1).cast("long"))
    ranked = ranked.join(cells.select("slot", "cell", "home", "start", "stay", "line"), ["slot", "cell"])
    ranked = ranked.withColumn("moving", F.when(F.col("rank") >= F.col("stay"), F.col("line") + F.col("rank") - F.col("stay")))
    # a cell's moving rows fall on few pieces of the line: join by cell, then by place
    of_cell = cells.where("n > stay").select("slot", "cell", F.col("line").alias("from"), (F.col("line") + F.col("n") - F.col("stay")).alias("end"))
    of_cell = _in_blocks(of_cell, "from", "end").join(_in_blocks(pieces, "low", "high"), "block").where("low < end and high > from")
    of_cell = of_cell.select("slot", "cell", F.struct("low", "high", "to", "base").alias("piece")).distinct().groupBy("slot", "cell").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    ranked = ranked.join(of_cell, ["slot", "cell"], "left")
    piece = F.get(F.filter("pieces", lambda p: (p["low"] <= F.col("moving")) & (F.col("moving") < p["high"])), 0)
    ranked = ranked.withColumn("piece", F.when(F.col("moving").isNotNull(), piece))
    return ranked.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.coalesce("piece.to", "home").cast("int").alias("shard"),
        F.coalesce(F.col("piece.base") + F.col("moving") - F.col("piece.low"), F.col("start") + F.col("rank")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _in_blocks(ranges: DataFrame, low: str, high: str) -> DataFrame:
    """A row for each block of the line that a range touches; the line has ``SLOTS`` blocks at most."""
    width = F.expr(f"max({high}) over () div {SLOTS} + 1")
    ranges = ranges.withColumn("width", width)
    return ranges.withColumn("block", F.explode(F.expr(f"sequence({low} div width, ({high} - 1) div width)"))).drop("width")


def _moves(cells: DataFrame, nodes: DataFrame, shards: int) -> DataFrame:
    """How the line of moving keys, in ring order, is dealt out: low, high, to, base.

    A fold over the virtual nodes clockwise, twice round: at each node the keys that wait
    and have passed no shard with room yet take what room its shard has left. ``base`` is
    the first free slot of that shard. The tables have a row per shard, cell or node.
    """
    kept = cells.groupBy("home").agg(F.sum("stay").alias("kept"))
    waiting = cells.groupBy("slot").agg(F.sum(F.col("n") - F.col("stay")).alias("moving"), F.sum("n").alias("n"))
    # the ring as steps: a slot's own keys join the line, then its nodes take from it
    one = lambda node, owner, moving: F.struct("slot", F.lit(node).alias("node") if isinstance(node, int) else node, owner, moving)
    none = F.lit(0).cast("long").alias("moving")
    steps = waiting.select(one(-1, F.lit(-1).alias("owner"), "moving").alias("step"), "n")
    steps = steps.unionByName(nodes.select(one(F.col("node"), "owner", none).alias("step"), F.lit(0).cast("long").alias("n")))
    steps = steps.withColumn("kept", F.lit(None).cast("struct<home:int,kept:bigint>"))
    kept = kept.select(F.struct("home", "kept").alias("kept"), F.lit(0).cast("long").alias("n"))
    once = steps.unionByName(kept, True).agg(F.array_sort(F.collect_list("step")).alias("steps"), F.map_from_entries(F.collect_list("kept")).alias("kept"), F.sum("n").alias("total"))

    def load(shard: Column) -> Column:
        kept = F.coalesce(F.try_element_at("kept", shard), F.lit(0).cast("long"))
        room = F.expr(f"total div {shards}") + F.when(shard < F.expr(f"total % {shards}"), 1).otherwise(0)
        return F.struct(kept.alias("kept"), (room - kept).alias("free"))

    once = once.withColumn("loads", F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), load))
    # second round: no new keys join
    lap = F.transform("steps", lambda s: F.struct(s["slot"], s["node"], s["owner"], F.lit(0).cast("long").alias("moving")))
    start = F.struct(
        F.lit(0).cast("long").alias("done"), F.lit(0).cast("long").alias("joined"),
        F.transform("loads", lambda x: x["free"]).alias("free"), F.transform("loads", lambda x: x["kept"]).alias("next"),
        F.expr("array()").cast("array<struct<low:bigint,high:bigint,to:int,base:bigint>>").alias("out"),
    )

    def step(state: Column, s: Column) -> Column:
        joined = state["joined"] + s["moving"]
        free = F.coalesce(F.get(state["free"], s["owner"]), F.lit(0).cast("long"))
        took = F.least(free, joined - state["done"])
        put = lambda xs, by: F.transform(xs, lambda x, i: x + F.when(i == s["owner"], by).otherwise(F.lit(0).cast("long")))
        piece = F.struct(
            state["done"].alias("low"), (state["done"] + took).alias("high"),
            s["owner"].cast("int").alias("to"), F.get(state["next"], s["owner"]).alias("base"),
        )
        changed = F.struct(
            (state["done"] + took).alias("done"), joined.alias("joined"), put(state["free"], -took).alias("free"),
            put(state["next"], took).alias("next"), F.concat(state["out"], F.array(piece)).alias("out"),
        )
        same = F.struct(state["done"].alias("done"), joined.alias("joined"), state["free"].alias("free"), state["next"].alias("next"), state["out"].alias("out"))
        return F.when((s["owner"] >= 0) & (took > 0), changed).otherwise(same)

    folded = once.select(F.aggregate(F.concat("steps", lap), start, step)["out"].alias("out"))
    return saved(folded.select(F.inline("out")))
