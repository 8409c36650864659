"""Dimension tables as input: checks, joins, what they lack."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyward.operators import dimensions, flow, reasons


def dim(spark, data):
    return spark.createDataFrame(data, "code int, reason string, reason_type string")


def test_keys_are_checked(spark):
    good = dim(spark, [(1, "a", "A"), (2, "b", None)])
    assert dimensions.checked_dimension(good, ["code"]).count() == 2
    with pytest.raises(ValueError, match="several rows for {'code': 1}"):
        dimensions.checked_dimension(good.unionByName(good.where("code = 1")), ["code"])
    with pytest.raises(ValueError, match="without"):
        dimensions.checked_dimension(dim(spark, [(None, "a", "A")]), ["code"])
    assert dimensions.checked_dimension(good.limit(0), ["code"]).count() == 0


def test_only_a_small_dimension_is_broadcast(spark):
    events = spark.range(10).select(F.col("id").cast("int").alias("code"))
    table = spark.range(50).select(F.col("id").cast("int").alias("code"), F.lit("x").alias("reason"))

    def hinted(up_to):
        checked = dimensions.checked_dimension(table, ["code"], broadcast_up_to=up_to)
        joined = dimensions.with_dimension(events, checked, {"code": "code"}, ["reason"])
        return "ResolvedHint" in joined._jdf.queryExecution().analyzed().toString()

    assert hinted(50) and not hinted(49)


def test_coded_totals(spark):
    table = dim(spark, [(1, "a", "A"), (2, "b", None), (3, "a", "A")])
    events = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x"), (3, "y"), (9, "y"), (None, "y")], "c int, s string")
    assert rows(reasons.coded_totals(events, "c", table)) == [
        ("A", "a", 3), ("Other exclusions", "b", 1), ("Other exclusions", None, 2),
    ]
    assert rows(dimensions.unmatched_codes(events, table, {"c": "code"}, by=["s"])) == [("y", 9, 1)]


def test_a_table_of_boxes_gives_what_a_mapping_gives(spark):
    boxed = spark.createDataFrame(
        [("a", "2020-01-02", "x", None, "x"), ("a", "2020-01-05", None, None, "x"), (None, "2020-01-07", "x", "x", None), ("b", None, "x", None, None)],
        "exc_id string, day string, b1 string, b2 string, b3 string",
    ).withColumn("exc_date", F.to_date("day"))
    mapping = {"b1": ("One", "T"), "b2": ("One", "T"), "b3": (None, None)}
    table = spark.createDataFrame([("b1", "One", "T"), ("b2", "One", "T")], "box string, reason string, reason_type string")
    boxes = list(mapping)
    for how in (reasons.reason_share, reasons.reason_totals, reasons.reason_hierarchy):
        assert rows(how(boxed, table, boxes=boxes)) == rows(how(boxed, mapping))
    with pytest.raises(ValueError, match="list of box columns"):
        reasons.reason_totals(boxed, table)


def test_ranks_from_a_table(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("z", "b")], "source string, target string")
    ranks = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3)], "node string, rank int")
    out = flow.state_flow([edges], source_rank=ranks, target_rank=ranks)
    assert [(r.source, r.source_rank, r.target_rank) for r in out.collect()] == [("b", 1, 3), ("a", 2, 1), ("z", None, 1)]
