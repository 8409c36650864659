"""Landed exports and written tables."""

from __future__ import annotations

import pytest
from conftest import d, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.operators import columns
from tallyward.plans.icu_study import ICU_STUDY
from tallyward.sources import (
    load_inputs,
    normalize_names,
    read_product,
    read_records,
    write_product,
)


def land(path, text):
    path.mkdir(parents=True, exist_ok=True)
    (path / f"{len(list(path.iterdir()))}.csv").write_text(text)
    return str(path)


def test_fields(spark, tmp_path):
    path = land(
        tmp_path / "a",
        'id,note,n\n1,"two\nlines, ""quoted""",007\n2,NA,\n3,"",x\n4, padded ,1\n',
    )
    assert rows(read_records(spark, path)) == [
        ("1", 'two\nlines, "quoted"', "007"),  # no type is guessed
        ("2", "NA", None),  # the text NA is text
        ("3", None, "x"),  # quoted and bare empty fields are missing
        ("4", " padded ", "1"),
    ]


def test_short_rows(spark, tmp_path):
    path = land(tmp_path / "a", "id,a,b\n1,x\n2,y,z\n")
    assert rows(read_records(spark, path)) == [("1", "x", None), ("2", "y", "z")]
    with pytest.raises(Exception, match="(?i)malformed"):
        read_records(spark, path, mode="FAILFAST").collect()


def test_many_files_and_schema(spark, tmp_path):
    path = land(tmp_path / "a", "id,n\n1,2\n")
    land(tmp_path / "a", "id,n\n3,\n")
    schema = T.StructType(
        [T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType())]
    )
    assert rows(read_records(spark, path, schema=schema)) == [("1", 2), ("3", None)]


def test_schema_is_checked_against_the_header(spark, tmp_path):
    path = land(tmp_path / "a", "n,id\n1,2\n")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.StringType())])
    with pytest.raises(Exception, match="(?i)header"):
        read_records(spark, path, schema=schema).collect()


def test_load_inputs_cleans_names(spark, tmp_path):
    paths = {"exc": land(tmp_path / "a", "exc_id,exc_rsn___14\nE1,Checked\n")}
    assert load_inputs(spark, paths)["exc"].columns == ["exc_id", "exc_rsn_14"]


def test_names_that_would_clash_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "a__b int, a_b int")
    with pytest.raises(ValueError, match="a_b"):
        normalize_names(df)


def test_rename_patterns(spark):
    names = [
        "id", "gq_complete_yn", "rbans_completed", "pase_comp_ph", "emp_complete", "gq_date",
        "sppb_datecomp", "rbans_date_complete", "hus_date_compl", "ph_biadl_complete_yn", "gq_rsn",
    ]
    df = spark.createDataFrame([tuple(names)], names)
    assert columns.unify_endings(df, ICU_STUDY.followup_endings).columns == [
        "id", "gq_complete", "rbans_complete", "pase_complete", "emp_complete", "gq_date",
        "sppb_date", "rbans_date", "hus_date", "ph_biadl_complete", "gq_rsn",
    ]


def test_matching(spark):
    df = spark.createDataFrame([(1,) * 5], ["a_id", "b_date", "c_date", "d_complete_yn", "e"])
    assert columns.matching(df, suffix="date") == ["b_date", "c_date"]
    assert columns.matching(df, prefix=("a", "d"), any_of=["e", "zz"]) == [
        "a_id", "d_complete_yn", "e",
    ]
    assert columns.matching(df, pattern=r"_complete.*$") == ["d_complete_yn"]
    assert columns.matching(df) == []


def test_drop_test_entities_keeps_rows_without_id(spark):
    df = spark.createDataFrame([("PT-Test1",), ("PT-1",), (None,)], "id string")
    assert rows(columns.drop_test_entities(df, "id")) == [("PT-1",), (None,)]


def test_datetime_columns(spark):
    df = spark.createDataFrame([("2018-03-10 23:59",), ("bad",)], "enroll_dttm string")
    out = columns.with_parsed_datetimes(df, ["enroll_dttm"])
    assert [r.enroll_dttm_date for r in out.collect()] == [d("2018-03-10"), None]


def test_rerun_replaces_one_date_only(spark, tmp_path):
    path = str(tmp_path / "t")
    full = spark.createDataFrame([(1, "a")], "n int, s string")
    write_product(full, path, d("2019-03-01"))
    write_product(full, path, d("2019-03-08"))
    write_product(full.where("n = 2"), path, d("2019-03-08"))  # now empty
    assert rows(read_product(spark, path, d("2019-03-01"))) == [(1, "a")]
    empty = read_product(spark, path, d("2019-03-08"))
    assert empty.columns == ["n", "s"] and empty.count() == 0
    assert rows(spark.read.parquet(path), "n", "as_of") == [(1, d("2019-03-01"))]


def test_failed_rerun_leaves_the_old_rows(spark, tmp_path):
    path, day = str(tmp_path / "t"), d("2019-03-08")
    old = spark.range(10).select(F.col("id").alias("n"))
    write_product(old, path, day)
    bad = old.withColumn("n", F.when(F.col("n") == 7, F.raise_error(F.lit("broken"))).otherwise(1))
    with pytest.raises(Exception, match="broken"):
        write_product(bad, path, day)
    assert read_product(spark, path, day).count() == 10
    assert spark.read.parquet(path).count() == 10
    # a table may be replaced by one made from it
    write_product(read_product(spark, path, day).where("n < 3"), path, day)
    assert rows(read_product(spark, path, day)) == [(0,), (1,), (2,)]
    # ended between the two renames
    (tmp_path / "t" / "_replaced").mkdir(exist_ok=True)
    (tmp_path / "t" / "as_of=2019-03-08").rename(tmp_path / "t" / "_replaced" / "as_of=2019-03-08")
    assert read_product(spark, path, day).count() == 3
    write_product(old, path, day)
    assert read_product(spark, path, day).count() == 10


def test_names_that_end_alike_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "a_done int, a_did int")
    with pytest.raises(ValueError, match="a_end"):
        columns.unify_endings(df, {"_end": ("_done", "_did")})
    assert columns.unify_endings(df, {"_end": ("_did", "d")}).columns == ["a_done", "a_end"]


def test_csv_sink(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a,b", None), ('q"', "x")], "s string, t string")
    write_product(df.coalesce(1), path, d("2019-03-01"), fmt="csv")
    assert rows(read_records(spark, f"{path}/as_of=2019-03-01")) == [("a,b", None), ('q"', "x")]
