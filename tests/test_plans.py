"""What the physical plans look like, and how they behave on uneven data."""

from __future__ import annotations

import datetime as dt
import re
from contextlib import contextmanager

import pytest
from conftest import SF, d, rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyward.operators import battery, device, expected, flow, followup, funnel, joins, positions
from tallyward.plans import warehouse
from tallyward.plans.warehouse import BEFORE_DISCHARGE, PERMANENT, QUERIES
from tallyward.sources import staging


@contextmanager
def conf(spark, **values):
    values = {k.replace("__", "."): str(v) for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"\bExchange (?:hash|range|Single)", text))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert not re.search(r"Python|ArrowEval|MapInPandas|CartesianProduct|NestedLoop", text)
    for scan in re.findall(r"FileScan parquet \[([^\]]*)\]", text):
        assert scan.count(",") < 9, scan  # never the whole of a wide table


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_generated_methods_are_small_enough_to_be_compiled(spark, name):
    """The JVM leaves methods of more than 8000 bytes of bytecode uncompiled."""
    with conf(
        spark, spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold=-1
    ):
        df = entry.queries()[name](spark, SF)
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) <= 8000


# Shuffles of each plan when nothing may be broadcast, the final sort included.
MOST_SHUFFLES = {
    "screening_funnel_monthly": 2,
    "screening_kpis": 2,
    "screening_two_sources": 2,
    "reason_totals": 1,
    "reason_share": 3,
    "reason_share_by_line_status": 3,
    "terminal_status_counts": 3,
    "daily_status_counts": 2,
    "daily_status_timeline": 1,
    "visit_compliance": 4,
    "removal_reasons": 6,
    "removal_histogram": 3,
    "device_wear_kpis": 1,
    "battery_completion": 3,
    "followup_status_counts": 4,
    "followup_status_counts_all_records": 4,
    "followup_totals_all_records": 5,
    "followup_instruments_all_records": 8,
    "followup_totals": 4,
    "followup_rows": 3,
    "first_last_dates": 1,
    "linked_state_flow": 4,
    "state_flow": 4,
    "state_flow_by_segment": 5,
    "study_flow": 6,
    "study_flow_by_priority": 7,
}


@pytest.mark.parametrize("name", sorted(MOST_SHUFFLES))
def test_shuffle_count(spark, name):
    with conf(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        assert shuffles(plan(entry.queries()[name](spark, SF))) <= MOST_SHUFFLES[name]


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["removal_reasons"](spark, SF))
    orders = next(s for s in text.split("FileScan")[1:] if "orders.parquet" in s)
    assert "EqualTo(o_orderstatus,F)" in orders
    assert "o_totalprice" not in orders


def test_all_orders_take_part_in_the_flow(spark):
    """Every order of the first period is one edge from the start; the others weigh in pairs."""
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    n_first = orders.where(F.year("o_orderdate") < 1997).count()
    edges = entry.queries()["state_flow"](spark, SF).toPandas()
    assert edges[edges.source == "Start"].weight.sum() == n_first
    per = orders.groupBy("o_custkey").agg(
        F.count_if(F.year("o_orderdate") < 1997).alias("a"),
        F.count_if(F.year("o_orderdate").between(1997, 1999)).alias("b"),
        F.count_if(F.year("o_orderdate") >= 2000).alias("c"),
    )
    pairs = per.agg(
        F.sum(F.greatest("a", F.lit(1)) * F.col("b")), F.sum(F.greatest("b", F.lit(1)) * F.col("c"))
    ).first()
    assert edges.weight.sum() == n_first + sum(pairs)


def test_boolean_batteries_use_hash_aggregates(spark):
    assert "SortAggregate" not in plan(entry.queries()["battery_completion"](spark, SF))


TWO = followup.Instruments(phone=("ls",), full=("gq", "ls"))
WINDOWS = {1: followup.VisitWindow(30, 14, True), 3: followup.VisitWindow(83, 56, False)}
VISITS = ("1 Month Phone Call", "3 Month Assessment")

# -- A third of all rows on one key ------------------------------------------------


@pytest.fixture(scope="module")
def hot_records(spark):
    """100k records; every third one belongs to entity 0."""
    n = F.col("id")
    return spark.range(100_000).select(
        F.when(n % 3 == 0, F.lit(0)).otherwise(n % 5_000).cast("string").alias("id"),
        F.lit("3 Month Assessment").alias("event"),
        F.when(n % 2 == 0, F.lit("Yes")).alias("gq_complete"),
        F.lit(None).cast("string").alias("ls_complete"),
        F.date_add(F.lit(d("2020-04-01")), (n % 20).cast("int")).alias("gq_date"),
    )


@pytest.mark.parametrize("merge", [False, True])
def test_records_of_a_hot_entity(spark, hot_records, merge):
    entities = spark.range(6_000).select(
        F.col("id").cast("string").alias("id"),
        F.lit(d("2020-01-01")).alias("hospdis_date"),
        F.lit(None).cast("date").alias("death_date"),
        F.lit(None).cast("date").alias("studywd_date"),
        F.lit("Discharged alive").alias("inhosp_status"),
    )
    with conf(
        spark,
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="8KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor=2,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="8KB",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1KB",
    ):
        status = followup.followup_status(
            entities, followup.slim_records(hot_records, TWO), TWO,
            anchor_col="hospdis_date", window_dim=WINDOWS, visits=list(VISITS),
            as_of=d("2021-01-01"), merge=merge,
        )
        probe = status.groupBy("id", "event").agg(
            F.count("*").alias("n"), F.count_if("fu_comp").alias("done"),
            F.max("last_asmt").alias("last"),
        )
        got = {(r.id, r.event): (r.n, r.done, r.last) for r in probe.collect()}
        totals = followup.followup_totals(status)
        totals.collect()
        text = plan(totals)
    # Hot partitions are split, or there are none left after folding.
    assert ("skew=true" in text) is not merge
    want = {(str(k), v): [0, 0, None] for k in range(6_000) for v in VISITS}
    for i in range(100_000):
        cell = want["0" if i % 3 == 0 else str(i % 5_000), "3 Month Assessment"]
        cell[0] += 1
        cell[1] += i % 2 == 0
        day = d("2020-04-01") + dt.timedelta(i % 20)
        cell[2] = day if cell[2] is None else max(day, cell[2])
    for cell in want.values():
        cell[0] = 1 if merge else max(cell[0], 1)
        cell[1] = min(cell[1], 1) if merge else cell[1]
    assert got == {k: tuple(v) for k, v in want.items()}


def test_counted_records_of_a_hot_entity(spark, hot_records):
    """Alike records leave a map task as one row; the counts are those of all records."""
    entities = spark.range(6_000).select(
        F.col("id").cast("string").alias("id"),
        F.lit(d("2020-01-01")).alias("hospdis_date"),
        F.lit(None).cast("date").alias("death_date"),
        F.lit(None).cast("date").alias("studywd_date"),
        F.lit("Discharged alive").alias("inhosp_status"),
    )
    kinds = followup.slim_records(hot_records, TWO)

    def status(**how):
        return followup.followup_status(
            entities, kinds, TWO, anchor_col="hospdis_date", window_dim=WINDOWS,
            visits=list(VISITS), as_of=d("2021-01-01"), **how,
        )

    counted, each = status(counted=True), status()
    assert counted.where("id = '0'").count() == 1 + 2
    for summary in (followup.followup_counts, followup.followup_totals):
        assert rows(summary(counted)) == rows(summary(each))
    assert rows(followup.followup_instruments(counted, TWO, WINDOWS)) == rows(
        followup.followup_instruments(each, TWO, WINDOWS)
    )
    text = plan(followup.followup_totals(counted))
    assert text.index("partial_count") > text.index("Exchange hash")
    with pytest.raises(ValueError, match="either merged or counted"):
        status(counted=True, merge=True)


def test_observations_are_counted_before_the_shuffle(spark):
    """A hot entity leaves each map task as one row."""
    text = plan(entry.queries()["visit_compliance"](spark, SF))
    lineitem = text[: text.index("lineitem.parquet")]
    assert lineitem.rindex("partial_count") > lineitem.rindex("Exchange hash")


def test_compliance_of_a_hot_entity(spark):
    stays = spark.createDataFrame(
        [("0", d("2020-01-01"), None), ("1", d("2020-01-01"), d("2020-01-02"))],
        "id string, enroll_date date, death_date date",
    )
    n = F.col("id")
    obs = spark.range(30_000).select(
        F.lit("0").alias("id"), F.lit("d1").alias("event"),
        F.when(n % 2 == 0, 1).otherwise(0).alias("blue"),
    )
    schedule = [
        expected.Visit(1, "d1", "Day 1", ("In",), or_transition=True),
        expected.Visit(3, "d3", "Day 3", ("In",), or_transition=True),
    ]

    def run(**options):
        return rows(
            expected.expected_vs_observed(
                stays, obs, schedule, measures={"blue": "blue"},
                rules=[("death_date", "Dead")], default_state="In", **options,
            ),
            "day", "n_expected", "n_done",
        )

    assert run() == [("Day 1", 30_001, 15_000), ("Day 3", 1, 0)]
    assert run(dedupe=True) == [("Day 1", 2, 1), ("Day 3", 1, 0)]
    assert run(dedupe=True, as_of=d("2020-01-02")) == [("Day 1", 2, 1)]


def test_removals_of_a_hot_entity(spark):
    """Copies count once; slots and days count each."""
    days = spark.range(20_000).select(
        F.lit("0").alias("id"),
        F.date_add(F.lit(d("2020-01-01")), (F.col("id") % 10).cast("int")).alias("daily_date"),
        F.lit("Permanent discontinuation").alias("s1"),
        F.when(F.col("id") % 2 == 0, F.lit("Bathing")).alias("s2"),
        F.lit("Bathing").alias("s3"),
    )
    entities = spark.createDataFrame(
        [("0", d("2020-01-10")), ("0", d("2020-01-10"))], "id string, hospdis_date date"
    )
    events = device.removal_events(
        days, entities, ["s1", "s2", "s3"], permanent=PERMANENT, prep_label=BEFORE_DISCHARGE
    )
    assert rows(events, "reason_mod", "n_events") == [
        ("Bathing", 15),  # 5 even days in slot 2, 10 days in slot 3
        ("Permanent discontinuation", 8),
        ("Removed within a day of hospital discharge", 2),
    ]


def test_long_id_list_is_cut_by_place(spark):
    """One form for any size: sorted pages, spread over tasks, repeated ids kept."""
    ids = spark.range(5_000).select(F.format_string("P%05d", F.col("id") % 4_990).alias("id"))
    lines = sorted(funnel.id_lines(ids.repartition(7), per_line=500).collect(), key=lambda r: r.line)
    assert [(r.line, r.n_ids, r.ids.count("; ")) for r in lines] == [(i, 5_000, 499) for i in range(10)]
    found = [i for line in lines for i in line.ids.split("; ")]
    assert found == sorted(f"P{i % 4_990:05d}" for i in range(5_000))
    assert rows(funnel.id_lines(ids.limit(3), per_line=500))[0][:2] == (0, 3)


@pytest.mark.parametrize(
    "name",
    [
        "study_flow",
        "study_flow_by_priority",
        "followup_not_yet_text",
        "followup_instruments_all_records",
        "followup_instruments_group_windows",
        "followup_totals_group_windows",
    ],
)
def test_tasks_of_the_followup_grow_with_the_tables(spark, tmp_path, monkeypatch, name):
    orders = [
        (k, k, "FOP"[k % 3], f"{k % 5 + 1}-{('URGENT', 'HIGH', 'MEDIUM', 'NOT', 'LOW')[k % 5]}", dt.datetime(2000, 1, 1 + k % 28))
        for k in range(40)
    ]
    kinds = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp"
    spark.createDataFrame(orders, kinds).write.parquet(f"{tmp_path}/orders.parquet")
    lines = [
        (k, n, "RAN"[(k + n) % 3], day + dt.timedelta(days=20 * n + 15))
        for k, *_, day in orders
        for n in (1, 1, 2, 3, 4)
    ]
    kinds = "l_orderkey long, l_linenumber int, l_returnflag string, l_shipdate timestamp"
    spark.createDataFrame(lines, kinds).write.parquet(f"{tmp_path}/lineitem.parquet")
    few = rows(QUERIES[name](spark, str(tmp_path)))
    assert "REPARTITION_BY_NUM" not in plan(warehouse._visit_lines(spark, str(tmp_path)))
    # 240 rows of 16 to a task: 15 tasks, more than the session's 8 shuffle partitions.
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 16)
    visits = warehouse._visit_lines(spark, str(tmp_path))
    assert plan(visits).count("15), REPARTITION_BY_NUM") == 2
    assert visits.rdd.getNumPartitions() == 15
    assert rows(QUERIES[name](spark, str(tmp_path))) == few


def test_many_rows_are_dealt_to_more_ranges(spark, monkeypatch):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), (97 - F.col("id")).alias("x"))
    few = rows(positions.with_positions(df, ["x"], by=["g"]))
    written = []
    monkeypatch.setattr(positions, "staged", lambda part: written.append(plan(part)) or staging.staged(part))
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 5)
    assert rows(positions.with_positions(df, ["x"], by=["g"])) == few
    assert "20), REPARTITION_BY_NUM" in written[-1]


def test_positions_of_groups_over_many_ranges(spark):
    """A hot group, a missing group, ties and nulls; places are those of the sorted group."""
    data = [("hot", i % 700) for i in range(3_000)] + [(None, 5), (None, None), ("a", 1), ("b", 2), ("b", 2)]
    df = spark.createDataFrame(data, "g string, x int").repartition(5)
    with conf(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        placed = positions.with_positions(df, ["x"], by=["g"]).collect()
    got = {}
    for r in placed:
        got.setdefault(r.g, []).append((r.position, r.x))
        assert r.group_size == sum(g == r.g for g, _ in data)
    for group, found in got.items():
        want = sorted((x for g, x in data if g == group), key=lambda x: (x is not None, x))
        assert sorted(found) == list(enumerate(want))
    assert positions.with_positions(df.limit(0), ["x"], by=["g"]).collect() == []


def test_staging_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(Session())


def test_id_list_of_nobody(spark):
    nobody = spark.createDataFrame([], "id string")
    assert rows(funnel.id_lines(nobody)) == []
    assert rows(funnel.id_lines(nobody, empty="None")) == [(0, 0, "None")]
    with pytest.raises(ValueError, match="without groups"):
        funnel.id_lines(nobody.withColumn("g", F.lit(1)), by=["g"], empty="None")


def test_linked_states_count_pairs_without_making_them(spark):
    """Entity 0 has 3000 x 2000 pairs; they are multiplied, not joined."""
    data = (
        [("0", 1, "a")] * 3_000 + [("0", 2, "b")] * 2_000
        + [("1", 1, "a"), ("1", 1, "b"), ("1", 2, "b")] + [("2", 2, "a")] + [("3", 1, "a")]
    )
    df = spark.createDataFrame(data, "id string, stage int, state string")
    stage = F.col("stage")
    edges = flow.state_flow(
        [
            flow.link_states(
                df, id_cols=["id"],
                first=(stage == 1, F.col("state")),
                second=(stage == 2, F.col("state")),
            )
        ]
    )
    assert rows(edges, "source", "target", "weight", "target_total") == [
        ("a", "b", 6_000_001, 6_000_002), ("b", "b", 1, 6_000_002), (None, "a", 1, 1),
    ]


def test_any_state_is_linked_and_rows_without_id_never_match(spark):
    data = [
        ("3", 1, "a"), ("3", 2, "new"), ("2", 1, "new"), ("2", 2, "b"), ("1", 1, None),
        ("1", 2, "b"), (None, 1, "a"), (None, 2, "c"), (None, 2, "c"),
    ]
    df = spark.createDataFrame(data, "id string, stage int, state string")
    stage, state = F.col("stage"), F.col("state")
    edges = flow.link_states(df, id_cols=["id"], first=(stage == 1, state), second=(stage == 2, state))
    assert rows(flow.state_flow([edges]), "source", "target", "weight") == [
        ("a", "new", 1), ("new", "b", 1), (None, "b", 1), (None, "c", 2),
    ]


def test_stages_are_linked_in_one_pass(spark):
    """Three stages with weights: the same edges as stage by stage, and those from the origin."""
    data = [
        ("1", 1, "a", "x", 2), ("1", 2, "b", None, 3), ("1", 3, "c", None, 1),
        ("2", 2, "b", None, 1), ("3", 1, "a", "y", 1), ("3", 3, "c", None, 5),
        (None, 1, "a", "x", 1), (None, 2, "b", None, 1),
    ]
    df = spark.createDataFrame(data, "id string, stage int, state string, origin string, n long")
    stages = [(F.col("stage") == k, F.col("state")) for k in (1, 2, 3)]
    edges = flow.stage_edges(
        df, id_cols=["id"], stages=stages, origin=F.col("origin"), weight="n"
    )
    assert rows(flow.state_flow([edges]), "source", "target", "weight") == [
        ("a", "b", 6), ("b", "c", 3), ("x", "a", 3), ("y", "a", 1), (None, "b", 2), (None, "c", 5),
    ]


def test_a_path_ends_at_its_first_gap(spark):
    paths = spark.createDataFrame(
        [("x", None, "z"), (None, "y", "z"), ("x", "y", "z")], "s1 string, s2 string, s3 string"
    )
    edges = flow.path_edges(paths, ["s1", "s2", "s3"], start="Start")
    assert rows(edges, "source", "target") == [
        ("Start", "x"), ("Start", "x"), ("x", "y"), ("y", "z"),
    ]
    edges = flow.path_edges(paths, ["s1", "s2", "s3"])
    assert rows(edges, "source", "target") == [("x", "y"), ("y", "z")]


def test_an_undated_entity_has_no_battery_flag(spark):
    rows_ = spark.createDataFrame(
        [(None, "Yes", "No"), (d("2020-01-01"), "Yes", "Yes")], "enroll_date date, a string, b string"
    )
    flags = battery.completion_flags(rows_, {"a": None, "b": d("2020-01-01")})
    got = flags.select(battery.battery_flag(["a", "b"]).alias("full")).collect()
    assert [r.full for r in got] == [None, True]


# -- Repeated records, order of rows -----------------------------------------------


def _followup(spark, records, merge, visits=None):
    entities = spark.createDataFrame(
        [("a", d("2020-01-01")), ("b", d("2020-01-01"))], "id string, hospdis_date date"
    ).withColumns(
        {
            "death_date": F.lit(None).cast("date"),
            "studywd_date": F.lit(None).cast("date"),
            "inhosp_status": F.lit("Discharged alive"),
        }
    )
    slim = followup.slim_records(records, TWO, refusal=F.col("gq_rsn") == "Patient refusal")
    return followup.followup_status(
        entities, slim, TWO, anchor_col="hospdis_date", window_dim=WINDOWS,
        visits=visits or ["1 Month Phone Call", "3 Month Assessment", "Other"],
        as_of=d("2021-01-01"), merge=merge,
    )


@pytest.fixture(scope="module")
def repeated(spark):
    three = "3 Month Assessment"
    return spark.createDataFrame(
        [
            ("a", three, None, "Yes", None, "2020-04-01", None),
            ("a", three, None, "No", "Yes", None, "2020-05-01"),
            ("a", three, "Patient refusal", None, None, None, None),
            (None, three, None, "Yes", None, None, None),
        ],
        "id string, event string, gq_rsn string, gq_complete string, "
        "ls_complete string, gq_date string, ls_date string",
    ).withColumns({c: F.col(c).cast("date") for c in ("gq_date", "ls_date")})


def test_repeated_records_give_a_row_each(spark, repeated):
    out = _followup(spark, repeated, merge=False)
    three = out.where("event = '3 Month Assessment'")
    assert rows(three, "id", "fu_status", "n_asmts_full") == [
        ("a", followup.ASSESSED, 1),
        ("a", followup.ASSESSED, 1),
        ("a", followup.REFUSED, 0),
        ("b", followup.ELIGIBLE, 0),
    ]
    assert out.count() == 4 + 2 * 2


def test_merged_records_give_one_row(spark, repeated):
    out = _followup(spark, repeated, merge=True)
    row = out.where("id = 'a' and event = '3 Month Assessment'").collect()
    assert len(row) == 1
    assert (row[0].n_asmts_full, row[0].all_full, row[0].refused) == (2, True, True)
    assert (row[0].first_asmt, row[0].last_asmt) == (d("2020-04-01"), d("2020-05-01"))
    assert out.count() == 2 * 3


def test_merging_by_visits_of_the_records_is_the_same(spark, repeated):
    """Visits read from the records take another way to the same rows."""
    cols = ["id", "fu_status", "n_asmts_full", "refused", "first_asmt", "last_asmt",
            "gq_complete", "ls_complete"]
    three = "event = '3 Month Assessment'"
    listed = _followup(spark, repeated, merge=True).where(three)
    read = _followup(spark, repeated, merge=True, visits=repeated)
    assert rows(read, *cols) == rows(listed, *cols)


def test_visit_without_a_window(spark, repeated):
    out = _followup(spark, repeated, merge=True).where("event = 'Other'")
    assert rows(out, "fu_month", "enter_window", "in_window", "fu_status") == [
        (None, None, None, followup.ELIGIBLE),
    ] * 2


@pytest.mark.parametrize(
    "name", ["state_flow", "reason_share", "followup_totals", "orders_without_lines"]
)
def test_result_does_not_depend_on_row_order(spark, name, tmp_path):
    """The same tables, shuffled into many files."""
    for table in ("orders", "lineitem", "customer"):
        df = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet")
        df.orderBy(F.rand(7)).repartition(13).write.parquet(f"{tmp_path}/{table}.parquet")
    query = entry.queries()[name]
    assert rows(query(spark, str(tmp_path))) == rows(query(spark, "/root/testdata/sf0.001"))


# -- More flags than a number has bits ---------------------------------------------


@pytest.mark.parametrize("how", [{}, {"merge": True}, {"counted": True}])
def test_two_hundred_instruments(spark, how):
    """Flags beyond the first 63 count and come back as the others do."""
    stems = [f"i{k}" for k in range(200)]
    many = followup.Instruments(phone=tuple(stems[:70]), full=tuple(stems[60:]), undated=tuple(stems))
    done = {"1 Month Phone Call": range(0, 70, 3), "3 Month Assessment": range(60, 200, 7)}
    data = [("a", visit, *("Yes" if k in some else None for k in range(200))) for visit, some in done.items()]
    schema = "id string, event string, " + ", ".join(f"{s}_complete string" for s in stems)
    records = followup.slim_records(spark.createDataFrame(data, schema), many)
    entities = spark.createDataFrame(
        [("a", d("2020-01-01"), None, None, "Discharged alive"), ("b", d("2020-01-01"), None, None, "Discharged alive")],
        "id string, hospdis_date date, death_date date, studywd_date date, inhosp_status string",
    )
    status = followup.followup_status(
        entities, records, many, anchor_col="hospdis_date", window_dim=WINDOWS,
        visits=list(VISITS), as_of=d("2021-01-01"), **how,
    )
    got = {(r.id, r.event): r for r in status.collect()}
    assert got["a", VISITS[0]].n_asmts_phone == len(done[VISITS[0]])
    assert got["a", VISITS[1]].n_asmts_full == len(done[VISITS[1]])
    for visit, asked in zip(VISITS, (range(70), range(60, 200))):
        row = got["a", visit]
        for k in range(200):
            assert row[f"i{k}_complete"] == (k in done[visit] if k in asked else None), k
    assert got["b", VISITS[1]].i199_complete is False and got["b", VISITS[1]].i0_complete is None
    with conf(spark, spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold=-1):
        text = spark._jvm.PythonSQLUtils.explainString(
            followup.followup_totals(status)._jdf.queryExecution(), "codegen"
        )
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)) <= 8000


def test_a_hundred_slots(spark):
    slots = [f"s{k}" for k in range(100)]
    data = [("a", d("2020-01-01"), *("Bathing" if k % 3 == 0 else None for k in range(100)))] * 2
    days = spark.createDataFrame(data, "id string, daily_date date, " + ", ".join(f"{s} string" for s in slots))
    entities = spark.createDataFrame([("a", d("2020-02-01"))], "id string, hospdis_date date")
    events = device.removal_events(days, entities, slots, permanent=PERMANENT, prep_label=BEFORE_DISCHARGE)
    assert rows(events, "reason_mod", "n_events") == [("Bathing", 34)]
    three = device.removal_events(days, entities, slots[:3], permanent=PERMANENT, prep_label=BEFORE_DISCHARGE)
    assert rows(three, "reason_mod", "n_events") == [("Bathing", 1)]
