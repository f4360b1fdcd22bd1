"""Hot keys: a third of all rows share one key; results against brute force."""

import datetime as dt
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sluice.operators import dedup
from sluice.operators.catalog import terminated_on_open
from sluice.operators.evaluate import childless_rows, key_rule_counts, orphan_rows, repeated_groups
from sluice.operators.catalog import BY_KEY
from sluice.operators.keys import surrogate_key
from sluice.operators.listings import shared_email_pairs
from sluice.plans.staging import with_parent_flag

ROWS = 30_000
AS_OF = dt.date(2024, 1, 15)


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hot"))
    spark.range(0, ROWS, 1, 8).selectExpr(
        "id", "if(id % 3 = 0, 'HOT', concat('k', id % 2000)) AS k", "CAST(id % 97 AS string) AS o"
    ).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def small_splits(settings):
    settings(
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        }
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def local(df):
    return [(r.id, r.k, r.o) for r in df.collect()]


def test_joins_split_a_hot_key(spark, hot, small_splits):
    parent = hot.select("k")
    flagged = with_parent_flag(hot, parent.filter("k <> 'HOT'"), "k", "ok")
    assert "skew=true" in final_plan(flagged)
    assert flagged.filter("NOT ok").count() == ROWS // 3
    orphans = orphan_rows(hot, parent.filter("k <> 'HOT'"), "k")
    assert "skew=true" in final_plan(orphans)
    assert orphans.count() == ROWS // 3
    assert "skew=true" in final_plan(childless_rows(hot, parent, "k"))


def test_repeated_groups_list_every_member(spark, hot, small_splits):
    groups = repeated_groups(hot, ["k"], "id", "n")
    assert "skew=true" in final_plan(groups)
    rows = groups.collect()
    expected = defaultdict(list)
    for i, k, _ in local(hot):
        expected[k].append(i)
    got = defaultdict(list)
    for r in rows:
        got[r.k].append(r.id)
        assert r.n == len(expected[r.k])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items() if len(v) > 1}


def test_repeated_groups_keep_null_key(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), ("x", "c")], "k string, m string")
    assert [tuple(r) for r in repeated_groups(df, ["k"], "m", "n").orderBy("m").collect()] == [(None, "a", 2), (None, "b", 2)]


def test_rank_splits_a_hot_key(spark, hot, settings):
    settings(**{"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    order = [F.col("o").desc_nulls_last(), F.col("id").asc()]
    got = {(r.id): r.rn for r in dedup.ranked(hot, ["k"], order).collect()}
    groups = defaultdict(list)
    for i, k, o in local(hot):
        groups[k].append((o, i))
    expected = {}
    for members in groups.values():
        members.sort(key=lambda m: m[1])
        members.sort(key=lambda m: m[0], reverse=True)
        expected.update({i: rank for rank, (_, i) in enumerate(members, 1)})
    assert got == expected


def test_latest_is_limited_before_the_shuffle(spark, hot):
    latest = dedup.keep_latest(hot, ["k"], [F.col("o").desc(), F.col("id").asc()])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Final") < plan.index("Exchange")
    best = {}
    for i, k, o in local(hot):
        if k not in best or (o, -i) > (best[k][0], -best[k][1]):
            best[k] = (o, i)
    assert {r.k: (r.o, r.id) for r in latest.collect()} == best


def test_key_counts_combine_before_the_shuffle(spark, hot):
    frames = {"work_orders": hot.selectExpr("k AS work_order_id", "'X' AS status")}
    counts = key_rule_counts(frames, [BY_KEY["u_003"]], AS_OF)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
    assert counts.first().failed_records == ROWS - hot.select("k").distinct().count()


def test_pair_rule_counts_join_rows(spark):
    frames = {
        "assignments": spark.createDataFrame([("w1", "t1"), ("w1", "t1"), ("w2", "t2"), (None, "t1")],
                                             "work_order_id string, technician_id string"),
        "work_orders": spark.createDataFrame([("w1", "DRAFT"), ("w1", "ON HOLD"), ("w1", "COMPLETED"), ("w2", "X")],
                                             "work_order_id string, status string"),
        "technicians": spark.createDataFrame([("t1", "terminated"), ("t1", "TERMINATED"), ("t2", "ACTIVE")],
                                             "technician_id string, employment_status string"),
    }
    row = terminated_on_open(frames, AS_OF).first()
    # two assignments, each with two open orders and two terminated records
    assert (row.total_records, row.failed_records) == (4, 8)


def test_shared_email_groups_stay_linear(spark):
    rows = [(f"C{i:03}", "n", "Same@x.co" if i % 2 else "same@x.co  ", "APP", i) for i in range(50)]
    rows += [("D1", "n", "two@x.co", "APP", 91), ("D2", "n", "two@x.co", "APP", 92), ("D3", "n", None, "APP", 93)]
    df = spark.createDataFrame(
        rows, "customer_id string, customer_name string, email_address string, source_system string, _src_row long"
    )
    pairs = [(r.customer_id_1, r.customer_id_2) for r in shared_email_pairs({"customers": df}).collect()]
    assert sorted(pairs) == sorted([("C000", f"C{i:03}") for i in range(1, 50)] + [("D1", "D2")])


def test_surrogate_keys_are_unique_and_repeatable(spark, hot):
    keyed = surrogate_key(hot.selectExpr("CAST(id AS string) AS id"), ["id"], "sk", digits=2)
    first = {r.id: r.sk for r in keyed.collect()}
    assert len(set(first.values())) == ROWS
    places = defaultdict(list)
    for sk in first.values():
        places[sk >> 40].append(sk & (1 << 40) - 1)
    assert all(sorted(p) == list(range(1, len(p) + 1)) for p in places.values())
    again = surrogate_key(hot.repartition(5).selectExpr("CAST(id AS string) AS id"), ["id"], "sk", digits=2)
    assert {r.id: r.sk for r in again.collect()} == first


def test_duplicate_flags_against_brute_force(spark):
    rows = []
    for i in range(3000):
        email = None if i % 3 == 0 else f"E{i % 400}@x.co "
        rows.append((i, f"C{i % 1100}", email, f"2024-01-{1 + i % 28:02} 00:00:00" if i % 5 else "N/A", i % 7))
    df = spark.createDataFrame(
        rows, "_src_row long, customer_id string, email_address string, last_modified string, t int"
    ).selectExpr("_src_row", "customer_id", "email_address", "last_modified",
                 "timestamp_seconds(t) AS _extract_timestamp")
    by_email, by_id = {}, {}
    for row, cid, email, modified, t in rows:
        key = None if email is None else email.strip().lower()
        stamp = "" if modified == "N/A" else modified
        if key not in by_email or (stamp, -row) > by_email[key]:
            by_email[key] = (stamp, -row)
        if cid not in by_id or (t, -row) > by_id[cid]:
            by_id[cid] = (t, -row)
    first_email, first_id = {-r for _, r in by_email.values()}, {-r for _, r in by_id.values()}
    for r in dedup.with_duplicate_flags(df).collect():
        assert r.is_email_duplicate == (r._src_row not in first_email)
        assert r.is_id_duplicate == (r._src_row not in first_id)
        assert r.is_duplicate == (r.is_email_duplicate or r.is_id_duplicate)


def test_master_key_is_another_id(spark):
    rows = [(1, "C1", "a@x.co"), (2, "C2", "A@x.co "), (3, "C3", "a@x.co"), (4, "C4", "b@x.co"), (5, "C4", "b@x.co")]
    df = spark.createDataFrame(rows, "_src_row long, customer_id string, email_address string")
    flagged = df.withColumn("is_duplicate", F.col("_src_row") != 1)
    got = {r._src_row: r.duplicate_of_key for r in dedup.with_master_key(flagged, df).collect()}
    assert got == {1: None, 2: "C1", 3: "C1", 4: None, 5: None}
    assert Counter(got.values())[None] == 3
