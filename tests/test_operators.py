"""Scores, keys, dimensions, sinks and the registry on small inputs."""

import datetime as dt
from dataclasses import replace

import pytest

from sluice.operators import quarantine, scoring
from sluice.operators.catalog import BY_KEY, RULES, credit_unparsed
from sluice.operators.evaluate import evaluate, evaluate_isolated, registry, rules_for_table, violating_rows
from sluice.operators.extended import EXTENDED_RULES, GROUPS
from sluice.operators.external import EXTERNAL_RULES
from sluice.functions.columns import number
from sluice.operators.keys import surrogate_key
from sluice.operators.scd2 import merge_into, scd2_merge
from sluice.plans import curation
from sluice.plans.monitoring import pct_share
from sluice.sources import sinks
from sluice.sources.schemas import raw_schema
from sluice.sources.versions import VersionedTable
from sluice.sources.tables import append_batches, literal_rows, shared_dir, text_schema

AS_OF = dt.date(2001, 7, 1)
RESULT = "rule_code string, dq_dimension string, severity string, total_records bigint, failed_records bigint," \
         " status string, details string"


def results(spark, *rows):
    return spark.createDataFrame([(*row, "text") for row in rows], RESULT)


def test_suite_sizes():
    assert len(RULES) == 62 and len({r.code for r in RULES}) == 62
    assert len(EXTERNAL_RULES) == 25
    assert len({r.code for r in EXTENDED_RULES}) == len(EXTENDED_RULES)
    assert {r.group for r in EXTENDED_RULES} == set(GROUPS)


def test_score_formula(spark):
    df = results(
        spark,
        ("A", "Completeness", "CRITICAL", 10, 5, "FAIL"),
        ("B", "Completeness", "LOW", 0, 0, "PASS"),
        ("C", "Validity", "ODD", 4, 4, "WARNING"),
    )
    # lost 30 * 0.5 + 5 * 1 of 30 + 5 + 5
    assert scoring.overall(df).first()[0] == 50.0
    scores = {r.dq_dimension: r.dimension_score for r in scoring.by_dimension(df).collect()}
    assert scores == {"Completeness": round(100 - 15 / 35 * 100, 2), "Validity": 0.0}
    assert scoring.graded(df).first().grade == "D"
    assert scoring.overall(df.filter("false")).first()[0] == 0.0
    row = scoring.summary_row(df, "R", AS_OF).first()
    assert (row.total_rules_run, row.rules_passed, row.rules_failed) == (3, 1, 2)
    assert row.uniqueness_score == 0.0 and row.critical_failures == 1 and row.high_failures == 0


@pytest.mark.parametrize("value,letter", [(90, "A"), (89.99, "B"), (75, "B"), (60, "C"), (50, "D"), (49.9, "F")])
def test_grade(spark, value, letter):
    assert spark.sql(f"SELECT {scoring.grade(f'{value}D')}").first()[0] == letter


def test_score_never_negative(spark):
    df = results(spark, ("A", "Consistency", "HIGH", 10, 50, "FAIL"))
    assert scoring.overall(df).first()[0] == 0.0


def test_failed_checks_order(spark):
    df = results(
        spark,
        ("A", "Validity", "LOW", 1, 1, "WARNING"),
        ("B", "Validity", "CRITICAL", 1, 1, "FAIL"),
        ("C", "Validity", "HIGH", 1, 0, "PASS"),
    )
    assert [r.rule_code for r in scoring.failed_checks(df).collect()] == ["B", "A"]


def test_registry_holds_the_conditions(spark):
    rows = registry(spark, RULES).collect()
    assert len(rows) == 62
    assert {r.rule_code: r.sql_check for r in rows}["V-011"] == "try_cast(hourly_rate AS double) > 500"


def test_filter_by_table():
    assert {r.table for r in rules_for_table(RULES, "invoices")} == {"invoices"}


def test_broken_rule_is_isolated(spark, raw):
    broken = replace(BY_KEY["c_001"], code="BROKEN", fails="nothing_here > 1")
    rows = {r.rule_code: r for r in evaluate_isolated(raw, [broken, BY_KEY["c_002"]], AS_OF).collect()}
    assert rows["BROKEN"].status == "ERROR" and rows["BROKEN"].total_records is None
    assert rows["C-002"].status == "FAIL"


def test_failed_never_exceeds_total(raw):
    for r in evaluate(raw, [r for r in RULES if r.key != "cs_007"], AS_OF).collect():
        assert 0 <= r.failed_records <= r.total_records
        assert 0 <= r.pass_rate <= 100


def test_one_scan_per_table(raw):
    rules = [r for r in RULES if r.table == "invoices" and not hasattr(r, "profile")]
    plan = evaluate(raw, rules, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_calendar(spark):
    dates = curation.dim_date(curation.days(spark))
    assert dates.count() == 4748
    row = dates.filter("full_date = DATE'2024-02-29'").first()
    assert (row.date_sk, row.week_num, row.day_of_week, row.day_name, row.is_weekend) == (
        20240229, 9, 5, "Thursday", False,
    )
    by_sunday = curation.dim_date(curation.days(spark), curation.SUNDAY_WEEK, fiscal=False)
    weeks = {str(r.full_date): r.week_num for r in by_sunday.filter("date_sk IN (20230101,20230107,20230108)").collect()}
    assert weeks == {"2023-01-01": 1, "2023-01-07": 1, "2023-01-08": 2}
    capped = curation.days(spark, curation.FIRST_DAY, dt.date(2025, 12, 31))
    assert capped.count() == 4018


def test_scd2(spark):
    schema = "id string, name string, effective_from date, effective_to date, is_current boolean"
    day = dt.date(2020, 1, 1)
    dim = spark.createDataFrame(
        [("a", "A", day, None, True), ("b", "B", day, None, True), ("c", "C", day, None, True),
         ("d", None, day, None, True), ("a", "A0", dt.date(2019, 1, 1), day, False)], schema)
    new = spark.createDataFrame([("a", "A"), ("b", "B2"), ("e", "E"), ("d", None)], "id string, name string")
    now = dt.date(2021, 5, 5)
    merged = scd2_merge(dim, new, "id", ["name"], now)
    rows = {(r.id, r.name, r.effective_from, r.effective_to, r.is_current) for r in merged.collect()}
    assert rows == {
        ("a", "A", day, None, True), ("a", "A0", dt.date(2019, 1, 1), day, False),
        ("b", "B", day, now, False), ("b", "B2", now, None, True),
        ("c", "C", day, None, True), ("d", None, day, None, True), ("e", "E", now, None, True),
    }
    again = scd2_merge(merged, new, "id", ["name"], dt.date(2022, 1, 1))
    assert {(r.id, r.name, r.effective_from, r.effective_to, r.is_current) for r in again.collect()} == rows


def test_scd2_keeps_keys_and_takes_a_null_key_once(spark):
    day, steps = dt.date(2020, 1, 1), [dt.date(2021, 1, 1), dt.date(2022, 1, 1), dt.date(2023, 1, 1)]
    first = spark.createDataFrame([(f"k{i}", "old") for i in range(50)], "id string, name string")
    dim = surrogate_key(
        first.selectExpr("*", f"DATE'{day}' AS effective_from", "CAST(NULL AS date) AS effective_to", "true AS is_current"), ["id"], "sk", 1
    )
    given = {(r.id, r.effective_from): r.sk for r in dim.collect()}
    new = spark.createDataFrame([("k1", "new"), ("k2", "new"), (None, "none"), ("x", "x")], "id string, name string")
    for now in steps:
        dim = scd2_merge(dim, new, "id", ["name"], now, "sk")
        rows = dim.collect()
        assert len(rows) == 54 and len({r.sk for r in rows}) == 54
        assert all(given.get((r.id, r.effective_from), r.sk) == r.sk for r in rows)
        given |= {(r.id, r.effective_from): r.sk for r in rows}
        assert sum(r.id is None for r in rows) == 1


def test_scd2_refuses_repeated_keys(spark):
    dim = spark.createDataFrame([("a", "A", AS_OF, None, True)], "id string, name string, effective_from date, effective_to date, is_current boolean")
    for twice in (("a", "B"), (None, "B")):
        new = spark.createDataFrame([twice, twice, ("c", "C")], "id string, name string")
        with pytest.raises(Exception, match="comes more than once"):
            scd2_merge(dim, new, "id", ["name"], AS_OF).collect()


def test_stored_dimension_is_merged_by_buckets(spark, tmp_path):
    """Against the merge of whole frames, load after load; buckets without a change keep their files."""
    shape = "id string, name string, effective_from date, effective_to date, is_current boolean"
    rows = [(f"k{i}" if i else None, "old", dt.date(2020, 1, 1), None, True) for i in range(400)]
    first = surrogate_key(spark.createDataFrame(rows, shape), ["id"], "sk", 1)
    table = VersionedTable(spark, str(tmp_path / "d"))
    whole = sinks.overwrite(first, str(tmp_path / "w"))
    table.write_buckets(first, ["id"], 16)
    loads = [[("k1", "new"), (None, "none"), ("x", "x")], [("k1", "new"), ("k2", "old")], [("k1", "newer"), ("y", None)]]
    for year, new in enumerate(loads, 2021):
        incoming = spark.createDataFrame(new, "id string, name string")
        day = dt.date(year, 1, 1)
        files = {f for f in table.read().inputFiles()}
        whole = sinks.overwrite(scd2_merge(whole, incoming, "id", ["name"], day, "sk"), str(tmp_path / "w"))
        merged = merge_into(table, incoming, "id", ["name"], day, "sk")
        assert sorted(map(tuple, merged.select(*whole.columns).collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
        assert len({r.sk for r in merged.collect()}) == merged.count()
        changed = len(files - set(table.read().inputFiles()))
        assert changed <= 3 if year != 2022 else changed == 0
    with pytest.raises(Exception, match="comes more than once"):
        merge_into(table, spark.createDataFrame([("q", "1"), ("q", "2")], "id string, name string"), "id", ["name"], AS_OF, "sk")


def test_known_keys_stay(spark):
    some = spark.range(0, 400).selectExpr("cast(id AS string) AS k")
    more = spark.range(100, 900).selectExpr("cast(id AS string) AS k")
    given = surrogate_key(some, ["k"], "sk", 2)
    before = {r.k: r.sk for r in given.collect()}
    after = {r.k: r.sk for r in surrogate_key(more, ["k"], "sk", 2, known=given).collect()}
    assert len(set(after.values())) == 800 and all(after[k] == v for k, v in before.items() if k in after)
    assert not {v for k, v in after.items() if k not in before} & set(before.values())


def test_calendar_of_the_years_that_occur(spark):
    dates = spark.sql("SELECT DATE'1850-05-01' AS a, DATE'2150-01-01' AS b UNION ALL SELECT NULL, DATE'2000-02-02'")
    days = [r.full_date for r in curation.days_covering(dates, "a", "b").collect()]
    assert sorted({d.year for d in days}) == [1850, 2000, 2150] and len(days) == len(set(days)) == 365 + 366 + 365
    dated = curation._with_day(dates, curation.dim_date(curation.days_covering(dates, "a", "b")), "b", "b_sk")
    assert sorted(r.b_sk for r in dated.collect()) == [20000202, 21500101]


def test_script_book_parses_fixed_point(spark):
    texts = ["99999999999.00", "2.5e5", "12.345", "-1", None, "$5"]
    df = spark.createDataFrame([(t,) for t in texts], "v string").selectExpr(f"{number('v', 'decimal(12,2)')} AS d", f"{number('v')} AS f")
    rows = df.collect()
    assert [r.d is None for r in rows] == [True, True, False, False, True, True]
    assert [r.f is None for r in rows] == [False, False, False, False, True, True]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    path = str(tmp_path / "t")
    assert sinks.overwrite(df, path).count() == 2
    assert sinks.append(df, path).count() == 4
    assert sinks.overwrite(df, path).count() == 2
    more = spark.createDataFrame([(2, "x"), (3, "c")], "id long, v string")
    rows = sorted(tuple(r) for r in sinks.insert_if_absent(more, path, ["id"]).collect())
    assert rows == [(1, "a"), (2, "b"), (3, "c")]
    out = tmp_path / "csv"
    sinks.export_csv(df, str(out))
    files = list(out.glob("*.csv"))
    assert len(files) == 1 and files[0].read_text().splitlines()[0] == "id,v"


def test_row_counts(spark):
    df = spark.range(3)
    assert {tuple(r) for r in sinks.row_counts({"a": df, "b": df}).collect()} == {
        ("a", 3), ("b", 3), ("(all tables)", 6),
    }


def test_literal_rows_and_batches(spark):
    now = dt.datetime(2024, 1, 1)
    first = literal_rows(spark, [("1", None)], ["id", "v"], now, "B1")
    second = literal_rows(spark, [("1", "x")], ["id", "v"], now, "B2")
    assert first.schema == text_schema(["id", "v"])
    assert {r._batch_id for r in append_batches(first, second).collect()} == {"B1", "B2"}


def test_shared_dir_is_read_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_log_codes(spark):
    reasons = ["CRITICAL: x", "HIGH: negative credit_limit", "HIGH: unparseable credit_limit [TBD]",
               "HIGH: invalid account_status [1]", "MEDIUM: duplicate"]
    df = spark.createDataFrame([(r, "k", True) for r in reasons], "quarantine_reason string, id string,"
                               " is_quarantined boolean")
    now = dt.datetime(2024, 1, 1)
    log = quarantine.quarantine_log(df, "raw.customers", "id", "R", now)
    assert [(r.rule_code, r.severity) for r in log.collect()] == [
        ("C-001", "CRITICAL"), ("V-003", "HIGH"), ("V-004", "HIGH"), ("V-001", "HIGH"), ("U-002", "MEDIUM"),
    ]
    freed = spark.createDataFrame([("raw.customers", "k")], "source_table string, source_key string")
    done = quarantine.resolve(log, freed, now, "ann")
    assert {(r.resolved_flag, r.resolved_by) for r in done.collect()} == {(True, "ann")}
    later = quarantine.resolve(done, freed, dt.datetime(2025, 1, 1), "bob")
    assert {(r.resolved_date, r.resolved_by) for r in later.collect()} == {(now, "ann")}


def test_pct_share(spark):
    row = spark.sql(f"SELECT {pct_share('1', '3')} AS a, {pct_share('0', '0')} AS b").first()
    assert (row.a, row.b) == ("33.3%", "0.0%")


def test_listing_reads_only_what_it_shows(spark, raw, tmp_path):
    table = sinks.overwrite(raw["customers"], str(tmp_path / "customers"))
    plan = violating_rows(table, BY_KEY["c_002"], AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNull(account_status)]" in plan
    assert "ReadSchema: struct<customer_id:string,customer_name:string,account_status:string>" in plan


def test_suite_reads_only_the_columns_it_names(spark, raw, tmp_path):
    table = sinks.overwrite(raw["technicians"], str(tmp_path / "technicians"))
    rules = [BY_KEY["v_010"], BY_KEY["v_011"], BY_KEY["t_002"]]
    plan = evaluate({"technicians": table}, rules, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<hire_date:string,hourly_rate:string>" in plan


def test_amounts_in_another_type():
    assert "contains(lower(credit_limit), 'e')" in credit_unparsed("decimal(12,2)").fails
    assert credit_unparsed() == BY_KEY["v_004"]


def test_raw_schemas():
    assert raw_schema("invoices").names[-2:] == ["_extract_timestamp", "_batch_id"]
    assert {f.dataType.simpleString() for f in raw_schema("sites").fields[:-2]} == {"string"}
