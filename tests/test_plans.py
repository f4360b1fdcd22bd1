"""How often queries read their tables."""

import datetime as dt
import re
from collections import Counter
from dataclasses import replace

import pytest

from sluice.operators import dedup
from sluice.operators import evaluate as evaluation
from sluice.operators.catalog import BY_KEY, RULES, terminated_on_open
from sluice.operators.evaluate import evaluate, evaluate_days, rule_counts
from sluice.operators.rules import KeyRule, RowRule
from sluice.plans import staging
from sluice.queries import AS_OF, LOAD, QUERIES, customers_dim, extended_frames


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return Counter(re.findall(r"/(\w+)\.parquet\]", plan))


@pytest.mark.parametrize(
    "name,most",
    [
        ("x_assignment_contradictions", {"lineitem": 4, "orders": 2}),
        ("before_after_report", {"customer": 5, "orders": 2}),
        ("pipeline_run_log", {"customer": 4, "orders": 2}),
        ("stage_customers", {"customer": 2}),
    ],
)
def test_tables_are_read_so_often_at_most(spark, data, name, most):
    found = scans(QUERIES[name](spark, data))
    assert found and found <= Counter(most), found


def test_a_merge_reads_customers_three_times_in_all(raw):
    """Twice for the dimension, once for the extract; everything after reads what was written."""
    columns = staging.clean_customer(LOAD)
    extract = raw["customers_batch2"].selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])
    incoming = dedup.keep_latest(extract, ["customer_id"], [dedup.newest_first("last_modified"), dedup.F.col("customer_name").asc()])
    assert 2 <= scans(customers_dim(raw))["customer"] + scans(incoming)["customer"] <= 3


def test_references_are_built_once(raw):
    frames = extended_frames(raw)
    assert frames["cities"] is frames["cities"] and frames["customers"] is not None


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((.+?), \d+\)", plan.split("== Initial Plan ==")[0])


def test_keys_move_with_their_own_columns_alone(raw):
    """A row on its way to a key carries that key, not those of other profiles."""
    rules = [r for r in RULES if isinstance(r, KeyRule)]
    widths = Counter(len(re.findall(r"#\d+", keys)) for keys in shuffles(rule_counts(raw, rules, AS_OF)))
    assert widths == {1: 5, 2: 1}  # work order, customer, technician, e-mail, employee; assignment by two


def test_assignments_of_terminated_technicians_move_once(raw):
    """The others do not move, and none moves to its technician."""
    found = shuffles(terminated_on_open(raw, AS_OF))
    assert sum("work_order_id" in keys for keys in found) == 1
    assert sum("technician_id" in keys for keys in found) <= 1  # the technicians themselves


def test_runs_of_several_days_count_once_what_no_day_changes(raw, tmp_path):
    days = [AS_OF - dt.timedelta(days=400 * k) for k in range(3)]
    calls = []

    class Counting:
        def __getitem__(self, table):
            calls.append(table)
            return raw[table]

    evaluated = evaluate_days(Counting(), RULES, days, str(tmp_path / "counts"))
    once = len(calls)
    calls.clear()
    evaluate_days(Counting(), RULES, days[:1], str(tmp_path / "one"))
    assert once == len(calls)  # as often as for one day
    outcomes = []
    for day in days:
        got = sorted(map(tuple, evaluated[day].collect()))
        assert got == sorted(map(tuple, evaluate(raw, RULES, day).collect()))
        outcomes.append(got)
    assert outcomes[0] != outcomes[1] != outcomes[2]


def test_a_failing_rule_repeats_no_other_pass(raw, monkeypatch):
    """Rules of other tables and keys are evaluated once."""
    seen = Counter()

    def counted(frames, rules, as_of):
        rules = list(rules)
        seen.update(r.code for r in rules)
        return evaluate(frames, rules, as_of)

    monkeypatch.setattr(evaluation, "evaluate", counted)
    broken = replace(BY_KEY["v_016"], code="V-016R", fails="raise_error(coalesce(customer_id, 'none')) IS NULL")
    got = {r.rule_code: r.status for r in evaluation.evaluate_isolated(raw, [*RULES, broken], AS_OF).collect()}
    assert got.pop("V-016R") == "ERROR" and "ERROR" not in got.values() and len(got) == len(RULES)
    assert {seen[r.code] for r in RULES if not (isinstance(r, RowRule) and r.table == "customers")} == {1}


def test_generated_methods_stay_small_enough_to_be_compiled(spark, raw, settings):
    settings(spark__sql__codegen__hugeMethodLimit="65535")
    evaluate(raw, RULES[:2], AS_OF)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
