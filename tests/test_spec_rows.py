"""One hand-written row per behaviour."""

import datetime as dt

import pytest

from sluice.functions import standardize as std
from sluice.operators.catalog import BY_KEY
from sluice.operators.evaluate import evaluate, rule_counts, violating_rows
from sluice.operators.extended import EXTENDED_RULES
from sluice.operators.joins import attach_measured
from sluice.operators.lookups import WithLookups, learn, lookup_violations
from sluice.plans.staging import Load, stage_customers, stage_technicians, stage_work_orders
from sluice.sources.tables import literal_rows

AS_OF = dt.date(2024, 1, 15)
NOW = dt.datetime(2024, 1, 15, 6)
LOAD = Load(AS_OF, NOW, "B1", row_id="row_id")
X = {rule.key: rule for rule in EXTENDED_RULES}

CUSTOMER = {
    "row_id": "1", "customer_id": "CUST-1", "customer_name": "Acme", "customer_type": "SMB",
    "account_status": "ACTIVE", "credit_limit": "100.00", "primary_contact": "Ann", "email_address": "a@b.co",
    "phone_number": "555-1", "billing_city": "Austin", "billing_state": "TX", "billing_zip": "78701",
    "region_code": "SW", "created_date": "2020-01-01", "last_modified": "2024-01-01 08:00:00",
    "source_system": "APP",
}
ORDER = {
    "row_id": "1", "work_order_id": "WO-1", "work_order_number": "N-1", "site_id": "S-1", "customer_id": "CUST-1",
    "work_order_type": "INSPECTION", "priority": "LOW", "status": "COMPLETED", "description": "job",
    "scheduled_date": "2024-01-05", "actual_start": "2024-01-05 08:00:00", "actual_end": "2024-01-05 10:00:00",
    "estimated_hours": "2.0", "actual_hours": "2.0", "labor_cost": "130.00", "parts_cost": "0.00",
    "total_cost": "130.00", "sla_due_date": "2024-01-05 12:00:00", "sla_met": "Y", "resolution_code": "DONE",
    "created_date": "2024-01-03", "last_modified": "2024-01-05 11:00:00",
}
TECHNICIAN = {
    "row_id": "1", "technician_id": "TECH-1", "employee_number": "E-1", "first_name": "Carlos",
    "last_name": "Rivera", "full_name": "Carlos Rivera", "employment_status": "ACTIVE", "skill_level": "MID",
    "home_region": "SW", "hire_date": "2015-01-01", "termination_date": None, "hourly_rate": "40.00",
    "manager_id": "MGR-1", "email": "c@corp.com", "mobile_phone": "555", "created_date": "2015-01-01",
    "last_modified": "2024-01-01 00:00:00",
}
INVOICE = {
    "row_id": "1", "invoice_id": "INV-1", "invoice_number": "N", "work_order_id": "WO-1", "customer_id": "CUST-1",
    "invoice_date": "2024-01-05", "due_date": "2024-02-05", "invoice_status": "SENT", "subtotal": "1190.00",
    "tax_amount": "95.20", "discount_amount": "0.00", "total_amount": "1285.20", "payment_terms": "NET-30",
    "payment_received": None, "payment_date": None,
}
ASSIGNMENT = {
    "assignment_id": "A-1", "work_order_id": "WO-1", "technician_id": "TECH-1", "assignment_role": "LEAD",
    "assigned_date": "2024-01-04", "start_time": "2024-01-05 06:00:00", "end_time": "2024-01-05 14:00:00",
    "hours_logged": "8.0", "assignment_status": "COMPLETED",
}
BASE = {
    "customers": CUSTOMER, "work_orders": ORDER, "technicians": TECHNICIAN, "invoices": INVOICE,
    "assignments": ASSIGNMENT,
}


def frame(spark, table, *changes):
    base = BASE[table]
    rows = [tuple({**base, **change}.values()) for change in changes]
    return literal_rows(spark, rows, list(base), NOW, "B1")


# rule, changed columns, does the row fail
CASES = [
    ("c_001", {"customer_name": None}, True),
    ("c_001", {"customer_name": "   "}, True),
    ("c_001", {}, False),
    ("c_002", {"account_status": None}, True),
    ("c_002", {"account_status": ""}, False),
    ("v_001", {"account_status": None}, True),
    ("v_001", {"account_status": "activ"}, True),
    ("v_001", {"account_status": "TEMP SUSPEND"}, True),
    ("v_001", {"account_status": "1"}, True),
    ("v_001", {"account_status": ""}, True),
    ("v_001", {"account_status": " active "}, False),
    ("v_002", {"status": None}, False),
    ("v_002", {"status": "IN PROGRESS"}, False),
    ("v_002", {"status": "Completed"}, False),
    ("v_002", {"status": "complete"}, True),
    ("v_002", {"status": " Completed"}, True),
    ("v_003", {"credit_limit": "-5"}, True),
    ("v_004", {"credit_limit": "TBD"}, True),
    ("v_004", {"credit_limit": "$450000"}, True),
    ("v_004", {"credit_limit": "USD125000"}, True),
    ("v_004", {"credit_limit": "2.5e5"}, False),
    ("v_004", {"credit_limit": "99999999999.00"}, False),
    ("v_004", {"credit_limit": None}, False),
    ("v_005", {"email_address": "not-an-email"}, True),
    ("v_005", {"email_address": "ytanaka@coastalpwr"}, True),
    ("v_005", {"email_address": "bcarlson@@silverton.com"}, True),
    ("v_005", {"email_address": "nobody@north​mill.com"}, False),
    ("v_005", {"email_address": None}, False),
    ("v_006", {"labor_cost": "-195.00", "parts_cost": "-85.00"}, True),
    ("v_007", {"total_amount": "-714.80"}, True),
    ("v_009", {"employment_status": "ON LEAVE"}, False),
    ("v_009", {"employment_status": "On-Leave"}, True),
    ("v_009", {"employment_status": "ACTVE"}, True),
    ("v_010", {"hourly_rate": "-38.50"}, True),
    ("v_010", {"hourly_rate": "50-60"}, False),
    ("v_011", {"hourly_rate": "9999.00"}, True),
    ("v_011", {"hourly_rate": "50-60"}, False),
    ("v_012", {"priority": None}, False),
    ("v_012", {"priority": "INSPECTION"}, True),
    ("v_015", {"assignment_status": None}, False),
    ("v_018", {"discount_amount": "2000.00"}, True),
    ("cs_001", {"actual_start": "2024-01-05 14:00:00", "actual_end": "2024-01-05 09:00:00"}, True),
    ("cs_001", {"actual_end": "later"}, False),
    ("cs_004", {"labor_cost": "650.00", "parts_cost": "4200.00", "total_cost": "3500.00"}, True),
    ("cs_004", {"labor_cost": "195.00", "parts_cost": None, "total_cost": None}, False),
    ("cs_006", {"sla_met": "Y", "actual_end": "2024-01-05 20:00:00"}, True),
    ("br_003", {"sla_met": "Y", "actual_end": "2024-01-05 20:00:00"}, True),
    ("br_003", {"sla_met": "YES"}, True),
    ("br_003", {"sla_met": "y"}, False),
    ("cs_010", {"actual_hours": "31.0"}, True),
    ("cs_010", {"actual_hours": "31.0", "actual_end": "2024-01-06 10:00:00"}, False),
    ("cs_012", {"hours_logged": "2.0"}, True),
    ("cs_012", {"hours_logged": "7.5"}, False),
    ("c_006", {"full_name": None}, True),
    ("t_001", {"created_date": "2024-01-16"}, True),
    ("t_001", {"created_date": "2024-01-15"}, False),
    ("t_004", {"last_modified": "2021-12-31 00:00:00"}, True),
    ("t_004", {"last_modified": "2000-01-01 junk"}, False),
    ("t_005", {"status": "IN PROGRESS", "last_modified": "2023-01-01 00:00:00"}, True),
    ("t_006", {"created_date": "UNKNOWN"}, True),
    ("br_004", {"invoice_status": "paid "}, True),
    ("br_005", {"estimated_hours": "0.0"}, True),
]
X_CASES = [
    ("x_mojibake", {"customer_name": "FÃ¡brica Norte"}, True),
    ("x_mojibake", {"customer_name": "SÃO PAULO"}, False),
    ("x_mojibake", {"customer_name": "Größe Â"}, False),
    ("x_mojibake", {"customer_name": "日本 Ã\xad"}, False),
    ("x_mojibake", {"customer_name": "æ\x97¥æ\x9c¬"}, True),
    ("x_mojibake", {"customer_name": "plain"}, False),
    ("x_mojibake", {"customer_name": None}, False),
    ("x_zero_width", {"email_address": "nobody@north​mill.com"}, True),
    ("x_zero_width", {}, False),
    ("x_currency_credit", {"credit_limit": "USD125000"}, True),
    ("x_sci_notation", {"credit_limit": "2.5e5"}, True),
    ("x_magnitude", {"credit_limit": "99999999999.00"}, True),
    ("x_empty_status", {"account_status": ""}, True),
    ("x_digit_name", {"customer_name": "123456"}, True),
]


@pytest.mark.parametrize("key,change,fails", CASES)
def test_row_rule(spark, key, change, fails):
    rule = BY_KEY[key]
    rows = violating_rows(frame(spark, rule.table, change), rule, AS_OF)
    if rule.lists_scope:
        rows = rows.filter("sla_flag_status = 'MISMATCH'")
    assert rows.count() == int(fails)


@pytest.mark.parametrize("key,change,fails", X_CASES)
def test_extended_rule(spark, key, change, fails):
    assert violating_rows(frame(spark, "customers", change), X[key], AS_OF).count() == int(fails)


@pytest.mark.parametrize("name", ["Fábrica", "日本", "Größe", "naïve café"])
def test_broken_names_are_repaired(spark, name):
    broken = name.encode().decode("latin-1")
    rows = violating_rows(frame(spark, "customers", {"customer_name": broken}), X["x_mojibake"], AS_OF)
    assert rows.first().repaired_name == name
    assert violating_rows(frame(spark, "customers", {"customer_name": name}), X["x_mojibake"], AS_OF).count() == 0


CITIES = [("MIAMI", "FL"), ("PORTLAND", "OR"), ("PORTLAND", "ME"), ("HOUSTON", "TX"), (None, "GA")]


@pytest.mark.parametrize(
    "city,state,unknown,wrong",
    [
        ("Miami", "TX", 0, 1), ("Miami", "FL", 0, 0), (" miami ", "fl", 0, 0), ("Portland", "ME", 0, 0), ("Portland", "CA", 0, 1),
        ("Dallas", "TX", 1, 0), ("Dallas", None, 1, 0), ("Miami", None, 0, 0), (None, "TX", 0, 0),
    ],
)
def test_unknown_and_contradicting_places(spark, city, state, unknown, wrong):
    rows = frame(spark, "customers", {"billing_city": city, "billing_state": state})
    given = spark.createDataFrame(CITIES, "key string, value string")
    frames = WithLookups({"customers": rows}, {"cities": lambda _: given})
    for key, n in (("x_city_unknown", unknown), ("x_city_state", wrong)):
        assert lookup_violations(frames, X[key]).count() == n
        counted = rule_counts(frames, [X[key]], AS_OF).first()
        assert (counted.total_records, counted.failed_records) == (1, n)


def test_learnt_pairs_need_support_and_share(spark):
    rows = [("A", "x")] * 6 + [("A", "y")] * 3 + [("A", "z")] + [("B", "x")] * 2 + [("C", None)] * 9 + [(None, "x")] * 9 + [("D", "q")] * 3
    df = spark.createDataFrame(rows, "k string, v string").repartition(4)
    assert sorted(map(tuple, learn(df, "k", "v", 3, 0.3).collect())) == [("A", "x"), ("A", "y"), ("D", "q")]
    assert sorted(map(tuple, learn(df, "k", "v", 1, 0.5).collect())) == [("A", "x"), ("B", "x"), ("D", "q")]
    assert learn(df.filter("false"), "k", "v", 1, 0.5).count() == 0


def test_a_large_reference_is_not_broadcast(spark, settings):
    settings(**{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    rows = spark.range(50).selectExpr("CAST(id AS string) AS k")
    known = spark.range(20).selectExpr("CAST(id AS string) AS k", "true AS ok")
    for most, broadcast in ((20, True), (19, False)):
        joined = attach_measured(rows, known, ["k"], most=most)
        assert joined.filter("ok").count() == 20 and joined.count() == 50
        assert ("BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()) is broadcast


def test_recovered_amount(spark):
    rows = violating_rows(frame(spark, "customers", {"credit_limit": "$450000"}), X["x_currency_credit"], AS_OF)
    assert rows.first().recovered_amount == 450000.0


def test_minutes_count_boundaries(spark):
    late = {"actual_start": "2024-01-05 14:00:30", "actual_end": "2024-01-05 13:58:59"}
    assert violating_rows(frame(spark, "work_orders", late), BY_KEY["cs_001"], AS_OF).first().minutes_inverted == 2


def test_customer_staging(spark):
    raw = frame(
        spark, "customers",
        {"row_id": "1", "account_status": "activ", "email_address": "A@B.co "},
        {"row_id": "2", "customer_id": "C2", "account_status": "TEMP SUSPEND", "email_address": "a@b.co",
         "last_modified": "2023-01-01 00:00:00"},
        {"row_id": "3", "customer_id": "C3", "account_status": "1", "email_address": "c3@x.co"},
        {"row_id": "4", "customer_id": "C4", "account_status": "", "email_address": "c4@x.co"},
        {"row_id": "5", "customer_id": "C5", "customer_name": " ", "credit_limit": "TBD", "email_address": None},
        {"row_id": "6", "customer_id": "C6", "credit_limit": "$450000", "email_address": None,
         "last_modified": "2023-01-01 00:00:00"},
    )
    rows = {r.customer_id: r for r in stage_customers(raw, LOAD).collect()}
    assert [rows[k].account_status for k in ("CUST-1", "C2", "C3", "C4")] == ["ACTIVE", "SUSPENDED", "1", ""]
    assert not rows["CUST-1"].is_duplicate and rows["C2"].is_duplicate
    assert rows["C2"].quarantine_reason == "MEDIUM: duplicate record — lower priority version"
    assert rows["C3"].quarantine_reason == "HIGH: invalid account_status [1]" and not rows["C3"].is_quarantined
    assert rows["C5"].quarantine_reason == "CRITICAL: customer_name is NULL or blank"
    assert rows["C5"].dq_score == 100 - 30 - 15 - 10
    # two missing e-mails are one e-mail: the older record is the duplicate
    assert rows["C6"].is_duplicate and rows["C6"].credit_limit is None
    apart = Load(AS_OF, NOW, "B1", row_id="row_id", null_keys_are_distinct=True)
    assert not {r.customer_id: r for r in stage_customers(raw, apart).collect()}["C6"].is_duplicate


def test_money_policy(spark):
    raw = frame(spark, "customers", {"credit_limit": "99999999999.00"})
    exact = Load(AS_OF, NOW, "B1", money="decimal(12,2)", row_id="row_id")
    assert stage_customers(raw, LOAD).first().credit_limit == 99999999999.0
    assert stage_customers(raw, exact).first().credit_limit is None


def test_work_order_staging(spark):
    raw = frame(
        spark, "work_orders",
        {"row_id": "1", "actual_start": "2024-01-05 14:00:00", "actual_end": "2024-01-05 09:00:00"},
        {"row_id": "2", "work_order_id": "W2", "customer_id": "CUST-999"},
        {"row_id": "3", "work_order_id": "W3", "labor_cost": "-195.00", "parts_cost": "-85.00"},
        {"row_id": "4", "work_order_id": "W4", "labor_cost": "195.00", "parts_cost": None, "total_cost": None},
        {"row_id": "5", "work_order_id": "W5", "actual_hours": "31.0", "status": "IN PROGRESS"},
    )
    customers = frame(spark, "customers", {})
    rows = {r.work_order_id: r for r in stage_work_orders(raw, customers, LOAD).collect()}
    assert rows["WO-1"].is_quarantined and rows["WO-1"].actual_end is None
    assert rows["W2"].quarantine_reason == "CRITICAL: orphaned customer_id [CUST-999]"
    assert rows["W3"].labor_cost is None and rows["W3"].parts_cost is None
    assert rows["W4"].is_quarantined is False
    assert rows["W5"].actual_hours is None and rows["W5"].status == "IN_PROGRESS"
    undecided = Load(AS_OF, NOW, "B1", row_id="row_id", three_valued=True)
    rows = {r.work_order_id: r for r in stage_work_orders(raw, customers, undecided).collect()}
    assert rows["W4"].is_quarantined is None


def test_technician_staging(spark):
    changes = [
        {"full_name": None, "employment_status": "On-Leave", "hourly_rate": "-38.50"},
        {"full_name": " ", "employment_status": "ACTVE", "hourly_rate": "9999.00"},
        {"employment_status": "ON LEAVE", "hourly_rate": "50-60"},
    ]
    changes = [{"row_id": str(i), "technician_id": f"T{i}", **c} for i, c in enumerate(changes)]
    rows = stage_technicians(frame(spark, "technicians", *changes), LOAD).orderBy("technician_id").collect()
    assert [r.full_name for r in rows] == ["Carlos Rivera"] * 3
    assert [r.employment_status for r in rows] == ["ON_LEAVE", "ACTIVE", "ON_LEAVE"]
    assert [r.hourly_rate for r in rows] == [None] * 3
    assert [r.is_quarantined for r in rows] == [True, False, False]


def test_synonyms_without_typos(spark):
    df = spark.createDataFrame([("activ",)], "account_status string")
    assert df.selectExpr(std.customer_status()).first()[0] == "ACTIVE"
    assert df.selectExpr(std.customer_status(known_typos=False)).first()[0] == "ACTIV"


def test_scoped_totals(spark):
    frames = {"work_orders": frame(spark, "work_orders", {}, {"status": "DRAFT"}, {"actual_end": None})}
    row = evaluate(frames, [BY_KEY["c_004"]], AS_OF).first()
    assert (row.total_records, row.failed_records, row.pass_rate, row.status) == (2, 1, 50.0, "FAIL")


def test_empty_table(spark):
    frames = {"work_orders": frame(spark, "work_orders", {}).filter("false")}
    rows = evaluate(frames, [BY_KEY["c_004"], BY_KEY["u_003"]], AS_OF).collect()
    assert [(r.total_records, r.failed_records, r.pass_rate, r.status) for r in rows] == [(0, 0, 100.0, "PASS")] * 2
