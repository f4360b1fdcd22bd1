"""All queries as SQL over the source tables.

The dirty views are repeated as common table expressions, because only the
source tables are registered where this text runs.
"""

from __future__ import annotations

import re

from sluice.sources.dirty_views import VIEWS

from .extended_sql import X_KEY_LISTS, X_KEYS, X_LOOKUPS, X_PAIR_LISTS, X_REFERENCES, X_ROWS
from .rules_sql import (
    ALL_KEYS,
    AS_OF,
    KEYS,
    ROWS,
    D,
    EMAIL,
    N,
    T,
    U,
    US,
    code_of,
    counts,
    key_counts,
    listing,
    outcome,
    row_counts,
    union,
)

LOADED = "TIMESTAMP '2001-07-01 06:00:00'"
RUN = "RUN-20010701"
BATCH = "BATCH-20010701"

# -- views on views ---------------------------------------------------------

_BATCHED = ("customers", "technicians", "work_orders", "invoices", "assignments", "certs")
_DERIVED = {
    f"raw_{t}_all": f"SELECT * FROM raw_{t} UNION ALL BY NAME SELECT * FROM raw_{t}_batch2" for t in _BATCHED
}


def _both_batches(sql: str) -> str:
    return re.sub(rf"\braw_({'|'.join(_BATCHED)})\b", r"raw_\1_all", sql)



def _score(*losses: tuple[str, int]) -> str:
    terms = "".join(f" - CASE WHEN {cond} THEN {loss} ELSE 0 END" for cond, loss in losses)
    return f"greatest(CAST(0 AS DOUBLE), CAST(100{terms} AS DOUBLE))"


_BLANK_NAME = "(customer_name IS NULL OR trim(customer_name) = '')"
_BAD_CREDIT = f"(credit_limit IS NOT NULL AND {N('credit_limit')} IS NULL)"
_NEG_CREDIT = f"coalesce({N('credit_limit')} < 0, FALSE)"
_BAD_STATUS = (
    f"coalesce({U('account_status')} NOT IN"
    " ('ACTIVE','INACTIVE','SUSPENDED','PENDING','ACTIV','TEMP SUSPEND'), FALSE)"
)
_BAD_STATUS_SQL = f"coalesce({U('account_status')} NOT IN ('ACTIVE','INACTIVE','SUSPENDED','PENDING'), FALSE)"
_FUTURE = f"coalesce({D('created_date')} > {AS_OF}, FALSE)"

_TYPE = (
    f"CASE WHEN {U('customer_type')} IN ('ENTERPRISE','ENTERP') THEN 'ENTERPRISE'"
    f" WHEN {U('customer_type')} IN ('GOVERNMENT','GOVT','GOV') THEN 'GOVERNMENT'"
    f" WHEN {U('customer_type')} = 'SMB' THEN 'SMB' ELSE 'UNKNOWN' END"
)


def _status(active: str, otherwise: str) -> str:
    return (
        f"CASE WHEN {U('account_status')} IN ({active}) THEN 'ACTIVE'"
        f" WHEN {U('account_status')} IN ('INACTIVE','INACT') THEN 'INACTIVE'"
        f" WHEN {U('account_status')} IN ('SUSPENDED','TEMP SUSPEND') THEN 'SUSPENDED'"
        f" WHEN {U('account_status')} = 'PENDING' THEN 'PENDING' ELSE {otherwise} END"
    )


_STATUS = _status("'ACTIVE','ACTIV'", U("account_status"))
_STATUS_PLAIN = _status("'ACTIVE'", U("account_status"))
_STATUS_RAW = _status("'ACTIVE','ACTIV'", "account_status")

_CUSTOMER_SCORE = _score(
    (_BLANK_NAME, 30), ("account_status IS NULL", 20), (_BAD_STATUS, 15), (_NEG_CREDIT, 15), (_BAD_CREDIT, 15),
    ("email_address IS NULL", 10), (f"email_address IS NOT NULL AND NOT {EMAIL('email_address')}", 10),
    ("primary_contact IS NULL", 5), (_FUTURE, 10),
)
_CUSTOMER_SCORE_SQL = _score(
    ("customer_name IS NULL", 30), ("account_status IS NULL", 20), (_BAD_CREDIT, 15), ("email_address IS NULL", 10),
    ("email_address IS NOT NULL AND email_address NOT LIKE '%@%.%'", 10), ("primary_contact IS NULL", 5),
    (_FUTURE, 10),
)
_CUSTOMER_GATE = f"({_BLANK_NAME} OR account_status IS NULL OR {_NEG_CREDIT} OR {_BAD_CREDIT})"
_CUSTOMER_GATE_SQL = f"({_BLANK_NAME} OR {_BAD_STATUS_SQL} OR {_NEG_CREDIT} OR {_BAD_CREDIT})"
_CUSTOMER_REASON = (
    f"CASE WHEN {_BLANK_NAME} THEN 'CRITICAL: customer_name is NULL or blank'"
    " WHEN account_status IS NULL THEN 'CRITICAL: account_status is NULL'"
    f" WHEN {_BAD_STATUS} THEN 'HIGH: invalid account_status [' || account_status || ']'"
    f" WHEN {_NEG_CREDIT} THEN 'HIGH: negative credit_limit'"
    f" WHEN {_BAD_CREDIT} THEN 'HIGH: unparseable credit_limit [' || credit_limit || ']'"
    " WHEN is_duplicate THEN 'MEDIUM: duplicate record — lower priority version' END"
)
_CUSTOMER_REASON_SQL = (
    f"CASE WHEN {_BLANK_NAME} THEN 'CRITICAL: customer_name is NULL'"
    f" WHEN {_BAD_STATUS_SQL} THEN 'CRITICAL: invalid account_status [' || account_status || ']'"
    f" WHEN {_BAD_CREDIT} THEN 'HIGH: credit_limit cannot be parsed [' || credit_limit || ']'"
    f" WHEN {_NEG_CREDIT} THEN 'HIGH: negative credit_limit' END"
)
_DUP_REASON = (
    "CASE WHEN is_id_duplicate THEN 'Duplicate customer_id — lower priority retained'"
    " WHEN is_email_duplicate THEN 'Duplicate email address — older record' END"
)
_MASTER = (
    "CASE WHEN is_duplicate THEN (SELECT min(o.customer_id) FROM raw_customers o"
    " WHERE lower(rtrim(o.email_address)) = lower(rtrim(f.email_address)) AND o.customer_id <> f.customer_id) END"
)


def _flagged(view: str) -> str:
    return (
        "SELECT *, rn_email > 1 AS is_email_duplicate, rn_id > 1 AS is_id_duplicate,"
        " rn_email > 1 OR rn_id > 1 AS is_duplicate FROM (SELECT *,"
        " row_number() OVER (PARTITION BY lower(trim(email_address))"
        f" ORDER BY {T('last_modified')} DESC NULLS LAST, _src_row) AS rn_email,"
        " row_number() OVER (PARTITION BY customer_id ORDER BY _extract_timestamp DESC, _src_row) AS rn_id"
        f" FROM {view})"
    )


_DERIVED["flagged_customers"] = _flagged("raw_customers")
_DERIVED["flagged_batch2"] = _flagged("raw_customers_batch2")


def _stage_customers(view: str) -> str:
    return (
        f"SELECT customer_id, trim(customer_name) AS customer_name, {_TYPE} AS customer_type,"
        f" {_STATUS} AS account_status, {N('credit_limit')} AS credit_limit,"
        " trim(primary_contact) AS primary_contact, lower(trim(email_address)) AS email_address, phone_number,"
        " trim(billing_city) AS billing_city, upper(trim(billing_state)) AS billing_state,"
        " left(trim(billing_zip), 5) AS billing_zip, upper(trim(region_code)) AS region_code,"
        f" {D('created_date')} AS created_date, {T('last_modified')} AS last_modified, source_system,"
        f" {_CUSTOMER_GATE} OR is_duplicate AS is_quarantined, {_CUSTOMER_REASON} AS quarantine_reason,"
        f" {_CUSTOMER_SCORE} AS dq_score, is_duplicate, CAST(NULL AS VARCHAR) AS duplicate_of_key,"
        f" {LOADED} AS stg_load_date, '{BATCH}' AS stg_batch_id FROM {view}"
    )


_DERIVED["stg_customers"] = _stage_customers("flagged_customers")
_DERIVED["stg_batch2"] = _stage_customers("flagged_batch2")


def _script(sql: str) -> str:
    """With the script book's types: fixed-point amounts and hours, whose text has no exponent."""
    kinds = {"credit_limit": 12, "labor_cost": 12, "parts_cost": 12, "total_cost": 12, "estimated_hours": 6, "actual_hours": 6}
    for column, digits in kinds.items():
        fixed = f"(CASE WHEN {column} NOT ILIKE '%e%' THEN TRY_CAST({column} AS DECIMAL({digits},2)) END)"
        sql = sql.replace(N(column), fixed)
    return sql


_SHOWN_ORDER = "".join(
    f"CAST({n} AS DOUBLE) AS {n}, " for n in ("estimated_hours", "actual_hours", "labor_cost", "parts_cost", "total_cost")
).rstrip(", ")
_DERIVED["stg_customers_sql"] = _script(
    f"SELECT customer_id, trim(customer_name) AS customer_name, {_TYPE} AS customer_type,"
    f" {_STATUS_RAW} AS account_status, {N('credit_limit')} AS credit_limit,"
    " trim(primary_contact) AS primary_contact, lower(trim(email_address)) AS email_address, phone_number,"
    " trim(billing_city) AS billing_city, upper(trim(billing_state)) AS billing_state,"
    " left(trim(billing_zip), 5) AS billing_zip, trim(region_code) AS region_code,"
    f" {D('created_date')} AS created_date, {T('last_modified')} AS last_modified, source_system,"
    f" {_CUSTOMER_GATE_SQL} OR is_duplicate AS is_quarantined,"
    f" coalesce({_CUSTOMER_REASON_SQL}, {_DUP_REASON}) AS quarantine_reason,"
    f" {_CUSTOMER_SCORE_SQL} AS dq_score, is_duplicate, {_MASTER} AS duplicate_of_key,"
    f" {LOADED} AS stg_load_date, _batch_id AS stg_batch_id FROM flagged_customers f"
)

_DERIVED["latest_orders"] = (
    "SELECT *, customer_id IS NOT NULL AND customer_id IN (SELECT customer_id FROM raw_customers)"
    " AS ref_integrity_ok FROM (SELECT *, row_number() OVER (PARTITION BY work_order_id"
    " ORDER BY _extract_timestamp DESC, _src_row) AS rn FROM raw_work_orders) WHERE rn = 1"
)
_ORPHAN = "(customer_id IS NOT NULL AND NOT ref_integrity_ok)"
_INVERTED = f"coalesce({T('actual_end')} < {T('actual_start')}, FALSE)"
_NEG_COST = f"coalesce({N('labor_cost')} < 0 OR {N('parts_cost')} < 0, FALSE)"
_NEG_COST_3 = f"({N('labor_cost')} < 0 OR {N('parts_cost')} < 0)"
_WO_TYPE = (
    "CASE WHEN upper(work_order_type) IN ('PREVENTIVE_MAINTENANCE','CORRECTIVE_MAINTENANCE','INSPECTION',"
    "'EMERGENCY_REPAIR','INSTALLATION') THEN upper(work_order_type) ELSE 'OTHER' END"
)
_WO_STATUS = (
    f"CASE WHEN {US('status')} IN ('COMPLETED','COMPLETE') THEN 'COMPLETED'"
    f" WHEN {US('status')} IN ('SCHEDULED','IN_PROGRESS','CANCELLED','ON_HOLD') THEN {US('status')}"
    " ELSE 'UNKNOWN' END"
)
_PRIORITY_CHECKED = (
    f"CASE WHEN {U('priority')} IN ('CRITICAL','HIGH','MEDIUM','LOW') THEN {U('priority')} END"
)
_SLA = (
    f"CASE WHEN {U('sla_met')} IN ('Y','YES','1','TRUE') THEN TRUE"
    f" WHEN {U('sla_met')} IN ('N','NO','0','FALSE') THEN FALSE END"
)
_END = f"CASE WHEN {T('actual_end')} < {T('actual_start')} THEN NULL ELSE {T('actual_end')} END"
_HOURS = f"CASE WHEN {N('actual_hours')} > 24 OR {N('actual_hours')} < 0 THEN NULL ELSE {N('actual_hours')} END"


def _not_negative(column: str) -> str:
    return f"CASE WHEN {N(column)} < 0 THEN NULL ELSE {N(column)} END"


def _wo_score(cost: str) -> str:
    return _score(
        ("customer_id IS NULL", 30), (_ORPHAN, 25), ("site_id IS NULL", 15), (_INVERTED, 20), (cost, 15),
        ("description IS NULL", 5), ("priority IS NULL", 5),
    )


def _wo_reason(text: str) -> str:
    return (
        "CASE WHEN customer_id IS NULL THEN 'CRITICAL: customer_id is NULL'"
        f" WHEN {_ORPHAN} THEN 'CRITICAL: orphaned customer_id [' || customer_id || ']'"
        f" WHEN {_INVERTED} THEN 'CRITICAL: actual_end before actual_start'"
        f" WHEN {_NEG_COST} THEN '{text}' END"
    )


def _stage_orders(priority: str, gate_cost: str, score_cost: str, text: str, batch: str) -> str:
    return (
        f"SELECT work_order_id, work_order_number, site_id, customer_id, {_WO_TYPE} AS work_order_type,"
        f" {priority} AS priority, {_WO_STATUS} AS status, trim(description) AS description,"
        f" {D('scheduled_date')} AS scheduled_date, {T('actual_start')} AS actual_start, {_END} AS actual_end,"
        f" {N('estimated_hours')} AS estimated_hours, {_HOURS} AS actual_hours,"
        f" {_not_negative('labor_cost')} AS labor_cost, {_not_negative('parts_cost')} AS parts_cost,"
        f" {_not_negative('total_cost')} AS total_cost, {T('sla_due_date')} AS sla_due_date, {_SLA} AS sla_met,"
        f" trim(resolution_code) AS resolution_code, {D('created_date')} AS created_date,"
        f" {T('last_modified')} AS last_modified,"
        f" customer_id IS NULL OR {_ORPHAN} OR {_INVERTED} OR {gate_cost} AS is_quarantined,"
        f" {_wo_reason(text)} AS quarantine_reason, {_wo_score(score_cost)} AS dq_score, ref_integrity_ok,"
        f" {LOADED} AS stg_load_date, {batch} AS stg_batch_id FROM latest_orders"
    )


_DERIVED["stg_orders"] = _stage_orders(
    U("priority"), _NEG_COST, _NEG_COST, "HIGH: negative cost value", f"'{BATCH}'"
)
_DERIVED["stg_orders_sql"] = _script(
    _stage_orders(_PRIORITY_CHECKED, _NEG_COST, f"{N('labor_cost')} < 0", "HIGH: negative cost values", "_batch_id")
)

_DERIVED["latest_technicians"] = (
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY technician_id"
    " ORDER BY _extract_timestamp DESC, _src_row) AS rn FROM raw_technicians) WHERE rn = 1"
)
_NEG_RATE = f"coalesce({N('hourly_rate')} < 0, FALSE)"
_FUTURE_HIRE = f"coalesce({D('hire_date')} > {AS_OF}, FALSE)"
_INV_DATES = f"coalesce({D('hire_date')} > {D('termination_date')}, FALSE)"
_TECH_STATUS = (
    f"CASE WHEN {US('employment_status')} IN ('ACTIVE','ACTVE') THEN 'ACTIVE'"
    f" WHEN {US('employment_status')} = 'TERMINATED' THEN 'TERMINATED'"
    f" WHEN {US('employment_status')} IN ('ON_LEAVE','ON-LEAVE') THEN 'ON_LEAVE'"
    f" WHEN {US('employment_status')} = 'SUSPENDED' THEN 'SUSPENDED' ELSE 'UNKNOWN' END"
)
_FULL_NAME = (
    "CASE WHEN full_name IS NOT NULL AND trim(full_name) <> '' THEN trim(full_name)"
    " ELSE concat_ws(' ', trim(first_name), trim(last_name)) END"
)
_RATE = f"CASE WHEN {N('hourly_rate')} < 0 OR {N('hourly_rate')} > 500 THEN NULL ELSE {N('hourly_rate')} END"
_TECH_REASON = (
    f"CASE WHEN {_INV_DATES} THEN 'HIGH: hire_date after termination_date'"
    f" WHEN {_NEG_RATE} THEN 'HIGH: negative hourly_rate'"
    f" WHEN {_FUTURE_HIRE} THEN 'HIGH: hire_date in the future'"
    " WHEN employee_number IS NULL THEN 'MEDIUM: missing employee_number' END"
)
_TECH_SCORE = _score(
    (_NEG_RATE, 20), (_INV_DATES, 20), (_FUTURE_HIRE, 15), ("employee_number IS NULL", 10),
    ("full_name IS NULL", 10), ("skill_level IS NULL", 5),
)
_DERIVED["stg_technicians"] = (
    f"SELECT technician_id, employee_number, first_name, last_name, {_FULL_NAME} AS full_name,"
    f" {_TECH_STATUS} AS employment_status, upper(trim(skill_level)) AS skill_level,"
    f" upper(trim(home_region)) AS home_region, {D('hire_date')} AS hire_date,"
    f" {D('termination_date')} AS termination_date, {_RATE} AS hourly_rate, manager_id, email, mobile_phone,"
    f" {_NEG_RATE} OR {_INV_DATES} AS is_quarantined, {_TECH_REASON} AS quarantine_reason,"
    f" {_TECH_SCORE} AS dq_score, {LOADED} AS stg_load_date, '{BATCH}' AS stg_batch_id FROM latest_technicians"
)

_DERIVED["latest_invoices"] = (
    "SELECT *, work_order_id IS NOT NULL AND work_order_id NOT IN"
    " (SELECT work_order_id FROM raw_work_orders) AS no_order,"
    " customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM raw_customers) AS no_customer"
    " FROM (SELECT *, row_number() OVER (PARTITION BY invoice_id ORDER BY _extract_timestamp DESC, _src_row) AS rn"
    " FROM raw_invoices) WHERE rn = 1"
)
_NEG_AMOUNT = f"coalesce({N('subtotal')} < 0 OR {N('total_amount')} < 0 OR {N('payment_received')} < 0, FALSE)"
_OVER = f"coalesce({N('discount_amount')} > {N('subtotal')}, FALSE)"
_OFF = (
    f"coalesce(abs({N('subtotal')} + {N('tax_amount')} - {N('discount_amount')} - {N('total_amount')}) > 0.01, FALSE)"
)
_DUE = f"coalesce({D('due_date')} < {D('invoice_date')}, FALSE)"
_DERIVED["stg_invoices"] = (
    f"SELECT invoice_id, invoice_number, work_order_id, customer_id, {D('invoice_date')} AS invoice_date,"
    f" {D('due_date')} AS due_date, CASE WHEN {U('invoice_status')} IN"
    f" ('DRAFT','SENT','PAID','OVERDUE','CANCELLED','VOID') THEN {U('invoice_status')} ELSE 'UNKNOWN' END"
    f" AS invoice_status, {_not_negative('subtotal')} AS subtotal, {N('tax_amount')} AS tax_amount,"
    f" {N('discount_amount')} AS discount_amount, {_not_negative('total_amount')} AS total_amount, payment_terms,"
    f" {_not_negative('payment_received')} AS payment_received, {D('payment_date')} AS payment_date,"
    f" no_order OR no_customer OR {_NEG_AMOUNT} OR {_OVER} OR {_OFF} OR {_DUE} AS is_quarantined,"
    " CASE WHEN no_order THEN 'CRITICAL: orphaned work_order_id [' || work_order_id || ']'"
    f" WHEN {_NEG_AMOUNT} THEN 'CRITICAL: negative financial amount'"
    f" WHEN {_OVER} THEN 'CRITICAL: discount_amount exceeds subtotal'"
    f" WHEN {_OFF} THEN 'CRITICAL: invoice total does not balance'"
    " WHEN no_customer THEN 'HIGH: orphaned customer_id [' || customer_id || ']'"
    f" WHEN {_DUE} THEN 'HIGH: due_date before invoice_date' END AS quarantine_reason, "
    + _score(("no_order", 30), (_NEG_AMOUNT, 30), (_OVER, 30), (_OFF, 30), ("no_customer", 20), (_DUE, 20))
    + f" AS dq_score, {LOADED} AS stg_load_date, '{BATCH}' AS stg_batch_id FROM latest_invoices"
)

_DERIVED["calendar"] = (
    "SELECT CAST(unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), INTERVAL 1 DAY)) AS DATE)"
    f" AS full_date FROM (SELECT DISTINCT year(d) AS y FROM (SELECT {D('scheduled_date')} AS d FROM raw_work_orders"
    f" UNION ALL SELECT {D('due_date')} FROM raw_invoices) WHERE d IS NOT NULL)"
)
_DATE_KEY = "CAST(strftime({}, '%Y%m%d') AS INTEGER)".format
_DATE_COLUMNS = (
    f"{_DATE_KEY('full_date')} AS date_sk, full_date, CAST(year(full_date) AS INTEGER) AS year_num,"
    " CAST(quarter(full_date) AS INTEGER) AS quarter_num, CAST(month(full_date) AS INTEGER) AS month_num,"
    " monthname(full_date) AS month_name, CAST({week} AS INTEGER) AS week_num,"
    " CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week, dayname(full_date) AS day_name,"
    " dayofweek(full_date) IN (0, 6) AS is_weekend"
)
_DERIVED["dim_date"] = (
    f"SELECT {_DATE_COLUMNS.replace('{week}', 'weekofyear(full_date)')}, FALSE AS is_holiday,"
    " CAST(year(full_date) AS INTEGER) AS fiscal_year, CAST(quarter(full_date) AS INTEGER) AS fiscal_quarter"
    " FROM calendar"
)


def _numbered(key: str, name: str) -> str:
    digits = " + ".join(f"{16 ** (2 - i)} * (instr('0123456789abcdef', substr(md5({key}), {i + 1}, 1)) - 1)" for i in range(3))
    place = f"row_number() OVER (PARTITION BY left(md5({key}), 3) ORDER BY md5({key}), {key})"
    return f"({digits}) * 1099511627776 + {place} AS {name}"


def _dim_customer(staged: str) -> str:
    return (
        f"SELECT {_numbered('customer_id', 'customer_sk')}, customer_id, customer_name, customer_type,"
        " account_status, region_code, credit_limit, coalesce(created_date, DATE '2000-01-01') AS effective_from,"
        " CAST(NULL AS DATE) AS effective_to, TRUE AS is_current, stg_batch_id AS record_source,"
        f" {LOADED} AS load_date FROM {staged} WHERE NOT is_quarantined AND NOT is_duplicate"
    )


_DERIVED["dim_customer"] = _dim_customer("stg_customers")
_DERIVED["dim_customer_sql"] = _dim_customer("stg_customers_sql")

_MEASURES = (
    "w.work_order_type, w.priority, w.status, w.estimated_hours, w.actual_hours, w.labor_cost, w.parts_cost,"
    " coalesce(w.labor_cost, 0) + coalesce(w.parts_cost, 0) AS total_cost, w.sla_met,"
    " w.actual_hours - w.estimated_hours AS hours_variance"
)
_DERIVED["fact_orders"] = (
    f"SELECT {_numbered('w.work_order_id', 'fact_wo_sk')}, w.work_order_id, w.work_order_number, c.customer_sk,"
    f" s.date_sk AS scheduled_date_sk, e.date_sk AS completed_date_sk, {_MEASURES}, {LOADED} AS load_date,"
    " w.stg_batch_id AS record_source FROM stg_orders w"
    " LEFT JOIN dim_customer c ON w.customer_id = c.customer_id AND c.is_current"
    " LEFT JOIN dim_date s ON w.scheduled_date = s.full_date"
    " LEFT JOIN dim_date e ON CAST(w.actual_end AS DATE) = e.full_date WHERE NOT w.is_quarantined"
)

_ALL_COUNTS = union(f"SELECT * FROM ({counts(k)})" for k in ALL_KEYS)
_DERIVED["results"] = outcome(_ALL_COUNTS)
_WEIGHT = "CASE severity WHEN 'CRITICAL' THEN 30 WHEN 'HIGH' THEN 20 WHEN 'MEDIUM' THEN 10 ELSE 5 END"


def _dq(where: str = "TRUE", digits: int = 2) -> str:
    share = f"{_WEIGHT} * failed_records / CAST(greatest(total_records, 1) AS DOUBLE)"
    return (
        f"coalesce(greatest(0, round(100 - sum({share}) FILTER (WHERE {where})"
        f" / sum({_WEIGHT}) FILTER (WHERE {where}) * 100, {digits})), 0)"
    )


def _grade(score: str) -> str:
    return (
        f"CASE WHEN {score} >= 90 THEN 'A' WHEN {score} >= 75 THEN 'B' WHEN {score} >= 60 THEN 'C'"
        f" WHEN {score} >= 50 THEN 'D' ELSE 'F' END"
    )


def _dimension(name: str) -> str:
    return _dq(f"dq_dimension = '{name}'")


def _summary(source: str, run: str, day: str) -> str:
    fails = "CAST(count(*) FILTER (WHERE status = 'FAIL' AND severity = '{}') AS INTEGER)".format
    return (
        f"SELECT '{run}' AS run_id, DATE '{day}' AS score_date, 'ALL_TABLES' AS target_table,"
        " CAST(count(*) AS INTEGER) AS total_rules_run,"
        " CAST(count(*) FILTER (WHERE status = 'PASS') AS INTEGER) AS rules_passed,"
        " CAST(count(*) FILTER (WHERE status <> 'PASS') AS INTEGER) AS rules_failed,"
        f" {fails('CRITICAL')} AS critical_failures, {fails('HIGH')} AS high_failures, {_dq()} AS overall_score,"
        f" {_dimension('Completeness')} AS completeness_score, {_dimension('Uniqueness')} AS uniqueness_score,"
        f" {_dimension('Validity')} AS validity_score, {_dimension('Consistency')} AS consistency_score,"
        f" {_dimension('Timeliness')} AS timeliness_score,"
        f" {_dimension('Referential Integrity')} AS ref_integrity_score FROM {source}"
    )




def _run(day: str) -> str:
    body = union(f"SELECT * FROM ({counts(k)})".replace(AS_OF, f"DATE '{day}'") for k in ALL_KEYS)
    return _summary(f"({outcome(body)})", f"RUN-{day}", day)


# the standard run and five earlier ones, 30 days apart
_RUN_DAYS = ["2001-07-01", "2001-06-01", "2001-05-02", "2001-04-02", "2001-03-03", "2001-02-01"]

# -- the compact suite ------------------------------------------------------

_EXTERNAL_KEYS = [
    "c_001", "c_002", "c_003", "c_005", "u_001", "u_002", "u_003", "u_004", "v_001", "v_003", "v_006", "v_007",
    "v_010", "r_001", "r_002", "r_003", "r_004", "cs_001", "cs_004", "cs_005", "cs_009", "t_001", "t_002", "t_003",
    "t_005",
]
_EXTERNAL_FAILED = {
    "u_001": "SELECT count(*) - count(DISTINCT customer_id) FROM raw_customers",
    "u_002": "SELECT count(*) FROM (SELECT lower(email_address) FROM raw_customers WHERE email_address IS NOT NULL"
             " GROUP BY lower(email_address) HAVING count(*) > 1)",
    "u_003": "SELECT count(*) - count(DISTINCT work_order_id) FROM raw_work_orders",
    "v_006": f"{N('labor_cost')} < 0 OR {N('parts_cost')} < 0",
    "v_007": f"{N('subtotal')} < 0 OR {N('total_amount')} < 0",
    "t_005": f"{U('status')} = 'IN_PROGRESS' AND date_diff('day', {D('last_modified')}, {AS_OF}) > 90",
}


def _external_counts(key: str) -> str:
    if key in ROWS:
        dim, table, sev, view, scope, fails, _ = ROWS[key]
        return row_counts(code_of(key), dim, table, sev, view, scope, _EXTERNAL_FAILED.get(key, fails))
    dim, table, sev, total, failed = KEYS[key]
    return key_counts(code_of(key), dim, table, sev, total, _EXTERNAL_FAILED.get(key, failed))


_DERIVED["external"] = outcome(
    union(f"SELECT * FROM ({_external_counts(k)})" for k in _EXTERNAL_KEYS), digits=1, warning="WARN"
)


# -- assembly ---------------------------------------------------------------


def with_views(sql: str) -> str:
    """Put every view the text needs in front of it, dependencies first."""
    texts = {name: text.format(**{source: source}).strip() for name, (text, source) in VIEWS.items()}
    texts.update(_DERIVED)
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in texts:
            if name not in ordered and re.search(rf"\b(FROM|JOIN) {name}\b", text):
                need(texts[name])
                if name not in ordered:
                    ordered.append(name)

    need(sql)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{name} AS ({texts[name]})" for name in ordered) + "\n" + sql


_RESULT = "rule_code, dq_dimension, target_table, severity, total_records, failed_records, pass_rate, status"
Q: dict[str, str] = {}

for _key in ALL_KEYS:
    Q[_key] = f"SELECT {_RESULT} FROM ({outcome(counts(_key))})"
    Q[f"violations_{_key}"] = listing(_key)

_X_COUNTS: dict[str, list[str]] = {}
for _code, (_g, _dim, (_table, _view), _sev, _fails, _cols) in X_ROWS.items():
    _X_COUNTS.setdefault(_g, []).append(row_counts(_code, _dim, _table, _sev, _view, "TRUE", _fails))
    Q["violations_" + _code.lower().replace("-", "_")] = _both_batches(
        f"SELECT '{_code}' AS rule_code, '{_sev}' AS severity, {_cols} FROM {_view} WHERE {_fails}"
    )
_DERIVED.update(X_REFERENCES)
for _code, (_g, _dim, (_table, _view), _sev, _fails, _cols) in X_LOOKUPS.items():
    _total, _failed = f"SELECT count(*) FROM {_view}", f"SELECT count(*) FROM {_view} WHERE {_fails}"
    _X_COUNTS.setdefault(_g, []).append(key_counts(_code, _dim, _table, _sev, _total, _failed))
    Q["violations_" + _code.lower().replace("-", "_")] = _both_batches(
        f"SELECT '{_code}' AS rule_code, '{_sev}' AS severity, {_cols} FROM {_view} WHERE {_fails}"
    )
Q["x_cross_batch_indexed"] = _both_batches(X_PAIR_LISTS["X-CROSS-BATCH"])
Q["rule_suite_incremental"] = _both_batches(f"SELECT {_RESULT} FROM ({outcome(_ALL_COUNTS)})")
Q["learnt_cities"] = "SELECT key, value FROM known_cities"
Q["learnt_states"] = "SELECT key, value FROM known_states"
for _code, (_g, _dim, _table, _sev, _total, _failed) in X_KEYS.items():
    _X_COUNTS.setdefault(_g, []).append(key_counts(_code, _dim, _table, _sev, _total, _failed))
    if _code in X_KEY_LISTS:
        _cols, _source = X_KEY_LISTS[_code]
        Q["violations_" + _code.lower().replace("-", "_")] = _both_batches(
            f"SELECT '{_code}' AS rule_code, '{_sev}' AS severity, {_cols} FROM {_source}"
        )
    if _code in X_PAIR_LISTS:
        Q["violations_" + _code.lower().replace("-", "_")] = _both_batches(X_PAIR_LISTS[_code])
for _g, _bodies in _X_COUNTS.items():
    Q[_g] = _both_batches(
        f"SELECT {_RESULT} FROM ({outcome(union(f'SELECT * FROM ({b})' for b in _bodies))})"
    )

Q["c_006_sql"] = (
    "SELECT 'C-006' AS rule_code, 'MEDIUM' AS severity, i.invoice_id, i.invoice_number, i.customer_id,"
    " c.customer_name, c.primary_contact, c.email_address, c.phone_number, c.n AS join_rows"
    " FROM raw_invoices i JOIN (SELECT *, count(*) OVER (PARTITION BY customer_id) AS n FROM raw_customers"
    " WHERE primary_contact IS NULL OR email_address IS NULL OR phone_number IS NULL"
    " QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY _extract_timestamp DESC, _src_row DESC) = 1) c"
    " ON i.customer_id = c.customer_id"
)
Q["u_002_pairs"] = (
    "WITH ranked AS (SELECT *, lower(rtrim(email_address)) AS k,"
    " row_number() OVER (PARTITION BY lower(rtrim(email_address)) ORDER BY customer_id, _src_row) AS place,"
    " count(*) OVER (PARTITION BY lower(rtrim(email_address))) AS members FROM raw_customers"
    " WHERE email_address IS NOT NULL)"
    " SELECT 'U-002' AS rule_code, 'HIGH' AS severity, a.customer_id AS customer_id_1, b.customer_id AS customer_id_2,"
    " a.customer_name AS name_1, b.customer_name AS name_2, a.email_address AS shared_email,"
    " a.source_system AS source_1, b.source_system AS source_2, a.members AS group_size"
    " FROM ranked a JOIN ranked b ON a.k = b.k AND a.customer_id < b.customer_id WHERE a.place = 1"
)
Q["v_005_sql"] = (
    "SELECT 'V-005' AS rule_code, 'MEDIUM' AS severity, customer_id, customer_name, email_address,"
    " 'Invalid email format' AS violation_detail FROM raw_customers WHERE email_address IS NOT NULL"
    " AND (email_address NOT LIKE '%@%.%' OR email_address LIKE '% %' OR length(rtrim(email_address)) < 6)"
)

Q["v_004_decimal"] = (
    "SELECT 'V-004' AS rule_code, 'HIGH' AS severity, customer_id, customer_name, credit_limit AS raw_credit_limit,"
    " 'Cannot convert to decimal' AS violation_detail FROM raw_customers_batch2"
    " WHERE credit_limit IS NOT NULL AND (CASE WHEN credit_limit NOT ILIKE '%e%' THEN TRY_CAST(credit_limit AS DECIMAL(12,2)) END) IS NULL"
)
Q["cs_006_sql"] = (
    "SELECT 'CS-006' AS rule_code, 'HIGH' AS severity, work_order_id, work_order_number, sla_due_date, actual_end,"
    " sla_met, 'SLA flagged as MET but completed after due date' AS violation_detail FROM raw_work_orders"
    f" WHERE {U('sla_met')} = 'Y' AND {T('actual_end')} > {T('sla_due_date')}"
)

_TEXT = "CAST({0} AS VARCHAR) AS {0}".format
_STAMP = f"{LOADED} AS _extract_timestamp, 'BATCH-{{}}' AS _batch_id".format
Q["src_table"] = "SELECT * FROM customer"
Q["src_text_files"] = (
    "SELECT CAST(s_suppkey AS VARCHAR) AS supplier_id, s_name || ', \"Ltd\"' AS supplier_name,"
    " CASE WHEN s_suppkey % 11 > 0 THEN CAST(s_nationkey AS VARCHAR) END AS phone FROM supplier WHERE s_suppkey % 7 > 2"
)
Q["src_text_files_rejected"] = (
    "SELECT CASE s_suppkey % 7 WHEN 0 THEN s_suppkey || ',cut' WHEN 2 THEN s_suppkey || ',\"open,1'"
    " ELSE s_suppkey || ',\"' || s_name || ', \"\"Ltd\"\"\",'"
    " || CASE WHEN s_suppkey % 11 > 0 THEN CAST(s_nationkey AS VARCHAR) ELSE '' END || ',more' END AS _line,"
    " CASE s_suppkey % 7 WHEN 0 THEN 'short' WHEN 1 THEN 'long' ELSE 'quotes' END AS _fault"
    " FROM supplier WHERE s_suppkey % 7 <= 2"
)
Q["src_literal_rows"] = (
    f"SELECT {', '.join(map(_TEXT, ('s_suppkey', 's_name', 's_nationkey', 's_acctbal')))}, {_STAMP(1)} FROM supplier"
)
_NAMED = ("technician_id", "employee_number", "full_name", "employment_status")
_LEFT_OUT = (
    "first_name", "last_name", "skill_level", "home_region", "hire_date", "termination_date", "hourly_rate",
    "manager_id", "email", "mobile_phone", "created_date", "last_modified",
)
Q["src_insert_values"] = (
    f"SELECT {', '.join(_NAMED)}, {', '.join(f'CAST(NULL AS VARCHAR) AS {n}' for n in _LEFT_OUT)}, {_STAMP(1)}"
    " FROM raw_technicians"
)
Q["src_explicit_string_schema"] = (
    f"SELECT {', '.join(_NAMED + _LEFT_OUT)}, _extract_timestamp, _batch_id FROM raw_technicians"
)
Q["sink_overwrite"] = "SELECT technician_id, full_name FROM raw_technicians"
Q["sink_truncate_insert"] = "SELECT invoice_id, invoice_status FROM raw_invoices WHERE invoice_status IS NOT NULL"
Q["sink_append_batch"] = "SELECT customer_id, customer_name, _batch_id FROM raw_customers_all"



def _stored(source: str, run: str) -> str:
    return (
        f"SELECT '{run}' AS run_id, rule_code, dq_dimension, target_table, severity, {LOADED} AS execution_time,"
        f" total_records, failed_records, pass_rate, status, details FROM {source}"
    )


def _whole_run(run: str, day: str) -> str:
    body = union(f"SELECT * FROM ({counts(k).replace(AS_OF, day)})" for k in ALL_KEYS)
    return _stored(f"({outcome(body)})", run)


Q["sink_append_results"] = (
    _whole_run("RUN-1", AS_OF) + " UNION ALL " + _whole_run("RUN-2", "DATE '2001-07-02'")
)
Q["sink_insert_if_absent"] = (
    f"SELECT DISTINCT {_DATE_KEY('d')} AS date_sk, d AS full_date FROM (SELECT {D('invoice_date')} AS d"
    f" FROM raw_invoices UNION ALL SELECT {D('due_date')} FROM raw_invoices) WHERE d IS NOT NULL"
)
Q["sink_csv_export"] = (
    "SELECT rule_code, dq_dimension, target_table, severity, total_records, failed_records, status FROM external"
)
_TABLES = {
    "customers": "raw_customers", "technicians": "raw_technicians", "work_orders": "raw_work_orders",
    "invoices": "raw_invoices", "assignments": "raw_assignments", "parts": "raw_parts", "certs": "raw_certs",
}
_COUNTS = union(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {v}" for n, v in _TABLES.items())
Q["table_row_counts"] = (
    f"{_COUNTS} UNION ALL SELECT '(all tables)', CAST(sum(row_count) AS BIGINT) FROM ({_COUNTS})"
)

Q["rule_result"] = f"SELECT {_RESULT}, details FROM results"
Q["rule_pass_rate_sql"] = (
    "SELECT 'C-001' AS rule_code, 'CRITICAL' AS severity, 'Completeness' AS dq_dimension,"
    " 'raw.customers' AS target_table, 'customer_name' AS target_column, count(*) AS total_records,"
    f" count(*) FILTER (WHERE {_BLANK_NAME}) AS failed_records, CAST(CAST(100.0 * (1 -"
    f" CAST(count(*) FILTER (WHERE {_BLANK_NAME}) AS DOUBLE) / nullif(count(*), 0)) AS DECIMAL(5,2)) AS DOUBLE)"
    " AS pass_rate_pct FROM raw_customers"
)


def _per_batch(key: str) -> str:
    dim, table, sev, view, scope, fails, _ = ROWS[key]
    body = row_counts(code_of(key), dim, table, sev, view, scope, fails)
    return body.replace("SELECT ", "SELECT _batch_id, ", 1) + " GROUP BY _batch_id"


Q["rule_suite_by_table"] = (
    f"SELECT _batch_id, {_RESULT} FROM ({outcome(union(f'SELECT * FROM ({_per_batch(k)})' for k in ROWS))})"
    f" UNION ALL SELECT 'BATCH-1', {_RESULT} FROM"
    f" ({outcome(union(f'SELECT * FROM ({counts(k)})' for k in ALL_KEYS if k not in ROWS))})"
)
Q["rule_filter_table"] = f"SELECT {_RESULT} FROM results WHERE contains(target_table, 'invoices')"
Q["rule_error_isolation"] = (
    f"SELECT {_RESULT} FROM results"
    " UNION ALL SELECT 'V-016B', 'Validity', 'raw.customers', 'LOW', NULL, NULL, NULL, 'ERROR'"
    " UNION ALL SELECT 'V-016R', 'Validity', 'raw.customers', 'LOW', NULL, NULL, NULL, 'ERROR'"
)
Q["dq_score_overall"] = f"SELECT {_dq()} AS overall_score FROM results"
Q["dq_score_by_dimension"] = (
    f"SELECT dq_dimension, {_dq()} AS dimension_score FROM results GROUP BY dq_dimension"
)
Q["dq_score_external"] = (
    f"SELECT dq_dimension, score, {_grade('score')} AS grade FROM ("
    f"SELECT dq_dimension, {_dq(digits=1)} AS score FROM external GROUP BY dq_dimension"
    f" UNION ALL SELECT '(overall)', {_dq(digits=1)} FROM external)"
)
Q["rule_result_external"] = f"SELECT {_RESULT} FROM external"
Q["dq_grade"] = (
    f"SELECT overall_score, {_grade('overall_score')} AS grade FROM (SELECT {_dq()} AS overall_score FROM results)"
)
Q["dq_severity_counts"] = (
    "SELECT count(*) FILTER (WHERE status = 'PASS') AS rules_passed,"
    " count(*) FILTER (WHERE status <> 'PASS') AS rules_failed,"
    " count(*) FILTER (WHERE status = 'FAIL' AND severity = 'CRITICAL') AS critical_failures,"
    " count(*) FILTER (WHERE status = 'FAIL' AND severity = 'HIGH') AS high_failures FROM results"
)
Q["dq_score_summary_row"] = _summary("results", RUN, "2001-07-01")
Q["dq_failed_checks"] = (
    f"SELECT rule_code, severity, {_WEIGHT} AS weight, failed_records, details FROM results WHERE status <> 'PASS'"
    " ORDER BY weight DESC, rule_code"
)
Q["dq_score_history"] = (
    "SELECT score_date, overall_score, completeness_score, validity_score, critical_failures, high_failures FROM ("
    + union(f"({_run(day)})" for day in _RUN_DAYS)
    + ") ORDER BY score_date DESC LIMIT 5"
)
_SIX = [
    row_counts("1", "COMPLETENESS", "customers", "CRITICAL", "raw_customers", "TRUE", "customer_name IS NULL"),
    row_counts("2", "COMPLETENESS", "customers", "HIGH", "raw_customers", "TRUE", "account_status IS NULL"),
    key_counts("3", "UNIQUENESS", "customers", "CRITICAL", *KEYS["u_001"][3:]),
    key_counts("4", "UNIQUENESS", "work_orders", "CRITICAL", *KEYS["u_003"][3:]),
    row_counts("5", "VALIDITY", "customers", "CRITICAL", "raw_customers", "TRUE", ROWS["v_001"][5]),
    row_counts("6", "VALIDITY", "work_orders", "HIGH", "raw_work_orders", "TRUE",
               f"{N('labor_cost')} < 0 OR {N('parts_cost')} < 0"),
]
Q["dq_aggregate_by_table"] = (
    "SELECT target_table, dq_dimension, severity, CAST(sum(total_records) AS BIGINT) AS total_records_checked,"
    " CAST(sum(failed_records) AS BIGINT) AS total_failures, round(100 * (1 - CAST(sum(failed_records) AS DOUBLE)"
    " / nullif(sum(total_records), 0)), 2) AS pass_rate_pct"
    f" FROM ({union(f'SELECT * FROM ({b})' for b in _SIX)}) GROUP BY target_table, dq_dimension, severity"
    " ORDER BY target_table, dq_dimension, CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2"
    " WHEN 'MEDIUM' THEN 3 ELSE 4 END"
)
Q["dq_results_table"] = _stored("results", RUN)
Q["dq_score_summary_table"] = union(f"({_run(day)})" for day in _RUN_DAYS[:2])

Q["dedup_rank_email"] = (
    "SELECT _src_row, lower(trim(email_address)) AS email_key, rn_email FROM flagged_customers"
)
Q["dedup_rank_id"] = "SELECT _src_row, customer_id, rn_id FROM flagged_customers"
Q["dedup_flag"] = (
    "SELECT _src_row, customer_id, is_email_duplicate, is_id_duplicate, is_duplicate FROM flagged_customers"
)
Q["dedup_flag_null_distinct"] = (
    "SELECT _src_row, customer_id, is_email_duplicate AND email_address IS NOT NULL AS is_email_duplicate,"
    " is_id_duplicate, is_id_duplicate OR (is_email_duplicate AND email_address IS NOT NULL) AS is_duplicate"
    " FROM flagged_customers"
)
Q["dedup_reason"] = f"SELECT _src_row, customer_id, {_DUP_REASON} AS dup_reason FROM flagged_customers"
Q["dedup_master_key"] = (
    f"SELECT _src_row, customer_id, is_duplicate, {_MASTER} AS duplicate_of_key FROM flagged_customers f"
)
Q["dedup_keep_latest"] = "SELECT work_order_id, work_order_number, _extract_timestamp, _src_row FROM latest_orders"
Q["dedup_keep_latest_technicians"] = "SELECT technician_id, full_name, _src_row FROM latest_technicians"
Q["distinct_keys"] = "SELECT DISTINCT work_order_id FROM raw_work_orders"

Q["std_customer_status"] = (
    f"SELECT _src_row, account_status, {_STATUS} AS status_std, {_STATUS_PLAIN} AS status_without_typos,"
    f" {_STATUS_RAW} AS status_or_raw FROM raw_customers"
)
Q["std_customer_type"] = f"SELECT _src_row, customer_type, {_TYPE} AS type_std FROM raw_customers"
Q["std_wo_status"] = f"SELECT _src_row, status, {_WO_STATUS} AS status_std FROM raw_work_orders"
Q["std_wo_type"] = f"SELECT _src_row, work_order_type, {_WO_TYPE} AS type_std FROM raw_work_orders"
Q["std_priority"] = (
    f"SELECT _src_row, {U('priority')} AS priority_std, {_PRIORITY_CHECKED} AS priority_checked FROM raw_work_orders"
)
Q["std_bool_text"] = f"SELECT _src_row, sla_met, {_SLA} AS sla_met_std FROM raw_work_orders"
Q["std_tech_status"] = f"SELECT _src_row, employment_status, {_TECH_STATUS} AS status_std FROM raw_technicians"
Q["coerce_number"] = (
    f"SELECT _src_row, {N('credit_limit')} AS as_double,"
    " CAST((CASE WHEN credit_limit NOT ILIKE '%e%' THEN TRY_CAST(credit_limit AS DECIMAL(12,2)) END) AS DOUBLE) AS as_decimal FROM raw_customers_batch2"
)
Q["coerce_date"] = f"SELECT _src_row, {D('created_date')} AS created_date_d FROM raw_customers"
Q["coerce_timestamp"] = f"SELECT _src_row, {T('last_modified')} AS last_modified_ts FROM raw_customers"
Q["clean_text"] = (
    "SELECT _src_row, trim(customer_name) AS customer_name, lower(trim(email_address)) AS email_address,"
    " trim(billing_city) AS billing_city, upper(trim(billing_state)) AS billing_state,"
    " left(trim(billing_zip), 5) AS billing_zip, upper(trim(region_code)) AS region_code FROM raw_customers"
)
Q["repair_null_inverted_end"] = f"SELECT _src_row, {_END} AS actual_end FROM raw_work_orders"
Q["repair_null_out_of_range"] = (
    f"SELECT _src_row, {_HOURS} AS actual_hours, {_not_negative('labor_cost')} AS labor_cost,"
    f" {_not_negative('parts_cost')} AS parts_cost, {_not_negative('total_cost')} AS total_cost FROM raw_work_orders"
)
Q["repair_null_rate"] = f"SELECT _src_row, {_RATE} AS hourly_rate FROM raw_technicians"
Q["derive_full_name"] = f"SELECT _src_row, {_FULL_NAME} AS full_name FROM raw_technicians"
Q["ref_flag"] = (
    "SELECT _src_row, customer_id, customer_id IS NOT NULL AND customer_id IN"
    " (SELECT customer_id FROM raw_customers) AS ref_integrity_ok FROM raw_work_orders"
)
Q["add_load_metadata"] = (
    f"SELECT technician_id, {LOADED} AS stg_load_date, '{BATCH}' AS stg_batch_id FROM raw_technicians"
)
Q["stage_customers"] = "SELECT * FROM stg_customers"
Q["stage_customers_sql"] = "SELECT * REPLACE (CAST(credit_limit AS DOUBLE) AS credit_limit) FROM stg_customers_sql"
Q["stage_work_orders"] = "SELECT * FROM stg_orders"
Q["stage_work_orders_sql"] = f"SELECT * REPLACE ({_SHOWN_ORDER}) FROM stg_orders_sql"
Q["stage_work_orders_three_valued"] = _stage_orders(
    U("priority"), _NEG_COST_3, _NEG_COST, "HIGH: negative cost value", f"'{BATCH}'"
)
Q["stage_technicians"] = "SELECT * FROM stg_technicians"
Q["stage_invoices"] = "SELECT * FROM stg_invoices"

Q["quarantine_flags_customers"] = (
    f"SELECT _src_row, {_BLANK_NAME} AS q_null_name, account_status IS NULL AS q_null_status,"
    f" {_BAD_STATUS} AS q_invalid_status, {_NEG_CREDIT} AS q_neg_credit, {_BAD_CREDIT} AS q_bad_credit,"
    f" {_FUTURE} AS q_future_date, {_CUSTOMER_GATE} AS should_quarantine FROM raw_customers"
)
Q["quarantine_flags_customers_sql"] = _script(
    f"SELECT _src_row, {_BLANK_NAME} AS q_null_name, account_status IS NULL AS q_null_status,"
    f" {_BAD_STATUS_SQL} AS q_invalid_status, {_NEG_CREDIT} AS q_neg_credit, {_BAD_CREDIT} AS q_bad_credit,"
    f" {_FUTURE} AS q_future_date, {_CUSTOMER_GATE_SQL} AS should_quarantine FROM raw_customers"
)
Q["quarantine_flags_work_orders"] = (
    f"SELECT work_order_id, customer_id IS NULL AS q_null_cust, {_ORPHAN} AS q_orphan_cust,"
    f" {_INVERTED} AS q_inv_time, {_NEG_COST} AS q_neg_cost, customer_id IS NULL OR {_ORPHAN} OR {_INVERTED}"
    f" OR {_NEG_COST} AS should_quarantine FROM latest_orders"
)
Q["quarantine_flags_technicians"] = (
    f"SELECT technician_id, employee_number IS NULL AS q_null_emp, {_NEG_RATE} AS q_neg_rate,"
    f" {_FUTURE_HIRE} AS q_future_hire, {_INV_DATES} AS q_inv_dates, {_NEG_RATE} OR {_INV_DATES}"
    " AS should_quarantine FROM latest_technicians"
)
Q["quarantine_reason"] = (
    f"SELECT 'customers' AS table_name, _src_row AS source_row, {_CUSTOMER_REASON} AS quarantine_reason"
    " FROM flagged_customers UNION ALL SELECT 'work_orders', _src_row, "
    f"{_wo_reason('HIGH: negative cost value')} FROM latest_orders"
    f" UNION ALL SELECT 'technicians', _src_row, {_TECH_REASON} FROM latest_technicians"
)
Q["record_score_customers"] = f"SELECT _src_row, {_CUSTOMER_SCORE} AS dq_score FROM raw_customers"
Q["record_score_customers_sql"] = _script(f"SELECT _src_row, {_CUSTOMER_SCORE_SQL} AS dq_score FROM raw_customers")
Q["record_score_work_orders"] = f"SELECT work_order_id, {_wo_score(_NEG_COST)} AS dq_score FROM latest_orders"
Q["record_score_technicians"] = f"SELECT technician_id, {_TECH_SCORE} AS dq_score FROM latest_technicians"


def _log(staged: str, code: str, severity: str) -> str:
    return (
        f"SELECT '{RUN}' AS run_id, 'raw.customers' AS source_table, customer_id AS source_key, {code} AS rule_code,"
        f" {severity} AS severity, quarantine_reason, CAST(NULL AS VARCHAR) AS raw_record,"
        f" {LOADED} AS quarantine_date, FALSE AS resolved_flag, CAST(NULL AS TIMESTAMP) AS resolved_date,"
        f" CAST(NULL AS VARCHAR) AS resolved_by FROM {staged} WHERE is_quarantined"
    )


_R = "quarantine_reason"
Q["quarantine_log"] = _log(
    "stg_customers",
    f"CASE WHEN {_R} LIKE 'CRITICAL%' THEN 'C-001' WHEN {_R} LIKE 'HIGH: neg%' THEN 'V-003'"
    f" WHEN {_R} LIKE 'HIGH: unpars%' THEN 'V-004' WHEN {_R} LIKE 'MEDIUM%' THEN 'U-002' ELSE 'V-001' END",
    f"CASE WHEN {_R} LIKE 'CRITICAL%' THEN 'CRITICAL' WHEN {_R} LIKE 'MEDIUM%' THEN 'MEDIUM' ELSE 'HIGH' END",
)
Q["quarantine_log_sql"] = _log(
    "stg_customers_sql",
    f"CASE WHEN {_R} LIKE 'CRITICAL%' THEN 'C-001' WHEN {_R} LIKE 'HIGH%' THEN 'V-003' ELSE 'U-002' END",
    f"CASE WHEN {_R} LIKE 'CRITICAL%' THEN 'CRITICAL' ELSE 'HIGH' END",
)
_STAGED = {"stg.customers": "stg_customers", "stg.work_orders": "stg_orders", "stg.technicians": "stg_technicians"}
Q["quarantine_counts"] = union(
    f"SELECT '{n}' AS table_name, count(*) AS total, count(*) FILTER (WHERE is_quarantined) AS quarantined,"
    f" count(*) FILTER (WHERE NOT is_quarantined) AS clean FROM {v}"
    for n, v in _STAGED.items()
)
_FREED = "customer_id IN (SELECT customer_id FROM raw_customers_batch2)"
Q["quarantine_resolution"] = (
    f"SELECT 'raw.customers' AS source_table, customer_id AS source_key, quarantine_reason, {_FREED} AS resolved_flag,"
    f" CASE WHEN {_FREED} THEN {LOADED} END AS resolved_date, CASE WHEN {_FREED} THEN 'steward' END AS resolved_by"
    " FROM stg_customers WHERE is_quarantined"
)

Q["dim_date"] = "SELECT * FROM dim_date"
_WEEK = (
    "CAST(strftime(full_date, '%U') AS INTEGER)"
    " + CASE WHEN dayofweek(date_trunc('year', full_date)) = 0 THEN 0 ELSE 1 END"
)
Q["dim_date_sql"] = f"SELECT {_DATE_COLUMNS.replace('{week}', _WEEK)} FROM calendar"
Q["dim_customer"] = "SELECT * FROM dim_customer"
Q["dim_technician"] = (
    f"SELECT {_numbered('technician_id', 'technician_sk')}, technician_id, employee_number, full_name,"
    " employment_status, skill_level, home_region, hire_date, coalesce(hire_date, DATE '2000-01-01')"
    " AS effective_from, CAST(NULL AS DATE) AS effective_to, TRUE AS is_current,"
    f" {LOADED} AS load_date FROM stg_technicians WHERE NOT is_quarantined"
)
Q["surrogate_key"] = (
    f"SELECT {_numbered('work_order_id', 'work_order_sk')}, work_order_id"
    " FROM (SELECT DISTINCT work_order_id FROM raw_work_orders)"
)
_TRACKED = ("customer_name", "customer_type", "account_status", "region_code", "credit_limit")
_SAME = " AND ".join(f"o.{c} IS NOT DISTINCT FROM n.{c}" for c in _TRACKED)
_COLS = ("customer_id", *_TRACKED)
Q["scd2_merge"] = (
    "WITH n AS (SELECT * FROM stg_batch2 QUALIFY row_number() OVER (PARTITION BY customer_id"
    " ORDER BY last_modified DESC, customer_name) = 1),"
    " o AS (SELECT * FROM dim_customer),"
    " last AS (SELECT customer_sk >> 40 AS b, max(customer_sk & 1099511627775) AS place FROM o GROUP BY 1),"
    f" opened AS (SELECT {_numbered("(n.customer_id || '|2001-07-02')", 'sk')}, {', '.join('n.' + c for c in _COLS)}"
    f" FROM n LEFT JOIN o ON o.customer_id = n.customer_id WHERE o.customer_id IS NULL OR NOT ({_SAME}))"
    f" SELECT o.customer_sk, {', '.join('o.' + c for c in _COLS)}, o.effective_from,"
    f" CASE WHEN n.customer_id IS NOT NULL AND NOT ({_SAME}) THEN DATE '2001-07-02' END AS effective_to,"
    f" NOT (n.customer_id IS NOT NULL AND NOT ({_SAME})) AS is_current"
    " FROM o LEFT JOIN n ON o.customer_id = n.customer_id"
    f" UNION ALL SELECT sk + coalesce(place, 0), {', '.join(_COLS)}, DATE '2001-07-02', CAST(NULL AS DATE), TRUE"
    " FROM opened LEFT JOIN last ON sk >> 40 = b"
)
Q["fact_work_orders"] = "SELECT * FROM fact_orders"
Q["fact_work_orders_sql"] = (
    f"SELECT * REPLACE ({_SHOWN_ORDER}, CAST(hours_variance AS DOUBLE) AS hours_variance) FROM ("
    f"SELECT {_numbered('w.work_order_id', 'fact_wo_sk')}, w.work_order_id, w.work_order_number, c.customer_sk,"
    f" {_DATE_KEY('w.scheduled_date')} AS scheduled_date_sk, {_DATE_KEY('w.actual_end')} AS completed_date_sk,"
    f" {_MEASURES}, {LOADED} AS load_date, w.stg_batch_id AS record_source FROM stg_orders_sql w"
    " LEFT JOIN dim_customer_sql c ON w.customer_id = c.customer_id WHERE NOT w.is_quarantined)"
)
Q["fact_invoices"] = (
    f"SELECT {_numbered('i.invoice_id', 'fact_inv_sk')}, i.invoice_id, i.invoice_number, i.work_order_id,"
    " c.customer_sk, s.date_sk AS invoice_date_sk, e.date_sk AS due_date_sk, i.invoice_status, i.subtotal,"
    " i.tax_amount, i.discount_amount, i.total_amount, i.payment_received,"
    " round(i.total_amount - coalesce(i.payment_received, 0), 2) AS outstanding_amount,"
    f" {LOADED} AS load_date FROM stg_invoices i LEFT JOIN dim_customer c ON i.customer_id = c.customer_id"
    " LEFT JOIN dim_date s ON i.invoice_date = s.full_date LEFT JOIN dim_date e ON i.due_date = e.full_date"
    " WHERE NOT i.is_quarantined"
)

_OFF_DOMAIN = "({0} IS NULL OR {0} NOT IN ('ACTIVE','INACTIVE','SUSPENDED','PENDING'))".format


def _metric(name: str, raw: str, staged: str, curated: str) -> str:
    return f"SELECT '{name}' AS metric, ({raw}) AS raw, ({staged}) AS staging, ({curated}) AS curated"


def _where(view: str, cond: str) -> str:
    return f"SELECT count(*) FROM {view} WHERE {cond}"


_ZERO = "SELECT CAST(0 AS BIGINT)"
_CLEAN = "NOT is_quarantined"
_INV = f"{T('actual_end')} < {T('actual_start')}"
Q["before_after_report"] = union(
    [
        _metric("Customers — NULL name", _where("raw_customers", "customer_name IS NULL"),
                _where("stg_customers", f"{_CLEAN} AND customer_name IS NULL"), _ZERO),
        _metric("Customers — Invalid status", _where("raw_customers", _OFF_DOMAIN(U("account_status"))),
                _where("stg_customers", f"{_CLEAN} AND {_OFF_DOMAIN('account_status')}"), _ZERO),
        _metric("Customers — Duplicate IDs", "SELECT count(*) - count(DISTINCT customer_id) FROM raw_customers",
                f"SELECT count(*) - count(DISTINCT customer_id) FROM stg_customers WHERE {_CLEAN}", _ZERO),
        _metric("Total customer records", _where("raw_customers", "TRUE"), _where("stg_customers", _CLEAN),
                _where("dim_customer", "TRUE")),
        _metric("Work Orders — Negative costs", _where("raw_work_orders", _NEG_COST_3),
                _where("stg_orders", f"{_CLEAN} AND (labor_cost < 0 OR parts_cost < 0)"), _ZERO),
        _metric("Work Orders — Inverted timestamps", _where("raw_work_orders", _INV),
                _where("stg_orders", f"{_CLEAN} AND actual_end < actual_start"), _ZERO),
        _metric("Total work order records", _where("raw_work_orders", "TRUE"), _where("stg_orders", _CLEAN),
                _where("stg_orders", _CLEAN)),
    ]
)


def _layer(label: str, view: str, where: str, status: str) -> str:
    return (
        f"SELECT '{label}' AS layer, count(*) FILTER (WHERE customer_name IS NULL) AS null_names,"
        f" count(*) FILTER (WHERE {_OFF_DOMAIN(status)}) AS invalid_status,"
        f" count(*) - count(DISTINCT customer_id) AS duplicate_ids, count(*) AS total_customers"
        f" FROM {view} WHERE {where}"
    )


Q["before_after_sql"] = (
    _layer("RAW (Dirty)", "raw_customers", "TRUE", U("account_status"))
    + " UNION ALL "
    + _layer("STAGING (Cleansed)", "stg_customers_sql", _CLEAN, "account_status")
    + " UNION ALL SELECT 'CURATED (Analytics-Ready)', CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT),"
    " count(*) FROM dim_customer_sql"
)
Q["pct_share"] = union(
    f"SELECT '{n}' AS table_name, CAST(round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE is_quarantined)"
    f" / greatest(count(*), 1), 1) AS VARCHAR) || '%' AS quarantined_pct FROM {v}"
    for n, v in list(_STAGED.items())[:2]
)
Q["pipeline_run_log"] = (
    f"SELECT '{RUN}' AS run_id, 'dq_pipeline' AS pipeline_name, {LOADED} AS run_start, {LOADED} AS run_end,"
    " 'COMPLETED' AS status,"
    " (SELECT count(*) FROM raw_customers) + (SELECT count(*) FROM raw_work_orders) AS records_extracted,"
    " (SELECT count(*) FROM stg_customers) + (SELECT count(*) FROM stg_orders) AS records_staged,"
    " (SELECT count(*) FROM stg_customers WHERE is_quarantined)"
    " + (SELECT count(*) FROM stg_orders WHERE is_quarantined) AS records_quarantined,"
    " (SELECT count(*) FROM dim_customer) + (SELECT count(*) FROM stg_orders WHERE NOT is_quarantined)"
    " AS records_curated, CAST(NULL AS DOUBLE) AS dq_score, CAST(NULL AS VARCHAR) AS error_message,"
    " 'job' AS triggered_by"
)


def _assemble(sql: str) -> str:
    full = with_views(sql)
    # a text with its own WITH continues the list of views
    return re.sub(r"\nWITH ", ",\n", full, count=1) if full is not sql and sql.startswith("WITH ") else full


ORACLE = {name: _assemble(sql) for name, sql in Q.items()}
