"""Rules as SQL predicates, written apart from the library.

Row rules: key -> (code, dimension, table, severity, view, scope, fails, listing).
"""

from __future__ import annotations

from sluice.operators.catalog import BY_KEY

N = "TRY_CAST({} AS DOUBLE)".format
D = "TRY_CAST({} AS DATE)".format
T = "TRY_CAST({} AS TIMESTAMP)".format
U = "upper(trim({}))".format
US = "upper(trim(replace({}, ' ', '_')))".format

AS_OF = "DATE '2001-07-01'"

DONE = f"{U('status')} IN ('COMPLETED', 'COMPLETE')"
EMAIL = r"regexp_matches({}, '^[^@\s]+@[^@\s]+\.[^@\s]+$')".format
ALL = "TRUE"

C, WO, TE, IN, AS = "raw_customers", "raw_work_orders", "raw_technicians", "raw_invoices", "raw_assignments"
CU_COLS = "customer_id, customer_name"
WO_COLS = "work_order_id, work_order_number"
TE_COLS = "technician_id, full_name"
IN_COLS = "invoice_id, invoice_number"

_CALC_SLA = f"CASE WHEN {T('actual_end')} <= {T('sla_due_date')} THEN 'Y' ELSE 'N' END"
_SLA_OFF = f"upper(trim(sla_met)) <> {_CALC_SLA}"


def note(text: str) -> str:
    return f", '{text}' AS violation_detail"


def minutes(start: str, end: str) -> str:
    return f"date_diff('minute', {T(start)}, {T(end)})"


ROWS = {
    "c_001": ("Completeness", "customers", "CRITICAL", C, ALL,
              "customer_name IS NULL OR trim(customer_name) = ''", CU_COLS),
    "c_002": ("Completeness", "customers", "CRITICAL", C, ALL, "account_status IS NULL", CU_COLS + ", account_status"),
    "c_003": ("Completeness", "work_orders", "CRITICAL", WO, ALL, "site_id IS NULL OR customer_id IS NULL",
              WO_COLS + ", CASE WHEN site_id IS NULL THEN 'site_id is NULL' ELSE '' END AS site_issue"
              ", CASE WHEN customer_id IS NULL THEN 'customer_id is NULL' ELSE '' END AS cust_issue"),
    "c_004": ("Completeness", "work_orders", "HIGH", WO, DONE, "actual_start IS NULL OR actual_end IS NULL",
              WO_COLS + ", status, actual_start, actual_end"),
    "c_005": ("Completeness", "technicians", "HIGH", TE, ALL, "employee_number IS NULL",
              "technician_id, first_name, last_name, employee_number, employment_status"),
    "c_006": ("Completeness", "technicians", "MEDIUM", TE, ALL, "full_name IS NULL OR trim(full_name) = ''", TE_COLS),
    "c_007": ("Completeness", "customers", "MEDIUM", C, ALL,
              "primary_contact IS NULL AND email_address IS NULL AND phone_number IS NULL",
              CU_COLS + ", primary_contact, email_address, phone_number"),
    "c_008": ("Completeness", "invoices", "CRITICAL", IN, ALL, "customer_id IS NULL", IN_COLS + ", customer_id"),
    "c_009": ("Completeness", "technicians", "HIGH", TE, f"{U('employment_status')} = 'TERMINATED'",
              "termination_date IS NULL", TE_COLS + ", employment_status, termination_date"),
    "v_001": ("Validity", "customers", "CRITICAL", C, ALL,
              f"account_status IS NULL OR {U('account_status')} NOT IN ('ACTIVE','INACTIVE','SUSPENDED','PENDING')",
              CU_COLS + ", account_status" + note("Not in allowed domain: ACTIVE, INACTIVE, SUSPENDED, PENDING")),
    "v_002": ("Validity", "work_orders", "CRITICAL", WO, ALL,
              f"{US('status')} NOT IN ('SCHEDULED','IN_PROGRESS','COMPLETED','CANCELLED','ON_HOLD')",
              WO_COLS + ", status" + note("Invalid status value")),
    "v_003": ("Validity", "customers", "HIGH", C, ALL, f"{N('credit_limit')} < 0",
              CU_COLS + ", credit_limit AS raw_credit_limit"),
    "v_004": ("Validity", "customers", "HIGH", C, ALL,
              f"credit_limit IS NOT NULL AND {N('credit_limit')} IS NULL",
              CU_COLS + ", credit_limit AS raw_credit_limit" + note("Cannot convert to decimal")),
    "v_005": ("Validity", "customers", "MEDIUM", C, ALL,
              f"email_address IS NOT NULL AND NOT {EMAIL('email_address')}",
              CU_COLS + ", email_address" + note("Invalid email format")),
    "v_006": ("Validity", "work_orders", "HIGH", WO, ALL,
              f"{N('labor_cost')} < 0 OR {N('parts_cost')} < 0 OR {N('total_cost')} < 0",
              WO_COLS + ", labor_cost, parts_cost, total_cost" + note("Negative monetary amount")),
    "v_007": ("Validity", "invoices", "CRITICAL", IN, ALL,
              f"{N('subtotal')} < 0 OR {N('total_amount')} < 0 OR {N('payment_received')} < 0",
              IN_COLS + ", subtotal, total_amount, payment_received" + note("Negative financial amount")),
    "v_008": ("Validity", "work_orders", "HIGH", WO, ALL,
              f"{U('work_order_type')} NOT IN ('PREVENTIVE_MAINTENANCE','CORRECTIVE_MAINTENANCE','INSPECTION',"
              "'EMERGENCY_REPAIR','INSTALLATION')",
              WO_COLS + ", work_order_type" + note("WO type not in allowed domain")),
    "v_009": ("Validity", "technicians", "HIGH", TE, ALL,
              f"{US('employment_status')} NOT IN ('ACTIVE','TERMINATED','ON_LEAVE','SUSPENDED')",
              "technician_id, first_name, last_name, employment_status"
              f", {US('employment_status')} AS normalized_attempt"),
    "v_010": ("Validity", "technicians", "HIGH", TE, ALL, f"{N('hourly_rate')} < 0",
              TE_COLS + ", hourly_rate" + note("Negative hourly rate")),
    "v_011": ("Validity", "technicians", "MEDIUM", TE, ALL, f"{N('hourly_rate')} > 500", TE_COLS + ", hourly_rate"),
    "v_012": ("Validity", "work_orders", "MEDIUM", WO, ALL,
              f"priority IS NOT NULL AND {U('priority')} NOT IN ('CRITICAL','HIGH','MEDIUM','LOW')",
              WO_COLS + ", priority"),
    "v_013": ("Validity", "invoices", "HIGH", IN, ALL,
              f"{U('invoice_status')} NOT IN ('DRAFT','SENT','PAID','OVERDUE','CANCELLED','VOID')",
              IN_COLS + ", invoice_status"),
    "v_014": ("Validity", "work_order_assignments", "LOW", AS, ALL,
              f"{U('assignment_role')} NOT IN ('LEAD','SUPPORT','SOLO')", "assignment_id, assignment_role"),
    "v_015": ("Validity", "work_order_assignments", "MEDIUM", AS, ALL,
              f"{U('assignment_status')} NOT IN ('SCHEDULED','ACTIVE','COMPLETED','CANCELLED')",
              "assignment_id, assignment_status"),
    "v_016": ("Validity", "customers", "LOW", C, ALL, "regexp_matches(phone_number, '[a-zA-Z]')",
              CU_COLS + ", phone_number"),
    "v_017": ("Validity", "customers", "HIGH", C, ALL, f"{U('customer_type')} NOT IN ('ENTERPRISE','GOVERNMENT','SMB')",
              CU_COLS + ", customer_type"),
    "v_018": ("Validity", "invoices", "CRITICAL", IN, ALL, f"{N('discount_amount')} > {N('subtotal')}",
              IN_COLS + ", subtotal, discount_amount"),
    "cs_001": ("Consistency", "work_orders", "CRITICAL", WO, ALL, f"{T('actual_end')} < {T('actual_start')}",
               WO_COLS + f", actual_start, actual_end, {minutes('actual_end', 'actual_start')} AS minutes_inverted"),
    "cs_002": ("Consistency", "technicians", "HIGH", TE, ALL, f"{D('hire_date')} > {D('termination_date')}",
               TE_COLS + ", hire_date, termination_date" + note("hire_date is after termination_date")),
    "cs_003": ("Consistency", "work_orders", "HIGH", WO, ALL,
               f"{DONE} AND (actual_start IS NULL OR actual_end IS NULL)",
               "work_order_id, status, actual_start, actual_end" + note("Completed WO missing time data")),
    "cs_004": ("Consistency", "work_orders", "HIGH", WO, ALL,
               f"abs({N('labor_cost')} + {N('parts_cost')} - {N('total_cost')}) > 0.01",
               WO_COLS + f", {N('labor_cost')} AS labor_cost, {N('parts_cost')} AS parts_cost"
               f", round({N('labor_cost')} + {N('parts_cost')}, 2) AS expected_total"
               f", {N('total_cost')} AS actual_total"
               f", round(abs({N('labor_cost')} + {N('parts_cost')} - {N('total_cost')}), 2) AS discrepancy_amount"),
    "cs_005": ("Consistency", "invoices", "CRITICAL", IN, ALL,
               f"abs({N('subtotal')} + {N('tax_amount')} - {N('discount_amount')} - {N('total_amount')}) > 0.01",
               IN_COLS + f", {N('subtotal')} AS subtotal, {N('tax_amount')} AS tax_amount"
               f", {N('discount_amount')} AS discount_amount"
               f", round({N('subtotal')} + {N('tax_amount')} - {N('discount_amount')}, 2) AS expected_total"
               f", {N('total_amount')} AS recorded_total"
               f", round(abs({N('subtotal')} + {N('tax_amount')} - {N('discount_amount')} - {N('total_amount')}), 2)"
               " AS discrepancy"),
    "cs_006": ("Consistency", "work_orders", "HIGH", WO, ALL,
               f"{U('sla_met')} IN ('Y','YES') AND {T('actual_end')} > {T('sla_due_date')}",
               WO_COLS + ", sla_due_date, actual_end, sla_met"
               + note("SLA flagged as MET but completed after due date")),
    "cs_008": ("Consistency", "invoices", "MEDIUM", IN, ALL, f"{N('payment_received')} > {N('total_amount')}",
               IN_COLS + f", {N('total_amount')} AS invoice_total, {N('payment_received')} AS payment_received"
               f", round({N('payment_received')} - {N('total_amount')}, 2) AS overpayment"),
    "cs_009": ("Consistency", "invoices", "HIGH", IN, ALL, f"{D('due_date')} < {D('invoice_date')}",
               IN_COLS + ", invoice_date, due_date" + note("due_date is before invoice_date")),
    "cs_010": ("Consistency", "work_orders", "MEDIUM", WO, ALL,
               f"{N('actual_hours')} > 24 AND CAST({T('actual_start')} AS DATE) = CAST({T('actual_end')} AS DATE)",
               WO_COLS + ", actual_start, actual_end, actual_hours"
               + note("actual_hours exceeds maximum for single-day WO")),
    "cs_011": ("Consistency", "work_order_assignments", "HIGH", AS, ALL, f"{T('end_time')} < {T('start_time')}",
               "assignment_id, start_time, end_time"),
    "cs_012": ("Consistency", "work_order_assignments", "MEDIUM", AS, ALL,
               f"abs({N('hours_logged')} - (epoch({T('end_time')}) - epoch({T('start_time')})) / 3600.0) > 1.0",
               "assignment_id, start_time, end_time, hours_logged"),
    "t_001": ("Timeliness", "customers", "HIGH", C, ALL, f"{D('created_date')} > {AS_OF}",
              CU_COLS + ", created_date" + note("created_date is in the future")),
    "t_002": ("Timeliness", "technicians", "HIGH", TE, ALL, f"{D('hire_date')} > {AS_OF}",
              TE_COLS + ", hire_date" + note("hire_date is in the future")),
    "t_003": ("Timeliness", "work_orders", "CRITICAL", WO, ALL, f"{DONE} AND {D('scheduled_date')} > {AS_OF}",
              WO_COLS + ", status, scheduled_date, actual_end" + note("Completed WO has future scheduled date")),
    "t_004": ("Timeliness", "customers", "LOW", C, ALL,
              f"{U('account_status')} = 'ACTIVE' AND {T('last_modified')} IS NOT NULL AND date_diff('day', {D('last_modified')}, {AS_OF}) > 730",
              CU_COLS + f", account_status, last_modified"
              f", CAST(date_diff('day', {D('last_modified')}, {AS_OF}) AS INTEGER) AS days_since_modified"
              + note("Customer record not updated in 2+ years")),
    "t_005": ("Timeliness", "work_orders", "HIGH", WO, ALL,
              f"{US('status')} = 'IN_PROGRESS' AND {T('last_modified')} IS NOT NULL AND date_diff('day', {D('last_modified')}, {AS_OF}) > 90",
              WO_COLS + f", status, scheduled_date, last_modified"
              f", CAST(date_diff('day', {D('last_modified')}, {AS_OF}) AS INTEGER) AS days_open"
              + note("IN_PROGRESS WO stale for 90+ days")),
    "t_006": ("Timeliness", "customers", "MEDIUM", C, ALL,
              f"created_date IS NOT NULL AND {D('created_date')} IS NULL",
              CU_COLS + ", created_date" + note("created_date cannot be parsed as a date")),
    "t_007": ("Timeliness", "technicians", "MEDIUM", TE, ALL,
              f"hire_date IS NOT NULL AND {D('hire_date')} IS NULL", TE_COLS + ", hire_date"),
    "br_003": ("Business Rules", "work_orders", "HIGH", WO,
               f"{T('actual_end')} IS NOT NULL AND {T('sla_due_date')} IS NOT NULL AND sla_met IS NOT NULL", _SLA_OFF,
               WO_COLS + f", priority, sla_due_date, actual_end, sla_met AS recorded_sla_flag"
               f", {_CALC_SLA} AS calculated_sla_flag"
               f", CASE WHEN {_SLA_OFF} THEN 'MISMATCH' ELSE 'OK' END AS sla_flag_status"),
    "br_004": ("Business Rules", "invoices", "MEDIUM", IN, ALL,
               f"{U('invoice_status')} = 'PAID' AND payment_date IS NULL", IN_COLS + ", invoice_status, payment_date"),
    "br_005": ("Business Rules", "work_orders", "MEDIUM", WO, ALL, f"{DONE} AND {N('estimated_hours')} = 0",
               WO_COLS + ", status, estimated_hours"),
}

# key -> (dimension, table, severity, total, failed), both scalar subqueries
KEYS = {
    "u_001": ("Uniqueness", "customers", "CRITICAL", "SELECT count(*) FROM raw_customers",
              "SELECT count(*) - count(DISTINCT customer_id) - max(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END)"
              " FROM raw_customers"),
    "u_002": ("Uniqueness", "customers", "HIGH", "SELECT count(*) FROM raw_customers",
              "SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM raw_customers"
              " WHERE email_address IS NOT NULL GROUP BY lower(trim(email_address)))"),
    "u_003": ("Uniqueness", "work_orders", "CRITICAL", "SELECT count(*) FROM raw_work_orders",
              "SELECT count(*) - count(DISTINCT work_order_id)"
              " - max(CASE WHEN work_order_id IS NULL THEN 1 ELSE 0 END) FROM raw_work_orders"),
    "u_004": ("Uniqueness", "invoices", "HIGH", "SELECT count(*) FROM raw_invoices",
              "SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM raw_invoices GROUP BY work_order_id)"),
    "u_005": ("Uniqueness", "work_order_assignments", "HIGH", "SELECT count(*) FROM raw_assignments",
              "SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM raw_assignments"
              " GROUP BY work_order_id, technician_id)"),
    "u_006": ("Uniqueness", "technicians", "HIGH", "SELECT count(*) FROM raw_technicians",
              "SELECT count(*) FROM (SELECT employee_number FROM raw_technicians WHERE employee_number IS NOT NULL"
              " GROUP BY employee_number HAVING count(*) > 1)"),
    "r_001": ("Referential Integrity", "work_orders", "CRITICAL", "SELECT count(*) FROM raw_work_orders",
              "SELECT count(*) FROM raw_work_orders w WHERE customer_id IS NOT NULL AND NOT EXISTS"
              " (SELECT 1 FROM raw_customers p WHERE p.customer_id = w.customer_id)"),
    "r_002": ("Referential Integrity", "invoices", "CRITICAL", "SELECT count(*) FROM raw_invoices",
              "SELECT count(*) FROM raw_invoices w WHERE work_order_id IS NOT NULL AND NOT EXISTS"
              " (SELECT 1 FROM raw_work_orders p WHERE p.work_order_id = w.work_order_id)"),
    "r_003": ("Referential Integrity", "work_order_assignments", "HIGH", "SELECT count(*) FROM raw_assignments",
              "SELECT count(*) FROM raw_assignments w WHERE work_order_id IS NOT NULL AND NOT EXISTS"
              " (SELECT 1 FROM raw_work_orders p WHERE p.work_order_id = w.work_order_id)"),
    "r_004": ("Referential Integrity", "work_order_assignments", "HIGH", "SELECT count(*) FROM raw_assignments",
              "SELECT count(*) FROM raw_assignments w WHERE technician_id IS NOT NULL AND NOT EXISTS"
              " (SELECT 1 FROM raw_technicians p WHERE p.technician_id = w.technician_id)"),
    "r_005": ("Referential Integrity", "invoices", "HIGH", "SELECT count(*) FROM raw_invoices",
              "SELECT count(*) FROM raw_invoices w WHERE customer_id IS NOT NULL AND NOT EXISTS"
              " (SELECT 1 FROM raw_customers p WHERE p.customer_id = w.customer_id)"),
    "br_001": ("Business Rules", "work_orders", "HIGH", f"SELECT count(*) FROM raw_work_orders WHERE {DONE}",
               f"SELECT count(*) FROM raw_work_orders w WHERE {DONE} AND NOT EXISTS"
               " (SELECT 1 FROM raw_assignments a WHERE a.work_order_id = w.work_order_id)"),
    "br_002": ("Business Rules", "work_orders", "HIGH", f"SELECT count(*) FROM raw_work_orders WHERE {DONE}",
               f"SELECT count(*) FROM raw_work_orders w WHERE {DONE} AND {N('total_cost')} > 0 AND NOT EXISTS"
               " (SELECT 1 FROM raw_invoices a WHERE a.work_order_id = w.work_order_id)"),
    "cs_007": ("Consistency", "work_order_assignments", "HIGH", "SELECT count(*) FROM raw_assignments",
               "SELECT count(*) FROM raw_assignments a"
               f" JOIN (SELECT work_order_id FROM raw_work_orders WHERE {US('status')}"
               " NOT IN ('COMPLETED','COMPLETE','CANCELLED')) w ON a.work_order_id = w.work_order_id"
               f" JOIN (SELECT technician_id FROM raw_technicians WHERE {US('employment_status')} = 'TERMINATED') t"
               " ON a.technician_id = t.technician_id"),
}

_ORPHAN = (
    "SELECT '{code}' AS rule_code, '{sev}' AS severity, {cols}, '{key} not found in raw.{parent}' AS violation_detail"
    " FROM {child} w WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {pview} WHERE {key} IS NOT NULL)"
).format

KEY_LISTS = {
    "u_001": "SELECT 'U-001' AS rule_code, 'CRITICAL' AS severity, customer_id, count(*) AS occurrence_count"
             " FROM raw_customers GROUP BY customer_id HAVING count(*) > 1",
    "u_002": "SELECT 'U-002' AS rule_code, 'HIGH' AS severity, lower(trim(email_address)) AS shared_email,"
             " count(*) AS occurrence_count FROM raw_customers WHERE email_address IS NOT NULL"
             " GROUP BY lower(trim(email_address)) HAVING count(*) > 1",
    "u_003": "SELECT 'U-003' AS rule_code, 'CRITICAL' AS severity, work_order_id, count(*) AS occurrence_count,"
             " min(_extract_timestamp) AS first_seen, max(_extract_timestamp) AS last_seen"
             " FROM raw_work_orders GROUP BY work_order_id HAVING count(*) > 1",
    "u_004": "SELECT 'U-004' AS rule_code, 'HIGH' AS severity, work_order_id, invoice_count, invoice_id"
             " FROM (SELECT *, count(*) OVER (PARTITION BY work_order_id) AS invoice_count FROM raw_invoices)"
             " WHERE invoice_count > 1",
    "u_005": "SELECT 'U-005' AS rule_code, 'HIGH' AS severity, work_order_id, technician_id, assignment_count,"
             " assignment_id FROM (SELECT *, count(*) OVER (PARTITION BY work_order_id, technician_id)"
             " AS assignment_count FROM raw_assignments) WHERE assignment_count > 1",
    "u_006": "SELECT 'U-006' AS rule_code, 'HIGH' AS severity, employee_number, occurrence_count, technician_id"
             " FROM (SELECT *, count(*) OVER (PARTITION BY employee_number) AS occurrence_count"
             " FROM raw_technicians WHERE employee_number IS NOT NULL) WHERE occurrence_count > 1",
    "r_001": _ORPHAN(code="R-001", sev="CRITICAL", key="customer_id", parent="customers", child="raw_work_orders",
                     pview="raw_customers", cols=WO_COLS + ", customer_id AS orphaned_customer_id"),
    "r_002": _ORPHAN(code="R-002", sev="CRITICAL", key="work_order_id", parent="work_orders", child="raw_invoices",
                     pview="raw_work_orders", cols=IN_COLS + ", work_order_id AS orphaned_wo_id"
                     ", '$' || coalesce(total_amount, '0.00') AS at_risk_amount"),
    "r_003": _ORPHAN(code="R-003", sev="HIGH", key="work_order_id", parent="work_orders", child="raw_assignments",
                     pview="raw_work_orders", cols="assignment_id, work_order_id AS orphaned_wo_id, technician_id"),
    "r_004": _ORPHAN(code="R-004", sev="HIGH", key="technician_id", parent="technicians", child="raw_assignments",
                     pview="raw_technicians", cols="assignment_id, work_order_id, technician_id AS orphaned_tech_id"),
    "r_005": _ORPHAN(code="R-005", sev="HIGH", key="customer_id", parent="customers", child="raw_invoices",
                     pview="raw_customers", cols=IN_COLS + ", customer_id AS orphaned_customer_id"),
    "br_001": "SELECT 'BR-001' AS rule_code, 'HIGH' AS severity, work_order_id, work_order_number, status, customer_id,"
              " 'Completed WO has no technician assignment' AS violation_detail FROM raw_work_orders w"
              f" WHERE {DONE} AND NOT EXISTS (SELECT 1 FROM raw_assignments a"
              " WHERE a.work_order_id = w.work_order_id)",
    "br_002": "SELECT 'BR-002' AS rule_code, 'HIGH' AS severity, work_order_id, work_order_number, status, customer_id,"
              " total_cost, 'Completed WO has no invoice — possible revenue leakage' AS violation_detail"
              f" FROM raw_work_orders w WHERE {DONE} AND {N('total_cost')} > 0 AND NOT EXISTS"
              " (SELECT 1 FROM raw_invoices a WHERE a.work_order_id = w.work_order_id)",
    "cs_007": "SELECT 'CS-007' AS rule_code, 'HIGH' AS severity, a.assignment_id, a.technician_id, t.full_name,"
              " t.employment_status, a.work_order_id, w.wo_status, w.n * t.n AS join_rows,"
              " 'Terminated tech assigned to open WO' AS violation_detail"
              " FROM raw_assignments a JOIN ("
              "SELECT technician_id, full_name, employment_status,"
              " count(*) OVER (PARTITION BY technician_id) AS n FROM raw_technicians"
              f" WHERE {US('employment_status')} = 'TERMINATED' QUALIFY row_number() OVER"
              " (PARTITION BY technician_id ORDER BY _extract_timestamp DESC, _src_row DESC) = 1) t"
              " ON a.technician_id = t.technician_id JOIN ("
              "SELECT work_order_id, status AS wo_status, count(*) OVER (PARTITION BY work_order_id) AS n"
              f" FROM raw_work_orders WHERE {US('status')} NOT IN ('COMPLETED','COMPLETE','CANCELLED')"
              " QUALIFY row_number() OVER (PARTITION BY work_order_id"
              " ORDER BY _extract_timestamp DESC, _src_row DESC) = 1) w ON a.work_order_id = w.work_order_id",
}

# the standard order of the suite, for unions
ALL_KEYS = list(ROWS) + list(KEYS)


def code_of(key: str) -> str:
    return key.upper().replace("_", "-")


def counts(key: str, code: str | None = None) -> str:
    """One row with total and failed records of a rule."""
    code = code or code_of(key)
    if key in ROWS:
        dim, table, sev, view, scope, fails, _ = ROWS[key]
        body = row_counts(code, dim, table, sev, view, scope, fails)
    else:
        dim, table, sev, total, failed = KEYS[key]
        body = key_counts(code, dim, table, sev, total, failed)
    text = BY_KEY[key].description.replace("'", "''")
    return body.replace("SELECT ", f"SELECT '{text}' AS details, ", 1)


def row_counts(code, dim, table, sev, view, scope, fails) -> str:
    return (
        f"SELECT '{code}' AS rule_code, '{dim}' AS dq_dimension, 'raw.{table}' AS target_table, '{sev}' AS severity,"
        f" count(*) FILTER (WHERE {scope}) AS total_records,"
        f" count(*) FILTER (WHERE ({scope}) AND ({fails})) AS failed_records FROM {view}"
    )


def key_counts(code, dim, table, sev, total, failed) -> str:
    return (
        f"SELECT '{code}' AS rule_code, '{dim}' AS dq_dimension, 'raw.{table}' AS target_table, '{sev}' AS severity,"
        f" CAST(({total}) AS BIGINT) AS total_records, CAST(({failed}) AS BIGINT) AS failed_records"
    )


def outcome(body: str, digits: int = 2, warning: str = "WARNING", more: str = "") -> str:
    return (
        f"SELECT *{more}, CASE WHEN total_records > 0 THEN"
        f" round(CAST(100 AS DOUBLE) * (total_records - failed_records) / total_records, {digits})"
        " ELSE CAST(100 AS DOUBLE) END AS pass_rate,"
        " CASE WHEN failed_records = 0 THEN 'PASS' WHEN severity IN ('CRITICAL','HIGH') THEN 'FAIL'"
        f" ELSE '{warning}' END AS status FROM ({body})"
    )


def union(bodies) -> str:
    return " UNION ALL ".join(bodies)


def listing(key: str) -> str:
    if key in KEY_LISTS:
        return KEY_LISTS[key]
    _, _, sev, view, scope, fails, columns = ROWS[key]
    where = f"({scope})" if key == "br_003" else f"({scope}) AND ({fails})"
    return f"SELECT '{code_of(key)}' AS rule_code, '{sev}' AS severity, {columns} FROM {view} WHERE {where}"
