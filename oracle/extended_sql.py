"""The extended rules as SQL: row predicates and scalar subqueries."""

from __future__ import annotations

from .rules_sql import AS_OF, D, DONE, N, T, U, US

CU = ("customers", "raw_customers")
TE = ("technicians", "raw_technicians")
WO = ("work_orders", "raw_work_orders")
IN = ("invoices", "raw_invoices")
AS = ("work_order_assignments", "raw_assignments")
PA = ("work_order_parts", "raw_parts")
CE = ("technician_certifications", "raw_certs")

MONEY_MARK = r"regexp_matches({}, '^(\$|USD)([0-9.]+)$')".format
RANGE = "regexp_matches({}, '^[0-9.]+-[0-9.]+$')".format


def recovered(column: str) -> str:
    return rf"TRY_CAST(regexp_extract({column}, '^(\$|USD)([0-9.]+)$', 2) AS DOUBLE) AS recovered_amount"



def _learnt(key: str, value: str) -> str:
    return (
        "SELECT key, value FROM (SELECT key, value, n, sum(n) OVER (PARTITION BY key) AS every FROM"
        f" (SELECT {key} AS key, {value} AS value, count(*) AS n FROM raw_customers_all GROUP BY ALL)"
        " WHERE key IS NOT NULL AND value IS NOT NULL) WHERE n >= 3 AND n >= 0.3 * every"
    )


# reference frame -> text
X_REFERENCES = {
    "known_cities": _learnt(U("billing_city"), U("billing_state")),
    "known_states": _learnt(U("billing_state"), U("region_code")),
    "known_managers": "SELECT DISTINCT manager_id AS key FROM raw_technicians WHERE manager_id IS NOT NULL",
    "known_warehouses": "SELECT 'WH-' || n_nationkey AS key FROM nation WHERE n_regionkey <> 2",
}


def _unknown(key: str, reference: str) -> str:
    return f"{key} IS NOT NULL AND {key} NOT IN (SELECT key FROM {reference})"


def _contradicts(key: str, value: str, reference: str) -> str:
    return (
        f"{value} IS NOT NULL AND {key} IN (SELECT key FROM {reference})"
        f" AND {key} || chr(1) || {value} NOT IN (SELECT key || chr(1) || value FROM {reference})"
    )


# code -> (group, dimension, (table, view), severity, fails, listing), where what fails is held against a reference
X_LOOKUPS = {
    "X-CITY-UNKNOWN": ("x_city_state", "Validity", CU, "LOW", _unknown(U("billing_city"), "known_cities"),
                       "customer_id, billing_city, billing_state"),
    "X-CITY-STATE": ("x_city_state", "Consistency", CU, "MEDIUM",
                     _contradicts(U("billing_city"), U("billing_state"), "known_cities"),
                     "customer_id, billing_city, billing_state"),
    "X-REGION-UNKNOWN": ("x_region_state", "Validity", CU, "LOW", _unknown(U("billing_state"), "known_states"),
                         "customer_id, billing_state, region_code"),
    "X-REGION-STATE": ("x_region_state", "Consistency", CU, "MEDIUM",
                       _contradicts(U("billing_state"), U("region_code"), "known_states"),
                       "customer_id, billing_state, region_code"),
    "X-TECH-MANAGER": ("x_tech_domains", "Referential Integrity", TE, "MEDIUM", _unknown("manager_id", "known_managers"),
                       "technician_id, manager_id"),
    "X-PART-WAREHOUSE": ("x_parts", "Validity", PA, "LOW", _unknown(U("warehouse_code"), "known_warehouses"),
                         "part_usage_id, warehouse_code"),
}

_CODES = "list_transform(string_split(customer_name, ''), lambda c: unicode(c))"
_REPAIRED = (
    f"CASE WHEN list_max({_CODES}) BETWEEN 128 AND 255 THEN TRY(decode(unhex(array_to_string("
    f"list_transform({_CODES}, lambda n: printf('%02X', CASE WHEN n < 256 THEN n ELSE 63 END)), '')))) END"
)

# code -> (group, dimension, (table, view), severity, fails, listing)
X_ROWS = {
    "X-MOJIBAKE": ("x_mojibake", "Validity", CU, "MEDIUM", f"{_REPAIRED} IS NOT NULL",
                   f"customer_id, customer_name, {_REPAIRED} AS repaired_name"),
    "X-ZERO-WIDTH": ("x_zero_width", "Validity", CU, "MEDIUM",
                     "contains(email_address, chr(8203)) OR contains(email_address, chr(8204))"
                     " OR contains(email_address, chr(8205)) OR contains(email_address, chr(65279))",
                     "customer_id, email_address"),
    "X-CURRENCY-CREDIT": ("x_currency_text", "Validity", CU, "MEDIUM", MONEY_MARK("credit_limit"),
                          "customer_id, credit_limit, " + recovered("credit_limit")),
    "X-RANGE-CREDIT": ("x_currency_text", "Validity", CU, "MEDIUM", RANGE("credit_limit"), "customer_id, credit_limit"),
    "X-CURRENCY-RATE": ("x_currency_text", "Validity", TE, "MEDIUM", MONEY_MARK("hourly_rate"),
                        "technician_id, hourly_rate, " + recovered("hourly_rate")),
    "X-RANGE-RATE": ("x_currency_text", "Validity", TE, "MEDIUM", RANGE("hourly_rate"), "technician_id, hourly_rate"),
    "X-SCI-NOTATION": ("x_sci_notation", "Validity", CU, "LOW",
                       "regexp_matches(credit_limit, '^[0-9.]+[eE][0-9]+$')", "customer_id, credit_limit"),
    "X-MAGNITUDE": ("x_magnitude", "Validity", CU, "MEDIUM", f"{N('credit_limit')} > 1000000000",
                    "customer_id, credit_limit"),
    "X-MODIFIED-BEFORE-CREATED": ("x_modified_before_created", "Consistency", CU, "MEDIUM",
                                  f"CAST({T('last_modified')} AS DATE) < {D('created_date')}",
                                  "customer_id, created_date, last_modified"),
    "X-SCHEDULED-BEFORE-CREATED": ("x_modified_before_created", "Consistency", WO, "MEDIUM",
                                   f"{D('scheduled_date')} < {D('created_date')}",
                                   "work_order_id, created_date, scheduled_date"),
    "X-PLACEHOLDER-EMAIL": ("x_placeholder", "Validity", CU, "LOW", "lower(trim(email_address)) = 'test@test.com'",
                            "customer_id, email_address"),
    "X-DIGIT-NAME": ("x_placeholder", "Validity", CU, "MEDIUM", "regexp_matches(customer_name, '^[0-9]+$')",
                     "customer_id, customer_name"),
    "X-EMPTY-STATUS": ("x_placeholder", "Completeness", CU, "HIGH", "account_status = ''",
                       "customer_id, account_status"),
    "X-TECH-REGION": ("x_tech_domains", "Validity", TE, "MEDIUM",
                      f"{U('home_region')} NOT IN ('NE','SE','SW','NW','MW','CW')", "technician_id, home_region"),
    "X-TECH-NO-REGION": ("x_tech_domains", "Completeness", TE, "LOW", "home_region IS NULL",
                         "technician_id, home_region"),
    "X-TECH-SKILL": ("x_tech_domains", "Validity", TE, "MEDIUM",
                     f"skill_level IS NULL OR {U('skill_level')} NOT IN ('JUNIOR','MID','SENIOR')",
                     "technician_id, skill_level"),
    "X-TECH-EMAIL": ("x_tech_domains", "Validity", TE, "LOW",
                     "lower(split_part(email, '@', -1)) IN ('gmail.com','yahoo.com')", "technician_id, email"),
    "X-TECH-NAMES": ("x_tech_domains", "Completeness", TE, "MEDIUM", "first_name IS NULL AND last_name IS NULL",
                     "technician_id"),
    "X-PARTS-GT-TOTAL": ("x_component_gt_total", "Consistency", WO, "HIGH", f"{N('parts_cost')} > {N('total_cost')}",
                         "work_order_id, parts_cost, total_cost"),
    "X-LABOR-GT-TOTAL": ("x_component_gt_total", "Consistency", WO, "HIGH", f"{N('labor_cost')} > {N('total_cost')}",
                         "work_order_id, labor_cost, total_cost"),
    "X-CANCELLED-COST": ("x_state_contradiction", "Business Rules", WO, "MEDIUM",
                         f"{US('status')} = 'CANCELLED' AND {N('total_cost')} > 0", "work_order_id, total_cost"),
    "X-OPEN-WITH-END": ("x_state_contradiction", "Business Rules", WO, "MEDIUM",
                        f"{US('status')} = 'IN_PROGRESS' AND actual_end IS NOT NULL", "work_order_id, actual_end"),
    "X-OPEN-RESOLVED": ("x_state_contradiction", "Business Rules", WO, "MEDIUM",
                        f"NOT ({DONE}) AND resolution_code IS NOT NULL", "work_order_id, status, resolution_code"),
    "X-ZERO-HOURS": ("x_state_contradiction", "Business Rules", WO, "MEDIUM", f"{DONE} AND {N('actual_hours')} = 0",
                     "work_order_id, actual_hours"),
    "X-INSTALL-NO-PARTS": ("x_state_contradiction", "Business Rules", WO, "MEDIUM",
                           f"{DONE} AND {U('work_order_type')} = 'INSTALLATION'"
                           f" AND coalesce({N('parts_cost')}, 0) = 0", "work_order_id, parts_cost"),
    "X-WO-NULL-NUMBER": ("x_wo_null_number", "Completeness", WO, "MEDIUM", "work_order_number IS NULL",
                         "work_order_id"),
    "X-INVOICE-NULL-NUMBER": ("x_invoice_null_number", "Completeness", IN, "MEDIUM", "invoice_number IS NULL",
                              "invoice_id"),
    "X-BLANK-DESCRIPTION": ("x_blank_description", "Completeness", WO, "LOW", "trim(description) = ''",
                            "work_order_id"),
    "X-TAX-GT-SUBTOTAL": ("x_invoice_contradictions", "Consistency", IN, "HIGH",
                          f"{N('tax_amount')} > {N('subtotal')}", "invoice_id, subtotal, tax_amount"),
    "X-VOID-PAID": ("x_invoice_contradictions", "Business Rules", IN, "HIGH",
                    f"{U('invoice_status')} = 'VOID' AND {N('payment_received')} > 0", "invoice_id, payment_received"),
    "X-PAID-EARLY": ("x_invoice_contradictions", "Consistency", IN, "MEDIUM",
                     f"{D('payment_date')} < {D('invoice_date')}", "invoice_id, invoice_date, payment_date"),
    "X-PAID-ZERO": ("x_invoice_contradictions", "Business Rules", IN, "MEDIUM",
                    f"{U('invoice_status')} = 'PAID' AND {N('total_amount')} = 0", "invoice_id"),
    "X-PAID-NOT-MARKED": ("x_invoice_contradictions", "Business Rules", IN, "MEDIUM",
                          f"{U('invoice_status')} = 'SENT' AND {N('payment_received')} >= {N('total_amount')}",
                          "invoice_id, payment_received, total_amount"),
    "X-INVOICE-FUTURE": ("x_invoice_contradictions", "Timeliness", IN, "MEDIUM", f"{D('invoice_date')} > {AS_OF}",
                         "invoice_id, invoice_date"),
    "X-DONE-FUTURE": ("x_assignment_contradictions", "Timeliness", AS, "HIGH",
                      f"{U('assignment_status')} = 'COMPLETED' AND CAST({T('start_time')} AS DATE) > {AS_OF}",
                      "assignment_id, start_time"),
    "X-DONE-ZERO": ("x_assignment_contradictions", "Business Rules", AS, "MEDIUM",
                    f"{U('assignment_status')} = 'COMPLETED' AND {N('hours_logged')} = 0",
                    "assignment_id, hours_logged"),
    "X-NEGATIVE-HOURS": ("x_assignment_contradictions", "Validity", AS, "HIGH", f"{N('hours_logged')} < 0",
                         "assignment_id, hours_logged"),
    "X-LONG-SHIFT": ("x_assignment_contradictions", "Business Rules", AS, "LOW", f"{N('hours_logged')} > 12",
                     "assignment_id, hours_logged"),
    "X-NULL-STATUS": ("x_assignment_contradictions", "Completeness", AS, "MEDIUM", "assignment_status IS NULL",
                      "assignment_id"),
    "X-ASSIGNED-AFTER-START": ("x_assignment_contradictions", "Consistency", AS, "MEDIUM",
                               f"{D('assigned_date')} > CAST({T('start_time')} AS DATE)",
                               "assignment_id, assigned_date, start_time"),
    "X-PART-QTY": ("x_parts", "Validity", PA, "HIGH", f"{N('quantity_used')} <= 0", "part_usage_id, quantity_used"),
    "X-PART-PRICE": ("x_parts", "Validity", PA, "MEDIUM", f"{N('unit_cost')} = 0", "part_usage_id, unit_cost"),
    "X-PART-CURRENCY": ("x_parts", "Validity", PA, "MEDIUM", MONEY_MARK("unit_cost"),
                        "part_usage_id, unit_cost, " + recovered("unit_cost")),
    "X-PART-TOTAL": ("x_parts", "Consistency", PA, "HIGH",
                     f"abs({N('quantity_used')} * {N('unit_cost')} - {N('total_cost')}) > 0.01",
                     "part_usage_id, quantity_used, unit_cost, total_cost"),
    "X-PART-NULL": ("x_parts", "Completeness", PA, "MEDIUM", "part_number IS NULL", "part_usage_id"),
    "X-PART-FUTURE": ("x_parts", "Timeliness", PA, "MEDIUM", f"{D('recorded_date')} > {AS_OF}",
                      "part_usage_id, recorded_date"),
    "X-PART-RECORDER": ("x_parts", "Completeness", PA, "LOW", "recorded_by IS NULL", "part_usage_id"),
    "X-CERT-DATES": ("x_certs", "Consistency", CE, "HIGH", f"{D('expiry_date')} < {D('issued_date')}",
                     "cert_id, issued_date, expiry_date"),
    "X-CERT-NO-CODE": ("x_certs", "Completeness", CE, "MEDIUM", "certification_code IS NULL", "cert_id"),
    "X-CERT-STATUS": ("x_certs", "Validity", CE, "MEDIUM", f"{U('cert_status')} NOT IN ('ACTIVE','EXPIRED')",
                      "cert_id, cert_status"),
    "X-CERT-FUTURE": ("x_certs", "Timeliness", CE, "MEDIUM", f"{D('issued_date')} > {AS_OF}", "cert_id, issued_date"),
    "X-CERT-LAPSED": ("x_certs", "Timeliness", CE, "HIGH",
                      f"{U('cert_status')} = 'ACTIVE' AND {D('expiry_date')} < {AS_OF}", "cert_id, expiry_date"),
    "X-CERT-NO-ISSUER": ("x_certs", "Completeness", CE, "LOW", "issuing_body IS NULL", "cert_id"),
}


def _extra(view: str, *keys: str) -> str:
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (
        f"SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM {view} WHERE {known}"
        f" GROUP BY {', '.join(keys)})"
    )


# code -> (keys and failed records, from what); the keys behind the rules below
X_KEY_LISTS = {
    "X-NAME-DUPLICATE": ("upper(trim(full_name)) AS name_key, count(*) - 1 AS failed_records",
                         "raw_technicians WHERE trim(full_name) <> '' GROUP BY upper(trim(full_name))"
                         " HAVING count(*) > 1"),
    "X-WO-INACTIVE-CUSTOMER": ("customer_id, count(*) AS failed_records",
                               "raw_work_orders WHERE customer_id IN (SELECT customer_id FROM raw_customers WHERE"
                               f" {U('account_status')} IN ('INACTIVE','SUSPENDED','TEMP SUSPEND'))"
                               " GROUP BY customer_id"),
    "X-BILLED-CANCELLED": ("work_order_id, count(*) AS failed_records",
                           "raw_invoices WHERE work_order_id IN (SELECT work_order_id FROM raw_work_orders WHERE"
                           f" {US('status')} = 'CANCELLED') GROUP BY work_order_id"),
    "X-ACTIVE-ON-STOPPED": ("work_order_id, count(*) AS failed_records",
                            f"raw_assignments WHERE {U('assignment_status')} = 'ACTIVE' AND work_order_id IN"
                            " (SELECT work_order_id FROM raw_work_orders WHERE"
                            f" {US('status')} IN ('CANCELLED','ON_HOLD')) GROUP BY work_order_id"),
    "X-TWO-LEADS": ("work_order_id, CAST(1 AS BIGINT) AS failed_records",
                    f"raw_assignments WHERE {U('assignment_role')} = 'LEAD' GROUP BY work_order_id"
                    " HAVING count(*) > 1"),
    "X-PART-ORPHAN": ("work_order_id, count(*) AS failed_records",
                      "raw_parts WHERE work_order_id NOT IN (SELECT work_order_id FROM raw_work_orders)"
                      " GROUP BY work_order_id"),
    "X-PART-DUPLICATE": ("work_order_id, part_number, recorded_date, count(*) - 1 AS failed_records",
                         "raw_parts WHERE part_number IS NOT NULL GROUP BY work_order_id, part_number, recorded_date"
                         " HAVING count(*) > 1"),
    "X-CERT-DUPLICATE": ("technician_id, certification_code, count(*) - 1 AS failed_records",
                         "raw_certs WHERE certification_code IS NOT NULL GROUP BY technician_id, certification_code"
                         " HAVING count(*) > 1"),
    "X-CERT-TERMINATED": ("technician_id, count(*) AS failed_records",
                          f"raw_certs WHERE {U('cert_status')} = 'ACTIVE' AND technician_id IN"
                          f" (SELECT technician_id FROM raw_technicians WHERE {US('employment_status')}"
                          " = 'TERMINATED') GROUP BY technician_id"),
    "X-ALL-CERTS-EXPIRED": ("technician_id, count(*) AS failed_records",
                            f"raw_technicians WHERE {US('employment_status')} IN ('ACTIVE','ACTVE')"
                            " AND technician_id IN (SELECT technician_id FROM raw_certs GROUP BY technician_id"
                            f" HAVING bool_and({U('cert_status')} = 'EXPIRED')) GROUP BY technician_id"),
}

X_PAIR_LISTS = {
    "X-CROSS-BATCH": "SELECT customer_id, count(*) AS records, min(_batch_id) AS first_seen,"
                     " max(_batch_id) AS last_seen FROM raw_customers GROUP BY customer_id"
                     " HAVING count(DISTINCT _batch_id) > 1",
    "X-INVOICE-NUMBER": "SELECT invoice_number, count(*) AS records, min(invoice_id) AS first_seen,"
                        " max(invoice_id) AS last_seen FROM raw_invoices WHERE invoice_number IS NOT NULL"
                        " GROUP BY invoice_number HAVING count(DISTINCT invoice_id) > 1",
    "X-LATE-ASSIGNMENT": f"SELECT a.assignment_id, a.work_order_id, {D('a.assigned_date')} AS made, w.due"
                         " FROM raw_assignments a JOIN (SELECT work_order_id,"
                         f" max({D('scheduled_date')}) AS due FROM raw_work_orders GROUP BY work_order_id) w"
                         " ON a.work_order_id = w.work_order_id"
                         f" WHERE date_diff('day', w.due, {D('a.assigned_date')}) > 30",
}

# code -> (group, dimension, table, severity, total, failed)
X_KEYS = {
    "X-CROSS-BATCH": ("x_cross_batch_duplicate", "Uniqueness", "customers", "HIGH",
                      "SELECT count(*) FROM raw_customers",
                      "SELECT count(*) FROM (SELECT customer_id FROM raw_customers GROUP BY customer_id"
                      " HAVING count(DISTINCT _batch_id) > 1)"),
    "X-NAME-DUPLICATE": ("x_name_duplicate", "Uniqueness", "technicians", "LOW",
                         "SELECT count(*) FROM raw_technicians",
                         "SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM raw_technicians"
                         " WHERE trim(full_name) <> '' GROUP BY upper(trim(full_name)))"),
    "X-WO-INACTIVE-CUSTOMER": ("x_wo_inactive_customer", "Business Rules", "work_orders", "HIGH",
                               "SELECT count(*) FROM raw_work_orders",
                               "SELECT count(*) FROM raw_work_orders WHERE customer_id IN (SELECT customer_id"
                               f" FROM raw_customers WHERE {U('account_status')}"
                               " IN ('INACTIVE','SUSPENDED','TEMP SUSPEND'))"),
    "X-BILLED-CANCELLED": ("x_invoice_contradictions", "Business Rules", "invoices", "HIGH",
                           "SELECT count(*) FROM raw_invoices",
                           "SELECT count(*) FROM raw_invoices WHERE work_order_id IN (SELECT work_order_id"
                           f" FROM raw_work_orders WHERE {US('status')} = 'CANCELLED')"),
    "X-INVOICE-NUMBER": ("x_invoice_number_duplicate", "Uniqueness", "invoices", "HIGH",
                         "SELECT count(*) FROM raw_invoices",
                         "SELECT count(*) FROM (SELECT invoice_number FROM raw_invoices"
                         " WHERE invoice_number IS NOT NULL GROUP BY invoice_number"
                         " HAVING count(DISTINCT invoice_id) > 1)"),
    "X-ACTIVE-ON-STOPPED": ("x_assignment_contradictions", "Business Rules", "work_order_assignments", "HIGH",
                            "SELECT count(*) FROM raw_assignments",
                            f"SELECT count(*) FROM raw_assignments WHERE {U('assignment_status')} = 'ACTIVE'"
                            " AND work_order_id IN (SELECT work_order_id FROM raw_work_orders"
                            f" WHERE {US('status')} IN ('CANCELLED','ON_HOLD'))"),
    "X-LATE-ASSIGNMENT": ("x_assignment_contradictions", "Timeliness", "work_order_assignments", "MEDIUM",
                          "SELECT count(*) FROM raw_assignments",
                          "SELECT count(*) FROM raw_assignments a JOIN (SELECT work_order_id,"
                          f" max({D('scheduled_date')}) AS due FROM raw_work_orders GROUP BY work_order_id) w"
                          " ON a.work_order_id = w.work_order_id"
                          f" WHERE date_diff('day', w.due, {D('a.assigned_date')}) > 30"),
    "X-TWO-LEADS": ("x_two_leads", "Business Rules", "work_order_assignments", "MEDIUM",
                    "SELECT count(*) FROM raw_assignments",
                    "SELECT count(*) FROM (SELECT work_order_id FROM raw_assignments"
                    f" WHERE {U('assignment_role')} = 'LEAD' AND work_order_id IS NOT NULL"
                    " GROUP BY work_order_id HAVING count(*) > 1)"),
    "X-PART-ORPHAN": ("x_parts", "Referential Integrity", "work_order_parts", "HIGH",
                      "SELECT count(*) FROM raw_parts",
                      "SELECT count(*) FROM raw_parts p WHERE work_order_id IS NOT NULL AND NOT EXISTS"
                      " (SELECT 1 FROM raw_work_orders w WHERE w.work_order_id = p.work_order_id)"),
    "X-PART-DUPLICATE": ("x_parts", "Uniqueness", "work_order_parts", "MEDIUM", "SELECT count(*) FROM raw_parts",
                         _extra("raw_parts", "work_order_id", "part_number", "recorded_date")),
    "X-CERT-DUPLICATE": ("x_certs", "Uniqueness", "technician_certifications", "MEDIUM",
                         "SELECT count(*) FROM raw_certs",
                         _extra("raw_certs", "technician_id", "certification_code")),
    "X-CERT-TERMINATED": ("x_certs", "Business Rules", "technician_certifications", "MEDIUM",
                          "SELECT count(*) FROM raw_certs",
                          f"SELECT count(*) FROM raw_certs WHERE {U('cert_status')} = 'ACTIVE' AND technician_id IN"
                          f" (SELECT technician_id FROM raw_technicians WHERE {US('employment_status')}"
                          " = 'TERMINATED')"),
    "X-ALL-CERTS-EXPIRED": ("x_all_certs_expired", "Business Rules", "technicians", "HIGH",
                            "SELECT count(*) FROM raw_technicians",
                            "SELECT count(*) FROM raw_technicians t WHERE"
                            f" {US('employment_status')} IN ('ACTIVE','ACTVE') AND technician_id IN"
                            " (SELECT technician_id FROM raw_certs GROUP BY technician_id"
                            f" HAVING bool_and({U('cert_status')} = 'EXPIRED'))"),
}
