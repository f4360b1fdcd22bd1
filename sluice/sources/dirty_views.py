"""Dirty raw views derived from the star-schema tables.

Each view corrupts clean rows by key modulus, so every planted problem grows
with the table it is derived from. The text is plain SQL that Spark and other
ANSI engines read alike; ``{orders}`` and the like mark the source table.
"""

from __future__ import annotations

RAW_CUSTOMERS = """
SELECT 'CUST-' || CAST(CASE WHEN c_custkey % 50 = 49 THEN c_custkey - 1 ELSE c_custkey END AS STRING) AS customer_id,
 CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN c_custkey % 43 = 0 THEN '   ' ELSE c_name END AS customer_name,
 CASE c_custkey % 7 WHEN 0 THEN 'ENTERPRISE' WHEN 1 THEN 'Enterprise' WHEN 2 THEN 'SMB' WHEN 3 THEN 'GOVERNMENT' WHEN 4 THEN 'govt ' WHEN 5 THEN 'ENTERP' ELSE c_mktsegment END AS customer_type,
 CASE c_custkey % 13 WHEN 0 THEN NULL WHEN 1 THEN 'Active' WHEN 2 THEN 'activ' WHEN 3 THEN 'TEMP SUSPEND' WHEN 4 THEN 'PENDING_REVIEW' WHEN 5 THEN 'INACTIVE' WHEN 6 THEN ' SUSPENDED ' WHEN 7 THEN 'PENDING' WHEN 8 THEN '' ELSE 'ACTIVE' END AS account_status,
 CASE c_custkey % 29 WHEN 0 THEN 'TBD' WHEN 1 THEN '$450000' WHEN 2 THEN '2.5e5' WHEN 3 THEN NULL WHEN 4 THEN '99999999999.00' ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING) END AS credit_limit,
 CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE 'Contact ' || CAST(c_custkey AS STRING) END AS primary_contact,
 CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN 'not-an-email' WHEN c_custkey % 23 = 0 THEN 'u' || CAST(c_custkey AS STRING) || '@@x.com' WHEN c_custkey % 11 = 0 THEN 'U' || CAST(c_custkey - 1 AS STRING) || '@Mail.com ' ELSE 'u' || CAST(c_custkey AS STRING) || '@mail.com' END AS email_address,
 CASE WHEN c_custkey % 34 = 0 THEN NULL WHEN c_custkey % 31 = 0 THEN 'CALL-MAIN-OFFICE' ELSE '555-' || CAST(c_custkey AS STRING) END AS phone_number,
 ' City' || CAST(c_custkey % 90 AS STRING) || ' ' AS billing_city,
 CASE c_custkey % 4 WHEN 0 THEN 'TX' WHEN 1 THEN 'tx' WHEN 2 THEN 'KS ' ELSE 'CA' END AS billing_state,
 CASE WHEN c_custkey % 6 = 0 THEN ' 39201-4872' ELSE '78701' END AS billing_zip,
 CASE c_custkey % 5 WHEN 0 THEN 'SW' WHEN 1 THEN 'sw' WHEN 2 THEN 'NE ' WHEN 3 THEN 'South-East' ELSE 'MW' END AS region_code,
 CASE WHEN c_custkey % 37 = 0 THEN 'UNKNOWN' WHEN c_custkey % 47 = 0 THEN '2027-01-01' ELSE CAST(DATE '1995-01-01' + CAST(c_custkey % 2300 AS INT) AS STRING) END AS created_date,
 CASE WHEN c_custkey % 5 = 0 THEN '1998-06-30 12:00:00' WHEN c_custkey % 53 = 0 THEN 'N/A' ELSE '2001-06-' || LPAD(CAST(1 + c_custkey % 28 AS STRING), 2, '0') || ' 08:00:00' END AS last_modified,
 CASE c_custkey % 3 WHEN 0 THEN 'APP' WHEN 1 THEN 'MOBILE' ELSE 'LEGACY' END AS source_system,
 CASE WHEN c_custkey % 50 = 49 THEN TIMESTAMP '2001-06-30 00:00:00' ELSE TIMESTAMP '2001-06-29 00:00:00' END AS _extract_timestamp,
 CASE WHEN c_custkey % 50 = 49 THEN 'BATCH-2' ELSE 'BATCH-1' END AS _batch_id, c_custkey AS _src_row
FROM {customer}
"""

RAW_TECHNICIANS = """
SELECT 'TECH-' || CAST(s_suppkey AS STRING) AS technician_id,
 CASE WHEN s_suppkey % 11 = 0 THEN NULL WHEN s_suppkey % 13 = 0 THEN 'EMP-1' ELSE 'EMP-' || CAST(s_suppkey AS STRING) END AS employee_number,
 'First' || CAST(s_suppkey AS STRING) AS first_name, ' Last' || CAST(s_nationkey AS STRING) || ' ' AS last_name,
 CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 17 = 0 THEN '  ' ELSE s_name END AS full_name,
 CASE s_suppkey % 9 WHEN 0 THEN 'active' WHEN 1 THEN 'TERMINATED' WHEN 2 THEN 'ON LEAVE' WHEN 3 THEN 'On-Leave' WHEN 4 THEN 'ACTVE' WHEN 5 THEN 'Terminated' WHEN 6 THEN 'SUSPENDED' ELSE 'ACTIVE' END AS employment_status,
 CASE s_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Senior' WHEN 2 THEN 'MID ' ELSE 'JUNIOR' END AS skill_level,
 CASE s_suppkey % 4 WHEN 0 THEN 'sw' WHEN 1 THEN 'NE' WHEN 2 THEN 'SOUTH' ELSE NULL END AS home_region,
 CASE WHEN s_suppkey % 19 = 0 THEN 'UNKNOWN' WHEN s_suppkey % 21 = 0 THEN '2026-01-01' ELSE CAST(DATE '1995-01-01' + CAST(s_suppkey % 2000 AS INT) AS STRING) END AS hire_date,
 CASE WHEN s_suppkey % 9 = 1 THEN CAST(DATE '1995-01-01' + CAST(s_suppkey % 2000 - 10 AS INT) AS STRING) ELSE NULL END AS termination_date,
 CASE s_suppkey % 8 WHEN 0 THEN '-38.50' WHEN 1 THEN '9999.00' WHEN 2 THEN '50-60' WHEN 3 THEN '$41.00' ELSE '65.00' END AS hourly_rate,
 'MGR-' || CAST(s_suppkey % 6 AS STRING) AS manager_id, 't' || CAST(s_suppkey AS STRING) || '@corp.com' AS email, '555-4' || CAST(s_suppkey AS STRING) AS mobile_phone,
 '1995-01-01' AS created_date, '2001-06-01 00:00:00' AS last_modified, TIMESTAMP '2001-06-29 00:00:00' AS _extract_timestamp, 'BATCH-1' AS _batch_id, s_suppkey AS _src_row
FROM {supplier}
"""

RAW_WORK_ORDERS = """
SELECT 'WO-' || CAST(CASE WHEN o_orderkey % 100 = 99 THEN o_orderkey - 1 ELSE o_orderkey END AS STRING) AS work_order_id,
 CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE 'WON-' || CAST(o_orderkey AS STRING) END AS work_order_number,
 CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE 'SITE-' || CAST(o_orderkey % 500 AS STRING) END AS site_id,
 CASE WHEN o_orderkey % 59 = 0 THEN NULL WHEN o_orderkey % 61 = 0 THEN 'CUST-X' || CAST(o_orderkey AS STRING) ELSE 'CUST-' || CAST(o_custkey AS STRING) END AS customer_id,
 CASE o_orderkey % 8 WHEN 0 THEN 'PREVENTIVE_MAINTENANCE' WHEN 1 THEN 'corrective_maintenance' WHEN 2 THEN 'INSPECTION' WHEN 3 THEN 'EMERGENCY_REPAIR' WHEN 4 THEN 'INSTALLATION' WHEN 5 THEN 'SITE_SURVEY' WHEN 6 THEN ' INSPECTION ' ELSE 'GENERAL_MAINTENANCE' END AS work_order_type,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'CRITICAL' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'MEDIUM ' WHEN '5-LOW' THEN 'LOW' ELSE CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'INSPECTION' END END AS priority,
 CASE o_orderstatus WHEN 'F' THEN CASE o_orderkey % 3 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'complete' ELSE ' Completed' END WHEN 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'IN PROGRESS' ELSE 'IN_PROGRESS' END ELSE CASE o_orderkey % 4 WHEN 0 THEN 'SCHEDULED' WHEN 1 THEN 'ON HOLD' WHEN 2 THEN 'CANCELLED' ELSE 'DRAFT' END END AS status,
 CASE WHEN o_orderkey % 67 = 0 THEN NULL WHEN o_orderkey % 71 = 0 THEN '   ' ELSE ' job ' || CAST(o_orderkey AS STRING) END AS description,
 CAST(CAST(o_orderdate AS DATE) AS STRING) AS scheduled_date,
 CASE WHEN o_orderstatus = 'O' OR o_orderkey % 73 = 0 THEN NULL ELSE CAST(o_orderdate + INTERVAL 8 HOUR AS STRING) END AS actual_start,
 CASE WHEN o_orderstatus <> 'F' OR o_orderkey % 79 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN CAST(o_orderdate + INTERVAL 5 HOUR AS STRING) WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate + INTERVAL 11 HOUR AS STRING) ELSE CAST(o_orderdate + INTERVAL 14 HOUR AS STRING) END AS actual_end,
 CASE WHEN o_orderkey % 83 = 0 THEN '0.0' WHEN o_orderkey % 89 = 0 THEN 'n/a' ELSE CAST(CAST(2 + o_orderkey % 7 AS DECIMAL(6,2)) AS STRING) END AS estimated_hours,
 CASE WHEN o_orderstatus <> 'F' THEN NULL WHEN o_orderkey % 91 = 0 THEN '31.0' WHEN o_orderkey % 93 = 0 THEN '-2.0' ELSE CAST(CAST(3 + o_orderkey % 5 AS DECIMAL(6,2)) AS STRING) END AS actual_hours,
 CASE WHEN o_orderstatus = 'O' THEN NULL WHEN o_orderkey % 37 = 0 THEN '-195.00' ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END AS labor_cost,
 CASE WHEN o_orderstatus = 'O' OR o_orderkey % 27 = 0 THEN NULL ELSE CAST(CAST(o_orderkey % 1000 AS DECIMAL(12,2)) AS STRING) END AS parts_cost,
 CASE WHEN o_orderstatus = 'O' THEN NULL WHEN o_orderkey % 43 = 0 THEN '10.00' ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) + CAST(o_orderkey % 1000 AS DECIMAL(12,2)) AS STRING) END AS total_cost,
 CAST(o_orderdate + INTERVAL 12 HOUR AS STRING) AS sla_due_date,
 CASE WHEN o_orderstatus <> 'F' THEN NULL ELSE CASE o_orderkey % 6 WHEN 0 THEN 'Y' WHEN 1 THEN 'y' WHEN 2 THEN 'YES' WHEN 3 THEN 'N' WHEN 4 THEN 'no' ELSE 'maybe' END END AS sla_met,
 CASE WHEN o_orderstatus = 'F' THEN ' RESOLVED_COMPLETE ' ELSE NULL END AS resolution_code,
 CAST(CAST(o_orderdate AS DATE) - 2 AS STRING) AS created_date,
 CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE CAST(o_orderdate + INTERVAL 15 HOUR AS STRING) END AS last_modified,
 CASE WHEN o_orderkey % 100 = 99 THEN TIMESTAMP '2001-06-30 00:00:00' ELSE TIMESTAMP '2001-06-29 00:00:00' END AS _extract_timestamp, 'BATCH-1' AS _batch_id, o_orderkey AS _src_row
FROM {orders}
"""

RAW_INVOICES = """
SELECT 'INV-' || CAST(o_orderkey AS STRING) AS invoice_id,
 CASE WHEN o_orderkey % 45 = 1 THEN NULL ELSE 'INVN-' || CAST(o_orderkey AS STRING) END AS invoice_number,
 CASE WHEN o_orderkey % 77 = 1 THEN 'WO-X' || CAST(o_orderkey AS STRING) WHEN o_orderkey % 10 = 1 THEN 'WO-' || CAST(o_orderkey + 1 AS STRING) ELSE 'WO-' || CAST(o_orderkey AS STRING) END AS work_order_id,
 CASE WHEN o_orderkey % 55 = 1 THEN NULL WHEN o_orderkey % 65 = 1 THEN 'CUST-X' ELSE 'CUST-' || CAST(o_custkey AS STRING) END AS customer_id,
 CAST(CAST(o_orderdate AS DATE) AS STRING) AS invoice_date,
 CASE WHEN o_orderkey % 33 = 1 THEN CAST(CAST(o_orderdate AS DATE) - 4 AS STRING) ELSE CAST(CAST(o_orderdate AS DATE) + 30 AS STRING) END AS due_date,
 CASE o_orderkey % 7 WHEN 0 THEN 'PAID' WHEN 1 THEN 'paid ' WHEN 2 THEN 'SENT' WHEN 3 THEN 'DRAFT' WHEN 4 THEN 'VOID' WHEN 5 THEN 'AWAITING_APPROVAL' ELSE 'OVERDUE' END AS invoice_status,
 CASE WHEN o_orderkey % 39 = 1 THEN '-280.00' ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END AS subtotal,
 CAST(CAST(o_orderkey % 400 AS DECIMAL(12,2)) AS STRING) AS tax_amount,
 CASE WHEN o_orderkey % 49 = 1 THEN '9999999.00' ELSE '0.00' END AS discount_amount,
 CASE WHEN o_orderkey % 25 = 1 THEN '345.00' ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) + CAST(o_orderkey % 400 AS DECIMAL(12,2)) AS STRING) END AS total_amount,
 'NET-30' AS payment_terms,
 CASE WHEN o_orderkey % 7 > 1 THEN NULL WHEN o_orderkey % 35 = 1 THEN '99999999.00' ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END AS payment_received,
 CASE WHEN o_orderkey % 7 > 1 OR o_orderkey % 21 = 1 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) + 12 AS STRING) END AS payment_date,
 TIMESTAMP '2001-06-29 00:00:00' AS _extract_timestamp, 'BATCH-1' AS _batch_id, o_orderkey AS _src_row
FROM {orders}
"""

RAW_ASSIGNMENTS = """
SELECT 'ASGN-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS assignment_id,
 CASE WHEN l_partkey % 101 = 0 THEN 'WO-X' || CAST(l_orderkey AS STRING) ELSE 'WO-' || CAST(l_orderkey AS STRING) END AS work_order_id,
 CASE WHEN l_partkey % 103 = 0 THEN 'TECH-X' ELSE 'TECH-' || CAST(l_suppkey AS STRING) END AS technician_id,
 CASE l_linenumber % 4 WHEN 0 THEN 'lead' WHEN 1 THEN 'SUPPORT' WHEN 2 THEN 'SOLO ' ELSE 'OBSERVER' END AS assignment_role,
 CAST(CAST(l_shipdate AS DATE) - 2 AS STRING) AS assigned_date,
 CAST(l_shipdate + INTERVAL 8 HOUR AS STRING) AS start_time,
 CASE WHEN l_partkey % 47 = 0 THEN CAST(l_shipdate + INTERVAL 6 HOUR AS STRING) WHEN l_partkey % 51 = 0 THEN NULL ELSE CAST(l_shipdate + INTERVAL 12 HOUR AS STRING) END AS end_time,
 CASE WHEN l_partkey % 57 = 0 THEN NULL WHEN l_partkey % 63 = 0 THEN '-2.5' ELSE CAST(CAST(l_linenumber AS DECIMAL(6,2)) AS STRING) END AS hours_logged,
 CASE l_partkey % 5 WHEN 0 THEN 'SCHEDULED' WHEN 1 THEN 'active' WHEN 2 THEN 'Done' WHEN 3 THEN NULL ELSE 'COMPLETED' END AS assignment_status,
 TIMESTAMP '2001-06-29 00:00:00' AS _extract_timestamp, 'BATCH-1' AS _batch_id
FROM {lineitem}
"""

RAW_PARTS = """
SELECT 'PART-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS part_usage_id,
 CASE WHEN l_partkey % 99 = 0 THEN 'WO-X' || CAST(l_orderkey AS STRING) ELSE 'WO-' || CAST(l_orderkey AS STRING) END AS work_order_id,
 CASE WHEN l_partkey % 87 = 0 THEN NULL ELSE 'PN-' || CAST(l_partkey % 40 AS STRING) END AS part_number,
 CASE WHEN l_partkey % 69 = 0 THEN '0' WHEN l_partkey % 75 = 0 THEN '-2' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS quantity_used,
 CASE WHEN l_partkey % 81 = 0 THEN '$85.00' WHEN l_partkey % 85 = 0 THEN '0.00' ELSE '10.00' END AS unit_cost,
 CASE WHEN l_partkey % 95 = 0 THEN '150.00' ELSE CAST(CAST(CAST(l_quantity AS INT) * 10 AS DECIMAL(12,2)) AS STRING) END AS total_cost,
 'WH-' || CAST(l_suppkey % 9 AS STRING) AS warehouse_code,
 CASE WHEN l_partkey % 37 = 0 THEN NULL ELSE 'user' || CAST(l_suppkey AS STRING) END AS recorded_by,
 CAST(CAST(l_shipdate AS DATE) AS STRING) AS recorded_date, TIMESTAMP '2001-06-29 00:00:00' AS _extract_timestamp, 'BATCH-1' AS _batch_id
FROM {lineitem}
"""

RAW_CERTS = """
SELECT 'CERT-' || CAST(p_partkey AS STRING) AS cert_id, 'TECH-' || CAST(p_partkey % 110 AS STRING) AS technician_id,
 CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE 'CODE-' || CAST(p_size % 12 AS STRING) END AS certification_code,
 p_name AS certification_name, CASE WHEN p_partkey % 29 = 0 THEN '2026-03-01' ELSE CAST(DATE '1996-01-01' + CAST(p_partkey % 1500 AS INT) AS STRING) END AS issued_date,
 CASE WHEN p_partkey % 23 = 0 THEN '1995-01-15' ELSE CAST(DATE '2000-01-01' + CAST(p_partkey % 1500 AS INT) AS STRING) END AS expiry_date,
 CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE p_brand END AS issuing_body,
 CASE p_partkey % 6 WHEN 0 THEN 'EXPIRED' WHEN 1 THEN 'under review' ELSE 'ACTIVE' END AS cert_status,
 TIMESTAMP '2001-06-29 00:00:00' AS _extract_timestamp, 'BATCH-1' AS _batch_id
FROM {part}
"""
# The second extract: re-extracted keys next to new ones, and problem classes
# the first extract does not hold (broken encodings, invisible characters,
# place and region contradictions, placeholders).
RAW_CUSTOMERS_BATCH2 = """
SELECT CASE WHEN c_custkey % 4 = 0 THEN 'CUST-' || CAST(c_custkey AS STRING) ELSE 'CUST-B' || CAST(c_custkey AS STRING) END AS customer_id,
 CASE WHEN c_custkey % 5 = 0 THEN 'FÃ¡brica ' || CAST(c_custkey AS STRING) WHEN c_custkey % 7 = 0 THEN CAST(100000 + c_custkey AS STRING) ELSE c_name END AS customer_name,
 CASE c_custkey % 3 WHEN 0 THEN 'ENTERPRISE' WHEN 1 THEN 'GOVERNMENT' ELSE 'SMB' END AS customer_type,
 CASE c_custkey % 11 WHEN 0 THEN '1' WHEN 1 THEN '' WHEN 2 THEN 'INACTIVE' ELSE 'ACTIVE' END AS account_status,
 CASE c_custkey % 13 WHEN 0 THEN 'USD125000' WHEN 1 THEN '$450000' WHEN 2 THEN '2.5e5' WHEN 3 THEN '50-60' WHEN 4 THEN '99999999999.00' ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING) END AS credit_limit,
 'Contact ' || CAST(c_custkey AS STRING) AS primary_contact,
 CASE WHEN c_custkey % 17 = 0 THEN 'u' || CAST(c_custkey AS STRING) || '@ma​il.com' WHEN c_custkey % 19 = 0 THEN 'test@test.com' ELSE 'u' || CAST(c_custkey AS STRING) || '@mail.com' END AS email_address,
 '555-9' || CAST(c_custkey AS STRING) AS phone_number,
 CASE c_custkey % 4 WHEN 0 THEN 'Miami' WHEN 1 THEN 'Portland' WHEN 2 THEN 'Houston' ELSE 'Atlanta' END AS billing_city,
 CASE c_custkey % 5 WHEN 0 THEN 'TX' WHEN 1 THEN 'FL' WHEN 2 THEN 'OR' WHEN 3 THEN 'GA' ELSE 'tx ' END AS billing_state,
 CASE WHEN c_custkey % 6 = 0 THEN '82001-1234' ELSE '77003' END AS billing_zip,
 CASE c_custkey % 3 WHEN 0 THEN 'SW' WHEN 1 THEN 'NE' ELSE 'SE' END AS region_code,
 CAST(DATE '1997-01-01' + CAST(c_custkey % 1500 AS INT) AS STRING) AS created_date,
 CASE WHEN c_custkey % 23 = 0 THEN '1996-01-01 09:00:00' ELSE '2001-06-' || LPAD(CAST(1 + c_custkey % 28 AS STRING), 2, '0') || ' 10:00:00' END AS last_modified,
 'LEGACY_DB' AS source_system,
 TIMESTAMP '2001-06-30 12:00:00' AS _extract_timestamp,
 'BATCH-B' AS _batch_id, -c_custkey AS _src_row
FROM {customer}
"""

RAW_TECHNICIANS_BATCH2 = """
SELECT 'TECH-B' || CAST(s_suppkey AS STRING) AS technician_id, 'EMP-B' || CAST(s_suppkey AS STRING) AS employee_number,
 CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 'First' || CAST(s_suppkey AS STRING) END AS first_name,
 CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 'Last' || CAST(s_suppkey AS STRING) END AS last_name,
 CASE WHEN s_suppkey % 4 = 0 THEN s_name WHEN s_suppkey % 7 = 0 THEN 'Unknown Tech' ELSE 'First' || CAST(s_suppkey AS STRING) || ' Last' END AS full_name,
 CASE WHEN s_suppkey % 11 = 0 THEN 'SUSPENDED' ELSE 'ACTIVE' END AS employment_status,
 CASE s_suppkey % 6 WHEN 0 THEN 'SENOIR' WHEN 1 THEN 'Mid-Level' ELSE 'MID' END AS skill_level,
 CASE s_suppkey % 5 WHEN 0 THEN 'SOUTHWEST' WHEN 1 THEN NULL ELSE 'CW' END AS home_region,
 CAST(DATE '1996-01-01' + CAST(s_suppkey % 1500 AS INT) AS STRING) AS hire_date, CAST(NULL AS STRING) AS termination_date,
 CASE s_suppkey % 8 WHEN 0 THEN '50-60' WHEN 1 THEN '$41.00' ELSE '55.00' END AS hourly_rate,
 CASE WHEN s_suppkey % 9 = 0 THEN 'MGR-999' ELSE 'MGR-1' END AS manager_id,
 'b' || CAST(s_suppkey AS STRING) || CASE s_suppkey % 10 WHEN 0 THEN '@gmail.com' WHEN 1 THEN '@yahoo.com' ELSE '@corp.com' END AS email,
 '555-5' || CAST(s_suppkey AS STRING) AS mobile_phone, '1996-01-01' AS created_date, '2001-06-20 00:00:00' AS last_modified,
 TIMESTAMP '2001-06-30 12:00:00' AS _extract_timestamp, 'BATCH-B' AS _batch_id, -s_suppkey AS _src_row
FROM {supplier}
"""

RAW_WORK_ORDERS_BATCH2 = """
SELECT 'WO-B' || CAST(o_orderkey AS STRING) AS work_order_id,
 CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE 'WON-B' || CAST(o_orderkey AS STRING) END AS work_order_number,
 'SITE-' || CAST(o_orderkey % 500 AS STRING) AS site_id, 'CUST-' || CAST(o_custkey AS STRING) AS customer_id,
 CASE WHEN o_orderkey % 6 = 4 THEN 'INSTALLATION' ELSE 'INSPECTION' END AS work_order_type,
 CASE WHEN o_orderkey % 13 = 0 THEN 'INSPECTION' ELSE 'HIGH' END AS priority,
 CASE o_orderkey % 6 WHEN 0 THEN 'CANCELLED' WHEN 1 THEN 'IN_PROGRESS' WHEN 2 THEN 'IN PROGRESS' ELSE 'COMPLETED' END AS status,
 CASE WHEN o_orderkey % 17 = 0 THEN '   ' ELSE 'job ' || CAST(o_orderkey AS STRING) END AS description,
 CAST(CAST(o_orderdate AS DATE) AS STRING) AS scheduled_date,
 CAST(o_orderdate + INTERVAL 8 HOUR AS STRING) AS actual_start,
 CASE WHEN o_orderkey % 6 IN (0, 2) THEN NULL ELSE CAST(o_orderdate + INTERVAL 11 HOUR AS STRING) END AS actual_end,
 '2.0' AS estimated_hours, CASE WHEN o_orderkey % 6 = 3 THEN '0.0' ELSE '3.0' END AS actual_hours,
 CASE WHEN o_orderkey % 19 = 0 THEN '650.00' ELSE '195.00' END AS labor_cost,
 CASE WHEN o_orderkey % 6 = 4 THEN '0.00' WHEN o_orderkey % 23 = 0 THEN '2800.00' ELSE '45.00' END AS parts_cost,
 '240.00' AS total_cost, CAST(o_orderdate + INTERVAL 12 HOUR AS STRING) AS sla_due_date,
 CASE WHEN o_orderkey % 6 IN (0, 2) THEN NULL ELSE 'Y' END AS sla_met,
 CASE WHEN o_orderkey % 6 IN (2, 5) THEN 'RESOLVED_COMPLETE' ELSE NULL END AS resolution_code,
 CASE WHEN o_orderkey % 9 = 0 THEN CAST(CAST(o_orderdate AS DATE) + 6 AS STRING) ELSE CAST(CAST(o_orderdate AS DATE) - 2 AS STRING) END AS created_date,
 CAST(o_orderdate + INTERVAL 15 HOUR AS STRING) AS last_modified,
 TIMESTAMP '2001-06-30 12:00:00' AS _extract_timestamp, 'BATCH-B' AS _batch_id, -o_orderkey AS _src_row
FROM {orders}
"""

RAW_INVOICES_BATCH2 = """
SELECT 'INV-B' || CAST(o_orderkey AS STRING) AS invoice_id,
 CASE WHEN o_orderkey % 45 = 2 THEN NULL WHEN o_orderkey % 10 = 1 THEN 'INVN-B' || CAST(o_orderkey + 1 AS STRING) ELSE 'INVN-B' || CAST(o_orderkey AS STRING) END AS invoice_number,
 'WO-B' || CAST(o_orderkey AS STRING) AS work_order_id, 'CUST-' || CAST(o_custkey AS STRING) AS customer_id,
 CASE WHEN o_orderkey % 31 = 0 THEN '2026-06-01' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS invoice_date,
 CAST(CAST(o_orderdate AS DATE) + 30 AS STRING) AS due_date,
 CASE o_orderkey % 4 WHEN 0 THEN 'VOID' WHEN 1 THEN 'PAID' WHEN 2 THEN 'SENT' ELSE 'DRAFT' END AS invoice_status,
 CASE WHEN o_orderkey % 20 = 1 THEN '0.00' ELSE '195.00' END AS subtotal,
 CASE WHEN o_orderkey % 29 = 0 THEN '290.00' WHEN o_orderkey % 20 = 1 THEN '0.00' ELSE '15.60' END AS tax_amount,
 '0.00' AS discount_amount, CASE WHEN o_orderkey % 20 = 1 THEN '0.00' ELSE '210.60' END AS total_amount, 'NET-30' AS payment_terms,
 CASE WHEN o_orderkey % 4 = 3 THEN NULL WHEN o_orderkey % 20 = 1 THEN '0.00' WHEN o_orderkey % 8 = 2 THEN '210.60' WHEN o_orderkey % 4 = 2 THEN '10.00' ELSE '210.60' END AS payment_received,
 CASE WHEN o_orderkey % 4 = 3 THEN NULL WHEN o_orderkey % 37 = 1 THEN CAST(CAST(o_orderdate AS DATE) - 1 AS STRING) ELSE CAST(CAST(o_orderdate AS DATE) + 12 AS STRING) END AS payment_date,
 TIMESTAMP '2001-06-30 12:00:00' AS _extract_timestamp, 'BATCH-B' AS _batch_id, -o_orderkey AS _src_row
FROM {orders}
"""

RAW_ASSIGNMENTS_BATCH2 = """
SELECT 'ASGN-B' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS assignment_id,
 'WO-B' || CAST(l_orderkey AS STRING) AS work_order_id, 'TECH-B' || CAST(l_suppkey AS STRING) AS technician_id,
 CASE WHEN l_linenumber % 3 = 0 THEN 'LEAD' ELSE 'SUPPORT' END AS assignment_role,
 CASE WHEN l_partkey % 41 = 0 THEN CAST(CAST(l_shipdate AS DATE) + 2 AS STRING) ELSE CAST(CAST(l_shipdate AS DATE) - 2 AS STRING) END AS assigned_date,
 CASE WHEN l_partkey % 43 = 0 THEN '2025-06-15 09:00:00' ELSE CAST(l_shipdate + INTERVAL 6 HOUR AS STRING) END AS start_time,
 CASE WHEN l_partkey % 43 = 0 THEN '2025-06-15 11:00:00' ELSE CAST(l_shipdate + INTERVAL 14 HOUR AS STRING) END AS end_time,
 CASE WHEN l_partkey % 47 = 0 THEN '0.0' WHEN l_partkey % 53 = 0 THEN '16.0' ELSE '8.0' END AS hours_logged,
 CASE l_partkey % 7 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN NULL ELSE 'COMPLETED' END AS assignment_status,
 TIMESTAMP '2001-06-30 12:00:00' AS _extract_timestamp, 'BATCH-B' AS _batch_id
FROM {lineitem}
"""

RAW_CERTS_BATCH2 = """
SELECT 'CERT-B' || CAST(p_partkey AS STRING) AS cert_id, 'TECH-B' || CAST(p_partkey % 50 AS STRING) AS technician_id,
 'CODE-' || CAST(p_size AS STRING) AS certification_code, p_name AS certification_name,
 CAST(DATE '1996-01-01' + CAST(p_partkey % 1500 AS INT) AS STRING) AS issued_date,
 CAST(DATE '2000-06-01' + CAST(p_partkey % 1500 AS INT) AS STRING) AS expiry_date,
 p_brand AS issuing_body,
 CASE WHEN p_partkey % 5 = 0 THEN 'EXPIRED' WHEN p_partkey % 13 = 0 THEN 'Pending Renewal' ELSE 'ACTIVE' END AS cert_status,
 TIMESTAMP '2001-06-30 12:00:00' AS _extract_timestamp, 'BATCH-B' AS _batch_id
FROM {part}
"""

# One warehouse per nation, but for one region.
WAREHOUSES = """
SELECT 'WH-' || CAST(n_nationkey AS STRING) AS warehouse_code FROM {nation} WHERE n_regionkey <> 2
"""

# view name -> (text, source table)
VIEWS = {
    "warehouses": (WAREHOUSES, "nation"),
    "raw_customers": (RAW_CUSTOMERS, "customer"),
    "raw_technicians": (RAW_TECHNICIANS, "supplier"),
    "raw_work_orders": (RAW_WORK_ORDERS, "orders"),
    "raw_invoices": (RAW_INVOICES, "orders"),
    "raw_assignments": (RAW_ASSIGNMENTS, "lineitem"),
    "raw_parts": (RAW_PARTS, "lineitem"),
    "raw_certs": (RAW_CERTS, "part"),
    "raw_customers_batch2": (RAW_CUSTOMERS_BATCH2, "customer"),
    "raw_technicians_batch2": (RAW_TECHNICIANS_BATCH2, "supplier"),
    "raw_work_orders_batch2": (RAW_WORK_ORDERS_BATCH2, "orders"),
    "raw_invoices_batch2": (RAW_INVOICES_BATCH2, "orders"),
    "raw_assignments_batch2": (RAW_ASSIGNMENTS_BATCH2, "lineitem"),
    "raw_certs_batch2": (RAW_CERTS_BATCH2, "part"),
}
