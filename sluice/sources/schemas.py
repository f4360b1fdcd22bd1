"""Columns of the raw tables; every one of them is text.

Fixed values, in the order of the source extracts.
"""

from __future__ import annotations

from pyspark.sql import types as T

from .tables import text_schema

RAW_COLUMNS = {
    "customers": (
        "customer_id", "customer_name", "customer_type", "account_status", "credit_limit", "primary_contact",
        "email_address", "phone_number", "billing_city", "billing_state", "billing_zip", "region_code",
        "created_date", "last_modified", "created_by", "source_system",
    ),
    "sites": (
        "site_id", "customer_id", "site_name", "site_type", "service_address", "city", "state", "zip_code",
        "latitude", "longitude", "site_status", "priority_tier", "territory_code", "created_date",
        "last_modified", "created_by",
    ),
    "technicians": (
        "technician_id", "employee_number", "first_name", "last_name", "full_name", "employment_status",
        "skill_level", "home_region", "hire_date", "termination_date", "hourly_rate", "manager_id", "email",
        "mobile_phone", "created_date", "last_modified",
    ),
    "technician_certifications": (
        "cert_id", "technician_id", "certification_code", "certification_name", "issued_date", "expiry_date",
        "issuing_body", "cert_status",
    ),
    "work_orders": (
        "work_order_id", "work_order_number", "site_id", "customer_id", "work_order_type", "priority", "status",
        "description", "scheduled_date", "scheduled_start", "scheduled_end", "actual_start", "actual_end",
        "estimated_hours", "actual_hours", "labor_cost", "parts_cost", "total_cost", "sla_due_date", "sla_met",
        "resolution_code", "notes", "created_date", "last_modified", "created_by", "source_system",
    ),
    "work_order_assignments": (
        "assignment_id", "work_order_id", "technician_id", "assignment_role", "assigned_date", "start_time",
        "end_time", "hours_logged", "assignment_status", "notes",
    ),
    "work_order_parts": (
        "part_usage_id", "work_order_id", "part_number", "part_description", "quantity_used", "unit_cost",
        "total_cost", "warehouse_code", "recorded_by", "recorded_date",
    ),
    "invoices": (
        "invoice_id", "invoice_number", "work_order_id", "customer_id", "invoice_date", "due_date",
        "invoice_status", "subtotal", "tax_amount", "discount_amount", "total_amount", "payment_terms",
        "payment_received", "payment_date", "created_date", "last_modified", "created_by",
    ),
    "invoice_line_items": (
        "line_item_id", "invoice_id", "line_type", "description", "quantity", "unit_price", "line_total",
        "tax_code",
    ),
}


def raw_schema(table: str) -> T.StructType:
    return text_schema(RAW_COLUMNS[table])
