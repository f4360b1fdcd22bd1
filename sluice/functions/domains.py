"""Allowed domains, synonyms, severities and thresholds."""

from __future__ import annotations

CUSTOMER_STATUS = ("ACTIVE", "INACTIVE", "SUSPENDED", "PENDING")
CUSTOMER_TYPE = ("ENTERPRISE", "GOVERNMENT", "SMB")
WORK_ORDER_TYPE = (
    "PREVENTIVE_MAINTENANCE",
    "CORRECTIVE_MAINTENANCE",
    "INSPECTION",
    "EMERGENCY_REPAIR",
    "INSTALLATION",
)
WORK_ORDER_STATUS = ("SCHEDULED", "IN_PROGRESS", "COMPLETED", "CANCELLED", "ON_HOLD")
COMPLETED = ("COMPLETED", "COMPLETE")
CLOSED = ("COMPLETED", "COMPLETE", "CANCELLED")
PRIORITY = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
TECHNICIAN_STATUS = ("ACTIVE", "TERMINATED", "ON_LEAVE", "SUSPENDED")
INVOICE_STATUS = ("DRAFT", "SENT", "PAID", "OVERDUE", "CANCELLED", "VOID")
ASSIGNMENT_ROLE = ("LEAD", "SUPPORT", "SOLO")
ASSIGNMENT_STATUS = ("SCHEDULED", "ACTIVE", "COMPLETED", "CANCELLED")
REGION = ("NE", "SE", "SW", "NW", "MW", "CW")
SKILL_LEVEL = ("JUNIOR", "MID", "SENIOR")
CERT_STATUS = ("ACTIVE", "EXPIRED")
PERSONAL_MAIL = ("gmail.com", "yahoo.com")

# standard value -> accepted spellings
CUSTOMER_STATUS_SYNONYMS = {
    "ACTIVE": ("ACTIVE", "ACTIV"),
    "INACTIVE": ("INACTIVE", "INACT"),
    "SUSPENDED": ("SUSPENDED", "TEMP SUSPEND"),
    "PENDING": ("PENDING",),
}
CUSTOMER_TYPE_SYNONYMS = {
    "ENTERPRISE": ("ENTERPRISE", "ENTERP"),
    "GOVERNMENT": ("GOVERNMENT", "GOVT", "GOV"),
    "SMB": ("SMB",),
}
WORK_ORDER_STATUS_SYNONYMS = {
    "SCHEDULED": ("SCHEDULED",),
    "IN_PROGRESS": ("IN_PROGRESS",),
    "COMPLETED": ("COMPLETED", "COMPLETE"),
    "CANCELLED": ("CANCELLED",),
    "ON_HOLD": ("ON_HOLD",),
}
TECHNICIAN_STATUS_SYNONYMS = {
    "ACTIVE": ("ACTIVE", "ACTVE"),
    "TERMINATED": ("TERMINATED",),
    "ON_LEAVE": ("ON_LEAVE", "ON-LEAVE"),
    "SUSPENDED": ("SUSPENDED",),
}
TRUE_TEXT = ("Y", "YES", "1", "TRUE")
FALSE_TEXT = ("N", "NO", "0", "FALSE")

DIMENSIONS = (
    "Completeness",
    "Uniqueness",
    "Validity",
    "Referential Integrity",
    "Consistency",
    "Timeliness",
    "Business Rules",
)
SEVERITY_WEIGHT = {"CRITICAL": 30, "HIGH": 20, "MEDIUM": 10, "LOW": 5}
DEFAULT_WEIGHT = 5
GRADES = (("A", 90), ("B", 75), ("C", 60), ("D", 50))

LATIN1_PATTERN = r"^[\x00-\xFF]*[\x80-\xFF][\x00-\xFF]*$"
INVISIBLE_PATTERN = "[\u200b-\u200d\ufeff]"
CURRENCY_PATTERN = r"^(\$|USD)([0-9.]+)$"
RANGE_PATTERN = r"^[0-9.]+-[0-9.]+$"
SCIENTIFIC_PATTERN = r"^[0-9.]+[eE][0-9]+$"
DIGITS_PATTERN = "^[0-9]+$"
PLACEHOLDER_MAIL = "test@test.com"
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
CENT = 0.01
MAX_HOURS = 24
MAX_RATE = 500
STALE_CUSTOMER_DAYS = 730
STALE_WORK_DAYS = 90
LATE_ASSIGNMENT_DAYS = 30
LONG_SHIFT_HOURS = 12
HUGE_CREDIT = 1_000_000_000
