"""Named queries: every operator over the tables of one directory."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import domains as d
from .functions import standardize as std
from .functions.columns import day, instant, lower_trim, named, number, upper_trim
from .operators import dedup, listings, scoring
from .operators import quarantine as q
from .operators.catalog import BY_KEY, LATE, RULES, credit_unparsed, is_value, negative
from .operators.evaluate import (
    RESULT_COLUMNS,
    evaluate,
    evaluate_days,
    evaluate_isolated,
    failing_keys,
    row_rule_counts,
    rule_counts,
    rules_for_table,
    violating_rows,
    with_outcome,
)
from .operators.extended import (
    CITY,
    EXTENDED_RULES,
    GROUPS,
    PAIR_LISTINGS,
    REGION_OF,
    SPREAD,
    STATE_OF,
    group_rules,
    learnt_places,
    spans,
)
from .operators.external import evaluate_external
from .operators.incremental import IncrementalSuite
from .operators.key_index import KeyIndex
from .operators.keys import surrogate_key
from .operators.lookups import LookupRule, WithLookups, known_values, lookup_violations
from .operators.rules import FrameRule, KeyRule, PairRule, RowRule
from .operators.scd2 import merge_into
from .plans import curation as cur
from .plans import monitoring as mon
from .plans import staging as stg
from .plans.staging import Load
from .sources import files, sinks
from .sources.schemas import raw_schema
from .sources.tables import Raw, as_text, dirty_view, read_table, scratch_path, stamp_batch
from .sources.versions import VersionedTable

AS_OF = dt.date(2001, 7, 1)
LOADED = dt.datetime(2001, 7, 1, 6, 0, 0)
RUN_ID = "RUN-20010701"
LOAD = Load(AS_OF, LOADED, "BATCH-20010701")
SCRIPT_MONEY = "decimal(12,2)"
SCRIPT_LOAD = replace(LOAD, book=q.SCRIPT, batch_id=None, money=SCRIPT_MONEY)
MERGE_DAY = dt.date(2001, 7, 2)
FIRST_BATCH = "BATCH-1"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
c = F.col


def query(name: str):
    def register(build: Callable[[Raw], DataFrame]):
        def run(spark: SparkSession, directory: str) -> DataFrame:
            # dirty text holds wall clock times; the zone only matters for how they are shown
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(Raw(spark, directory))

        QUERIES[name] = run
        return build

    return register


def results(raw: Raw, rules=RULES) -> DataFrame:
    return evaluate(raw, rules, AS_OF)


# -- sources and sinks ------------------------------------------------------


@query("src_table")
def _(raw):
    return read_table(raw.spark, "customer", raw.directory)


@query("src_literal_rows")
def _(raw):
    """Source rows as text, stamped with extract time and batch."""
    return stamp_batch(as_text(read_table(raw.spark, "supplier", raw.directory)), LOADED, "BATCH-1")


@query("src_insert_values")
def _(raw):
    """A load that names its columns; those it leaves out take their default, null."""
    rows = raw["technicians"].select("technician_id", "employee_number", "full_name", "employment_status")
    return stamp_batch(rows, LOADED, "BATCH-1").to(raw_schema("technicians"))


@query("src_explicit_string_schema")
def _(raw):
    """An extract brought to its declared schema of text columns, in the declared order."""
    return raw["technicians"].to(raw_schema("technicians"))


def text_extract(raw) -> DataFrame:
    """Suppliers as text lines, of which some are cut, some run on and some have a stray quote, read back."""
    columns = ["supplier_id", "supplier_name", "phone"]
    supplier = read_table(raw.spark, "supplier", raw.directory)
    row = F.struct(c("s_suppkey").cast("string"), F.concat("s_name", F.lit(', "Ltd"')), F.when(c("s_suppkey") % 11 > 0, c("s_nationkey").cast("string")))
    line = F.to_csv(row, {"escape": '"'})
    broken = (
        F.when(c("s_suppkey") % 7 == 0, F.concat(c("s_suppkey").cast("string"), F.lit(",cut")))
        .when(c("s_suppkey") % 7 == 1, F.concat(line, F.lit(",more")))
        .when(c("s_suppkey") % 7 == 2, F.concat(c("s_suppkey").cast("string"), F.lit(',"open,1')))
        .otherwise(line)
    )
    path = scratch_path(raw.spark, "extract")
    supplier.select(broken.alias("value")).write.text(path)
    return files.read_extract(raw.spark, path, columns)


@query("src_text_files")
def _(raw):
    """The rows of an extract of text files."""
    return files.rows(text_extract(raw)).drop(files.FILE)


@query("src_text_files_rejected")
def _(raw):
    """The lines of the extract that are no rows."""
    return files.rejected(text_extract(raw)).drop(files.FILE)


@query("sink_overwrite")
def _(raw):
    path = scratch_path(raw.spark, "overwrite")
    sinks.overwrite(raw["technicians"].select("technician_id", "employee_number"), path)
    return sinks.overwrite(raw["technicians"].select("technician_id", "full_name"), path)


@query("sink_truncate_insert")
def _(raw):
    path = scratch_path(raw.spark, "truncate")
    first = raw["invoices"].select("invoice_id", "invoice_status")
    sinks.overwrite(first, path)
    return sinks.overwrite(first.filter(c("invoice_status").isNotNull()), path)


@query("sink_append_batch")
def _(raw):
    path = scratch_path(raw.spark, "append")
    columns = ["customer_id", "customer_name", "_batch_id"]
    sinks.append(raw["customers"].select(*columns), path)
    return sinks.append(raw["customers_batch2"].select(*columns), path)


@query("sink_append_results")
def _(raw):
    """Two runs, the second of which is corrected: its first results are replaced."""
    path = scratch_path(raw.spark, "results")
    runs = (("RUN-1", AS_OF), ("RUN-2", AS_OF), ("RUN-2", MERGE_DAY))
    evaluated = evaluate_days(raw, RULES, [as_of for _, as_of in runs], scratch_path(raw.spark, "counts"))
    for run_id, as_of in runs:
        table = sinks.replace_run(scoring.result_rows(evaluated[as_of], run_id, LOADED), path)
    return table


@query("sink_insert_if_absent")
def _(raw):
    """Days of the invoices first, then the due dates not there yet."""
    path = scratch_path(raw.spark, "absent")

    def days(column: str) -> DataFrame:
        found = raw["invoices"].selectExpr(f"{day(column)} AS full_date").filter("full_date IS NOT NULL").distinct()
        return found.selectExpr(f"{cur.date_key('full_date')} AS date_sk", "full_date")

    sinks.overwrite(days("invoice_date"), path)
    return sinks.insert_if_absent(days("due_date"), path, ["date_sk"])


@query("sink_csv_export")
def _(raw):
    rows = evaluate_external(raw, AS_OF).select(
        "rule_code", "dq_dimension", "target_table", "severity", "total_records", "failed_records", "status"
    )
    return sinks.export_csv(rows, scratch_path(raw.spark, "csv"))


@query("table_row_counts")
def _(raw):
    names = ("customers", "technicians", "work_orders", "invoices", "assignments", "parts", "certs")
    return sinks.row_counts({name: raw[name] for name in names})


# -- rules ------------------------------------------------------------------


def _rule_query(rule):
    @query(rule.key)
    def _(raw):
        return results(raw, [rule]).select(*RESULT_COLUMNS)

    @query(f"violations_{rule.key}")
    def _(raw):
        return listings.violations(raw, rule.key, AS_OF)


for _rule in RULES:
    _rule_query(_rule)

query("c_006_sql")(listings.invoices_without_contact)
query("u_002_pairs")(listings.shared_email_pairs)
query("v_005_sql")(listings.loose_email_rows)


def extended_frames(raw) -> WithLookups:
    """All extracts, and the references they are held against: places learnt from all customers, the managers that the
    first extract names, and the list of warehouses."""
    return WithLookups(
        raw.with_later_batches(),
        {
            "cities": lambda frames: learnt_places(frames, CITY, STATE_OF),
            "states": lambda frames: learnt_places(frames, STATE_OF, REGION_OF),
            "managers": lambda frames: known_values(raw["technicians"], "manager_id"),
            "warehouses": lambda frames: known_values(dirty_view(raw.spark, raw.directory, "warehouses"), "warehouse_code"),
        },
    )


def _group_query(group):
    @query(group)
    def _(raw):
        return results(extended_frames(raw), group_rules(group)).select(*RESULT_COLUMNS)


def _extended_listing(rule):
    @query("violations_" + rule.key)
    def _(raw):
        frames = extended_frames(raw)
        if isinstance(rule, LookupRule):
            return lookup_violations(frames, rule)
        if isinstance(rule, KeyRule):
            return failing_keys(frames, rule, AS_OF)
        if isinstance(rule, (PairRule, FrameRule)):
            return PAIR_LISTINGS[rule.key](frames)
        return violating_rows(frames[rule.table], rule, AS_OF)


for _group in GROUPS:
    _group_query(_group)
for _rule in EXTENDED_RULES:
    _extended_listing(_rule)


@query("x_cross_batch_indexed")
def _(raw):
    """Customers extracted again: the keys of the second extract meet those of the first in a key index."""
    values = {"records": "sum", "first_seen": "min", "last_seen": "max"}
    index = KeyIndex(raw.spark, scratch_path(raw.spark, "key-index"), ["customer_id"], values, buckets=8)
    for table in ("customers", "customers_batch2"):
        index.add(spans(raw[table], "customer_id", "_batch_id"), table)
    return index.read().filter(SPREAD).select("customer_id", *values)


@query("learnt_cities")
def _(raw):
    """The places that the rules on cities hold customers against."""
    return extended_frames(raw)["cities"]


@query("learnt_states")
def _(raw):
    return extended_frames(raw)["states"]


@query("v_004_decimal")
def _(raw):
    """Amounts parsed as DECIMAL(12,2): what does not fit counts as unparseable."""
    return violating_rows(raw["customers_batch2"], credit_unparsed(SCRIPT_MONEY), AS_OF)


@query("cs_006_sql")
def _(raw):
    """Only the flag Y counts as met."""
    only_y = replace(BY_KEY["cs_006"], fails=f"{is_value('sla_met', 'Y')} AND {LATE}")
    return violating_rows(raw["work_orders"], only_y, AS_OF)


# -- evaluation, scores and reports -----------------------------------------


@query("rule_result")
def _(raw):
    return results(raw).select(*RESULT_COLUMNS, "details")


@query("rule_pass_rate_sql")
def _(raw):
    counts = row_rule_counts(raw["customers"], [BY_KEY["c_001"]], AS_OF)
    rate = "100.0D * (1 - failed_records / nullif(total_records, 0))"
    return counts.selectExpr(
        "rule_code",
        "severity",
        "dq_dimension",
        "target_table",
        "'customer_name' AS target_column",
        "total_records",
        "failed_records",
        f"CAST(CAST({rate} AS decimal(5,2)) AS double) AS pass_rate_pct",
    )


@query("rule_suite_by_table")
def _(raw):
    """Every rule: row rules in one pass per table and batch, key and pair rules over the extract."""
    parts = []
    for table in ("customers", "technicians", "work_orders", "invoices", "assignments"):
        rules = [r for r in RULES if isinstance(r, RowRule) and r.table == table]
        parts.append(with_outcome(row_rule_counts(raw[table], rules, AS_OF, ["_batch_id"])))
    others = evaluate(raw, [r for r in RULES if not isinstance(r, RowRule)], AS_OF)
    parts.append(others.withColumn("_batch_id", F.lit(FIRST_BATCH)).select(*parts[0].columns))
    return reduce(DataFrame.unionAll, parts).select("_batch_id", *RESULT_COLUMNS)


@query("rule_suite_incremental")
def _(raw):
    """Every rule over both extracts, each of which is scanned when it comes."""
    tables = ("customers", "technicians", "work_orders", "invoices", "assignments")
    suite = IncrementalSuite(raw.spark, scratch_path(raw.spark, "suite"), RULES, buckets=8)
    suite.add(raw, "first", AS_OF)
    suite.add({t: raw[f"{t}_batch2"] for t in tables}, "second", AS_OF)
    return suite.evaluate(AS_OF, raw.with_later_batches()).select(*RESULT_COLUMNS)


@query("rule_filter_table")
def _(raw):
    return results(raw, rules_for_table(RULES, "invoices")).select(*RESULT_COLUMNS)


@query("rule_error_isolation")
def _(raw):
    """The suite with a rule that cannot be bound and one that fails while it runs."""
    broken = [
        replace(BY_KEY["v_016"], code="V-016B", fails="no_such_column IS NULL"),
        replace(BY_KEY["v_016"], code="V-016R", fails="raise_error(coalesce(customer_id, 'none')) IS NULL"),
    ]
    return evaluate_isolated(raw, [*RULES, *broken], AS_OF).select(*RESULT_COLUMNS)


@query("dq_score_overall")
def _(raw):
    return scoring.overall(results(raw))


@query("dq_score_by_dimension")
def _(raw):
    return scoring.by_dimension(results(raw))


@query("dq_score_external")
def _(raw):
    return scoring.with_overall(evaluate_external(raw, AS_OF), digits=1)


@query("rule_result_external")
def _(raw):
    return evaluate_external(raw, AS_OF).select(*RESULT_COLUMNS)


@query("dq_grade")
def _(raw):
    return scoring.graded(results(raw))


@query("dq_severity_counts")
def _(raw):
    return scoring.severity_counts(results(raw))


@query("dq_score_summary_row")
def _(raw):
    return scoring.summary_row(results(raw), RUN_ID, AS_OF)


@query("dq_failed_checks")
def _(raw):
    return scoring.failed_checks(results(raw))


def _stored_runs(raw, days: int) -> DataFrame:
    """The summaries of several runs, as the runs left them in one table."""
    path = scratch_path(raw.spark, "dq_score_summary")
    runs = [AS_OF - dt.timedelta(days=30 * back) for back in range(days)]
    evaluated = evaluate_days(raw, RULES, runs, scratch_path(raw.spark, "counts"))
    for as_of in runs:
        summary = scoring.summary_row(evaluated[as_of], f"RUN-{as_of}", as_of)
        table = sinks.replace_run(summary, path)
    return table


@query("dq_score_history")
def _(raw):
    return scoring.history(_stored_runs(raw, 6))


@query("dq_aggregate_by_table")
def _(raw):
    """The summed form over six counts, with that report's own spelling and severities."""
    null_name = replace(BY_KEY["c_001"], dimension="COMPLETENESS", fails="customer_name IS NULL")
    suite = [
        null_name,
        replace(BY_KEY["c_002"], dimension="COMPLETENESS", severity="HIGH"),
        replace(BY_KEY["u_001"], dimension="UNIQUENESS"),
        replace(BY_KEY["u_003"], dimension="UNIQUENESS"),
        replace(BY_KEY["v_001"], dimension="VALIDITY"),
        replace(BY_KEY["v_006"], dimension="VALIDITY", fails=negative("labor_cost", "parts_cost")),
    ]
    return scoring.by_table(rule_counts(raw, suite, AS_OF))


@query("dq_results_table")
def _(raw):
    rows = scoring.result_rows(results(raw), RUN_ID, LOADED)
    return sinks.append(rows, scratch_path(raw.spark, "dq_results"))


@query("dq_score_summary_table")
def _(raw):
    return _stored_runs(raw, 2)


# -- deduplication ----------------------------------------------------------


@query("dedup_rank_email")
def _(raw):
    return dedup.rank_by_email(raw["customers"])


@query("dedup_rank_id")
def _(raw):
    return dedup.rank_by_id(raw["customers"])


@query("dedup_flag")
def _(raw):
    return dedup.with_duplicate_flags(raw["customers"]).select(
        "_src_row", "customer_id", "is_email_duplicate", "is_id_duplicate", "is_duplicate"
    )


@query("dedup_flag_null_distinct")
def _(raw):
    return dedup.with_duplicate_flags(raw["customers"], null_keys_are_distinct=True).select(
        "_src_row", "customer_id", "is_email_duplicate", "is_id_duplicate", "is_duplicate"
    )


@query("dedup_reason")
def _(raw):
    return dedup.with_duplicate_flags(raw["customers"]).selectExpr(
        "_src_row", "customer_id", f"{dedup.DUPLICATE_REASON} AS dup_reason"
    )


@query("dedup_master_key")
def _(raw):
    flagged = dedup.with_duplicate_flags(raw["customers"])
    return dedup.with_master_key(flagged, raw["customers"]).select(
        "_src_row", "customer_id", "is_duplicate", "duplicate_of_key"
    )


@query("dedup_keep_latest")
def _(raw):
    return dedup.keep_latest(raw["work_orders"], ["work_order_id"], dedup.extract_order()).select(
        "work_order_id", "work_order_number", "_extract_timestamp", "_src_row"
    )


@query("dedup_keep_latest_technicians")
def _(raw):
    return dedup.keep_latest(raw["technicians"], ["technician_id"], dedup.extract_order()).select(
        "technician_id", "full_name", "_src_row"
    )


@query("distinct_keys")
def _(raw):
    return dedup.distinct_keys(raw["work_orders"], "work_order_id")


# -- standardisation --------------------------------------------------------


def projection(name: str, table: str, **columns: str) -> None:
    """A query that shows raw rows next to expressions over them."""
    query(name)(lambda raw: raw[table].selectExpr("_src_row", *named(columns)))


projection(
    "std_customer_status", "customers", account_status="account_status", status_std=std.customer_status(),
    status_without_typos=std.customer_status(known_typos=False), status_or_raw=std.customer_status(keep_raw=True),
)
projection("std_customer_type", "customers", customer_type="customer_type", type_std=std.customer_type())
projection("std_wo_status", "work_orders", status="status", status_std=std.work_order_status())
projection("std_wo_type", "work_orders", work_order_type="work_order_type", type_std=std.work_order_type())
projection("std_priority", "work_orders", priority_std=std.priority(), priority_checked=std.priority(checked=True))
projection("std_bool_text", "work_orders", sla_met="sla_met", sla_met_std=std.bool_text("sla_met"))
projection(
    "std_tech_status", "technicians", employment_status="employment_status", status_std=std.technician_status()
)
projection(
    "coerce_number", "customers_batch2", as_double=number("credit_limit"),
    as_decimal=f"CAST({number('credit_limit', 'decimal(12,2)')} AS double)",
)
projection("coerce_date", "customers", created_date_d=day("created_date"))
projection("coerce_timestamp", "customers", last_modified_ts=instant("last_modified"))
projection(
    "clean_text", "customers",
    customer_name="trim(customer_name)",
    email_address=lower_trim("email_address"),
    billing_city="trim(billing_city)",
    billing_state=upper_trim("billing_state"),
    billing_zip=std.zip5(),
    region_code=upper_trim("region_code"),
)
projection("repair_null_inverted_end", "work_orders", actual_end=std.end_not_before("actual_start", "actual_end"))
projection(
    "repair_null_out_of_range", "work_orders",
    actual_hours=std.in_range("actual_hours", 0, d.MAX_HOURS),
    labor_cost=std.in_range("labor_cost", 0),
    parts_cost=std.in_range("parts_cost", 0),
    total_cost=std.in_range("total_cost", 0),
)
projection("repair_null_rate", "technicians", hourly_rate=std.in_range("hourly_rate", 0, d.MAX_RATE))
projection("derive_full_name", "technicians", full_name=std.full_name())


@query("ref_flag")
def _(raw):
    checked = stg.with_parent_flag(raw["work_orders"], raw["customers"], "customer_id", "ref_integrity_ok")
    return checked.select("_src_row", "customer_id", "ref_integrity_ok")


@query("add_load_metadata")
def _(raw):
    return raw["technicians"].selectExpr("technician_id", *named(LOAD.metadata))


def staged_customers(raw, load=LOAD):
    return stg.stage_customers(raw["customers"], load)


def staged_orders(raw, load=LOAD):
    return stg.stage_work_orders(raw["work_orders"], raw["customers"], load)


def staged_technicians(raw):
    return stg.stage_technicians(raw["technicians"], LOAD)


def staged_invoices(raw):
    return stg.stage_invoices(raw["invoices"], raw["work_orders"], raw["customers"], LOAD)


query("stage_customers")(staged_customers)
query("stage_customers_sql")(lambda raw: decimals_shown(staged_customers(raw, SCRIPT_LOAD)))
query("stage_work_orders")(staged_orders)
query("stage_work_orders_sql")(lambda raw: decimals_shown(staged_orders(raw, SCRIPT_LOAD)))
query("stage_work_orders_three_valued")(lambda raw: staged_orders(raw, replace(LOAD, three_valued=True)))
query("stage_technicians")(staged_technicians)
query("stage_invoices")(staged_invoices)


# -- quarantine -------------------------------------------------------------


def decimals_shown(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for a listing."""
    return df.select(*[c(n).cast("double").alias(n) if t.startswith("decimal") else c(n) for n, t in df.dtypes])


def customer_flags(raw, book=q.NOTEBOOK):
    money = SCRIPT_MONEY if book == q.SCRIPT else "double"
    return q.with_flags(raw["customers"], q.customer_flags(book, money), AS_OF)


def _customer_book(suffix, book):
    @query("quarantine_flags_customers" + suffix)
    def _(raw):
        gate = f"{q.customer_gate(book)} AS should_quarantine"
        return customer_flags(raw, book).selectExpr("_src_row", *q.customer_flags(), gate)

    @query("record_score_customers" + suffix)
    def _(raw):
        return customer_flags(raw, book).selectExpr("_src_row", f"{q.customer_score(book)} AS dq_score")


_customer_book("", q.NOTEBOOK)
_customer_book("_sql", q.SCRIPT)


def order_flags(raw):
    return stg.flagged_work_orders(raw["work_orders"], raw["customers"], LOAD)


@query("quarantine_flags_work_orders")
def _(raw):
    gate = f"{q.WORK_ORDER_GATE} AS should_quarantine"
    return order_flags(raw).selectExpr("work_order_id", *q.work_order_flags(), gate)


@query("quarantine_flags_technicians")
def _(raw):
    gate = f"{q.TECHNICIAN_GATE} AS should_quarantine"
    return stg.flagged_technicians(raw["technicians"], LOAD).selectExpr("technician_id", *q.technician_flags(), gate)


@query("quarantine_reason")
def _(raw):
    """Reasons of all three staged tables, one below the other."""
    tables = {
        "customers": (stg.flagged_customers(raw["customers"], LOAD), q.customer_reason()),
        "work_orders": (order_flags(raw), q.work_order_reason()),
        "technicians": (stg.flagged_technicians(raw["technicians"], LOAD), q.TECHNICIAN_REASON),
    }
    parts = [
        df.selectExpr(f"'{name}' AS table_name", "_src_row AS source_row", f"{reason} AS quarantine_reason")
        for name, (df, reason) in tables.items()
    ]
    return reduce(DataFrame.unionAll, parts)


@query("record_score_work_orders")
def _(raw):
    return order_flags(raw).selectExpr("work_order_id", f"{q.work_order_score()} AS dq_score")


@query("record_score_technicians")
def _(raw):
    flagged = stg.flagged_technicians(raw["technicians"], LOAD)
    return flagged.selectExpr("technician_id", f"{q.TECHNICIAN_SCORE} AS dq_score")


def customer_log(raw, load=LOAD):
    staged = staged_customers(raw, load)
    return q.quarantine_log(staged, "raw.customers", "customer_id", RUN_ID, LOADED, load.book)


query("quarantine_log")(customer_log)
query("quarantine_log_sql")(lambda raw: customer_log(raw, SCRIPT_LOAD))


@query("quarantine_counts")
def _(raw):
    return q.quarantine_counts(
        {
            "stg.customers": staged_customers(raw),
            "stg.work_orders": staged_orders(raw),
            "stg.technicians": staged_technicians(raw),
        }
    )


@query("quarantine_resolution")
def _(raw):
    """Keys the second extract brings again count as released."""
    released = raw["customers_batch2"].select(
        F.lit("raw.customers").alias("source_table"), c("customer_id").alias("source_key")
    )
    return q.resolve(customer_log(raw), released, LOADED, "steward").select(
        "source_table", "source_key", "quarantine_reason", "resolved_flag", "resolved_date", "resolved_by"
    )


# -- curation ---------------------------------------------------------------


def calendar(raw) -> DataFrame:
    """The years the orders and invoices fall in."""
    days = raw["work_orders"].selectExpr(f"{day('scheduled_date')} AS a", f"CAST({instant('actual_end')} AS date) AS b")
    days = days.unionAll(raw["invoices"].selectExpr(day("invoice_date"), day("due_date")))
    return cur.days_covering(days, "a", "b")


def customers_dim(raw, load=LOAD):
    return cur.dim_customer(staged_customers(raw, load), LOADED)


query("dim_date")(lambda raw: cur.dim_date(calendar(raw)))
query("dim_date_sql")(lambda raw: cur.dim_date(calendar(raw), cur.SUNDAY_WEEK, fiscal=False))
query("dim_customer")(customers_dim)
query("dim_technician")(lambda raw: cur.dim_technician(staged_technicians(raw), LOADED))


@query("surrogate_key")
def _(raw):
    keys = dedup.distinct_keys(raw["work_orders"], "work_order_id")
    return surrogate_key(keys, ["work_order_id"], "work_order_sk")


@query("scd2_merge")
def _(raw):
    """The second extract, one row per customer, merged into the stored dimension of the first."""
    shown = ["customer_id", "customer_name", "customer_type", "account_status", "region_code", "credit_limit"]
    columns = stg.clean_customer(LOAD)
    second = raw["customers_batch2"].selectExpr(*named({n: columns[n] for n in (*shown, "last_modified")}))
    incoming = dedup.keep_latest(second, ["customer_id"], [c("last_modified").desc(), c("customer_name").asc()])
    table = VersionedTable(raw.spark, scratch_path(raw.spark, "dim_customer"))
    first = customers_dim(raw).select("customer_sk", *shown, "effective_from", "effective_to", "is_current")
    table.write_buckets(first, ["customer_id"], buckets=8)
    return merge_into(table, incoming.select(*shown), "customer_id", shown[1:], MERGE_DAY, "customer_sk")


def orders_fact(raw):
    return cur.fact_work_orders(staged_orders(raw), customers_dim(raw), cur.dim_date(calendar(raw)), LOADED)


query("fact_work_orders")(orders_fact)


@query("fact_work_orders_sql")
def _(raw):
    return decimals_shown(
        cur.fact_work_orders_by_format(staged_orders(raw, SCRIPT_LOAD), customers_dim(raw, SCRIPT_LOAD), LOADED)
    )


@query("fact_invoices")
def _(raw):
    return cur.fact_invoices(staged_invoices(raw), customers_dim(raw), cur.dim_date(calendar(raw)), LOADED)


# -- monitoring -------------------------------------------------------------


@query("before_after_report")
def _(raw):
    return mon.before_after(mon.layers(raw, staged_customers(raw), staged_orders(raw), AS_OF))


@query("before_after_sql")
def _(raw):
    return mon.before_after_customers(mon.customer_layers(raw, staged_customers(raw, SCRIPT_LOAD), AS_OF))


@query("pct_share")
def _(raw):
    counts = q.quarantine_counts({"stg.customers": staged_customers(raw), "stg.work_orders": staged_orders(raw)})
    return counts.selectExpr("table_name", f"{mon.pct_share('quarantined', 'total')} AS quarantined_pct")


@query("pipeline_run_log")
def _(raw):
    parts = [mon.records(raw[name], extracted="count(1)") for name in ("customers", "work_orders")]
    for staged, curated in (
        (staged_customers(raw), mon.CURATED_CUSTOMERS),
        (staged_orders(raw), mon.CURATED_WORK_ORDERS),
    ):
        parts.append(mon.records(staged, staged="count(1)", quarantined=mon.HELD, curated=curated))
    return mon.pipeline_run(RUN_ID, "dq_pipeline", LOADED, LOADED, parts)
