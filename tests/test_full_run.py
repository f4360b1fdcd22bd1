"""The full run, run twice and the second one repeated, and the incremental load."""

import datetime as dt

import pytest

from sluice.operators import quarantine
from sluice.plans import full_run
from sluice.plans.staging import Load
from sluice.queries import QUERIES
from sluice.sources import sinks
from sluice.streaming.incremental import append_new_files

AS_OF = dt.date(2001, 7, 1)
LOAD = Load(AS_OF, dt.datetime(2001, 7, 1, 6), "BATCH-20010701")


@pytest.fixture(scope="module")
def runs(spark, raw, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    out = [full_run.run(raw, root, LOAD, f"RUN-{i}", dt.datetime(2001, 7, 1, 7)) for i in (1, 2, 2)]
    return root, (out[0], out[2])


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_full_refresh_is_idempotent(runs, spark, data):
    _, (first, second) = runs
    for table in ("dim_customer", "fact_work_orders", "fact_invoices", "dim_technician"):
        assert second[table].count() == QUERIES[table](spark, data).count()
    keys = second["fact_work_orders"].select("work_order_id")
    assert keys.count() == keys.distinct().count()


def test_written_layers_match_the_queries(runs, spark, data):
    _, (_, second) = runs
    expected = QUERIES["before_after_report"](spark, data)
    assert rows(second["before_after"].select(*expected.columns)) == rows(expected)


def test_logs_grow_by_run(runs, spark, data):
    root, (_, second) = runs
    assert second["pipeline_runs"].count() == 2
    assert second["dq_score_summary"].count() == 2
    assert spark.read.parquet(f"{root}/dq/dq_results").count() == 2 * 62
    assert second["quarantine_log"].count() == 2 * QUERIES["quarantine_log"](spark, data).count()


def test_counts_add_up(runs, spark):
    root, (_, second) = runs
    audit = second["pipeline_runs"].filter("run_id = 'RUN-2'").first()
    staged = [sinks.read(spark, f"{root}/stg/{t}") for t in ("customers", "work_orders")]
    held = sum(df.filter("is_quarantined").count() for df in staged)
    assert audit.records_staged == sum(df.count() for df in staged)
    assert audit.records_quarantined == held
    # every clean work order becomes a fact, every clean first customer a dimension row
    assert audit.records_curated == audit.records_staged - held
    for df in staged:
        assert df.filter("dq_score < 0 OR dq_score > 100").count() == 0


def test_observed_counts_equal_counted_ones(runs, spark):
    """Duplicates among clean rows are counted per key here; the run took them from the rows' flags."""
    root, (_, second) = runs
    report = {r.metric: r for r in second["before_after"].collect()}
    customers = sinks.read(spark, f"{root}/stg/customers").filter("NOT is_quarantined")
    again = customers.groupBy("customer_id").count().selectExpr("coalesce(sum(count - 1), 0)").first()[0]
    assert report["Customers — Duplicate IDs"].staging == again
    assert report["Customers — NULL name"].staging == customers.filter("customer_name IS NULL").count()
    assert report["Total customer records"].curated == second["dim_customer"].filter("is_current").count()
    counted = quarantine.quarantine_counts(
        {f"stg.{t}": sinks.read(spark, f"{root}/stg/{t}") for t in ("customers", "work_orders", "technicians", "invoices")}
    )
    assert rows(second["quarantine_counts"].select(*counted.columns)) == rows(counted)


def test_keys_stay(spark, raw, runs, tmp_path):
    """Another load with fewer and changed rows: all keys that there were keep their numbers."""
    root = str(tmp_path / "lake")

    frames = {t: raw[t] for t in ("customers", "technicians", "work_orders", "invoices", "assignments")}
    some = {**frames, "technicians": raw["technicians"].filter("_src_row % 3 > 0"), "work_orders": raw["work_orders"].filter("_src_row % 5 > 0")}
    full_run.run(some, root, LOAD, "RUN-1", dt.datetime(2001, 7, 1, 7))
    names = {"dim_technician": ("technician_id", "technician_sk"), "fact_work_orders": ("work_order_id", "fact_wo_sk")}
    before = {t: dict(map(tuple, sinks.read(spark, f"{root}/curated/{t}").select(*names[t]).collect())) for t in names}
    out = full_run.run(frames, root, LOAD, "RUN-2", dt.datetime(2001, 7, 2, 7))
    for table, given in before.items():
        after = dict(map(tuple, out[table].select(*names[table]).collect()))
        assert len(after) > len(given) and len(set(after.values())) == len(after)
        assert all(after[k] == n for k, n in given.items())


def test_dates_resolve(runs):
    _, (_, second) = runs
    assert second["fact_work_orders"].filter("scheduled_date_sk IS NULL").count() == 0


def test_new_files_load_once(spark, data, tmp_path):
    source, table, checkpoint = (str(tmp_path / n) for n in ("in", "raw", "cp"))
    supplier = spark.read.parquet(f"{data}/supplier.parquet")
    supplier.write.mode("append").parquet(source)

    def load(batch):
        append_new_files(spark, source, supplier.schema, table, checkpoint, batch, dt.datetime(2001, 7, 1))

    load("B1")
    load("B1")
    supplier.write.mode("append").parquet(source)
    load("B2")
    counts = {r._batch_id: r["count"] for r in spark.read.parquet(table).groupBy("_batch_id").count().collect()}
    assert counts == {"B1": supplier.count(), "B2": supplier.count()}
    assert dict(spark.read.parquet(table).dtypes)["s_suppkey"] == "string"
