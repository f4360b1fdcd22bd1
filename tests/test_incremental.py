"""Batches that meet stored keys and counts: same totals as a full evaluation, history neither shuffled nor read again."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from sluice.operators.catalog import RULES
from sluice.operators.evaluate import evaluate
from sluice.operators.incremental import IncrementalSuite, names_today
from sluice.operators.key_index import KeyIndex
from sluice.operators.rules import KeyRule, RowRule
from sluice.sources import sinks

AS_OF = dt.date(2001, 7, 1)
TABLES = ("customers", "technicians", "work_orders", "invoices", "assignments")


@pytest.fixture
def no_broadcast(settings):
    settings(**{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})


def counted(rows):
    return rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))


@pytest.fixture
def batches(spark):
    def batch(k):
        return spark.range(3000).selectExpr(
            f"if(id % 3 = 0, 'hot', if(id % 7 = 0, NULL, CAST((id + {k} * 500) % 1100 AS string))) AS a",
            "if(id % 5 = 0, NULL, 'x') AS b", f"CAST(id * {k} % 17 AS int) AS v",
        )

    return [batch(k) for k in (1, 2, 3)]


def index(spark, path):
    return KeyIndex(spark, str(path), ["a", "b"], {"n": "sum", "low": "min", "high": "max"}, buckets=4)


def found(df):
    return sorted(map(tuple, df.select("a", "b", "n", "low", "high").collect()), key=str)


def test_index_equals_the_full_form(spark, batches, tmp_path, no_broadcast):
    keys = index(spark, tmp_path / "i")
    whole = None
    for i, batch in enumerate(batches):
        keys.add(counted(batch), f"b{i}")
        whole = batch if whole is None else whole.unionAll(batch)
        assert found(keys.read()) == found(counted(whole))
    keys.add(counted(batches[0]), "b0")  # repeated: there already
    assert found(keys.read()) == found(counted(whole)) and keys.batches() == ("b0", "b1", "b2")
    files = [f for f in keys.read().inputFiles()]
    assert len(files) == 4  # one a bucket


def test_history_is_not_shuffled(spark, batches, tmp_path, no_broadcast):
    keys = index(spark, tmp_path / "i")
    keys.add(counted(batches[0]), "b0")
    batch = sinks.overwrite(counted(batches[1]), str(tmp_path / "batch"))
    for joined in (keys.meet(batch), keys._merged(keys._keyed(batch))):
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == plan.split("Initial Plan")[0].count("Exchange hashpartitioning") * 2
        assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning") == 1  # the batch alone
        assert "SelectedBucketsCount: 4 out of 4" in plan
    assert {(r.a, r.b) for r in keys.meet(batch).collect()} == {(r.a, r.b) for r in counted(batches[0]).collect()} & {
        (r.a, r.b) for r in counted(batches[1]).collect()
    }
    assert keys.meet(batch, "left_anti").count() == batch.count() - keys.meet(batch).count()


def test_buckets_follow_the_keys(spark, batches, tmp_path, monkeypatch):
    """One task writes one bucket, so none may hold a share that grows with the keys."""
    keys = index(spark, tmp_path / "i")
    whole, held = None, []
    for i, (batch, fit) in enumerate(zip(batches, (100, 100, 40))):
        monkeypatch.setattr("sluice.operators.key_index.KEYS_A_BUCKET", fit)
        keys.add(counted(batch), f"b{i}")
        whole = batch if whole is None else whole.unionAll(batch)
        assert found(keys.read()) == found(counted(whole))
        sizes = [r["count"] for r in keys.read().groupBy(F.input_file_name()).count().collect()]
        held.append(keys.table.version().buckets)
        assert held[-1] >= sum(sizes) / fit and max(sizes) < 2 * fit
    assert held[0] > 4 and held[2] >= 2 * held[0]  # more than the 4 given from the start, then dealt out anew
    again = index(spark, tmp_path / "i")  # made with 4, as it is on disk
    assert found(again.read()) == found(counted(whole))


def test_a_lost_batch_is_not_in_the_index(spark, batches, tmp_path):
    keys = index(spark, tmp_path / "i")
    keys.add(counted(batches[0]), "b0")
    lost = counted(batches[1]).withColumn("n", F.expr("if(n > 0, raise_error('lost'), n)").cast("long"))
    with pytest.raises(Exception, match="lost"):
        keys.add(lost, "b1")
    assert keys.batches() == ("b0",) and found(keys.read()) == found(counted(batches[0]))
    keys.add(counted(batches[1]), "b1")
    assert found(keys.read()) == found(counted(batches[0].unionAll(batches[1])))


@pytest.fixture
def extracts(raw):
    return raw, {t: raw[f"{t}_batch2"] for t in TABLES}, raw.with_later_batches()


def outcome(df):
    return sorted((r.rule_code, r.total_records, r.failed_records, r.pass_rate, r.status) for r in df.collect())


def test_totals_equal_the_full_evaluation(spark, extracts, tmp_path):
    first, second, both = extracts
    suite = IncrementalSuite(spark, str(tmp_path / "s"), RULES, buckets=4)
    for batch, name in ((first, "1"), (second, "2"), (second, "2")):  # the second one repeated
        suite.add(batch, name, AS_OF)
    assert outcome(suite.evaluate(AS_OF, both)) == outcome(evaluate(both, RULES, AS_OF))


def test_totals_for_another_day(spark, extracts, tmp_path):
    first, second, both = extracts
    rules = [r for r in RULES if isinstance(r, RowRule)]
    assert any(map(names_today, rules))
    suite = IncrementalSuite(spark, str(tmp_path / "s"), rules, buckets=4)
    suite.add(first, "1", AS_OF)
    later = AS_OF + dt.timedelta(days=400)
    suite.add(second, "2", later)
    with pytest.raises(ValueError):
        suite.evaluate(later)
    assert outcome(suite.evaluate(later, both)) == outcome(evaluate(both, rules, later))


def test_a_second_batch_scans_only_itself(spark, raw, tmp_path):
    """The first batch is deleted before the second one comes."""
    rules = [r for r in RULES if isinstance(r, (RowRule, KeyRule)) and r.table in ("customers", "technicians")]
    rules = [r for r in rules if isinstance(r, RowRule) or set(m.table for m in map(r.profile.measures.get, r.uses)) <= {r.table}]
    assert any(isinstance(r, KeyRule) for r in rules)
    suite = IncrementalSuite(spark, str(tmp_path / "s"), rules, buckets=4)
    stored = {t: str(tmp_path / t) for t in ("customers", "technicians")}
    suite.add({t: sinks.overwrite(raw[t], p) for t, p in stored.items()}, "1", AS_OF)
    for path in stored.values():
        os.rename(path, path + "-gone")
    suite.add({t: raw[f"{t}_batch2"] for t in stored}, "2", AS_OF)
    assert outcome(suite.evaluate(AS_OF)) == outcome(evaluate(raw.with_later_batches(), rules, AS_OF))
