"""Versioned tables and runs as partitions: what readers see when runs are lost, repeated or overlap."""

import os

import pytest

from sluice.sources import sinks
from sluice.sources.versions import BUCKET, VersionedTable, bucket_of


@pytest.fixture
def rows(spark):
    return lambda *pairs: spark.createDataFrame(pairs, "id int, v string")


def found(df):
    return sorted(tuple(r) for r in df.collect())


def files(path):
    return {f"{d}/{n}": os.stat(f"{d}/{n}").st_mtime_ns for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_refresh_append_and_earlier_versions(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    assert not sinks.exists(spark, path)
    sinks.overwrite(rows((1, "a")), path)
    sinks.append(rows((2, "b")), path)
    assert found(sinks.read(spark, path)) == [(1, "a"), (2, "b")]
    sinks.overwrite(rows((3, None)), path)
    assert found(sinks.read(spark, path)) == [(3, None)]
    assert found(sinks.read(spark, path, version=2)) == [(1, "a"), (2, "b")]
    with pytest.raises(FileNotFoundError):
        sinks.read(spark, path, version=9)


def test_a_lost_run_leaves_the_old_table(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite(rows((1, "a")), path)
    failing = rows((2, "b")).selectExpr("id", "if(id > 0, raise_error('lost'), v) AS v")
    with pytest.raises(Exception, match="lost"):
        sinks.overwrite(failing, path)
    assert found(sinks.read(spark, path)) == [(1, "a")]
    table = VersionedTable(spark, path)
    table.prepare(rows((3, "c")))  # killed between the write and its entry
    (tmp_path / "t" / "_log" / ".half").write_text('{"folders": [')  # and while the entry was written
    assert found(sinks.read(spark, path)) == [(1, "a")]
    sinks.append(rows((4, "d")), path)
    assert found(sinks.read(spark, path)) == [(1, "a"), (4, "d")]


def test_a_table_refreshed_from_itself_and_its_readers(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    old = sinks.overwrite(rows((1, "a"), (2, "b")), path)
    sinks.overwrite(sinks.read(spark, path).selectExpr("id + 1 AS id", "v"), path)
    assert found(old) == [(1, "a"), (2, "b")]
    assert found(sinks.read(spark, path)) == [(2, "a"), (3, "b")]


def test_two_writers_at_once(spark, rows, tmp_path):
    """Both prepared before either is published: appends add up, a merge that read the old version fails."""
    path = str(tmp_path / "t")
    sinks.overwrite(rows((1, "a")), path)
    one, two = VersionedTable(spark, path), VersionedTable(spark, path)
    first, second = one.prepare(rows((2, "b"))), two.prepare(rows((3, "c")))
    schema = rows((0, "")).schema
    one.publish(first, schema, append=True)
    two.publish(second, schema, append=True)
    assert found(sinks.read(spark, path)) == [(1, "a"), (2, "b"), (3, "c")]


def test_vacuum_keeps_what_versions_name(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite(rows((1, "a")), path)
    sinks.append(rows((2, "b")), path)
    sinks.overwrite(rows((3, "c")), path)
    table = VersionedTable(spark, path)
    aside = table.prepare(rows((4, "d")))
    table.vacuum(keep=2)
    assert table.numbers() == [2, 3]
    assert found(table.read(2)) == [(1, "a"), (2, "b")]
    table.vacuum(keep=1)
    assert table.numbers() == [3] and found(table.read()) == [(3, "c")]
    assert aside in os.listdir(path)  # it may belong to a run at work
    table.vacuum(keep=1, grace_seconds=-1)
    assert len([n for n in os.listdir(path) if n.startswith("data-")]) == 1
    assert found(table.read()) == [(3, "c")]


def test_empty_tables(spark, rows, tmp_path):
    table, counts = sinks.overwrite_counted(rows((1, "a")).filter("false"), str(tmp_path / "t"), {"n": "count(1)", "s": "sum(id)"})
    assert (table.count(), counts) == (0, {"n": 0, "s": 0})
    table, counts = sinks.overwrite_counted(rows((1, "a"), (2, None)), str(tmp_path / "t"), {"n": "count(1)", "s": "count_if(v IS NULL)"})
    assert counts == {"n": 2, "s": 1}


def test_buckets_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")
    table = VersionedTable(spark, path)
    df = spark.range(1000).selectExpr("if(id = 0, NULL, CAST(id AS string)) AS id", "0 AS v")
    table.write_buckets(df, ["id"], 8)
    before = files(path)
    some = [r[0] for r in df.filter("id IN ('5', '77')").select(bucket_of(["id"], 8)).distinct().collect()]
    changed = table.read_buckets(some).selectExpr("id", "if(id IN ('5', '77'), 1, v) AS v")
    table.merge_buckets(changed, ["id"], some)
    after = files(path)
    assert all(after[f] == t for f, t in before.items())
    assert {f.split(f"{BUCKET}=")[1].split("/")[0] for f in set(after) - set(before)} == {str(b) for b in some}
    now = {r.id: r.v for r in table.read().collect()}
    assert len(now) == 1000 and {i for i, v in now.items() if v} == {"5", "77"}
    with pytest.raises(ValueError):
        table.merge_buckets(df, ["id"], some)


def test_a_run_replaces_its_own_rows_only(spark, tmp_path):
    path = str(tmp_path / "runs")

    def store(run, *values):
        return sinks.replace_run(spark.createDataFrame([(run, v) for v in values], "run_id string, v int"), path)

    store("1", 1, 2)
    store("2", 3)
    before = files(path)
    table = store("2", 4, 5)
    assert found(table) == [("1", 1), ("1", 2), ("2", 4), ("2", 5)]
    assert all(files(path).get(f) == t for f, t in before.items() if "run_id=1/" in f)
    plan = table.filter("run_id = '2'")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(run_id" in plan.toString()
    assert all("run_id=2/" in r[0] for r in table.filter("run_id = '2'").selectExpr("input_file_name()").collect())
