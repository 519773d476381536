from __future__ import annotations

from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from rows import bronze, play, write_drop

from sluicework import PLAYS, cast_typed, dense_key, run_bronze, run_silver, upsert_facts
from sluicework.operators.facts import KEY_RANGES, key_ranges
from sluicework.operators.keys import highest_key, range_clustered
from sluicework.plans import jobs
from sluicework.sources.storage import Staging, empty

D1, D2 = "2026-03-01", "2026-03-02"


@pytest.fixture
def staging(spark):
    with Staging(spark) as opened:
        yield opened


def load(spark, rows, day):
    return cast_typed(PLAYS, bronze(spark, PLAYS, rows, day))[0]


def keys(frame):
    found = frame.select("play_id", "snapshot_date", "ms_played", "play_sk").collect()
    return sorted((r[0], str(r[1]), r[2], r[3]) for r in found)


@pytest.mark.parametrize("partitions", ["1", "4", "16"])
def test_dense_key_equals_global_row_number(spark, staging, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # Two thirds share the first column, so the range has to split on the second.
        frame = spark.range(20000).select(
            F.expr("IF(id % 3 = 0, id % 97, 50)").alias("a"), F.expr("id * 31 % 20011").alias("b")
        )
        numbered = dense_key(frame, ["a", "b"], "sk", staging, start=100)
        expected = frame.withColumn("sk", F.row_number().over(Window.orderBy("a", "b")) + 100)
        assert numbered.exceptAll(expected.withColumn("sk", F.col("sk").cast("bigint"))).count() == 0
        assert numbered.agg(F.count("*"), F.min("sk"), F.max("sk")).first()[:] == (20000, 101, 20100)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_dense_key_of_nothing(spark, staging):
    numbered = dense_key(spark.range(0), ["id"], "sk", staging)
    assert numbered.columns == ["id", "sk"] and numbered.count() == 0


def test_dense_key_moves_no_row_into_a_single_partition(spark, staging):
    numbered = dense_key(spark.range(1000), ["id"], "sk", staging)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        # Only the per-partition sizes may meet in one task.
        if "SinglePartition" in line:
            assert "id#" not in line


def test_highest_key(spark):
    assert highest_key(empty(spark, PLAYS.table_schema), "play_sk") == 0


def test_next_day_and_key_of_another_day(spark, staging):
    stored = [play("840", f"{D1}T03:30:00", "11"), play("812", f"{D1}T02:15:00", "12")]
    nothing = empty(spark, PLAYS.table_schema)
    current = staging.table(upsert_facts(PLAYS, nothing, load(spark, stored, D1), staging).rows)
    assert keys(current) == [(812, D1, 12, 1), (840, D1, 11, 2)]
    following = [play("812", f"{D2}T04:45:00", "13"), play("900", f"{D2}T05:00:00", "14")]
    second = upsert_facts(PLAYS, current, load(spark, following, D2), staging)
    assert keys(second.rows) == [(900, D2, 14, 3)]
    assert second.elsewhere_count == 1
    days = (date.fromisoformat(D2), date.fromisoformat(D1))
    assert [tuple(r) for r in second.elsewhere.collect()] == [(812, *days)]
    (left,) = second.left_out.collect()
    assert (left["play_id"], left["ms_played"], left["error_reason"], left["error_stage"]) == (
        812,
        13,
        f"play_id_held_by_{D1}",
        "held_elsewhere",
    )
    assert second.left_out.columns == PLAYS.error_schema.names


@pytest.fixture
def two_days(spark, staging):
    one = load(spark, [play(str(n), f"{D1}T01:00:00", str(n)) for n in (10, 11, 12)], D1)
    rows = upsert_facts(PLAYS, empty(spark, PLAYS.table_schema), one, staging).rows
    current = staging.table(rows)
    two = load(spark, [play(str(n), f"{D2}T01:00:00", str(n)) for n in (20, 21)], D2)
    return staging.table(current.unionByName(upsert_facts(PLAYS, current, two, staging).rows))


def test_redrop_takes_new_values_and_keeps_keys(spark, staging, two_days):
    again = [play("10", f"{D1}T01:00:00", "77"), play("9", f"{D1}T01:00:00", "9")]
    done = upsert_facts(PLAYS, two_days, load(spark, again, D1), staging)
    # 11 and 12 are missing from the re-drop, so they are gone; 9 is new and comes last.
    assert keys(done.rows) == [(9, D1, 9, 6), (10, D1, 77, 1)]


def test_redrop_can_retain_missing_rows(spark, staging, two_days):
    again = [play("10", f"{D1}T01:00:00", "77"), play("20", f"{D1}T01:00:00", "5")]
    done = upsert_facts(PLAYS, two_days, load(spark, again, D1), staging, retain_missing=True)
    assert keys(done.rows) == [(10, D1, 77, 1), (11, D1, 11, 2), (12, D1, 12, 3)]
    assert done.elsewhere_count == 1


def test_retain_missing_without_a_loaded_row_goes_by_the_given_days(spark, staging, two_days):
    nothing = load(spark, [], D1)
    done = upsert_facts(PLAYS, two_days, nothing, staging, retain_missing=True, days=[D1])
    assert keys(done.rows) == keys(two_days.where(f"snapshot_date = '{D1}'"))


def test_a_wrong_highest_key_is_not_taken_for_an_empty_table(spark, staging, two_days):
    again = load(spark, [play("20", f"{D2}T01:00:00", "20")], D2)
    done = upsert_facts(PLAYS, two_days, again, staging, highest=0)
    assert keys(done.rows) == [(20, D2, 20, 4)]


def test_key_ranges_leave_the_gaps_out(spark):
    frame = spark.range(0, 100_000).union(spark.range(10**12, 10**12 + 3)).toDF("k")
    ranges = key_ranges(frame, "k")
    assert ranges == [(0, 99_999), (10**12, 10**12 + 2)]
    spread = spark.range(0, 10**6).selectExpr("id * id AS k")
    found = key_ranges(spread, "k")
    assert 1 < len(found) <= KEY_RANGES and found[0][0] == 0
    assert all(a[1] < b[0] for a, b in zip(found, found[1:], strict=False))
    assert key_ranges(spark.range(0).toDF("k"), "k") == []
    words = spark.createDataFrame([("b",), ("a",)], "k string")
    assert key_ranges(words, "k") == [("a", "b")]


def test_an_outlying_key_does_not_widen_the_scan(spark, staging, tmp_path):
    """Ten stored files of a thousand keys; the load has keys of the last one and a first key."""
    path = f"{tmp_path}/plays"
    columns = ", ".join(
        f"{'id' if f.name in ('play_id', 'play_sk') else 'NULL'} :: {f.dataType.simpleString()}"
        f" AS {f.name}"
        for f in PLAYS.table_schema
        if f.name != "snapshot_date"
    ).split(", ")
    stored = spark.range(0, 10_000, 1, 10).selectExpr(
        *columns, f"date_add(date'{D1}', CAST(id DIV 1000 AS int)) AS snapshot_date"
    )
    stored.write.partitionBy("snapshot_date").parquet(path)
    current = spark.read.schema(PLAYS.table_schema).parquet(path)
    rows = [play(str(k), "2026-04-01T01:00:00") for k in (0, *range(9_990, 10_010))]
    day = "2026-04-01"
    low, high = key_ranges(load(spark, rows, day), "play_id")
    assert low == (0, 0) and high == (9_990, 10_009)
    tests = " OR ".join(f"play_id BETWEEN {a} AND {b}" for a, b in (low, high))
    scan = current.where(tests).select("play_id")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(play_id,0)" in plan
    done = upsert_facts(PLAYS, current, load(spark, rows, day), staging)
    assert done.elsewhere_count == 11
    assert sorted(r["play_sk"] for r in done.rows.collect()) == list(range(10_000, 10_010))


def test_same_load_again_changes_nothing(spark, staging, two_days):
    again = load(spark, [play(str(n), f"{D2}T01:00:00", str(n)) for n in (21, 20)], D2)
    done = upsert_facts(PLAYS, two_days, again, staging)
    assert keys(done.rows) == keys(two_days.where(f"snapshot_date = '{D2}'"))


def test_empty_load_on_a_filled_table(spark, staging, two_days):
    done = upsert_facts(PLAYS, two_days, load(spark, [], D1), staging)
    assert done.rows.count() == 0 and done.elsewhere_count == 0


def test_new_keys_are_dense_on_top_of_the_table(spark, staging, two_days):
    rows = load(spark, [play(str(n), f"{D2}T01:00:00", "1") for n in range(5, 400)], D2)
    done = upsert_facts(PLAYS, two_days, rows, staging)
    fresh = sorted(r[0] for r in done.rows.where("play_sk > 5").select("play_sk").collect())
    assert fresh == list(range(6, 6 + 390))
    assert done.elsewhere_count == 3


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_a_narrow_range_is_in_few_files(spark, tmp_path, parts):
    frame = spark.range(0, 4000, 1, 8).selectExpr("(id * 2654435761) % 100003 AS k", "id AS v")
    path = f"{tmp_path}/rows"
    range_clustered(frame, frame.select("k"), "k", parts).write.parquet(path)
    spans = []
    for file in sorted(tmp_path.glob("rows/*.parquet")):
        footer = pq.ParquetFile(file)
        found = footer.metadata.row_group(0).column(0).statistics
        spans.append((found.min, found.max, footer.metadata.num_rows))
        keys = footer.read(["k"])["k"].to_pylist()
        assert keys == sorted(keys)
    spans.sort()
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert len(spans) == parts and max(s[2] for s in spans) <= 1.3 * 4000 / parts + 10
    # Of a range of a fiftieth of the keys: at most two files, where hashing would need them all.
    assert sum(low <= 52_000 and high >= 50_000 for low, high, _ in spans) <= 2
    assert spark.read.parquet(path).exceptAll(frame).count() == 0


def test_clustering_of_few_keys_null_keys_and_texts(spark):
    few = spark.range(100).selectExpr("IF(id % 4 = 0, NULL, id % 3) AS k")
    assert range_clustered(few, few, "k", 9).count() == 100
    none = few.limit(0)
    assert range_clustered(none, none, "k", 5).count() == 0
    texts = few.selectExpr("CAST(k AS string) AS k")
    assert range_clustered(texts, texts, "k", 3).count() == 100
    big = spark.range(50).selectExpr("CAST(id AS decimal(20,2)) / 4 AS k")
    assert range_clustered(big, big, "k", 6).count() == 50


def test_a_fact_day_is_written_in_key_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "_FILE_BYTES", 2000)
    rows = [play(str(k * 7919 % 1009), f"{D1}T01:00:00", "5") for k in range(1, 600)]
    write_drop(tmp_path / "plays", D1, rows)
    run_bronze(spark, PLAYS, str(tmp_path / "plays"), D1, f"{tmp_path}/bronze")
    run_silver(spark, PLAYS, f"{tmp_path}/bronze/plays", D1, f"{tmp_path}/silver")
    spans = []
    for file in (tmp_path / "silver/plays").rglob("*.parquet"):
        keys = pq.read_table(file, columns=["play_id"], partitioning=None)["play_id"].to_pylist()
        spans.append((min(keys), max(keys)))
    spans.sort()
    assert len(spans) > 3 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_a_day_that_compresses_well_is_sorted_in_several_tasks(spark, tmp_path, monkeypatch):
    def refine(day_rows, **options):
        write_drop(tmp_path / "plays", D1, day_rows)
        run_bronze(spark, PLAYS, str(tmp_path / "plays"), D1, f"{tmp_path}/bronze")
        run_silver(spark, PLAYS, f"{tmp_path}/bronze/plays", D1, f"{tmp_path}/silver", **options)
        files = [pq.read_table(f) for f in (tmp_path / "silver/plays").rglob("*.parquet")]
        return sorted(f.num_rows for f in files)

    # Bronze bytes would make a few files, what the rows take in memory makes more.
    monkeypatch.setattr(jobs, "_FILE_BYTES", 40_000)
    rows = [play(str(k), f"{D1}T01:00:00", "5") for k in range(1, 2001)]
    found = refine(rows)
    assert sum(found) == 2000 and max(found) < 300
    # Also when the rows that stay are stored ones.
    found = refine([play("9", f"{D1}T01:00:00", "-1")], retain_missing=True)
    assert sum(found) == 2000 and max(found) < 300
