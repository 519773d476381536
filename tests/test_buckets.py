"""The bucketed copy beside a table: contents, plans without an exchange, merging, crashes."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F
from rows import at, bronze, play, user

from sluicework import PLAYS, USERS, cast_typed, replace_days, replace_table
from sluicework.operators.dimension import compared_rows
from sluicework.operators.facts import held_rows, key_ranges
from sluicework.plans.jobs import stored_keys
from sluicework.sources import buckets, storage
from sluicework.sources.buckets import KeyedCopy

DAYS = [f"2025-03-{n:02d}" for n in range(1, 13)]


def facts(spark, day, keys):
    n = DAYS.index(day)
    rows = [play(str(k), f"{day}T06:00:00", str(900 + k)) for k in keys]
    typed = cast_typed(PLAYS, bronze(spark, PLAYS, rows, day))[0]
    return typed.withColumn("play_sk", F.col("play_id").cast("bigint") + 1000 * n)


def put(spark, base, day, keys):
    replace_days(facts(spark, day, keys), f"{base}/plays", [day])


def held(copy):
    rows = copy.frame().select("play_id", "play_sk", F.col("snapshot_date").cast("string"))
    return sorted(tuple(r) for r in rows.collect())


def want(days):
    return sorted(
        (k, k + 1000 * DAYS.index(day), day) for day, keys in days.items() for k in keys
    )


def test_copy_follows_the_table(spark, tmp_path):
    stored = {DAYS[0]: range(0, 50), DAYS[1]: range(50, 60)}
    with stored_keys(spark, PLAYS, str(tmp_path)) as copy:
        assert copy.sync() == [] and copy.frame().count() == 0
        for day, keys in stored.items():
            put(spark, tmp_path, day, keys)
        assert copy.sync() == DAYS[:2] and held(copy) == want(stored)
        assert copy.sync() == []
    # Another run, after a re-drop of one day, a new day and a day that is gone.
    stored[DAYS[1]], stored[DAYS[2]] = range(55, 58), range(200, 230)
    for day in DAYS[1:3]:
        put(spark, tmp_path, day, stored[day])
    shutil.rmtree(f"{tmp_path}/plays/snapshot_date={DAYS[0]}")
    del stored[DAYS[0]]
    with stored_keys(spark, PLAYS, str(tmp_path)) as copy:
        assert copy.sync() == DAYS[1:3] and held(copy) == want(stored)
        name = copy._table
        assert spark.catalog.tableExists(name)
    assert not spark.catalog.tableExists(name)


def exchanged(plan):
    """Whether each scan of the formatted plan lies below an exchange: (scan's line, exchanged)."""
    above = []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        above = [(d, text) for d, text in above if d < depth]
        if "FileScan" in line or "Scan ExistingRDD" in line:
            yield line, any("Exchange" in text for _, text in above)
        above.append((depth, line))


def stored_side(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    (found,) = [hit for line, hit in exchanged(plan) if "sluicework_" in line]
    assert "Bucketed: true" in plan and "SortMergeJoin" in plan
    return found


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stored_keys_meet_a_load_without_an_exchange(spark, tmp_path, no_broadcast):
    for day in DAYS[:3]:
        put(spark, tmp_path, day, range(100 * DAYS.index(day), 100 * DAYS.index(day) + 80))
    with stored_keys(spark, PLAYS, str(tmp_path)) as copy:
        copy.sync()
        keys = facts(spark, DAYS[3], [3, 170, 999]).select("play_id", "snapshot_date")
        met = held_rows(PLAYS, copy.frame(), keys, key_ranges(keys, "play_id"))
        assert not stored_side(met)
        found = sorted((r["play_id"], str(r["held_by"]), r["play_sk"]) for r in met.collect())
        assert found == [(3, DAYS[0], 3), (170, DAYS[1], 1170)]


def versions(spark, day, rows):
    typed = cast_typed(USERS, bronze(spark, USERS, rows, day))[0]
    return typed.select(
        "*",
        (F.col("user_id") + 5).cast("bigint").alias("customer_sk"),
        F.coalesce("updated_at", "created_at").alias("valid_from"),
        F.when(F.col("plan_tier") == "gone", F.lit(at("2025-09-01T00:00:00"))).alias("valid_to"),
        (F.col("plan_tier") != "gone").alias("is_current"),
    )


def test_active_rows_meet_a_snapshot_without_an_exchange(spark, tmp_path, no_broadcast):
    rows = [user(str(n), "CL", "gone" if n % 4 == 0 else "solo") for n in range(40)]
    replace_days(versions(spark, DAYS[0], rows), f"{tmp_path}/users", [DAYS[0]])
    with stored_keys(spark, USERS, str(tmp_path)) as copy:
        copy.sync()
        assert copy.frame().count() == 30
        loaded = cast_typed(USERS, bronze(spark, USERS, rows[:6], DAYS[1]))[0]
        met = compared_rows(USERS, copy.frame(), loaded)
        assert not stored_side(met)
        found = {r["user_id"]: r["_old_plan_tier"] for r in met.collect()}
        assert found == {n: None if n % 4 == 0 else "solo" for n in range(6)}
        # A table replaced as a whole has other files for every day.
        replace_table(versions(spark, DAYS[1], rows[:3]), f"{tmp_path}/users")
        assert copy.sync() == [DAYS[1]] and copy.frame().count() == 2


def test_many_segments_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "MOST_SEGMENTS", 3)
    stored = {}
    with stored_keys(spark, PLAYS, str(tmp_path)) as copy:
        for n, day in enumerate(DAYS[:9]):
            stored[day] = range(10 * n, 10 * n + 5 + n)
            put(spark, tmp_path, day, stored[day])
            if n == 6:
                stored[DAYS[1]] = range(700, 703)
                put(spark, tmp_path, DAYS[1], stored[DAYS[1]])
            copy.sync()
            folders = storage.children(spark, copy.folder, f"{buckets.SEGMENT}=*")
            assert len(folders) <= 4 and held(copy) == want(stored)
        assert len(storage.children(spark, f"{copy.folder}/_days")) == 9


def test_more_buckets_when_the_copy_outgrows_them(spark, tmp_path, monkeypatch):
    put(spark, tmp_path, DAYS[0], range(100))
    with stored_keys(spark, PLAYS, str(tmp_path)) as copy:
        copy.sync()
        assert copy.folder.endswith("b00000008")
        monkeypatch.setattr(buckets, "BUCKET_BYTES", 100)
        assert copy.sync() == DAYS[:1]
        assert int(copy.folder[-8:]) >= 32 and held(copy) == want({DAYS[0]: range(100)})
        assert len(storage.children(spark, copy.root)) == 1


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["touch", "delete"])
def test_a_crash_leaves_nothing_that_is_trusted(spark, tmp_path, monkeypatch, step):
    put(spark, tmp_path, DAYS[0], range(20))
    with stored_keys(spark, PLAYS, str(tmp_path)) as copy:
        copy.sync()
    put(spark, tmp_path, DAYS[0], range(10, 15))
    put(spark, tmp_path, DAYS[1], range(30, 35))

    def crash(*_):
        raise Crash

    monkeypatch.setattr(storage, step, crash)
    with pytest.raises(Crash), stored_keys(spark, PLAYS, str(tmp_path)) as copy:
        copy.sync()
    monkeypatch.undo()
    with stored_keys(spark, PLAYS, str(tmp_path)) as copy:
        copy.sync()
        assert held(copy) == want({DAYS[0]: range(10, 15), DAYS[1]: range(30, 35)})
        live = storage.children(spark, copy.folder, f"{buckets.SEGMENT}=*")
        assert 1 <= len(live) <= 2


def test_names_that_need_quoting(spark, tmp_path):
    rows = spark.range(20).selectExpr("id AS `a b`", "id * 2 AS `c``d`", "date'2025-03-01' AS snapshot_date")
    path = f"{tmp_path}/it's"
    replace_days(rows, path, [DAYS[0]])
    with KeyedCopy(spark, path, rows.schema, "a b", ["c`d"]) as copy:
        copy.sync()
        assert copy.frame().columns == ["a b", "c`d", "snapshot_date"]
        assert copy.frame().agg(F.sum("`c``d`")).first()[0] == 380
