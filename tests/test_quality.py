from __future__ import annotations

from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F
from rows import at, bronze, play, user

from sluicework import (
    PLAYS,
    USERS,
    Field,
    Rule,
    TableContract,
    cast_typed,
    classify,
    deduplicate,
    newest,
    quality_gate,
    upsert_facts,
    validate,
)
from sluicework.sources.storage import Staging, empty

DAY = "2026-03-01"


@pytest.fixture
def staging(spark):
    with Staging(spark) as opened:
        yield opened


def typed(spark, rows):
    return cast_typed(PLAYS, bronze(spark, PLAYS, rows, DAY))


def reasons(frame, key="play_id"):
    return {row[key]: row["error_reason"] for row in frame.collect()}


def bag(frame):
    return Counter(tuple(row) for row in frame.select(*sorted(frame.columns)).collect())


@pytest.mark.parametrize(
    ("value", "expected"),
    [("1.5", None), ("", None), ("9999999999", None), ("1e3", None), (" 12 ", 12), ("7", 7)],
)
def test_integers_read_safely(spark, value, expected):
    good, bad = typed(spark, [play("1", f"{DAY}T10:00:00", ms_played=value)])
    if expected is None:
        assert good.count() == 0
        row = bad.first()
        assert row["error_reason"] == "cast_error_ms_played"
        assert row["ms_played"] is None and row["play_id"] == 1
    else:
        assert good.first()["ms_played"] == expected and bad.count() == 0


def test_malformed_time_is_quarantined_and_reasons_follow_column_order(spark):
    rows = [play("1", "03/01/2026", "NaN", created_at=f"{DAY}T10:00:00", user_id="x")]
    good, bad = typed(spark, rows)
    assert good.count() == 0
    assert bad.first()["error_reason"] == (
        "cast_error_user_id; cast_error_played_at; cast_error_ms_played"
    )


def test_derived_columns(spark):
    rows = [
        play("1", "2026-03-01T23:59:00", created_at="2026-03-02T00:01:00"),
        play("2", "2026-03-01T00:01:00", created_at="2026-03-01T23:59:00"),
    ]
    good, _ = typed(spark, rows)
    found = {r["play_id"]: (r["event_date"], r["late_arriving_data"]) for r in good.collect()}
    assert found == {1: (date(2026, 3, 1), True), 2: (date(2026, 3, 1), False)}


def test_rules_of_plays(spark):
    rows = [
        play("1", f"{DAY}T10:00:00"),
        play("2", f"{DAY}T10:00:00", user_id=None),
        play("3", f"{DAY}T10:00:00", "0"),
        play("4", f"{DAY}T10:00:00", "-1", user_id=None, device_id=None),
        play("5", None, created_at=f"{DAY}T10:00:00", ms_played=None),
    ]
    valid, invalid = validate(PLAYS, typed(spark, rows)[0])
    assert [r["play_id"] for r in valid.collect()] == [1]
    assert "error_reason" not in valid.columns
    assert reasons(invalid) == {
        2: "null_user_id",
        3: "non_positive_ms_played",
        4: "null_user_id; null_device_id; non_positive_ms_played",
        5: "null_played_at; null_ms_played",
    }


def test_rules_of_users(spark):
    rows = [
        user("1"),
        user("2", email=None, country=None),
        user("3", plan_tier=None),
        user(None, email="a@example.org"),
    ]
    good, _ = cast_typed(USERS, bronze(spark, USERS, rows, DAY))
    valid, invalid = validate(USERS, good)
    assert [r["user_id"] for r in valid.collect()] == [1]
    assert reasons(invalid, "user_id") == {
        2: "null_email; null_country",
        3: "null_plan_tier",
        None: "null_user_id",
    }


def test_newest_row_wins(spark, staging):
    copies = {"2200": f"{DAY}T06:10:00", "3300": f"{DAY}T19:25:00", "1100": f"{DAY}T08:40:00"}
    parts = [
        bronze(spark, PLAYS, [play("17", f"{DAY}T05:55:00", length)], DAY, arrived)
        for length, arrived in copies.items()
    ]
    rows, _ = cast_typed(PLAYS, parts[0].union(parts[1]).union(parts[2]))
    found = deduplicate(rows, "play_id", PLAYS.newest_first, staging)
    latest = int(max(copies, key=copies.get))
    assert [r["ms_played"] for r in found.kept.collect()] == [latest]
    others = sorted(int(c) for c in copies if int(c) != latest)
    assert sorted(r["ms_played"] for r in found.duplicates.collect()) == others
    assert found.duplicate_count == len(others)
    assert bag(newest(rows, "play_id", PLAYS.newest_first)) == bag(found.kept)


def test_users_order_prefers_update_over_creation(spark, staging):
    rows = [
        user("1", "PL", updated_at="2026-02-01T00:00:00"),
        user("1", "DE", updated_at="2026-02-02T00:00:00"),
        user("1", "FR", created_at="2026-01-31T00:00:00"),
    ]
    good, _ = cast_typed(USERS, bronze(spark, USERS, rows, DAY))
    found = deduplicate(good, "user_id", USERS.newest_first, staging)
    assert [r["country"] for r in found.kept.collect()] == ["DE"]
    assert sorted(r["country"] for r in found.duplicates.collect()) == ["FR", "PL"]


def test_full_ties_keep_one_copy_whatever_the_partitioning(spark, staging):
    rows = [play("1", f"{DAY}T10:00:00", str(ms)) for ms in (5, 9, 9, 9, 7)]
    good, _ = typed(spark, rows)
    for partitions in (1, 3, 16):
        found = deduplicate(
            good.repartition(partitions), "play_id", PLAYS.newest_first, staging
        )
        assert [r["ms_played"] for r in found.kept.collect()] == [9]
        assert sorted(r["ms_played"] for r in found.duplicates.collect()) == [5, 7, 9, 9]


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
def test_hot_key_against_brute_force(spark, staging, broadcast_bytes):
    """A third of the rows on one key; also with the split that a big key set takes."""
    frame = spark.range(6000).select(
        F.expr("IF(id % 3 = 0, -1, id % 3500)").alias("k"),
        F.expr("id * 7919 % 101").alias("a"),
        F.expr("IF(id % 3 = 0, id % 50, id)").alias("b"),
    )
    found = deduplicate(
        frame, "k", ["a"], staging, heavy_rows=500, broadcast_bytes=broadcast_bytes or 4000
    )
    best: dict = {}
    rows = [tuple(r) for r in frame.collect()]
    for k, a, b in rows:
        best[k] = max(best.get(k, (a, b)), (a, b))
    winners = Counter((k, *v) for k, v in best.items())
    assert Counter(tuple(r) for r in found.kept.collect()) == winners
    assert Counter(tuple(r) for r in newest(frame, "k", ["a"]).collect()) == winners
    assert Counter(tuple(r) for r in found.duplicates.collect()) == Counter(rows) - winners
    assert sorted(r["k"] for r in found.keys.collect()) == sorted(best)
    assert found.duplicate_count == len(rows) - len(best)


def test_gate_stages_and_bad_rows_do_not_displace_good_ones(spark, staging):
    rows = [
        play("1", f"{DAY}T10:00:00", "100"),
        play("1", f"{DAY}T10:00:00", "-7", created_at=f"{DAY}T23:00:00"),
        play("1", f"{DAY}T10:00:00", "NaN", created_at=f"{DAY}T23:00:00"),
        play("1", f"{DAY}T10:00:00", "90"),
        play(None, f"{DAY}T10:00:00"),
        play(None, f"{DAY}T11:00:00"),
    ]
    source = bronze(spark, PLAYS, rows, DAY)
    gated = quality_gate(PLAYS, classify(PLAYS, source), staging)
    assert [r["ms_played"] for r in gated.accepted.collect()] == [100]
    assert gated.accepted.columns == PLAYS.silver_schema.names
    assert sorted((r["error_stage"], r["error_reason"]) for r in gated.rejected.collect()) == [
        ("cast", "cast_error_ms_played"),
        ("deduplication", "duplicate_play_id"),
        ("validation", "non_positive_ms_played"),
        ("validation", "null_play_id"),
        ("validation", "null_play_id"),
    ]
    assert gated.rejected.columns == PLAYS.error_schema.names
    assert gated.rejected_count == 5


def test_clean_input_gives_a_typed_empty_quarantine(spark, staging):
    source = bronze(spark, PLAYS, [play("1", f"{DAY}T10:00:00")], DAY)
    gated = quality_gate(PLAYS, classify(PLAYS, source), staging)
    assert gated.rejected_count == 0
    assert gated.rejected.collect() == []
    assert [(f.name, f.dataType) for f in gated.rejected.schema] == [
        (f.name, f.dataType) for f in PLAYS.error_schema
    ]


def test_raw_record_keeps_the_text(spark, staging):
    source = bronze(spark, PLAYS, [play("1", f"{DAY}T10:00:00", "NaN")], DAY)
    gated = quality_gate(PLAYS, classify(PLAYS, source, keep_raw=True), staging)
    assert '"ms_played":"NaN"' in gated.rejected.first()["raw_record"]
    assert gated.accepted.columns == PLAYS.silver_schema.names


def test_empty_input(spark, staging):
    source = bronze(spark, PLAYS, [], DAY)
    gated = quality_gate(PLAYS, classify(PLAYS, source), staging)
    assert gated.accepted.count() == gated.rejected.count() == gated.rejected_count == 0


def test_accepted_and_rejected_are_a_partition_of_the_input(spark, staging):
    rows = [
        play(str(i % 40), f"{DAY}T{i % 24:02d}:00:00", "NaN" if i % 11 == 0 else str(i - 5))
        for i in range(200)
    ]
    source = bronze(spark, PLAYS, rows, DAY)
    gated = quality_gate(PLAYS, classify(PLAYS, source), staging)
    accepted, rejected = gated.accepted.count(), gated.rejected.count()
    assert accepted + rejected == 200
    assert rejected == gated.rejected_count
    assert gated.accepted.select("play_id").distinct().count() == accepted


def test_split_and_combined_forms_agree(spark, staging):
    rows = [
        play("1", f"{DAY}T10:00:00"),
        play("x", f"{DAY}T10:00:00", "-1"),
        play("3", f"{DAY}T10:00:00", "-1", user_id=None),
    ]
    source = bronze(spark, PLAYS, rows, DAY)
    good, unread = cast_typed(PLAYS, source)
    valid, invalid = validate(PLAYS, good)
    whole = classify(PLAYS, source)
    clean = whole.where("error_stage IS NULL").drop("error_stage", "error_reason")
    assert bag(clean) == bag(valid)
    assert bag(whole.where("error_stage = 'cast'").drop("error_stage")) == bag(unread)
    assert bag(whole.where("error_stage = 'validation'").drop("error_stage")) == bag(invalid)
    assert at(f"{DAY}T10:00:00") == valid.first()["played_at"]


def test_any_name_and_reason_will_do(spark, staging):
    """Names with blanks, dashes, dots and backticks, and a reason with an apostrophe."""
    odd = TableContract(
        name="odd",
        key="the key",
        fields=(Field("the key", "int"), Field("a-b", "int"), Field("x`y", "string", False)),
        checks=(Rule("isn't \\ positive", "`a-b` <= 0"),),
        newest_first=("`a-b`", "source_file"),
        surrogate="row-sk",
    )
    rows = [("1", "5", "u"), ("1", "6", None), ("2", "0", "v"), ("3", "z", "w"), (None, "1", "x")]
    arrived = (at(f"{DAY}T10:00:00"), "odd.json", date.fromisoformat(DAY))
    source = spark.createDataFrame([(*r, *arrived) for r in rows], odd.bronze_schema)
    gated = quality_gate(odd, classify(odd, source, keep_raw=True), staging)
    assert [tuple(r)[:3] for r in gated.accepted.collect()] == [(1, 6, None)]
    assert sorted(r["error_reason"] for r in gated.rejected.collect()) == [
        "cast_error_a-b",
        "duplicate_the key",
        "isn't \\ positive",
        "null_the key",
    ]
    load = upsert_facts(odd, empty(spark, odd.table_schema), gated.accepted, staging)
    again = upsert_facts(odd, staging.table(load.rows), gated.accepted, staging)
    assert [r["row-sk"] for r in again.rows.collect()] == [1]
