from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from rows import at, bronze, dimension, dimension_row, user

from sluicework import USERS, cast_typed, merge_history
from sluicework.sources.storage import Staging, empty

COLUMNS = ("user_id", "country", "plan_tier", "customer_sk", "valid_from", "valid_to", "is_current")


@pytest.fixture
def staging(spark):
    with Staging(spark) as opened:
        yield opened


def load(spark, rows, day="2026-03-02"):
    return cast_typed(USERS, bronze(spark, USERS, rows, day))[0]


def picture(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=lambda r: r[3])


def test_first_load_starts_versions(spark, staging):
    rows = [user("2", "US", "premium", updated_at="2026-02-15T12:00:00"), user("1")]
    merged = merge_history(USERS, empty(spark, USERS.table_schema), load(spark, rows), staging)
    assert merged.rows.columns == USERS.table_schema.names
    assert picture(merged.rows) == [
        (1, "PL", "free", 1, at("2025-12-04T05:45:00"), None, True),
        (2, "US", "premium", 2, at("2026-02-15T12:00:00"), None, True),
    ]


@pytest.fixture
def current(spark):
    """Three users: one never changed, one moved once, one came last."""
    return dimension(
        spark,
        [
            dimension_row(41, "SE", "trial", 7, "2025-04-01T09:00:00", day="2025-05-10"),
            dimension_row(
                42, "SE", "trial", 8, "2025-04-02T09:00:00", "2025-05-20T18:30:00", "2025-05-10"
            ),
            dimension_row(
                42, "FI", "trial", 9, "2025-05-20T18:30:00", updated="2025-05-20T18:30:00",
                day="2025-05-21",
            ),
            dimension_row(43, "DK", "full", 10, "2025-05-19T06:00:00", day="2025-05-21"),
        ],
    )


# User 42 takes another tier, user 43 moves, user 44 is new; user 41 is as before.
CHANGES = [
    user("41", "SE", "trial"),
    user("42", "FI", "full", updated_at="2025-06-01T20:00:00"),
    user("43", "DE", "full", updated_at="2025-06-01T21:00:00"),
    user("44", "SE", "trial", created_at="2025-06-01T22:00:00"),
]


def test_change_closes_the_active_version(spark, staging, current):
    merged = merge_history(USERS, current, load(spark, CHANGES, "2025-06-02"), staging)
    after = {row[3]: row for row in picture(merged.rows)}
    # Every stored version is still there; the two of changed users end where the new ones start.
    for sk, before in {row[3]: row for row in picture(current)}.items():
        ends = {9: "2025-06-01T20:00:00", 10: "2025-06-01T21:00:00"}
        if sk in ends:
            assert after.pop(sk) == (*before[:5], at(ends[sk]), False)
        else:
            assert after.pop(sk) == before
    assert [(row[0], *row[1:3], row[4], row[5]) for row in after.values()] == [
        (int(r["user_id"]), r["country"], r["plan_tier"],
         at(r["updated_at"] or r["created_at"]), None)
        for r in CHANGES[1:]
    ]
    assert sorted(after) == [11, 12, 13] and all(row[6] for row in after.values())
    days = {r["customer_sk"]: str(r["snapshot_date"]) for r in merged.rows.collect()}
    assert days[7] == "2025-05-10" and days[9] == "2025-05-21" and days[13] == "2025-06-02"
    assert merged.closings.count() == merged.closed_count == 2
    assert merged.versions.count() == merged.opened_count == 3


def test_rerun_changes_nothing(spark, staging, current):
    once = staging.table(merge_history(USERS, current, load(spark, CHANGES), staging).rows)
    twice = merge_history(USERS, once, load(spark, CHANGES), staging, order_guard=True)
    assert picture(twice.rows) == picture(once)
    assert twice.rejected.count() == 0


def test_user_missing_from_the_snapshot_stays(spark, staging, current):
    """Of three active users the snapshot has one, unchanged; the other two are as they were."""
    merged = merge_history(USERS, current, load(spark, CHANGES[:1], "2025-06-02"), staging)
    assert merged.opened_count == merged.closed_count == 0
    assert picture(merged.rows) == picture(current)
    active = merged.rows.where("is_current").select("user_id").collect()
    assert sorted(r["user_id"] for r in active) == [41, 42, 43]


def test_empty_snapshot_changes_nothing(spark, staging, current):
    merged = merge_history(USERS, current, load(spark, []), staging)
    assert picture(merged.rows) == picture(current)


def test_null_is_a_value_of_its_own(spark, staging):
    stored = dimension(
        spark,
        [
            dimension_row(1, None, "free", 1, "2025-12-04T05:45:00"),
            dimension_row(2, None, "free", 2, "2025-12-04T05:45:00"),
            dimension_row(3, "PL", "free", 3, "2025-12-04T05:45:00"),
        ],
    )
    rows = [user("1", None), user("2", "__NULL__"), user("3", None)]
    merged = merge_history(USERS, stored, load(spark, rows), staging)
    assert sorted(r["user_id"] for r in merged.versions.collect()) == [2, 3]


# An older state of two users, and a user not known yet.
BACKWARDS = [
    user("41", "NO", "trial", created_at="2025-04-01T09:00:00"),
    user("43", "DK", "trial", updated_at="2025-05-01T00:00:00"),
    user("45", "SE"),
]


def test_older_snapshot_without_guard_closes_backwards(spark, staging, current):
    merged = merge_history(USERS, current, load(spark, BACKWARDS), staging)
    ended = merged.rows.where("NOT is_current AND customer_sk <> 8")
    closed = {r["user_id"]: r for r in ended.collect()}
    assert sorted(closed) == [41, 43]
    assert closed[43]["valid_to"] < closed[43]["valid_from"]
    assert closed[41]["valid_to"] == closed[41]["valid_from"]


def test_order_guard_rejects_what_is_not_newer(spark, staging, current):
    merged = merge_history(USERS, current, load(spark, BACKWARDS), staging, order_guard=True)
    assert picture(merged.rows)[:4] == picture(current)
    assert [r["user_id"] for r in merged.versions.collect()] == [45]
    assert merged.rejected.columns == USERS.error_schema.names
    found = {(r["user_id"], r["error_reason"], r["error_stage"]) for r in merged.rejected.collect()}
    assert found == {(41, "out_of_order", "out_of_order"), (43, "out_of_order", "out_of_order")}
    assert (merged.opened_count, merged.closed_count, merged.rejected_count) == (1, 0, 2)


@pytest.mark.parametrize("partitions", ["1", "16"])
def test_chain_against_brute_force(spark, staging, partitions):
    """Three growing snapshots whose tiers change: intervals must chain, keys must be dense."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        table, expected, top = empty(spark, USERS.table_schema), {}, 0
        for day in range(1, 4):
            stamp = f"2026-03-{day:02d}"
            rows = [
                user(str(u), plan_tier=f"t{(u * day) % 5}", updated_at=f"{stamp}T00:00:00")
                for u in range(day * 30)
            ]
            for u in range(day * 30):
                tier, versions = f"t{(u * day) % 5}", expected.setdefault(u, [])
                if not versions or versions[-1][0] != tier:
                    top += 1
                    versions.append((tier, top, at(f"{stamp}T00:00:00")))
            merged = merge_history(USERS, table, load(spark, rows, stamp), staging)
            table = staging.table(merged.rows)
        wanted = []
        for u, versions in expected.items():
            for (tier, sk, since), following in zip(versions, [*versions[1:], None], strict=True):
                until = following[2] if following else None
                wanted.append((u, "PL", tier, sk, since, until, until is None))
        assert picture(table) == sorted(wanted, key=lambda r: r[3])
        assert table.where("is_current").groupBy("user_id").count().where("count > 1").count() == 0
        assert table.agg(F.max("customer_sk")).first()[0] == table.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
