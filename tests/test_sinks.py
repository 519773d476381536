"""Catalog tables, days swapped by a journal, and surrogates reserved by loads side by side."""

from __future__ import annotations

import uuid
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from threading import Barrier

import pytest
from rows import WEEK, play, week_plays, week_users, write_drop

from sluicework import (
    PLAYS,
    USERS,
    DaySwap,
    KeyReservation,
    create_day_table,
    insert_days,
    publish_days,
    read_table,
    run_bronze,
    run_silver,
)
from sluicework.sources import reservations, storage
from sluicework.sources.buckets import KeyedCopy
from sluicework.sources.writers import clear_table_day

D1, D2, D3 = WEEK
SCHEMA = "name string, n int, snapshot_date date"


def frame(spark, *rows):
    return spark.createDataFrame([(a, n, date.fromisoformat(d)) for a, n, d in rows], SCHEMA)


def content(table):
    return Counter((r["name"], r["n"], str(r["snapshot_date"])) for r in table.collect())


@pytest.fixture
def table(spark, tmp_path):
    name = f"sinks_{uuid.uuid4().hex}"
    create_day_table(spark, name, frame(spark).schema, f"{tmp_path}/it's a table")
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


# Catalog tables


def test_days_of_a_catalog_table_are_replaced_and_cleared(spark, table):
    first = frame(spark, ("a", 1, D1), ("b", 2, D1), ("b", 2, D1), ("c", 3, D2), (None, None, D3))
    assert insert_days(first, table, [D1, D2, D3]) == {D1: 3, D2: 1, D3: 1}
    assert content(spark.table(table)) == content(first)

    # Other column order, one day new, one emptied, one not named.
    turned = frame(spark, ("z", 9, D1)).select("snapshot_date", "n", "name")
    assert insert_days(turned, table, [D1, D2]) == {D1: 1, D2: 0}
    assert content(spark.table(table)) == Counter([("z", 9, D1), (None, None, D3)])


def test_an_insert_may_read_its_own_table(spark, table):
    insert_days(frame(spark, ("a", 1, D1), ("b", 2, D1), ("c", 3, D2)), table, [D1, D2])
    insert_days(spark.table(table).where("n <> 1"), table, [D1, D2])
    assert content(spark.table(table)) == Counter([("b", 2, D1), ("c", 3, D2)])
    insert_days(spark.table(table).where("n > 5"), table, [D2])
    assert content(spark.table(table)) == Counter([("b", 2, D1)])


def test_no_days_and_no_rows_change_nothing(spark, table):
    insert_days(frame(spark, ("a", 1, D1)), table, [D1])
    assert insert_days(frame(spark), table, []) == {}
    assert insert_days(frame(spark), table, [D2]) == {D2: 0}
    assert content(spark.table(table)) == Counter([("a", 1, D1)])


def test_a_write_without_counts_clears_only_what_is_empty(spark, table, monkeypatch):
    from sluicework.sources import catalog_tables

    insert_days(frame(spark, ("a", 1, D1), ("c", 3, D2)), table, [D1, D2])
    monkeypatch.setattr(catalog_tables, "observed", lambda observation: None)
    assert insert_days(frame(spark, ("d", 4, D1)), table, [D1, D2]) == {D1: 1, D2: 0}
    assert content(spark.table(table)) == Counter([("d", 4, D1)])


class Place:
    """A source folder and the two layers below a temporary folder."""

    def __init__(self, spark, base):
        self.spark, self.base = spark, base
        self.bronze, self.silver = f"{base}/bronze", f"{base}/silver"

    def land(self, contract, day, rows):
        write_drop(self.base / "source" / contract.name, day, rows)
        source = str(self.base / "source" / contract.name)
        run_bronze(self.spark, contract, source, day, self.bronze)

    def refine(self, contract, day, **options):
        source = f"{self.bronze}/{contract.name}"
        return run_silver(self.spark, contract, source, day, self.silver, **options)

    def table(self, contract):
        path = f"{self.silver}/{contract.name}"
        return read_table(self.spark, path, contract.table_schema)


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, tmp_path)


def same_rows(left, right):
    return Counter(left.collect()) == Counter(right.select(*left.columns).collect())


@pytest.mark.parametrize("whole_table", [False, True])
def test_a_catalog_table_follows_the_jobs(spark, place, tmp_path, whole_table):
    for contract, rows_of in ((PLAYS, week_plays), (USERS, week_users)):
        name = f"published_{uuid.uuid4().hex}"
        create_day_table(spark, name, contract.table_schema, f"{tmp_path}/{name}")
        options = {"whole_table": whole_table} if contract.is_dimension else {}
        for day in (*WEEK, D2):
            place.land(contract, day, rows_of(day))
            place.refine(contract, day, publish=name, **options)
            assert same_rows(place.table(contract), spark.table(name))
        spark.sql(f"DROP TABLE {name}")


def test_publishing_all_days_clears_those_that_are_gone(spark, place, table, tmp_path):
    place.land(PLAYS, D1, week_plays(D1))
    place.refine(PLAYS, D1)
    name = f"published_{uuid.uuid4().hex}"
    create_day_table(spark, name, PLAYS.table_schema, f"{tmp_path}/{name}")
    publish_days(spark, PLAYS, f"{place.silver}/plays", name)
    assert spark.table(name).count() == place.table(PLAYS).count() > 0
    assert set(publish_days(spark, PLAYS, f"{tmp_path}/nothing", name).values()) == {0}
    assert spark.table(name).count() == 0
    spark.sql(f"DROP TABLE {name}")


# Days swapped by a journal


class Crash(Exception):
    pass


def days_table(spark, path):
    return spark.read.schema(frame(spark).schema).parquet(path)


@pytest.mark.parametrize("step", ["touch", "delete", "rename"])
def test_a_swap_that_dies_anywhere_changes_nothing_or_is_finished(
    spark, tmp_path, monkeypatch, step
):
    """Dies at the first, second, ... call of one kind of file work, until it no longer dies."""
    old = frame(spark, ("a", 1, D1), ("b", 2, D2), ("c", 3, D3))
    new = frame(spark, ("A", 10, D1), ("C", 30, D3))  # and nothing on the second day
    real, seen = getattr(storage, step), set()
    for fatal in range(1, 20):
        path = f"{tmp_path}/{step}-{fatal}"
        DaySwap(spark, path).replace(old, list(WEEK))
        calls = []

        def dying(*given, calls=calls, fatal=fatal):
            calls.append(given)
            if len(calls) >= fatal:
                raise Crash
            return real(*given)

        monkeypatch.setattr(storage, step, dying)
        died = True
        try:
            DaySwap(spark, path).replace(new, list(WEEK))
            died = False
        except Crash:
            pass
        monkeypatch.undo()
        DaySwap(spark, path).finish_earlier()
        found = content(days_table(spark, path))
        assert found in (content(old), content(new))
        seen.add("old" if found == content(old) else "new")
        assert not storage.children(spark, f"{path}/_swap")
        if not died:
            assert found == content(new)
            break
    else:
        raise AssertionError("never got through")
    assert "new" in seen


def test_a_swap_may_read_its_table_and_refuses_other_days(spark, tmp_path):
    path = f"{tmp_path}/t"
    DaySwap(spark, path).replace(frame(spark, ("a", 1, D1), ("b", 2, D1), ("c", 3, D2)), [D1, D2])
    DaySwap(spark, path).replace(days_table(spark, path).where("n = 2"), [D1])
    assert content(days_table(spark, path)) == Counter([("b", 2, D1), ("c", 3, D2)])
    with pytest.raises(ValueError, match=D3):
        DaySwap(spark, path).replace(frame(spark, ("x", 1, D1), ("y", 2, D3)), [D1])
    assert content(days_table(spark, path)) == Counter([("b", 2, D1), ("c", 3, D2)])
    assert not storage.children(spark, f"{path}/_swap")


@pytest.mark.parametrize("moves", [0, 1])
def test_the_next_dimension_load_finishes_a_dead_one(spark, place, monkeypatch, moves):
    for day in WEEK:
        place.land(USERS, day, week_users(day))
    place.refine(USERS, D1)
    place.refine(USERS, D2)
    real, done = storage.rename, []

    def dying(spark, source, target):
        if "/_swap/" in source:
            if len(done) == moves:
                raise Crash
            done.append(source)
        return real(spark, source, target)

    monkeypatch.setattr(storage, "rename", dying)
    with pytest.raises(Crash):
        place.refine(USERS, D3)
    monkeypatch.undo()
    place.refine(USERS, D3)  # finishes the dead run, and has nothing to add

    other = Place(spark, place.base / "other")
    for day in WEEK:
        other.land(USERS, day, week_users(day))
        other.refine(USERS, day)
    drop = ("bronze_ingested_at", "source_file")
    assert same_rows(place.table(USERS).drop(*drop), other.table(USERS).drop(*drop))


# Reserved surrogates


def test_a_reservation_follows_the_table_and_the_running_loads(spark, tmp_path):
    path, stored = f"{tmp_path}/t", [40]
    one, two, three = (KeyReservation(spark, path, lambda: stored[0]) for _ in range(3))
    assert one(0) == 40
    assert one(10) == 40
    assert two(5) == 50
    assert one(1) == 55  # a second run of the same load
    stored[0] = 56
    one.close()
    assert three(2) == 56
    two.close()
    three.close()
    # All are over: the table alone decides, also when it has shrunk.
    stored[0] = 7
    assert KeyReservation(spark, path, lambda: stored[0])(3) == 7


def test_who_looked_too_early_looks_again(spark, tmp_path):
    path, stored = f"{tmp_path}/t", [0]
    slow, quick = (KeyReservation(spark, path, lambda: stored[0]) for _ in range(2))
    slow.look()
    assert quick(100) == 0
    stored[0] = 100
    quick.close()  # over, so only the number and the table tell of it
    assert slow(5) == 100


def test_a_reservation_without_a_range_is_given_up(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    reservation = KeyReservation(spark, path, lambda: 3)
    storage.touch(spark, f"{reservation.root}/r0000000001")
    monkeypatch.setattr(reservations, "WRITE_SECONDS", 0.2)
    assert reservation(4) == 3
    assert KeyReservation(spark, path, lambda: 3)(1) == 7
    # And a load that is dead holds its run until its time is over.
    monkeypatch.setattr(reservations, "LEASE_SECONDS", -1)
    assert KeyReservation(spark, path, lambda: 3)(1) == 3


def test_entries_that_are_over_go_but_the_last(spark, tmp_path):
    path = f"{tmp_path}/t"
    for n in range(4):
        with KeyReservation(spark, path, lambda n=n: n) as reservation:
            assert reservation(1) == n
    assert storage.children(spark, f"{path}_reserved") == ["r0000000004", "r0000000004.over"]


def test_two_loads_side_by_side_have_disjoint_dense_keys(spark, place, monkeypatch):
    n = 40
    days = {D1: 0, D2: n}
    for day, first in days.items():
        rows = [play(str(90_000 + first + i), f"{day}T08:{i:02d}:00") for i in range(n)]
        place.land(PLAYS, day, rows)
    # Both have looked before either reserves.
    met, look = Barrier(2, timeout=120), KeyReservation.look

    def together(self):
        first = self._seen is None and not hasattr(self, "met")
        look(self)
        if first:
            self.met = True
            met.wait()

    monkeypatch.setattr(KeyReservation, "look", together)
    with ThreadPoolExecutor(2) as side:
        reports = list(side.map(lambda day: place.refine(PLAYS, day), days))
    assert [r["rows"] for r in reports] == [n, n]
    monkeypatch.undo()
    keys = {}
    for row in place.table(PLAYS).collect():
        keys.setdefault(str(row["snapshot_date"]), []).append(row["play_sk"])
    assert sorted(keys[D1] + keys[D2]) == list(range(1, 2 * n + 1))
    for found in keys.values():
        assert max(found) - min(found) == n - 1
    # A third load meets all keys of both.
    place.land(PLAYS, D3, [play(str(90_000 + i), f"{D3}T08:00:00") for i in range(2 * n + 3)])
    report = place.refine(PLAYS, D3)
    assert (report["rows"], report["elsewhere"]) == (3, 2 * n)


def test_a_copy_in_use_is_not_swept(spark, tmp_path):
    path = f"{tmp_path}/t"
    DaySwap(spark, path).replace(frame(spark, ("a", 1, D1), ("b", 2, D2)), [D1, D2])

    def copy():
        return KeyedCopy(spark, path, frame(spark).schema, "name", ["n"])

    with copy() as reader, copy() as other:
        reader.sync()
        rows = reader.frame()
        DaySwap(spark, path).replace(frame(spark, ("a", 7, D1), ("b", 8, D2)), [D1, D2])
        other.sync()
        assert {r["n"] for r in rows.collect()} == {1, 2}
        assert {r["n"] for r in other.frame().collect()} == {7, 8}
    with copy() as last:
        last.sync()
        assert {r["n"] for r in last.frame().collect()} == {7, 8}
        assert len(storage.children(spark, last.folder, "_segment=*")) == 1


def test_a_segment_leaves_the_writes_of_other_loads_alone(spark, tmp_path):
    path = f"{tmp_path}/t"
    DaySwap(spark, path).replace(frame(spark, ("a", 1, D1)), [D1])
    with KeyedCopy(spark, path, frame(spark).schema, "name", ["n"]) as copy:
        copy.sync()
        # A file that a task of a load beside this one has in the making.
        making = f"{copy.folder}/_temporary/0/_temporary/attempt/part-0"
        storage.touch(spark, making)
        DaySwap(spark, path).replace(frame(spark, ("a", 7, D1), ("b", 8, D2)), [D1, D2])
        copy.sync()
        assert storage.exists(spark, making)
        assert {r["n"] for r in copy.frame().collect()} == {7, 8}


def test_a_load_that_ends_meanwhile_is_no_error(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    DaySwap(spark, path).replace(frame(spark, ("a", 1, D1)), [D1])
    children = storage.children

    def ended(session, folder, *pattern):
        gone = ["ended"] if folder.endswith("_users") else []
        return children(session, folder, *pattern) + gone

    monkeypatch.setattr(storage, "children", ended)
    with KeyedCopy(spark, path, frame(spark).schema, "name", ["n"]) as copy:
        copy.sync()
        assert {r["n"] for r in copy.frame().collect()} == {1}


def test_clearing_the_last_day_leaves_a_day_in_the_making(spark, tmp_path):
    path = f"{tmp_path}/t"
    storage.touch(spark, f"{path}/.spark-staging-1/part-0")
    storage.touch(spark, f"{path}/snapshot_date={D1}/part-0")
    clear_table_day(spark, path, D1)
    assert storage.exists(spark, f"{path}/.spark-staging-1/part-0")
    assert not storage.exists(spark, f"{path}/snapshot_date={D1}")
    storage.delete(spark, f"{path}/.spark-staging-1")
    clear_table_day(spark, path, D1)
    assert not storage.exists(spark, path)
