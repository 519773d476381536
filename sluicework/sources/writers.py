"""Sinks: replace whole days, replace a whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluicework.contracts import DAY
from sluicework.functions.metrics import observed
from sluicework.sources import storage

# A table that was replaced as a whole lives in a folder per version.  The log has an entry per
# number, which only one run can create and which names that version's folder; the highest one that
# does is the table.
VERSION = "v"
LOG = "_versions"
# A run's mark while it writes a version; after so long it is taken for dead.
RUNNING = "_running"
LEASE_SECONDS = 7 * 24 * 3600


class CommitConflict(RuntimeError):
    """Another run has committed a version since this one read the table."""


def _overwrite_days(frame: DataFrame, path: str) -> None:
    (
        frame.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )


def clear_table_day(
    spark: SparkSession, path: str, day: str, keep_empty_table: bool = False
) -> None:
    """Remove a day, and a table that has nothing left unless it is to be kept.

    A load beside this one may be staging its own day below the path, which then stays.
    """
    storage.delete(spark, f"{path}/{DAY}={day}")
    if not keep_empty_table and not set(storage.children(spark, path)) - {"_SUCCESS"}:
        storage.delete(spark, path)


def _files(spark: SparkSession, path: str, day: str) -> set[str]:
    return set(storage.children(spark, f"{path}/{DAY}={day}"))


def replace_days(
    frame: DataFrame, path: str, days: list[str], keep_empty_table: bool = True
) -> dict[str, int]:
    """Make each of ``days`` hold exactly the rows of ``frame``, also when that is no row.

    The rows are counted while they are written.  A day that got none is cleared afterwards,
    never before: until the write is done the plan may still read the table.  Whether a day got
    rows is decided by its count, and where the write gave no counts by its files: a day that
    got rows has new ones only.  The frame must not hold other days.  Returns the rows per day.
    """
    spark = frame.sparkSession
    before = {day: _files(spark, path, day) for day in days}
    written = Observation()
    per_day = [
        F.count(F.when(F.col(DAY) == F.lit(d).cast("date"), True)).alias(d) for d in days
    ]
    _overwrite_days(frame.observe(written, *per_day), path)
    counts = observed(written)
    if counts is None:
        counts = {}
        for day in days:
            if _files(spark, path, day) - before[day]:
                counts[day] = spark.read.parquet(f"{path}/{DAY}={day}").count()
    rows = {day: counts.get(day, 0) for day in days}
    for day in [d for d, count in rows.items() if count == 0]:
        clear_table_day(spark, path, day, keep_empty_table)
    return rows


# Below a table: drops being landed, a folder each, named by day.
LANDING = "_landing"
_READY = "_ready"
_REPLACE, _CLEAR = "replace", "clear"


class Landing:
    """A day of several tables, staged below the first one and then moved into all of them.

    What is to be done is noted before anything is moved: an empty file per table, then the one that
    makes the notes valid.  A run that dies before that has changed nothing; one that dies later is
    finished by the next, for moving is repeatable: a staged folder that is gone has been moved.
    """

    def __init__(self, spark: SparkSession, tables: dict[str, str], day: str) -> None:
        self._spark, self._tables, self._day = spark, tables, day
        self._root = f"{next(iter(tables.values()))}/{LANDING}"
        self.folder = f"{self._root}/{day}-{uuid.uuid4().hex}"

    def finish_earlier(self) -> None:
        """Finish or drop what an earlier run for this day has left."""
        for name in storage.children(self._spark, self._root, f"{self._day}-*"):
            folder = f"{self._root}/{name}"
            if storage.exists(self._spark, f"{folder}/{_READY}"):
                self._move(folder)
            else:
                storage.delete(self._spark, folder)

    def commit(self, filled: set[str]) -> None:
        """Give every table its staged folder of this day, the others no row of it."""
        for name in self._tables:
            todo = _REPLACE if name in filled else _CLEAR
            storage.touch(self._spark, f"{self.folder}/{_READY}-{name}-{todo}")
        storage.touch(self._spark, f"{self.folder}/{_READY}")
        self._move(self.folder)

    def _move(self, folder: str) -> None:
        for position, (name, path) in enumerate(self._tables.items()):
            target, staged = f"{path}/{DAY}={self._day}", f"{folder}/{name}"
            if storage.exists(self._spark, f"{folder}/{_READY}-{name}-{_CLEAR}"):
                clear_table_day(self._spark, path, self._day, keep_empty_table=position == 0)
            elif storage.exists(self._spark, staged):
                storage.delete(self._spark, target)
                storage.make_folder(self._spark, path)
                storage.rename(self._spark, staged, target)
            self._spark.catalog.refreshByPath(path)
        storage.delete(self._spark, folder)


# Below a table, or the version that is the table: days being replaced together, a folder a load.
SWAP = "_swap"


class DaySwap:
    """Several days of one table, staged below it and then moved into it.

    A journal of empty files, one per day and then one that makes them valid, is written before
    anything is moved.  A load that dies before that has changed nothing.  One that dies later leaves
    some days old and some new, until the next load calls ``finish_earlier``: every staged folder
    that is still there is moved, whatever has become of the run that made it.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path
        self._root = f"{path}/{SWAP}"

    def finish_earlier(self) -> None:
        """Finish or drop what an earlier load has left."""
        for name in storage.children(self._spark, self._root):
            folder = f"{self._root}/{name}"
            if storage.exists(self._spark, f"{folder}/{_READY}"):
                self._move(folder)
            else:
                storage.delete(self._spark, folder)

    def replace(self, frame: DataFrame, days: list[str]) -> None:
        """Make each of ``days`` hold exactly the rows of ``frame``, also when that is no row.

        The frame may read the table.  Rows of another day raise, and nothing changes.
        """
        folder = f"{self._root}/{uuid.uuid4().hex}"
        try:
            frame.write.partitionBy(DAY).parquet(f"{folder}/days")
            staged = storage.children(self._spark, f"{folder}/days", f"{DAY}=*")
            filled = {name.partition("=")[2] for name in staged}
            if not filled <= set(days):
                raise ValueError(f"rows of other days: {sorted(filled - set(days))}")
        except Exception:
            storage.delete(self._spark, folder)
            raise
        for day in days:
            todo = _REPLACE if day in filled else _CLEAR
            storage.touch(self._spark, f"{folder}/{_READY}-{todo}-{day}")
        storage.touch(self._spark, f"{folder}/{_READY}")
        self._move(folder)

    def _move(self, folder: str) -> None:
        for note in storage.children(self._spark, folder, f"{_READY}-*"):
            todo, _, day = note[len(_READY) + 1 :].partition("-")
            target, staged = f"{self._path}/{DAY}={day}", f"{folder}/days/{DAY}={day}"
            if todo == _CLEAR:
                storage.delete(self._spark, target)
            elif storage.exists(self._spark, staged):
                storage.delete(self._spark, target)
                storage.rename(self._spark, staged, target)
        # The mark goes first: a folder that is half deleted must not look valid and half empty.
        storage.delete(self._spark, f"{folder}/{_READY}")
        storage.delete(self._spark, folder)
        self._spark.catalog.refreshByPath(self._path)


def _number(name: str) -> int:
    return int(name[len(VERSION) :].split("-")[0])


def _entries(spark: SparkSession, path: str) -> list[str]:
    return storage.children(spark, f"{path}/{LOG}", f"{VERSION}*")


def _committed(spark: SparkSession, path: str, entries: list[str]) -> str | None:
    """The folder of the last committed version.

    An entry without a name in it is being written, or its run has died just then.
    """
    for entry in reversed(entries):
        # Entries were once named like their folder.
        named = entry if "-" in entry else storage.read_text(spark, f"{path}/{LOG}/{entry}")
        if named:
            return named
    return None


def stored_path(spark: SparkSession, path: str) -> str:
    """Where the rows of a table are: its last committed version, else the path itself."""
    committed = _committed(spark, path, _entries(spark, path))
    return f"{path}/{committed}" if committed else path


def table_version(spark: SparkSession, path: str) -> int:
    """The number of the last log entry, 0 without one: what a later commit is based on."""
    return max(map(_number, _entries(spark, path)), default=0)


def remove_leftovers(spark: SparkSession, path: str) -> None:
    """Delete whatever is not the table: versions never committed or replaced, older entries, and
    the days from before the first version.  A version that another run is writing stays."""
    entries = _entries(spark, path)
    committed = _committed(spark, path, entries)
    if committed:
        for day in storage.children(spark, path, f"{DAY}=*"):
            storage.delete(spark, f"{path}/{day}")
    running = set()
    for mark in storage.children(spark, f"{path}/{RUNNING}"):
        age = storage.age(spark, f"{path}/{RUNNING}/{mark}")
        # One that is gone since the listing may have been committed since.
        if age is None or age < LEASE_SECONDS:
            running.add(mark)
        else:
            storage.delete(spark, f"{path}/{RUNNING}/{mark}")
    for version in storage.children(spark, path, f"{VERSION}[0-9]*"):
        if version != committed and version not in running:
            storage.delete(spark, f"{path}/{version}")
    for entry in entries[:-1]:
        if committed and _number(entry) < _number(committed):
            storage.delete(spark, f"{path}/{LOG}/{entry}")


def replace_table(frame: DataFrame, path: str, base: int | None = None) -> None:
    """Replace a partitioned table by ``frame``, which may read that table.

    The rows go to a new version's folder; the log entry that makes it the table is the creation
    of one file, so a reader and a crash see the old table or the new one.  ``base`` is the
    ``table_version`` the frame was made from, by default the one of now; when another run has
    committed on it meanwhile, ``CommitConflict`` is raised and nothing changes.  Old versions are
    removed after the commit, and again at the start of the next run.
    """
    spark = frame.sparkSession
    number = (table_version(spark, path) if base is None else base) + 1
    version = f"{VERSION}{number:010d}-{uuid.uuid4().hex}"
    mark = f"{path}/{RUNNING}/{version}"
    storage.touch(spark, mark)
    try:
        frame.write.partitionBy(DAY).parquet(f"{path}/{version}")
        commit_version(spark, path, version)
    except Exception:
        storage.delete(spark, f"{path}/{version}")
        storage.delete(spark, mark)
        raise
    storage.delete(spark, mark)
    remove_leftovers(spark, path)
    spark.catalog.refreshByPath(path)


def commit_version(spark: SparkSession, path: str, version: str) -> None:
    """Create the entry of the version's number, which can be done once."""
    entry = version.split("-")[0]
    if not storage.create_new(spark, f"{path}/{LOG}/{entry}", version):
        raise CommitConflict(f"{path}: another run has committed {entry}")
