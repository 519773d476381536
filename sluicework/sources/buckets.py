"""A narrow copy of a stored table, kept in buckets of its key, to be joined without a shuffle."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import defaultdict
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluicework.contracts import DAY
from sluicework.functions.columns import quoted
from sluicework.sources import storage
from sluicework.sources.writers import stored_path

SEGMENT = "_segment"
_MARKS = "_days"
# A file per context that uses the copy, beside it; after so long its load is taken for dead.
_USERS = "_users"
LEASE_SECONDS = 7 * 24 * 3600
# Rows of a bucket are joined in one task.
BUCKET_BYTES = 256 << 20
LEAST_BUCKETS = 8
# More live segments than this are merged.
MOST_SEGMENTS = 8


class KeyedCopy:
    """Some columns of a table stored by day, in buckets of ``key``, beside the table.

    Spark plans a join on the key with no exchange of this side, since files of one bucket hold all
    rows of their keys' hashes.  The copy consists of segments, each written at once with the days
    that were new or had changed.  An empty file per day, named ``day~digest~segment``, tells which
    segment has a day's rows and of which files of the table: a day whose files are other ones by
    now is copied again, whoever wrote them, and a crash leaves nothing that a later ``sync`` would
    trust.  Segments are merged when they become many, the small ones first, so a row is rewritten
    about as often as the logarithm of their number.

    Use it as a context: bucketed files are read through a table of the session catalog, which goes
    when the context ends; the files stay.  Of several contexts side by side none removes files, as
    another one may be reading or writing them; a later one does.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        key: str,
        columns: list[str],
        where: str | None = None,
        name: str = "keys",
    ) -> None:
        self._spark, self._path, self._schema = spark, path, schema
        self._key, self._where = key, where
        self._columns = [key, *columns, DAY]
        self.root = f"{path}_{name}"
        self._table = ""
        self._buckets = 0
        self._marks: dict[str, tuple[str, str]] = {}  # day: (digest, segment)
        self._user = ""

    def __enter__(self) -> KeyedCopy:
        self._user = uuid.uuid4().hex
        storage.touch(self._spark, f"{self.root}{_USERS}/{self._user}")
        return self

    def __exit__(self, *_: object) -> None:
        storage.delete(self._spark, f"{self.root}{_USERS}/{self._user}")
        self._forget()

    def _alone(self) -> bool:
        users = f"{self.root}{_USERS}"
        for other in storage.children(self._spark, users):
            if other == self._user:
                continue
            age = storage.age(self._spark, f"{users}/{other}")
            if age is None:  # ended since the listing
                continue
            if age < LEASE_SECONDS:
                return False
            storage.delete(self._spark, f"{users}/{other}")
        return True

    def _forget(self) -> None:
        if self._table:
            self._spark.sql(f"DROP TABLE IF EXISTS {self._table}")
            self._table = ""

    @property
    def folder(self) -> str:
        return f"{self.root}/b{self._buckets:08d}"

    def _open(self, buckets: int) -> None:
        """The catalog's table over the folder of so many buckets."""
        self._forget()
        self._buckets = buckets
        self._table = self._bucketed(
            self.folder, f", {SEGMENT} string", f" PARTITIONED BY ({SEGMENT})"
        )
        if storage.children(self._spark, self.folder, f"{SEGMENT}=*"):
            self._spark.sql(f"ALTER TABLE {self._table} RECOVER PARTITIONS")

    def _bucketed(self, folder: str, more: str = "", parted: str = "") -> str:
        """A table of the session catalog over files in buckets of the key."""
        name = f"sluicework_{uuid.uuid4().hex}"
        types = {f.name: f.dataType.simpleString() for f in self._schema}
        columns = ", ".join(f"{quoted(c)} {types[c]}" for c in self._columns)
        key, location = quoted(self._key), folder.replace("'", "\\'")
        self._spark.sql(
            f"CREATE TABLE {name} ({columns}{more}) USING parquet{parted}"
            f" CLUSTERED BY ({key}) SORTED BY ({key})"
            f" INTO {self._buckets} BUCKETS LOCATION '{location}'"
        )
        return name

    def _sources(self) -> dict[str, str]:
        """A digest of the names of each stored day's files; names are never used twice."""
        if not storage.exists(self._spark, self._path):
            return {}
        stored = self._spark.read.schema(self._schema).parquet(
            stored_path(self._spark, self._path)
        )
        files = defaultdict(list)
        for file in stored.inputFiles():
            found = re.search(rf"/{DAY}=([^/]+)/([^/]+)$", file)
            files[found[1]].append(found[2])
        return {
            day: hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest()[:16]
            for day, names in files.items()
        }

    def _read_marks(self) -> list[tuple[str, str, str]]:
        names = storage.children(self._spark, f"{self.folder}/{_MARKS}")
        return [tuple(name.split("~")) for name in names]

    def _wanted_buckets(self, now: int) -> int:
        """As many as the copy needs; it is rebuilt only when four times as many are."""
        held = 0
        if now:
            # Segments with a mark are whole; others may be in the making.
            segments = {segment for _, _, segment in self._read_marks()}
            held = sum(
                storage.tree_size(self._spark, f"{self.folder}/{SEGMENT}={s}") for s in segments
            )
        # Before there is a copy: a fourth of the table.
        held = held or storage.tree_size(self._spark, self._path) // 4
        wanted = LEAST_BUCKETS
        while wanted * BUCKET_BYTES < held:
            wanted *= 2
        return wanted if not now or wanted >= 4 * now else now

    def sync(self) -> list[str]:
        """Bring the copy up to the table; returns the days that were copied."""
        spark = self._spark
        sources = self._sources()
        folders = [int(name[1:]) for name in storage.children(spark, self.root, "b*")]
        self._buckets = max(folders, default=0)
        buckets = self._wanted_buckets(self._buckets)
        if buckets != self._buckets or not self._table:
            self._open(buckets)
        marks = self._read_marks()
        self._marks = {day: (d, s) for day, d, s in marks if sources.get(day) == d}
        stale = sorted(set(sources) - set(self._marks))
        if stale:
            self._copy(stale, sources)
        self._drop_marks([mark for mark in marks if self._marks.get(mark[0]) != mark[1:]])
        if len(self._segments()) > MOST_SEGMENTS:
            self._merge()
        self._drop_dead(folders)
        return stale

    def _segments(self) -> dict[str, list[date]]:
        """The days whose rows are to be read from each segment."""
        found = defaultdict(list)
        for day, (_, segment) in sorted(self._marks.items()):
            found[segment].append(date.fromisoformat(day))
        return found

    def _write(self, rows: DataFrame, days: dict[str, str]) -> None:
        segment = uuid.uuid4().hex
        # A write commits by way of a folder below its table's; a table of the segment's own keeps
        # that apart from the ones of loads side by side.
        table = self._bucketed(f"{self.folder}/{SEGMENT}={segment}")
        try:
            (
                rows.select(*map(quoted, self._columns))
                .repartition(self._buckets, F.col(quoted(self._key)))
                .write.insertInto(table)
            )
        finally:
            self._spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._spark.sql(f"ALTER TABLE {self._table} ADD PARTITION ({SEGMENT} = '{segment}')")
        for day, digest in days.items():
            storage.touch(self._spark, f"{self.folder}/{_MARKS}/{day}~{digest}~{segment}")
            self._marks[day] = digest, segment

    def _copy(self, stale: list[str], sources: dict[str, str]) -> None:
        stored = self._spark.read.schema(self._schema).parquet(
            stored_path(self._spark, self._path)
        )
        rows = stored.where(F.col(DAY).isin([date.fromisoformat(d) for d in stale]))
        if self._where:
            rows = rows.where(self._where)
        self._write(rows, {day: sources[day] for day in stale})

    def _merge(self) -> None:
        """One segment out of the smallest ones, up to the first that outweighs all before it."""
        sizes = {
            segment: storage.tree_size(self._spark, f"{self.folder}/{SEGMENT}={segment}")
            for segment in self._segments()
        }
        ascending = sorted(sizes, key=lambda s: (sizes[s], s))
        take, weight = 0, 0
        while take < len(ascending) and (take < 2 or sizes[ascending[take]] <= weight):
            weight += sizes[ascending[take]]
            take += 1
        old = {
            day: mark for day, mark in self._marks.items() if mark[1] in ascending[:take]
        }
        self._write(self._rows(ascending[:take]), {day: digest for day, (digest, _) in old.items()})
        self._drop_marks([(day, *mark) for day, mark in old.items()])

    def _drop_marks(self, marks: list[tuple[str, ...]]) -> None:
        for mark in marks:
            storage.delete(self._spark, f"{self.folder}/{_MARKS}/{'~'.join(mark)}")

    def _drop_dead(self, folders: list[int]) -> None:
        found = storage.children(self._spark, self.folder, f"{SEGMENT}=*")
        # Asked after the listing: who starts later has none of these segments.
        if not self._alone():
            return
        # Read after that: who has just ended has left its marks.
        live = {f"{SEGMENT}={segment}" for _, _, segment in self._read_marks()}
        for name in found:
            if name not in live:
                storage.delete(self._spark, f"{self.folder}/{name}")
        for other in folders:
            if other != self._buckets:
                storage.delete(self._spark, f"{self.root}/b{other:08d}")

    def _rows(self, segments: list[str]) -> DataFrame:
        days = self._segments()
        tests = [(F.col(SEGMENT) == s) & F.col(DAY).isin(days[s]) for s in segments]
        rows = self._spark.table(self._table).where(reduce(or_, tests, F.lit(False)))
        return rows.select(*map(quoted, self._columns))

    def frame(self) -> DataFrame:
        """The key, the copied columns and the day, as of the last ``sync``."""
        return self._rows(list(self._segments()))
