"""Runs of surrogate keys that are given to one load each, also when loads run side by side."""

from __future__ import annotations

import re
import time
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from sluicework.sources import storage

# An entry's text is written within so many seconds of its creation, or its load gives it up.
WRITE_SECONDS = 60.0
# A load that has not ended after so long is taken for dead.
LEASE_SECONDS = 7 * 24 * 3600
_ENTRY = "r"
_OVER = ".over"


class KeyReservation:
    """The keys after all that are stored or given to a load still running.

    Beside the table is a numbered entry per reservation, which can be created once and has the last
    key of its run as text.  A load looks at the entries, then at the highest stored key, and creates
    the next number; when another load has created it meanwhile, it looks again.  So whoever gets
    a number knows all runs given before.  An entry is marked as over when its load has ended: then
    its rows are stored, or never will be, and what is stored decides alone.  Keys are therefore
    dense as long as no load dies; after one that was killed they go on behind its run.

    It needs a store whose create-without-overwrite is atomic, as HDFS.  Use it as a context; called
    with a number of rows it gives the key before the first of their run.
    """

    def __init__(self, spark: SparkSession, path: str, highest: Callable[[], int]) -> None:
        self._spark, self._highest = spark, highest
        self.root = f"{path}_reserved"
        self._seen: tuple[int, int] | None = None  # last number, last key
        self._taken: list[str] = []

    def __enter__(self) -> KeyReservation:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def _entries(self) -> tuple[list[int], set[int]]:
        """All numbers in order, and those that are over."""
        names = storage.children(self._spark, self.root, f"{_ENTRY}[0-9]*")
        over = {int(n[1 : -len(_OVER)]) for n in names if n.endswith(_OVER)}
        return [int(n[1:]) for n in names if re.fullmatch(rf"{_ENTRY}\d+", n)], over

    def _path(self, number: int) -> str:
        return f"{self.root}/{_ENTRY}{number:010d}"

    def _end(self, number: int) -> int:
        """The last key of a run, 0 when its load has ended or is dead."""
        entry = self._path(number)
        try:
            while True:
                age = storage.age(self._spark, entry)
                if age is None or age >= LEASE_SECONDS:
                    break
                text = storage.read_text(self._spark, entry)
                if text:
                    return int(text)
                if age > WRITE_SECONDS:
                    break
                time.sleep(0.05)
        except Py4JJavaError:
            if storage.exists(self._spark, entry):
                raise
        return 0

    def look(self) -> None:
        """Take note of the reservations and of the highest stored key, in this order: a load that
        is over by the first has its rows stored by the second."""
        numbers, over = self._entries()
        given = max((self._end(n) for n in numbers if n not in over), default=0)
        self._seen = max(numbers, default=0), max(given, self._highest())

    def __call__(self, count: int) -> int:
        while True:
            if self._seen is None:
                self.look()
            number, top = self._seen
            if not count:
                return top
            self._seen = None
            began = time.monotonic()
            entry = self._path(number + 1)
            if storage.create_new(self._spark, entry, str(top + count)):
                if time.monotonic() - began < WRITE_SECONDS / 2:
                    self._taken.append(entry)
                    return top
                storage.touch(self._spark, entry + _OVER)

    def close(self) -> None:
        """Mark what was taken as over; entries that are over go, but never the last number."""
        for entry in self._taken:
            storage.touch(self._spark, entry + _OVER)
        self._taken = []
        numbers, over = self._entries()
        for number in numbers[:-1]:
            if number in over:
                storage.delete(self._spark, self._path(number))
                storage.delete(self._spark, self._path(number) + _OVER)
