"""Aggregates that come out of a write for free."""

from __future__ import annotations

from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation


def observed(observation: Observation) -> dict[str, Any] | None:
    """The metrics of an observation placed directly under a write; None if it gave none.

    When adaptive execution finds at run time that nothing is left to write, it drops the plan
    and the observation with it.  None is no proof of that: the caller looks at what it wrote.
    """
    try:
        return observation.get
    except Py4JJavaError as error:
        if "AssertionError" not in error.java_exception.toString():
            raise
        return None
