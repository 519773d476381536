"""SQL expressions built from a contract: safe casts, reason text, change tests.

They are SQL text, which Spark parses in one call, rather than trees of Column objects, which cost
a round trip to the JVM per node.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from sluicework.contracts import Rule, TableContract

SEPARATOR = "; "


def quoted(name: str) -> str:
    """A column's name in SQL text, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def literal(value: str) -> str:
    """A text literal in SQL."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


@dataclass(frozen=True)
class Cast:
    """One curated column: its name, its raw value and that value safely cast."""

    name: str
    raw: str
    typed: str
    can_fail: bool

    @property
    def unreadable(self) -> str:
        """Text was given, but it does not read as the wanted type."""
        return f"(({self.raw}) IS NOT NULL AND {self.typed} IS NULL)"


def casts(contract: TableContract) -> list[Cast]:
    """The curated columns as expressions over a bronze frame."""
    sources = {f.name: f.derived or quoted(f.name) for f in contract.fields}
    sources["bronze_ingested_at"] = "ingested_at"
    business = {f.name for f in contract.fields}
    found = []
    for field in contract.silver_schema.fields:
        raw = sources.get(field.name, quoted(field.name))
        typed = f"try_cast({raw} AS {field.dataType.simpleString()})"
        # Text stays text, and provenance is typed before it gets here.
        can_fail = field.name in business and field.dataType.simpleString() != "string"
        found.append(Cast(field.name, raw, typed, can_fail))
    return found


def any_of(conditions: Iterable[str]) -> str:
    return " OR ".join(conditions) or "false"


def reasons(cases: Iterable[tuple[str, str]]) -> str:
    """The reasons whose condition holds, joined in the given order."""
    parts = [f"CASE WHEN {condition} THEN {literal(reason)} END" for reason, condition in cases]
    return f"concat_ws({literal(SEPARATOR)}, {', '.join(parts)})" if parts else "''"


def unreadable(columns: list[Cast]) -> str:
    return any_of(c.unreadable for c in columns if c.can_fail)


def cast_reasons(columns: list[Cast]) -> str:
    return reasons((f"cast_error_{c.name}", c.unreadable) for c in columns if c.can_fail)


def rule_reasons(rules: list[Rule]) -> str:
    return reasons((r.reason, r.bad_when) for r in rules)


def breaks_a_rule(rules: list[Rule]) -> str:
    # A predicate that is unknown (null operand) is not a breach.
    return any_of(f"coalesce({r.bad_when}, false)" for r in rules)


def differs(pairs: Iterable[tuple[str, str]]) -> str:
    """Null-safe: null against null is the same, null against a value is a change."""
    return any_of(f"NOT ({quoted(left)} <=> {quoted(right)})" for left, right in pairs)
