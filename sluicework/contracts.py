"""Table contracts: the one place that says what a table looks like and which rules it obeys."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import lru_cache

from pyspark.sql.types import StructType

# Names that stored tables share.
DAY = "snapshot_date"
CORRUPT = "_corrupt_record"
REASON = "error_reason"
STAGE = "error_stage"


@lru_cache
def _schema(*columns: tuple[str, str]) -> StructType:
    # Columns stay nullable: file readers ignore the flag, so "required" is a rule instead.
    named = ((name.replace("`", "``"), kind) for name, kind in columns)
    return StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in named))


@dataclass(frozen=True)
class Field:
    """A business column.  One with ``derived`` SQL over the raw text is not in the drop."""

    name: str
    type: str
    required: bool = True
    derived: str | None = None


@dataclass(frozen=True)
class Rule:
    """A named reason and the SQL predicate over typed columns that marks a row as bad."""

    reason: str
    bad_when: str


@dataclass(frozen=True)
class TableContract:
    """Everything the generic operators need to know about one table.

    ``newest_first`` are SQL expressions; the row that is largest by them wins a
    de-duplication.  A table with ``tracked`` columns is a dimension kept as type-2
    history, every other table holds facts.
    """

    name: str
    key: str
    fields: tuple[Field, ...]
    newest_first: tuple[str, ...]
    surrogate: str
    checks: tuple[Rule, ...] = ()
    tracked: tuple[str, ...] = ()
    effective_from: str | None = None
    timestamp: str = "timestamp"

    @property
    def is_dimension(self) -> bool:
        return bool(self.tracked)

    @property
    def raw_names(self) -> list[str]:
        return [f.name for f in self.fields if f.derived is None]

    @property
    def rules(self) -> list[Rule]:
        """Null rules of the required drop columns in column order, then the table's own checks."""
        nulls = [
            Rule(f"null_{f.name}", f"`{f.name.replace('`', '``')}` IS NULL")
            for f in self.fields
            if f.required and f.derived is None
        ]
        return [*nulls, *self.checks]

    @property
    def drop_schema(self) -> StructType:
        """What is read from a JSON line: text columns plus the corrupt-line column."""
        return _schema(*[(n, "string") for n in [*self.raw_names, CORRUPT]])

    @property
    def bronze_schema(self) -> StructType:
        return _schema(
            *[(n, "string") for n in self.raw_names], *self._provenance("ingested_at")
        )

    @property
    def silver_schema(self) -> StructType:
        """Typed columns, before any surrogate key."""
        return _schema(*self._curated())

    @property
    def table_schema(self) -> StructType:
        """The curated table as stored."""
        extra = [(self.surrogate, "bigint")]
        if self.is_dimension:
            extra += [
                ("valid_from", self.timestamp),
                ("valid_to", self.timestamp),
                ("is_current", "boolean"),
            ]
        return _schema(*self._curated(), *extra)

    @property
    def error_schema(self) -> StructType:
        return _schema(*self._curated(), (REASON, "string"), (STAGE, "string"))

    def _curated(self) -> list[tuple[str, str]]:
        return [(f.name, f.type) for f in self.fields] + self._provenance("bronze_ingested_at")

    def _provenance(self, arrival: str) -> list[tuple[str, str]]:
        return [(arrival, self.timestamp), ("source_file", "string"), (DAY, "date")]

    def with_types(self, types: dict[str, str], **changes: object) -> TableContract:
        """The same contract on other column types, e.g. ``{"int": "bigint"}`` for wider keys."""
        fields = tuple(replace(f, type=types.get(f.type, f.type)) for f in self.fields)
        clock = types.get(self.timestamp, self.timestamp)
        return replace(self, fields=fields, timestamp=clock, **changes)


# Columns, types, rules and orders of the two tables.

PLAYS = TableContract(
    name="plays",
    key="play_id",
    fields=(
        Field("play_id", "int"),
        Field("user_id", "int"),
        Field("content_id", "int"),
        Field("device_id", "int"),
        Field("played_at", "timestamp"),
        Field("event_date", "date", derived="try_cast(played_at AS date)"),
        Field("created_at", "timestamp"),
        Field(
            "late_arriving_data",
            "boolean",
            derived="try_cast(created_at AS date) > try_cast(played_at AS date)",
        ),
        Field("ms_played", "int"),
    ),
    checks=(Rule("non_positive_ms_played", "ms_played <= 0"),),
    newest_first=("bronze_ingested_at", "created_at", "source_file"),
    surrogate="play_sk",
)

USERS = TableContract(
    name="users",
    key="user_id",
    fields=(
        Field("user_id", "int"),
        Field("email", "string"),
        Field("country", "string"),
        Field("plan_tier", "string"),
        Field("created_at", "timestamp"),
        Field("updated_at", "timestamp", required=False),
    ),
    newest_first=("coalesce(updated_at, created_at)", "bronze_ingested_at", "source_file"),
    surrogate="customer_sk",
    tracked=("email", "country", "plan_tier"),
    effective_from="coalesce(updated_at, created_at)",
)

TABLES = {contract.name: contract for contract in (PLAYS, USERS)}
