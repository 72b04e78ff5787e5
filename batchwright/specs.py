"""Table specifications: schema, load strategy, key and change columns.

A table is declared once.  The registry is validated before any batch is
touched, so an unknown strategy or a change column missing from the schema
fails up front instead of silently skipping a table.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql.types import StructType

SCD = "scd"
APPEND = "append"
TRUNCATE = "truncate_load"
FULL = "full_load"
STRATEGIES = (SCD, APPEND, TRUNCATE, FULL)

# Columns the loads add to the declared schema.
START_DATE = "start_date"
END_DATE = "end_date"
BATCHED_AT = "batched_at"


class SpecError(ValueError):
    """The registry or a table spec is inconsistent."""


class UnknownTableError(KeyError):
    """A batch holds a folder for which no table is declared."""


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: str
    load: str = FULL
    primary_key: str | None = None
    change_columns: tuple[str, ...] = ()
    file_name: str | None = None
    target_table: str | None = None

    @property
    def struct(self) -> StructType:
        return StructType.fromDDL(self.schema)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.struct.fields]

    @property
    def target(self) -> str:
        return self.target_table or self.name

    @property
    def added_columns(self) -> tuple[str, ...]:
        if self.load == SCD:
            return (START_DATE, END_DATE)
        if self.load in (APPEND, TRUNCATE):
            return (BATCHED_AT,)
        return ()

    @property
    def output_columns(self) -> list[str]:
        return self.columns + list(self.added_columns)

    def validate(self) -> TableSpec:
        if self.load not in STRATEGIES:
            raise SpecError(f"{self.name}: unknown load strategy {self.load!r}; expected one of {STRATEGIES}")
        try:
            cols = self.columns
        except Exception as exc:  # bad DDL text
            raise SpecError(f"{self.name}: schema does not parse: {exc}") from exc
        clash = set(cols) & {START_DATE, END_DATE, BATCHED_AT}
        if clash:
            raise SpecError(f"{self.name}: schema already has reserved column(s) {sorted(clash)}")
        if self.load == SCD:
            if not self.primary_key:
                raise SpecError(f"{self.name}: scd load needs a primary_key")
            if not self.change_columns:
                raise SpecError(f"{self.name}: scd load needs change_columns")
            missing = [c for c in (self.primary_key, *self.change_columns) if c not in cols]
            if missing:
                raise SpecError(f"{self.name}: columns not in schema: {missing}")
            if self.primary_key in self.change_columns:
                raise SpecError(f"{self.name}: primary key cannot be a change column")
        return self


@dataclass(frozen=True)
class Registry:
    """Validated mapping ``table name -> TableSpec``."""

    specs: Mapping[str, TableSpec] = field(default_factory=dict)

    @classmethod
    def of(cls, specs: Iterable[TableSpec]) -> Registry:
        out: dict[str, TableSpec] = {}
        for spec in specs:
            if spec.name in out:
                raise SpecError(f"table {spec.name!r} declared twice")
            out[spec.name] = spec.validate()
        targets = [s.target for s in out.values()]
        dup = {t for t in targets if targets.count(t) > 1}
        if dup:
            raise SpecError(f"several tables write the same target: {sorted(dup)}")
        return cls(out)

    def __getitem__(self, name: str) -> TableSpec:
        try:
            return self.specs[name]
        except KeyError:
            raise UnknownTableError(f"no table declared for {name!r}; known: {sorted(self.specs)}") from None

    def __contains__(self, name: object) -> bool:
        return name in self.specs

    def __iter__(self):
        return iter(self.specs.values())

    def names(self) -> list[str]:
        return list(self.specs)

    def check_tables(self, names: Iterable[str]) -> None:
        unknown = sorted(set(names) - set(self.specs))
        if unknown:
            raise UnknownTableError(f"batch holds undeclared table folder(s) {unknown}")


def load_order(specs: Iterable[TableSpec]) -> list[TableSpec]:
    """Dimensions first, appended facts last.

    The fact table's high-water mark decides whether a batch is new, so it
    must be the last table a batch commits: a crash before it leaves the
    batch "not loaded" and a rerun completes the remaining tables.
    """
    rank = {FULL: 0, TRUNCATE: 0, SCD: 1, APPEND: 2}
    return sorted(specs, key=lambda s: (rank[s.load], s.name))
