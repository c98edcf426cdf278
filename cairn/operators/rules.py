"""Rules that decide or decline, with the grounds of each cell kept as rows.

A rule maps a record's view to outcomes, not to values: a struct of value, evidence_basis,
source_field, source_value, unresolved_reason and manual_override.  A declined cell has a reason and
a blank value; a cell that is blank because a rule found so has neither.  Projected rows are the
primary table, and the wide table is a pivot of them.

Rules are Column expressions over the view's columns, so all of them run in one pass over it,
without a shuffle and without Python in the tasks.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OUTCOME = ("value", "evidence_basis", "source_field", "source_value", "unresolved_reason", "manual_override")


def _text(x) -> Column:
    return F.coalesce(x.cast("string"), F.lit("")) if isinstance(x, Column) else F.lit(str(x))


def decide(value, basis: str, field: str = "", source="", override: bool = False) -> Column:
    """An outcome with a value (blank if that is what was found) and its grounds."""
    return F.struct(_text(value).alias("value"), F.lit(basis).alias("evidence_basis"), F.lit(field).alias("source_field"), _text(source).alias("source_value"), F.lit("").alias("unresolved_reason"), F.lit(override).alias("manual_override"))


def decline(reason, field: str = "", source="") -> Column:
    """An outcome without a value, and why."""
    return F.struct(F.lit("").alias("value"), F.lit("").alias("evidence_basis"), F.lit(field).alias("source_field"), _text(source).alias("source_value"), _text(reason).alias("unresolved_reason"), F.lit(False).alias("manual_override"))


def ladder(*steps: tuple[Column, Column], otherwise: Column) -> Column:
    """The outcome of the first condition that holds."""
    out = F.when(*steps[0])
    for condition, outcome in steps[1:]:
        out = out.when(condition, outcome)
    return out.otherwise(otherwise)


@dataclass(frozen=True)
class Implementation:
    key: str
    parameters: frozenset[str]
    bases: frozenset[str]
    fields: tuple[str, ...]
    function: Callable[[Mapping[str, object]], Mapping[str, Column] | Column]


class Registry:
    """Implementations by key; a catalog binds them to columns with versions and parameters."""

    def __init__(self):
        self.implementations: dict[str, Implementation] = {}

    def rule(self, key: str, parameters: Sequence[str] = (), bases: Sequence[str] = (), fields: Sequence[str] = ()):
        def register(f):
            if key in self.implementations:
                raise ValueError(f"implementation {key} is registered twice")
            self.implementations[key] = Implementation(key, frozenset(parameters), frozenset(bases), tuple(fields), f)
            return f

        return register

    def bind(self, catalog: Sequence[Mapping]) -> list[BoundRule]:
        """The catalog's active rules; raises unless catalog and code match exactly."""
        if not catalog:
            raise ValueError("the catalog is empty: nothing would be checked")
        active = [r for r in catalog if r["status"] == "active"]
        named, known = {r["implementation"] for r in active}, set(self.implementations)
        if named != known:
            raise ValueError(f"rules without code: {sorted(named - known)}; code without rules: {sorted(known - named)}")
        columns: set[str] = set()
        for r in active:
            if not re.fullmatch(r"R-[A-Z0-9][A-Z0-9_-]*", r["rule_id"]) or not re.fullmatch(r"\d+\.\d+\.\d+", r["rule_version"]):
                raise ValueError(f"bad rule id or version: {r['rule_id']} {r['rule_version']}")
            impl = self.implementations[r["implementation"]]
            if set(r["parameters"]) != impl.parameters:
                raise ValueError(f"{r['rule_id']} must have exactly the parameters {sorted(impl.parameters)}")
            missing = [v for v in leaves(r["parameters"]) if v not in r["description"]]
            if missing:
                raise ValueError(f"{r['rule_id']}: its description does not state {missing}")
            for field in impl.fields or (r["field_name"],):
                if field in columns:
                    raise ValueError(f"two active rules for {field}")
                columns.add(field)
        return [BoundRule(r["rule_id"], r["field_name"], r["parameters"], self.implementations[r["implementation"]]) for r in active]


@dataclass(frozen=True)
class BoundRule:
    rule_id: str
    field: str
    parameters: Mapping
    implementation: Implementation

    def outcomes(self) -> dict[str, Column]:
        got = self.implementation.function(self.parameters)
        return dict(got) if isinstance(got, Mapping) else {self.field: got}


def leaves(x) -> list[str]:
    """The scalar leaves of nested parameters, as text."""
    if isinstance(x, Mapping):
        return [v for y in x.values() for v in leaves(y)]
    if isinstance(x, (list, tuple)):
        return [v for y in x for v in leaves(y)]
    return [str(x)]


def project(views: DataFrame, rules: Sequence[BoundRule], key: str) -> DataFrame:
    """One row per record and column: (key, canonical_field, final_value, winning_rule_id, grounds)."""
    cells = []
    for r in rules:
        got = r.outcomes()
        if r.implementation.fields and set(got) != set(r.implementation.fields):
            raise ValueError(f"{r.rule_id} must give exactly the columns {r.implementation.fields}")
        cells += [F.struct(F.lit(field).alias("canonical_field"), F.lit(r.rule_id).alias("winning_rule_id"), o.alias("o")) for field, o in got.items()]
    rows = views.select(key, F.explode(F.array(*cells)).alias("c"))
    return rows.select(key, "c.canonical_field", F.col("c.o.value").alias("final_value"), "c.winning_rule_id", *[F.col(f"c.o.{x}").alias(x) for x in OUTCOME[1:]])


def violations(projected: DataFrame, rules: Sequence[BoundRule], key: str) -> DataFrame:
    """(key, canonical_field, problem): values of declined cells, and grounds that no rule declares."""
    declared = [F.lit(f"{r.rule_id}|{b}") for r in rules for b in r.implementation.bases]
    stated = F.concat_ws("|", "winning_rule_id", "evidence_basis")
    problem = F.when((F.col("unresolved_reason") != "") & (F.col("final_value") != ""), "declined cell has a value").when((F.col("unresolved_reason") == "") & ~stated.isin(*declared), "undeclared basis")
    return projected.select(key, "canonical_field", problem.alias("problem")).filter("problem is not null")


def widen(projected: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """The wide table: one row per record, blank where its rule declined."""
    return projected.groupBy(key).pivot("canonical_field", list(fields)).agg(F.first("final_value"))


def decision_status(applied: Column, without: Column, with_: Column, decided: Column, excluded: Column, has_column: Column, active: Column) -> Column:
    """What a decision did, from the cell with and without it."""
    return (
        F.when(~active, "not_active")
        .when(excluded & applied, "exclusion_not_effective")
        .when(excluded, "exclusion_verified")
        .when(~applied, "subject_not_in_corpus")
        .when(~has_column, "no_canonical_column")
        .when(with_ != decided, "overridden_by_rule")
        .when(without == with_, "applied_unchanged")
        .when(without == "", "applied_filled_unresolved")
        .otherwise("applied_changed")
    )


class VacuousCheck(ValueError):
    """A check that examined nothing."""


def require_clean(found: DataFrame, examined: DataFrame, name: str) -> None:
    """Raise if a check found a violation, or had no rows to examine."""
    if not examined.limit(1).count():
        raise VacuousCheck(f"{name} examined no rows")
    first = found.limit(3).collect()
    if first:
        raise AssertionError(f"{name}: {[r.asDict() for r in first]}")
