"""Validation rules as column expressions.

A rule is a path, a condition and the words of its complaint. ``errors_of`` gives the complaints
of a row as an array, empty for a valid row. Nothing here looks at more than one row.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrid.functions import values as V


@dataclass(frozen=True)
class Rule:
    path: str
    holds: Column
    problem: str
    applies: Column | None = None

    def only_if(self, condition: Column) -> Rule:
        applies = condition if self.applies is None else condition & self.applies
        return Rule(self.path, self.holds, self.problem, applies)

    def complaint(self) -> Column:
        broken = ~F.coalesce(self.holds, F.lit(False))
        if self.applies is not None:
            broken = F.coalesce(self.applies, F.lit(False)) & broken
        return F.when(broken, F.lit(f"{self.path}: {self.problem}"))


def complaints_of(rules: Iterable[Rule]) -> Column:
    """All complaints as one text, a line each; empty if there are none."""
    return F.concat_ws("\n", *[r.complaint() for r in rules])


def complaint_list(complaints: Column) -> Column:
    return F.when(complaints == "", F.array().cast("array<string>")).otherwise(
        F.split(complaints, "\n"))


def errors_of(rules: Iterable[Rule]) -> Column:
    return complaint_list(complaints_of(rules))


# --- single fields ----------------------------------------------------------------------
def given(path: str) -> Rule:
    return Rule(path, F.col(path).isNotNull(), "missing or of the wrong type")


def equals(path: str, value) -> Rule:
    return Rule(path, F.col(path) == F.lit(value), f"must be {value}")


def one_of(path: str, values: Iterable[str]) -> Rule:
    return Rule(path, F.col(path).isin(*values), f"must be one of {', '.join(values)}")


def matches(path: str, pattern: str, what: str) -> Rule:
    return Rule(path, F.col(path).rlike(pattern), f"must be {what}")


def semver(path: str) -> Rule:
    return matches(path, V.SEMVER, "a semantic version")


def uuid(path: str) -> Rule:
    return matches(path, V.UUID, "a UUID")


def positive(path: str) -> Rule:
    return Rule(path, F.col(path) > 0, "must be a positive integer")


def within(path: str, low: int, high: int) -> Rule:
    return Rule(path, F.col(path).between(low, high), f"must be an integer {low} to {high}")


def zoned_time(path: str) -> Rule:
    text = F.col(path)
    return Rule(path, text.rlike(V.ZONED_TIMESTAMP) & zoned_timestamp(text).isNotNull(),
                "must be a timestamp with an offset")


def zoned_timestamp(text: Column) -> Column:
    return F.upper(text).try_cast("timestamp")


# --- fields kept as variants so that their JSON type can be checked -----------------------
def _json_type(value: Column) -> Column:
    return F.schema_of_variant(value)


def text_given(path: str) -> Rule:
    return Rule(path, _json_type(F.col(path)) == "STRING", "must be a text")


def optional(path: str, json_type: str, what: str) -> Rule:
    kind = _json_type(F.col(path))
    holds = F.col(path).isNull() | (kind == "VOID") | kind.startswith(json_type)
    return Rule(path, holds, f"must be {what} or absent")


def variant_text(path: str) -> Column:
    return F.try_variant_get(F.col(path), "$", "string")


def variant_long(path: str) -> Column:
    return F.try_variant_get(F.col(path), "$", "bigint")


def variant_json(path: str) -> Column:
    """JSON text of a variant; a JSON null gives null."""
    return F.when(_json_type(F.col(path)) != "VOID", F.to_json(F.col(path)))


def text_matches(path: str, pattern: str, what: str) -> Rule:
    holds = (_json_type(F.col(path)) == "STRING") & variant_text(path).rlike(pattern)
    return Rule(path, holds, f"must be {what}")


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
