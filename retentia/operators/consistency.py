"""Cross-column consistency of customer rows: repair them, or name what other columns determine."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.functions.scalars import any_of, null_if

# Fixed value: the text that stands for "no value" in form input.
NO_VALUE = "(ninguno)"


@dataclass(frozen=True)
class Switch:
    """When ``source`` is "No", the other columns have these values."""

    source: str
    values: Mapping[str, object]


@dataclass(frozen=True)
class Floor:
    """A lower bound that holds while ``source`` is "Yes", or always without a source."""

    column: str
    minimum: float
    source: str | None = None


@dataclass(frozen=True)
class ConsistencyRules:
    """The defaults are fixed values."""

    switches: tuple[Switch, ...] = (
        Switch(
            "internet_service",
            {
                "internet_type": None,
                "online_security": "No",
                "online_backup": "No",
                "device_protection_plan": "No",
                "premium_tech_support": "No",
                "streaming_tv": "No",
                "streaming_movies": "No",
                "streaming_music": "No",
                "unlimited_data": "No",
                "avg_monthly_gb_download": 0,
            },
        ),
        Switch(
            "phone_service",
            {
                "multiple_lines": "No",
                "avg_monthly_long_distance_charges": 0.0,
                "total_long_distance_charges": 0.0,
            },
        ),
        Switch("dependents", {"number_of_dependents": 0}),
        Switch("referred_a_friend", {"number_of_referrals": 0}),
    )
    floors: tuple[Floor, ...] = (
        Floor("number_of_referrals", 1, "referred_a_friend"),
        Floor("number_of_dependents", 1, "dependents"),
        Floor("avg_monthly_long_distance_charges", 1.0, "phone_service"),
        Floor("total_long_distance_charges", 1.0, "phone_service"),
        Floor("avg_monthly_gb_download", 1, "internet_service"),
        Floor("monthly_charge", 18.55),
        Floor("total_charges", 18.80),
        Floor("total_revenue", 21.36),
    )
    age: str = "age"
    under_30: str = "under_30"


def _switched(rules: ConsistencyRules, column: str, present: set[str], current: Column, dtype) -> Column:
    for switch in rules.switches:
        if column in switch.values and switch.source in present:
            fixed = F.lit(switch.values[column]).cast(dtype)
            current = F.when(F.col(switch.source) == "No", fixed).otherwise(current)
    return current


def _floored(rules: ConsistencyRules, column: str, present: set[str], current: Column, dtype) -> Column:
    for floor in rules.floors:
        if floor.column != column:
            continue
        low = current < floor.minimum
        if floor.source is not None:
            if floor.source not in present:
                continue
            low = low & (F.col(floor.source) == "Yes")
        current = F.when(low, F.lit(floor.minimum).cast(dtype)).otherwise(current)
    return current


def _repaired(df: DataFrame, rules: ConsistencyRules) -> list[tuple[str, Column]]:
    present = set(df.columns)
    out = []
    for f in df.schema:
        current = F.col(f.name)
        current = _switched(rules, f.name, present, current, f.dataType)
        current = _floored(rules, f.name, present, current, f.dataType)
        if f.name == rules.under_30 and rules.age in present:
            age = F.col(rules.age)
            current = F.when(age.isNull(), current).when(age < 30, "Yes").otherwise("No")
        out.append((f.name, current))
    return out


def repair(df: DataFrame, rules: ConsistencyRules = ConsistencyRules()) -> DataFrame:
    """Apply switches, then floors, then the age flag. Running it twice changes nothing more.

    One projection; rules about columns the frame does not have are skipped, nulls stay null.
    """
    return df.select(*[c.alias(name) for name, c in _repaired(df, rules)])


def inconsistent(df: DataFrame, rules: ConsistencyRules = ConsistencyRules()) -> Column:
    """True for a row that ``repair`` would change."""
    return any_of([~F.col(name).eqNullSafe(c) for name, c in _repaired(df, rules)])


def determined_fields(df: DataFrame, rules: ConsistencyRules = ConsistencyRules(), column: str = "determined") -> DataFrame:
    """Add the sorted names of the columns that the row's other values fix."""
    present = set(df.columns)
    names: list[Column] = [F.array(F.lit(rules.under_30))]
    for switch in rules.switches:
        if switch.source in present:
            fixed = F.array(*[F.lit(n) for n in sorted(switch.values)])
            names.append(F.when(F.col(switch.source) == "No", fixed).otherwise(F.array().cast("array<string>")))
    return df.withColumn(column, F.array_sort(F.concat(*names)))


def clear_sentinel(df: DataFrame, columns: list[str] | None = None, sentinel: str = NO_VALUE) -> DataFrame:
    """Turn the "no value" text into null."""
    chosen = set(columns if columns is not None else [f.name for f in df.schema if f.dataType.simpleString() == "string"])
    return df.select(*[null_if(F.col(c), sentinel).alias(c) if c in chosen else F.col(c) for c in df.columns])
