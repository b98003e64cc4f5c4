"""Declared table contracts: column set, types, nulls, domains, ranges, unique key.

Every rule is a boolean column expression, so a whole contract is checked in one pass, and the same
expressions serve the violation report, the per-row error list and the quarantine split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.functions.scalars import any_of


class ContractViolation(ValueError):
    """The data does not meet its contract."""


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "string"
    nullable: bool = False
    allowed: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    unique: bool = False


@dataclass(frozen=True)
class Contract:
    fields: tuple[Field, ...]

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def subset(self, names: Sequence[str]) -> Contract:
        return Contract(tuple(f for f in self.fields if f.name in set(names)))

    def renamed(self, mapping: dict[str, str]) -> Contract:
        return Contract(
            tuple(
                Field(mapping.get(f.name, f.name), f.type, f.nullable, f.allowed, f.low, f.high, f.unique)
                for f in self.fields
            )
        )


def request_name(column: str) -> str:
    """The snake_case name of a raw column in scoring requests."""
    return column.lower().replace(" ", "_")


def with_original_names(df: DataFrame, contract: Contract) -> DataFrame:
    """Accept either spelling of each contract column and return the original one."""
    return df.withColumnsRenamed({request_name(n): n for n in contract.names if request_name(n) in df.columns})


def with_request_names(df: DataFrame, contract: Contract) -> DataFrame:
    return df.withColumnsRenamed({n: request_name(n) for n in contract.names if n in df.columns})


def column_differences(df: DataFrame, contract: Contract) -> tuple[list[str], list[str]]:
    """(columns that are missing, columns that the contract does not have), in order. Runs no job."""
    return [n for n in contract.names if n not in df.columns], [c for c in df.columns if c not in contract.names]


def check_columns(df: DataFrame, contract: Contract) -> None:
    """The column set is closed: a missing or an extra column is an error. Runs no job."""
    missing, extra = column_differences(df, contract)
    if missing or extra:
        raise ContractViolation(f"missing columns {missing}, unexpected columns {extra}")


INTEGERS = ("tinyint", "smallint", "int", "bigint")
# What the casts may take; other texts are not tried, since a cast that fails raises an error inside, which costs far more than the match.
WHOLE = r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*$"
WITH_EXPONENT = r"^[\x00-\x20]*[+-]?[\p{Nd}.]+[eE][+-]?\p{Nd}+[\x00-\x20]*$"


def _typed(field: Field, kind: str | None = None) -> Column:
    """The column in its declared type, null where a value does not fit; ``kind`` is the type it has now, if known."""
    raw = F.col(f"`{field.name}`")
    if kind == field.type:
        return raw
    if field.type != "bigint":
        return raw.try_cast(field.type)
    if kind in INTEGERS:
        return raw.cast("bigint")
    # A whole number may be written with a zero fraction, as a column that once held gaps is, or with an exponent. The text's own
    # digits decide: a cast would round a fraction away. Most values pass the plain cast and go no further.
    text = raw.cast("string")
    zero_fraction = F.when(text.rlike(r"^\s*[+-]?\d+\.0*\s*$"), F.regexp_replace(text, r"\.0*\s*$", "").try_cast("bigint"))
    number = text.try_cast("decimal(38,18)")
    exponent = F.when(text.rlike(WITH_EXPONENT) & (number == F.floor(number)), number.try_cast("bigint"))
    return F.coalesce(F.when(text.rlike(WHOLE), text.try_cast("bigint")), zero_fraction, exponent)


def coerce(df: DataFrame, contract: Contract) -> DataFrame:
    """Columns in contract order and type; values that do not fit become null."""
    kinds = dict(df.dtypes)
    return df.select(*[_typed(f, kinds.get(f.name)).alias(f.name) for f in contract.fields])


def _rules(contract: Contract, kinds: Mapping[str, str], values: Sequence[tuple[Column, Column]]) -> list[tuple[str, str, Column]]:
    """The rules on each field's column as it is and in its declared type."""
    rules = []
    for f, (raw, typed) in zip(contract.fields, values, strict=True):
        if f.type != "string":
            fits = kinds.get(f.name) == f.type
            rules.append(("type", f.name, F.lit(False) if fits else raw.isNotNull() & typed.isNull()))
        if not f.nullable:
            rules.append(("not_null", f.name, raw.isNull()))
        if f.allowed:
            rules.append(("allowed", f.name, typed.isNotNull() & ~typed.isin(*f.allowed)))
        if f.low is not None:
            rules.append(("min", f.name, typed < F.lit(f.low)))
        if f.high is not None:
            rules.append(("max", f.name, typed > F.lit(f.high)))
    return rules


def _values(contract: Contract, kinds: Mapping[str, str]) -> list[tuple[Column, Column]]:
    return [(F.col(f"`{f.name}`"), _typed(f, kinds.get(f.name))) for f in contract.fields]


def row_rules(contract: Contract, df: DataFrame) -> list[tuple[str, str, Column]]:
    """(rule, column, "is violated") for every rule that one row of ``df`` can break."""
    kinds = dict(df.dtypes)
    return _rules(contract, kinds, _values(contract, kinds))


def with_errors(df: DataFrame, contract: Contract, column: str = "errors") -> DataFrame:
    """Add the ``rule:column`` names a row breaks, as an array that is empty for a clean row.

    Built from text because ``concat_ws`` skips nulls; a higher-order filter over that many rules
    takes the optimizer minutes.
    """
    marks = [F.when(bad, F.lit(f"{rule}:{name}")) for rule, name, bad in row_rules(contract, df)]
    return df.withColumn(column, F.array_remove(F.split(F.concat_ws("\n", *marks), "\n"), ""))


def is_broken(contract: Contract, df: DataFrame) -> Column:
    """True for a row of ``df`` that breaks any rule."""
    return F.coalesce(any_of([bad for _, _, bad in row_rules(contract, df)]), F.lit(False))


def quarantine(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(clean rows in contract type, broken rows with their errors)."""
    broken = is_broken(contract, df)
    return coerce(df.where(~broken), contract), with_errors(df.where(broken), contract)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row counts."""
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """One row (rule, column, n_violations) per rule of the contract, zero counts included.

    All row rules are counted in one aggregation that shuffles one row per task. Each value is cast once for all its rules.
    """
    kinds = dict(df.dtypes)
    typed = [column for i, (raw, value) in enumerate(_values(contract, kinds)) for column in (raw.alias(f"raw{i}"), value.alias(f"typed{i}"))]
    rules = _rules(contract, kinds, [(F.col(f"raw{i}"), F.col(f"typed{i}")) for i in range(len(contract.fields))])
    row = df.select(*typed).agg(*[F.count_if(bad).alias(f"v{i}") for i, (_, _, bad) in enumerate(rules)])
    entries = [
        F.struct(F.lit(rule).alias("rule"), F.lit(name).alias("column"), F.col(f"v{i}").alias("n_violations"))
        for i, (rule, name, _) in enumerate(rules)
    ]
    report = row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    for name in [f.name for f in contract.fields if f.unique]:
        repeats = duplicate_keys(df.select(name).where(F.col(f"`{name}`").isNotNull()), [name])
        count = F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).cast("bigint")
        report = report.unionByName(
            repeats.agg(count.alias("n_violations")).select(F.lit("unique").alias("rule"), F.lit(name).alias("column"), "n_violations")
        )
    return report


def enforce(df: DataFrame, contract: Contract) -> DataFrame:
    """The coerced frame, or an error that lists every broken rule. Runs one job."""
    check_columns(df, contract)
    broken = violations(df, contract).where("n_violations > 0").orderBy("rule", "column").collect()
    if broken:
        raise ContractViolation(", ".join(f"{r['rule']}:{r['column']} ({r['n_violations']})" for r in broken))
    return coerce(df, contract)


def unknown_values(df: DataFrame, column: str, known: DataFrame, known_column: str) -> DataFrame:
    """Values of ``column`` outside the known domain, with their row counts.

    Values are counted first, so the anti join sees one row per distinct value.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    return counted.join(known.select(F.col(known_column).alias(column)).distinct(), column, "left_anti")


def known_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values; the scan reads this column only."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


YES_NO = ("Yes", "No")


def _yes_no(name: str) -> Field:
    return Field(name, allowed=YES_NO)


# The 50 raw customer columns with their types, domains and bounds.
CUSTOMER_CONTRACT = Contract(
    (
        Field("Customer ID", unique=True),
        Field("Gender", allowed=("Male", "Female")),
        Field("Age", "bigint", low=0, high=120),
        _yes_no("Under 30"),
        _yes_no("Senior Citizen"),
        _yes_no("Married"),
        _yes_no("Dependents"),
        _yes_no("Referred a Friend"),
        _yes_no("Phone Service"),
        _yes_no("Multiple Lines"),
        _yes_no("Internet Service"),
        _yes_no("Online Security"),
        _yes_no("Online Backup"),
        _yes_no("Device Protection Plan"),
        _yes_no("Premium Tech Support"),
        _yes_no("Streaming TV"),
        _yes_no("Streaming Movies"),
        _yes_no("Streaming Music"),
        _yes_no("Unlimited Data"),
        _yes_no("Paperless Billing"),
        _yes_no("Churn Label"),
        Field("Number of Dependents", "bigint", low=0),
        Field("Country"),
        Field("State"),
        Field("City"),
        Field("Zip Code", "bigint"),
        Field("Latitude", "double"),
        Field("Longitude", "double"),
        Field("Population", "bigint", low=0),
        Field("Quarter"),
        Field("Number of Referrals", "bigint", low=0),
        Field("Tenure in Months", "bigint", low=0),
        Field("Offer", nullable=True, allowed=("Offer A", "Offer B", "Offer C", "Offer D", "Offer E")),
        Field("Avg Monthly Long Distance Charges", "double", low=0),
        Field("Internet Type", nullable=True, allowed=("Cable", "DSL", "Fiber Optic")),
        Field("Avg Monthly GB Download", "bigint", low=0),
        Field("Contract", allowed=("Month-to-Month", "One Year", "Two Year")),
        Field("Payment Method", allowed=("Bank Withdrawal", "Credit Card", "Mailed Check")),
        Field("Monthly Charge", "double"),
        Field("Total Charges", "double", low=0),
        Field("Total Refunds", "double", low=0),
        Field("Total Extra Data Charges", "bigint", low=0),
        Field("Total Long Distance Charges", "double", low=0),
        Field("Total Revenue", "double", low=0),
        Field("Satisfaction Score", "bigint", low=1, high=5),
        Field("Customer Status", allowed=("Churned", "Joined", "Stayed")),
        Field("Churn Score", "bigint", low=0, high=100),
        Field("CLTV", "bigint", low=0),
        Field("Churn Category", nullable=True, allowed=("Attitude", "Competitor", "Dissatisfaction", "Other", "Price")),
        Field("Churn Reason", nullable=True),
    )
)
