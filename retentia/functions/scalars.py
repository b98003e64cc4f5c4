"""Column expressions used by several operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts a CSV reader of the data-science stack takes for a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def null_if_token(c: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return F.when(~c.isin(*tokens), c)


def null_if(c: Column, sentinel: str) -> Column:
    return F.nullif(c, F.lit(sentinel))


def yes_flag(c: Column) -> Column:
    """1 for "Yes", 0 for anything else including null."""
    return F.coalesce((c == "Yes").cast("int"), F.lit(0))


def lower_clip(c: Column, minimum: float | None) -> Column:
    return c if minimum is None else F.when(c < minimum, F.lit(minimum)).otherwise(c)


def lookup(c: Column, table: Mapping[str, object]) -> Column:
    """Config-sized lookup; an unknown key gives null."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])[c]


def remaining_months(term: Column, tenure: Column) -> Column:
    """Months left in the running contract cycle; a cycle just completed starts a full one."""
    into = F.pmod(tenure, term)
    return F.when(term <= 1, term).when(into == 0, term).otherwise(term - into)


def direction(value: Column) -> Column:
    return F.when(value > 0, F.lit("raises risk")).when(value.isNotNull(), F.lit("lowers risk"))


def segment_label(column: Column, value: Column) -> Column:
    return F.concat_ws("=", column, value)


def batch_name(intensity: Column) -> Column:
    return F.format_string("batch_intensity_%.2f", intensity)


def prefix_keys(m: Column, prefix: str) -> Column:
    return F.transform_keys(m, lambda k, _: F.concat(F.lit(prefix), k))


def merge_maps(left: Column, right: Column) -> Column:
    """Right side wins, whatever the session's duplicate-key policy is."""
    kept = F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k))
    return F.map_concat(kept, right)


def zip_to_map(names: Column, values: Column) -> Column:
    """Names to values by position; unequal lengths fail the job."""
    return F.map_from_arrays(names, values)


def any_of(conditions: Sequence[Column]) -> Column:
    result = F.lit(False)
    for condition in conditions:
        result = result | condition
    return result


def missing(c: Column, is_float: bool) -> Column:
    """Null, or NaN for floating columns."""
    return (c.isNull() | F.isnan(c)) if is_float else c.isNull()
