"""The data contract of model input: rules as data, compiled to column expressions.

One pass over a table gives every row the list of rules it breaks. The same compiled rules serve
batches and streams.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise.functions.scalar import state_code

# Fixed values.
STATE_CODES = [
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA",
    "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
]
LAT_RANGE = (-34, 6)
LNG_RANGE = (-74, -34)
SELLERS_RANGE = (1, 20)
ITEMS_RANGE = (1, 100)
WEIGHT_RANGE = (0, 500_000)
ESTIMATE_RANGE = (0, 200)


@dataclass(frozen=True)
class Field:
    """One contract column: its type and at most one check on the value."""

    name: str
    kind: str
    one_of: tuple[str, ...] | None = None
    between: tuple[float, float] | None = None
    above: float | None = None
    at_least: float | None = None

    def read(self, df: DataFrame) -> Column:
        """The value in the declared type, null where it cannot be converted."""
        if self.name not in df.columns:
            return F.lit(None).cast(self.kind)
        source = df.schema[self.name].dataType
        value = F.col(self.name)
        if self.kind == "bigint" and isinstance(source, (T.DoubleType, T.FloatType, T.DecimalType)):
            # A fraction in a whole-number column is a violation, not something to cut off.
            return F.when(value == F.floor(value), value.try_cast("bigint"))
        value = value.try_cast(self.kind)
        return F.when(~F.isnan(value), value) if self.kind == "double" else value

    def broken(self) -> tuple[str, Column] | None:
        """Name of the value check and the condition of breaking it (null for a null value)."""
        value = F.col(self.name)
        if self.one_of is not None:
            return "membership", ~value.isin(*self.one_of)
        if self.between is not None:
            return "range", ~value.between(*self.between)
        if self.above is not None:
            return "range", ~(value > self.above)
        if self.at_least is not None:
            return "range", ~(value >= self.at_least)
        return None


CONTRACT = [
    Field("customer_state", "string", one_of=tuple(STATE_CODES)),
    Field("seller_state", "string", one_of=tuple(STATE_CODES)),
    Field("customer_lat", "double", between=LAT_RANGE),
    Field("customer_lng", "double", between=LNG_RANGE),
    Field("seller_lat", "double", between=LAT_RANGE),
    Field("seller_lng", "double", between=LNG_RANGE),
    Field("n_sellers", "bigint", between=SELLERS_RANGE),
    Field("n_items", "bigint", between=ITEMS_RANGE),
    Field("total_price", "double", above=0),
    Field("total_freight", "double", at_least=0),
    Field("total_weight_g", "double", between=WEIGHT_RANGE),
    Field("estimated_delivery_days", "bigint", between=ESTIMATE_RANGE),
    Field("order_purchase_timestamp", "timestamp"),
]
CONTRACT_COLUMNS = [f.name for f in CONTRACT]
COORDINATES = ["customer_lat", "seller_lat"]


class ContractError(ValueError):
    """A table breaks the contract, so nothing may be trained or judged on it."""


def missing_columns(df: DataFrame, fields: list[Field] = CONTRACT) -> list[str]:
    return [f.name for f in fields if f.name not in df.columns]


def check(
    df: DataFrame, fields: list[Field] = CONTRACT, form_input: bool = False, payload: bool = False
) -> DataFrame:
    """Coerce the contract columns and add ``violations``: which rule each column of the row breaks.

    Rules: ``required`` (absent column or null), ``coercion``, ``membership``, ``range``. Other columns
    pass through. ``form_input`` cleans state codes typed into a web form first. ``payload`` keeps the
    values as they came, as JSON text.
    """
    if form_input:
        states = [f.name for f in fields if f.one_of and f.name in df.columns]
        df = df.withColumns({c: state_code(c) for c in states})
    raw = {f.name: F.col(f.name).cast("string") if f.name in df.columns else F.lit(None).cast("string") for f in fields}
    prepared = df.withColumns({f"_raw_{name}": text for name, text in raw.items()})
    if payload:
        given = F.struct(*[F.col(f"_raw_{f.name}").alias(f.name) for f in fields])
        prepared = prepared.withColumn("payload", F.to_json(given, {"ignoreNullFields": "false"}))
    prepared = prepared.withColumns({f.name: f.read(df) for f in fields})

    found = []
    for f in fields:
        given = F.col(f"_raw_{f.name}")
        # A NaN read from a file is a missing value, not a bad number.
        missing = given.isNull() | (given == "NaN") if f.kind == "double" else given.isNull()
        rule = F.when(missing, "required").when(F.col(f.name).isNull(), "coercion")
        broken = f.broken()
        if broken:
            rule = rule.when(broken[1], broken[0])
        found.append(
            F.when(rule.isNotNull(), F.struct(F.lit(f.name).alias("column"), rule.alias("rule"), given.alias("value")))
        )
    violations = F.filter(F.array(*found), lambda v: v.isNotNull())
    return prepared.withColumn("violations", violations).drop(*[f"_raw_{f.name}" for f in fields])


def is_valid() -> Column:
    return F.size("violations") == 0


def contract_only(checked: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Only the contract columns: identifiers and the target never reach a model. ``keep`` adds some back."""
    return checked.select(*keep, *[c for c in CONTRACT_COLUMNS if c not in keep])


def drop_unlocated(df: DataFrame) -> DataFrame:
    """Rows without coordinates leave a batch before the contract; a single request is rejected instead."""
    return df.na.drop(subset=COORDINATES)


def violation_rows(checked: DataFrame, key: str) -> DataFrame:
    """One row per broken rule."""
    return checked.select(key, F.inline("violations"))


def violation_counts(checked: DataFrame) -> DataFrame:
    """All failures of a table by column and rule."""
    return checked.select(F.inline("violations")).groupBy("column", "rule").agg(F.count("*").alias("n_rows"))


def table_verdict(checked: DataFrame) -> DataFrame:
    """One row: number of rows, number of bad rows, and whether the table passes."""
    return checked.agg(
        F.count("*").alias("n_rows"), F.coalesce(F.sum((~is_valid()).cast("bigint")), F.lit(0)).alias("n_bad")
    ).withColumn("passes", F.col("n_bad") == 0)


def require_valid(df: DataFrame, drop_missing_points: bool = True) -> DataFrame:
    """Check a whole table and stop with :class:`ContractError` when any row is bad."""
    absent = missing_columns(df)
    if absent:
        raise ContractError(f"missing columns: {', '.join(absent)}")
    checked = check(drop_unlocated(df) if drop_missing_points else df)
    verdict = table_verdict(checked).first()
    if not verdict["passes"]:
        # At most one row per column and rule.
        worst = violation_counts(checked).orderBy(F.desc("n_rows"), "column", "rule").collect()
        detail = "; ".join(f"{r['column']}: {r['rule']} in {r['n_rows']} rows" for r in worst)
        raise ContractError(f"{verdict['n_bad']} of {verdict['n_rows']} rows are bad: {detail}")
    return checked.drop("violations")


def route(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split checked rows into accepted and quarantined ones; the latter keep their reasons."""
    return checked.where(is_valid()).drop("violations"), checked.where(~is_valid())


def reasons() -> Column:
    """The violations of a row as one line of text."""
    line = lambda v: F.concat(v["column"], F.lit(": "), v["rule"], F.lit(" ("), F.coalesce(v["value"], F.lit("null")), F.lit(")"))
    return F.array_join(F.transform("violations", line), "; ")


# The faults planted into a sample of good rows, by 0-based row number.
FAULTS = {
    3: ("order_purchase_timestamp", "not-a-date"),
    4: ("total_weight_g", "-500.0"),
    20: ("customer_lat", "40.0"),
    30: ("n_items", "abc"),
    34: ("total_price", None),
    42: ("customer_state", "XX"),
    47: ("seller_state", None),
}


def plant_faults(rows: DataFrame, row_number: str) -> DataFrame:
    """Break one column in each of the numbered rows; all contract columns become text."""
    out = {}
    for name in CONTRACT_COLUMNS:
        value = F.col(name).cast("string")
        for number, (column, bad) in FAULTS.items():
            if column == name:
                value = F.when(F.col(row_number) == number, F.lit(bad).cast("string")).otherwise(value)
        out[name] = value
    return rows.withColumns(out)


