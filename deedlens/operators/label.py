"""Labels from rules and thresholds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named condition and the label of the rows it is the first to meet."""

    name: str
    condition: Column
    value: int


def label_rules(df: DataFrame, rules: Sequence[Rule], default: int, out: str = "is_fraud") -> DataFrame:
    """Label by the first rule that holds, and say in ``rule_id`` which one it was.

    A condition that is NULL does not hold.
    """
    label = F.when(rules[0].condition, F.lit(rules[0].value))
    fired = F.when(rules[0].condition, F.lit(rules[0].name))
    for rule in rules[1:]:
        label = label.when(rule.condition, F.lit(rule.value))
        fired = fired.when(rule.condition, F.lit(rule.name))
    return df.withColumns({out: label.otherwise(F.lit(default)), "rule_id": fired})


def any_missing(columns: Sequence[str]) -> Column:
    condition = F.col(columns[0]).isNull()
    for name in columns[1:]:
        condition = condition | F.col(name).isNull()
    return condition


def missing_any(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """0/1 indicator: at least one of ``columns`` is NULL."""
    return df.withColumn(out, any_missing(columns).cast("int"))


@dataclass(frozen=True)
class OwnershipRules:
    """Parameters of the suspicious-title rules."""

    # Default threshold and home country.
    high_price: int = 1_000_000
    home_country: str = "UK"
    price: str = "PricePaid"
    country: str = "CountryIncorporated1"
    names: tuple[str, ...] = ("ProprietorName1", "ProprietorName2")
    address: str = "Proprietor1Address1"
    missing_flag: str = "missing_proprietor_name"

    def rules(self) -> list[Rule]:
        return [
            Rule("high_price", F.col(self.price) > self.high_price, 1),
            Rule("missing_proprietor", any_missing([*self.names, self.address]), 1),
            Rule("foreign_company", F.col(self.country) != self.home_country, 1),
            # Covered by the second rule as long as the flag comes from the same names.
            Rule("missing_name_flag", F.col(self.missing_flag) == 1, 1),
        ]


def label_ownership(df: DataFrame, params: OwnershipRules = OwnershipRules()) -> DataFrame:
    """Missing-name flag, label and the rule that fired."""
    flagged = missing_any(df, list(params.names), params.missing_flag)
    return label_rules(flagged, params.rules(), default=0)


def threshold_label(df: DataFrame, column: str, threshold: float, below: int, out: str = "is_fraud") -> DataFrame:
    """``below`` for values under the threshold and its opposite for all others, NULL included."""
    if below not in (0, 1):
        raise ValueError("below must be 0 or 1")
    return df.withColumn(out, F.when(F.col(column) < threshold, below).otherwise(1 - below))


def bool_label(df: DataFrame, column: str, out: str) -> DataFrame:
    """1 for true, 0 for false and NULL."""
    return df.withColumn(out, F.when(F.col(column), 1).otherwise(0))


def class_split(df: DataFrame, label: str = "is_fraud") -> tuple[DataFrame, DataFrame]:
    """Rows labelled 1 and rows labelled 0."""
    return df.filter(F.col(label) == 1), df.filter(F.col(label) == 0)
