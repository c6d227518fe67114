"""Declared schemas of the titles and price-index tables.

Fixed values: column names and types, built by rule for the repeated groups.
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

PROPRIETORS = (1, 2, 3, 4)
# The loaded table has these two as well; cleaning drops them.
DROPPED_TITLE_COLUMNS = ("CompanyRegistrationNo3", "Proprietor4Address3")
PRICE_GROUPS = (
    "Detached",
    "SemiDetached",
    "Terraced",
    "Flat",
    "Cash",
    "Mortgage",
    "FTB",
    "FOO",
    "New",
    "Old",
)
_FEATURES = StructField("features", VectorUDT(), True)


def _fields(names: list[str], kind: DataType) -> list[StructField]:
    return [StructField(name, kind, True) for name in names]


def titles_schema(labelled: bool = False, loaded: bool = False) -> StructType:
    """Titles as cleaned; ``labelled`` adds features and labels, ``loaded`` the columns that cleaning drops."""
    place = [
        "TitleNumber",
        "Tenure",
        "PropertyAddress",
        "District",
        "County",
        "Region",
        "Postcode",
        "MultipleAddressIndicator",
    ]
    fields = _fields(place, StringType()) + [StructField("PricePaid", IntegerType(), True)]
    for i in PROPRIETORS:
        names = [f"ProprietorName{i}", f"CompanyRegistrationNo{i}", f"ProprietorshipCategory{i}"]
        names += [f"CountryIncorporated{i}"] + [f"Proprietor{i}Address{line}" for line in (1, 2, 3)]
        fields += _fields([n for n in names if loaded or n not in DROPPED_TITLE_COLUMNS], StringType())
    fields += [
        StructField("DateProprietorAdded", DateType(), True),
        StructField("AdditionalProprietorIndicator", StringType(), True),
    ]
    if labelled:
        flags = [StructField(n, IntegerType(), False) for n in ("missing_proprietor_name", "is_fraud")]
        fields += [_FEATURES, *flags]
    return StructType(fields)


def price_index_schema(labelled: bool = False) -> StructType:
    """Monthly price index by region; ``labelled`` adds features and the label."""
    fields = [StructField("Datetaken", DateType(), True)] + _fields(["RegionName", "AreaCode"], StringType())
    whole = ["AveragePrice", "Index", "IndexSA", "oneMonthPercentChange", "twelveMonthPercentChange"]
    whole += ["AveragePriceSA", "SalesVolume"]
    parts = ("Price", "Index", "1mPercentChange", "12mPercentChange")
    fields += _fields(whole + [group + part for group in PRICE_GROUPS for part in parts], DoubleType())
    if labelled:
        fields += [_FEATURES, StructField("is_fraud", IntegerType(), False)]
    return StructType(fields)
