"""All ownership and price reports over two labelled tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from deedlens.operators import profile, totals


@dataclass(frozen=True)
class Area:
    """The county that is looked at closely, and the district left out of its lists."""

    # Default county and district.
    county: str = "GREATER LONDON"
    exclude: str = "CITY OF LONDON"


def analysis_reports(good: DataFrame, bad: DataFrame, titles: DataFrame, area: Area = Area()) -> dict[str, DataFrame]:
    """Reports by name; nothing runs until one is read.

    ``good`` is the labelled price index, ``bad`` the flagged titles, ``titles``
    all titles.
    """
    by_region = totals.region_totals(bad, "Region", "PricePaid")
    ratios = totals.price_ratio(good, bad, county=area.county)
    top = totals.top_price_ratios(ratios, totals.group_counts(bad, "District"), exclude=area.exclude)
    return {
        "by_region": by_region,
        "all_regions": totals.report_totals(by_region, "n_rows", "total"),
        "jurisdictions": totals.top_totals(titles, "CountryIncorporated1", "PricePaid", 1_000_000_000),
        "districts": totals.top_totals_within(
            bad, "District", "PricePaid", 1_000_000_000, within="County", name=area.county, exclude=area.exclude
        ),
        "price_ratios": top,
        "district_shares": totals.share_of_total(top.select("district", "n"), "n"),
        "global_ratio": totals.global_ratio(good, bad, "AveragePrice", "PricePaid"),
        "price_histogram": profile.histogram(good, "AveragePrice"),
    }
