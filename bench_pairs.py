"""Time operators against their direct spellings; prints one JSON line.

Takes BENCH_SF_DIR and BENCH_CPUS like bench.py. Each figure is the faster of two runs.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent / "tests"))

import spellings  # noqa: E402

from bench import session  # noqa: E402
from deedlens.operators import profile, text, totals, windows  # noqa: E402
from deedlens.plans.ownership import clean_titles  # noqa: E402
from deedlens.registry.features import LEXICON  # noqa: E402
from deedlens.registry.reports import bad, labelled  # noqa: E402
from deedlens.sources.scratch import stored  # noqa: E402
from deedlens.standins import PRICES, price_index, table, titles  # noqa: E402


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def seconds(run) -> float:
    best = float("inf")
    for _ in range(2):
        start = time.perf_counter()
        run()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    # Inputs are stored first, so that both spellings read files.
    clean = stored(clean_titles(titles(spark, sf_dir)))
    rows = stored(labelled(spark, sf_dir))
    flagged = stored(bad(spark, sf_dir))
    index = stored(price_index(spark, sf_dir))
    documents = table(spark, sf_dir, "documents")
    by = ["District", "County"]
    texts = ["Tenure", "District", "County", "Region", "Postcode", "CountryIncorporated1", "ProprietorName1"]
    summary = stored(windows.group_summary(rows, ["PropertyAddress"], "PropertyAddress", "PricePaid"))
    pairs = {
        "null_profile": (
            lambda: profile.null_profile(clean).collect(),
            lambda: spellings.null_profile_by_column(clean),
        ),
        "price_ratio": (
            lambda: noop(totals.price_ratio(index, flagged)),
            lambda: noop(spellings.price_ratio_by_join(index, flagged)),
        ),
        "group_summary": (
            lambda: noop(windows.group_summary(rows, by, "District", "PricePaid")),
            lambda: noop(spellings.group_summary_by_window(rows, by, "District", "PricePaid")),
        ),
        "yearly_average": (
            lambda: noop(windows.yearly_average(index, "Datetaken", "RegionName", PRICES)),
            lambda: noop(spellings.yearly_average_by_window(index, "Datetaken", "RegionName", PRICES)),
        ),
        "dense_rank": (
            lambda: noop(windows.dense_rank_top(summary, "n", 10)),
            lambda: noop(spellings.dense_rank_top_by_window(summary, "n", 10)),
        ),
        "category_counts": (
            lambda: profile.category_counts(clean, texts).collect(),
            lambda: spellings.category_counts_by_column(clean, texts),
        ),
        "polarity": (
            lambda: noop(text.polarity(documents, "text", LEXICON).select("doc_id", "polarity")),
            lambda: noop(spellings.polarity_by_udf(documents, "doc_id", "text", LEXICON)),
        ),
    }
    figures = {name: {"ours": seconds(ours), "direct": seconds(direct)} for name, (ours, direct) in pairs.items()}
    print(json.dumps({"unit": "sec", "pairs": figures, "sf": os.path.basename(sf_dir).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
