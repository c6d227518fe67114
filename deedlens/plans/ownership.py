"""From raw titles to labels, reports, augmented rows and tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from deedlens.functions.text import quoted
from deedlens.operators import clean, features, joins, label, profile, sampling, totals, windows
from deedlens.operators.compare import quality_report
from deedlens.operators.label import OwnershipRules
from deedlens.sources.catalog import write_table
from deedlens.sources.schemas import DROPPED_TITLE_COLUMNS
from deedlens.sources.scratch import stored

# Columns of the titles table that the flow works on.
CATEGORIES = (
    "Tenure",
    "PropertyAddress",
    "District",
    "County",
    "Region",
    "Postcode",
    "MultipleAddressIndicator",
)
ROGUE_TENURES = ("93347",)


def clean_titles(titles: DataFrame, rogue: Sequence[str] = ROGUE_TENURES) -> DataFrame:
    """Rogue tenures out, tenure as text, surplus columns dropped."""
    kept = clean.drop_rogue(titles, "Tenure", rogue)
    return clean.cast_columns(kept, {"Tenure": "string"}).drop(*DROPPED_TITLE_COLUMNS)


def prepare_titles(cleaned: DataFrame) -> features.Features:
    """Titles with a feature vector, and the incomplete ones."""
    return features.build_features(cleaned, CATEGORIES, ["PricePaid"], key="TitleNumber")


def labelled_titles(cleaned: DataFrame, rules: OwnershipRules = OwnershipRules()) -> DataFrame:
    return label.label_ownership(prepare_titles(cleaned).kept, rules)


def leftover_titles(cleaned: DataFrame) -> DataFrame:
    return prepare_titles(cleaned).dropped


def ownership_reports(labelled: DataFrame, ranks: int = 10) -> dict[str, DataFrame]:
    """Flagged titles by country, shares per district, and the dearest titles of the top districts."""
    # Three reports read the summary: it is worked out once.
    summary = stored(windows.group_summary(labelled, ["District", "County"], "District", "PricePaid"))
    top = windows.dense_rank_top(summary, "n", ranks)
    return {
        "by_country": totals.flagged_counts(labelled, "CountryIncorporated1"),
        "district_shares": windows.percent_of_total(summary.drop("max_value"), "n").orderBy(F.desc("n")),
        "top_districts": top,
        "dearest": joins.max_row_join(
            top,
            labelled,
            group="District",
            maximum="max_value",
            value="PricePaid",
            columns=["ProprietorName1", "CountryIncorporated1", "Tenure", "PropertyAddress"],
        ),
    }


@dataclass(frozen=True)
class OwnershipRun:
    """Results of the flow. What is read more than once, the reports' summary, is stored when the flow is built."""

    null_profile: DataFrame
    labelled: DataFrame
    leftover: DataFrame
    balance: DataFrame
    augmented: DataFrame
    quality: DataFrame
    reports: dict[str, DataFrame]

    def write(self, db: str, labelled: StructType | None = None, cleaned: StructType | None = None) -> None:
        """Overwrite the flow's tables: flagged rows, synthetic rows, both together, leftovers.

        With schemas given, rows are cast to them: ``labelled`` for the first
        three tables, ``cleaned`` for the leftovers.
        """
        # Drawn and labelled once; three tables read it.
        both = stored(self.augmented, "augmented")
        write_table(both.filter("copy = 0").drop("copy"), db, "bad_data", labelled)
        write_table(both.filter("copy > 0").drop("copy"), db, "synthetic_bad_data", labelled)
        write_table(both.drop("copy"), db, "bad_fraud_data", labelled)
        write_table(self.leftover, db, "good_offshore_data", cleaned)


def ownership_flow(
    titles: DataFrame,
    rules: OwnershipRules = OwnershipRules(),
    seed: int = 42,
    fraction: float | None = None,
    labelled_table: tuple[str, str] | None = None,
) -> OwnershipRun:
    """Clean, prepare, label, report, augment the flagged class and judge the synthetic rows.

    ``fraction`` is the rate of synthetic rows; left out, it is the share of
    flagged rows among all. With ``labelled_table`` (database, name) the labelled
    rows are written once and every report reads that table, instead of
    repeating the work from the raw titles.
    """
    cleaned = clean_titles(titles)
    labelled = labelled_titles(cleaned, rules)
    if labelled_table is not None:
        db, name = labelled_table
        write_table(labelled, db, name)
        labelled = titles.sparkSession.table(f"{db}.{name}")
    flagged, _ = label.class_split(labelled)
    rate = sampling.share_where(mark_titles(titles, rules), F.col("part") == BAD) if fraction is None else fraction
    augmented = sampling.augment(flagged, rate, seed, "TitleNumber")
    tagged = augmented.withColumn("is_synthetic", F.col("copy") > 0).drop("copy", "features")
    return OwnershipRun(
        null_profile=profile.null_profile(cleaned),
        labelled=labelled,
        leftover=leftover_titles(cleaned),
        balance=profile.class_balance(labelled, "is_fraud"),
        augmented=augmented,
        quality=quality_report(tagged, "is_synthetic"),
        reports=ownership_reports(labelled),
    )


#: Parts of the table of all titles, each a partition of it.
BAD, GOOD, INCOMPLETE, ROGUE, SYNTHETIC = "bad", "good", "incomplete", "rogue", "synthetic"


def mark_titles(titles: DataFrame, rules: OwnershipRules = OwnershipRules()) -> DataFrame:
    """All titles in one pass, with features, labels and the ``part`` each belongs to.

    Rogue tenures and incomplete titles have no features and no labels.
    """
    needed = [*CATEGORIES, "PricePaid"]
    rows = clean.cast_columns(titles, {"Tenure": "string"}).drop(*DROPPED_TITLE_COLUMNS)
    labelled = label.label_ownership(rows, rules).drop("rule_id")
    rogue = F.col("Tenure").isNull() | F.col("Tenure").isin(*ROGUE_TENURES)
    part = (
        F.when(rogue, ROGUE).when(clean.lacks_value(rows, needed), INCOMPLETE).when(F.col("is_fraud") == 1, BAD).otherwise(GOOD)
    )
    known = F.col("part").isin(BAD, GOOD)
    vector = array_to_vector(F.array(F.col("PricePaid").cast("double")))
    return (
        labelled.withColumn("part", part)
        .withColumns({c: F.when(known, F.col(c)) for c in (rules.missing_flag, "is_fraud")})
        .withColumn("features", F.when(known, vector))
        .select(*rows.columns, "features", rules.missing_flag, "is_fraud", "part")
    )


def write_ownership_tables(
    titles: DataFrame,
    db: str,
    rules: OwnershipRules = OwnershipRules(),
    seed: int = 42,
    name: str = "all_titles",
    path: str | None = None,
    prefix: str = "",
) -> None:
    """One table of all titles, and the flow's four tables as views of its partitions.

    Titles are read once: cleaned, labelled and written with the ``part`` they
    belong to. The rate of synthetic rows and the rows they are drawn from come
    from that table, and the draws are appended to it as a part of their own, so
    nothing is evaluated twice. The views are ``bad_data``, ``synthetic_bad_data``,
    ``bad_fraud_data`` (both) and ``good_offshore_data`` (incomplete titles whose
    number occurs among no complete ones), each after ``prefix``; a view of that
    name is replaced. A column that the titles lack is not in the tables.
    """
    spark = titles.sparkSession
    table = f"{quoted(db)}.{quoted(name)}"

    def write(rows: DataFrame, mode: str) -> None:
        # A part that holds most rows is written by several tasks.
        writer = rows.hint("rebalance", "part").write.mode(mode).partitionBy("part")
        (writer if path is None else writer.option("path", path)).saveAsTable(f"{db}.{name}")

    write(mark_titles(titles, rules), "overwrite")
    rows = spark.table(table)
    bad = rows.filter(F.col("part") == BAD)
    rate = sampling.share_where(rows, F.col("part") == BAD)
    drawn = sampling.bootstrap(bad, rate, seed, "TitleNumber").drop("copy")
    write(drawn.withColumn("part", F.lit(SYNTHETIC)).select(*rows.columns), "append")
    labelled = ", ".join(quoted(c) for c in rows.columns if c != "part")
    cleaned = ", ".join(quoted(c) for c in rows.columns if c not in ("part", "features", "is_fraud", rules.missing_flag))
    views = {
        "bad_data": f"SELECT {labelled} FROM {table} WHERE part = '{BAD}'",
        "synthetic_bad_data": f"SELECT {labelled} FROM {table} WHERE part = '{SYNTHETIC}'",
        "bad_fraud_data": f"SELECT {labelled} FROM {table} WHERE part IN ('{BAD}', '{SYNTHETIC}')",
        "good_offshore_data": f"SELECT {cleaned} FROM {table} t WHERE part = '{INCOMPLETE}' AND NOT EXISTS ("
        f"SELECT 1 FROM {table} k WHERE k.part IN ('{BAD}', '{GOOD}') AND k.TitleNumber = t.TitleNumber)",
    }
    for view, sql in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {quoted(db)}.{quoted(prefix + view)} AS {sql}")
