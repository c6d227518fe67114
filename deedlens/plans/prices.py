"""From the price index to labels, augmented rows and yearly averages."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedlens.operators import features, label, profile, sampling
from deedlens.operators.compare import reconcile
from deedlens.sources.catalog import write_table
from deedlens.sources.connectors import SourceSpec

# Default price above which an index row counts as suspicious.
HIGH_PRICE = 1_000_000


def with_row_key(index: DataFrame) -> DataFrame:
    """One index row is identified by its region and month."""
    return index.withColumn("row_key", F.concat_ws("|", "RegionName", "Datetaken"))


def labelled_index(index: DataFrame, threshold: float = HIGH_PRICE) -> DataFrame:
    """Rows with an average price, as a feature vector, labelled 0 below the threshold and 1 otherwise.

    A missing region or area code does not drop a row.
    """
    built = features.assemble(index, ["AveragePrice"])
    return label.threshold_label(built, "AveragePrice", threshold, below=0)


@dataclass(frozen=True)
class IndexRun:
    """Lazy results of the flow."""

    null_profile: DataFrame
    labelled: DataFrame
    balance: DataFrame
    augmented: DataFrame

    def write(self, db: str) -> None:
        """Overwrite the flow's tables: good rows, synthetic rows, both together."""
        write_table(self.augmented.filter("copy = 0").drop("copy", "row_key"), db, "good_data")
        write_table(self.augmented.filter("copy > 0").drop("copy", "row_key"), db, "synthetic_good_data")
        write_table(self.augmented.drop("copy", "row_key"), db, "good_fraud_data")


def index_flow(index: DataFrame, threshold: float = HIGH_PRICE, seed: int = 42) -> IndexRun:
    """Profile, label, and augment the good class at its own share."""
    labelled = labelled_index(index, threshold)
    _, good = label.class_split(with_row_key(labelled))
    return IndexRun(
        null_profile=profile.null_profile(index),
        labelled=labelled,
        balance=profile.class_balance(labelled, "is_fraud"),
        augmented=sampling.augment(good, sampling.share_of(good, index), seed, "row_key"),
    )


def regional_sample(index: DataFrame, regions: list[str], rows: int) -> DataFrame:
    """The same number of index rows, the earliest, from each of some regions."""
    picked = index.filter(F.col("RegionName").isin(*regions))
    return sampling.rows_per_group(picked, "RegionName", rows, "Datetaken").drop("row_in_group")


def round_trip(
    spark: SparkSession,
    source: SourceSpec,
    target: SourceSpec,
    transform: Callable[[DataFrame], DataFrame],
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read, transform, save, read back and reconcile what was saved with what was computed.

    ``types`` restores column types that the target does not keep.
    """
    result = transform(source.read(spark))
    target.write(result, "overwrite")
    saved = target.read(spark)
    if types:
        saved = saved.withColumns({c: F.col(c).cast(kind) for c, kind in types.items()})
    return reconcile(result, saved.select(*result.columns))
