"""Validation of broadcast messages with a reject route, and eligibility rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Layout of a message record.
MESSAGE_DDL = (
    "sms_campaign_code string, target_mobile_no string, sms_template_code string, "
    "sms_request_external_ref bigint, sms_request_external_txn_ref bigint, "
    "sms_template_variables struct<brand_code: string, ocis_mrg_pty_id: string>"
)
ROW_TAG = "sms_request"
ROOT_TAG = "sms_requests"
STAGED_DDL = "partyId string, phoneNumber string, broadcastId string, brand string"
PARTITIONS = ("broadcastId", "brand")


@dataclass(frozen=True)
class StagingRules:
    """What a valid mobile number looks like, and the broadcast the rows belong to."""

    # Number format and broadcast of the staging job.
    mobile_start: str = "7"
    mobile_length: int = 10
    broadcast_id: str = "12332346"

    def reason(self, number: Column) -> Column:
        """Why a number is rejected; NULL for a good one."""
        return (
            F.when(number.isNull(), "missing number")
            .when(~number.rlike("^[0-9]+$"), "not a number")
            .when(F.length(number) != self.mobile_length, "wrong length")
            .when(~number.startswith(self.mobile_start), "wrong start")
        )


def check_messages(messages: DataFrame, rules: StagingRules = StagingRules()) -> DataFrame:
    """Messages flattened to the staging columns, with the ``reason`` of a reject or NULL."""
    number = F.col("target_mobile_no")
    return messages.select(
        "sms_campaign_code",
        "sms_request_external_ref",
        "sms_request_external_txn_ref",
        "sms_template_code",
        F.col("sms_template_variables.ocis_mrg_pty_id").alias("partyId"),
        number.alias("phoneNumber"),
        rules.reason(number).alias("reason"),
        F.lit(rules.broadcast_id).alias("broadcastId"),
        F.col("sms_template_variables.brand_code").alias("brand"),
    )


def stage_messages(
    messages: DataFrame, rejected_on: Column, rules: StagingRules = StagingRules()
) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected messages; together they are all messages.

    ``rejected_on`` is the date put on rejects, ``current_date()`` in a live job.
    """
    checked = check_messages(messages, rules)
    accepted = checked.filter(F.col("reason").isNull()).select("partyId", "phoneNumber", *PARTITIONS)
    rejected = checked.filter(F.col("reason").isNotNull()).select(
        "sms_campaign_code",
        "sms_request_external_ref",
        "sms_request_external_txn_ref",
        "sms_template_code",
        "partyId",
        "phoneNumber",
        rejected_on.cast("date").alias("whenRejected"),
        "reason",
        *PARTITIONS,
    )
    return accepted, rejected


def stage_records(
    records: DataFrame, rejected_on: Column, rules: StagingRules = StagingRules(), raw: str = "_raw"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Accepted, rejected and broken records; together they are all records.

    ``records`` come from a read that keeps the text of a broken element in
    ``raw``. Broken ones are neither accepted nor rejected, whatever could be
    read of them: they come out as ``record``, the element itself, and
    ``whenRejected``, to be mended and read again.
    """
    whole = records.filter(F.col(raw).isNull()).drop(raw)
    accepted, rejected = stage_messages(whole, rejected_on, rules)
    broken = records.filter(F.col(raw).isNotNull())
    return accepted, rejected, broken.select(F.col(raw).alias("record"), rejected_on.cast("date").alias("whenRejected"))


# Blocked account codes and accepted statuses.
BLOCKED_CODES = ("I", "B", "D", "F", "Y", "N", "P", "Q", "Z", "R", "W")
ACCEPTED_STATUSES = ("A", "D")


@dataclass(frozen=True)
class EligibilityRules:
    """Accounts that may be alerted: no blocked code, flag unset, good status, due recently."""

    blocked: Mapping[str, Sequence[str]] = field(
        default_factory=lambda: {"block_code_1": BLOCKED_CODES, "block_code_2": BLOCKED_CODES}
    )
    flag: str = "pmt_ach_flag"
    flag_value: int = 0
    status: str = "int_status"
    statuses: Sequence[str] = ACCEPTED_STATUSES
    date: str = "due"
    days_back: int = 1


def eligible(df: DataFrame, as_of: Column, rules: EligibilityRules = EligibilityRules()) -> DataFrame:
    """Rows that meet all rules, dated in the ``days_back`` days before ``as_of``.

    An account without a code is not blocked. The date is compared as it is
    stored, so the filter reaches the file statistics and date partitions.
    """
    keep = (F.col(rules.flag) == rules.flag_value) & F.col(rules.status).isin(*rules.statuses)
    keep = keep & (F.col(rules.date) >= F.date_sub(as_of, rules.days_back)) & (F.col(rules.date) < as_of)
    for column, codes in rules.blocked.items():
        keep = keep & (F.col(column).isNull() | ~F.col(column).isin(*codes))
    return df.filter(keep)
