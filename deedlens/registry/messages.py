"""Message staging and eligibility."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedlens.operators import staging
from deedlens.registry.base import query
from deedlens.sources import files
from deedlens.sources.scratch import scratch_path
from deedlens.standins import ACCOUNTS_SQL, MESSAGES_SQL, accounts, messages

_REJECTED_ON = "2024-02-01"


@query(
    f"""
WITH {MESSAGES_SQL}
SELECT sms_campaign_code, target_mobile_no, sms_template_code, sms_request_external_ref, sms_request_external_txn_ref,
  brand_code, ocis_mrg_pty_id FROM messages
"""
)
def q_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generated messages, flat."""
    return messages(spark, sf_dir).select("*", "sms_template_variables.*").drop("sms_template_variables")


@query(
    f"""
WITH {MESSAGES_SQL}
SELECT ocis_mrg_pty_id AS "partyId", target_mobile_no AS "phoneNumber", '12332346' AS "broadcastId", brand_code AS brand
FROM checked WHERE reason IS NULL
"""
)
def q_stage_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with a valid mobile number."""
    return staging.stage_messages(messages(spark, sf_dir), F.lit(_REJECTED_ON))[0]


@query(
    f"""
WITH {MESSAGES_SQL}
SELECT sms_campaign_code, sms_request_external_ref, sms_request_external_txn_ref, sms_template_code,
  ocis_mrg_pty_id AS "partyId", target_mobile_no AS "phoneNumber", DATE '{_REJECTED_ON}' AS "whenRejected", reason,
  '12332346' AS "broadcastId", brand_code AS brand
FROM checked WHERE reason IS NOT NULL
"""
)
def q_stage_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without one, each with the reason."""
    return staging.stage_messages(messages(spark, sf_dir), F.lit(_REJECTED_ON))[1]


# Every fifth record is broken: it lacks a closing tag, holds letters where digits belong, or an open ampersand.
_RECORD_SQL = """
'<sms_request><sms_campaign_code>' || sms_campaign_code || '</sms_campaign_code><target_mobile_no>' || target_mobile_no ||
CASE WHEN n % 15 = 0 THEN '' ELSE '</target_mobile_no>' END || '<sms_template_code>' || sms_template_code ||
CASE WHEN n % 15 = 5 THEN ' & more' ELSE '' END || '</sms_template_code><sms_request_external_ref>' ||
CASE WHEN n % 15 = 10 THEN 'none' ELSE '' END || sms_request_external_ref || '</sms_request_external_ref><sms_request_external_txn_ref>' ||
sms_request_external_txn_ref || '</sms_request_external_txn_ref><sms_template_variables><brand_code>' || {brand} ||
'</brand_code><ocis_mrg_pty_id>' || {party} || '</ocis_mrg_pty_id></sms_template_variables></sms_request>'"""
_N_SQL = "CAST(substr(target_mobile_no, 2, 6) AS BIGINT)"
_RECORDS_SQL = f"""
{MESSAGES_SQL},
numbered AS (SELECT *, {_N_SQL} AS n FROM checked),
records AS (SELECT *, {_RECORD_SQL.format(brand="brand_code", party="ocis_mrg_pty_id")} AS record FROM numbered)"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as XML text, some of them broken, written and read back."""
    record = _RECORD_SQL.format(brand="sms_template_variables.brand_code", party="sms_template_variables.ocis_mrg_pty_id")
    texts = messages(spark, sf_dir).selectExpr("*", f"{_N_SQL} AS n").selectExpr(f"{record} AS value")
    path = scratch_path(spark, "records-xml")
    texts.write.text(path)
    return files.read_xml_or_raw(spark, path, staging.ROW_TAG, staging.MESSAGE_DDL)


@query(f"WITH {_RECORDS_SQL} SELECT record, DATE '{_REJECTED_ON}' AS \"whenRejected\" FROM records WHERE n % 5 = 0")
def q_stage_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that are no XML or have letters for a number, as they came."""
    return staging.stage_records(_records(spark, sf_dir), F.lit(_REJECTED_ON))[2]


@query(
    f"""
WITH {_RECORDS_SQL}
SELECT 'accepted' AS route, ocis_mrg_pty_id AS "partyId", target_mobile_no AS "phoneNumber", NULL AS reason, brand_code AS brand
FROM records WHERE n % 5 <> 0 AND reason IS NULL
UNION ALL SELECT 'rejected', ocis_mrg_pty_id, target_mobile_no, reason, brand_code
FROM records WHERE n % 5 <> 0 AND reason IS NOT NULL
"""
)
def q_stage_beside_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands beside the broken records is accepted or rejected as ever."""
    accepted, rejected, _ = staging.stage_records(_records(spark, sf_dir), F.lit(_REJECTED_ON))
    columns = ["partyId", "phoneNumber", "reason", "brand"]
    good = accepted.withColumn("reason", F.lit(None).cast("string")).select(F.lit("accepted").alias("route"), *columns)
    return good.unionByName(rejected.select(F.lit("rejected").alias("route"), *columns))


@query(
    f"""
WITH {ACCOUNTS_SQL}
SELECT account_id, int_status FROM accounts
WHERE pmt_ach_flag = 0 AND int_status IN ('A', 'D')
  AND due >= DATE '2024-01-10' AND due < DATE '2024-01-20'
  AND (block_code_1 IS NULL OR block_code_1 NOT IN {staging.BLOCKED_CODES})
  AND (block_code_2 IS NULL OR block_code_2 NOT IN {staging.BLOCKED_CODES})
"""
)
def q_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts due in the ten days before 20 January that may be alerted."""
    rules = staging.EligibilityRules(days_back=10)
    found = staging.eligible(accounts(spark, sf_dir), F.to_date(F.lit("2024-01-20")), rules)
    return found.select("account_id", "int_status")
