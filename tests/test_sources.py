from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from deedlens.operators import generate, profile, staging
from deedlens.plans.analysis import Area, analysis_reports
from deedlens.plans.ownership import clean_titles, labelled_titles, mark_titles, ownership_flow, write_ownership_tables
from deedlens.plans.prices import index_flow, round_trip
from deedlens.sources import catalog, connectors, files, schemas, scratch
from deedlens.standins import INDEX_THRESHOLD, OWNERSHIP, full_titles, price_index, titles

SF_DIR = "/root/testdata/sf0.001"


def test_load_table_fails_when_absent(spark):
    with pytest.raises(LookupError):
        catalog.load_table(spark, "default", "no_such_table")


def test_write_then_load(spark):
    df = spark.createDataFrame([("T1", 5, "x"), ("T2", None, "y")], "title string, price int, extra string")
    schema = StructType.fromDDL("title string NOT NULL, price double")
    catalog.write_table(df, "default", "written", schema)
    found = catalog.load_table(spark, "default", "written")
    assert found.dtypes == [("title", "string"), ("price", "double")]
    assert rows(found) == [("T1", 5.0), ("T2", None)]
    assert catalog.table_rows(spark, "default", "written") == 2
    catalog.write_table(df.limit(1), "default", "written", schema)
    assert catalog.table_rows(spark, "default", "written") == 1
    good, bad = catalog.load_labelled(spark, "default", "written", "written")
    assert good.count() == bad.count() == 1


def test_declared_schema_is_enforced(spark):
    df = spark.createDataFrame([("T1",), (None,)], "title string")
    with pytest.raises(ValueError, match="price"):
        catalog.conform(df, StructType.fromDDL("title string, price int"))
    with pytest.raises(Exception, match="NULL in required column title"):
        catalog.conform(df, StructType.fromDDL("title string NOT NULL")).collect()


def test_delimited_round_trip_and_misfit(spark, tmp_path):
    ddl = "id int, amount double, who string, ok boolean"
    df = spark.createDataFrame([(1, 2.5, "a b", True), (2, None, None, False)], ddl)
    files.write_delimited(df, str(tmp_path / "t"))
    assert rows(files.read_delimited(spark, str(tmp_path / "t"), ddl)) == rows(df)
    with pytest.raises(Exception, match="MALFORMED_RECORD|CSV"):
        files.read_delimited(spark, str(tmp_path / "t"), "id int, amount int, who string, ok boolean").collect()


def test_xml_keeps_leading_zeros(spark, tmp_path):
    sent = generate.sample_messages(spark.range(1, 40), "id").withColumn(
        "target_mobile_no", F.lpad((F.col("sms_request_external_ref") % 1000).cast("string"), 10, "0")
    )
    files.write_xml(sent, str(tmp_path / "x"), staging.ROW_TAG, staging.ROOT_TAG)
    read = files.read_xml(spark, str(tmp_path / "x"), staging.ROW_TAG, staging.MESSAGE_DDL)
    assert rows(read) == rows(sent)


def test_xml_sample_layout(spark, tmp_path):
    record = """<sms_requests><sms_request><sms_campaign_code>C1</sms_campaign_code>
      <target_mobile_no>{}</target_mobile_no><sms_template_code>T</sms_template_code>
      <sms_request_external_ref>1</sms_request_external_ref>
      <sms_request_external_txn_ref>2</sms_request_external_txn_ref>
      <sms_template_variables><brand_code>MBN</brand_code><ocis_mrg_pty_id>9</ocis_mrg_pty_id></sms_template_variables>
      </sms_request></sms_requests>"""
    for i, number in enumerate(["7411224959", "9876543210", "765908711"]):
        (tmp_path / f"m{i}.xml").write_text(record.format(number))
    read = files.read_xml(spark, str(tmp_path), staging.ROW_TAG, staging.MESSAGE_DDL)
    accepted, rejected = staging.stage_messages(read, F.current_date())
    assert rows(accepted) == [("9", "7411224959", "12332346", "MBN")]
    assert rejected.count() == 2


def test_partitions_are_overwritten_one_by_one(spark, tmp_path):
    path = str(tmp_path / "staged")
    first = spark.createDataFrame([("p1", "n", "1", "A"), ("p2", "n", "1", "B")], staging.STAGED_DDL)
    second = spark.createDataFrame([("p3", "n", "1", "B")], staging.STAGED_DDL)
    files.write_partitioned(first, path, staging.PARTITIONS)
    files.write_partitioned(second, path, staging.PARTITIONS)
    read = files.read_partitioned(spark, path, staging.STAGED_DDL)
    assert rows(read) == [("p1", "n", "1", "A"), ("p3", "n", "1", "B")]
    pruned = read.filter("brand = 'A'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(brand" in pruned


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    brand = F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("B"), (F.col("id") % 5).cast("string")))
    df = spark.range(0, 90_000, numPartitions=8).select(
        F.md5(F.col("id").cast("string")).alias("partyId"), F.lit("1").alias("broadcastId"), brand.alias("brand")
    )
    files.write_partitioned(df, str(tmp_path / "hot"), staging.PARTITIONS)
    for key, value in before.items():
        spark.conf.set(key, value)
    assert len(list((tmp_path / "hot" / "broadcastId=1" / "brand=HOT").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 90_000


def test_csv_report_is_one_file(spark, tmp_path):
    files.write_csv_report(spark.range(50).repartition(5), str(tmp_path / "r"))
    assert len(list((tmp_path / "r").glob("part-*.csv"))) == 1


def test_jdbc_options():
    spec = connectors.jdbc(
        "jdbc:x:y", "s.t", "me", "secret", "a.Driver", 500, connectors.JdbcPartitioning("id", "0", "100", 4)
    )
    assert spec.format == "jdbc"
    assert spec.options == {
        "url": "jdbc:x:y",
        "dbtable": "s.t",
        "user": "me",
        "password": "secret",
        "driver": "a.Driver",
        "fetchsize": "500",
        "partitionColumn": "id",
        "lowerBound": "0",
        "upperBound": "100",
        "numPartitions": "4",
    }


def test_connector_options():
    assert connectors.bigquery("d", "t", "/key.json").options == {
        "credentialsFile": "/key.json",
        "dataset": "d",
        "table": "t",
    }
    assert connectors.redis("t", "k", infer_schema=True).options == {
        "table": "t",
        "key.column": "k",
        "infer.schema": "true",
    }
    assert connectors.redis("t", "k").format == "org.apache.spark.sql.redis"


def test_source_spec_reads_and_writes(spark, tmp_path):
    spec = connectors.SourceSpec("parquet", {"path": str(tmp_path / "p")})
    spec.write(spark.range(3), "overwrite")
    assert spec.read(spark).count() == 3


def test_scratch_follows_the_setting(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_dir(spark) == folder
    first, second = scratch.scratch_path(spark, "a"), scratch.scratch_path(spark, "a")
    assert first != second and first.startswith(folder)


def test_stored_frame_is_computed_once(spark):
    df = scratch.stored(spark.range(100).select("id", F.rand().alias("r")))
    assert rows(df) == rows(df)


def test_ownership_flow(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS flows")
    raw = titles(spark, SF_DIR)
    run = ownership_flow(raw, OWNERSHIP, labelled_table=("flows", "labelled"))
    balance = run.balance.first()
    assert balance["total"] == balance["flagged"] + balance["unflagged"]
    cleaned = raw.filter("Tenure <> '93347'").count()
    assert balance["total"] + run.leftover.count() == cleaned
    run.write("flows")
    flagged = spark.table("flows.bad_data").count()
    synthetic = spark.table("flows.synthetic_bad_data").count()
    assert flagged == balance["flagged"]
    assert spark.table("flows.bad_fraud_data").count() == flagged + synthetic
    assert abs(synthetic - flagged * flagged / raw.count()) < 5 * (flagged**0.5)
    assert run.reports["by_country"].count() > 0
    assert set(run.reports) == {"by_country", "district_shares", "top_districts", "dearest"}
    assert run.reports["dearest"].count() >= run.reports["top_districts"].count() > 0
    assert {r["section"] for r in run.quality.collect()} == {"shape", "describe", "category"}


def test_index_flow(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS flows")
    run = index_flow(price_index(spark, SF_DIR), INDEX_THRESHOLD)
    balance = run.balance.first()
    run.write("flows")
    assert spark.table("flows.good_data").count() == balance["unflagged"]
    whole = spark.table("flows.good_fraud_data").count()
    assert whole == balance["unflagged"] + spark.table("flows.synthetic_good_data").count()
    assert "copy" not in spark.table("flows.good_fraud_data").columns


def test_analysis_reports(spark):
    raw = titles(spark, SF_DIR)
    bad = labelled_titles(clean_titles(raw), OWNERSHIP).filter("is_fraud = 1")
    reports = analysis_reports(price_index(spark, SF_DIR), bad, raw, Area("Europe", "NATION_8"))
    for name, report in reports.items():
        assert report.count() > 0, name
    shares = sum(r["percentage"] for r in reports["district_shares"].collect())
    assert abs(shares - 100) < 0.5


def test_round_trip_sees_a_lossy_target(spark, tmp_path):
    source = connectors.SourceSpec("parquet", {"path": str(tmp_path / "s")})
    target = connectors.SourceSpec("json", {"path": str(tmp_path / "t")})
    source.write(spark.createDataFrame([(1, "a"), (2, None)], "x int, y string"), "overwrite")
    same = round_trip(spark, source, target, lambda df: df, types={"x": "int"})
    assert rows(same) == [(2, 2, 0, 0, True)]
    halved = connectors.SourceSpec("json", {"path": str(tmp_path / "u")})
    lossy = round_trip(spark, source, halved, lambda df: df.withColumn("x", F.col("x") / 3), types={"x": "decimal(10,2)"})
    assert lossy.first()["matched"] is False


def test_declared_schemas():
    titles_columns = schemas.titles_schema().fieldNames()
    assert len(titles_columns) == 8 + 1 + 4 * 7 - 2 + 2
    assert not set(schemas.DROPPED_TITLE_COLUMNS) & set(titles_columns)
    assert len(schemas.titles_schema(loaded=True)) == len(titles_columns) + 2
    assert schemas.titles_schema(labelled=True).fieldNames()[-3:] == ["features", "missing_proprietor_name", "is_fraud"]
    assert len(schemas.price_index_schema()) == 3 + 7 + 40
    assert schemas.price_index_schema(labelled=True)["is_fraud"].dataType.typeName() == "integer"


def test_flow_on_the_full_schema(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS full_titles")
    loaded = schemas.titles_schema(loaded=True)
    some = titles(spark, SF_DIR)
    raw = some.select(
        *[
            F.col(f.name) if f.name in some.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in loaded
        ]
    )
    run = ownership_flow(raw, OWNERSHIP)
    labelled, cleaned = schemas.titles_schema(labelled=True), schemas.titles_schema()
    run.write("full_titles", labelled, cleaned)
    written = spark.table("full_titles.bad_fraud_data")
    assert written.columns == labelled.fieldNames()
    assert written.filter("is_fraud <> 1").count() == 0
    assert spark.table("full_titles.good_offshore_data").columns == cleaned.fieldNames()
    empty = {r["column"] for r in run.null_profile.filter("null_count = row_count").collect()}
    assert {"ProprietorName4", "Proprietor2Address3"} <= empty


def test_ownership_tables_from_one_reading(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS parts")
    raw = full_titles(spark, SF_DIR)
    # A number that stands twice, once incomplete; and titles without a number.
    twice = raw.limit(1).withColumns({"TitleNumber": F.lit("T4"), "County": F.lit(None).cast("string"), "Tenure": F.lit("Freehold")})
    nameless = raw.limit(1).withColumns({"TitleNumber": F.lit(None).cast("string"), "Region": F.lit(None).cast("string"), "Tenure": F.lit("Freehold")})
    raw = raw.unionByName(twice).unionByName(nameless)
    flow = ownership_flow(raw, OWNERSHIP)
    for _ in range(2):
        # The second time replaces the first.
        write_ownership_tables(raw, "parts", OWNERSHIP, path=str(tmp_path / "all"))
        parts = {r["part"]: r["count"] for r in spark.table("parts.all_titles").groupBy("part").count().collect()}
        assert sum(n for p, n in parts.items() if p != "synthetic") == raw.count()
        bad, synthetic = spark.table("parts.bad_data"), spark.table("parts.synthetic_bad_data")
        assert bad.count() == parts["bad"] and synthetic.count() == parts["synthetic"]
        assert spark.table("parts.bad_fraud_data").count() == parts["bad"] + parts["synthetic"]
    leftover = spark.table("parts.good_offshore_data")
    assert leftover.columns == schemas.titles_schema().fieldNames()
    assert rows(leftover.select("TitleNumber")) == rows(flow.leftover.select("TitleNumber"))
    assert leftover.where("TitleNumber IS NULL").count() == 1
    drawn = flow.augmented.filter("copy > 0").select("TitleNumber", "is_fraud")
    assert rows(synthetic.select("TitleNumber", "is_fraud")) == rows(drawn)
    assert bad.schema["features"].dataType == schemas.titles_schema(labelled=True)["features"].dataType


def test_marked_titles_read_their_source_once(spark):
    plan = mark_titles(full_titles(spark, SF_DIR), OWNERSHIP)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("orders.parquet") == 1 and "Python" not in plan


def test_made_columns_share_one_expression(spark):
    # An expression for each column makes a method that the JVM only interprets.
    titles = full_titles(spark, SF_DIR)
    plan = titles._jdf.queryExecution().optimizedPlan().toString()
    assert len(titles.columns) > 35 and plan.count("CASE WHEN") < 15
    found = titles.where("TitleNumber = 'T12'").select("TitleNumber", "ProprietorName3", "CompanyRegistrationNo1").first()
    names = titles.columns
    for name in ("ProprietorName3", "CompanyRegistrationNo1"):
        n = names.index(name)
        assert found[name] == (f"{name}-{12 % (n + 5)}" if 12 % (n + 3) else None)


def test_ownership_tables_of_no_titles(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS parts")
    write_ownership_tables(full_titles(spark, SF_DIR).limit(0), "parts", OWNERSHIP, name="none", path=str(tmp_path / "n"), prefix="none_")
    assert spark.table("parts.none_bad_fraud_data").count() == spark.table("parts.none_good_offshore_data").count() == 0


def test_load_labelled_refuses_when_one_is_absent(spark):
    catalog.write_table(spark.range(3), "default", "only_good")
    for pair in (("only_good", "no_bad"), ("no_good", "only_good")):
        with pytest.raises(LookupError):
            catalog.load_labelled(spark, "default", *pair)


def test_broken_records_do_not_take_their_neighbours(spark, tmp_path):
    def record(n, inner="", end="</sms_request>"):
        return f'<sms_request id="x"><target_mobile_no>{n}</target_mobile_no>{inner}{end}'

    texts = [
        "<?xml version='1.0'?><sms_requests>",
        record(1),
        record(2, end=""),
        record(3) + record(4, "<open>"),
        record(5, "<sms_request_external_ref>x1</sms_request_external_ref>"),
        "  " + record(6, "<sms_request_external_ref>7</sms_request_external_ref>").replace("><", ">\n<"),
        record("7 & 8"),
        record("ä" * 100_000),
        "</sms_requests>",
    ]
    path = str(tmp_path / "records")
    spark.createDataFrame([("\n".join(texts),)], "value string").write.text(path)
    read = files.read_xml_or_raw(spark, path, staging.ROW_TAG, staging.MESSAGE_DDL).cache()
    whole = rows(read.where("_raw IS NULL").select("target_mobile_no"))
    assert whole == rows(spark.createDataFrame([("1",), ("3",), ("6",), ("ä" * 100_000,)], "x string"))
    broken = sorted(r["_raw"] for r in read.where("_raw IS NOT NULL").collect())
    assert len(broken) == 4 and broken[0].startswith('<sms_request id="x"><target_mobile_no>2')
    accepted, rejected, bad = staging.stage_records(read, F.lit("2024-02-01"))
    assert accepted.count() + rejected.count() + bad.count() == read.count() == 8
    assert {r["reason"] for r in rejected.collect()} == {"wrong length", "not a number"}
    spark.createDataFrame([], "value string").write.text(str(tmp_path / "none"))
    assert files.read_xml_or_raw(spark, str(tmp_path / "none"), staging.ROW_TAG, staging.MESSAGE_DDL).count() == 0


def test_column_statistics_are_refused_when_stale(spark, tmp_path):
    df = spark.createDataFrame([(1, None, 2.5), (2, "a", None), (None, None, float("nan"))], "x int, s string, d double")
    with pytest.raises(LookupError):
        catalog.column_statistics(spark, "default", "no_such_table")
    catalog.write_table(df, "default", "measured", path=str(tmp_path / "m"))
    with pytest.raises(LookupError):
        catalog.column_statistics(spark, "default", "measured")
    catalog.analyze_columns(spark, "default", "measured")
    found = catalog.column_statistics(spark, "default", "measured")
    assert rows(found.select("column", "row_count", "null_count")) == [("d", 3, 1), ("s", 3, 2), ("x", 3, 1)]
    assert rows(found.where("column = 'x'").select("minimum", "maximum")) == [("1", "2")]
    same = profile.null_profile_of(found)
    assert rows(same) == rows(profile.null_profile(df)) and same.dtypes == profile.null_profile(df).dtypes
    assert "parquet" not in same._jdf.queryExecution().executedPlan().toString().lower()
    # Files that came by another way than the catalog.
    df.write.mode("append").parquet(str(tmp_path / "m"))
    with pytest.raises(LookupError):
        catalog.column_statistics(spark, "default", "measured")
    catalog.analyze_columns(spark, "default", "measured")
    assert catalog.column_statistics(spark, "default", "measured").first()["row_count"] == 6
    df.limit(1).write.insertInto("default.measured")
    with pytest.raises(LookupError):
        catalog.column_statistics(spark, "default", "measured")
