"""Plans are what the design says: one scan, early filters, no nested loops."""

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import load_all
from checks.registry import QUERIES
from flightlake.operators import facts, gold, views
from flightlake.operators.documents import latest_per_doc
from flightlake.sources import tables

load_all()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_or_nested_loop_join(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text


@pytest.fixture(scope="module")
def silver_path(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver") / "table")
    tables.write_silver(fx.silver(spark, sf_dir), "silver_plans", path)
    return path


def test_gold_reads_silver_once(spark, silver_path):
    silver = spark.table("silver_plans")
    assert plan(gold.gold_summary(silver)).count("FileScan parquet") == 1
    assert plan(gold.gold_union(silver)).count("FileScan parquet") == 4


def test_gold_reads_needed_columns_only(spark, silver_path):
    text = plan(gold.gold_summary(spark.table("silver_plans")))
    scan = text[text.index("ReadSchema") :]
    assert "flight_id" not in scan and "event_ts" not in scan


def test_recent_facts_prune_day_folders(spark, silver_path):
    text = plan(facts.airline_facts(spark.table("silver_plans"), fx.AS_OF, 7, "AA"))
    assert "PartitionFilters: [isnotnull(ingest_date" in text
    assert "EqualTo(airline,AA)" in text


def test_top_k_is_a_top_k_plan(spark, silver_path):
    text = plan(facts.route_risk_facts(views.route_risk(spark.table("silver_plans"))))
    assert "TakeOrderedAndProject" in text


def test_latest_row_is_cut_before_the_shuffle(spark, sf_dir):
    text = plan(latest_per_doc(fx.documents(spark, sf_dir), ["content"]))
    assert text.count("WindowGroupLimit") == 2


def test_silver_table_is_partitioned_by_day(spark, silver_path):
    days = spark.table("silver_plans").select("ingest_date").distinct().count()
    parts = spark.sql("SHOW PARTITIONS silver_plans").count()
    assert days == parts == 30


def test_a_missing_folder_is_no_source(spark, tmp_path):
    assert tables.available(spark, str(tmp_path / "nothing")) is None
    spark.range(1).write.parquet(str(tmp_path / "some"))
    assert tables.available(spark, str(tmp_path / "some")).select(F.count("*")).collect()[0][0] == 1


def test_filters_share_one_run_of_silver(spark, sf_dir):
    """Four branches of a union would each sort the task's flights; stored flights are only filtered."""
    text = plan(QUERIES["optional_filters"](spark, sf_dir))
    assert text.count("FileScan parquet") == 4 and "Window" not in text and "Sort" not in text


def test_facts_of_one_airline_are_spread_over_tasks(spark, sf_dir):
    """Nearly all questions with an airline name the same one; their facts are ranked by many tasks."""
    from checks.requests import _fact_rows

    rows = _fact_rows(spark, sf_dir)
    held = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(held) >= 4 and max(held) < sum(held) / 2
    text = plan(QUERIES["first_fact"](spark, sf_dir))
    assert text.index("Exchange hashpartitioning(request_id") > text.index("Join")
