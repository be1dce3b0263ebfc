"""How the queries deal out the driver tables."""

import pytest
from pyspark.sql import functions as F

import workloads


def test_tasks_follow_the_rows_of_a_table(spark, tmp_path):
    spark.range(400_000).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))   # one row group
    rows = workloads.table(spark, str(tmp_path), "events")
    dealt = rows.groupBy(F.spark_partition_id()).count().agg(F.sum("count"), F.max("count")).first()
    assert dealt[0] == 400_000 and dealt[1] < 60_000


def test_a_small_table_is_dealt_to_all_cores(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    assert workloads.table(spark, str(tmp_path), "events").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("name", ["kv_comma_events", "json_ndjson_events", "timeline_normalise"])
def test_tasks_that_read_a_table_do_not_parse_it(spark, tmp_path, name):
    """A filter on lines below the dealing would have the few tasks that read render and trim all of them."""
    rows = spark.range(100).selectExpr(
        "id AS event_id", "timestamp_ntz '2024-01-01' AS ts", "id AS user_id", "'view' AS event_type", "'{\"k\": 1}' AS props")
    rows.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    plan = workloads.QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "FileScan parquet" in below and "Filter " not in below


def test_blanks_around_separators_and_fields_without_a_value(parse):
    fields = [{"target": "device_name", "source": "n a"}, {"target": "action", "source": "act"}, {"target": "user_name", "source": "\u00fc"}]
    (row,) = parse(workloads.kv_mapping(*fields), 't=0,lost,\u3000n a\u00a0=\t a = b\u2003, act , \u00fc = "x"  ,act= 1 ,=2,')
    assert (row["device_name"], row["action"], row["user_name"]) == ("a = b", "1", "x")


def test_one_file_is_sorted_by_many_tasks(spark, tmp_path):
    rows = spark.range(5000, 0, -1).select("id", F.concat(F.lit("\nn"), F.col("id").cast("string")).alias("value")).repartition(4)
    workloads._one_file(spark, rows, "id", str(tmp_path / "logs"))
    (file,) = (tmp_path / "logs").iterdir()
    assert file.read_text() == "".join(f"\nn{n}\n" for n in range(1, 5001))


def test_a_row_group_beside_empty_splits_is_dealt_out(spark, tmp_path, monkeypatch):
    """As many splits as tasks say nothing, where one of them has all rows."""
    monkeypatch.setattr(workloads, "ROWS_PER_TASK", 1000)
    spark.range(4000).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))   # one row group
    spark.conf.set("spark.sql.files.maxPartitionBytes", 2000)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        assert spark.read.parquet(str(tmp_path / "events.parquet")).rdd.getNumPartitions() >= 4
        dealt = workloads.table(spark, str(tmp_path), "events").groupBy(F.spark_partition_id()).count().agg(F.sum("count"), F.max("count")).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert dealt[0] == 4000 and dealt[1] <= 1010


def test_splits_that_are_even_stay(spark, tmp_path):
    spark.range(4000).repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    spark.conf.set("spark.sql.files.openCostInBytes", 128 << 20)   # a file a split
    try:
        assert "Exchange" not in workloads.table(spark, str(tmp_path), "events")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
