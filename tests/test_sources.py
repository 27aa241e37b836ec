import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from basketry import schemas
from basketry.config import Settings
from basketry.session import scratch_path, session_options, streaming_session
from basketry.sources import catalog, files, jdbc, kafka


def test_lake_paths():
    assert Settings(lake_root="/data").bronze("orders") == "file:///data/bronze/orders"
    assert Settings(lake_mode="cloud", lake_root="bucket/lake/").gold("x") == "s3a://bucket/lake/gold/x"
    assert Settings(lake_root="hdfs://n/lake").silver("cdc") == "hdfs://n/lake/silver/cdc"


def test_settings_from_env(monkeypatch):
    monkeypatch.setenv("BASKETRY_WATERMARK", "5 minutes")
    monkeypatch.setenv("BASKETRY_STATE_PARTITIONS", "48")
    s = Settings.from_env()
    assert (s.watermark, s.state_partitions, s.window) == ("5 minutes", 48, "1 minute")


def test_object_store_options():
    opts = session_options(Settings(lake_mode="cloud", object_store_endpoint="http://store:9000"))
    assert opts["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert not any("s3a" in k for k in session_options(Settings()))


def test_batches_can_be_bounded(monkeypatch):
    monkeypatch.setenv("BASKETRY_MAX_OFFSETS_PER_TRIGGER", "1000")
    monkeypatch.setenv("BASKETRY_DEDUP_METRICS", "false")
    s = Settings.from_env()
    assert kafka.kafka_options(s, ["orders"], "earliest")["maxOffsetsPerTrigger"] == "1000"
    assert s.dedup_metrics is False and s.max_ahead_minutes == 60


def test_kafka_options():
    s = Settings(kafka_servers="k:9092", kafka_min_partitions=24)
    opts = kafka.kafka_options(s, ["orders"], "latest", group="g")
    assert opts == {
        "kafka.bootstrap.servers": "k:9092", "subscribe": "orders", "startingOffsets": "latest",
        "failOnDataLoss": "false", "kafka.group.id": "g", "minPartitions": "24",
    }
    assert kafka.kafka_options(s, ["a", "b"], "earliest", False)["failOnDataLoss"] == "true"
    assert s.cdc_topics()[0] == "ecommerce_cdc.ecommerce_cdc.customers"


def test_missing_path_is_empty_but_other_errors_are_raised(spark, tmp_path):
    schema = schemas.bronze("orders")
    assert files.read_dataset(spark, f"{tmp_path}/none", schema).count() == 0
    with pytest.raises(Exception) as e:
        files.read_dataset(spark, "nosuchscheme://x/y", schema).count()
    assert not isinstance(e.value, AnalysisException)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        files.read_dataset(spark, f"{tmp_path}/bad", schema).count()


def test_catalog_registration(spark, tmp_path):
    path = f"{tmp_path}/bronze"
    small = schemas._schema("order_id string", "year int")
    wide = schemas._schema("order_id string", "note string", "year int")
    write = lambda row, cols: spark.createDataFrame([row], cols).write.partitionBy("year").mode("append").parquet(path)
    write(("a", 2023), "order_id string, year int")
    assert catalog.table_or_path(spark, "bronze_x", path, small).count() == 1
    catalog.register_dataset(spark, "bronze_x", path, small, ["year"])
    assert spark.table("bronze_x").count() == 1
    write(("b", "hi", 2024), "order_id string, note string, year int")
    catalog.register_dataset(spark, "bronze_x", path, wide, ["year"])
    got = sorted((r.order_id, r.note) for r in catalog.table_or_path(spark, "bronze_x", path, wide).collect())
    assert got == [("a", None), ("b", "hi")]
    catalog.refresh_statistics(spark, "bronze_x", ["order_id"])
    catalog.refresh_statistics(spark, "bronze_x")
    stats = spark.sql("DESCRIBE EXTENDED bronze_x").filter("col_name = 'Statistics'").first()
    assert "2 rows" in stats.data_type
    spark.sql("DROP TABLE bronze_x")


def test_merge_statement():
    assert jdbc.merge_statement("m.t", "m.t_stage", ["k"], ["k", "v"]) == (
        "INSERT INTO m.t (k, v) SELECT k, v FROM m.t_stage ON CONFLICT (k) DO UPDATE SET v = EXCLUDED.v"
    )
    assert jdbc.merge_statement("t", "s", ["k"], ["k"]).endswith("DO NOTHING")


def test_scratch_folders_lie_in_the_shared_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root) and a != b


def test_state_partitions_do_not_follow_the_batch_setting(spark):
    session = streaming_session(spark, Settings(state_partitions=6))
    assert session.conf.get("spark.sql.shuffle.partitions") == "6"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_small_single_file_is_split(spark, tmp_path):
    spark.range(400000).selectExpr("id", "cast(rand(1) as string) v").coalesce(1).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert files.split_for_cores(df).rdd.getNumPartitions() == 4
    assert files.split_for_cores(df, at_least=1 << 30) is df
