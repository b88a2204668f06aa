"""History (W6) against a plain window, ST4 late rows (G8) and the driver entry points."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from recspark.operators import history as H
from recspark.operators.history import build_history
from recspark.streaming import streams as ST

SF0001 = "/root/testdata/sf0.001"


def test_history_matches_plain_window(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 3), rnd.randint(0, 50), f"2024-01-{rnd.randint(1, 9):02d} {rnd.randint(0, 23):02d}:00:00", i)
            for i in range(300)]
    df = spark.createDataFrame(rows, "u long, item long, ts string, id long").withColumn("ts", F.to_timestamp("ts"))
    got = build_history(df, "u", "item", "ts", ["id"], 4, bucket="day")
    want = df.withColumn("history", F.collect_list("item").over(
        Window.partitionBy("u").orderBy("ts", "id").rowsBetween(-4, -1)))
    g = {r.id: r.history for r in got.collect()}
    w = {r.id: r.history for r in want.collect()}
    assert g == w


def test_late_rows_dropped(spark):
    from recspark.plans.q_streaming import _stream
    from recspark.streaming import streams as ST
    counts = {}
    for mode in ("complete", "update", "append"):
        agg = ST.windowed_counts(_stream(spark, SF0001, order=[1, 2, 0]), "ts", ["event_type"], "1 day")
        res = ST.run_to_table(agg, mode, keys=["window", "event_type"])
        counts[mode] = res.agg(F.sum("n")).first()[0]
    assert counts == {"complete": 1000, "update": 506, "append": 443}


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_range_buckets_match_plain_window_with_a_hot_user(spark):
    rnd = random.Random(8)
    # user 0 holds half of the rows, all on one day
    rows = [(0 if i % 2 == 0 else rnd.randint(1, 5), rnd.randint(0, 40), f"2024-01-01 {rnd.randint(0, 23):02d}:00:00", i)
            for i in range(600)]
    df = spark.createDataFrame(rows, "u long, item long, ts string, id long").withColumn("ts", F.to_timestamp("ts"))
    got = build_history(df, "u", "item", "ts", ["id"], 5, bucket="range", partitions=7)
    want = df.withColumn("history", F.collect_list("item").over(
        Window.partitionBy("u").orderBy("ts", "id").rowsBetween(-5, -1)))
    assert {r.id: r.history for r in got.collect()} == {r.id: r.history for r in want.collect()}


def test_history_with_null_items_and_users(spark):
    import random
    rnd = random.Random(12)
    rows = [(rnd.choice([1, 2, None]), rnd.choice([None, None, 10, 11, 12]), f"2024-01-{1 + i // 8:02d} 00:00:{i % 8:02d}", i)
            for i in range(120)]
    df = spark.createDataFrame(rows, "u long, i long, ts string, tie long").withColumn("ts", F.to_timestamp("ts"))
    want = {}
    for u, _, _, tie in rows:
        before = [i for v, i, _, t in rows if v == u and t < tie and i is not None]
        want[tie] = before[-3:]
    for n in (1, 5, 17):
        got = H.build_history(df, "u", "i", "ts", ["tie"], 3, partitions=n)
        assert {r.tie: r.history for r in got.collect()} == want
    assert {r.tie: r.history for r in H.build_history(df, "u", "i", "ts", ["tie"], 3, bucket="day").collect()} == want


def test_rows_without_a_time_are_replayed(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", 1), ("2024-01-02 00:00:00", 2), (None, 3)], "ts string, x long")
    df = df.withColumn("ts", F.to_timestamp("ts"))
    root, folders, per = ST.stage_event_files(df, "ts", ["2024-01-02 00:00:00"])
    assert len(folders) == 3
    out = ST.run_to_table(ST.read_file_stream(spark, root, df.schema, per), "append")
    assert sorted(r.x for r in out.collect()) == [1, 2, 3]


def test_a_small_range_does_not_funnel_the_others(spark):
    df = spark.range(400).select(F.when(F.col("id") == 0, "2024-01-01").otherwise("2024-01-02").cast("timestamp").alias("ts"), "id")
    root, folders, per = ST.stage_event_files(df, "ts", ["2024-01-02 00:00:00", "2024-01-03 00:00:00"], files_per_range=4)
    assert per == 4 and len(folders) == 3
    held = spark.read.parquet(folders[1]).groupBy(F.input_file_name()).count().collect()
    assert len(held) == 4 and max(r["count"] for r in held) <= 110
    batches = []
    (ST.read_file_stream(spark, root, df.schema, per).writeStream.foreachBatch(lambda b, i: batches.append(b.count()))
     .trigger(availableNow=True).start().awaitTermination())
    assert batches == [1, 399, 0]
