"""G1 Swing goldens and the split of heavy users into blocks."""

from pyspark.sql import functions as F

from recspark.operators import swing as sw

# four readers of five books; hand-worked: readers per book 11: 3, 12: 3, 13: 2, 14: 1, 15: 2
ROWS = [(7, 11, "2023-02-01 08:00:00"), (7, 12, "2023-02-02 08:00:00"), (8, 11, "2023-02-03 08:00:00"),
        (8, 12, "2023-02-03 09:00:00"), (8, 13, "2023-02-03 10:00:00"), (9, 12, "2023-03-01 08:00:00"),
        (9, 13, "2023-03-01 09:00:00"), (9, 14, "2023-03-01 10:00:00"), (9, 15, "2023-03-08 10:00:00"),
        (6, 11, "2023-03-09 08:00:00"), (6, 15, "2023-03-10 08:00:00"), (6, 15, "2023-03-10 09:00:00")]


def _log(spark):
    df = spark.createDataFrame(ROWS, "user_id long, item_id long, ts string")
    return df.withColumn("ts", F.to_timestamp("ts"))


def _rows(df):
    return sorted((r.item1, r.item2, round(r.swing_score, 6), r["rank"]) for r in df.collect())


def test_all_time(spark):
    # 11-12: 2 / (3 + 3 - 2); 12-13: 2 / (3 + 2 - 2); 13-14 and 14-15: 1 / (2 + 1 - 1)
    assert _rows(sw.swing(_log(spark), k=2)) == [
        (11, 12, 0.5, 1), (11, 13, 0.25, 2), (11, 15, 0.25, 2), (12, 13, 0.666667, 1), (12, 14, 0.333333, 2),
        (13, 14, 0.5, 1), (13, 15, 0.333333, 2), (14, 15, 0.5, 1)]


def test_windows(spark):
    # the last ten days: reader 9 from 8 March on has book 15 alone, reader 6 books 11 and 15
    assert _rows(sw.swing(_log(spark), days=3, k=2)) == [(11, 15, 0.5, 1)]
    assert _rows(sw.swing(_log(spark), days=1, k=2, as_of="2023-03-10 09:00:00")) == []
    assert _rows(sw.swing(_log(spark), days=3, k=2, as_of="2023-03-10 09:00:00")) == [(11, 15, 0.5, 1)]


def test_row_number_ties(spark):
    got = _rows(sw.swing(_log(spark), k=2, ties="row_number"))
    assert got[:2] == [(11, 12, 0.5, 1), (11, 13, 0.25, 2)] and len(got) == 7


def test_symmetric_scores_in_range(spark):
    out = sw.swing_scores(sw.swing_cooccurrence(_log(spark)), symmetric=True)
    vals = [r.swing_score for r in out.collect()]
    assert vals and all(0 < v <= 1 for v in vals)
    assert out.where((F.col("item1") == 12) & (F.col("item2") == 11)).count() == 1


def test_blocks_change_nothing(spark):
    import random
    rnd = random.Random(4)
    rows = [(u, rnd.randint(0, 60)) for u in range(15) for _ in range(rnd.randint(1, 80))]
    log = spark.createDataFrame(rows, "user_id long, item_id long")
    plain = sw.swing_cooccurrence(log)
    want = {}
    for u in range(15):
        items = sorted({i for w, i in rows if w == u})
        for a in items:
            for b in items:
                if a < b:
                    want[(a, b)] = want.get((a, b), 0) + 1
    for block in (1, 7, 2000):
        got = sw.swing_cooccurrence(log, block_items=block)
        assert {(r.item1, r.item2): r.co_occurrence_count for r in got.collect()} == want
    key = lambda d: sorted(map(tuple, d.collect()))
    assert key(sw.swing_sql(spark, log, k=3, block_items=5)) == key(
        sw.swing_recommend(sw.swing_scores(plain), k=3, ties="row_number"))


def test_no_task_faces_more_than_its_blocks(spark):
    log = spark.createDataFrame([(1, i) for i in range(3000)], "user_id long, item_id long")
    pairs = sw._pairs(sw._item_rows(log), 250)
    assert pairs.count() == 3000 * 2999 // 2
    joined = pairs._jdf.queryExecution().executedPlan().toString()
    assert "_i#" in joined and "_j#" in joined  # the join keys


def test_null_keys_dropped(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (None, 2), (1, 2)], "user_id long, item_id long")
    co = sw.swing_cooccurrence(df).collect()
    assert [(r.item1, r.item2, r.co_occurrence_count) for r in co] == [(1, 2, 1)]


def test_sql_form_matches_goldens(spark):
    assert _rows(sw.swing_sql(spark, _log(spark), k=2)) == _rows(sw.swing(_log(spark), k=2, ties="row_number"))
    assert _rows(sw.swing_sql(spark, _log(spark), k=2, days=3)) == [(11, 15, 0.5, 1)]


def test_exact_rolling_users_sends_no_row_to_every_day(spark):
    import datetime
    import random

    from recspark.operators import sketches as SK
    rnd = random.Random(2)
    first = datetime.date(2024, 1, 1)
    rows = {(rnd.choice("ab"), rnd.randrange(25), first + datetime.timedelta(rnd.randrange(120))) for _ in range(400)}
    seen = spark.createDataFrame([*rows, ("a", None, first), ("b", 3, None)], "brand string, user_id long, day date")
    out = SK.exact_rolling_users(seen, "brand", "user_id", 30)
    assert "sequence(" not in out._jdf.queryExecution().toString()
    got = {(r.brand, r.day): r.n_users for r in out.collect()}
    for brand, day in {(b, d) for b, _, d in rows}:
        assert got[brand, day] == len({u for b, u, d in rows if b == brand and day - datetime.timedelta(30) < d <= day})


def _random_log(spark, seed=6):
    import random
    rnd = random.Random(seed)
    rows = [(u, rnd.randint(0, 40) + 2**33 * (seed % 2)) for u in range(30) for _ in range(rnd.randint(0, 30))]
    return spark.createDataFrame([*rows, (None, 3), (4, None)], "user_id long, item_id long"), set(rows)


def _swing_by_hand(rows, symmetric):
    users = {}
    for u, i in rows:
        users.setdefault(i, set()).add(u)
    return {(a, b): (len(users[a] & users[b]), len(users[a]), len(users[b])) for a in users for b in users
            if (a != b if symmetric else a < b) and users[a] & users[b]}


def test_lists_blocks_and_slices_count_the_same_pairs(spark):
    for seed in (6, 7):  # items that fit an int, and items that don't
        log, rows = _random_log(spark, seed)
        for symmetric in (False, True):
            want = _swing_by_hand(rows, symmetric)
            for block, hot in ((2000, 50_000), (7, 50_000), (2000, 3), (5, 2)):
                got = sw.swing_cooccurrence(log, block, symmetric, hot)
                assert dict(got.dtypes) == {"item1": "bigint", "item2": "bigint", "item1_user_count": "bigint",
                                            "item2_user_count": "bigint", "co_occurrence_count": "bigint"}
                found = got.collect()
                assert len(found) == len(want)
                assert {(r.item1, r.item2): (r.co_occurrence_count, r.item1_user_count, r.item2_user_count)
                        for r in found} == want
    key = lambda d: sorted(map(tuple, d.collect()))
    assert key(sw.swing_sql(spark, log, k=3, block_items=5, hot_users=2)) == key(sw.swing(log, k=3, ties="row_number"))


def _behind_the_last_shuffle(df):
    """Operators from the top of the plan down to its first exchange."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = [line.lstrip(" :+-*(0123456789)") for line in plan.splitlines()]
    return lines[:next(i for i, line in enumerate(lines) if line.startswith("Exchange"))]


def test_pairs_are_made_behind_the_last_shuffle(spark):
    log, _ = _random_log(spark)
    for df in (sw.swing(log, k=3), sw.swing(log, k=3, symmetric=True), sw.swing_cooccurrence(log),
               sw.swing_sql(spark, log, k=3)):
        top = _behind_the_last_shuffle(df)
        assert any(line.startswith("Generate posexplode(ys") for line in top)
        assert any("count(1)" in line for line in top)


def test_lists_travel_in_as_few_bytes_as_items_and_counts_need(spark):
    import random
    rnd = random.Random(3)
    for kind, items in (("long", [-3, 5, 65_000, 65_540, 1 << 20]), ("long", [-(2**62), 0, 2**40, 2**61]),
                        ("long", [-(2**63), 7, 2**63 - 1]), ("int", [-(2**31), -1, 2**31 - 1]), ("short", [-300, 2, 299]),
                        ("string", ["a", "b", "c"])):
        rows = sorted({(u, rnd.choice(items)) for u in range(300) for _ in range(3)})
        log = spark.createDataFrame(rows, f"user_id long, item_id {kind}").repartition(3)
        for symmetric in (False, True):
            for block, hot in ((2000, 50_000), (1, 3)):
                got = sw.swing_cooccurrence(log, block, symmetric, hot)
                top = "\n".join(_behind_the_last_shuffle(got))
                whole = kind != "string" and items[-1] - items[0] < 2**62
                assert ("_bytes" in top) == whole and ("nys" in top) != whole  # no list of user counts
                assert {(r.item1, r.item2): (r.co_occurrence_count, r.item1_user_count, r.item2_user_count)
                        for r in got.collect()} == _swing_by_hand(set(rows), symmetric)
    sizes = sw.pair_sizes(log.select("user_id", F.lit(5).alias("item_id")), spark.createDataFrame([(5, 255), (65_540, 3)], "item_id int, n long"))
    assert (sizes.item_bytes, sizes.count_bytes) == (0, 1)
    sizes = sw.pair_sizes(log.select("user_id", F.lit(5).alias("item_id")), spark.createDataFrame([(5, 256), (65_541, 3)], "item_id int, n long"))
    assert (sizes.item_bytes, sizes.count_bytes) == (1, 2)
