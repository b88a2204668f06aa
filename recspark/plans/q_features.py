"""Feature-engineering queries.

The wide interaction log is ``lineitem JOIN orders`` (user = customer, item =
part) with the customer and part dimensions and per-part statistics joined on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.operators import profile as PR
from recspark.operators import sampling as SA
from recspark.operators import transformers as TR
from recspark.operators.joins import combo_merge, join_with_suffixes
from recspark.plans.catalog import REGISTRY, register
from recspark.plans.pipeline import FeaturePipeline, OpsPipeline, pipeline_from_processor_spec
from recspark.session import read_table, store_rows
from recspark.sources import io as IO
from recspark.sources.spec import load_spec


def _r(c, n=6):
    return F.round(c, n)


def customers_with_nulls(spark, sf) -> DataFrame:
    c = read_table(spark, sf, "customer")
    return c.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("acct"),
                    F.nullif(F.col("c_nationkey"), F.lit(3)).alias("nation"),
                    F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("seg"))


_CNULL = """cn AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS acct,
               nullif(c_nationkey, 3) AS nation, nullif(c_mktsegment, 'BUILDING') AS seg FROM customer)"""


@register("E1_A5_fill_missing", "WITH " + _CNULL + """,
st AS (SELECT avg(acct) AS m, quantile_cont(acct, 0.5) AS med FROM cn),
md AS (SELECT nation FROM cn WHERE nation IS NOT NULL GROUP BY nation ORDER BY count(*) DESC, nation LIMIT 1)
SELECT c_custkey, round(coalesce(acct, (SELECT m FROM st)), 6) AS acct_mean,
       round(coalesce(acct, (SELECT med FROM st)), 6) AS acct_median,
       CAST(coalesce(nation, (SELECT nation FROM md)) AS INTEGER) AS nation_mode,
       coalesce(seg, 'UNKNOWN') AS seg_literal, round(coalesce(acct, 0), 6) AS acct_zero
FROM cn""")
def q_fill(spark, sf):
    c = customers_with_nulls(spark, sf).withColumns({"acct_mean": F.col("acct"), "acct_median": F.col("acct"),
                                                     "nation_mode": F.col("nation"), "seg_literal": F.col("seg"),
                                                     "acct_zero": F.col("acct")})
    m = TR.MissingValueFiller([TR.FillSpec("acct_mean", "mean"), TR.FillSpec("acct_median", "median"),
                               TR.FillSpec("nation_mode", "mode"), TR.FillSpec("seg_literal", "UNKNOWN"),
                               TR.FillSpec("acct_zero", "zero")]).fit(c)
    out = m.transform(c)
    return out.select("c_custkey", _r("acct_mean").alias("acct_mean"), _r("acct_median").alias("acct_median"),
                      F.col("nation_mode").cast("int"), "seg_literal", _r("acct_zero").alias("acct_zero"))


@register("E2_time_features", """
WITH e AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE epoch_us(ts) // 1000 END AS ms,
                  epoch_us(ts) // 1000000 AS sec, strftime(ts, '%Y%m%d') AS ymd,
                  hour(ts) * 100 + minute(ts) AS hhmm FROM events)
SELECT event_id,
  coalesce(isodow(to_timestamp(ms // 1000)), -1) AS ms_dayofweek, coalesce(hour(to_timestamp(ms // 1000)), -1) AS ms_hour,
  month(to_timestamp(sec)) AS s_month, minute(to_timestamp(sec)) AS s_minute,
  isodow(strptime(ymd, '%Y%m%d')) - 1 AS str_weekday0, day(strptime(ymd, '%Y%m%d')) AS str_day,
  hhmm // 100 AS hm_hour, hhmm % 100 AS hm_minute, CAST(4 AS BIGINT) AS hm_dayofweek
FROM e""")
def q_time_features(spark, sf):
    ev = read_table(spark, sf, "events")
    e = ev.select("event_id", F.when(F.col("event_type") != "error", F.unix_millis("ts")).alias("ms"),
                  F.unix_seconds("ts").alias("sec"), F.date_format("ts", "yyyyMMdd").alias("ymd"),
                  (F.hour("ts") * 100 + F.minute("ts")).alias("hhmm"))
    specs = [TR.TimeSpec("ms", "ms_dayofweek", "ms", "dayofweek"), TR.TimeSpec("ms", "ms_hour", "ms", "hour"),
             TR.TimeSpec("sec", "s_month", "s", "month"), TR.TimeSpec("sec", "s_minute", "s", "minute"),
             TR.TimeSpec("ymd", "str_weekday0", "str", "weekday0", "%Y%m%d"),
             TR.TimeSpec("ymd", "str_day", "str", "day", "%Y%m%d"),
             TR.TimeSpec("hhmm", "hm_hour", "int_to_hour", "hour"),
             TR.TimeSpec("hhmm", "hm_minute", "int_to_minute", "minute"),
             TR.TimeSpec("hhmm", "hm_dayofweek", "int_to_hour", "dayofweek")]
    out = TR.TimeFeatureExtractor(specs).transform(e)
    return out.select("event_id", *[s.col_out for s in specs])


@register("E4_E11_label_and_cross_codes", """
SELECT p_partkey,
  CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS BIGINT) AS p_brand_encoded,
  CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS BIGINT) AS p_type_encoded,
  CAST(dense_rank() OVER (ORDER BY p_brand || '_' || p_type) - 1 AS BIGINT) AS p_brand_p_type_cross,
  p_size
FROM part""")
def q_label(spark, sf):
    p = read_table(spark, sf, "part")
    enc = TR.CategoricalEncoder(["p_brand", "p_type", "p_size"]).fit(p)  # p_size numeric: passed through (L6)
    out = enc.transform(p)
    cross = TR.CrossFeatureCreator([["p_brand", "p_type"]]).fit(out)
    out = cross.transform(out)
    return out.select("p_partkey", "p_brand_encoded", "p_type_encoded", "p_brand_p_type_cross", "p_size")


@register("E5_frequency_codes", """
WITH j AS (SELECT p.p_brand FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
v AS (SELECT p_brand, count(*) AS n FROM j GROUP BY p_brand),
c AS (SELECT p_brand, row_number() OVER (ORDER BY n DESC, p_brand) AS code FROM v)
SELECT p.p_partkey, CAST(coalesce(c.code, 0) AS BIGINT) AS p_brand_freq FROM part p LEFT JOIN c USING (p_brand)""")
def q_freq(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_partkey"])
    p = read_table(spark, sf, "part", ["p_partkey", "p_brand"])
    fit_on = li.join(p, F.col("l_partkey") == F.col("p_partkey")).select("p_brand")
    m = TR.FrequencyLookup(["p_brand"]).fit(fit_on)
    return m.transform(p).select("p_partkey", "p_brand_freq")


def _quantile_bins_sql(col: str, n: int) -> str:
    probs = ", ".join(str(i / n) for i in range(n + 1))
    return f"""(SELECT list_sort(list_distinct(quantile_cont({col}, [{probs}]))) FROM lineitem)"""


@register("E7_quantile_bins", f"""
WITH e AS (SELECT {_quantile_bins_sql('l_extendedprice', 10)} AS pe, {_quantile_bins_sql('l_quantity', 4)} AS qe)
SELECT l_orderkey, l_linenumber, l_partkey,
  CAST(len(list_filter(list_slice(pe, 2, len(pe) - 1), lambda x: x < l_extendedprice)) AS INTEGER) AS l_extendedprice_bin,
  CAST(len(list_filter(list_slice(qe, 2, len(qe) - 1), lambda x: x < l_quantity)) AS INTEGER) AS l_quantity_bin
FROM lineitem, e""")
def q_qbins(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"])
    m1 = TR.NumericalBinner(["l_extendedprice"], 10, "quantile").fit(li)
    m2 = TR.NumericalBinner(["l_quantity"], 4, "quantile").fit(li)
    return m2.transform(m1.transform(li)).select("l_orderkey", "l_linenumber", "l_partkey",
                                                 "l_extendedprice_bin", "l_quantity_bin")


@register("E8_width_bins", """
WITH s AS (SELECT min(p_retailprice) AS mn, max(p_retailprice) AS mx FROM part),
e AS (SELECT list_transform(range(1, 5), lambda i: i * ((mx - mn) / 5) + mn) AS inner_edges FROM s)
SELECT p_partkey, CAST(len(list_filter(inner_edges, lambda x: x < p_retailprice)) AS INTEGER) AS p_retailprice_bin
FROM part, e""")
def q_wbins(spark, sf):
    p = read_table(spark, sf, "part", ["p_partkey", "p_retailprice"])
    m = TR.NumericalBinner(["p_retailprice"], 5, "width").fit(p)
    return m.transform(p).select("p_partkey", "p_retailprice_bin")


@register("E9_E10_normalize", "WITH " + _CNULL + """,
s AS (SELECT min(acct) AS mn, max(acct) AS mx, quantile_cont(acct, 0.5) AS med, avg(acct) AS m, stddev_pop(acct) AS sd FROM cn)
SELECT c_custkey, round((coalesce(acct, med) - mn) / (mx - mn), 6) AS acct_minmax,
       round((coalesce(acct, m) - m) / sd, 6) AS acct_z
FROM cn, s""")
def q_norm(spark, sf):
    c = customers_with_nulls(spark, sf).withColumn("acct_z", F.col("acct")).withColumn("acct_minmax", F.col("acct"))
    out = TR.MinMaxNormalizer(["acct_minmax"]).fit(c).transform(c)
    out = TR.ZScoreNormalizer(["acct_z"]).fit(out).transform(out)
    return out.select("c_custkey", _r("acct_minmax").alias("acct_minmax"), _r("acct_z").alias("acct_z"))


# ----------------------------------------------------------------------------- E14 / E16 wide log

LINEITEM_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
                 "l_returnflag"]
SIDE_ROWS = 100_000


def wide_sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The sides of the wide log: orders with their user's columns and count, items with their count and mean price."""
    li = read_table(spark, sf, "lineitem", LINEITEM_COLS)
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
    c = read_table(spark, sf, "customer", ["c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey"])
    p = read_table(spark, sf, "part", ["p_partkey", "p_brand", "p_type", "p_name", "p_retailprice"])
    batch_log = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    ustat = batch_log.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("cnt"))
    istat = batch_log.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("cnt"),
                                                                        F.avg("l_extendedprice").alias("avg_price"))
    users = c.join(ustat, "c_custkey", "left")
    return (o.join(users, F.col("o_custkey") == F.col("c_custkey"), "left").drop("c_custkey"),
            p.join(istat, "p_partkey", "left"))


def stored_sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    """``wide_sides`` worked out once, for logs that are joined to them again and again.

    A side of more than ``SIDE_ROWS`` rows is never broadcast: a plan would
    guess its size from packed files.
    """
    sides = [store_rows(side) for side in wide_sides(spark, sf)]
    return tuple(side.hint("merge") if side.count() > SIDE_ROWS else side for side in sides)


def wide_log(spark, sf, lineitem: DataFrame | None = None, sides: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """J1/J2 (+J3 clash names): log LEFT JOIN user dim LEFT JOIN item dim / item stats.

    The user's columns are joined to the orders, which are fewer than the log's
    rows.  ``lineitem`` may be a stream: the dimensions and the user / item
    statistics (computed from the batch log) are static sides of
    stream-static joins; ``sides`` gives them stored.
    """
    li = read_table(spark, sf, "lineitem", LINEITEM_COLS) if lineitem is None else lineitem.select(*LINEITEM_COLS)
    orders, its = sides or wide_sides(spark, sf)
    w = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    w = join_with_suffixes(w.withColumnRenamed("l_partkey", "p_partkey"), its, "p_partkey", "left")
    return w.withColumns({"acct": F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")),
                          "seg": F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")),
                          "time_ms": F.unix_millis("o_orderdate"),
                          "date": F.date_format("o_orderdate", "yyyyMMdd"),
                          "is_return": F.col("l_returnflag") == "R"})


_WIDE_SQL = """
log AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_returnflag,
               o.o_custkey, o.o_orderdate, o.o_orderpriority
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
ustat AS (SELECT o_custkey AS c_custkey, count(*) AS cnt FROM log GROUP BY 1),
istat AS (SELECT l_partkey AS p_partkey, count(*) AS cnt, avg(l_extendedprice) AS avg_price FROM log GROUP BY 1),
w AS (SELECT log.*, c.c_acctbal, c.c_mktsegment, c.c_nationkey, us.cnt AS cnt_x,
             p.p_brand, p.p_type, p.p_name, p.p_retailprice, its.cnt AS cnt_y, its.avg_price,
             CASE WHEN c.c_acctbal >= 0 THEN c.c_acctbal END AS acct, nullif(c.c_mktsegment, 'BUILDING') AS seg
      FROM log LEFT JOIN customer c ON log.o_custkey = c.c_custkey LEFT JOIN ustat us ON us.c_custkey = log.o_custkey
      LEFT JOIN part p ON p.p_partkey = log.l_partkey LEFT JOIN istat its ON its.p_partkey = log.l_partkey)"""


def _md5b(x: str, n: int) -> str:
    return f"('0x' || substr(md5(CAST({x} AS VARCHAR)), 1, 15))::BIGINT % {n}"


WIDE_SPEC = {
    "NA_Processing": {"enabled": True, "default_fill_value": "UNKNOWN", "features": [
        {"feature_name": "acct", "strategy": "mean"}, {"feature_name": "seg", "fill_value": "UNKNOWN"}]},
    "feature_processing": [
        {"feature_name": "o_custkey", "feature_side": "user", "feature_process": [
            {"col_in": "o_custkey", "col_out": "user_id", "function_name": "HashTransform",
             "function_parameters": {"hash_method": "md5", "vocabulary_size": 1000000}}]},
        {"feature_name": "p_partkey", "feature_side": "item", "feature_process": [
            {"col_in": "p_partkey", "col_out": "item_id", "function_name": "HashTransform",
             "function_parameters": {"hash_method": "md5", "vocabulary_size": 1000000}}]},
        {"feature_name": "time_ms", "feature_side": "context", "feature_process": [
            {"col_in": "time_ms", "col_out": "dayofweek", "function_name": "TimeFeatureExtractTransform",
             "function_parameters": {"unit": "ms", "feature": "dayofweek"}},
            {"col_in": "date", "col_out": "month", "function_name": "TimeFeatureExtractTransform",
             "function_parameters": {"unit": "str", "feature": "month", "format": "%Y%m%d"}}]},
        {"feature_name": "is_return", "feature_type": "boolean", "feature_process": [
            {"col_in": "is_return", "col_out": "is_return", "function_name": "BooleanTransform"}]},
        {"feature_name": "l_extendedprice", "feature_type": "dense", "feature_process": [
            {"col_in": "l_extendedprice", "col_out": "l_extendedprice_log", "function_name": "LogTransform"},
            {"col_in": "acct", "col_out": "acct_log", "function_name": "LogTransform"}]},
        {"feature_name": "seg", "feature_process": [
            {"col_in": "seg", "col_out": "seg_encoded", "function_name": "LabelEncodeTransform"},
            {"col_in": "p_brand", "col_out": "p_brand_encoded", "function_name": "LabelEncodeTransform"}]},
        {"feature_name": "p_name", "feature_process": [
            {"col_in": "p_name", "col_out": "p_name_processed", "function_name": "MultiValueTransform",
             "function_parameters": {"sep": " ", "hash_method": "md5", "vocabulary_size": 1000, "max_len": 3,
                                     "padding_value": 0}}]},
    ],
}


@register("E14_P1_feature_pipeline", "WITH " + _WIDE_SQL + """,
f AS (SELECT *, coalesce(acct, (SELECT avg(acct) FROM w)) AS acct_f, coalesce(seg, 'UNKNOWN') AS seg_f FROM w)
SELECT l_orderkey, l_linenumber, """ + _md5b("o_custkey", 1000000) + " AS user_id, " + _md5b("l_partkey", 1000000) + """ AS item_id,
  isodow(o_orderdate) AS dayofweek, month(o_orderdate) AS month, CAST(l_returnflag = 'R' AS INTEGER) AS is_return,
  round(ln(1 + l_extendedprice), 6) AS l_extendedprice_log, round(CASE WHEN acct_f >= 0 THEN ln(1 + acct_f) ELSE 0 END, 6) AS acct_log,
  CAST(dense_rank() OVER (ORDER BY seg_f) - 1 AS BIGINT) AS seg_encoded,
  CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS BIGINT) AS p_brand_encoded,
  list_slice(list_concat(list_transform(string_split(p_name, ' '), lambda t: """ + _md5b("t", 1000) + """), [0, 0, 0]), 1, 3) AS p_name_processed,
  l_quantity, l_discount, o_orderpriority, c_nationkey, p_type, p_retailprice, cnt_x, cnt_y
FROM f""")
def q_pipeline(spark, sf):
    w = wide_log(spark, sf)
    spec = load_spec(WIDE_SPEC)
    model = pipeline_from_processor_spec(spec, store_input=True).fit(w)
    out = model.transform(w)
    return out.select("l_orderkey", "l_linenumber", "user_id", "item_id", "dayofweek", "month",
                      "is_return", _r("l_extendedprice_log").alias("l_extendedprice_log"),
                      _r("acct_log").alias("acct_log"), "seg_encoded", "p_brand_encoded",
                      F.col("p_name_processed").cast("array<bigint>"), "l_quantity", "l_discount",
                      "o_orderpriority", "c_nationkey", "p_type", "p_retailprice", "cnt_x", "cnt_y")


def _pipeline_out(out: DataFrame) -> DataFrame:
    return out.select("l_orderkey", "l_linenumber", "user_id", "item_id", "dayofweek", "month",
                      "is_return", _r("l_extendedprice_log").alias("l_extendedprice_log"),
                      _r("acct_log").alias("acct_log"), "seg_encoded", "p_brand_encoded",
                      F.col("p_name_processed").cast("array<bigint>"), "l_quantity", "l_discount",
                      "o_orderpriority", "c_nationkey", "p_type", "p_retailprice", "cnt_x", "cnt_y")


def q_pipeline_stream(spark, sf):
    """ST1 at full size: the E14 model fitted on the batch log, applied to lineitem
    replayed as a file stream (three ship-date ranges) - the result equals E14.

    The static sides are stored: every micro-batch would work them out anew."""
    from recspark.streaming import streams as ST
    sides = stored_sides(spark, sf)
    model = pipeline_from_processor_spec(load_spec(WIDE_SPEC), store_input=True).fit(wide_log(spark, sf, sides=sides))
    li = read_table(spark, sf, "lineitem", LINEITEM_COLS + ["l_shipdate"])
    root, _, per_batch = ST.stage_event_files(li, "l_shipdate", ["1995-01-01 00:00:00", "1998-01-01 00:00:00"])
    stream = ST.read_file_stream(spark, root, li.schema, files_per_trigger=per_batch)
    return ST.run_to_table(_pipeline_out(model.transform(wide_log(spark, sf, stream, sides))), "append")


@register("E16_wide_samples", "WITH " + _WIDE_SQL + """,
pe AS (SELECT list_sort(list_distinct(quantile_cont(l_extendedprice, [0.0, 0.25, 0.5, 0.75, 1.0]))) AS e FROM w),
mm AS (SELECT min(p_retailprice) AS mn, max(p_retailprice) AS mx FROM w)
SELECT l_orderkey, l_linenumber, isodow(o_orderdate) - 1 AS weekday0,
  CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS BIGINT) AS c_mktsegment_encoded,
  CAST(len(list_filter(list_slice(e, 2, len(e) - 1), lambda x: x < l_extendedprice)) AS INTEGER) AS l_extendedprice_bin,
  round((p_retailprice - mn) / (mx - mn), 6) AS p_retailprice_mm, cnt_x, cnt_y
FROM w, pe, mm""")
def q_wide_samples(spark, sf):
    w = wide_log(spark, sf).withColumns({"weekday0": F.weekday("o_orderdate").cast("long"),
                                         "p_retailprice_mm": F.col("p_retailprice")})
    stages = [TR.CategoricalEncoder(["c_mktsegment"]), TR.NumericalBinner(["l_extendedprice"], 4),
              TR.MinMaxNormalizer(["p_retailprice_mm"])]
    w = FeaturePipeline(stages, store_input=True).fit(w).transform(w)
    return w.select("l_orderkey", "l_linenumber", "weekday0", "c_mktsegment_encoded", "l_extendedprice_bin",
                    _r("p_retailprice_mm").alias("p_retailprice_mm"), "cnt_x", "cnt_y")


OPS_PIPELINES = [
    {"col_in": "o_custkey", "col_out": "user_id_emb", "fillna": 0, "feature_type": "sparse",
     "ops": [{"str_hash": {"num_embeddings": 1000, "method": "md5"}}]},
    {"col_in": "o_orderpriority", "col_out": "priority_emb", "fillna": "null", "feature_type": "varlen_sparse",
     "ops": [{"str_to_list": {"sep": "-"}}, {"padding": {"max_len": 3, "padding_value": "null"}},
             {"list_hash": {"num_embeddings": 48, "method": "md5"}}]},
    {"col_in": "o_totalprice_scaled", "col_out": "price", "fillna": 0, "feature_type": "dense",
     "ops": [{"clip": {"min_value": 0, "max_value": 1}}, "log1p"]},
    {"col_in": "o_secs", "col_out": "day", "ops": ["int_to_date", "get_day"]},
    {"col_in": "o_secs", "col_out": "wd", "ops": ["int_to_date", "isoweekday"]},
    {"col_in": "o_ymd", "col_out": "month", "ops": [{"str_to_date": {"format": "%Y-%m-%d"}}, "get_month"]},
    {"col_in": "o_orderkey", "col_out": "o_orderkey"},
]


@register("E15_S9_ops_pipeline", """
SELECT """ + _md5b("o_custkey", 1000) + """ AS user_id_emb,
  list_transform(list_slice(list_concat(string_split(o_orderpriority, '-'), ['null', 'null', 'null']), 1, 3), lambda t: """
       + _md5b("t", 48) + """) AS priority_emb,
  round(ln(1 + least(greatest(o_totalprice / 500000, 0), 1)), 6) AS price,
  CAST(day(o_orderdate) AS INTEGER) AS day, CAST(isodow(o_orderdate) AS INTEGER) AS wd,
  CAST(month(o_orderdate) AS INTEGER) AS month, o_orderkey
FROM orders""")
def q_ops(spark, sf):
    o = read_table(spark, sf, "orders")
    o = o.select("o_orderkey", "o_custkey", "o_orderpriority", (F.col("o_totalprice") / 500000).alias("o_totalprice_scaled"),
                 F.unix_seconds("o_orderdate").alias("o_secs"), F.date_format("o_orderdate", "yyyyMMdd").alias("o_ymd"))
    spec = load_spec({"train_set": {"set_name": "train", "join_how": "inner"}, "pipelines": OPS_PIPELINES})
    out = OpsPipeline(spec["pipelines"]).transform(o)
    return out.select("user_id_emb", "priority_emb", _r("price").alias("price"), F.col("day").cast("int"),
                      F.col("wd").cast("int"), F.col("month").cast("int"), "o_orderkey")


@register("E18_fold_rare", "WITH " + _CNULL + """,
k AS (SELECT nation FROM cn GROUP BY nation HAVING count(*) >= 60)
SELECT c_custkey, CASE WHEN cn.nation IS NULL THEN NULL WHEN k.nation IS NOT NULL THEN CAST(cn.nation AS VARCHAR)
                       ELSE '__rare__' END AS nation
FROM cn LEFT JOIN k ON cn.nation = k.nation""")
def q_fold(spark, sf):
    c = customers_with_nulls(spark, sf).select("c_custkey", "nation")
    return SA.fold_rare(c, ["nation"], 60).select("c_custkey", "nation")


@register("E19_negative_samples", """
WITH pos AS (SELECT DISTINCT o.o_custkey AS user_id, l.l_partkey AS item_id
             FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
cat AS (SELECT p_partkey AS neg, row_number() OVER (ORDER BY p_partkey) - 1 AS slot FROM (SELECT DISTINCT p_partkey FROM part)),
nc AS (SELECT count(*) AS n FROM cat),
kn AS (SELECT DISTINCT user_id, item_id FROM pos JOIN cat ON neg = item_id),
u AS (SELECT user_id, (SELECT n FROM nc) - count(kn.item_id) AS m FROM (SELECT DISTINCT user_id FROM pos) LEFT JOIN kn USING (user_id) GROUP BY 1),
others AS (SELECT user_id, neg, row_number() OVER (PARTITION BY user_id ORDER BY neg) - 1 AS r
           FROM u CROSS JOIN cat WHERE NOT EXISTS (SELECT 1 FROM kn WHERE kn.user_id = u.user_id AND kn.item_id = neg)),
d AS (SELECT user_id, item_id, draw,
             ((('0x' || substr(md5(CAST(user_id AS VARCHAR) || '|' || CAST(item_id AS VARCHAR) || '|7'), 1, 15))::BIGINT) % m
              + draw * (m // least(2, m))) % m AS r
      FROM pos JOIN u USING (user_id), range(0, 2) AS x(draw) WHERE m > 0 AND draw < least(2, m)),
k AS (SELECT d.user_id, others.neg FROM d JOIN others ON others.user_id = d.user_id AND others.r = d.r)
SELECT user_id, item_id, 1 AS label FROM pos
UNION ALL SELECT user_id, neg, 0 FROM k""")
def q_neg(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey"])
    pos = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")).distinct()
    items = read_table(spark, sf, "part", ["p_partkey"]).select(F.col("p_partkey").alias("item_id"))
    return SA.negative_samples(pos, items, n=2)


_DRAW = "(('0x' || substr(md5(CAST(user_id AS VARCHAR) || '|' || CAST(item_id AS VARCHAR) || '|7|{j}'), 1, 15))::BIGINT)"


@register("E19_independent_draws", f"""
WITH pos AS (SELECT DISTINCT o.o_custkey AS user_id, l.l_partkey AS item_id
             FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
cat AS (SELECT p_partkey AS neg FROM (SELECT DISTINCT p_partkey FROM part)),
kn AS (SELECT DISTINCT user_id, item_id FROM pos JOIN cat ON neg = item_id),
others AS (SELECT user_id, neg, row_number() OVER (PARTITION BY user_id ORDER BY neg) - 1 AS r, count(*) OVER (PARTITION BY user_id) AS m
           FROM (SELECT DISTINCT user_id FROM pos) u CROSS JOIN cat
           WHERE NOT EXISTS (SELECT 1 FROM kn WHERE kn.user_id = u.user_id AND kn.item_id = neg)),
u AS (SELECT DISTINCT user_id, m FROM others),
one AS (SELECT user_id, item_id, m, {_DRAW.format(j=1)} % m AS r FROM pos JOIN u USING (user_id)),
two AS (SELECT user_id, item_id, r, {_DRAW.format(j=2)} % (m - 1) AS x FROM one WHERE m > 1),
d AS (SELECT user_id, r FROM one UNION ALL SELECT user_id, CASE WHEN x >= r THEN x + 1 ELSE x END FROM two)
SELECT user_id, item_id, 1 AS label FROM pos
UNION ALL SELECT d.user_id, others.neg, 0 FROM d JOIN others ON others.user_id = d.user_id AND others.r = d.r""")
def q_neg_independent(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey"])
    pos = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")).distinct()
    items = read_table(spark, sf, "part", ["p_partkey"]).select(F.col("p_partkey").alias("item_id"))
    return SA.negative_samples(pos, items, n=2, draws="independent")


@register("E20_split", """
SELECT o_orderkey, CASE WHEN b < 0.7 THEN 'train' WHEN b < 0.9 THEN 'val' WHEN b < 1.0 THEN 'test' ELSE 'test' END AS split
FROM (SELECT o_orderkey, (('0x' || substr(md5('42|' || CAST(o_orderkey AS VARCHAR)), 1, 15))::BIGINT % 1000000) / 1000000.0 AS b FROM orders)""")
def q_split(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey"])
    return SA.split_by_hash(o, ["o_orderkey"], {"train": 0.7, "val": 0.2, "test": 0.1}, seed=42)


@register("A11_value_counts", """
SELECT 'c_mktsegment' AS "column", c_mktsegment AS value, count(*) AS count FROM customer GROUP BY 2
UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), count(*) FROM customer GROUP BY 2""")
def q_vc(spark, sf):
    return PR.value_counts(read_table(spark, sf, "customer"), ["c_mktsegment", "c_nationkey"])


@register("A12_numeric_profile", """
SELECT 'l_extendedprice' AS "column", count(l_extendedprice) AS count, CAST(0 AS BIGINT) AS nulls,
       round(min(l_extendedprice), 6) AS min, round(max(l_extendedprice), 6) AS max, round(avg(l_extendedprice), 6) AS mean,
       round(stddev_pop(l_extendedprice), 6) AS std,
       list_transform(quantile_cont(l_extendedprice, [0.0, 0.1, 0.5, 0.9, 1.0]), lambda x: round(x, 6)) AS percentiles FROM lineitem
UNION ALL
SELECT 'l_quantity', count(l_quantity), 0, round(min(l_quantity), 6), round(max(l_quantity), 6), round(avg(l_quantity), 6),
       round(stddev_pop(l_quantity), 6),
       list_transform(quantile_cont(l_quantity, [0.0, 0.1, 0.5, 0.9, 1.0]), lambda x: round(x, 6)) FROM lineitem""")
def q_profile(spark, sf):
    p = PR.numeric_profile(read_table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"],
                           [0.0, 0.1, 0.5, 0.9, 1.0])
    return p.select("column", "count", "nulls", *[_r(c).alias(c) for c in ("min", "max", "mean", "std")],
                    F.transform("percentiles", lambda x: F.round(x, 6)).alias("percentiles"))


@register("A9_A14_nulls_and_lengths", """
SELECT CAST(len(string_split(p_name, ' ')) AS INTEGER) AS length, count(*) AS count FROM part GROUP BY 1""")
def q_len(spark, sf):
    from recspark.functions.scalars import str_to_list
    p = read_table(spark, sf, "part").select(str_to_list("p_name", " ").alias("toks"))
    return PR.list_length_counts(p, "toks")


@register("J4_S4_multikey_merge", """
WITH st AS (SELECT l_partkey, l_suppkey, count(*) AS n, round(avg(l_extendedprice), 6) AS avg_price
            FROM lineitem GROUP BY 1, 2)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, st.n, st.avg_price
FROM lineitem l JOIN st ON l.l_partkey = st.l_partkey AND l.l_suppkey = st.l_suppkey""")
def q_merge(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    st = li.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"),
                                                   F.round(F.avg("l_extendedprice"), 6).alias("avg_price"))
    return combo_merge(li.drop("l_extendedprice"), st, ["l_partkey", "l_suppkey"], "inner")


@register("S3_S5_S10_stack_head_sentinel", """
SELECT o_orderkey, o_custkey, nullif(CAST(o_orderkey % 7 AS BIGINT) - 1, -1) AS shard_or_null FROM
  (SELECT * FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT * FROM orders WHERE o_orderstatus <> 'F')
ORDER BY o_orderkey LIMIT 100""")
def q_stack(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    stacked = IO.concat_sets([o.where(F.col("o_orderstatus") == "F"), o.where(F.col("o_orderstatus") != "F")])
    d = stacked.withColumn("shard_or_null", F.pmod("o_orderkey", F.lit(7)) - 1)
    d = IO.sentinel_to_null(d, ["shard_or_null"])
    return IO.sample_head(d, 100, ["o_orderkey"]).select("o_orderkey", "o_custkey", "shard_or_null")


@register("A9_all_null_columns", "WITH " + _CNULL + """
SELECT 'acct' AS "column", count(acct) = 0 AS all_null FROM cn
UNION ALL SELECT 'nation', count(nation) = 0 FROM cn
UNION ALL SELECT 'seg', count(seg) = 0 FROM cn
UNION ALL SELECT 'never', count(CASE WHEN acct > 1e12 THEN acct END) = 0 FROM cn""")
def q_all_null(spark, sf):
    c = customers_with_nulls(spark, sf).withColumn("never", F.when(F.col("acct") > 1e12, F.col("acct")))
    return PR.all_null_columns(c, ["acct", "nation", "seg", "never"])


register("ST1_stream_feature_pipeline", REGISTRY["E14_P1_feature_pipeline"].sql)(q_pipeline_stream)
