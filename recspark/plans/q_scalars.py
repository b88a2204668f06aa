"""Scalar-function queries (F1-F31, S10, M6, M12) over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from recspark.functions import scalars as S
from recspark.functions.hashing import list_hash, str_hash
from recspark.functions.registry import apply_ops
from recspark.plans.catalog import register
from recspark.session import read_table


def _r(c, n=6):
    return F.round(c, n)


@register("F1_str_hash", """
SELECT p_partkey,
  ('0x' || substr(md5(CAST(p_partkey AS VARCHAR)), 1, 15))::BIGINT % 1000000 AS key_md5,
  ('0x' || substr(md5(p_name), 1, 15))::BIGINT % 1000 AS name_md5,
  ('0x' || substr(sha256(p_brand), 1, 15))::BIGINT % 97 AS brand_sha256
FROM part""")
def q_hash(spark, sf):
    p = read_table(spark, sf, "part")
    return p.select("p_partkey", str_hash("p_partkey", 1_000_000, "md5").alias("key_md5"),
                    str_hash("p_name", 1000, "md5").alias("name_md5"),
                    str_hash("p_brand", 97, "sha256").alias("brand_sha256"))


@register("F2_F5_split_hash_pad", """
SELECT p_partkey,
  string_split(p_name, ' ') AS tokens,
  list_transform(string_split(p_name, ' '), lambda t: ('0x' || substr(md5(t), 1, 15))::BIGINT % 100) AS hashed,
  list_slice(list_concat(list_transform(string_split(p_name, ' '),
      lambda t: ('0x' || substr(md5(t), 1, 15))::BIGINT % 100), [0, 0, 0]), 1, 3) AS hashed_padded,
  list_transform(list_slice(list_concat(string_split(p_name, ' '), ['null', 'null', 'null']), 1, 3),
      lambda t: ('0x' || substr(md5(t), 1, 15))::BIGINT % 100) AS padded_hashed,
  list_transform([p_name, p_type], lambda t: string_split(t, 'a')) AS split_each
FROM part""")
def q_split(spark, sf):
    p = read_table(spark, sf, "part")
    toks = S.str_to_list("p_name", " ")
    return p.select("p_partkey", toks.alias("tokens"),
                    list_hash(toks, 100, "md5").alias("hashed"),
                    S.padding(list_hash(toks, 100, "md5"), 3, 0).cast("array<bigint>").alias("hashed_padded"),
                    list_hash(S.padding(toks, 3, "null"), 100, "md5").alias("padded_hashed"),
                    S.list_str_split(F.array("p_name", "p_type"), "a").alias("split_each"))


@register("F6_F8_numeric", """
SELECT l_orderkey, l_linenumber,
  round(ln(1 + l_quantity), 6) AS qty_log1p,
  CAST(floor(l_extendedprice / 1000) AS BIGINT) AS price_k,
  CAST(floor(-l_extendedprice / 1000) AS BIGINT) AS neg_price_k,
  CASE WHEN l_discount IS NULL THEN NULL ELSE least(greatest(l_discount, 0.02), 0.08) END AS disc_clip,
  round(CASE WHEN l_tax - 0.04 >= 0 THEN ln(1 + l_tax - 0.04) ELSE 0 END, 6) AS tax_log_feature
FROM lineitem""")
def q_numeric(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", _r(S.log1p("l_quantity")).alias("qty_log1p"),
                     S.floor_divide("l_extendedprice", 1000).alias("price_k"),
                     S.floor_divide(-F.col("l_extendedprice"), 1000).alias("neg_price_k"),
                     S.clip("l_discount", 0.02, 0.08).alias("disc_clip"),
                     _r(S.safe_log_feature(F.col("l_tax") - 0.04)).alias("tax_log_feature"))


@register("F9_F18_time_parts", """
WITH e AS (SELECT event_id, ts, epoch_us(ts) // 1000000 AS sec, epoch_us(ts) // 1000 AS ms,
                  strftime(ts, '%Y%m%d') AS ymd, strftime(ts, '%Y-%m-%d') AS ymd_dash,
                  (hour(ts) * 100 + minute(ts)) * (CASE WHEN event_type = 'error' THEN 25 ELSE 1 END) AS hhmm
           FROM events)
SELECT event_id,
  strftime(to_timestamp(sec), '%Y-%m-%d %H:%M:%S') AS from_sec,
  strftime(to_timestamp(floor(ms / 1000)), '%Y-%m-%d %H:%M:%S') AS from_ms,
  strftime(strptime(ymd, '%Y%m%d'), '%Y-%m-%d %H:%M:%S') AS from_ymd,
  strftime(strptime(ymd_dash, '%Y-%m-%d'), '%Y-%m-%d %H:%M:%S') AS from_dash_with_ymd_format,
  day(ts) AS d, hour(ts) AS h, minute(ts) AS mi, month(ts) AS mo,
  isodow(ts) AS iso_wd, isodow(ts) - 1 AS wd0,
  CASE WHEN hhmm < 2400 AND hhmm % 100 < 60 THEN hhmm // 100 END AS hhmm_hour,
  CASE WHEN hhmm < 2400 AND hhmm % 100 < 60 THEN hhmm % 100 END AS hhmm_minute
FROM e""")
def q_time(spark, sf):
    ev = read_table(spark, sf, "events")
    e = ev.select("event_id", "ts", F.unix_seconds("ts").alias("sec"), F.unix_millis("ts").alias("ms"),
                  F.date_format("ts", "yyyyMMdd").alias("ymd"), F.date_format("ts", "yyyy-MM-dd").alias("ymd_dash"),
                  ((F.hour("ts") * 100 + F.minute("ts")) *
                   F.when(F.col("event_type") == "error", 25).otherwise(1)).alias("hhmm"))
    fmt = "yyyy-MM-dd HH:mm:ss"
    return e.select(
        "event_id",
        F.date_format(S.int_to_date("sec"), fmt).alias("from_sec"),
        F.date_format(S.ms_to_timestamp("ms"), fmt).alias("from_ms"),
        F.date_format(S.str_to_date("ymd", "%Y%m%d"), fmt).alias("from_ymd"),
        F.date_format(S.str_to_date("ymd_dash", "%Y%m%d"), fmt).alias("from_dash_with_ymd_format"),
        S.get_day("ts").cast("long").alias("d"), S.get_hour("ts").cast("long").alias("h"),
        S.get_minute("ts").cast("long").alias("mi"), S.get_month("ts").cast("long").alias("mo"),
        S.iso_weekday("ts").cast("long").alias("iso_wd"), S.weekday0("ts").cast("long").alias("wd0"),
        S.hhmm_hour("hhmm").cast("long").alias("hhmm_hour"), S.hhmm_minute("hhmm").cast("long").alias("hhmm_minute"))


@register("F19_F23_conversions", """
SELECT c_custkey,
  CAST(c_acctbal > 0 AS INTEGER) AS positive_flag,
  list_filter(list_transform(string_split(CAST(c_custkey AS VARCHAR) || ',x,' || CAST(c_nationkey AS VARCHAR), ','),
      lambda t: TRY_CAST(trim(t) AS BIGINT)), lambda v: v IS NOT NULL) AS int_list,
  concat_ws('_', coalesce(c_mktsegment, 'nan'), coalesce(CAST(c_nationkey AS VARCHAR), 'nan'),
            coalesce(CAST(nullif(c_nationkey, 3) AS VARCHAR), 'nan')) AS cross_str,
  coalesce(nullif(c_mktsegment, 'BUILDING'), 'UNKNOWN') AS seg_filled,
  CAST(nullif(c_nationkey, 3) AS BIGINT) AS nation_sentinel_null,
  list_sort(map_keys(map_from_entries([
      {'k': 'seg', 'v': string_split(c_mktsegment, ',')},
      {'k': 'nat', 'v': string_split(CAST(c_nationkey AS VARCHAR) || ',' || CAST(c_custkey AS VARCHAR), ',')}
  ]))) AS prop_keys,
  string_split(CAST(c_nationkey AS VARCHAR) || ',' || CAST(c_custkey AS VARCHAR), ',') AS prop_nat
FROM customer""")
def q_conv(spark, sf):
    c = read_table(spark, sf, "customer")
    prop = F.concat(F.lit("seg:"), F.col("c_mktsegment"), F.lit(";nat:"), F.col("c_nationkey").cast("string"),
                    F.lit(","), F.col("c_custkey").cast("string"), F.lit(";"))
    m = S.property_map(prop)
    return c.select(
        "c_custkey", S.bool_to_int(F.col("c_acctbal") > 0).alias("positive_flag"),
        S.csv_to_long_list(F.concat_ws(",x,", F.col("c_custkey").cast("string"),
                                       F.col("c_nationkey").cast("string"))).alias("int_list"),
        S.cross_string(["c_mktsegment", "c_nationkey", F.nullif(F.col("c_nationkey"), F.lit(3))]).alias("cross_str"),
        S.fill_value(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), "UNKNOWN").alias("seg_filled"),
        S.sentinel_to_null("c_nationkey", 3).cast("long").alias("nation_sentinel_null"),
        F.array_sort(F.map_keys(m)).alias("prop_keys"), m["nat"].alias("prop_nat"))


_VEC_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
f AS (SELECT vec_id, e, list_slice(e, 1, 4) AS f0, list_slice(e, 5, 8) AS f1, list_slice(e, 9, 12) AS f2 FROM v)
"""


@register("F24_F28_vectors", _VEC_SQL + """
SELECT vec_id,
  round(list_dot_product(e, list_reverse(e)), 6) AS dot_rev,
  round(sqrt(list_dot_product(e, e)), 6) AS l2,
  round(e[1] / sqrt(list_dot_product(e, e)), 6) AS unit_first,
  round(list_sum(list_transform(list_zip(f0, f1), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 6) AS sqdist_f0_f1,
  round(1 / (1 + exp(-e[1] * 10)), 6) AS sig,
  list_transform(list_transform(f0, lambda x: exp(x - list_max(f0)) / list_sum(list_transform(f0, lambda y: exp(y - list_max(f0))))), lambda z: round(z, 6)) AS softmax_f0,
  round((1 / (1 + exp(-e[1] * 10))) * (1 / (1 + exp(-e[2] * 10))), 6) AS ctcvr,
  list_transform(list_slice(e, 1, 8), lambda x: round(x, 6)) AS prefix8
FROM f""")
def q_vectors(spark, sf):
    v = read_table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    e = F.col("e")
    f0, f1 = F.slice(e, 1, 4), F.slice(e, 5, 4)
    rnd = lambda a: F.transform(a, lambda x: F.round(x, 6))
    return v.select(
        "vec_id", _r(S.dot(e, F.reverse(e))).alias("dot_rev"), _r(S.l2_norm(e)).alias("l2"),
        _r(F.element_at(S.l2_normalize(e), 1)).alias("unit_first"),
        _r(S.sq_l2_distance(f0, f1)).alias("sqdist_f0_f1"),
        _r(S.sigmoid(F.element_at(e, 1) * 10)).alias("sig"), rnd(S.softmax(f0)).alias("softmax_f0"),
        _r(S.ctcvr(F.element_at(e, 1) * 10, F.element_at(e, 2) * 10)).alias("ctcvr"),
        rnd(S.vector_prefix(e, 8)).alias("prefix8"))


@register("F29_prefix_ngrams", """
WITH c AS (SELECT vec_id, list_transform(list_slice(embedding, 1, 3),
                  lambda x: CAST(floor((x + 1) * 1000) AS BIGINT)) AS codes FROM embeddings)
SELECT vec_id, codes,
  [codes[1], codes[1] * 2048 + codes[2], (codes[1] * 2048 + codes[2]) * 2048 + codes[3]] AS ngrams,
  [codes[1] % 1000000, (codes[1] * 2048 + codes[2]) % 1000000,
   ((codes[1] * 2048 + codes[2]) * 2048 + codes[3]) % 1000000] AS ngrams_hashed
FROM c""")
def q_ngrams(spark, sf):
    v = read_table(spark, sf, "embeddings")
    codes = F.transform(F.slice("embedding", 1, 3), lambda x: F.floor((x.cast("double") + 1) * 1000).cast("long"))
    c = v.select("vec_id", codes.alias("codes"))
    return c.select("vec_id", "codes", S.prefix_ngrams("codes", 2048).alias("ngrams"),
                    S.prefix_ngrams("codes", 2048, 1_000_000).alias("ngrams_hashed"))


@register("F30_M12_pairwise_products", _VEC_SQL + """
SELECT vec_id, list_transform([
    list_transform(list_zip(f0, f1), lambda p: round(p[1] * p[2], 6)),
    list_transform(list_zip(f0, f2), lambda p: round(p[1] * p[2], 6)),
    list_transform(list_zip(f1, f2), lambda p: round(p[1] * p[2], 6))], lambda x: x) AS pair_products
FROM f""")
def q_pairs(spark, sf):
    v = read_table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    fields = F.array(F.slice("e", 1, 4), F.slice("e", 5, 4), F.slice("e", 9, 4))
    pp = S.pairwise_products(fields)
    return v.select("vec_id", F.transform(pp, lambda a: F.transform(a, lambda x: F.round(x, 6))).alias("pair_products"))


@register("M6_fm_second_order", _VEC_SQL + """
SELECT vec_id, round(0.5 * list_sum(list_transform(range(1, 5), lambda d:
    (f0[d] + f1[d] + f2[d]) * (f0[d] + f1[d] + f2[d]) - (f0[d] * f0[d] + f1[d] * f1[d] + f2[d] * f2[d]))), 6) AS fm2
FROM f""")
def q_fm2(spark, sf):
    v = read_table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    fields = F.array(F.slice("e", 1, 4), F.slice("e", 5, 4), F.slice("e", 9, 4))
    return v.select("vec_id", _r(S.fm_second_order_array(fields)).alias("fm2"))


@register("F31_X1_op_chain", """
SELECT o_orderkey,
  list_transform(list_slice(list_concat(string_split(o_orderpriority, '-'), ['null', 'null', 'null']), 1, 3),
      lambda t: ('0x' || substr(md5(t), 1, 15))::BIGINT % 50) AS prio_tokens,
  round(ln(1 + least(greatest(o_totalprice / 100000, 0), 1)), 6) AS price_clip_log,
  isodow(o_orderdate) AS order_wd
FROM orders""")
def q_opchain(spark, sf):
    o = read_table(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        apply_ops("o_orderpriority", [{"str_to_list": {"sep": "-"}},
                                      {"padding": {"max_len": 3, "padding_value": "null"}},
                                      {"list_hash": {"num_embeddings": 50, "method": "md5"}}]).alias("prio_tokens"),
        _r(apply_ops(F.col("o_totalprice") / 100000, [{"clip": {"min_value": 0, "max_value": 1}}, "log1p"]))
        .alias("price_clip_log"),
        apply_ops(F.unix_seconds("o_orderdate"), ["int_to_date", "isoweekday"]).cast("long").alias("order_wd"))
