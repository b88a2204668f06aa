"""Stored state (X2): every value and stage comes back equal, and unknown things fail clearly."""

import datetime as dt
import decimal
import json
import math

import numpy as np
import pytest

from recspark.operators import transformers as TR
from recspark.operators.base import Model, Stateless, load_model
from recspark.operators.state import read_value, write_value
from recspark.plans import pipeline as PL

COLUMNS = "city string, amount double, kind string, tags string, age long, at long, on boolean"
ROWS = [("rome", 3.5, "x", "a|b", 1, 1_700_000_000_000, True), (None, None, "y", None, 2, None, None),
        ("oslo", 0.0, None, "c", 2, 1_600_000_000_000, False), ("rome", 9.0, "x", "", None, 0, True)]

STAGES = {
    "fill": TR.MissingValueFiller([TR.FillSpec("age", "mean"), TR.FillSpec("city", "mode"), TR.FillSpec("kind", None, "?")]),
    "time": TR.TimeFeatureExtractor([TR.TimeSpec("at", "hour", "ms", "hour")]),
    "bool": TR.BooleanConverter(["on"]),
    "log": TR.LogTransformer([("amount", "amount_log")]),
    "hash": TR.HashTransformer([("city", "city_hash", 50)], method="md5"),
    "label": TR.CategoricalEncoder(["city", "kind"]),
    "frequency": TR.FrequencyLookup(["city"], min_count=1),
    "cross": TR.CrossFeatureCreator([["city", "kind"]]),
    "multi": TR.MultivaluedProcessor([TR.MultiValueSpec("tags", "tags_out", "|", 3, 40, hash_method="md5")]),
    "bins": TR.NumericalBinner(["amount"], 2),
    "quantiles": TR.NumericalBinner(["amount"], 2, strategy="quantile"),
    "minmax": TR.MinMaxNormalizer(["amount"]),
    "z": TR.ZScoreNormalizer(["amount"]),
    "select": PL.Select(["city", {"age": "years"}]),
    "clean": PL.ColumnCleaner(["tags", "at"], ["at"]),
    "ops": PL.OpsPipeline([{"col_in": "city", "col_out": "c", "fillna": "none",
                            "ops": [{"str_hash": {"num_embeddings": 9, "method": "md5"}}]}]),
}


@pytest.mark.parametrize("name", sorted(STAGES))
def test_every_stage_comes_back(spark, tmp_path, name):
    df = spark.createDataFrame(ROWS, COLUMNS)
    fitted = STAGES[name].fit(df)
    fitted.save(str(tmp_path))
    loaded = load_model(spark, str(tmp_path))
    assert type(loaded) is type(fitted)
    want, got = fitted.transform(df), loaded.transform(df)
    assert got.schema == want.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_values_come_back():
    values = [None, True, 3, -1.5, math.inf, -math.inf, "é\n", [1, [2.0]], (1, "a", ()), {1, 2}, frozenset({"x"}),
              {1: "a", (2, 3): None, "as": {"of": 1}}, dt.date(2020, 2, 29), dt.datetime(2021, 1, 2, 3, 4, 5, 6),
              decimal.Decimal("1.10"), b"\x00\xff", TR.TimeSpec("a", "b", "ms", "hour")]
    for v in values:
        got = read_value(json.loads(json.dumps(write_value(v))))
        assert got == v and type(got) is type(v)
    assert math.isnan(read_value(write_value(math.nan))) and write_value(np.float64(2.5)) == 2.5
    a = np.arange(6, dtype=np.int32).reshape(2, 3)
    back = read_value(json.loads(json.dumps(write_value(a))))
    assert back.dtype == a.dtype and (back == a).all()
    with pytest.raises(TypeError, match="state_type"):
        write_value({"f": len})
    with pytest.raises(ValueError, match="unknown kind"):
        read_value({"as": "code", "of": "1"})
    with pytest.raises(ValueError, match="unknown parameter class"):
        read_value({"as": "type", "of": ["os", {}]})


def _rewrite(spark, path, **changes):
    doc = json.loads(spark.read.text(f"{path}/state").first()["value"])
    spark.createDataFrame([(json.dumps({**doc, **changes}),)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path}/state")


def test_unknown_versions_and_classes_fail(spark, tmp_path):
    path = str(tmp_path / "m")
    TR.BooleanConverter(["on"]).save(path, spark)
    _rewrite(spark, path, version=99)
    with pytest.raises(ValueError, match="version 99"):
        load_model(spark, path)
    _rewrite(spark, path, version=1, **{"class": "Popen"})
    with pytest.raises(ValueError, match="unknown model 'Popen'"):
        load_model(spark, path)


def test_own_models_register_themselves(spark, tmp_path):
    class Doubler(Model):
        def transform(self, df):
            return df.withColumn("x", df.x * self.state["by"])

    Doubler({"by": 2}).save(str(tmp_path), spark)
    assert load_model(spark, str(tmp_path)).transform(spark.createDataFrame([(4,)], "x int")).first().x == 8


# --------------------------------------------------------------------------- one evaluation of the input per fit

def _counted(spark, df):
    """``df`` and an accumulator of the rows it has produced, over all jobs."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(len(b))
            yield b
    return df.mapInPandas(count, df.schema), made


def _all_stages():
    return [STAGES[n] for n in ("fill", "time", "log", "hash", "frequency", "cross", "multi", "bins", "quantiles")] + [
        TR.MinMaxNormalizer(["amount"], suffix="_mm"), STAGES["label"], PL.ColumnCleaner(["tags"], [])]


def test_stored_input_is_evaluated_once(spark):
    df = spark.createDataFrame(ROWS * 5, COLUMNS)
    source, made = _counted(spark, df)
    fitted = PL.FeaturePipeline(_all_stages(), store_input=True).fit(source)
    assert made.value == 20
    again, more = _counted(spark, df)
    plain = PL.FeaturePipeline(_all_stages()).fit(again)
    assert more.value > 20
    want, got = plain.transform(df), fitted.transform(df)
    assert want.schema == got.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_only_columns_that_stages_read_are_stored(spark):
    df = spark.createDataFrame(ROWS, COLUMNS)
    p = PL.FeaturePipeline([TR.CategoricalEncoder(["city"]), TR.ZScoreNormalizer(["amount"])], store_input=True)
    assert p._stored(df, p.stages).columns == ["city", "amount"]
    assert PL.FeaturePipeline([STAGES["log"], _Unknown()]).inputs() is None
    assert p._stored(df, [_Unknown()]).columns == df.columns


class _Unknown(Stateless):
    def inputs(self):
        return None


def test_columns_that_no_statistic_hangs_on_are_not_stored(spark):
    df = spark.createDataFrame([("a", True, 1.0, 5, "q"), ("b", False, None, 7, "r")], "city string, flag boolean, x double, ms long, other string")
    stages = [TR.MissingValueFiller([TR.FillSpec("x", "mean")]), TR.TimeFeatureExtractor([TR.TimeSpec("ms", "hour", "ms", "hour")]),
              TR.BooleanConverter(["flag"]), TR.LogTransformer([("x", "x_log")]), TR.CategoricalEncoder(["city"])]
    p = PL.FeaturePipeline(stages, store_input=True)
    assert p._stored(df, stages).columns == ["city", "x"]
    assert p._stored(df, [*stages[:4], TR.ZScoreNormalizer(["x_log"])]).columns == ["x"]
    assert p._stored(df, [*stages[:4], TR.CategoricalEncoder(["flag", "hour"])]).columns == ["flag", "x", "ms"]
    plain = PL.FeaturePipeline(stages).fit(df).transform(df)
    assert sorted(map(str, p.fit(df).transform(df).collect())) == sorted(map(str, plain.collect()))


def test_sides_of_the_streamed_log_are_worked_out_once(spark, tmp_path, monkeypatch):
    from recspark.plans import q_features as Q
    tables = {"lineitem": [(k, 1, k % 3, 2.0, 1.0 * k, 0.1, "R" if k % 2 else "N") for k in range(8)],
              "orders": [(k, k % 4 if k else None, None, "1-URGENT") for k in range(7)] + [(6, 1, None, "5-LOW")],
              "customer": [(k, 1.0, "BUILDING", 3) for k in (0, 1, 1, 2)], "part": [(k, "b", "t", "n m", 1.0) for k in range(2)]}
    kinds = {"lineitem": "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, "
                         "l_discount double, l_returnflag string",
             "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string",
             "customer": "c_custkey long, c_acctbal double, c_mktsegment string, c_nationkey int",
             "part": "p_partkey long, p_brand string, p_type string, p_name string, p_retailprice double"}
    for name, rows in tables.items():
        spark.createDataFrame(rows, kinds[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    want = Q.wide_log(spark, str(tmp_path))
    for most in (Q.SIDE_ROWS, 0):
        monkeypatch.setattr(Q, "SIDE_ROWS", most)
        got = Q.wide_log(spark, str(tmp_path), sides=Q.stored_sides(spark, str(tmp_path)))
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("Scan parquet") == 3 and "Aggregate" not in plan  # the log and two stored sides
        assert ("SortMergeJoin" in plan) == (most == 0)
