"""S9 spec files, E17 summary, P3/P4/P9 helpers, J7 lookup, X2 save/load, X1 registry."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from recspark.functions.registry import apply_ops, list_ops, register_op
from recspark.operators import transformers as TR
from recspark.operators.joins import join_with_suffixes, vocab_lookup
from recspark.plans.pipeline import Select, feature_columns, numeric_columns, pipeline_from_processor_spec
from recspark.sources.spec import dialect, load_spec, spec_summary

BASE_YML = """
dataset:
  name: demo
  column_names: [user_id, tag, dur]
NA_Processing:
  enabled: true
  default_fill_value: UNKNOWN
  features:
    - feature_name: tag
      fill_value: "x"
"""
FEATURE_YML = """
feature_processing:
  - feature_name: user_id
    feature_side: user
    feature_process:
      - col_in: user_id
        col_out: user_id
        function_name: HashTransform
        function_parameters: {hash_method: md5, vocabulary_size: 1000}
  - feature_name: tag
    feature_side: item
    feature_process:
      - col_in: tag
        col_out: tag_processed
        function_name: MultiValueTransform
        function_parameters: {sep: ",", hash_method: md5, vocabulary_size: 100, max_len: 3, padding_value: 0}
  - feature_name: dur
    feature_type: dense
    feature_process:
      - col_in: dur
        col_out: dur_log
        function_name: LogTransform
"""
PIPE_YML = """
train_set: {set_name: train, sep: "\\t", label_columns: [y]}
combo_set: {set_name: item, join_on: [item_id, cat], join_how: inner, join_set_names: [train]}
pipelines:
  - {col_in: user_id, col_out: user_id_emb, fillna: 0, feature_type: sparse, num_embeddings: 50,
     ops: [{str_hash: {num_embeddings: 50}}]}
  - {col_in: score, col_out: score_d, feature_type: dense, ops: [{clip: {min_value: 0, max_value: 1}}, log1p]}
  - {col_in: y, col_out: y, feature_type: sparse, num_embeddings: 2}
"""


def test_processor_spec_from_folder(spark):
    d = tempfile.mkdtemp(prefix="spec-")
    for name, text in (("base.yml", BASE_YML), ("feature.yml", FEATURE_YML)):
        with open(os.path.join(d, name), "w") as fh:
            fh.write(text)
    spec = load_spec(d)
    assert dialect(spec) == "processor" and spec["dataset"]["name"] == "demo"
    df = spark.createDataFrame([(1, "a,b", 3.0), (2, None, -1.0)], "user_id long, tag string, dur double")
    out = pipeline_from_processor_spec(spec).fit(df).transform(df)
    assert sorted(out.columns) == ["dur_log", "tag_processed", "user_id"]  # P1 cleaner dropped tag, dur
    rows = {r.user_id: r for r in out.collect()}
    assert all(len(r.tag_processed) == 3 for r in rows.values())
    summary = {r.feature: (r.kind, r.dim) for r in spec_summary(spark, spec).collect()}
    assert summary["dur_log"] == ("dense", 1) and summary["user_id"] == ("sparse", 8)


def test_pipeline_dialect_spellings(spark):
    d = tempfile.mkdtemp(prefix="spec-")
    p = os.path.join(d, "p.yml")
    with open(p, "w") as fh:
        fh.write(PIPE_YML)
    spec = load_spec(p)
    assert spec["combo_set"]["how"] == "inner" and spec["combo_set"]["join_names"] == ["train"]
    assert all(x["source"] == "context" for x in spec["pipelines"])
    s = {r.feature: (r.side, r.dim) for r in spec_summary(spark, spec).collect()}
    assert s["y"] == ("label", 0) and s["score_d"] == ("context", 1) and s["user_id_emb"][1] == 8


def test_feature_and_numeric_columns(spark):
    df = spark.createDataFrame([(1, 2, 0.5, "a", 1, ["x"], 3)],
                               "user_id long, is_click int, price double, seg string, price_bin int, "
                               "tags array<string>, code int")
    fc = feature_columns(df)
    assert fc["id"] == ["user_id"] and fc["label"] == ["is_click"] and fc["bin"] == ["price_bin"]
    assert fc["multi"] == ["tags"] and fc["categorical"] == ["seg"]
    assert numeric_columns(df, exclude=["user_id"]) == ["price"]
    sel = Select(["user_id", {"price": "p"}]).transform(df)
    assert sel.columns == ["user_id", "p"]


def test_vocab_lookup_and_suffixes(spark):
    df = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "v string")
    vocab = spark.createDataFrame([("a", 0), ("b", 1)], "value string, code long")
    out = [r.c for r in vocab_lookup(df, "v", vocab, "c", default=0).orderBy("v").collect()]
    assert sorted(out) == [0, 0, 0, 1]
    left = spark.createDataFrame([(1, 10)], "k long, n long")
    right = spark.createDataFrame([(1, 20)], "k long, n long")
    assert join_with_suffixes(left, right, "k").columns == ["k", "n_x", "n_y"]


def test_model_save_load(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "s string")
    m = TR.CategoricalEncoder(["s"]).fit(df)
    d = tempfile.mkdtemp(prefix="model-")
    m.save(d)
    loaded = TR.VocabModel.load(spark, d)
    got = sorted((r.s, r.s_encoded) for r in loaded.transform(df).collect())
    assert got == [("a", 0), ("b", 1), ("c", 2)]
    b = TR.NumericalBinner(["x"], 2).fit(spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double"))
    b.save(d + "-bins")
    assert TR.BinModel.load(spark, d + "-bins").state == b.state


def test_op_registry(spark):
    assert {"str_hash", "padding", "isoweekday"} <= set(list_ops())
    register_op("times_two", lambda c: c * 2)
    df = spark.createDataFrame([(3,)], "x long")
    assert df.select(apply_ops("x", ["times_two", {"clip": {"min_value": 0, "max_value": 5}}]).alias("y")).first().y == 5
    with pytest.raises(KeyError):
        apply_ops(F.col("x"), ["no_such_op"])


def test_package_is_shipped_to_workers(spark):
    """The pandas UDF path must import the package inside a worker."""
    import pandas as pd

    from recspark.session import ship_package

    ship_package(spark)
    ship_package(spark)  # idempotent per application

    def probe(pdf: pd.DataFrame) -> pd.DataFrame:
        import recspark.operators.rerank as rr  # noqa: F401 - must be importable on the worker
        return pdf.assign(ok=1)

    out = spark.range(4).groupBy("id").applyInPandas(probe, "id long, ok int").agg(F.sum("ok")).first()[0]
    assert out == 4


def _wide_spec(n=110):
    """A spec with over a hundred outputs over five input columns."""
    def step(i):
        fn, cin, params = [
            ("HashTransform", "city", {"vocabulary_size": 50 + i, "hash_method": "md5"}),
            ("LogTransform", "amount", {}),
            ("LabelEncodeTransform", "kind", {}),
            ("MultiValueTransform", "tags", {"sep": "|", "max_len": 2 + i % 4, "vocabulary_size": 40 + i, "hash_method": "md5"}),
        ][i % 4 if i < 4 or i % 4 != 2 else 0]
        return {"function_name": fn, "col_in": cin, "col_out": f"out{i}", "function_parameters": params}
    return {"dataset": {"column_names": ["city", "amount", "kind", "tags", "age"]},
            "NA_Processing": {"enabled": True, "features": [{"feature_name": "age", "strategy": "mean"}]},
            "feature_processing": [{"feature_name": f"f{i}", "feature_process": [step(i)]} for i in range(n)]}


def test_fitted_pipeline_is_stored_and_loaded(spark, tmp_path):
    from recspark.operators.base import load_model
    from recspark.plans.pipeline import PipelineModel, pipeline_from_processor_spec
    df = spark.createDataFrame([("rome", 3.5, "x", "a|b", 1), (None, None, "y", None, 2), ("oslo", 0.0, None, "c", 2), ("rome", 9.0, "x", "", None)],
                               "city string, amount double, kind string, tags string, age long")
    fitted = pipeline_from_processor_spec(_wide_spec(), clean=False).fit(df)
    fitted.save(str(tmp_path / "pipeline"))
    loaded = PipelineModel.load(spark, str(tmp_path / "pipeline"))
    want, got = fitted.transform(df), loaded.transform(df)
    assert got.columns == want.columns and len(got.columns) > 110
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    rows = want.select("city", "amount", "kind", "age").collect()
    assert {r.city for r in rows} == {"rome", "oslo", "UNKNOWN"} and {r.amount for r in rows} == {3.5, 0.0, 9.0}
    with pytest.raises(TypeError):
        TR.BinModel.load(spark, str(tmp_path / "pipeline"))
    cross = TR.CrossFeatureCreator([["city", "kind"]]).fit(df)
    cross.save(str(tmp_path / "cross"))
    assert sorted(map(str, load_model(spark, str(tmp_path / "cross")).transform(df).collect())) == sorted(
        map(str, cross.transform(df).collect()))
