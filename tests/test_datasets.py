"""Datasets compiled from a spec (S9, S1, S3, S4) and the stored chain of Swing."""

import pytest

from recspark.operators.swing import swing
from recspark.operators.swing_tables import STEPS, swing_tables
from recspark.sources.datasets import compile_features, compile_sets, parse_sets
from recspark.sources.io import save_table
from recspark.sources.spec import load_spec

YML = """
train_set:
  set_name: clicks
  file_type: csv
  data_path: ['in\\a.txt', in/b.txt]
  sep: "\\t"
  header: null
  chunksize: 2048
  label_columns: [y]
  names: [user, item, y, place, spare]
val_set:
  set_name: held
  data_path: held.csv
  label_columns: [y]
combo_set:
  set_name: items
  data_path: items.csv
  join_type: merge
  join_on: [item]
  join_how: left
  join_set_names: [clicks, held]
pipelines:
  - {col_in: user, col_out: u, fillna: "0", ops: []}
  - {col_in: kind, col_out: k, fillna: none, ops: []}
  - {col_in: place_x, col_out: px, fillna: nowhere, ops: []}
  - {col_in: place_y, col_out: py, fillna: nowhere, ops: []}
  - {col_in: y, col_out: y, ops: []}
"""


@pytest.fixture
def files(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("1\ti1\t1\toslo\tz\n2\ti2\t0\t\tz\n")
    (tmp_path / "in" / "b.txt").write_text("3\ti9\tbad\trome\tz\n4\t\t1\trome\tz\n")
    (tmp_path / "held.csv").write_text("place,y,item,user\nbonn,1,i2,7\n")
    (tmp_path / "items.csv").write_text("item,kind,place,more\ni1,book,paris,1\ni2,,lima,2\n,ghost,x,3\n")
    (tmp_path / "spec.yml").write_text(YML)
    return tmp_path


def test_yaml_end_to_end(spark, files):
    out = compile_features(spark, load_spec(str(files / "spec.yml")), str(files))
    assert set(out) == {"clicks", "held"}
    rows = sorted(tuple(r) for r in out["clicks"].select("u", "k", "px", "py", "y").collect())
    assert rows == sorted([("1", "book", "oslo", "paris", 1), ("2", "none", "nowhere", "lima", 0),
                           ("3", "none", "rome", "nowhere", None), ("4", "none", "rome", "nowhere", 1)],
                          key=lambda r: r[0])
    assert [tuple(r) for r in out["held"].select("u", "k", "px", "py", "y").collect()] == [("7", "none", "bonn", "lima", 1)]


def test_only_named_columns_reach_the_scan(spark, files):
    spec = load_spec(str(files / "spec.yml"))
    pruned = compile_sets(spark, spec, str(files))["clicks"]
    assert pruned.columns == ["item", "user", "y", "place_x", "kind", "place_y"]
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "spare" not in plan and "more" not in plan
    whole = compile_sets(spark, spec, str(files), prune=False)["clicks"]
    assert {"spare", "more"} <= set(whole.columns)


def test_concat_comes_in_order_and_by_name(spark, files):
    spec = {"train_set": {"set_name": "a", "data_path": "held.csv"},
            "test_set": {"set_name": "b", "data_path": "items.csv", "join_type": "concat", "join_names": ["a"]},
            "pipelines": [{"col_in": c, "col_out": c} for c in ("place", "kind")]}
    out = compile_sets(spark, spec, str(files))
    assert sorted(map(tuple, out["a"].collect()), key=str) == sorted(
        [("bonn", None), ("lima", None), ("paris", "book"), ("x", "ghost")], key=str)
    assert out["b"].count() == 3  # taken as read


def _set(**changes):
    return {"train_set": {"set_name": "a", "data_path": "held.csv", **changes}}


@pytest.mark.parametrize("spec, words", [
    (_set(set_name=None), "train_set has no set_name"),
    (_set(data_path=[]), "'a' has no data_path"),
    (_set(file_type="excel"), "neither csv nor parquet"),
    (_set(join_type="cross"), "neither merge nor concat"),
    (_set(join_type="merge", join_names=["b"]), "merge needs join_on"),
    (_set(join_type="concat"), "concat needs join_names"),
    (_set(join_type="concat", join_names=["b"]), "joins unknown set 'b'"),
    (_set(join_type="concat", join_names=["a"]), "joins itself"),
    (_set(how="outer"), "neither inner nor left"),
    ({**_set(), "val_set": {"set_name": "a", "data_path": "x"}}, "two sets named 'a'"),
])
def test_wrong_declarations(spec, words):
    with pytest.raises(ValueError, match=words):
        parse_sets(spec)


def test_missing_columns_name_their_set(spark, files):
    with pytest.raises(ValueError, match="set 'a' has no columns \\['no'\\]"):
        compile_sets(spark, _set(label_columns=["no"]), str(files))
    spec = {**_set(), "combo_set": {"set_name": "i", "data_path": "items.csv", "join_type": "merge", "join_on": ["kind"],
                                    "join_names": ["a"]}}
    with pytest.raises(ValueError, match="set 'a' has no columns \\['kind'\\]"):
        compile_sets(spark, spec, str(files))
    with pytest.raises(ValueError, match="set 'a' has no columns \\['age'\\]"):
        compile_features(spark, {**_set(), "pipelines": [{"col_in": "age", "col_out": "age"}]}, str(files))


# --------------------------------------------------------------------------- stored Swing

def _exchanges(df) -> int:
    return sum(line.lstrip(" :+-").startswith("Exchange") for line in
               df._jdf.queryExecution().executedPlan().toString().splitlines())


def _log(spark):
    rows = [(u, (u * 7 + j * j) % 23) for u in range(40) for j in range(6)] * 2 + [(None, 1), (3, None)]
    return spark.createDataFrame(rows, "user_id int, item_id int")


def test_swing_tables_match_the_one_plan(spark, tmp_path):
    log = _log(spark)
    tables = swing_tables(log, "t_swing_match", k=4, buckets=3, location=str(tmp_path))
    assert set(tables) == set(STEPS)
    want = sorted(map(tuple, swing(log, k=4).collect()))
    assert sorted(map(tuple, tables["recs"].select("item1", "item2", "swing_score", "rank").collect())) == want and want


def test_tables_save_exchanges(spark, tmp_path):
    from recspark.operators.swing import swing_recommend, swing_scores
    from recspark.operators.swing_tables import bucketed_cooccurrence
    log = _log(spark)
    tables = swing_tables(log, "t_swing_plan", buckets=3, location=str(tmp_path))
    save_table(tables["user_items"], "t_swing_plain", location=str(tmp_path))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # large sides
    try:
        plain_ui = spark.table("t_swing_plain")
        plain_n = plain_ui.groupBy("item_id").count().withColumnRenamed("count", "n")
        plain = bucketed_cooccurrence(plain_ui, plain_n)
        stored = bucketed_cooccurrence(tables["user_items"], tables["item_users"])
        assert _exchanges(stored) < _exchanges(plain)
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert _exchanges(swing_recommend(tables["pairs"], 3)) == 0  # another k moves nothing
    assert _exchanges(swing_recommend(swing_scores(plain), 3)) > 0


def test_swing_tables_resume(spark, tmp_path):
    log = _log(spark)
    first = swing_tables(log, "t_swing_resume", k=2, buckets=2, location=str(tmp_path))
    n = first["recs"].count()
    spark.sql("DROP TABLE t_swing_resume_recs")
    empty = log.limit(0)  # kept tables are not written again
    again = swing_tables(empty, "t_swing_resume", k=2, buckets=2, location=str(tmp_path), resume=True)
    assert again["recs"].count() == n > 0


def test_swing_tables_of_nothing(spark, tmp_path):
    tables = swing_tables(_log(spark).limit(0), "t_swing_empty", buckets=2, location=str(tmp_path))
    assert all(t.count() == 0 for t in tables.values())


def test_bucketing_needs_a_table(spark, tmp_path):
    with pytest.raises(ValueError, match="buckets"):
        save_table(_log(spark), "x", path=str(tmp_path), bucket_by=["user_id"], buckets=2)
    with pytest.raises(ValueError, match="buckets"):
        save_table(_log(spark), "x", bucket_by=["user_id"])
