"""Fit / transform contract.

An ``Estimator.fit(df)`` runs Spark aggregates and returns a ``Model`` whose
state is small (statistics, bin edges), plus optional DataFrame state
(vocabularies).  ``Model.transform`` is lazy: it only adds column expressions
or joins, so the same fitted model runs on batch tables and on streams.

``save`` writes a folder through Spark's own writers, so any file system that
Spark reaches will do: ``state`` holds one line of JSON (see
``recspark.operators.state``), ``table=<name>`` each table, ``part=<i>`` the
models a model is made of.  ``load_model`` gives back an equal model of the
class that was saved.  Loading reads data only: no code stored in the folder
is run, and a class or version that is not registered is an error.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from recspark.operators.state import VERSION, model_class, read_value, register_model, write_value


class Model:
    name = "model"

    def __init__(self, state: dict, tables: dict[str, DataFrame] | None = None):
        self.state = state
        self.tables = tables or {}

    def __init_subclass__(cls, **kwargs):
        super().__init_subclass__(**kwargs)
        register_model(cls)

    def transform(self, df: DataFrame) -> DataFrame:  # pragma: no cover - abstract
        raise NotImplementedError

    def _parts(self) -> list[tuple[str, Model]]:
        """Models among the attributes, in a fixed order."""
        found = []
        for key, value in sorted(vars(self).items()):
            if isinstance(value, Model):
                found.append((key, value))
            elif isinstance(value, list) and value and all(isinstance(v, Model) for v in value):
                found += [(key, v) for v in value]
        return found

    def save(self, path: str, spark: SparkSession | None = None) -> None:
        spark = spark or SparkSession.getActiveSession()
        parts = self._parts()
        names = {key for key, _ in parts} | {"tables"}
        plain = {k: v for k, v in vars(self).items() if k not in names}
        doc = {"version": VERSION, "class": type(self).__name__, "state": write_value(plain),
               "tables": sorted(self.tables), "parts": [key for key, _ in parts],
               "lists": sorted({key for key, _ in parts if isinstance(getattr(self, key), list)})}
        line = json.dumps(doc, sort_keys=True)
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/state")
        for key, t in self.tables.items():
            t.write.mode("overwrite").parquet(f"{path}/table={key}")
        for i, (_, model) in enumerate(parts):
            model.save(f"{path}/part={i}", spark)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Model:
        model = load_model(spark, path)
        if not isinstance(model, cls):
            raise TypeError(f"{path} holds a {type(model).__name__}, not a {cls.__name__}")
        return model


def load_model(spark: SparkSession, path: str) -> Model:
    """The model saved at ``path``; a version or class unknown here is a ``ValueError``."""
    doc = json.loads(spark.read.text(f"{path}/state").first()["value"])
    if doc.get("version") != VERSION:
        raise ValueError(f"{path} has state version {doc.get('version')!r}; this library reads version {VERSION}")
    kind = model_class(doc["class"])
    model = kind.__new__(kind)
    vars(model).update(read_value(doc["state"]))
    model.tables = {key: spark.read.parquet(f"{path}/table={key}") for key in doc["tables"]}
    for key in doc["lists"]:
        setattr(model, key, [])
    for i, key in enumerate(doc["parts"]):
        part = load_model(spark, f"{path}/part={i}")
        if key in doc["lists"]:
            getattr(model, key).append(part)
        else:
            setattr(model, key, part)
    return model


class Estimator:
    def inputs(self) -> list[str] | None:
        """Columns that ``fit`` and ``transform`` read; ``None`` if not known (all of them)."""
        return None

    def writes(self) -> list[str] | None:
        """Columns that ``transform`` writes; ``None`` if not known."""
        return None

    def fit(self, df: DataFrame) -> Model:  # pragma: no cover - abstract
        raise NotImplementedError

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


class Stateless(Estimator, Model):
    """A transformer with nothing to fit."""

    def __init__(self):
        Model.__init__(self, {})

    def fit(self, df: DataFrame) -> Model:
        return self
