"""Config-driven feature pipelines.

``FeaturePipeline`` fits its stages in order on the progressively transformed
frame (each stateful stage = one aggregate job), and the fitted
``PipelineModel.transform`` is a lazy chain of projections (plus broadcast
vocabulary joins) that runs unchanged on a batch table or a stream.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.fixed import (CLEANER_EXTRA_COLUMNS, DEFAULT_FILL_VALUE, FN_BOOL, FN_HASH, FN_LABEL, FN_LOG, FN_MULTI,
                            FN_TIME)
from recspark.functions.registry import apply_ops
from recspark.operators import transformers as TR
from recspark.operators.base import Estimator, Model, Stateless
from recspark.session import ensure_checkpoint_dir


class PipelineModel(Model):
    def __init__(self, models: list[Model]):
        super().__init__({"stages": [type(m).__name__ for m in models]})
        self.models = models

    def transform(self, df: DataFrame) -> DataFrame:
        for m in self.models:
            df = m.transform(df)
        return df


class FeaturePipeline(Estimator):
    """Ordered stages; ``fit`` runs one aggregate job per stateful stage.

    ``store_input=True`` evaluates the input once: the columns that the
    statistics hang on are written as Parquet into the shared checkpoint folder,
    and every statistic reads its own columns from there.
    Meant for inputs that are joins or unions; over a plain scan the statistics
    read their columns from the source as cheaply.  A lost executor costs its
    running tasks only, since the copy lies outside the executors.
    """

    def __init__(self, stages: list[Estimator], store_input: bool = False):
        self.stages, self.store_input = stages, store_input

    def inputs(self):
        each = [st.inputs() for st in self.stages]
        return None if None in each else [c for cols in each for c in cols]

    def _stored(self, df: DataFrame, stages: list[Estimator]) -> DataFrame:
        """The columns of ``df`` that the statistics of ``stages`` hang on, written once and read back."""
        read: set[str] | None = set()
        for st in reversed(stages):
            out, own = st.writes(), st.inputs()
            if isinstance(st, Stateless) and out is not None and not read & set(out):
                continue  # no statistic reads what it writes
            if own is None:
                read = None
                break
            read |= set(own)
        part = df if read is None else df.select(*[c for c in df.columns if c in read])
        path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/recspark-fit-{uuid.uuid4().hex[:10]}"
        part.write.parquet(path)
        return df.sparkSession.read.schema(part.schema).parquet(path)

    def fit(self, df: DataFrame) -> PipelineModel:
        stateful = [i for i, st in enumerate(self.stages) if not isinstance(st, Stateless)]
        last = stateful[-1] + 1 if stateful else 0
        cur = self._stored(df, self.stages[:last]) if self.store_input and last else df
        models: list[Model] = []
        for st in self.stages[:last]:  # L4: every stage sees the output of the previous ones
            m = st.fit(cur)
            cur = m.transform(cur)
            models.append(m)
        return PipelineModel(models + list(self.stages[last:]))  # the rest has nothing to fit


class ColumnCleaner(Stateless):
    """Drop source columns that were not regenerated, plus helper columns."""

    def __init__(self, original: list[str], generated: list[str],
                 extra: tuple[str, ...] = CLEANER_EXTRA_COLUMNS, keep: list[str] | None = None):
        super().__init__()
        self.original, self.generated, self.extra = original, set(generated), extra
        self.keep = set(keep or [])

    def inputs(self):
        return []

    def transform(self, df):
        drop = [c for c in self.original if c not in self.generated and c not in self.keep] + list(self.extra)
        return df.drop(*[c for c in drop if c in df.columns])


class Select(Stateless):
    """Select / rename to a column list (``{old: new}`` entries rename)."""

    def __init__(self, cols: list):
        super().__init__()
        self.cols = cols

    def inputs(self):
        return [name for c in self.cols for name in (c if isinstance(c, dict) else [c])]

    def transform(self, df):
        out = []
        for c in self.cols:
            if isinstance(c, dict):
                (old, new), = c.items()
                out.append(F.col(old).alias(new))
            else:
                out.append(F.col(c))
        return df.select(*out)


# --------------------------------------------------------------------------- processor dialect

def pipeline_from_processor_spec(spec: dict, hash_method: str | None = None, clean: bool = True,
                                 store_input: bool = False) -> FeaturePipeline:
    """``fill -> time -> bool -> log -> label -> multi -> hash -> clean``.

    Every declared parameter is honoured (L2) and every transform writes its
    ``col_out`` (L3).  ``hash_method`` overrides the per-step method (the
    reference always used xxh32, L7).
    """
    na = spec.get("NA_Processing", {}) or {}
    fills = []
    if na.get("enabled", True):
        for f in na.get("features", []) or []:
            fills.append(TR.FillSpec(f["feature_name"], f.get("strategy"), f.get("fill_value")))
        listed = {f.col for f in fills}
        columns = (spec.get("dataset") or {}).get("column_names") or []
        # declared columns without an entry get the default of their type (L1)
        fills += [TR.FillSpec(c, None) for c in columns if c not in listed]
    default_fill = na.get("default_fill_value", DEFAULT_FILL_VALUE)
    time_specs, bools, logs, labels, label_out, multis, hashes = [], [], [], [], {}, [], []
    originals, generated = [], []
    for feat in spec.get("feature_processing", []) or []:
        for step in feat.get("feature_process", []) or []:
            fn, p = step.get("function_name"), step.get("function_parameters") or {}
            cin, cout = step["col_in"], step.get("col_out") or step["col_in"]
            originals.append(cin)
            generated.append(cout)
            if fn == FN_TIME:
                time_specs.append(TR.TimeSpec(cin, cout, p.get("unit", "ms"), p.get("feature", "hour"),
                                              p.get("format", "%Y%m%d")))
            elif fn == FN_BOOL:
                bools.append(cin)
            elif fn == FN_LOG:
                logs.append((cin, cout))
            elif fn == FN_LABEL:
                labels.append(cin)
                label_out[cin] = cout
            elif fn == FN_MULTI:
                multis.append(TR.MultiValueSpec(cin, cout, str(p.get("sep", ",")), int(p.get("max_len", 10)),
                                                int(p.get("vocabulary_size", 1_000_000)),
                                                p.get("padding_value", 0),
                                                p.get("ops", ["split", "hash", "pad"]),
                                                hash_method or p.get("hash_method", "xxh32")))
            elif fn == FN_HASH:
                hashes.append((cin, cout, int(p.get("vocabulary_size", 1_000_000)),
                               hash_method or p.get("hash_method", "xxh32")))
            else:
                raise ValueError(f"unknown function_name {fn!r}")
    stages: list[Estimator] = [TR.MissingValueFiller(fills, default_fill_value=default_fill),
                               TR.TimeFeatureExtractor(time_specs), TR.BooleanConverter(bools),
                               TR.LogTransformer(logs),
                               TR.CategoricalEncoder(labels, outputs=label_out, unseen="zero"),
                               TR.MultivaluedProcessor(multis)]
    by_method: dict[str, list] = {}
    for cin, cout, n, m in hashes:
        by_method.setdefault(m, []).append((cin, cout, n))
    stages += [TR.HashTransformer(v, method=m) for m, v in by_method.items()]
    if clean:
        stages.append(ColumnCleaner(originals, generated))
    return FeaturePipeline(stages, store_input)


# --------------------------------------------------------------------------- pipeline dialect

_DTYPES = {"int": T.LongType(), "float": T.DoubleType(), "str": T.StringType(), "string": T.StringType()}


class OpsPipeline(Stateless):
    """Per feature ``fillna`` then its ``ops`` chain -> ``col_out``; one projection."""

    def __init__(self, pipelines: list[dict], keep_inputs: bool = False):
        super().__init__()
        self.pipelines, self.keep_inputs = pipelines, keep_inputs

    def inputs(self):
        return [p["col_in"] for p in self.pipelines]

    def expr(self, p: dict, df: DataFrame):
        c = F.col(p["col_in"])
        if p.get("fillna") is not None:
            c = F.coalesce(c, F.lit(p["fillna"]).cast(df.schema[p["col_in"]].dataType))
        return apply_ops(c, p.get("ops", []) or [])

    def transform(self, df):
        ps = [p for p in self.pipelines if p["col_in"] in df.columns]
        cols = {p["col_out"]: self.expr(p, df) for p in ps}
        if self.keep_inputs:
            return df.withColumns(cols)
        return df.select(*[v.alias(k) for k, v in cols.items()])


# --------------------------------------------------------------------------- schema helpers

_INTS = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)


def feature_columns(df: DataFrame, id_cols=("user_id", "item_id"), label_cols=()) -> dict[str, list[str]]:
    """Sort columns into id / label / numeric / categorical / bin / multi-valued."""
    out = {"id": [], "label": [], "numeric": [], "categorical": [], "bin": [], "multi": []}
    for f in df.schema.fields:
        n, t = f.name, f.dataType
        if n in id_cols or n.endswith("_id"):
            out["id"].append(n)
        elif n in label_cols or n.startswith("is_"):
            out["label"].append(n)
        elif n.endswith("_bin"):
            out["bin"].append(n)
        elif isinstance(t, T.ArrayType):
            out["multi"].append(n)
        elif isinstance(t, T.StringType) or n.endswith("_encoded"):
            out["categorical"].append(n)
        elif isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType) + _INTS):
            out["numeric"].append(n)
    return out


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """64-bit numeric columns minus exclusions (32/8-bit codes are not selected)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.LongType, T.DoubleType)) and f.name not in set(exclude)]
