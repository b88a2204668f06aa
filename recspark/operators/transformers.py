"""Fitted feature transformers.

Each estimator handles many columns at once: ``fit`` runs **one** aggregate
over all of its columns (one Spark job per stage, statistics come back as a
single row), ``transform`` adds all outputs with one ``withColumns`` (never a
per-column loop of projections).  Vocabularies stay DataFrames and are joined
back; they are broadcast only behind a bounded row count.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.fixed import DEFAULT_FILL_VALUE, DEFAULT_HASH_SEED, SUFFIX_BIN, SUFFIX_CROSS, SUFFIX_ENCODED
from recspark.functions import scalars as S
from recspark.functions.hashing import list_hash, str_hash
from recspark.operators.base import Estimator, Model, Stateless
from recspark.operators.quantiles import exact_modes, exact_quantiles
from recspark.operators.ranking import dense_codes
from recspark.operators.state import state_type
from recspark.session import cut_lineage

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, NUMERIC)


def _present(df: DataFrame, cols, strict: bool) -> list[str]:
    """Missing columns are skipped (or raise with ``strict``)."""
    missing = [c for c in cols if c not in df.columns]
    if missing and strict:
        raise KeyError(f"columns not found: {missing}")
    return [c for c in cols if c in df.columns]


# --------------------------------------------------------------------------- E1

@state_type
@dataclass
class FillSpec:
    col: str
    strategy: str | None = None      # mean | median | mode | zero | none
    fill_value: object = None         # literal (L1)


class MissingValueFiller(Estimator):
    """E1 (+A5): per-column fill by statistic or literal.

    Means come from one aggregate; exact medians and modes from the
    distributed counting in ``quantiles`` (``approx_median`` switches the
    medians to ``percentile_approx``).
    """

    def __init__(self, specs: list[FillSpec], default_fill_value: str = DEFAULT_FILL_VALUE,
                 approx_median: bool = False, strict: bool = False):
        self.specs, self.default = specs, default_fill_value
        self.approx, self.strict = approx_median, strict

    def inputs(self):
        return [s.col for s in self.specs]

    def fit(self, df: DataFrame) -> "FillModel":
        aggs, values, medians, modes = [], {}, [], []
        for s in self.specs:
            if s.col not in df.columns:
                _present(df, [s.col], self.strict)
                continue
            c = F.col(s.col)
            if s.fill_value is not None:
                values[s.col] = s.fill_value
            elif s.strategy == "mean":
                aggs.append(F.avg(c).alias(s.col))
            elif s.strategy == "median":
                if self.approx:
                    aggs.append(F.percentile_approx(c, 0.5, 10000).alias(s.col))
                else:
                    medians.append(s.col)
            elif s.strategy == "mode":
                modes.append(s.col)
            elif s.strategy == "zero":
                values[s.col] = 0
            elif s.strategy in ("none", "skip"):
                continue
            elif s.strategy is None:
                values[s.col] = 0 if is_numeric(df, s.col) else self.default
            else:
                # L1: an unknown strategy word is taken as the literal to fill with
                values[s.col] = s.strategy
        if aggs:
            row = df.agg(*aggs).first().asDict()
            values.update({k: v for k, v in row.items() if v is not None})
        # exact median / mode by distributed counting (no single-task value map)
        for c, q in exact_quantiles(df, medians, [0.5]).items():
            if q is not None:
                values[c] = q[0]
        values.update({c: v for c, v in exact_modes(df, modes).items() if v is not None})
        return FillModel({"values": values})


class FillModel(Model):
    """A fractional statistic of a whole-number column widens the column to double."""

    def transform(self, df: DataFrame) -> DataFrame:
        vals = {c: v for c, v in self.state["values"].items() if c in df.columns}

        def filled(c, v):
            kind = df.schema[c].dataType
            if isinstance(kind, T.IntegralType) and isinstance(v, float) and v != int(v):
                return F.coalesce(F.col(c).cast("double"), F.lit(v))
            return F.coalesce(F.col(c), F.lit(v).cast(kind))
        return df.withColumns({c: filled(c, v) for c, v in vals.items()}) if vals else df


# --------------------------------------------------------------------------- E2

@state_type
@dataclass
class TimeSpec:
    col_in: str
    col_out: str
    unit: str          # ms | s | str | int_to_hour | int_to_minute | timestamp
    feature: str       # dayofweek | weekday0 | hour | minute | month | day
    format: str = "%Y%m%d"


class TimeFeatureExtractor(Stateless):
    """Time parts from ms/s epochs, formatted strings or HHMM ints; null -> -1."""

    def __init__(self, specs: list[TimeSpec]):
        super().__init__()
        self.specs = specs

    def inputs(self):
        return [s.col_in for s in self.specs]

    def writes(self):
        return [s.col_out for s in self.specs]

    @staticmethod
    def expr(s: TimeSpec) -> Column:
        c = F.col(s.col_in)
        if s.unit in ("int_to_hour", "int_to_minute"):
            if s.feature == "hour":
                v = S.hhmm_hour(c)
            elif s.feature == "minute":
                v = S.hhmm_minute(c)
            else:  # the date part of an HHMM value is 1970-01-01
                ts = F.when(S.hhmm_hour(c).isNotNull(), F.lit("1970-01-01").cast("timestamp"))
                v = _part(ts, s.feature)
        else:
            if s.unit == "ms":
                ts = S.ms_to_timestamp(c)
            elif s.unit == "s":
                ts = S.int_to_date(c)
            elif s.unit == "str":
                ts = S.str_to_date(c, s.format)
            elif s.unit == "timestamp":
                ts = c.cast("timestamp")
            else:
                raise ValueError(f"unsupported time unit {s.unit!r}")
            v = _part(ts, s.feature)
        return F.coalesce(v.cast("long"), F.lit(-1).cast("long"))

    def transform(self, df: DataFrame) -> DataFrame:
        specs = [s for s in self.specs if s.col_in in df.columns]
        return df.withColumns({s.col_out: self.expr(s) for s in specs}) if specs else df


def _part(ts: Column, feature: str) -> Column:
    fns = {"dayofweek": S.iso_weekday, "isoweekday": S.iso_weekday, "weekday0": S.weekday0,
           "hour": S.get_hour, "minute": S.get_minute, "month": S.get_month, "day": S.get_day}
    if feature not in fns:
        raise ValueError(f"unsupported time feature {feature!r}")
    return fns[feature](ts)


# --------------------------------------------------------------------------- E3, E12, E13

class BooleanConverter(Stateless):
    """Boolean / flag columns -> int 0/1 (null stays null)."""

    def __init__(self, cols: list[str]):
        super().__init__()
        self.cols = cols

    def inputs(self):
        return list(self.cols)

    def writes(self):
        return list(self.cols)

    def transform(self, df):
        cols = [c for c in self.cols if c in df.columns]
        return df.withColumns({c: S.bool_to_int(c) for c in cols}) if cols else df


class LogTransformer(Stateless):
    """``col_out = log1p(col_in)`` for ``x >= 0``, else 0 (writes ``col_out``, L3)."""

    def __init__(self, pairs: list[tuple[str, str]]):
        super().__init__()
        self.pairs = pairs

    def inputs(self):
        return [c for c, _ in self.pairs]

    def writes(self):
        return [c for _, c in self.pairs]

    def transform(self, df):
        pairs = [(i, o) for i, o in self.pairs if i in df.columns]
        return df.withColumns({o: S.safe_log_feature(i) for i, o in pairs}) if pairs else df


class HashTransformer(Stateless):
    """``col_out = bucket(text(col_in))`` in ``[0, n)``."""

    def __init__(self, specs: list[tuple[str, str, int]], method: str = "xxh32", seed: int = DEFAULT_HASH_SEED):
        super().__init__()
        self.specs, self.method, self.seed = specs, method, seed

    def inputs(self):
        return [s[0] for s in self.specs]

    def transform(self, df):
        specs = [s for s in self.specs if s[0] in df.columns]
        return df.withColumns({o: str_hash(i, n, self.method, self.seed) for i, o, n in specs}) if specs else df


# --------------------------------------------------------------------------- E4, E5, E11

def _stack_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """Unpivot ``cols`` into ``(feature, value string)``, dropping nulls."""
    parts = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
                                for c in cols]))
    return df.select(parts.alias("_kv")).select("_kv.feature", "_kv.value").where(F.col("value").isNotNull())


class CategoricalEncoder(Estimator):
    """Label codes = rank of the value in the sorted distinct non-null values
    (U4 ``distinct`` then A10 dense codes).

    ``unseen='zero'`` codes null/unseen as 0 (reference behaviour, collides
    with the first class); ``'oov'`` codes them as ``n`` (own code).
    ``numeric='pass'`` leaves numeric columns untouched (L6), ``'cast'``
    encodes their text.  Output column: ``col + suffix``.
    """

    def __init__(self, cols: list[str], suffix: str = SUFFIX_ENCODED, unseen: str = "zero",
                 numeric: str = "pass", outputs: dict[str, str] | None = None, strict: bool = False):
        self.cols, self.suffix, self.unseen, self.numeric = cols, suffix, unseen, numeric
        self.outputs, self.strict = outputs or {}, strict

    def inputs(self):
        return list(self.cols)

    def fit(self, df: DataFrame) -> "VocabModel":
        cols = _present(df, self.cols, self.strict)
        if self.numeric == "pass":
            cols = [c for c in cols if not is_numeric(df, c)]
        outs = {c: self.outputs.get(c, c + self.suffix) for c in cols}
        if not cols:
            return VocabModel({"outputs": {}, "unseen": self.unseen, "sizes": {}}, {})
        # distinct values are read twice (size check, numbering): materialise them once
        vals = cut_lineage(_stack_values(df, cols).distinct())
        # the vocabulary is fitted state: materialise it too (reliable checkpoint)
        vocab = cut_lineage(dense_codes(vals, ["feature"], [F.col("value").asc()]))
        sizes = {r["feature"]: r["n"] for r in vocab.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
        return VocabModel({"outputs": outs, "unseen": self.unseen, "sizes": sizes}, {"vocab": vocab})


class VocabModel(Model):
    def transform(self, df: DataFrame) -> DataFrame:
        outs = {c: o for c, o in self.state["outputs"].items() if c in df.columns}
        if not outs:
            return df
        vocab = self.tables["vocab"]
        out = df
        for c, o in outs.items():
            default = 0 if self.state["unseen"] == "zero" else int(self.state["sizes"].get(c, 0))
            v = vocab.where(F.col("feature") == c).select(F.col("value").alias("_v"), F.col("code").alias("_code"))
            out = (out.join(v, F.col(c).cast("string") == F.col("_v"), "left")
                   .withColumn(o, F.coalesce(F.col("_code"), F.lit(default)).cast("long"))
                   .drop("_v", "_code"))
        return out


class FrequencyLookup(Estimator):
    """E5: code 0 = out of vocabulary; known values 1..n by descending count,
    ties by value ascending.  ``min_count`` / ``max_tokens`` shrink the
    vocabulary (dropped values fall to 0)."""

    def __init__(self, cols: list[str], suffix: str = "_freq", min_count: int = 1,
                 max_tokens: int | None = None):
        self.cols, self.suffix, self.min_count, self.max_tokens = cols, suffix, min_count, max_tokens

    def inputs(self):
        return list(self.cols)

    def fit(self, df: DataFrame) -> VocabModel:
        cols = [c for c in self.cols if c in df.columns]
        counts = (_stack_values(df, cols).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cnt"))
                  .where(F.col("cnt") >= self.min_count))
        vocab = dense_codes(counts, ["feature"], [F.col("cnt").desc(), F.col("value").asc()])
        vocab = vocab.withColumn("code", F.col("code") + 1)
        if self.max_tokens is not None:
            vocab = vocab.where(F.col("code") <= self.max_tokens)
        vocab = cut_lineage(vocab)
        return VocabModel({"outputs": {c: c + self.suffix for c in cols}, "unseen": "zero", "sizes": {}},
                          {"vocab": vocab.select("feature", "value", "code")})


class CrossFeatureCreator(Estimator):
    """``a_b_cross`` = text ``"a_b"`` (null -> ``nan``) label-encoded."""

    def __init__(self, crosses: list[list[str]], unseen: str = "zero", keep_string: bool = False):
        self.crosses, self.unseen, self.keep_string = crosses, unseen, keep_string

    def inputs(self):
        return [c for cross in self.crosses for c in cross]

    def _with_strings(self, df):
        return df.withColumns({"_".join(c) + SUFFIX_CROSS + "_str": S.cross_string(c) for c in self.crosses})

    def fit(self, df):
        names = ["_".join(c) + SUFFIX_CROSS + "_str" for c in self.crosses]
        enc = CategoricalEncoder(names, numeric="cast", unseen=self.unseen,
                                 outputs={n: n[:-4] for n in names}).fit(self._with_strings(df))
        return _CrossModel({"crosses": self.crosses, "keep": self.keep_string}, enc)


class _CrossModel(Model):
    def __init__(self, state, enc: VocabModel):
        super().__init__(state, enc.tables)
        self.enc = enc

    def transform(self, df):
        names = ["_".join(c) + SUFFIX_CROSS + "_str" for c in self.state["crosses"]]
        out = self.enc.transform(df.withColumns({n: S.cross_string(c)
                                                 for n, c in zip(names, self.state["crosses"])}))
        return out if self.state["keep"] else out.drop(*names)


# --------------------------------------------------------------------------- E6

@state_type
@dataclass
class MultiValueSpec:
    col_in: str
    col_out: str
    sep: str = ","
    max_len: int = 10
    vocabulary_size: int = 1_000_000
    padding_value: object = 0
    ops: list[str] = field(default_factory=lambda: ["split", "hash", "pad"])
    hash_method: str = "xxh32"


class MultivaluedProcessor(Stateless):
    """Split -> hash -> pad (reference order) or split -> pad -> hash."""

    def __init__(self, specs: list[MultiValueSpec]):
        super().__init__()
        self.specs = specs

    def inputs(self):
        return [s.col_in for s in self.specs]

    @staticmethod
    def expr(s: MultiValueSpec) -> Column:
        v: Column = F.col(s.col_in)
        hashed = False
        for op in s.ops:
            if op == "split":
                v = S.str_to_list(v, s.sep)
            elif op == "hash":
                v, hashed = list_hash(v, s.vocabulary_size, s.hash_method), True
            elif op == "pad":
                v = S.padding(v, s.max_len, s.padding_value, None if hashed else "string")
            else:
                raise ValueError(f"unknown multi-value op {op!r}")
        return v

    def transform(self, df):
        specs = [s for s in self.specs if s.col_in in df.columns]
        return df.withColumns({s.col_out: self.expr(s) for s in specs}) if specs else df


# --------------------------------------------------------------------------- E7, E8

def quantile_edges(qs: list[float]) -> list[float]:
    """Distinct edges in order (pandas ``duplicates='drop'``)."""
    out: list[float] = []
    for q in qs:
        if not out or q != out[-1]:
            out.append(float(q))
    return out


def width_edges(mn: float, mx: float, n: int) -> list[float]:
    """Equal-width edges as pandas ``cut``: a constant range is widened by 0.1 %."""
    if mn == mx:
        mn = mn - 0.001 * abs(mn) if mn != 0 else -0.001
        mx = mx + 0.001 * abs(mx) if mx != 0 else 0.001
    return [float(x) for x in np.linspace(mn, mx, n + 1)]


def bin_expr(x: Column, edges: list[float]) -> Column:
    """Right-closed bin index, lowest edge included, values outside clamp to the
    first / last bin; fewer than two edges -> -1."""
    if len(edges) < 2:
        return F.lit(-1).cast("int")
    inner = edges[1:-1]
    if not inner:
        return F.lit(0).cast("int")
    arr = F.array(*[F.lit(e) for e in inner])
    return F.size(F.filter(arr, lambda e: e < x.cast("double"))).cast("int")


class NumericalBinner(Estimator):
    """Quantile (A8 edges: exact ``percentile`` or ``approx``) or equal-width bins.

    Nulls are filled with the fit median; an all-null column is skipped.
    Output ``col + '_bin'``.
    """

    def __init__(self, cols: list[str], num_bins: int = 10, strategy: str = "quantile",
                 approx: bool = False, suffix: str = SUFFIX_BIN, strict: bool = False):
        if strategy not in ("quantile", "width"):
            raise ValueError("strategy must be 'quantile' or 'width'")
        self.cols, self.n, self.strategy, self.approx, self.suffix = cols, num_bins, strategy, approx, suffix
        self.strict = strict

    def inputs(self):
        return list(self.cols)

    def fit(self, df):
        cols = _present(df, self.cols, self.strict)
        probs = [i / self.n for i in range(self.n + 1)]
        pct = (lambda x: F.percentile_approx(x, probs, 10000)) if self.approx else \
            (lambda x: F.percentile(x, F.lit(probs)))
        aggs = [F.count(F.lit(1)).alias("rows")]
        for i, c in enumerate(cols):
            x = F.col(c).cast("double")
            aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}")]
            if self.approx:
                aggs.append(F.percentile_approx(x, 0.5, 10000).alias(f"med{i}"))
                if self.strategy == "quantile":
                    aggs.append(pct(x).alias(f"q{i}"))
        row = df.agg(*aggs).first().asDict() if cols else {}
        if not self.approx:  # exact, by distributed counting
            wanted = [0.5] + (probs if self.strategy == "quantile" else [])
            qs = exact_quantiles(df, cols, wanted)
            for i, c in enumerate(cols):
                if qs.get(c) is not None:
                    row[f"med{i}"] = qs[c][0]
                    row[f"q{i}"] = qs[c][1:]
        state, with_nulls = {}, []
        for i, c in enumerate(cols):
            if row[f"n{i}"] == 0:
                continue  # A9: all-null column, skipped as in the reference
            if self.strategy == "quantile":
                edges = quantile_edges(row[f"q{i}"])
                if row[f"n{i}"] < row["rows"]:
                    with_nulls.append(c)
            else:  # filling with the median never moves min / max
                edges = width_edges(row[f"mn{i}"], row[f"mx{i}"], self.n)
            state[c] = {"median": row[f"med{i}"], "edges": edges}
        if with_nulls:
            # quantiles are taken over the median-filled column, as the reference does
            filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(state[c]["median"])).alias(c)
                                 for c in with_nulls])
            if self.approx:
                r2 = filled.agg(*[pct(F.col(c)).alias(c) for c in with_nulls]).first().asDict()
            else:
                r2 = exact_quantiles(filled, with_nulls, probs)
            for c in with_nulls:
                state[c]["edges"] = quantile_edges(r2[c])
        return BinModel({"bins": state, "suffix": self.suffix})


class BinModel(Model):
    def transform(self, df):
        bins = {c: b for c, b in self.state["bins"].items() if c in df.columns}
        return df.withColumns({
            c + self.state["suffix"]: bin_expr(F.coalesce(F.col(c).cast("double"), F.lit(b["median"])), b["edges"])
            for c, b in bins.items()}) if bins else df


# --------------------------------------------------------------------------- E9, E10

class MinMaxNormalizer(Estimator):
    """``(x - min) / (max - min)`` with nulls filled by the fit median; zero range -> 0."""

    def __init__(self, cols: list[str], suffix: str = "", approx: bool = False):
        self.cols, self.suffix, self.approx = cols, suffix, approx

    def inputs(self):
        return list(self.cols)

    def fit(self, df):
        cols = [c for c in self.cols if c in df.columns]
        aggs = []
        for i, c in enumerate(cols):
            x = F.col(c).cast("double")
            aggs += [F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}")]
            if self.approx:
                aggs.append(F.percentile_approx(x, 0.5, 10000).alias(f"md{i}"))
        row = df.agg(*aggs).first().asDict() if aggs else {}
        if not self.approx:
            med = exact_quantiles(df, cols, [0.5])
            row.update({f"md{i}": (med[c][0] if med.get(c) else None) for i, c in enumerate(cols)})
        return _MinMaxModel({"stats": {c: [row[f"mn{i}"], row[f"mx{i}"], row[f"md{i}"]]
                                       for i, c in enumerate(cols)}, "suffix": self.suffix})


class _MinMaxModel(Model):
    def transform(self, df):
        out = {}
        for c, (mn, mx, md) in self.state["stats"].items():
            if c not in df.columns or mn is None:
                continue
            x = F.coalesce(F.col(c).cast("double"), F.lit(md))
            out[c + self.state["suffix"]] = ((x - F.lit(mn)) / F.lit(mx - mn)) if mx != mn else F.lit(0.0)
        return df.withColumns(out) if out else df


class ZScoreNormalizer(Estimator):
    """``(x - mean) / stddev_pop``; zero deviation -> 0; nulls -> mean (0 after scaling)."""

    def __init__(self, cols: list[str], suffix: str = ""):
        self.cols, self.suffix = cols, suffix

    def inputs(self):
        return list(self.cols)

    def fit(self, df):
        cols = [c for c in self.cols if c in df.columns]
        aggs = []
        for i, c in enumerate(cols):
            x = F.col(c).cast("double")
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
        row = df.agg(*aggs).first().asDict() if aggs else {}
        return _ZModel({"stats": {c: [row[f"m{i}"], row[f"s{i}"]] for i, c in enumerate(cols)},
                        "suffix": self.suffix})


class _ZModel(Model):
    def transform(self, df):
        out = {}
        for c, (m, s) in self.state["stats"].items():
            if c not in df.columns or m is None:
                continue
            x = F.coalesce(F.col(c).cast("double"), F.lit(m))
            out[c + self.state["suffix"]] = (x - F.lit(m)) / F.lit(s) if s and not math.isnan(s) else F.lit(0.0)
        return df.withColumns(out) if out else df
