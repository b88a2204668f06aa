"""Per-value op registry (X1) and op chains.

Config files name ops (``str_hash``, ``padding``, ...) with keyword
parameters.  Each name maps to a builder ``(Column, **params) -> Column``, so
an op chain folds into one column expression.  Users may register their own
builder - including one wrapping a ``pandas_udf``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from recspark.fixed import DEFAULT_HASH_SEED
from recspark.functions import scalars as S
from recspark.functions.hashing import list_hash, str_hash

OpBuilder = Callable[..., Column]
_OPS: dict[str, OpBuilder] = {}


def register_op(name: str, builder: OpBuilder | None = None):
    """Register ``builder`` under ``name`` (usable as a decorator)."""
    def deco(fn):
        _OPS[name] = fn
        return fn
    return deco(builder) if builder is not None else deco


def get_op(name: str) -> OpBuilder:
    if name not in _OPS:
        raise KeyError(f"unknown op {name!r}; known: {sorted(_OPS)}")
    return _OPS[name]


def list_ops() -> list[str]:
    return sorted(_OPS)


def apply_ops(col: Column | str, ops: list) -> Column:
    """apply ``[{name: params}, ...]`` (or plain names) in listed order."""
    c = F.col(col) if isinstance(col, str) else col
    texts = False  # a list of texts, fresh from a split: a number pads it as text
    for op in ops or []:
        if isinstance(op, str):
            name, params = op, {}
        else:
            (name, params), = op.items()
        if name == "padding" and texts:
            params = {**params, "of": "string"}
        texts = name in ("str_to_list", "list_str_split") or (name == "padding" and texts)
        c = get_op(name)(c, **(params or {}))
    return c


# Op names and parameter names follow the config format.
register_op("str_hash", lambda c, num_embeddings, seed=DEFAULT_HASH_SEED, method="xxh32": str_hash(c, num_embeddings, method, seed))
register_op("list_hash", lambda c, num_embeddings, seed=DEFAULT_HASH_SEED, method="xxh32": list_hash(c, num_embeddings, method, seed))
register_op("str_to_list", lambda c, sep: S.str_to_list(c, str(sep)))
register_op("list_str_split", lambda c, sep: S.list_str_split(c, str(sep)))
register_op("padding", lambda c, max_len, padding_value, of=None: S.padding(c, int(max_len), padding_value, of))
register_op("log1p", lambda c: S.log1p(c))
register_op("floor_divide", lambda c, divide: S.floor_divide(c, divide))
register_op("floor_divde", lambda c, divide: S.floor_divide(c, divide))  # spelling used by configs
register_op("clip", lambda c, min_value=None, max_value=None: S.clip(c, min_value, max_value))
register_op("int_to_date", lambda c, tz=None: S.int_to_date(c))
register_op("ms_to_date", lambda c: S.ms_to_timestamp(c))
register_op("str_to_date", lambda c, format="%Y%m%d": S.str_to_date(c, format))
register_op("get_day", lambda c: S.get_day(c))
register_op("get_hour", lambda c: S.get_hour(c))
register_op("get_minute", lambda c: S.get_minute(c))
register_op("get_month", lambda c: S.get_month(c))
register_op("isoweekday", lambda c: S.iso_weekday(c))
register_op("weekday0", lambda c: S.weekday0(c))
register_op("sentinel_to_null", lambda c, sentinel=-1: S.sentinel_to_null(c, sentinel))
register_op("fillna", lambda c, value: S.fill_value(c, value))
