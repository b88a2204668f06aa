"""Versioned JSON form of fitted state.

Plain JSON values stand for themselves.  Everything else is an object
``{"as": <kind>, "of": <content>}``: tuples, sets, dicts (as pairs, so that
keys keep their type), non-finite floats, dates, times, decimals, bytes, and
the declared parameter classes (``state_type``).  A value of another type
cannot be saved and says so.

Class names are looked up in two registries, never imported from the text:
models enter theirs when their class is defined, parameter classes through
``state_type``.
"""

from __future__ import annotations

import base64
import dataclasses
import datetime as dt
import decimal
import importlib
import math

import numpy as np

VERSION = 1
# modules whose classes a stored state may name; others register when they are imported
MODULES = ("recspark.operators.transformers", "recspark.plans.pipeline")

_MODELS: dict[str, type] = {}
_TYPES: dict[str, type] = {}


def register_model(cls: type) -> None:
    known = _MODELS.get(cls.__name__)
    if known is not None and (known.__module__, known.__qualname__) != (cls.__module__, cls.__qualname__):
        raise ValueError(f"two models named {cls.__name__}: {known.__module__} and {cls.__module__}")
    _MODELS[cls.__name__] = cls


def state_type(cls: type) -> type:
    """Class decorator: a dataclass that may stand in a saved state."""
    if not dataclasses.is_dataclass(cls):
        raise TypeError(f"{cls.__name__} is no dataclass")
    _TYPES[cls.__name__] = cls
    return cls


def _find(registry: dict[str, type], name: str, what: str) -> type:
    if name not in registry:
        for module in MODULES:
            importlib.import_module(module)
    if name not in registry:
        raise ValueError(f"unknown {what} {name!r}; import the module that defines it first")
    return registry[name]


def model_class(name: str) -> type:
    return _find(_MODELS, name, "model")


def write_value(v):
    """``v`` as JSON content."""
    if isinstance(v, np.generic):
        v = v.item()
    if v is None or isinstance(v, (bool, int, str)):
        return v
    if isinstance(v, float):
        return v if math.isfinite(v) else {"as": "float", "of": repr(v)}
    if isinstance(v, np.ndarray):
        return {"as": "array", "of": [str(v.dtype), list(v.shape), [write_value(x) for x in v.ravel().tolist()]]}
    if isinstance(v, list):
        return [write_value(x) for x in v]
    if isinstance(v, tuple):
        return {"as": "tuple", "of": [write_value(x) for x in v]}
    if isinstance(v, (set, frozenset)):
        return {"as": type(v).__name__, "of": sorted((write_value(x) for x in v), key=repr)}
    if isinstance(v, dict):
        return {"as": "dict", "of": [[write_value(k), write_value(x)] for k, x in v.items()]}
    if isinstance(v, dt.datetime):  # before date: a datetime is a date
        return {"as": "datetime", "of": v.isoformat()}
    if isinstance(v, dt.date):
        return {"as": "date", "of": v.isoformat()}
    if isinstance(v, decimal.Decimal):
        return {"as": "decimal", "of": str(v)}
    if isinstance(v, (bytes, bytearray)):
        return {"as": "bytes", "of": base64.b64encode(bytes(v)).decode("ascii")}
    name = type(v).__name__
    if _TYPES.get(name) is type(v):
        return {"as": "type", "of": [name, {f.name: write_value(getattr(v, f.name)) for f in dataclasses.fields(v)}]}
    raise TypeError(f"a {type(v).__module__}.{name} cannot be saved; declare it with state_type")


def _make_type(content) -> object:
    name, values = content
    cls = _find(_TYPES, name, "parameter class")
    fields = {f.name for f in dataclasses.fields(cls)}
    if set(values) - fields:
        raise ValueError(f"{name} has no fields {sorted(set(values) - fields)}")
    return cls(**{k: read_value(x) for k, x in values.items()})


_READERS = {
    "float": float,
    "array": lambda c: np.array([read_value(x) for x in c[2]], dtype=c[0]).reshape(c[1]),
    "tuple": lambda c: tuple(read_value(x) for x in c),
    "set": lambda c: {read_value(x) for x in c},
    "frozenset": lambda c: frozenset(read_value(x) for x in c),
    "dict": lambda c: {read_value(k): read_value(x) for k, x in c},
    "datetime": dt.datetime.fromisoformat,
    "date": dt.date.fromisoformat,
    "decimal": decimal.Decimal,
    "bytes": base64.b64decode,
    "type": _make_type,
}


def read_value(v):
    """The value that ``write_value`` wrote."""
    if isinstance(v, list):
        return [read_value(x) for x in v]
    if not isinstance(v, dict):
        return v
    if v.get("as") not in _READERS:
        raise ValueError(f"unknown kind of value {v.get('as')!r}")
    return _READERS[v["as"]](v["of"])
