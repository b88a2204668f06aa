"""Datasets compiled from a spec (S9 with S1, S2, S3, S4).

``train_set``, ``val_set``, ``test_set`` and ``combo_set`` of a pipeline spec
(``combo_set`` may be a list) declare delimited or parquet files.
``compile_sets`` turns them into one lazy plan per read set:

1. every listed path of a set is read with an explicit schema;
2. a set with ``join_type`` is added to each set named in ``join_names``:
   ``merge`` joins on ``join_on`` (``how`` inner or left, other columns of
   equal name get ``_x`` / ``_y``), ``concat`` stacks by column name;
3. unless ``prune=False`` only the columns that pipelines, labels or joins
   name are kept, so they alone reach the scan.

Keys of a set: ``set_name``, ``file_type`` (csv or parquet), ``data_path`` (a
path or a list), ``sep``, ``header`` (a row number or null, 0 by default; any
row number skips the first line), ``names``, ``label_columns``, ``join_type``,
``join_on``, ``how``, ``join_names``; besides them ``types`` (column -> Spark
type; other columns of delimited files are strings, labels ints).
``chunksize`` is accepted and has no effect: partitions take its place.

Null keys match nothing.  An added set is taken as read, without what is
added to it itself, and sets are added in the order of the spec.  A missing
key, an unknown set name or a column that no file has is a ``ValueError``
that names the set.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.operators.joins import join_with_suffixes
from recspark.sources.io import concat_sets, read_parquet_set, read_set

ROLES = ("train_set", "val_set", "test_set", "combo_set")


@dataclass(frozen=True)
class SetSpec:
    role: str
    set_name: str
    data_path: tuple[str, ...]
    file_type: str = "csv"
    sep: str = ","
    header: bool = True
    names: tuple[str, ...] = ()
    label_columns: tuple[str, ...] = ()
    types: tuple[tuple[str, str], ...] = ()
    join_type: str | None = None
    join_on: tuple[str, ...] = ()
    how: str = "inner"
    join_names: tuple[str, ...] = ()


def _tuple(value) -> tuple:
    if value is None:
        return ()
    return (value,) if isinstance(value, str) else tuple(value)


def _parse(role: str, d: dict) -> SetSpec:
    name = d.get("set_name")
    if not name:
        raise ValueError(f"{role} has no set_name")
    paths = _tuple(d.get("data_path"))
    if not paths:
        raise ValueError(f"set {name!r} has no data_path")
    spec = SetSpec(role, name, paths, d.get("file_type") or "csv", d.get("sep") or ",", d.get("header", 0) is not None,
                   _tuple(d.get("names")), _tuple(d.get("label_columns")), tuple((d.get("types") or {}).items()),
                   d.get("join_type"), _tuple(d.get("join_on")), d.get("how") or d.get("join_how") or "inner",
                   _tuple(d.get("join_names") or d.get("join_set_names")))
    if spec.file_type not in ("csv", "parquet"):
        raise ValueError(f"set {name!r}: file_type {spec.file_type!r} is neither csv nor parquet")
    if spec.join_type not in (None, "merge", "concat"):
        raise ValueError(f"set {name!r}: join_type {spec.join_type!r} is neither merge nor concat")
    if spec.join_type == "merge" and not spec.join_on:
        raise ValueError(f"set {name!r}: merge needs join_on")
    if spec.how not in ("inner", "left"):
        raise ValueError(f"set {name!r}: how {spec.how!r} is neither inner nor left")
    if spec.join_type and not spec.join_names:
        raise ValueError(f"set {name!r}: {spec.join_type} needs join_names")
    return spec


def parse_sets(spec: dict) -> list[SetSpec]:
    """The declared sets in the order train, val, test, combo; names must be unique."""
    sets = []
    for role in ROLES:
        declared = spec.get(role) or []
        sets += [_parse(role, d) for d in (declared if isinstance(declared, list) else [declared])]
    names = [s.set_name for s in sets]
    for s in sets:
        if names.count(s.set_name) > 1:
            raise ValueError(f"two sets named {s.set_name!r}")
        for target in s.join_names:
            if target not in names:
                raise ValueError(f"set {s.set_name!r} joins unknown set {target!r}")
            if target == s.set_name:
                raise ValueError(f"set {target!r} joins itself")
    return sets


def named_columns(spec: dict, sets: list[SetSpec]) -> set[str]:
    """Columns that pipelines, labels and joins read, with the names that merge suffixes stand for."""
    cols = {p["col_in"] for p in spec.get("pipelines") or []}
    cols |= {c[:-2] for c in cols if c.endswith(("_x", "_y"))}
    for s in sets:
        cols |= set(s.label_columns) | set(s.join_on)
    return cols


def read_one(spark: SparkSession, s: SetSpec, root: str | None = None) -> DataFrame:
    """One set as read: all its paths (relative ones below ``root``), labels as ints."""
    paths = [p.replace("\\", "/") for p in s.data_path]
    paths = [p if root is None or p.startswith("/") or "://" in p else f"{root.rstrip('/')}/{p}" for p in paths]
    if s.file_type == "parquet":
        df = read_parquet_set(spark, paths)
        cast = {c: F.col(c).try_cast("int") for c in s.label_columns if c in df.columns}
        return df.withColumns(cast) if cast else df
    types = dict(s.types)
    schema = ", ".join(f"`{n}` {types.get(n, 'string')}" for n in s.names) or None
    df = read_set(spark, paths, sep=s.sep, header=s.header, schema=schema)
    cast = {c: F.col(c).try_cast(t) for c, t in types.items() if not s.names and c in df.columns}
    cast |= {c: F.col(c).try_cast("int") for c in s.label_columns if c in df.columns}
    return df.withColumns(cast) if cast else df


def compile_sets(spark: SparkSession, spec: dict, root: str | None = None, prune: bool = True) -> dict[str, DataFrame]:
    """``set_name`` -> its plan, for every set that is not only added to others."""
    sets = parse_sets(spec)
    wanted = named_columns(spec, sets)
    raw = {}
    for s in sets:
        df = read_one(spark, s, root)
        lost = [c for c in s.label_columns + (s.join_on if s.join_type == "merge" else ()) if c not in df.columns]
        if lost:
            raise ValueError(f"set {s.set_name!r} has no columns {lost}")
        raw[s.set_name] = df.select(*[c for c in df.columns if c in wanted]) if prune else df
    out = dict(raw)
    for s in sets:
        for target in s.join_names if s.join_type else ():
            if s.join_type == "concat":
                out[target] = concat_sets([out[target], raw[s.set_name]])
                continue
            lost = [c for c in s.join_on if c not in out[target].columns]
            if lost:
                raise ValueError(f"set {target!r} has no columns {lost} to merge {s.set_name!r} on")
            out[target] = join_with_suffixes(out[target], raw[s.set_name], list(s.join_on), s.how)
    return {s.set_name: out[s.set_name] for s in sets if s.role != "combo_set"}


def compile_features(spark: SparkSession, spec: dict, root: str | None = None, keep: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """``compile_sets`` followed by the spec's pipelines; every pipeline column must exist in every set."""
    from recspark.plans.pipeline import OpsPipeline

    kept = [{"col_in": c, "col_out": c} for c in keep]
    full = {**spec, "pipelines": list(spec.get("pipelines") or []) + kept}
    out = {}
    for name, df in compile_sets(spark, full, root).items():
        lost = sorted({p["col_in"] for p in full["pipelines"]} - set(df.columns))
        if lost:
            raise ValueError(f"set {name!r} has no columns {lost} that pipelines read")
        out[name] = OpsPipeline(full["pipelines"]).transform(df)
    return out
