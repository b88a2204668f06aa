"""Feature specs (S9) and their dimension summary.

Two config dialects are accepted and kept as plain dicts:

* **processor dialect** - ``dataset`` + ``feature_processing`` (entries with
  ``function_name`` / ``function_parameters``) + ``NA_Processing``; usually
  three YAML files in one folder, merged.
* **pipeline dialect** - ``train_set`` / ``val_set`` / ``test_set`` /
  ``combo_set`` + ``pipelines`` (per-feature ``fillna`` and ``ops``).

Both spellings of the merge keys are accepted (``how``/``join_how``,
``join_names``/``join_set_names``) and ``source`` defaults to ``context``.
"""

from __future__ import annotations

import glob
import os

from pyspark.sql import DataFrame, SparkSession

from recspark.fixed import FN_LOG

try:
    import yaml
except ImportError:  # pragma: no cover
    yaml = None


def _merge(a: dict, b: dict) -> dict:
    out = dict(a)
    for k, v in b.items():
        out[k] = _merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def load_spec(src) -> dict:
    """Load a spec from a dict, a YAML file, or a folder of YAML files (merged)."""
    if isinstance(src, dict):
        spec = dict(src)
    else:
        if yaml is None:
            raise ImportError("PyYAML is needed to read spec files")
        files = sorted(glob.glob(os.path.join(src, "*.yml")) + glob.glob(os.path.join(src, "*.yaml"))) \
            if os.path.isdir(src) else [src]
        spec = {}
        for f in files:
            with open(f) as fh:
                spec = _merge(spec, yaml.safe_load(fh) or {})
    for p in spec.get("pipelines", []) or []:
        p.setdefault("source", "context")
    for key in ("train_set", "val_set", "test_set", "combo_set"):
        s = spec.get(key)
        if isinstance(s, dict):
            if "join_how" in s and "how" not in s:
                s["how"] = s["join_how"]
            if "join_set_names" in s and "join_names" not in s:
                s["join_names"] = s["join_set_names"]
    return spec


def dialect(spec: dict) -> str:
    if "pipelines" in spec:
        return "pipeline"
    if "feature_processing" in spec:
        return "processor"
    raise ValueError("spec has neither 'pipelines' nor 'feature_processing'")


def spec_summary(spark: SparkSession, spec: dict, emb_dim: int = 8) -> DataFrame:
    """One row per model input with ``(feature, kind, side, vocab, dim)``.

    Sparse and variable-length features add ``emb_dim`` each, dense ones 1;
    labels add nothing.  Totals are a ``groupBy`` away.
    """
    rows = []
    if dialect(spec) == "pipeline":
        labels = set()
        for key in ("train_set",):
            labels |= set((spec.get(key) or {}).get("label_columns", []) or [])
        for p in spec["pipelines"]:
            kind = p.get("feature_type", "sparse")
            is_label = p.get("col_in") in labels or p.get("source") == "label"
            dim = 0 if is_label else (1 if kind == "dense" else int(p.get("emb_dim", emb_dim)))
            rows.append((p["col_out"], kind, "label" if is_label else p.get("source", "context"),
                         int(p.get("num_embeddings") or 0), dim))
    else:
        for f in spec["feature_processing"]:
            for step in f.get("feature_process", []) or []:
                kind = f.get("feature_type", "sparse")
                dense = step.get("function_name") == FN_LOG or kind == "dense"
                vocab = int((step.get("function_parameters") or {}).get("vocabulary_size") or 0)
                rows.append((step.get("col_out") or step.get("col_in"), "dense" if dense else "sparse",
                             f.get("feature_side", "context"), vocab, 1 if dense else emb_dim))
    return spark.createDataFrame(rows, "feature string, kind string, side string, vocab long, dim int")
