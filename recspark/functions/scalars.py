"""Column -> Column helpers (F2-F31).  All native Spark expressions.

Every helper accepts a column name or a ``Column`` and returns a ``Column``;
none of them evaluates anything.  Nulls and bad input give ``null`` (ANSI
mode is on, so every parse goes through ``try_*``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from recspark.fixed import NULL_TOKEN
from recspark.functions.hashing import list_hash, str_hash  # noqa: F401  (re-export F1, F4)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _split_pattern(sep: str) -> str:
    return "\\Q" + sep + "\\E"


# --- lists -----------------------------------------------------------------

def str_to_list(c, sep: str) -> Column:
    """split on a literal separator; ``""`` -> ``[""]``; null -> ``[]``."""
    return F.coalesce(F.split(_c(c).cast("string"), _split_pattern(sep), -1), F.array().cast("array<string>"))


def list_str_split(c, sep: str) -> Column:
    """split every element of a string list."""
    return F.transform(_c(c), lambda x: F.split(x, _split_pattern(sep), -1))


def padding(c, max_len: int, value, of: str | None = None) -> Column:
    """truncate to ``max_len`` then right-pad with ``value``; null -> all padding.

    ``of``: the element type, when it is not the value's (text lists padded
    with a number).
    """
    pad = F.array_repeat(F.lit(value).cast(of) if of else F.lit(value), max_len)
    base = F.coalesce(_c(c), F.array().cast(f"array<{of or _lit_type(value)}>"))
    return F.slice(F.concat(base, pad), 1, max_len)


def _lit_type(value) -> str:
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int):
        return "int" if -2**31 <= value < 2**31 else "bigint"
    if isinstance(value, float):
        return "double"
    return "string"


def csv_to_long_list(c, sep: str = ",") -> Column:
    """``"1,2,3"`` -> ``[1,2,3]`` (bad tokens dropped); null -> ``[]``."""
    parts = F.split(_c(c).cast("string"), _split_pattern(sep), -1)
    longs = F.filter(F.transform(parts, lambda x: F.trim(x).try_cast("long")), lambda x: x.isNotNull())
    return F.coalesce(longs, F.array().cast("array<bigint>"))


def property_map(c, entry_sep: str = ";", kv_sep: str = ":", value_sep: str = ",") -> Column:
    """``"catA:p1,p2;catB:-1"`` -> ``map<string, array<string>>``.

    Keys without a ``kv_sep`` map to an empty list; a repeated key keeps the
    last entry.
    """
    entries = F.filter(F.split(_c(c).cast("string"), _split_pattern(entry_sep), -1), lambda e: e != "")
    structs = F.transform(entries, lambda e: F.struct(
        F.split_part(e, F.lit(kv_sep), F.lit(1)).alias("key"),
        F.when(F.instr(e, kv_sep) > 0,
               F.split(F.substr(e, F.instr(e, kv_sep) + 1), _split_pattern(value_sep), -1))
        .otherwise(F.array().cast("array<string>")).alias("value")))
    # keep the last occurrence of a key: reverse, drop later duplicates, reverse back
    keys = F.transform(structs, lambda s: s["key"])
    last = F.filter(structs, lambda s, i: F.array_position(F.reverse(keys), s["key"]) == F.size(keys) - i)
    return F.map_from_entries(last)


# --- numbers ---------------------------------------------------------------

def log1p(c) -> Column:
    """``ln(1 + x)``; null for ``x <= -1``."""
    x = _c(c).cast("double")
    return F.when(x > -1, F.log1p(x))


def floor_divide(c, d: int) -> Column:
    """Python-style floor division (rounds toward minus infinity); null for ``d = 0``.

    Whole numbers stay exact up to the ends of ``long``; fractional input is
    floored before and after, which gives the same quotient.
    """
    if int(d) != d:
        return F.floor(_c(c).cast("double") / F.lit(float(d))).cast("long")
    if d == 0:
        return F.lit(None).cast("long")
    x = F.floor(_c(c)).cast("long") if d > 0 else F.ceil(_c(c)).cast("long")
    by = F.lit(int(d)).cast("long")
    uneven = (x % by != 0) & ((x < 0) != F.lit(d < 0))  # ``div`` cuts towards zero
    return F.call_function("div", x, by) - uneven.cast("long")


def clip(c, lo=None, hi=None) -> Column:
    """F8: null-preserving clip (``greatest``/``least`` alone would skip nulls)."""
    x = _c(c)
    y = x
    if lo is not None:
        y = F.greatest(y, F.lit(lo))
    if hi is not None:
        y = F.least(y, F.lit(hi))
    return F.when(x.isNotNull(), y)


def safe_log_feature(c) -> Column:
    """``log1p(x)`` for ``x >= 0``, else 0 (nulls too)."""
    x = _c(c).cast("double")
    return F.coalesce(F.when(x >= 0, F.log1p(x)), F.lit(0.0))


def bool_to_int(c) -> Column:
    """F19."""
    return _c(c).cast("boolean").cast("int")


def fill_value(c, v) -> Column:
    """F22."""
    return F.coalesce(_c(c), F.lit(v))


def sentinel_to_null(c, sentinel=-1) -> Column:
    """``-1`` (or another sentinel) -> null."""
    return F.nullif(_c(c), F.lit(sentinel))


def cross_string(cols: Sequence, null_token: str = NULL_TOKEN, sep: str = "_") -> Column:
    """``a_b_c`` of the columns' texts, null -> ``null_token``."""
    return F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit(null_token)) for c in cols])


# --- time ------------------------------------------------------------------

def int_to_date(c) -> Column:
    """epoch seconds -> timestamp (UTC session)."""
    return F.timestamp_seconds(_c(c))


def ms_to_timestamp(c) -> Column:
    """epoch milliseconds -> timestamp truncated to the second (floor)."""
    return F.timestamp_seconds(F.floor(_c(c) / F.lit(1000)))


_STRPTIME = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%y": "yy",
             "%b": "MMM", "%f": "SSSSSS"}


def strptime_to_spark(fmt: str) -> str:
    """Map a ``strptime`` pattern to a Spark datetime pattern."""
    out, i = [], 0
    while i < len(fmt):
        tok = fmt[i:i + 2]
        if tok in _STRPTIME:
            out.append(_STRPTIME[tok])
            i += 2
        else:
            ch = fmt[i]
            out.append(f"'{ch}'" if ch.isalpha() else ch)
            i += 1
    return "".join(out)


def str_to_date(c, fmt: str = "%Y%m%d") -> Column:
    """parse with ``fmt``; ``%Y%m%d`` and ``%Y-%m-%d`` fall back to each other."""
    s = _c(c).cast("string")
    fmts = [fmt]
    alt = {"%Y%m%d": "%Y-%m-%d", "%Y-%m-%d": "%Y%m%d"}.get(fmt)
    if alt:
        fmts.append(alt)
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(strptime_to_spark(f))) for f in fmts])


def get_day(ts) -> Column:
    """F12."""
    return F.dayofmonth(_c(ts))


def get_hour(ts) -> Column:
    """F13."""
    return F.hour(_c(ts))


def get_minute(ts) -> Column:
    """F14."""
    return F.minute(_c(ts))


def get_month(ts) -> Column:
    """F15."""
    return F.month(_c(ts))


def iso_weekday(ts) -> Column:
    """F16: Monday = 1 .. Sunday = 7 (never Spark's ``dayofweek``, Sunday = 1)."""
    return F.weekday(_c(ts)) + 1


def weekday0(ts) -> Column:
    """Monday = 0 .. Sunday = 6."""
    return F.weekday(_c(ts))


def _hhmm_valid(x: Column) -> Column:
    return (x >= 0) & (F.floor(x / 100) < 24) & (F.pmod(x, F.lit(100)) < 60)


def hhmm_hour(c) -> Column:
    """``1030`` -> 10; out-of-range -> null."""
    x = _c(c).cast("long")
    return F.when(_hhmm_valid(x), F.floor(x / 100).cast("int"))


def hhmm_minute(c) -> Column:
    """``1030`` -> 30; out-of-range -> null."""
    x = _c(c).cast("long")
    return F.when(_hhmm_valid(x), F.pmod(x, F.lit(100)).cast("int"))


# --- vectors ---------------------------------------------------------------

def dot(a, b) -> Column:
    """dot product in double."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(a) -> Column:
    """F24."""
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(a) -> Column:
    """``v / ||v||``; a zero vector stays zero."""
    norm = F.array(l2_norm(a))  # a list of one, so that it is worked out once a vector and not once an element
    return F.transform(norm, lambda n: F.transform(_c(a), lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0))))[0]


def sq_l2_distance(a, b) -> Column:
    """F25."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y.cast("double")) *
                                  (x.cast("double") - y.cast("double"))),
                       F.lit(0.0), lambda acc, x: acc + x)


def vec_add(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") + y.cast("double"))


def vec_sub(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") - y.cast("double"))


def sigmoid(c) -> Column:
    """F26."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(c).cast("double")))


def softmax(a) -> Column:
    """softmax of an array, max-shifted for stability."""
    col = _c(a)
    m = F.array_max(col)
    ex = F.transform(col, lambda x: F.exp(x.cast("double") - m))
    s = F.aggregate(ex, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(ex, lambda x: x / s)


def ctcvr(ctr_logit, cvr_logit) -> Column:
    """``sigmoid(ctr) * sigmoid(cvr)``."""
    return sigmoid(ctr_logit) * sigmoid(cvr_logit)


def vector_prefix(a, d: int) -> Column:
    """first ``d`` dimensions (Matryoshka prefix)."""
    return F.slice(_c(a), 1, d)


def prefix_ngrams(codes, k: int, hash_size: int | None = None) -> Column:
    """``[sum_{i<l} c_i * k^(l-1-i) for l = 1..L]`` (optionally ``% hash_size``).

    Horner form, exact in bigint; the caller must keep ``k^L < 2^63``.
    """
    col = _c(codes)
    grams = F.transform(col, lambda _, i: F.aggregate(F.slice(col, 1, i + 1), F.lit(0).cast("long"),
                                                      lambda acc, x: acc * F.lit(k) + x.cast("long")))
    if hash_size is not None:
        grams = F.transform(grams, lambda g: F.pmod(g, F.lit(hash_size)))
    return grams


def pairwise_products(fields) -> Column:
    """element-wise products of field vectors for every pair ``i < j``, in
    ``(0,1), (0,2), ..., (1,2), ...`` order."""
    col = _c(fields)
    n = F.size(col)
    idx = F.sequence(F.lit(0), n - 1)
    return F.flatten(F.transform(idx, lambda i: F.transform(
        F.filter(idx, lambda j: j > i),
        lambda j: F.zip_with(F.element_at(col, i + 1), F.element_at(col, j + 1),
                             lambda x, y: x.cast("double") * y.cast("double")))))


def fm_second_order_array(fields) -> Column:
    """M6 (array form): ``0.5 * sum_d ((sum_f v_fd)^2 - sum_f v_fd^2)``."""
    col = _c(fields)
    dims = F.sequence(F.lit(1), F.size(F.element_at(col, 1)))
    per_dim = F.transform(dims, lambda d: F.struct(
        F.aggregate(col, F.lit(0.0), lambda acc, v: acc + F.element_at(v, d).cast("double")).alias("s"),
        F.aggregate(col, F.lit(0.0), lambda acc, v: acc + F.element_at(v, d).cast("double") *
                    F.element_at(v, d).cast("double")).alias("q")))
    return F.lit(0.5) * F.aggregate(per_dim, F.lit(0.0), lambda acc, t: acc + t["s"] * t["s"] - t["q"])
