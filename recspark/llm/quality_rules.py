"""Operator 3: host-level quality rules.

Every document is measured by text rules.  The failures of each rule are
summed by host (``host_col``), the host's failure rate is shrunk towards the
rate of all hosts by a beta prior fitted to the hosts themselves (method of
moments), and the host's verdict is joined back to its documents: on a host
whose shrunk rate is above ``host_limit`` a document goes when it fails any of
the rules, elsewhere only when it fails a hard rule.  A clean document stays on
any host.

Only DataFrame functions are used.  Windows of five words are found inside the
row, by sorting their packed hashes, so no text and no word is shuffled; what
is shuffled is one partial sum for each host and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.llm.common import join_small, stored, words

WINDOW = 5
_POS_BITS = 24
_POS = (1 << _POS_BITS) - 1
#: Rules that count towards a host's rate: hard ones reject a document anywhere.
HARD = ("few_words", "repeated_windows")
SOFT = ("symbols", "repeated_lines", "word_length")


def _window_hashes(df: DataFrame) -> DataFrame:
    """``__w``: one 64-bit hash for each window of five words, in text order."""
    df = df.withColumn("__h", F.transform("__words", lambda w: F.xxhash64(w)))
    h = F.col("__h")
    at = F.sequence(F.lit(0), F.greatest(F.size(h) - WINDOW, F.lit(0)))
    hashes = F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))
    return df.withColumn("__w", F.when(F.size(h) >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>")))


def _repeat_positions(df: DataFrame) -> DataFrame:
    """``__d``: the sorted positions of the windows that occur twice or more.

    The upper 40 bits of a hash and the position share one long, so that one
    primitive sort brings equal windows together.  Texts in which two different
    windows share those 40 bits (or with over 2^24 words) sort whole hashes.
    """
    w = F.col("__w")
    df = df.withColumn("__n_distinct", F.size(F.array_distinct(w)))
    has = F.col("__n_distinct") < F.size(w)
    short = F.transform(w, lambda x: F.shiftright(x, _POS_BITS))
    packable = has & (F.size(w) < _POS) & (F.size(F.array_distinct(short)) == F.col("__n_distinct"))
    none = F.array().cast("array<bigint>")
    packed = F.sort_array(F.transform(w, lambda x, i: F.shiftleft(F.shiftright(x, _POS_BITS), _POS_BITS)
                                      .bitwiseOR(i.cast("long"))))
    whole = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("x"), i.cast("long").alias("i"))))
    df = df.withColumn("__packable", packable)
    df = df.withColumns({"__s": F.when(F.col("__packable"), packed).otherwise(none),
                         "__t": F.when(has & ~F.col("__packable"), whole)})
    s, t = F.col("__s"), F.col("__t")

    def twin(x: Column, y: Column) -> Column:
        return F.coalesce(F.shiftright(x, _POS_BITS) == F.shiftright(y, _POS_BITS), F.lit(False))

    from_packed = F.transform(
        F.filter(s, lambda x, i: twin(x, F.get(s, i + 1)) | twin(x, F.get(s, i - 1))),
        lambda x: x.bitwiseAND(F.lit(_POS).cast("long")))
    same = lambda x, y: F.coalesce(x["x"] == y["x"], F.lit(False))
    from_whole = F.transform(F.filter(t, lambda x, i: same(x, F.get(t, i + 1)) | same(x, F.get(t, i - 1))),
                             lambda x: x["i"])
    return df.withColumn("__d", F.sort_array(F.when(t.isNotNull(), from_whole).otherwise(from_packed)))


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the base columns of a text: ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words`` (all long) and ``base_failed``.

    A null text has no words.  Columns of these names are replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.withColumn("__words", words(F.col(text_col)))
    df = _repeat_positions(_window_hashes(df))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    d = F.col("__d")
    covered = F.aggregate(F.transform(d, lambda x, i: F.least(F.lit(WINDOW).cast("long"),
                                                              F.coalesce(F.get(d, i + 1) - x, F.lit(WINDOW)))),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    df = df.withColumn("__lines", lines)
    df = df.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.char_length(F.array_join("__words", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": F.when(F.size(d) == 0, F.lit(0).cast("long")).otherwise(covered),
        "__n_lines": F.size("__lines"),
    })
    df = df.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    return df.drop("__words", "__h", "__w", "__n_distinct", "__packable", "__s", "__t", "__d", "__lines")


def _rules() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "few_words": F.col("n_words") < 10,
        "repeated_windows": 100 * F.col("n_repeat_words") > 20 * F.col("n_words"),
        "symbols": F.col("n_symbols") > 0.1 * n,
        "repeated_lines": 10 * F.col("n_dup_lines") > 3 * F.col("__n_lines"),
        "word_length": (F.col("word_chars") < 3 * n) | (F.col("word_chars") > 12 * n),
    }


def host_verdicts(measured: DataFrame, host_col: str = "source", host_limit: float = 0.5) -> DataFrame:
    """One row per host: documents, failing documents, shrunk rate, ``bad_host``.

    The prior is Beta(rate * s, (1 - rate) * s): ``rate`` over all documents,
    strength ``s`` from the variance of the host rates beyond what binomial
    counts explain (1 to 1e6).  A null host is a host of its own.
    """
    fails = F.expr(" or ".join(f"__rule_{r}" for r in HARD + SOFT)).cast("long")
    hosts = measured.groupBy(F.col(host_col).alias("__host")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(fails).alias("n_failed"),
        *[F.sum(F.col(f"__rule_{r}").cast("long")).alias(f"n_{r}") for r in HARD + SOFT])
    rate = F.col("n_failed") / F.col("n_docs")
    row = hosts.agg(F.sum("n_docs").alias("docs"), F.sum("n_failed").alias("failed"), F.count(F.lit(1)).alias("hosts"),
                    F.sum(rate * rate * F.col("n_docs")).alias("square")).first()
    mean, strength = 0.0, 1e6
    if row["docs"]:
        mean = row["failed"] / row["docs"]
        p = mean * (1 - mean)
        between = row["square"] / row["docs"] - mean * mean - p * row["hosts"] / row["docs"]
        strength = min(max(p / between - 1, 1.0), 1e6) if between > 0 else 1e6
    shrunk = (F.col("n_failed") + mean * strength) / (F.col("n_docs") + strength)
    return hosts.withColumn("host_rate", shrunk).withColumn("bad_host", F.col("host_rate") > host_limit)


def quality_rules(docs: DataFrame, text_col: str = "text", host_col: str = "source",
                  host_limit: float = 0.5, drop_text: bool = False) -> DataFrame:
    """Documents with their measures, ``host_rate``, ``bad_host`` and ``kept``.

    ``drop_text`` leaves the text out of the stored measures.  Empty tables
    give no rows; repeated rows are measured each.  Columns of the output
    names are replaced, others are carried.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
             "host_rate", "bad_host", "kept")
    measured = measure(docs.drop(*[c for c in names if c in docs.columns]), text_col)
    measured = measured.withColumns({f"__rule_{k}": v for k, v in _rules().items()})
    measured = stored(measured.drop(text_col) if drop_text else measured, "quality-rules")
    hosts = stored(host_verdicts(measured, host_col, host_limit).select("__host", "host_rate", "bad_host"), "quality-hosts")
    out = join_small(measured, hosts, F.col(host_col).eqNullSafe(F.col("__host")), "left")
    soft = F.expr(" or ".join(f"__rule_{r}" for r in SOFT))
    out = out.withColumn("kept", ~F.col("base_failed") & ~(F.coalesce("bad_host", F.lit(False)) & soft))
    return out.drop(*[c for c in out.columns if c.startswith("__") and c not in docs.columns])
