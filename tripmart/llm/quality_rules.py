"""Quality rules: robust multivariate outliers per language and source (operator 8).

Words are runs of anything but space and \\t..\\r. Base rule: at least 50 words, and
at most half of them in 3-word windows that occur twice or more. Documents that
pass it are described by a transformed vector (symbol share, repeated-line share,
repeated-word share, share of letters and digits, mean word length); a minimum-covariance-
determinant estimate per (lang, source) gives each a Mahalanobis distance, and
documents too far out are rejected.

The estimate is fitted by concentration steps from medians and median deviations:
each step takes the closest three quarters of a group and their mean and
covariance, computed by Spark aggregates over all rows; no group is gathered
anywhere. Groups under ``min_rows`` use their language's estimate, then the one of
all documents.

Defined cases: a null text has no words and fails the base rule; null lang or source
is a value of its own; repeated rows are judged alike, each by itself; without rows
that pass the base rule there is no estimate and the base rule alone decides; no rows
in, no rows out; other columns pass through whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import freed, release, stored, trimmed

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_alnum"]
P = 5
#: Least standard deviation of each part of the vector: shares are angles (asin of the root), so 0.04 is a share of 0.0016.
FLOOR = (0.04, 0.12, 0.12, 0.015, 0.06)
#: Rejected beyond this squared distance. For 5 normal variables 1 in 10^6 lies beyond 37; clean texts vary more (short ones most).
MAX_DISTANCE2 = 95.0
MIN_ROWS = 60
MAX_BROADCAST_GROUPS = 20_000
CHI2_MEDIAN = 4.351  # of 5 degrees of freedom


def text_stats(text: str | None) -> tuple[int, ...]:
    """The statistics of one whole text, in the order of STATS."""
    text = text if isinstance(text, str) else ""
    words = WORD.findall(text)
    n = len(words)
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    counts = Counter(windows)
    if len(counts) < len(windows):
        covered = bytearray(n)
        for i, window in enumerate(windows):
            if counts[window] > 1:
                covered[i:i + 3] = b"\x01\x01\x01"
        repeated = sum(covered)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (n, sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated,
            len(lines), len(re.sub(r"[\W_]+", "", text)))


def stats_column(text):
    @F.pandas_udf(", ".join(f"{c} long" for c in STATS))
    def run(texts: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame([text_stats(t) for t in texts], columns=STATS, dtype="int64")
        release()
        return out

    return run(text)


def base_failed(s):
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def vector(s):
    """The transformed vector, array<double> of P parts."""
    angle = lambda part, whole: F.asin(F.sqrt(F.least(F.lit(1.0), part / F.greatest(whole, F.lit(1)))))
    return F.array(angle(s["n_symbols"], s["word_chars"]), angle(s["n_dup_lines"], s["n_lines"]),
                   angle(s["n_repeat_words"], s["n_words"]), angle(s["n_alnum"], s["word_chars"]),
                   F.log(F.greatest(s["word_chars"], F.lit(1)) / F.greatest(s["n_words"], F.lit(1))))


def _keys(lang, source):
    return F.array(F.to_json(F.struct(F.lit(2).alias("level"), lang.alias("lang"), source.alias("source"))),
                   F.to_json(F.struct(F.lit(1).alias("level"), lang.alias("lang"))), F.lit("all"))


def _distance2(x, model):
    """Squared Mahalanobis distance of x under a model row (mean, inverse)."""
    d = [x[i] - model["mean"][i] for i in range(P)]
    return sum(d[i] * d[j] * model["inverse"][i * P + j] for i in range(P) for j in range(P))


def _inverted(frames):
    """Model rows from moments: cov is regularised by FLOOR and inverted, one small matrix a row."""
    for pdf in freed(frames):
        rows = []
        for key, n, s1, s2 in zip(pdf["key"], pdf["n"], pdf["s1"], pdf["s2"]):
            mean = np.asarray(s1, float) / n
            cov = np.asarray(s2, float).reshape(P, P) / n - np.outer(mean, mean) + np.diag(np.square(FLOOR))
            rows.append((key, int(n), mean.tolist(), np.linalg.inv(cov).ravel().tolist()))
        yield pd.DataFrame(rows, columns=["key", "n", "mean", "inverse"])


def _small(model: DataFrame, groups: int) -> DataFrame:
    return F.broadcast(model) if groups <= MAX_BROADCAST_GROUPS else model


def fit(vectors: DataFrame, h: float = 0.75, steps: int = 4) -> tuple[DataFrame, int]:
    """Per key of (key, x): n, mean, inverse covariance and the scale that brings the
    median squared distance to that of a normal; and the number of keys."""
    at = lambda f: F.array(*[f(F.col("x")[i]) for i in range(P)])
    start = vectors.groupBy("key").agg(F.count("*").alias("n"), at(lambda c: F.percentile_approx(c, 0.5, 1000)).alias("mean"))
    start = stored(start, "mcd-median")
    groups = start.count()
    spread = (vectors.join(_small(start, groups), "key")
              .select("key", F.zip_with("x", "mean", lambda a, b: F.abs(a - b)).alias("x"))
              .groupBy("key").agg(at(lambda c: F.percentile_approx(c, 0.5, 1000)).alias("mad")))
    model = start.join(spread, "key").withColumn("inverse", F.array(*[
        (1 / (F.pow(F.col("mad")[i] * 1.4826, 2) + FLOOR[i] ** 2)) if i == j else F.lit(0.0)
        for i in range(P) for j in range(P)])).drop("mad")
    model = stored(model, "mcd-start")
    for _ in range(steps):
        scored = vectors.join(_small(model, groups), "key").select("key", "x", _distance2(F.col("x"), model_row()).alias("d2"))
        cut = scored.groupBy("key").agg(F.percentile_approx("d2", h, 1000).alias("cut"))
        sums = (scored.join(_small(cut, groups), "key").filter("d2 <= cut").groupBy("key").agg(
            F.count("*").alias("n"), F.array(*[F.sum(F.col("x")[i]) for i in range(P)]).alias("s1"),
            F.array(*[F.sum(F.col("x")[i] * F.col("x")[j]) for i in range(P) for j in range(P)]).alias("s2")))
        model = stored(sums.mapInPandas(trimmed(_inverted), "key string, n long, mean array<double>, inverse array<double>"), "mcd-step")
    scored = vectors.join(_small(model, groups), "key").select("key", _distance2(F.col("x"), model_row()).alias("d2"))
    scale = scored.groupBy("key").agg(F.count("*").alias("rows"), F.percentile_approx("d2", 0.5, 1000).alias("median"))
    model = model.join(scale, "key").select("key", "rows", "mean", "inverse",
                                            F.least(F.lit(1.0), CHI2_MEDIAN / F.greatest("median", F.lit(1e-9))).alias("scale"))
    return stored(model, "mcd-model"), groups


def model_row():
    return {"mean": F.col("mean"), "inverse": F.col("inverse")}


def judged(rows: DataFrame, fitted_on: DataFrame, min_rows: int = MIN_ROWS, cut: float = MAX_DISTANCE2) -> DataFrame:
    """``rows`` has one struct column ``s`` (lang, source, stats) among others; adds base_failed,
    distance2 and kept. ``fitted_on`` has the same struct for all rows of the corpus."""
    s = F.col("s")
    vectors = (fitted_on.filter(~base_failed(s)).select(F.explode(_keys(s["lang"], s["source"])).alias("key"), vector(s).alias("x")))
    model, groups = fit(vectors)
    out = rows.withColumn("base_failed", base_failed(s)).withColumn("_keys", _keys(s["lang"], s["source"]))
    for level in range(3):
        own = model.select(F.col("key").alias(f"_k{level}"), F.struct("rows", "mean", "inverse", "scale").alias(f"_m{level}"))
        if level < 2:
            own = own.filter(F.col(f"_m{level}")["rows"] >= min_rows)
        out = out.join(_small(own, groups), F.col("_keys")[level] == F.col(f"_k{level}"), "left").drop(f"_k{level}")
    m = F.coalesce("_m0", "_m1", "_m2")
    d2 = _distance2(vector(s), {"mean": m["mean"], "inverse": m["inverse"]}) * m["scale"]
    out = out.withColumn("distance2", F.when(~F.col("base_failed"), d2)).drop("_keys", "_m0", "_m1", "_m2")
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance2", F.lit(0.0)) <= cut))


def _with_stats(docs: DataFrame, keep: list) -> DataFrame:
    got = stats_column(F.col("text"))
    return docs.select(*keep, F.col("lang").alias("_l"), F.col("source").alias("_s"), got.alias("_st")).select(
        *[F.col(f"`{c}`") for c in docs.select(*keep).columns],
        F.struct(F.col("_l").alias("lang"), F.col("_s").alias("source"), *[F.col("_st")[c].alias(c) for c in STATS]).alias("s"))


def quality(docs: DataFrame, min_rows: int = MIN_ROWS, cut: float = MAX_DISTANCE2) -> DataFrame:
    """One row per document: doc_id, lang, source, statistics, base_failed, distance2, kept."""
    stats = stored(_with_stats(docs, [F.col("doc_id")]), "quality-stats")
    out = judged(stats, stats, min_rows, cut)
    return out.select("doc_id", "s.*", "base_failed", "distance2", "kept")


def filter_documents(docs: DataFrame, min_rows: int = MIN_ROWS, cut: float = MAX_DISTANCE2) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns of ``docs``."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "text", "lang", "source")
    stats = stored(_with_stats(docs, []), "quality-stats")
    out = judged(_with_stats(packed, [F.col("doc")]), stats, min_rows, cut)
    return out.filter("kept").select("doc.*")
