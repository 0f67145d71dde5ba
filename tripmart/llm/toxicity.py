"""Toxicity by a factorization machine over hashed terms (operator 1).

Terms are the distinct lower-cased words of the whole text and their beginnings of 4
and 5 letters, hashed to 2^18 buckets. score = sigmoid(w0 + sum w_i + sum_{i<j} <v_i, v_j>)
over the buckets present: the pairwise part learns interactions, such as an insult
together with the mention of a group, which additive weights miss.

The model is fitted on at most ``max_train`` labelled documents (those with the
smallest hash of doc_id; equal texts count once). Term counts by label are Spark aggregates; the buckets most
associated with the label are kept (at most ``max_terms``), and the sample's rows, now
short lists of kept buckets, are fitted by AdaGrad. Scoring reads all rows.

Defined cases: a null or empty text scores sigmoid(w0), the rate without any term;
without labelled rows of both classes every score is the share of toxic ones (0 if there are
none); a null doc_id has no label and is not held out; a document labelled twice
is toxic if one label says so; repeated rows score alike; no rows in, no rows out; other columns pass.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import freed, stored, trimmed

WORD = re.compile(r"[^\W_]+")
BUCKETS = 2**18
MAX_TRAIN = 30_000
MAX_TERMS = 8_192
FACTORS = 8
LEAST_CHI2 = 20.0
THRESHOLD = 0.3
_MEMO_WORDS = 100_000


def word_buckets(word: str) -> list[int]:
    terms = [word] + [word[:n] + "^" for n in (4, 5) if len(word) >= n]
    return [zlib.crc32(t.encode("utf-8", "surrogatepass")) % BUCKETS for t in terms]


def _present(text, live, memo: dict) -> set:
    """Buckets of ``live`` (None: all) present in the text; memo is word -> its buckets."""
    found: set = set()
    for word in set(WORD.findall(text.lower())) if isinstance(text, str) else ():
        got = memo.get(word)
        if got is None:
            if len(memo) >= _MEMO_WORDS:
                memo.clear()
            got = memo[word] = tuple(b for b in word_buckets(word) if live is None or b in live)
        if got:
            found.update(got)
    return found


@dataclass
class Model:
    bias: float
    terms: dict[int, int]  # bucket -> row
    w: np.ndarray
    v: np.ndarray

    def raw(self, rows: list[int]) -> float:
        if not rows:
            return self.bias
        v = self.v[rows]
        return float(self.bias + self.w[rows].sum() + 0.5 * (np.square(v.sum(0)) - np.square(v).sum(0)).sum())

    def score(self, buckets) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.raw(sorted(self.terms[b] for b in buckets)), -35, 35))))


def fit_rows(rows: list[list[int]], y: np.ndarray, n_terms: int, epochs: int = 15, rate: float = 0.1,
             l2: float = 1e-4, seed: int = 7) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic loss by AdaGrad in mini-batches; rows are lists of term numbers."""
    rng = np.random.default_rng(seed)
    rate0 = min(max(float(y.mean()), 1e-4), 1 - 1e-4)
    bias, w, v = float(np.log(rate0 / (1 - rate0))), np.zeros(n_terms), rng.normal(0, 0.01, (n_terms, FACTORS))
    g0, gw, gv = 1e-8, np.full(n_terms, 1e-8), np.full((n_terms, FACTORS), 1e-8)
    size = np.array([len(r) for r in rows])
    flat = np.fromiter((i for r in rows for i in r), dtype=np.int64, count=int(size.sum()))
    at = np.concatenate([[0], np.cumsum(size)])
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(rows), 256):
            batch = order[lo:lo + 256]
            doc = np.repeat(np.arange(len(batch)), size[batch])
            idx = flat[np.concatenate([np.arange(at[b], at[b + 1]) for b in batch])] if len(doc) else flat[:0]
            s = np.zeros((len(batch), FACTORS))
            np.add.at(s, doc, v[idx])
            sq, lin = np.zeros(len(batch)), np.zeros(len(batch))
            np.add.at(sq, doc, np.square(v[idx]).sum(1))
            np.add.at(lin, doc, w[idx])
            raw = bias + lin + 0.5 * (np.square(s).sum(1) - sq)
            err = 1 / (1 + np.exp(-np.clip(raw, -35, 35))) - y[batch]
            dw, dv = np.zeros(n_terms), np.zeros((n_terms, FACTORS))
            np.add.at(dw, idx, err[doc])
            np.add.at(dv, idx, err[doc, None] * (s[doc] - v[idx]))
            hit = np.unique(idx)
            dw[hit] = dw[hit] / len(batch) + l2 * w[hit]
            dv[hit] = dv[hit] / len(batch) + l2 * v[hit]
            gw[hit] += dw[hit] ** 2
            gv[hit] += dv[hit] ** 2
            w[hit] -= rate * dw[hit] / np.sqrt(gw[hit])
            v[hit] -= rate * dv[hit] / np.sqrt(gv[hit])
            d0 = float(err.mean())
            g0 += d0 * d0
            bias -= 0.1 * rate * d0 / np.sqrt(g0)
    return bias, w, v


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """(text, y) of at most about ``max_train`` labelled rows that are not held out, equal texts once."""
    own = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("toxic").alias("_y"), F.xxhash64("doc_id").alias("_h")))
    last = own.select("_h").orderBy("_h").limit(max_train).agg(F.max("_h").alias("m")).first()["m"]
    sample = F.broadcast(own.filter(F.col("_h") <= F.lit(last if last is not None else 0)).select("doc_id", "_y"))  # at most max_train rows
    return (docs.select("doc_id", "text").join(sample, "doc_id").groupBy(F.coalesce("text", F.lit("")).alias("text"))
            .agg(F.max("_y").cast("double").alias("y")))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_terms: int = MAX_TERMS) -> Model:
    def extract(frames):
        memo: dict = {}
        for pdf in freed(frames):
            for lo in range(0, len(pdf), 500):
                part = pdf.iloc[lo:lo + 500]
                yield pd.DataFrame({"y": part["y"], "buckets": [np.array(sorted(_present(t, None, memo)), np.int32) for t in part["text"]]})

    rows = stored(training_rows(docs, labels, max_train).mapInPandas(trimmed(extract), "y double, buckets array<int>"), "toxic-train")
    n, pos = rows.agg(F.count("*"), F.sum("y")).first()
    pos = pos or 0.0
    if not n or pos in (0.0, float(n)):
        share = float(pos) / n if n else 0.0
        return Model(float(np.log(share / (1 - share))) if 0 < share < 1 else (-35.0 if not share else 35.0), {}, np.zeros(0), np.zeros((0, FACTORS)))
    counts = (rows.select("y", F.explode("buckets").alias("b")).groupBy("b")
              .agg(F.count("*").alias("df"), F.sum("y").alias("tp")).filter("df >= 3"))
    a, df = F.col("tp"), F.col("df")
    expected = df * F.lit(pos / n)
    chi2 = F.pow(a - expected, 2) / expected + F.pow(expected - a, 2) / (df - expected)
    live = [r["b"] for r in counts.select("b", chi2.alias("c")).filter(F.col("c") >= LEAST_CHI2)
            .orderBy(F.desc("c"), "b").limit(max_terms).collect()]
    terms = {b: i for i, b in enumerate(live)}
    kept = rows.select("y", F.array_intersect("buckets", F.lit(np.array(live, dtype=np.int32)) if live else F.array().cast("array<int>"))
                       .alias("buckets")).orderBy("y", F.col("buckets").cast("string")).collect()
    bias, w, v = fit_rows([[terms[b] for b in r["buckets"]] for r in kept], np.array([r["y"] for r in kept]), len(live))
    return Model(bias, terms, w, v)


def score_column(text, model: Model):
    live = frozenset(model.terms)

    @F.pandas_udf("double")
    @trimmed
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo: dict = {}
        for texts in freed(batches):
            yield pd.Series([model.score(_present(t, live, memo)) for t in texts], dtype="float64")

    return run(text)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_train: int = MAX_TRAIN) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, max_train)
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(F.col("text"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def filter_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, corpus: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that score under the threshold, with the columns of ``docs``."""
    model = fit(docs if corpus is None else corpus, labels)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "text")
    return packed.filter(score_column(F.col("text"), model) < threshold).select("doc.*")
