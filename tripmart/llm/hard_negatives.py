"""Hard negatives by Fagin's threshold algorithm over blocks of candidates.

Candidates are dealt by their id to blocks of bounded size, anchors to groups; a task meets one block
and one group. It sorts the block's candidates along every dimension once. For an anchor it reads those
lists from the end that the sign of the anchor's component favours, some rows deeper each time, and
scores every row met for the first time by its whole integer inner product. The sum of the anchor's
components times the values at the present depth bounds all rows not met yet; reading stops once
this threshold is strictly below what every window still wants: its kth best score, or its lower end.
Each block gives its k best; the k best of all blocks are taken by Spark.

Two rounds: the first finds an anchor's positives (the best rows of its label, one window without
bounds), the second one window of scores for each of them among rows of other labels.

Defined cases: rows with a null vec_id, label or vector, or a null or non-finite component take no part, nor do
vectors so long or large that a score could pass 64 bits (components c of d with d * c * c >= 2^63). Of
rows that share a vec_id the one with the smallest label, then the smallest vector, takes part. Only vectors of
one length are compared; of empty ones all scores are 0. Equal scores are ordered by vec_id. An anchor
without positives or a window without negatives gives no rows. An empty table gives no rows. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import stored

K = 5
#: Candidates of a block, anchors of a group: what a task holds at once.
BLOCK, GROUP = 8192, 512
#: Rows read from every list in the first step; each further step reads twice as deep.
FIRST_DEPTH = 16
LOW, HIGH = 80, 100  # per cent of the positive's score


def prepare(rows: DataFrame, label: Column, scale: int = 256) -> DataFrame:
    """(vec_id, label, v array<long>) of the rows that take part, one per vec_id."""
    own = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                      F.transform("embedding", lambda x: F.lit(float(scale)) * x.cast("double")).alias("x"))
    sound = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(2**62)))
    whole = own.filter("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").filter(sound).select(
        "vec_id", "label", F.transform("x", lambda x: F.floor(x).cast("long")).alias("v"))
    largest = F.coalesce(F.array_max(F.transform("v", lambda x: F.abs(x))), F.lit(0)).cast("double")
    fits = F.size("v") * largest * largest < float(2**63)
    return (whole.filter(fits).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r"))
            .select("vec_id", "r.label", "r.v"))


class Block:
    """Rows of one length, ordered by vec_id, with the order of every dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.v = ids[order], labels[order], vectors[order]
        self.lists = np.argsort(self.v, axis=0, kind="stable").T.copy()  # ascending rows of each dimension
        self.sorted = np.take_along_axis(self.v.T, self.lists, axis=1)
        self.largest = int(np.abs(self.v).max(initial=0))
        self._float = self.v.astype(np.float64)

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Integer inner products. Sums under 2^53 are exact in doubles, which are faster."""
        if self.largest * int(np.abs(anchor).max(initial=0)) * len(anchor) < 2**53:
            return (self._float[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.v[rows] @ anchor

    def best(self, anchor: np.ndarray, allowed: np.ndarray, bounds: list[tuple[int, int]], k: int) -> tuple[list[list[tuple[int, int]]], int]:
        """For each window of scores (lowest, highest) the k best (score, vec_id) of the allowed rows, and how many rows were scored."""
        n = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        seen = np.zeros(n, bool)
        done = ~allowed  # rows that need no score
        rows, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        depth, step = 0, FIRST_DEPTH
        while depth < n:
            to = min(n, depth + step)
            seen[self.lists[up, n - to:n - depth]] = True
            seen[self.lists[down, depth:to]] = True
            if not len(up) and not len(down):
                seen[:] = True  # no dimension tells rows apart: all scores are 0
                to = n
            new = np.flatnonzero(seen & ~done)
            if len(new):
                done[new] = True
                rows.append(new)
                scores.append(self.scores(new, anchor))
            depth, step = to, 2 * step
            if depth == n or done.all():
                break
            threshold = int(sum(int(a) * int(x) for a, x in zip(anchor[up], self.sorted[up, n - depth]))
                            + sum(int(a) * int(x) for a, x in zip(anchor[down], self.sorted[down, depth - 1])))
            have = np.concatenate(scores)
            if all(threshold < self._wanted(have, low, high, k) for low, high in bounds):
                break
        at, have = np.concatenate(rows), np.concatenate(scores)
        out = []
        for low, high in bounds:
            inside = _inside(have, low, high)
            pick = np.flatnonzero(inside)
            pick = pick[np.lexsort((at[pick], -have[pick]))][:k]  # rows are in the order of vec_id
            out.append([(int(have[i]), int(self.ids[at[i]])) for i in pick])
        return out, len(at)

    @staticmethod
    def _wanted(have: np.ndarray, low: int | None, high: int | None, k: int) -> float:
        """The score that a row not met yet must reach to matter to this window."""
        if low is not None and high is not None and low > high:
            return float("inf")
        own = have[_inside(have, low, high)]
        if len(own) >= k:
            return int(np.partition(own, len(own) - k)[len(own) - k])
        return float("-inf") if low is None else low


def _inside(scores: np.ndarray, low: int | None, high: int | None) -> np.ndarray:
    inside = np.ones(len(scores), bool)
    if low is not None:
        inside &= scores >= low
    if high is not None:
        inside &= scores <= high
    return inside


def window(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """The scores s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def _search(candidates: DataFrame, anchors: DataFrame, same_label: bool, k: int, low: int, high: int, block: int, group: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score, vec_id, score): the k best of every block for each window of each anchor.

    ``anchors``: vec_id, label, v, and for windows targets (array of positive_id, positive_score).
    """
    blocks = max(1, -(-candidates.count() // block))
    groups = max(1, -(-anchors.count() // group))
    deal = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    left = candidates.select(deal.alias("b"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), "vec_id", "label", "v")
    targets = F.col("targets") if "targets" in anchors.columns else F.array().cast("array<struct<positive_id:bigint,positive_score:bigint>>")
    # the columns of the two sides have names of their own: both come from one table
    right = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("g"),
                           F.col("vec_id").alias("own_id"), F.col("label").alias("own_label"), F.col("v").alias("own_v"),
                           F.transform(targets, lambda t: t["positive_id"]).alias("ids"),
                           F.transform(targets, lambda t: t["positive_score"]).alias("scores"))

    def run(rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if not len(rows) or not len(wanted):
            return pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score", "vec_id", "score"])
        lengths = rows["v"].map(len).to_numpy()
        for d in np.unique(lengths):
            own = rows[lengths == d]
            held = Block(own["vec_id"].to_numpy(np.int64), own["label"].to_numpy(np.int64),
                         np.array(own["v"].tolist(), np.int64).reshape(len(own), int(d)))
            for a in wanted[wanted["own_v"].map(len) == d].itertuples():
                v = np.asarray(a.own_v, np.int64)
                allowed = (held.labels == a.own_label) == same_label
                allowed &= held.ids != a.own_id
                if same_label:
                    names, bounds = [(-1, 0)], [(None, None)]
                else:
                    names = list(zip(a.ids, a.scores))
                    bounds = [window(int(s), low, high) for s in a.scores]
                found, _ = held.best(v, allowed, bounds, k)
                out += [(a.own_id, int(p), int(s), vec_id, score) for (p, s), best in zip(names, found) for score, vec_id in best]
        return pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score", "vec_id", "score"])

    return left.groupBy("b", "g").cogroup(right.groupBy("b", "g")).applyInPandas(
        run, "anchor_id long, positive_id long, positive_score long, vec_id long, score long")


def mine(rows: DataFrame, label: Column, is_anchor: Callable[[Column], Column], k: int = K, positives: int = K, low: int = LOW,
         high: int = HIGH, scale: int = 256, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and each of its first
    ``positives`` rows of the same label the first ``k`` rows of other labels whose score is ``low`` to ``high`` per cent of the positive's."""
    held = stored(prepare(rows, label, scale), "vectors")
    anchors = held.filter(is_anchor(F.col("vec_id")))
    near = _search(held, anchors, True, positives, low, high, block, group)
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id"))
    first = near.withColumn("place", place).filter(F.col("place") <= positives)
    targets = first.groupBy("anchor_id").agg(F.array_sort(F.collect_list(
        F.struct(F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))).alias("targets"))
    with_targets = stored(anchors.join(targets, anchors["vec_id"] == targets["anchor_id"]).drop("anchor_id"), "anchors")
    far = _search(held, with_targets, False, k, low, high, block, group)
    place = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id"))
    return far.withColumn("rank", place).filter(F.col("rank") <= k).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def changed_label() -> Column:
    """The label, the next one of ten where vec_id is divisible by 7."""
    return F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label").cast("long") + 1, F.lit(10))).otherwise(F.col("label").cast("long"))


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """The registered query: anchors are rows whose vec_id is divisible by 100."""
    return mine(embeddings, changed_label(), lambda vec_id: vec_id % 100 == 0)


def sql() -> str:
    """DuckDB SQL: every anchor against every row."""
    return f"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
r AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, v) = 1),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
             CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {K}),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND {LOW} * p.score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {K}"""
