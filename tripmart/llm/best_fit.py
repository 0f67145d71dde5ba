"""Best-fit packing of documents into sequences under several capacities (operator 2).

A sequence (bin) has three capacities: tokens, documents and attention cost (the sum of
squared lengths). Pieces go longest first into the open bin that fits under every
capacity and either leaves the smallest weighted norm of what remains
(``rule="norm"``) or has the largest weighted dot product of the piece's demand
and the bin's remainder (``rule="dot"``); a new bin is opened only if none fits.

Pieces are dealt round-robin to groups of at most about ``group_rows`` and every group is
packed in its own task, from lengths only. A group of thousands of pieces leaves a few
unfilled bins, so the loss against one global packing is below one in a thousand.

Defined cases: a null or empty text is one piece that holds the end token; texts
longer than a sequence, and only those, are cut into full pieces with a shorter last one; repeated rows are packed
each by itself; a null doc_id stays null; no rows in, no rows out; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import freed, inner_id, outer_id, slices, stored, trimmed
from tripmart.llm.word_bpe import END, vocabulary_path, word_ids

TOKENS = 4096
GROUP_ROWS = 16_384


def pieces(docs: DataFrame, tokens: int = TOKENS, vocabulary: str | None = None) -> DataFrame:
    """doc_id (inner form), piece, start, length, ids_crc32 of all pieces of all texts."""
    path = vocabulary or vocabulary_path()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = word_ids(path)
        for pdf in freed(frames):
            rows: list[tuple] = []
            ids_of = pdf["doc_id"].tolist()
            for first, texts in slices(pdf["text"].tolist()):
                flat, at = encoder.lookup(texts)
                for i in range(len(texts)):
                    ids = np.empty(at[i + 1] - at[i] + 1, "<u4")
                    ids[:-1] = flat[at[i]:at[i + 1]]
                    ids[-1] = END
                    for k, start in enumerate(range(0, len(ids), tokens)):
                        part = ids[start:start + tokens]
                        rows.append((ids_of[first + i], k, start, len(part), zlib.crc32(part.tobytes())))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(inner_id(F.col("doc_id")).alias("doc_id"), "text").mapInPandas(
        trimmed(cut), "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, tokens: int, max_docs: int, max_cost: float, rule: str = "norm",
             weights: tuple[float, float, float] = (1.0, 0.05, 0.2)) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset in the bin) of each piece. Every capacity holds in every bin; a piece that
    exceeds one by itself is refused."""
    demand = np.stack([lengths / tokens, np.full(len(lengths), 1 / max_docs), np.square(lengths.astype(float)) / max_cost])
    if len(lengths) and demand.max() > 1 + 1e-9:
        raise ValueError("a piece exceeds a capacity of an empty sequence")
    w = np.asarray(weights)
    left = np.empty((3, 1024))
    used = np.zeros(1024, np.int64)
    n_bins = 0
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    live = np.empty(0, np.int64)  # bins that the shortest piece may still fit
    order = np.argsort(-lengths, kind="stable")
    shortest = demand[:, order[-1]] if len(order) else None
    eps = 1e-9
    for turn, i in enumerate(order):
        d = demand[:, i]
        if turn % 512 == 0 and len(live):
            live = live[(left[:, live] + eps >= shortest[:, None]).all(0)]
        rest = left[:, live]
        fits = (rest[0] + eps >= d[0]) & (rest[1] + eps >= d[1]) & (rest[2] + eps >= d[2])
        some = np.flatnonzero(fits)
        if len(some):
            rest = rest[:, some]
            score = (w @ np.square(rest - d[:, None])) if rule == "norm" else -((w * d) @ rest)
            b = live[some[np.argmin(score)]]
        else:
            b = n_bins
            n_bins += 1
            if n_bins > left.shape[1]:
                left = np.concatenate([left, np.empty_like(left)], axis=1)
                used = np.concatenate([used, np.zeros_like(used)])
            left[:, b] = 1.0
            live = np.append(live, b)
        where[i], offset[i] = b, used[b]
        used[b] += lengths[i]
        left[:, b] -= d
    return where, offset


def pack(docs: DataFrame, tokens: int = TOKENS, max_docs: int = TOKENS, max_cost: float | None = None, rule: str = "norm",
         group_rows: int = GROUP_ROWS, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The default document and cost capacities are those that ``tokens`` implies, so that only
    tokens bind; smaller ones hold in every sequence.
    """
    cost = float(max_cost if max_cost is not None else tokens * tokens)
    cut = stored(pieces(docs, tokens, vocabulary), "pieces")
    groups = max(1, -(-cut.count() // group_rows))
    dealt = cut.withColumn("_group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        where, offset = best_fit(pdf["length"].to_numpy(np.int64), tokens, max_docs, cost, rule)
        return pdf.drop(columns="_group").assign(sequence_id=where + (int(key[0]) << 32), offset=offset)

    out = dealt.groupBy("_group").applyInPandas(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumn("doc_id", outer_id(F.col("doc_id")))
