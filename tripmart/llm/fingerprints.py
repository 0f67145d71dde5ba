"""Document fingerprints from prefix polynomial hashes (operator 4).

``PrefixHash`` keeps, for two bases modulo 2^31 - 1, the sums of code point * base^i up to
each place. Any span's hash follows from two of them, so spans of any two texts are
compared in constant time and longest common extensions are found by binary search.

A fingerprint holds the number of code points, the hash of the whole text and the 64
smallest distinct hashes of all its spans of 16 code points (of the whole text if it is
shorter) and of the spans of 4 among its first 64, which tell short texts apart. Likeness of two fingerprints is the share of spans in common, 2 J / (1 + J) with the Jaccard
estimate J of the two samples; equal texts have equal fingerprints and likeness 1.

``edited`` replaces the last half of each text by the beginning of the next document in
descending doc_id. Documents are dealt to buckets, ranges of doc_id cut from the ids
alone; the first document of a bucket also goes, as context, to the bucket before
it, so every pair of neighbours meets in one task that reads its rows once and in order. Spans of the
edited text are those of the two parts and the few across the cut: nothing is hashed twice.

Defined cases: a null text is empty; two empty texts are alike (1), an empty and another are not
(0); one document alone is its own next; null doc_ids count as largest; rows that repeat a doc_id follow each
other in the order of a hash of the text; no rows in, no rows out; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import bucket_of, freed, inner_id, ordered_buckets, outer_id
from tripmart.llm.shingles import mix

_U = np.uint64
PRIME = 2**31 - 1
_P, _S = _U(PRIME), _U(31)
BASES = (1_103_515_245, 1_852_378_561)
SPAN = 16
SAMPLE = 64
HEAD, HEAD_SPAN = 64, 4
_BITS = 48
ROWS_PER_BUCKET = 2_048


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo 2^31 - 1 for x under 2^63."""
    x = (x & _P) + (x >> _S)
    x = (x & _P) + (x >> _S)
    return np.where(x >= _P, x - _P, x)


_tables: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of both bases and of their inverses, at least n of each."""
    if not _tables or len(_tables[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        made = []
        for base in (*BASES, *(pow(b, -1, PRIME) for b in BASES)):
            p = np.ones(1, _U)
            while len(p) < size:
                p = np.concatenate([p, _reduced(p * _U(pow(base, len(p), PRIME)))])
            made.append(p)
        _tables[:] = made
    return _tables


class PrefixHash:
    """Hashes of all spans of one text."""

    def __init__(self, points: np.ndarray):
        self.n = len(points)
        tables = _powers(self.n + 1)
        values = points.astype(_U) + _U(1)
        self.sums = []
        for power in tables[:2]:
            s = np.zeros(self.n + 1, _U)
            np.cumsum(_reduced(values * power[:self.n]), out=s[1:])
            self.sums.append(s)

    @classmethod
    def of(cls, text: str) -> PrefixHash:
        return cls(code_points(text))

    def span(self, start: int, end: int) -> tuple[int, int]:
        """The hash of places start .. end - 1."""
        inverse = _powers(self.n + 1)[2:]
        return tuple(int(s[end] - s[start]) % PRIME * int(i[start]) % PRIME for s, i in zip(self.sums, inverse))

    def spans(self, length: int) -> np.ndarray:
        """48-bit hashes of all spans of that length, or of the whole text if it is shorter."""
        if not self.n:
            return np.empty(0, _U)
        length = min(length, self.n)
        k = self.n - length + 1
        a, b = (_reduced(_reduced(s[length:] - s[:k]) * i[:k]) for s, i in zip(self.sums, _powers(self.n + 1)[2:]))
        return mix((a << _S | b) + _U(length << 62 & 0xFFFFFFFFFFFFFFFF)) >> _U(64 - _BITS)

    def common(self, other: PrefixHash, i: int = 0, j: int = 0) -> int:
        """Length of the longest common extension of place i here and place j in ``other``."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            mid = (low + high + 1) // 2
            if self.span(i, i + mid) == other.span(j, j + mid):
                low = mid
            else:
                high = mid - 1
        return low


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def sample(*hashes: np.ndarray) -> np.ndarray:
    """The SAMPLE smallest distinct values."""
    n = sum(map(len, hashes))
    top = 1 << _BITS
    limit = top if n <= 4 * SAMPLE else top * 3 * SAMPLE // n
    while True:
        own = np.unique(np.concatenate([h[h < _U(limit)] for h in hashes]) if limit < top else np.concatenate(hashes))
        if len(own) >= SAMPLE or limit >= top:
            return own[:SAMPLE]
        limit = min(top, limit * 8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of spans in common, from two samples."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:max(len(a), len(b)) if max(len(a), len(b)) >= SAMPLE else None]
    both = np.intersect1d(a, b, assume_unique=True)
    j = float(np.isin(both, union).sum()) / len(union)
    return 2 * j / (1 + j)


def shown(n: int, whole: tuple[int, int], values: np.ndarray) -> str:
    return f"{n:x}.{whole[0]:08x}{whole[1]:08x}." + np.ascontiguousarray(values.astype(">u8")).view(np.uint8).reshape(-1, 8)[:, 2:].tobytes().hex()


def head_spans(points: np.ndarray) -> np.ndarray:
    return PrefixHash(points[:HEAD]).spans(HEAD_SPAN)


class _Document:
    __slots__ = ("text", "points", "hash", "spans", "head", "sample", "print")

    def __init__(self, text: str):
        self.text = text
        self.points = code_points(text)
        self.hash = PrefixHash(self.points)
        self.spans = self.hash.spans(SPAN)
        self.head = head_spans(self.points)
        self.sample = sample(self.spans, self.head)
        self.print = shown(self.hash.n, self.hash.span(0, self.hash.n), self.sample)

    def followed_by(self, other: _Document) -> tuple:
        """The result row, without doc_id, given the next document."""
        n = self.hash.n
        half = n // 2
        keep, took = n - half, min(half, other.hash.n)
        edited = self.text[:keep] + other.text[:took]
        m = keep + took
        if m <= SPAN or keep < SPAN or took < SPAN:
            points = code_points(edited)
            mine = sample(PrefixHash(points).spans(SPAN), head_spans(points))
        else:
            across = PrefixHash(np.concatenate([self.points[keep - SPAN + 1:keep], other.points[:SPAN - 1]])).spans(SPAN)
            head = self.head if keep >= HEAD else head_spans(np.concatenate([self.points[:keep], other.points[:min(took, HEAD - keep)]]))
            mine = sample(self.spans[:keep - SPAN + 1], other.spans[:took - SPAN + 1], across, head)
        a, b = self.hash.span(0, keep), other.hash.span(0, took)
        whole = tuple((x + y * int(p[keep])) % PRIME for x, y, p in zip(a, b, _powers(keep + 1)))  # the hash of the two parts joined
        return (n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), self.print, shown(m, whole, mine),
                likeness(self.sample, mine), likeness(self.sample, other.sample), self.hash.common(other.hash))


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, common_with_next long")
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def fingerprints(docs: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, common_with_next (code points that the text and the next one begin with alike)."""
    text = F.coalesce("text", F.lit(""))
    ids = docs.select(inner_id(F.col("doc_id")).alias("doc_id"))
    bounds = ordered_buckets(ids, "doc_id", rows_per_bucket)
    first = sorted((r["b"], r["m"]) for r in ids.groupBy(bucket_of(F.col("doc_id"), bounds).alias("b"))
                   .agg(F.max("doc_id").alias("m")).collect())  # one row a bucket, at most 4096
    # the first document of a bucket follows the last of the next larger bucket; the very first, that of the smallest
    heads = [(m, first[(i + 1) % len(first)][0]) for i, (_, m) in enumerate(first)]
    head = docs.sparkSession.createDataFrame(heads, "doc_id long, before int")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, held, alone = -1, None, False
        for pdf in freed(frames):
            rows = []
            for b, context, key, t in zip(pdf["bucket"].tolist(), pdf["context"].tolist(), pdf["doc_id"].tolist(), pdf["text"].tolist()):
                if b != bucket:
                    bucket, held = b, None
                if held is None and context:
                    continue
                doc = _Document(t)
                if held is not None:
                    rows.append((held[0], *held[1].followed_by(doc)))
                held = None if context else (key, doc)
            yield pd.DataFrame(rows, columns=_NAMES)

    own = docs.select(inner_id(F.col("doc_id")).alias("doc_id"), text.alias("text"))
    own = own.withColumn("bucket", bucket_of(F.col("doc_id"), bounds)).join(F.broadcast(head), "doc_id", "left")
    places = F.when(F.col("before").isNull(), F.array(F.struct(F.col("bucket"), F.lit(0).alias("context")))).otherwise(
        F.array(F.struct(F.col("bucket"), F.lit(0).alias("context")), F.struct(F.col("before").alias("bucket"), F.lit(1).alias("context"))))
    dealt = own.select("doc_id", "text", F.inline(places))
    out = (dealt.repartition("bucket").sortWithinPartitions("bucket", "context", F.desc("doc_id"), F.xxhash64("text"))
           .select("bucket", "context", "doc_id", "text").mapInPandas(run, SCHEMA))
    return out.withColumn("doc_id", outer_id(F.col("doc_id")))
