"""Token ids in grammar-compressed shard files (operator 9).

Documents are encoded, an end id is appended to each, and the ids are written in ascending
doc_id order as shards of about 2^21 ids. Every shard is compressed by Re-Pair: the most
frequent pairs of neighbouring ids become new symbols (nonterminals), again and again until no pair occurs
LEAST_COUNT times. Pairs are taken in descending order of frequency in rounds: a pair joins a round if no
chosen pair ends with its first symbol or begins with its last, so that replacements
cannot overlap and a round is one pass over the shard; the others wait for the next. A pair of two equal symbols is
replaced from the left in each run of them. No rule crosses a document's end.

Shard layout (little-endian): the magic, six unsigned 64-bit numbers (ids, symbols,
rules, documents, first nonterminal, 0), then the symbols (u32), rule left and right
sides (u32 each), rule expansion lengths (u32), and for each document its symbol count and its id
count (u32 each). ``document_ids`` reads one document, or a slice of it, through the
expansion lengths without decoding the shard.

Spark sees a shard as one row (bucket, before, n_ids, doc_ids, bytes) of a Parquet table in any
file system; ``before`` counts the ids of the bucket's earlier shards. Buckets are ranges of doc_id cut from the ids alone, so a task that runs
again writes the same shards. A shard's place in the whole is its bucket's place (a sum over at
most 4096 buckets) and ``before``.

Defined cases: a null text is empty (the end id alone); rows that repeat a doc_id stand
side by side, ordered by text; null doc_ids come last; no rows in, no shards and no rows out; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import bucket_of, freed, inner_id, ordered_buckets, outer_id, slices, stored
from tripmart.llm.word_bpe import END, vocabulary_path, word_ids

MAGIC = b"TMRP0001"
SHARD_IDS = 2**21
ROWS_PER_BUCKET = 2_048
FIRST_NEW = 2**16  # nonterminals are numbered from here; ids are below
LEAST_COUNT = 32
SHIFT = np.uint64(32)  # a pair is one number: its first symbol above, its last below


def _choose(keys: np.ndarray, counts: np.ndarray) -> list[int]:
    """The round's pairs, most frequent first, whose first symbols are disjoint from their last ones (but for pairs of equal symbols)."""
    first: set[int] = set()
    last: set[int] = set()
    out = []
    for key in keys[np.argsort(-counts, kind="stable")].tolist():
        a, b = key >> 32, key & 0xFFFFFFFF
        if a not in last and b not in first and (a != b or a not in first and a not in last):
            first.add(a)
            last.add(b)
            out.append(key)
    return out


def _counted(pairs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(pair, count) of the pairs met ``least`` times, sorted."""
    ranked = np.sort(pairs)
    at = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1], [True]])) if len(ranked) else np.zeros(1, int)
    often = np.flatnonzero(np.diff(at) >= least)
    return ranked[at[often]], np.diff(at)[often]


def _second(at: np.ndarray) -> np.ndarray:
    """Which of the places ``at`` of pairs of equal symbols are the second, fourth, ... of a run of them: they overlap the one before."""
    start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1] + 1]))
    return (at - np.repeat(at[start], np.diff(np.append(start, len(at))))) % 2 == 1


def _ends_of(keys: np.ndarray, size: int) -> np.ndarray:
    """A table over symbols: 1 if it is the first one of a pair, 2 if the last one, 3 if both."""
    out = np.zeros(size, np.uint8)
    out[keys >> SHIFT] = 1
    out[keys & np.uint64(2**32 - 1)] |= 2
    return out


def _between(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places whose symbol is a first one by the table ``ends``, with a last one behind it."""
    here = ends[symbols]
    return (here[:-1] & (here[1:] >> 1)).view(bool)


def compress(ids: np.ndarray, ends: np.ndarray, rounds: int | None = None, least: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, rules as an (n, 2) array, symbols of each document); ``ends`` are the documents' last places. Rounds go on until no
    pair occurs ``least`` times, unless ``rounds`` are given.

    A pair without new symbols only gets rarer, so that a round counts pairs of new symbols and those that were frequent alone.
    """
    symbols = ids.astype(np.uint32)
    closes = np.zeros(len(ids), bool)
    closes[ends] = True
    wanted = ~closes[:-1]  # places whose pair may be frequent
    rules: list[tuple[int, int]] = []
    done = 0
    while rounds is None or done < rounds:
        done += 1
        top = FIRST_NEW + len(rules)
        equal = np.flatnonzero((symbols[:-1] == symbols[1:]) & wanted)
        if len(equal):
            wanted[equal[_second(equal)]] = False
        known, counts = _counted((symbols[:-1].astype(np.uint64) << SHIFT | symbols[1:])[wanted], least)
        chosen = _choose(known, counts)
        if not chosen:
            break
        order = np.argsort(np.array(chosen, np.uint64))
        keys = np.array(chosen, np.uint64)[order]
        where = np.flatnonzero(_between(symbols, _ends_of(keys, top)) & wanted)
        pair = symbols[where].astype(np.uint64) << SHIFT | symbols[where + 1]
        place = np.searchsorted(keys, pair)
        place[place == len(keys)] = 0
        hit = keys[place] == pair
        where, rule = where[hit], order[place[hit]]
        symbols[where] = top + rule
        closes[where] |= closes[where + 1]
        keep = np.ones(len(symbols), bool)
        keep[where + 1] = False
        symbols, closes = symbols[keep], closes[keep]
        rules += [(k >> 32, k & 0xFFFFFFFF) for k in chosen]
        new = symbols >= top
        wanted = (_between(symbols, _ends_of(known, FIRST_NEW + len(rules))) | new[:-1] | new[1:]) & ~closes[:-1]
    return symbols, np.array(rules, np.uint32).reshape(-1, 2), np.diff(np.concatenate([[-1], np.flatnonzero(closes)])).astype(np.uint32)


def expansion_lengths(rules: np.ndarray) -> np.ndarray:
    """Ids under each nonterminal; a rule only names ids and earlier rules."""
    size = np.ones(FIRST_NEW + len(rules), np.int64)
    for i, (a, b) in enumerate(rules.tolist()):
        size[FIRST_NEW + i] = size[a] + size[b]
    return size


def to_bytes(ids: np.ndarray, sizes: np.ndarray) -> bytes:
    """One shard file from the ids of its documents and their lengths (at least 1 each)."""
    symbols, rules, per_doc = compress(ids, np.cumsum(sizes) - 1)
    head = np.array([len(ids), len(symbols), len(rules), len(sizes), FIRST_NEW, 0], "<u8")
    lengths = expansion_lengths(rules)[FIRST_NEW:]
    return b"".join([MAGIC, head.tobytes(), *(x.astype("<u4").tobytes() for x in (
        symbols, rules[:, 0], rules[:, 1], lengths, per_doc, sizes))])


class Shard:
    """A shard file: whole decoding and random access."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a shard file")
        self.n_ids, symbols, rules, docs, self.first_new, _ = np.frombuffer(data, "<u8", 6, 8).tolist()
        at = 8 + 48
        parts = []
        for n in (symbols, rules, rules, rules, docs, docs):
            parts.append(np.frombuffer(data, "<u4", n, at))
            at += 4 * n
        self.symbols, self.left, self.right, self.lengths, self.doc_symbols, self.doc_ids = parts
        self.size = np.concatenate([np.ones(self.first_new, np.int64), self.lengths.astype(np.int64)])
        self._text: tuple[np.ndarray, np.ndarray] | None = None

    def _expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all nonterminals one after another, where each one's begin)."""
        if self._text is None:
            begin = np.concatenate([[0], np.cumsum(self.lengths, dtype=np.int64)])
            flat = np.empty(int(begin[-1]), np.uint32)
            for i, (a, b) in enumerate(zip(self.left.tolist(), self.right.tolist())):
                at = begin[i]
                for s in (a, b):
                    if s < self.first_new:
                        flat[at] = s
                        at += 1
                    else:
                        j = s - self.first_new
                        n = begin[j + 1] - begin[j]
                        flat[at:at + n] = flat[begin[j]:begin[j + 1]]
                        at += n
            self._text = flat, begin[:-1]
        return self._text

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        flat, begin = self._expansions()
        pool = np.concatenate([np.arange(self.first_new, dtype=np.uint32), flat])
        start = np.concatenate([np.arange(self.first_new), self.first_new + begin])[symbols]
        size = self.size[symbols]
        end = np.cumsum(size)
        return pool[np.repeat(start - (end - size), size) + np.arange(int(end[-1]) if len(end) else 0)]

    def all_ids(self) -> np.ndarray:
        return self.expand(self.symbols)

    def document_ids(self, doc: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids start .. stop of the shard's doc-th document, from the symbols that hold them only."""
        lo = int(self.doc_symbols[:doc].sum())
        own = self.symbols[lo:lo + int(self.doc_symbols[doc])]
        end = np.cumsum(self.size[own])
        stop = int(end[-1]) if stop is None else min(stop, int(end[-1]))
        if start >= stop:
            return np.empty(0, np.uint32)
        a, b = int(np.searchsorted(end, start, side="right")), int(np.searchsorted(end, stop, side="left")) + 1
        skipped = int(end[a - 1]) if a else 0
        return self.expand(own[a:b])[start - skipped:stop - skipped]


SCHEMA = "bucket int, before long, n_ids long, doc_ids array<long>, bytes binary"


def shards(docs: DataFrame, vocabulary: str | None = None, shard_ids: int = SHARD_IDS, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """The shard files of all documents in ascending doc_id order, one row each."""
    path = vocabulary or vocabulary_path()
    own = docs.select(inner_id(F.col("doc_id")).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    bounds = ordered_buckets(own, "doc_id", rows_per_bucket)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = word_ids(path)
        bucket, before, size = -1, 0, 0
        ids: list[np.ndarray] = []
        names: list[int] = []

        def flush() -> pd.DataFrame:
            data = to_bytes(np.concatenate(ids), np.array([len(x) for x in ids]))
            row = pd.DataFrame([(bucket, before, size, list(names), data)], columns=["bucket", "before", "n_ids", "doc_ids", "bytes"])
            ids.clear()
            names.clear()
            return row

        for pdf in freed(frames):
            buckets, keys = pdf["bucket"].tolist(), pdf["doc_id"].tolist()
            for first, texts in slices(pdf["text"].tolist()):
                flat, at = encoder.lookup(texts)
                for i in range(len(texts)):
                    n = int(at[i + 1] - at[i]) + 1
                    if ids and (buckets[first + i] != bucket or size + n > shard_ids):
                        yield flush()
                        before, size = before + size, 0
                    if buckets[first + i] != bucket:
                        bucket, before, size = buckets[first + i], 0, 0
                    ids.append(np.append(flat[at[i]:at[i + 1]], flat.dtype.type(END)))
                    names.append(keys[first + i])
                    size += n
        if ids:
            yield flush()

    dealt = own.withColumn("bucket", bucket_of(F.col("doc_id"), bounds))
    return (dealt.repartition("bucket").sortWithinPartitions("bucket", "doc_id", "text")
            .mapInPandas(run, SCHEMA))


def places(files: DataFrame) -> DataFrame:
    """(bucket, first): ids before each bucket. One number a bucket, at most 4096, meets in the driver."""
    totals = sorted((r["bucket"], r["n"]) for r in files.groupBy("bucket").agg(F.sum("n_ids").alias("n")).collect())
    rows = [(bucket, sum(n for _, n in totals[:i])) for i, (bucket, _) in enumerate(totals)]
    return files.sparkSession.createDataFrame(rows, "bucket int, first long")


def read(files: DataFrame, made, schema: str) -> DataFrame:
    """Rows ``made(ids)`` of every document in the shard files, with doc_id and start."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in freed(frames):
            for base, keys, data in zip(pdf["base"], pdf["doc_ids"], pdf["bytes"]):
                shard = Shard(bytes(data))
                ids = shard.all_ids()
                end = np.cumsum(shard.doc_ids.astype(np.int64))
                begin = end - shard.doc_ids
                out = [made(ids[a:b]) for a, b in zip(begin.tolist(), end.tolist())]
                yield pd.DataFrame(out, columns=names).assign(doc_id=np.asarray(keys, np.int64), start=base + begin)[["doc_id", "start", *names]]

    joined = files.join(F.broadcast(places(files)), "bucket").select((F.col("first") + F.col("before")).alias("base"), "doc_ids", "bytes")
    out = joined.mapInPandas(run, f"doc_id long, start long, {schema}")
    return out.withColumn("doc_id", outer_id(F.col("doc_id")))


def write(docs: DataFrame, path: str, vocabulary: str | None = None) -> None:
    shards(docs, vocabulary).write.mode("overwrite").parquet(path)


def open_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(T._parse_datatype_string(SCHEMA)).parquet(path)


def digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files as read back."""
    files = stored(shards(docs, vocabulary), "shards")
    return read(files, lambda ids: (len(ids), zlib.crc32(ids.astype("<u4").tobytes())), "n_tokens long, ids_crc32 long")
