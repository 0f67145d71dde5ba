"""N-gram Jaccard join by MinHash banding (operator 7).

Two documents are linked if the sets of their 5-word shingles (lower-cased words
between white space) have a Jaccard similarity of 0.8 or more; a class is a connected
component of links. A text of 1 to 4 words has one shingle, all of it.

1. Documents with the same words are one *text*; all that follows works on distinct texts
   and copies are counted, never paired.
2. ``bands`` x ``rows`` MinHash values a text; ``plan_bands`` picks them so that a pair at the
   threshold shares a band with probability ``recall`` or more.
3. Shuffle on band hashes. Within a bucket, texts whose signatures agree on less than
   ``threshold - 0.2`` are told apart at once (six standard deviations below the
   threshold); the others are joined by a spanning forest, not by all their pairs. A bucket
   over ``TILE`` texts is joined whole (a superset, so nothing is lost).
4. Candidate components are cut into tiles of ``TILE`` texts; each pair of tiles is one group,
   in which the full shingle sets are intersected exactly. A group gives the number of
   links of each text and a spanning forest of its true links.
5. Components of the true links are the classes.

Defined cases: a document without words (null, empty or white space) has no
shingles and no links and is a class of its own; repeated rows (same doc_id and
text) are copies and count as links of each other; a class is named by its smallest doc_id, null
doc_ids counting as largest; no rows in, no rows out; other columns are ignored (join) or kept (filter).
Texts are told apart by a 64-bit hash of their words.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import components, freed, inner_id, outer_id, slices, stored, trimmed
from tripmart.llm.shingles import mix, shingle_hashes, word_hashes

K = 5
THRESHOLD = 0.8
RECALL = 0.9999
TILE = 256
_U = np.uint64


def plan_bands(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = 5) -> tuple[int, int]:
    """(bands, rows): the fewest bands of ``rows`` values that find a pair at the threshold with that probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)), rows


def text_id(words: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(words.tobytes(), digest_size=8).digest(), "little", signed=True)


def min_hashes(shingles: np.ndarray, at: np.ndarray, n: int, seed: int = 1) -> np.ndarray:
    """n MinHash values (32 bits) of every text that has shingles; rows of texts without are undefined."""
    rng = np.random.default_rng(seed)
    odd = rng.integers(0, 2**63, n, dtype=_U) * _U(2) + _U(1)
    plus = rng.integers(0, 2**63, n, dtype=_U)
    out = np.zeros((len(at) - 1, n), np.uint32)
    has = np.flatnonzero(np.diff(at))
    if len(has):
        for j in range(n):  # multiply-shift: the upper half of a * x + b
            out[has, j] = np.minimum.reduceat(((shingles * odd[j] + plus[j]) >> _U(32)).astype(np.uint32), at[has])
    return out


def raw_hash():
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("raw")


def signatures(docs: DataFrame, bands: int, rows: int, k: int) -> DataFrame:
    """doc_id (inner), raw (hash of the text as it is), tid (null without words), band hashes, signature (low bytes)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in freed(frames):
            ids, raw = pdf["doc_id"].to_numpy(), pdf["raw"].to_numpy()
            for first, texts in slices(pdf["text"].tolist()):
                words, w_at = word_hashes(texts)
                sh, at = shingle_hashes(words, w_at, k)
                mh = min_hashes(sh, at, bands * rows)
                keys = np.zeros((len(texts), bands), _U)
                for r in range(rows):
                    keys = mix(keys * _U(0x9E3779B97F4A7C15) + mh[:, r::rows] + _U(1))
                keys = mix(keys + np.arange(bands, dtype=_U) * _U(0x632BE59BD9B4E019)).view(np.int64)
                some = np.diff(at) > 0
                low = mh.astype(np.uint8)
                yield pd.DataFrame({
                    "doc_id": ids[first:first + len(texts)], "raw": raw[first:first + len(texts)],
                    "tid": pd.array([text_id(words[w_at[i]:w_at[i + 1]]) if some[i] else None for i in range(len(texts))], dtype="Int64"),
                    "bands": [keys[i] if some[i] else None for i in range(len(texts))],
                    "sig": [low[i].tobytes() if some[i] else None for i in range(len(texts))],
                })

    return docs.select(inner_id(F.col("doc_id")).alias("doc_id"), raw_hash(), "text").mapInPandas(
        trimmed(run), "doc_id long, raw long, tid long, bands array<long>, sig binary")


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the graph on n nodes with edges (a, b)."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = find(x), find(y)
        if rx != ry:
            root[max(rx, ry)] = min(rx, ry)
            kept.append((x, y))
    return kept


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of rows with equal keys, and the end."""
    n = len(keys[0])
    if not n:
        return np.zeros(1, int)
    return np.concatenate([[0], np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1, [n]])


def _by_key(frames: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Batches of a partition sorted by ``key``, cut between keys."""
    held: list[pd.DataFrame] = []
    for pdf in freed(frames):
        if not len(pdf):
            continue
        cut = int(np.searchsorted(pdf[key].to_numpy(), pdf[key].iloc[-1], side="left"))
        if cut:
            yield pd.concat([*held, pdf.iloc[:cut]], ignore_index=True) if held else pdf.iloc[:cut].reset_index(drop=True)
            held = [pdf.iloc[cut:]]
        elif held and held[-1][key].iloc[-1] != pdf[key].iloc[0]:
            yield pd.concat(held, ignore_index=True)
            held = [pdf]
        else:
            held.append(pdf)
    if held:
        yield pd.concat(held, ignore_index=True)


def bucket_edges(texts: DataFrame, bands: int, rows: int, threshold: float) -> DataFrame:
    """(a, b): spanning forests of the texts of each bucket whose signatures agree enough."""
    least = (threshold - 0.2) * bands * rows
    each = texts.select("tid", F.explode("bands").alias("band"))
    shared = each.groupBy("band").agg(F.count("*").alias("n"), F.min("tid").alias("low")).filter("n > 1")
    some = stored(each.join(shared, "band"), "bands")
    # oversize buckets: joined to their smallest text without a look at signatures
    wide = some.filter(F.col("n") > TILE).select(F.col("tid").alias("a"), F.col("low").alias("b"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _by_key(frames, "band"):
            tid = pdf["tid"].to_numpy()
            sig = np.frombuffer(b"".join(pdf["sig"]), np.uint8).reshape(len(pdf), -1)
            at = _runs(pdf["band"].to_numpy())
            a, b = [], []
            size = np.diff(at)
            two = at[:-1][size == 2]
            near = two[(sig[two] == sig[two + 1]).sum(1) >= least]
            a.append(tid[near])
            b.append(tid[near + 1])
            for lo, hi in zip(at[:-1][size > 2].tolist(), at[1:][size > 2].tolist()):
                own = sig[lo:hi]
                xs, ys = [], []
                for i in range(len(own) - 1):
                    j = np.flatnonzero((own[i + 1:] == own[i]).sum(1) >= least) + i + 1
                    xs.append(np.full(len(j), i))
                    ys.append(j)
                for x, y in forest(hi - lo, np.concatenate(xs), np.concatenate(ys)):
                    a.append(tid[[lo + x]])
                    b.append(tid[[lo + y]])
            yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    small = some.filter(F.col("n") <= TILE).select("tid", "band").join(texts.select("tid", "sig"), "tid")
    close = small.repartition("band").sortWithinPartitions("band").select("band", "tid", "sig").mapInPandas(trimmed(run), "a long, b long")
    return close.unionByName(wide)


def tile_links(sets: list[np.ndarray], weight: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool,
               threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links between the texts ``left`` and ``right`` of a tile pair (``same``: one tile): the
    weighted number for each text, and a spanning forest. Exact, on whole sets."""
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), size)
    useful = count[code] > 1
    code, owner = code[useful], owner[useful]
    _, code = np.unique(code, return_inverse=True)
    cells = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    width = max(1, 8_000_000 // max(1, len(sets)))
    top = int(code[-1]) + 1 if len(code) else 0
    for lo in range(0, top, width):
        i, j = np.searchsorted(code, [lo, lo + width])
        dense = np.zeros((len(sets), min(width, top - lo)), np.float32)
        dense[owner[i:j], code[i:j] - lo] = 1
        cells += dense[left] @ dense[right].T
    linked = cells >= threshold * (size[left][:, None] + size[right][None, :] - cells) - 1e-3
    if same:
        np.fill_diagonal(linked, False)
    links = np.zeros(len(sets), np.int64)
    np.add.at(links, left, linked @ weight[right])
    if not same:
        np.add.at(links, right, linked.T @ weight[left])
    x, y = np.nonzero(linked)
    return links, forest(len(sets), left[x], right[y])


def verified(docs: DataFrame, members: DataFrame, k: int, threshold: float) -> DataFrame:
    """members: (doc_id, raw, tid, root, tile, tiles, copies), one row per text. Gives (tid, links)
    rows and (a, b) rows of true links, as (tid, links, other)."""
    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in freed(frames):
            for first, texts in slices(pdf["text"].tolist()):
                words, w_at = word_hashes(texts)
                sh, at = shingle_hashes(words, w_at, k)
                own = pdf.iloc[first:first + len(texts)]
                yield own[["tid", "root", "tile", "tiles", "copies"]].assign(
                    shingles=[np.unique(sh[at[i]:at[i + 1]]).tobytes() for i in range(len(texts))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _by_key(frames, "pair"):
            rows: list[tuple] = []
            at = _runs(pdf["pair"].to_numpy(), pdf["root"].to_numpy())
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
                own = pdf.iloc[lo:hi].drop_duplicates("tid")
                tile, tid = own["tile"].to_numpy(), own["tid"].to_numpy()
                same = tile.min() == tile.max()
                left = np.flatnonzero(tile == tile.min())
                right = left if same else np.flatnonzero(tile == tile.max())
                if same and not own["alone"].iloc[0]:
                    continue
                held = [np.frombuffer(b, _U) for b in own["shingles"]]
                links, edges = tile_links(held, own["copies"].to_numpy(), left, right, same, threshold)
                rows += [(int(t), int(n), None) for t, n in zip(tid, links) if n]
                rows += [(int(tid[x]), 0, int(tid[y])) for x, y in edges]
            tids, counts, others = zip(*rows) if rows else ((), (), ())
            yield pd.DataFrame({"tid": pd.array(tids, dtype="int64"), "links": pd.array(counts, dtype="int64"),
                                "other": pd.array(others, dtype="Int64")})

    with_sets = (docs.select(inner_id(F.col("doc_id")).alias("doc_id"), raw_hash(), "text").join(members.hint("shuffle_hash"), ["doc_id", "raw"])
                 .select("tid", "root", "tile", "tiles", "copies", "text")
                 .mapInPandas(trimmed(sets), "tid long, root long, tile int, tiles int, copies long, shingles binary"))
    # every pair of tiles of a component is a group, the pair of a tile with itself too
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("with")
    pairs = with_sets.select("*", other).select(
        F.xxhash64("root", F.least("tile", "with"), F.greatest("tile", "with")).alias("pair"),
        "root", (F.col("tile") == F.col("with")).alias("alone"), "tid", "tile", "copies", "shingles")
    return pairs.repartition("pair").sortWithinPartitions("pair", "root").mapInPandas(trimmed(run), "tid long, links long, other long")


def _classes(docs: DataFrame, threshold: float, k: int, recall: float) -> DataFrame:
    """doc_id (inner), raw, tid, class_id (inner), links, copies, head (raw hash of the row that stands for the class)."""
    bands, rows = plan_bands(threshold, recall)
    sig = stored(signatures(docs, bands, rows, k), "signatures")
    texts = stored(sig.filter("tid is not null").groupBy("tid").agg(
        F.min(F.struct("doc_id", "raw")).alias("least"), F.count("*").alias("copies"), F.first("bands").alias("bands"),
        F.first("sig").alias("sig")).select("tid", "least.*", "copies", "bands", "sig"), "texts")
    rough = components(bucket_edges(texts, bands, rows, threshold), "rough")
    sizes = rough.groupBy("root").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    members = (rough.join(sizes, "root").withColumnRenamed("id", "tid")
               .join(texts.select("tid", "doc_id", "raw", "copies"), "tid")
               .withColumn("tile", F.pmod(F.xxhash64("tid"), F.col("tiles")).cast("int"))
               .select("doc_id", "raw", "tid", "root", "tile", "tiles", "copies"))
    found = stored(verified(docs, stored(members, "members"), k, threshold), "links")
    edges = found.filter("other is not null").select(F.col("tid").alias("a"), F.col("other").alias("b"))
    classes = components(edges, "classes").withColumnRenamed("id", "tid")
    links = found.groupBy("tid").agg(F.sum("links").alias("more"))
    named = (texts.select("tid", "doc_id", "raw", "copies").join(classes, "tid", "left").join(links, "tid", "left")
             .withColumn("root", F.coalesce("root", "tid")))
    heads = named.groupBy("root").agg(F.min(F.struct("doc_id", "raw")).alias("head"))
    named = stored(named.join(heads, "root").select(
        "tid", "copies", F.col("head.doc_id").alias("class_id"), F.col("head.raw").alias("head"),
        (F.coalesce("more", F.lit(0)) + F.col("copies") - 1).alias("links")), "named")
    return sig.select("doc_id", "raw", "tid").join(named, "tid", "left")


def join(docs: DataFrame, threshold: float = THRESHOLD, k: int = K, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its class), links (other
    documents at the threshold or above, copies among them), copies (documents with the same
    words, itself included)."""
    return _classes(docs, threshold, k, recall).select(
        outer_id(F.col("doc_id")).alias("doc_id"), outer_id(F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("copies", F.lit(1)).alias("copies"))


def filter_documents(docs: DataFrame, threshold: float = THRESHOLD, k: int = K, recall: float = RECALL) -> DataFrame:
    """One row of ``docs`` per class, the one with the smallest doc_id, with the columns of
    ``docs``; rows without words all stay. Of rows that repeat that doc_id and text one stays."""
    rows = _classes(docs, threshold, k, recall)
    heads = rows.filter(F.col("tid").isNull() | (F.col("class_id") == F.col("doc_id")) & (F.col("head") == F.col("raw")))
    heads = stored(heads.groupBy("doc_id", "raw").agg(((F.count("*") > 1) & (F.count("tid") > 0)).alias("_once")), "heads")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), inner_id(F.col("doc_id")).alias("doc_id"), raw_hash())
    got = packed.join(heads.hint("shuffle_hash"), ["doc_id", "raw"])
    if heads.filter("_once").isEmpty():
        return got.select("doc.*")
    once = got.filter("_once").dropDuplicates(["doc_id", "raw"])
    return got.filter(~F.col("_once")).select("doc.*").unionByName(once.select("doc.*"))
