"""Phrase collocations by direct-address tiling of frequency-ranked ids.

Texts are first written as batches: the numbers of their words in the batch's own word list. The lists
meet once in Spark, which counts every word per language, gives each frequent one an id by its rank
(the most frequent get the smallest) and sends the ids back to the batches; all other words
become breaks, as no frequent phrase holds them. Ids of languages differ, so an id names its language.

Adjacent ids are then counted in square tiles of the id plane: a tile that gets many pairs in a
step is counted in place by a dense ``bincount``, the others as sorted coordinates with their counts.
A task gives its sums, Spark adds those of all tasks. Frequent pairs are ranked anew, replaced
by their own ids in the batches, and counted with the word behind them by the same tiles; and so on
up to ``max_words``.

Words, per language (null: ``und``): A-Z are lower-cased, texts are split at ``. , ; : ! ?`` and line ends
into pieces, those at spaces and tabs into words.

Defined cases: null and empty texts have no words. Repeated rows count each time. doc_id and other columns are
not read. Equal scores after rounding down go to the earliest cut; equal scores of phrases to the more
frequent one, then to the smaller in bytes. A language without candidates has no rows; an empty table neither.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import freed, stored

MAX_WORDS, LEAST, INSIDE, TOP = 3, 10, 50, 2000
SCALE = 1_000_000
#: Side of a tile, tiles along each axis that may be dense, pairs that a dense tile must get in one step.
SIDE, DENSE_TILES, DENSE_PAIRS = 256, 8, 2048
#: Pairs counted in one step, distinct coordinates that a task holds before it gives them out (Spark adds them up).
STEP, HELD = 1 << 17, 1 << 20
#: Bits of the filter of frequent phrases, at every size of the input; a full one saves no shuffle and changes no result.
FILTER_BITS = 1 << 24
#: Parts that the phrases of a language are dealt to before their best meet: no task sees all of them.
SPREAD = (64, 8)

_BREAK = b"\n"
_TABLE = bytes(0x20 if c == 0x09 else 0x0A if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))


def tokens(text: str) -> list[bytes]:
    """Words of a text and a line end after each piece."""
    raw = text.encode("utf-8", "surrogatepass").lower().translate(_TABLE).replace(_BREAK, b" \n ")
    return [w for w in raw.split(b" ") if w] + [_BREAK]


def batches(docs: DataFrame) -> DataFrame:
    """One row per language of an Arrow batch: batch, lang, codes (int32 numbers in ``words``, -1 between pieces), words, counts."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in freed(frames):
            known: dict[str, dict[bytes, int]] = {}
            codes: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(pdf["lang"].tolist(), pdf["text"].tolist()):
                if not isinstance(text, str) or not text:
                    continue
                own = known.setdefault(lang, {_BREAK: 0})
                codes.setdefault(lang, []).append(np.array([own.setdefault(w, len(own)) for w in tokens(text)], np.int32))
            out = []
            for lang, own in known.items():
                numbers = np.concatenate(codes.pop(lang)) - 1
                counts = np.bincount(numbers[numbers >= 0], minlength=len(own) - 1)
                out.append((lang, numbers.astype(np.int32).tobytes(), [w.decode("utf-8", "surrogatepass") for w in own][1:], counts.tolist()))
            yield pd.DataFrame(out, columns=["lang", "codes", "words", "counts"])

    out = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text").mapInPandas(
        run, "lang string, codes binary, words array<string>, counts array<long>")
    return out.withColumn("batch", F.monotonically_increasing_id())


def ranked(counted: DataFrame, by: list[str]) -> DataFrame:
    """``counted`` (columns ``by``, n) with an int ``id`` from 0: rows of larger counts come first, to a quarter of a power of two.

    Places are summed from class to class and from range to range, so that no task orders all rows.
    """
    ranges = max(1, -(-counted.count() // 20_000))
    put = counted.select("*", F.floor(F.log2("n") * 4).cast("int").alias("class"), F.pmod(F.xxhash64(*by), F.lit(ranges)).alias("range"))
    sizes = put.groupBy("class", "range").agg(F.count("*").alias("m"))
    classes = sizes.groupBy("class").agg(F.sum("m").alias("m"))  # at most four for each of 64 powers
    first = F.sum("m").over(Window.orderBy(F.desc("class")).rowsBetween(Window.unboundedPreceding, -1))
    within = F.sum("m").over(Window.partitionBy("class").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    start = (sizes.withColumn("within", F.coalesce(within, F.lit(0))).drop("m")
             .join(classes.select("class", F.coalesce(first, F.lit(0)).alias("first")), "class")
             .select("class", "range", (F.col("first") + F.col("within")).alias("start")))
    place = F.row_number().over(Window.partitionBy("class", "range").orderBy(*by)) - 1
    return put.withColumn("place", place).join(start, ["class", "range"]).select(
        *by, "n", (F.col("start") + F.col("place")).cast("int").alias("id"))


class Tiles:
    """Counts of (row, column) pairs of ids: dense near the origin where pairs are many, sorted coordinates elsewhere."""

    def __init__(self, side: int = SIDE, tiles: int = DENSE_TILES, dense_pairs: int = DENSE_PAIRS, held: int = HELD):
        self.side, self.tiles, self.dense_pairs, self.held = side, tiles, dense_pairs, held
        self.dense: dict[int, np.ndarray] = {}
        self.codes, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, row: np.ndarray, column: np.ndarray) -> None:
        row, column = row.astype(np.int64), column.astype(np.int64)
        reach = self.side * self.tiles
        head = (row < reach) & (column < reach)
        tile = (row[head] // self.side) * self.tiles + column[head] // self.side
        busy = np.bincount(tile, minlength=self.tiles**2) >= self.dense_pairs
        busy[list(self.dense)] = True
        rest = np.ones(len(row), bool)
        rest[np.flatnonzero(head)[busy[tile]]] = False
        order = np.argsort(tile, kind="stable")
        cell = ((row[head] % self.side) * self.side + column[head] % self.side)[order]
        edge = np.searchsorted(tile[order], np.arange(self.tiles**2 + 1))
        for t in np.flatnonzero(busy):
            found = np.bincount(cell[edge[t]:edge[t + 1]], minlength=self.side**2)
            self.dense[int(t)] = self.dense[int(t)] + found if int(t) in self.dense else found
        self._merge(row[rest] << 32 | column[rest])

    def _merge(self, codes: np.ndarray) -> None:
        found, n = np.unique(codes, return_counts=True)
        every, back = np.unique(np.concatenate([self.codes, found]), return_inverse=True)
        counts = np.zeros(len(every), np.int64)
        np.add.at(counts, back, np.concatenate([self.counts, n]))
        self.codes, self.counts = every, counts

    def overflow(self) -> Iterator[pd.DataFrame]:
        """The coordinates, once they are many; counting goes on from none."""
        if len(self.codes) > self.held:
            yield from self._parts(self.codes, self.counts)
            self.codes, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)

    def rest(self) -> Iterator[pd.DataFrame]:
        for t, cells in self.dense.items():
            at = np.flatnonzero(cells)
            row, column = t // self.tiles * self.side + at // self.side, t % self.tiles * self.side + at % self.side
            yield from self._parts(row << 32 | column, cells[at])
        yield from self._parts(self.codes, self.counts)

    def _parts(self, codes: np.ndarray, counts: np.ndarray, size: int = 1 << 16) -> Iterator[pd.DataFrame]:
        for i in range(0, len(codes), size):
            yield pd.DataFrame({"code": codes[i:i + size], "n": counts[i:i + size]})


def _ints(raw) -> np.ndarray:
    return np.frombuffer(raw, np.int32)


def _sequences(pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, symbols) of each row; without a column for them, words are their own symbols."""
    ids = map(_ints, pdf["ids"])
    return zip(ids, map(_ints, pdf["symbols"])) if "symbols" in pdf else ((x, x) for x in ids)


def encode_words(held: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(batch, ids): the word ids of each batch in order, -1 for a break or a rare word."""
    each = held.select("batch", "lang", F.posexplode("words").alias("number", "word"))
    known = each.join(vocabulary, ["lang", "word"]).groupBy("batch").agg(
        F.collect_list(F.shiftleft(F.col("number").cast("long"), 32) + F.col("id")).alias("known"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in freed(frames):
            out = []
            for batch, codes, n, known in zip(pdf["batch"], pdf["codes"], pdf["n"], pdf["known"]):
                to = np.full(int(n) + 1, -1, np.int32)  # the last place is that of breaks (-1)
                known = np.asarray(known, np.int64)
                to[known >> 32] = known & 0xFFFFFFFF
                out.append((batch, to[_ints(codes)].tobytes()))
            yield pd.DataFrame(out, columns=["batch", "ids"])

    return held.select("batch", "codes", F.size("words").alias("n")).join(known, "batch").mapInPandas(run, "batch long, ids binary")


def _adjacent(ids: np.ndarray, symbols: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, codes) of frequent phrases of ``words`` words with one more frequent word behind, whose last ``words`` are frequent too."""
    if len(ids) <= words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    here, behind = symbols[:-words], ids[words:]
    at = np.flatnonzero((here >= 0) & (behind >= 0) & (symbols[1:len(here) + 1] >= 0))
    return at, here[at].astype(np.int64) << 32 | behind[at].astype(np.int64)


def count_next(encoded: DataFrame, words: int, least: int) -> DataFrame:
    """(code, n) of the frequent phrases of one word more: code is the id of the phrase in the high half, that of the next word in the low one."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tiles = Tiles()
        for pdf in freed(frames):
            for ids, symbols in _sequences(pdf):
                _, codes = _adjacent(ids, symbols, words)
                for i in range(0, len(codes), STEP):
                    tiles.add(codes[i:i + STEP] >> 32, codes[i:i + STEP] & 0xFFFFFFFF)
                    yield from tiles.overflow()
        yield from tiles.rest()

    return (encoded.drop("batch").mapInPandas(run, "code long, n long")
            .groupBy("code").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))


_FRONT, _BEHIND, _SHIFT = 2654435761, 2246822507, 16  # odd numbers under 2^32: products of ids stay under 2^63


def _slots(codes: np.ndarray) -> np.ndarray:
    return (((codes >> 32) * _FRONT ^ (codes & 0xFFFFFFFF) * _BEHIND) >> _SHIFT) & (FILTER_BITS - 1)


def phrase_filter(phrases: DataFrame) -> np.ndarray:
    """FILTER_BITS bits, those of the ``code`` of each phrase set: a code whose bit is not set is no phrase."""
    front, behind = F.shiftright("code", 32), F.col("code").bitwiseAND(0xFFFFFFFF)
    slot = F.shiftright((front * F.lit(_FRONT)).bitwiseXOR(behind * F.lit(_BEHIND)), _SHIFT).bitwiseAND(FILTER_BITS - 1)
    found = (phrases.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("at"))
             .agg(F.expr("bit_or(shiftleft(1L, CAST(slot & 63 AS INT)))").alias("bits")).toArrow())  # at most FILTER_BITS / 64 rows
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[found["at"].to_numpy()] = found["bits"].to_numpy()
    return out


def _maybe(bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    slots = _slots(codes)
    return codes[(bits[slots >> 6] >> (slots & 63)) & 1 == 1]


def encode_next(encoded: DataFrame, words: int, phrases: DataFrame) -> DataFrame:
    """The batches with the ids of ``phrases`` (code, id; one word longer) as symbols."""
    bits = phrase_filter(phrases)

    def codes_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in freed(frames):
            for batch, (ids, symbols) in zip(pdf["batch"], _sequences(pdf)):
                codes = np.unique(_maybe(bits, _adjacent(ids, symbols, words)[1]))
                for i in range(0, len(codes), STEP):
                    yield pd.DataFrame({"batch": batch, "code": codes[i:i + STEP]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in freed(frames):
            out = []
            for batch, (ids, symbols), known, names in zip(pdf["batch"], _sequences(pdf), pdf["codes"], pdf["names"]):
                at, codes = _adjacent(ids, symbols, words)
                known, names = np.asarray(known, np.int64), np.asarray(names, np.int32)
                order = np.argsort(known)
                known, names = known[order], names[order]
                place = np.minimum(np.searchsorted(known, codes), len(known) - 1)
                held = known[place] == codes
                new = np.full(len(ids), -1, np.int32)
                new[at[held]] = names[place[held]]
                out.append((batch, ids.tobytes(), new.tobytes()))
            yield pd.DataFrame(out, columns=["batch", "ids", "symbols"])

    each = encoded.mapInPandas(codes_of, "batch long, code long")
    known = each.join(phrases.select("code", "id"), "code").groupBy("batch").agg(F.collect_list(F.struct("code", "id")).alias("k"))
    return encoded.join(known, "batch").select(
        *encoded.columns, F.transform("k", lambda x: x["code"]).alias("codes"), F.transform("k", lambda x: x["id"]).alias("names")
    ).mapInPandas(run, "batch long, ids binary, symbols binary")


def phrase_counts(docs: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """((lang, n words), (lang, phrase, ids, n) of all frequent phrases of 1 to ``max_words`` words)."""
    held = stored(batches(docs), "batches")
    each = held.select("lang", F.inline(F.arrays_zip("words", "counts")))
    counted = stored(each.groupBy("lang", F.col("words").alias("word")).agg(F.sum("counts").alias("n")), "words")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    words = stored(ranked(counted.filter(F.col("n") >= least), ["lang", "word"]), "vocabulary")
    level = words.select("id", "lang", F.col("word").alias("phrase"), F.array("id").alias("ids"), "n")
    levels = [level]
    encoded = stored(encode_words(held, words), "encoded-1") if max_words > 1 else None
    for m in range(1, max_words):
        counted = stored(count_next(encoded, m, least), f"counts-{m + 1}")  # ranking reads them more than once
        pairs = stored(ranked(counted, ["code"]), f"phrases-{m + 1}")
        front, behind = F.shiftright("code", 32), F.col("code").bitwiseAND(0xFFFFFFFF)
        level = stored(
            pairs.select("id", "n", front.cast("int").alias("front"), behind.cast("int").alias("behind"))
            .join(level.select(F.col("id").alias("front"), "lang", "phrase", "ids"), "front")
            .join(words.select(F.col("id").alias("behind"), "word"), "behind")
            .select("id", "lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), F.array_append("ids", F.col("behind")).alias("ids"), "n"),
            f"level-{m + 1}")
        levels.append(level)
        if m + 1 < max_words:
            encoded = stored(encode_next(encoded, m, pairs), f"encoded-{m + 1}")
    every = levels[0]
    for more in levels[1:]:
        every = every.unionByName(more)
    return totals, every.select("lang", "phrase", "ids", "n")


def _score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)), exact: counts have up to 13 digits, products up to 35."""
    whole = {c: F.col(c).cast("decimal(13,0)") for c in (a, left, right)}
    top = whole[a] * whole[a] * F.lit(SCALE).cast("decimal(7,0)")
    return F.call_function("div", top, whole[left] * whole[right])


def scored(phrases: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """(lang, phrase, ids, a, l, r, score) of phrases of two words or more, by the cut that scores least."""
    held = phrases.select("ids", F.col("n").alias("f"))
    parts = []
    for m in range(2, max_words + 1):
        own = phrases.filter(F.size("ids") == m).withColumnRenamed("n", "a")
        cut = None
        for k in range(1, m):
            left = held.filter(F.size("ids") == k).select(F.col("ids").alias("front"), F.col("f").alias("l"))
            right = held.filter(F.size("ids") == m - k).select(F.col("ids").alias("behind"), F.col("f").alias("r"))
            own = (own.withColumn("front", F.slice("ids", 1, k)).withColumn("behind", F.slice("ids", k + 1, m - k))
                   .join(left, "front").join(right, "behind").drop("front", "behind"))
            this = F.struct(_score("a", "l", "r").alias("score"), F.lit(k).alias("k"), "l", "r")
            own = own.withColumn("cut", this if cut is None else F.least("cut", this)).drop("l", "r")
            cut = True
        parts.append(own.select("lang", "phrase", "ids", "a", "cut.l", "cut.r", "cut.score"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _without_contained(candidates: DataFrame, inside: int, max_words: int) -> DataFrame:
    """The candidates that no longer candidate holds with ``inside`` per cent of their count or more."""
    sub = [F.struct(F.slice("ids", i, k).alias("ids"), F.col("a").alias("longer"))
           for k in range(2, max_words) for i in range(1, max_words - k + 2)]
    if not sub:
        return candidates
    within = (candidates.filter(F.size("ids") > 2).select(F.explode(F.array(*sub)).alias("s"), F.size("ids").alias("m"))
              .select("s.*", "m").filter(F.size("ids") < F.col("m")).groupBy("ids").agg(F.max("longer").alias("longer")))
    return candidates.join(within, "ids", "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a"))).drop("longer")


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST, inside: int = INSIDE, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language."""
    totals, phrases = phrase_counts(docs, max_words, least)
    kept = _without_contained(stored(scored(phrases, max_words), "candidates"), inside, max_words)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    near = kept
    for parts in SPREAD:
        part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
        near = near.withColumn("place", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).filter(F.col("place") <= top)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def sql() -> str:
    """DuckDB SQL: all phrases of one to three words, counted and scored (words hold no spaces, so joined ones keep their cuts)."""
    grams = "\n".join(f"UNION ALL SELECT lang, {m} AS m, array_to_string(w[i:i + {m - 1}], ' ') AS p FROM (SELECT lang, w, unnest(range(1, len(w) - {m - 2})) AS i FROM t)"
                      for m in range(1, MAX_WORDS + 1)).removeprefix("UNION ALL ")
    return f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
       unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
t AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
f AS MATERIALIZED (SELECT lang, m, p, count(*) AS a FROM ({grams}) GROUP BY ALL HAVING count(*) >= {LEAST}),
total AS (SELECT lang, sum(len(w)) AS n FROM t GROUP BY lang),
c AS (SELECT lang, m, p, a, string_split(p, ' ') AS w FROM f WHERE m >= 2),
parts AS (SELECT lang, m, p, a, k, array_to_string(w[1:k], ' ') AS front, array_to_string(w[k + 1:m], ' ') AS behind, m - k AS rest
          FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
cut AS (SELECT s.lang, s.m, s.p, s.a, s.k, l.a AS l, r.a AS r,
               CAST({SCALE}::HUGEINT * s.a * s.a // (l.a::HUGEINT * r.a) AS BIGINT) AS score
        FROM parts s JOIN f l ON l.lang = s.lang AND l.m = s.k AND l.p = s.front JOIN f r ON r.lang = s.lang AND r.m = s.rest AND r.p = s.behind),
scored AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
within AS (SELECT lang, p, max(a) AS longer FROM
           (SELECT lang, a, array_to_string(w[i:i + 1], ' ') AS p FROM (SELECT *, unnest([1, 2]) AS i FROM c WHERE m = 3)) GROUP BY lang, p),
kept AS (SELECT s.* FROM scored s LEFT JOIN within USING (lang, p) WHERE longer IS NULL OR 100 * longer < {INSIDE} * s.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM kept JOIN total USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) <= {TOP}"""
