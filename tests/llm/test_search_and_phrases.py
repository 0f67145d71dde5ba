"""Operators 11 to 13: decontamination, hard negatives, collocations."""
import glob
import hashlib
import io
import os
import re
from collections import Counter
from contextlib import redirect_stdout

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm_data import prose

from tripmart.llm import collocations, entry, hard_negatives, positional_index

SMALL = "/root/testdata/sf0.001"


def plain(rows, columns):
    return Counter(tuple(r[c] for c in columns) for r in rows)


def by_sql(name, sf_dir=SMALL):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    found = con.execute(entry.oracle_sql()[name])
    return [c[0] for c in found.description], found.fetchall()


@pytest.mark.parametrize("name", ["op11_decontamination", "op12_hard_negatives", "op13_collocations"])
def test_query_equals_sql(spark, name):
    columns, want = by_sql(name)
    got = entry.queries()[name](spark, SMALL)
    assert set(got.columns) == set(columns)
    assert plain(got.collect(), columns) == Counter(map(tuple, want))


# -- decontamination ----------------------------------------------------------------------------

def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def cut(item, size=10):
    return [tuple(item[i:i + size]) for i in range(max(1, len(item) - size + 1))] if item else []


def brute_contamination(docs, items, size=10):
    wins = [(w, i) for i, t in items for w in cut(words(t), size)]
    out = []
    for doc_id, text in docs:
        own = words(text)
        places = {}
        for n in {len(w) for w, _ in wins}:
            for i in range(len(own) - n + 1):
                places.setdefault(tuple(own[i:i + n]), []).append(i)
        hit = {p for w, _ in wins for i in places.get(w, ()) for p in range(i, i + len(w))}
        names = sorted({str(i) for w, i in wins if w in places and i is not None})
        out.append((doc_id, len(own), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


@pytest.fixture(scope="module")
def items(doc_rows):
    texts = {i: t for i, t, *_ in doc_rows}
    return [(1, " ".join(words(texts[3])[20:45]).upper()), (2, " ".join(words(texts[20])[5:16])), (10, texts[405]), (11, "word"),
            (12, "word word word word word word word word word word word word"), (13, None), (14, "  ,;"), (None, " ".join(words(texts[7])[3:14])),
            (15, "日本語 😀"), (16, "no such words anywhere in any of these documents at all really"), (1, "two three"), (17, texts[405]),
            (18, "CAFÉ É")]


def test_contamination_is_that_of_brute_force(spark, docs, doc_rows, items):
    texts = [(i, t) for i, t, *_ in doc_rows] + [(900, "a cafÉ É b café é"), (901, "CAFÉ É")]
    more = docs.select("doc_id", "text", F.lit(1).alias("key"), F.lit("x").alias("words"), F.lit(2).alias("win")).unionByName(
        spark.createDataFrame([(i, t, 1, "x", 2) for i, t in texts[-2:]], "doc_id long, text string, key int, words string, win int"))
    bench = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, start int")
    got = positional_index.contamination(more, bench)
    assert plain(got.collect(), COLUMNS) == Counter(brute_contamination(texts, items))
    assert positional_index.contamination(more.limit(0), bench).count() == 0
    none = positional_index.contamination(more, bench.limit(0)).collect()
    assert len(none) == len(texts) and not any(r["contaminated"] or r["n_hit"] or r["n_items"] for r in none)


def test_phrases_and_stretches_are_those_of_brute_force(spark, docs, doc_rows, items):
    index = positional_index.build(docs)
    wins = positional_index.windows(spark.createDataFrame(items, "item_id long, text string"), 4)
    spans = positional_index.spans(index, wins, positional_index.phrase_matches(index, wins)).collect()
    own = {i: words(t) for i, t, *_ in doc_rows}
    for r in spans:
        assert r["phrase"].split(" ") in [w[r["start"]:r["start"] + r["len"]] for w in (words(t) for i, t, *_ in doc_rows if i == r["doc_id"])]
    assert {(r["item_id"], r["start"]) for r in spans if r["doc_id"] == 405} >= {(10, 0), (17, 0), (1, 1)}
    near = positional_index.spans(index, wins, positional_index.proximity_matches(index, wins, 3)).collect()
    got = Counter((r["doc_id"], r["item_id"], r["start"], r["len"], r["phrase"]) for r in near)
    want = Counter()
    for i, t, *_ in doc_rows:
        w = words(t)
        for item, phrase in {(item, p) for item, text in items for p in cut(words(text), 4)}:
            span = len(phrase) + 3
            for s in range(max(0, len(w) - span) + 1):
                if set(phrase) <= set(w[s:s + span]):
                    want[(i, item, s, span, " ".join(phrase))] += 1
    assert got == want and own


def test_index_can_be_opened_again_and_runs_without_python(spark, docs):
    from tripmart.session import scratch_path

    path = scratch_path(spark, "index")
    positional_index.build(docs, path)
    index = positional_index.open_index(spark, path)
    assert index.postings.count() == index.tokens.agg(F.sum("n_words")).first()[0] == index.terms.agg(F.sum("n")).first()[0]
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    text = io.StringIO()
    with redirect_stdout(text):
        positional_index.contamination(docs, bench).explain("formatted")
        index.postings.explain()
    assert not re.search("Python|Pandas|Arrow", text.getvalue())


# -- hard negatives -----------------------------------------------------------------------------

def brute_negatives(rows, is_anchor, label_of, k=5):
    held = {}
    for vec_id, label, x in rows:
        if vec_id is None or label is None or x is None or any(c is None or not np.isfinite(c) for c in x):
            continue
        v = [int(np.floor(256 * float(c))) for c in x]
        if len(v) * max(map(abs, v), default=0) ** 2 < 2**63:
            new = (label_of(vec_id, label), v)
            held[vec_id] = min(held.get(vec_id, new), new)
    out = Counter()
    for a, (la, va) in held.items():
        if not is_anchor(a):
            continue
        scores = sorted((-sum(p * q for p, q in zip(va, v)), i, lab == la) for i, (lab, v) in held.items() if i != a and len(v) == len(va))
        for p, positive, _ in [s for s in scores if s[2]][:k]:
            fit = [(n, i) for n, i, same in scores if not same and 80 * -p <= 100 * -n <= 100 * -p][:k]
            for rank, (n, i) in enumerate(fit, 1):
                out[(a, positive, rank, i, -p, -n)] += 1
    return out


ANSWER = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_negatives_are_those_of_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(0, 4)), [float(c) for c in np.round(rng.normal(0, 0.4, 6), 1 if i % 2 else 3)]) for i in range(300)]
    rows += [(400 + i, 1, rows[10][2]) for i in range(40)]  # one very common vector
    rows += [(300, 2, [0.0] * 6), (310, 2, [float("nan")] * 6), (320, None, [1.0] * 6), (330, 1, None), (340, 1, [None] * 6), (None, 1, [1.0] * 6),
             (350, 1, [float("inf")] * 6), (360, 1, [1e30] * 6), (370, 3, [5.0, -5.0]), (371, 3, [4.0, -5.0]), (372, 2, [4.0, -4.5]), (380, 1, []), (381, 1, []),
             (382, 2, []), (390, 1, [2.0e5] * 6), (391, 1, [2.0e5] * 6), (392, 2, [1.9e5] * 6), rows[10], rows[20], (20, 0, rows[30][2])]
    df = spark.createDataFrame([(i, lab, x, 1, "y") for i, lab, x in rows], "vec_id long, label int, embedding array<double>, b int, own_v string")
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    want = brute_negatives(rows, lambda i: i % 10 == 0, lambda i, lab: (lab + 1) % 10 if i % 7 == 0 else lab)
    for block, group in ((8192, 512), (17, 4)):
        got = hard_negatives.mine(df, label, lambda c: c % 10 == 0, block=block, group=group)
        assert plain(got.collect(), ANSWER) == want
    assert hard_negatives.mine(df.limit(0), label, lambda c: c % 10 == 0).count() == 0


def test_threshold_stops_before_all_rows_are_scored():
    rng = np.random.default_rng(1)
    v = np.sort(rng.integers(-1000, 1000, (5000, 3)), axis=0)  # rows that are large in one dimension are large in all
    block = hard_negatives.Block(np.arange(5000), np.zeros(5000, int), v)
    anchor = np.array([3, 2, 7])
    (best,), scored = block.best(anchor, np.ones(5000, bool), [(None, None)], 5)
    assert [s for s, _ in best] == sorted((v @ anchor).tolist(), reverse=True)[:5] and scored < 500
    low, high = int((v @ anchor)[4000]), int((v @ anchor)[4100])
    (best,), scored = block.best(anchor, np.ones(5000, bool), [(low, high)], 5)
    assert all(low <= s <= high for s, _ in best) and len(best) == 5 and scored < 2500
    assert hard_negatives.window(-5) == (-4, -5) and hard_negatives.window(7) == (6, 7)


def test_large_scores_are_whole():
    v = np.array([[2**28, 1], [2**28, 2], [2**28, 3]])
    block = hard_negatives.Block(np.arange(3), np.zeros(3, int), v)
    (best,), _ = block.best(np.array([2**28, 1]), np.ones(3, bool), [(None, None)], 3)
    assert best == [(2**56 + 3, 2), (2**56 + 2, 1), (2**56 + 1, 0)]


# -- collocations -------------------------------------------------------------------------------

def brute_phrases(docs, max_words, least, inside, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for lang, text in docs:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            w = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(w)
            f.update((lang or "und", tuple(w[i:i + m])) for m in range(1, max_words + 1) for i in range(len(w) - m + 1))
    found = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    out = []
    for lang in n:
        best = []
        for (at, p), a in found.items():
            longer = [b for (other, q), b in found.items() if other == at and len(q) > len(p)
                      and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))] if at == lang else []
            if at != lang or any(100 * b >= inside * a for b in longer):
                continue
            score, k = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        out += [(lang, r, p.decode(), -a, x, y, n[lang], -s) for r, (s, a, p, x, y) in enumerate(sorted(best)[:top], 1)]
    return Counter(out)


PHRASE = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("max_words, least, inside, top", [(3, 3, 50, 40), (4, 2, 60, 2000), (2, 4, 50, 7)])
def test_collocations_are_those_of_brute_force(spark, docs, doc_rows, max_words, least, inside, top):
    kept = [(lang, t) for i, t, lang, *_ in doc_rows if i != 404]
    extra = [("en", "A b,c  d. A b\tc d"), (None, "x y z x y z\x0bx y\rz"), ("fr", " ".join(["la"] * 50)), ("xx", ",;"), ("xx", None)]
    df = (docs.filter("doc_id IS NULL OR doc_id <> 404").select("lang", "text", F.lit(3).alias("n"), F.lit(1).alias("word"))
          .unionByName(spark.createDataFrame([(a, b, 3, 1) for a, b in extra], "lang string, text string, n int, word int")))
    got = collocations.collocations(df, max_words, least, inside, top)
    assert plain(got.collect(), PHRASE) == brute_phrases(kept + extra, max_words, least, inside, top)


def test_no_documents_no_phrases(spark, no_docs):
    assert collocations.collocations(no_docs).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, None), ("en", "")], "lang string, text string")).count() == 0


def test_tiles_count_as_a_plain_counter_does():
    rng = np.random.default_rng(2)
    tiles, want, parts = collocations.Tiles(side=8, tiles=3, dense_pairs=40, held=300), Counter(), []
    for _ in range(20):
        a, b = (rng.zipf(1.3, 500).clip(1, 90) - 1 for _ in range(2))
        tiles.add(a, b)
        want.update(zip(a.tolist(), b.tolist()))
        parts += list(tiles.overflow())
    assert tiles.dense and parts  # both ways were taken
    got = Counter()
    for frame in [*parts, *tiles.rest()]:
        for code, n in zip(frame["code"].tolist(), frame["n"].tolist()):
            got[(code >> 32, code & 0xFFFFFFFF)] += n
    assert got == want


def test_ids_follow_frequency(spark):
    rows = spark.createDataFrame([(i, 10 + i * i) for i in range(200)], "word long, n long")
    got = collocations.ranked(rows, ["word"]).collect()
    assert sorted(r["id"] for r in got) == list(range(200))
    order = [r["n"] for r in sorted(got, key=lambda r: r["id"])]
    assert all(b <= a * 2 ** 0.25 * 1.001 for i, a in enumerate(order) for b in order[i + 1:i + 30])
    assert prose(1, 3)
