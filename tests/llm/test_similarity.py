"""Operators 3, 4, 7 and 10 against brute force."""
import hashlib
import random
import weakref
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
from tests_llm_data import doubled, edited, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmart.llm import common, fingerprints, jaccard_join, license_scan, substring_dedup
from tripmart.llm import shingles as shingles_module
from tripmart.llm.shingles import shingle_hashes, word_hashes

WORD = r"[^\x20\x09-\x0D]+"


def shingles(text):
    import re

    w = re.findall(WORD, (text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_shingles_are_those_of_the_words(doc_rows):
    texts = [r[1] or "" for r in doc_rows]
    words, first = word_hashes(texts)
    sh, at = shingle_hashes(words, first, 5)
    seen: dict = {}
    for i, t in enumerate(texts):
        own = set(sh[at[i]:at[i + 1]].tolist())
        assert len(own) == len(shingles(t))
        for j in range(i):
            assert len(own & seen[j]) == len(shingles(t) & shingles(texts[j]))
        seen[i] = own


def brute_classes(doc_rows):
    sets = [shingles(t) for _, t, *_ in doc_rows]
    n = len(sets)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both / len(sets[i] | sets[j]) >= 0.8:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    big = 2**63 - 1
    least = defaultdict(lambda: big)
    for i, r in enumerate(doc_rows):
        least[find(i)] = min(least[find(i)], big if r[0] is None else r[0])
    return [(r[0], None if least[find(i)] == big else least[find(i)], links[i]) for i, r in enumerate(doc_rows)]


def test_join_finds_every_link(docs, doc_rows, no_docs):
    got = Counter((r["doc_id"], r["class_id"], r["links"]) for r in jaccard_join.join(docs).collect())
    assert got == Counter(brute_classes(doc_rows))
    assert jaccard_join.join(no_docs).count() == 0


def test_filter_keeps_one_of_each_class(docs, doc_rows, no_docs):
    got = jaccard_join.filter_documents(docs)
    assert got.columns == docs.columns
    ids = Counter(r["doc_id"] for r in got.collect())
    classes = brute_classes(doc_rows)
    worded = [c for c, r in zip(classes, doc_rows) if shingles(r[1])]
    want = Counter({c: 1 for _, c, _ in worded if c is not None})
    want[7] += 1  # another text under the same id
    want[None] = 1
    for r in doc_rows:
        if not shingles(r[1]):
            want[r[0]] += 1
    assert ids == want
    assert jaccard_join.filter_documents(no_docs).count() == 0


def test_texts_of_a_doubling_pattern_are_no_copies(spark):
    a, b = doubled()
    words, _ = word_hashes([a, b])
    assert words[0] != words[1]
    docs = spark.createDataFrame([(0, a), (1, b), (2, f"one {a} two"), (3, f"one {b} two")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["class_id"], r["links"], r["copies"]) for r in jaccard_join.join(docs).collect())
    assert got == [(i, i, 0, 1) for i in range(4)]
    assert jaccard_join.filter_documents(docs).count() == 4


def test_tiles_count_links_of_one_large_group(monkeypatch, spark):
    monkeypatch.setattr(jaccard_join, "TILE", 8)
    base = prose(5, 200)
    rows = [(i, edited(base, i, i % 6)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["class_id"], r["links"]) for r in jaccard_join.join(docs).collect())
    assert got == Counter(brute_classes(rows))


def test_bands_reach_the_recall():
    bands, rows = jaccard_join.plan_bands()
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 > 1 - (1 - 0.8**rows) ** (bands - 1)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=25, unique=True))
def test_chains_match_the_quadratic_recurrence(matches):
    pos, other = (np.array(x) for x in zip(*matches))
    order = np.lexsort((-other, pos))
    best: dict = {}
    for i in order:
        before = [best[j] - substring_dedup.GAP * (pos[i] - pos[j] + other[i] - other[j]) for j in best if pos[j] < pos[i] and other[j] < other[i]]
        best[i] = 5 + max(0, max(before, default=0))
    chains = substring_dedup.chains(pos, other)
    assert sorted(i for c in chains for i in c.tolist()) == list(range(len(pos)))
    for c in chains:
        assert (np.diff(pos[c]) > 0).all() and (np.diff(other[c]) > 0).all()
    c = chains[0]
    score = 5 + sum(5 - substring_dedup.GAP * (pos[b] - pos[a] + other[b] - other[a]) for a, b in zip(c, c[1:]))
    assert abs(score - max(best.values())) < 1e-6


def test_passages_are_found_and_cut(docs, doc_rows, no_docs):
    found = substring_dedup.find(docs).collect()
    pairs = {(r["doc_id"], r["other_doc_id"]) for r in found}
    passage = prose(900, 70).lower().split()
    texts = {r[0]: (r[1] or "").lower().split() for r in doc_rows if r[0] is not None and r[0] != 7}
    for i in (301, 302):  # the shared passage, exactly
        own = [r for r in found if r["doc_id"] == i]
        assert len(own) == 1
        assert texts[i][own[0]["start_word"]:own[0]["end_word"]] == passage
    for i in range(101, 106):  # near copies hang on the first of their kind
        assert any(a == i and b in (20, *range(100, i)) for a, b in pairs)
    assert {(200 + i, 3) for i in range(4)} <= pairs
    assert not {r["doc_id"] for r in found} & {0, 1, 2, 3, 20, 300, 405, 408, 409}
    left = substring_dedup.filter_documents(docs)
    assert left.columns == docs.columns
    left = {r["doc_id"]: r for r in left.filter("doc_id is not null").collect()}
    assert not {200, 201, 202, 203} & set(left)  # nothing was left of whole copies
    for i in (301, 302):
        words = (left[i]["text"] or "").lower().split()
        assert words == f"{prose(i - 250, 90)} {prose(i - 230, 80)}".lower().split()
        assert left[i]["n_chars"] == len(left[i]["text"])
    assert left[300]["text"] == next(r[1] for r in doc_rows if r[0] == 300) and left[408]["text"] == ""
    assert substring_dedup.find(no_docs).count() == 0 and substring_dedup.filter_documents(no_docs).count() == 0


def plain(seed, n):
    return " ".join(prose(seed, n).lower().split())


def covered(spark, texts, doc_id):
    """Words of one document that lie in its passages."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {w for r in substring_dedup.find(docs).filter(f"doc_id = {doc_id}").collect() for w in range(r["start_word"], r["end_word"])}


def test_two_passages_with_own_text_between_are_both_found(spark):
    for size, own in ((60, 50), (60, 100), (100, 150), (100, 250), (200, 400)):
        one, two = plain(1000 + own, size), plain(2000 + own, size)
        texts = [" ".join([plain(1, 30), one, plain(2, own), two, plain(3, 30)]), " ".join([plain(4, 40), one, plain(5, own), two, plain(6, 20)])]
        got = covered(spark, texts, 1)
        assert {*range(40, 40 + size), *range(40 + size + own, 40 + 2 * size + own)} <= got and len(got) <= 2 * size + 10


def test_every_copy_inside_the_later_document_is_found(spark):
    one, phrase = plain(3000, 70), " ".join(plain(3000, 70).split()[20:35])
    texts = [f"{plain(11, 30)} {one} {plain(12, 30)}", " ".join([plain(13, 10), phrase, plain(14, 10), one, plain(15, 60), one, plain(16, 30), one])]
    start = 35
    want = {w for k in (start, start + 130, start + 230) for w in range(k, k + 70)}
    got = covered(spark, texts, 1)
    assert want <= got and len(got) <= len(want) + 10


def test_recall_of_fuzzy_passages(spark):
    """Substitutions at random places: every such pair is a passage by brute force (same length, words equal in place, both ends equal)."""
    rng = random.Random(2)
    texts, want = [], {}
    for size in (50, 80, 120):
        for identity in (0.95, 0.9, 0.85, 0.8):
            for _ in range(20):
                own = plain(4000 + len(texts), size).split()
                other = list(own)
                for i in rng.sample(range(2, size - 2), size - round(size * identity)):
                    other[i] = f"x{rng.randint(0, 9999)}y"
                assert sum(a == b for a, b in zip(own, other)) >= 0.8 * size
                texts.append(" ".join([plain(5000 + len(texts), 30), *own, plain(6000 + len(texts), 30)]))
                want[len(texts)] = size, identity
                texts.append(" ".join([plain(7000 + len(texts), 20), *other, plain(8000 + len(texts), 20)]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"] for r in substring_dedup.find(docs).collect()}
    missed = Counter(want[i] for i in want if i not in found)
    for size in (50, 80, 120):
        assert missed[size, 0.95] <= 1 and missed[size, 0.9] <= 4
    assert missed[80, 0.85] <= 5 and missed[120, 0.85] <= 2 and missed[120, 0.8] <= 8


def test_repeats_made_of_frequent_lines_are_found_whole(spark, monkeypatch):
    lines = [plain(9000 + i, 30) for i in range(4)]
    elsewhere = [f"{plain(9100 + 10 * i + j, 30)} {lines[i]} {plain(9200 + 10 * i + j, 30)}" for i in range(4) for j in range(8)]
    passage = " ".join(lines)
    half = len(elsewhere) // 2
    texts = [*[t for k, t in enumerate(elsewhere) if k % 2], f"{plain(9300, 30)} {passage} {plain(9301, 30)}",
             *[t for k, t in enumerate(elsewhere) if k % 2 == 0], f"{plain(9302, 20)} {passage} {plain(9303, 30)}"]
    assert len(texts) == 2 * half + 2
    want = set(range(20, 140))
    assert covered(spark, texts, len(texts) - 1) == want
    monkeypatch.setattr(substring_dedup, "HOT", 16)  # frequent seeds dealt by ranges of documents
    monkeypatch.setattr(substring_dedup, "SAMPLE", 2)
    monkeypatch.setattr(substring_dedup, "ordered_buckets", lambda *_: [5, 12, 20, 28])
    assert covered(spark, texts, len(texts) - 1) == want


def test_all_frequent_seeds_are_dealt_by_ranges(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", 2)
    monkeypatch.setattr(substring_dedup, "SAMPLE", 1)
    text = " ".join(f"w{i}" for i in range(110_004))
    docs = spark.createDataFrame([(0, text), (1, text)], "dk long, text string")
    assert len(substring_dedup.hot_seeds(docs)) > 110_000


def test_packs_of_matches_grow_with_the_matches(spark, monkeypatch):
    texts = [f"{plain(9500 + i, 30)} {plain(9600 + i % 40, 60)} {plain(9700 + i, 30)}" for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {tuple(r) for r in substring_dedup.find(docs).collect()}
    assert len({r[0] for r in want}) == 160
    monkeypatch.setattr(substring_dedup, "CHARS", 500)  # many buckets of seeds
    monkeypatch.setattr(substring_dedup, "FAN", 4, raising=False)
    size = sum(map(len, texts))
    one_level = substring_dedup.linked(substring_dedup.keyed(docs, ["text"]))
    assert one_level.count() <= 2 * (size // 500) * 4
    monkeypatch.setattr(substring_dedup, "PAIR_CHARS", 2_000, raising=False)  # groups of pairs are dealt on
    monkeypatch.setattr(substring_dedup, "STEP", 1_000, raising=False)
    assert substring_dedup.linked(substring_dedup.keyed(docs, ["text"])).agg({"bucket": "max"}).first()[0] >= 4
    assert {tuple(r) for r in substring_dedup.find(docs).collect()} == want


def test_words_travel_once_for_a_pair_of_documents(spark):
    lines = [plain(9800 + i, 55) for i in range(20)]
    texts = [" ".join(f"{plain(base + i, 12)} {line}" for i, line in enumerate(order)) for base, order in ((9900, lines), (9950, lines[::-1]))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pairs = substring_dedup.chained(substring_dedup.linked(substring_dedup.keyed(docs, ["text"]))).collect()
    assert len(pairs) == 1  # not a row for each of the 20 passages
    for side in ("own", "its"):
        blocks = list(pairs[0][side])
        assert blocks == sorted(set(blocks)) and len(blocks) <= 20 * 67 // substring_dedup.BLOCK + 2  # the margin may lie behind the end
    found = {(r["start_word"], r["other_start_word"], r["end_word"] - r["start_word"]) for r in substring_dedup.find(docs).collect()}
    assert {(12 + 67 * i, 12 + 67 * (19 - i), 55) for i in range(20)} == found


def test_prefix_hashes_answer_spans_and_extensions():
    a, b = fingerprints.PrefixHash.of("abcabcabd" * 50), fingerprints.PrefixHash.of("xxabcabcabd" + "abcabcabe")
    assert a.span(0, 3) == a.span(3, 6) != a.span(6, 9)
    assert a.common(a, 0, 9) == 441 and a.common(b, 0, 2) == 17 and a.common(b, 0, 0) == 0
    values = a.spans(16)
    assert len(values) == 450 - 15 and len(set(values.tolist())) == 9


def test_fingerprints_of_documents(docs, doc_rows, no_docs):
    got = fingerprints.fingerprints(docs, rows_per_bucket=6).collect()
    by_text: dict = {}
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert len(got) == len(doc_rows)
    unique = [i for i, n in Counter(r[0] for r in doc_rows).items() if n == 1]
    order = sorted((r for r in doc_rows if r[0] is not None), key=lambda r: -r[0])
    rows = {r["doc_id"]: r for r in got}
    for k, (i, t, *_) in enumerate(order[:-1]):
        nxt = order[k + 1]
        if i not in unique or nxt[0] not in unique:
            continue
        t, after = t or "", nxt[1] or ""
        half = len(t) // 2
        change = t[:len(t) - half] + after[:half]
        r = rows[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(change.encode()).hexdigest()
        own, new = fingerprints._Document(t), fingerprints._Document(change)
        assert (r["fingerprint"], r["edited_fingerprint"]) == (own.print, new.print)
        assert r["near_edited"] == fingerprints.likeness(own.sample, new.sample)
        assert by_text.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        if len(t) > 400 and len(after) > 400 and i != 401:  # which is one word over and over
            assert 0.3 < r["near_edited"] < 0.8 or r["near_next"] > 0.7
    assert len(set(by_text.values())) == len(by_text)
    # the last document's next is the first; null doc_ids come first
    assert rows[0]["n_chars"] == len(order[-1][1])
    assert fingerprints.fingerprints(no_docs).count() == 0


def test_one_document_is_its_own_next(spark):
    r = fingerprints.fingerprints(spark.createDataFrame([(1, "hello world")], "doc_id long, text string")).first()
    assert r["edited_sha256"] == hashlib.sha256(b"hello hello").hexdigest() and r["near_next"] == 1.0


def test_licenses_match_the_sql(docs, doc_rows, no_docs):
    got = {(r["doc_id"], r["license"]): r["containment"] for r in license_scan.license_scan(docs).collect()}
    documents = pd.DataFrame([(r[0], r[1]) for r in doc_rows], columns=["doc_id", "text"]).astype({"doc_id": "Int64"})  # noqa: F841
    want = {(a, b): c for a, b, c in duckdb.sql(license_scan.sql()).fetchall()}
    assert got == want and (403, "MIT line") in got
    assert license_scan.license_scan(no_docs).count() == 0


def test_notices_are_found_anywhere_and_with_changes():
    known = license_scan.classes(license_scan.TEMPLATES)
    for n, (name, text) in enumerate(sorted(license_scan.TEMPLATES.items())):
        for before in (0, 3, 17, 40):
            found = license_scan.scan([f"{prose(n, before)} {text.upper()} {prose(n + 50, 30)}"], known)
            assert (name, 1.0) in {(f[1], f[2]) for f in found}
    long = license_scan.TEMPLATES["MIT"].replace("merge", "mix")
    assert [f[1] for f in license_scan.scan([prose(1, 30) + " " + long], known)] == ["MIT"]
    assert license_scan.scan([prose(1, 500)], known) == []


def test_words_are_hashed_in_blocks_with_small_tables(monkeypatch):
    texts = [plain(9800, 60_000), "x" * 150_000 + " y", "", " \n ", "z"]
    whole = [word_hashes([t])[0].tolist() for t in texts]
    monkeypatch.setattr(shingles_module, "_prime_powers", [])
    words, at = word_hashes([texts[0], *texts[2:]])
    assert max(len(a) for pair in shingles_module._prime_powers for a in pair) <= 2**16  # a worker keeps them
    assert [words[a:b].tolist() for a, b in zip(at, at[1:])] == [whole[0], *whole[2:]]
    for block in (1, 7, 2**20):  # the same hashes wherever blocks end
        monkeypatch.setattr(shingles_module, "_BLOCK", block)
        words, at = word_hashes(texts)
        assert [words[a:b].tolist() for a, b in zip(at, at[1:])] == whole


def test_a_task_gives_back_its_last_batch(monkeypatch):
    """Memory is given back once more when nothing of the last batch is held any longer."""
    held, alive = [], []
    monkeypatch.setattr(common, "release", lambda: alive.append(sum(w() is not None for w in held)))

    @common.trimmed
    def run(frames):
        for batch in common.freed(frames):
            made = np.zeros(len(batch))
            held.append(weakref.ref(made))
            yield made

    for _ in run(iter([np.zeros(3), np.zeros(4)])):
        del _
    assert len(held) == 2 and alive[-2:] == [1, 0]
