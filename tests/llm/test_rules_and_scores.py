"""Operators 1 and 8, and the pipeline."""
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from tests_llm_data import prose

from tripmart.llm import quality_rules, toxicity
from tripmart.llm.common import components, table

SF = "/root/testdata/sf0.01"


def brute_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)} if len(words) < 2000 else \
        {i + j for i, w in enumerate(windows) if Counter(windows)[w] > 1 for j in range(3)} if len(set(windows)) < len(windows) else set()
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_statistics_are_those_of_the_definition(doc_rows):
    for _, t, *_ in doc_rows:
        if t is None or len(t) < 20_000:
            assert quality_rules.text_stats(t)[:5] == brute_stats(t)
    assert quality_rules.text_stats("a b c\na b c\n \n\n")[:5] == (6, 6, 0, 1, 6)


def brute_mcd(x, h=0.75, steps=4):
    """The estimate of one group with numpy's own quantiles."""
    center = np.median(x, 0)
    scale = np.median(np.abs(x - center), 0) * 1.4826
    inverse = np.diag(1 / (scale**2 + np.square(quality_rules.FLOOR)))
    for _ in range(steps):
        d = np.einsum("ij,jk,ik->i", x - center, inverse, x - center)
        kept = x[d <= np.sort(d)[int(np.ceil(h * len(d))) - 1]]
        center = kept.mean(0)
        inverse = np.linalg.inv(np.cov(kept.T, bias=True) + np.diag(np.square(quality_rules.FLOOR)))
    d = np.einsum("ij,jk,ik->i", x - center, inverse, x - center)
    return d * min(1.0, quality_rules.CHI2_MEDIAN / np.sort(d)[int(np.ceil(0.5 * len(d))) - 1])


def test_distances_match_a_direct_estimate(spark):
    from pyspark.sql import functions as F

    from tripmart.llm.common import ship

    ship(spark)
    rows = [(i, prose(i, 60 + i % 90) + (" # $ | " * (i % 4) if i % 9 == 0 else ""), "en", "a") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["distance2"] for r in quality_rules.quality(docs).collect()}
    stats = docs.select("doc_id", quality_rules.stats_column(F.col("text")).alias("s"))
    own = [(r["doc_id"], r["x"]) for r in stats.filter(~quality_rules.base_failed(F.col("s"))).select("doc_id", quality_rules.vector(F.col("s")).alias("x")).collect()]
    want = brute_mcd(np.array([x for _, x in own]))
    for (i, _), d in zip(own, want):
        assert got[i] == pytest.approx(d, rel=1e-6)


def test_quality_of_odd_rows(docs, doc_rows, no_docs):
    got = quality_rules.quality(docs).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_repeat_words"]) for r in got) == \
        Counter((i, quality_rules.text_stats(t)[0], quality_rules.text_stats(t)[4]) for i, t, *_ in doc_rows)
    by = {r["doc_id"]: r for r in got}
    for i in (401, 405, 406, 407, 408, 409):
        assert by[i]["base_failed"] and not by[i]["kept"]
    assert not by[402]["kept"] and by[2]["kept"] and by[404]["kept"]
    kept = quality_rules.filter_documents(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in got if r["kept"])
    assert quality_rules.quality(no_docs).count() == quality_rules.filter_documents(no_docs).count() == 0


def test_base_statistics_in_sql(spark):
    """The base rule's statistics on the given table, against DuckDB."""
    docs = table(spark, SF, "documents")
    got = {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"]) for r in quality_rules.quality(docs).collect()}
    want = duckdb.sql(f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM '{SF}/documents.parquet'),
        l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d),
        dup AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n FROM l WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]') GROUP BY 1)
        SELECT doc_id, len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')), length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')),
               length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')), coalesce(n, 0) FROM d LEFT JOIN dup USING (doc_id)""").fetchall()
    assert got == {r[0]: tuple(r[1:]) for r in want}


def test_factorization_learns_an_interaction():
    """Toxic only where both terms meet: additive weights cannot tell, the pairwise part can."""
    rng = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(4000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append(sorted([0] * a + [1] * b + [2 + int(rng.integers(20))]))
        y.append(float(a and b))
    bias, w, v = toxicity.fit_rows(rows, np.array(y), 22, epochs=30)
    model = toxicity.Model(bias, {i: i for i in range(22)}, w, v)
    raw = {k: model.raw(list(k)) for k in ((0, 1), (0,), (1,), ())}
    assert raw[0, 1] > 0 > max(raw[(0,)], raw[(1,)], raw[()])
    assert raw[0, 1] == pytest.approx(bias + w[0] + w[1] + v[0] @ v[1])


def test_scores_of_odd_rows(docs, doc_rows, no_docs, labels):
    got = toxicity.toxicity(docs, labels).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in doc_rows)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    assert toxicity.toxicity(no_docs, labels).count() == 0
    assert max(r["score"] for r in toxicity.toxicity(docs, labels.filter("toxic = 7")).collect()) < 1e-9
    left = toxicity.filter_documents(docs, labels, threshold=2.0)
    assert left.columns == docs.columns and left.count() == len(doc_rows)


def test_held_out_accuracy_on_the_given_table(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = toxicity.toxicity(docs, labels).filter("held_out").join(labels, "doc_id").select("toxic", "predicted").collect()
    hits = Counter((r["toxic"], r["predicted"]) for r in rows)
    assert hits[0, 1] <= 0.02 * (hits[0, 0] + hits[0, 1]) and hits[1, 1] >= 0.5 * (hits[1, 0] + hits[1, 1])


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(5, 5)]
    got = dict((r["id"], r["root"]) for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect())
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


def test_pipeline_stages(spark, tmp_path, docs, labels, doc_rows):
    import corpus_pipeline

    folder = str(tmp_path / "sf")
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "ngram_jaccard_join", "substring_dedup", "best_fit_packing"]
    from tripmart.llm.common import stored

    now = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = now.columns, []
    for name, stage in corpus_pipeline.STAGES:
        now = stored(stage(spark, now, folder), "test-pipeline")
        seen.append({r["doc_id"] for r in now.select("doc_id").collect()})
        if name != "best_fit_packing":
            assert now.columns == columns
    assert not seen[0] & {401, 402, 405, 406, 407, 408, 409}
    assert {2, 4, 10, 300, 301, 302, 404} <= seen[1]
    assert len(seen[2] & {20, *range(100, 106)}) < 7 and not seen[2] & {200, 201, 202, 203} and {3, 300, 301, 302} <= seen[2]
    assert seen[3] == seen[4] and {300, 301, 302} <= seen[4]
    assert now.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
