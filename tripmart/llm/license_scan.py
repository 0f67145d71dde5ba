"""License notices by MinHash bands over overlapping windows (operator 10).

Words are runs of ASCII letters and digits or other non-ASCII characters of the
lower-cased text. Templates of m 5-word shingles belong to the size class W, the least power of two
that holds m. For each class every text is cut into windows of three steps of W / 2 shingles, one step apart
(single shingles, or two, for the two smallest classes), so any W neighbouring shingles lie whole in
one window.

A window that holds at least ``containment`` of a template has a known least Jaccard similarity with it.
From that, each class gets the number of bands (of one MinHash value each) that finds such a window with
probability 0.9999 or more. Windows that share a band with a template are then compared exactly: the
share of the template's shingles that the window holds must reach ``containment``.

Templates are a small fixed list (or the caller's own), sent with the tasks; texts are scanned whole,
each row in the task that reads it, without a shuffle.

Defined cases: a null, empty or shorter text has no match; a text may match several templates, and
templates may lie in each other; repeated rows match alike; a null doc_id stays null; no rows in, no rows out; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import freed, inner_id, outer_id, slices
from tripmart.llm.shingles import hash_runs, joined, shingle_hashes

K = 5
CONTAINMENT = 0.8
RECALL = 0.9999
_U = np.uint64
_CUT = np.zeros(256, dtype=bool)
_CUT[[b for b in range(128) if not chr(b).isalnum()]] = True

# Texts of public license notices.
TEMPLATES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        'by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
        "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    "CC-BY-4.0 line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."),
    "MIT line": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
        "this permission notice shall be included in all copies or substantial portions of the Software."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
}


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw, first = joined([t.lower() for t in texts])
    starts, _, hashes = hash_runs(raw, _CUT)
    return hashes, np.searchsorted(starts, first)


@dataclass
class SizeClass:
    """Templates of one size class: window step and length in shingles, bands, names, sets and band values."""

    step: int
    length: int
    bands: int
    names: list[str]
    sets: list[np.ndarray]
    values: np.ndarray


def _odd(bands: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**63, 256, dtype=_U)[:bands] * _U(2) + _U(1), rng.integers(0, 2**63, 256, dtype=_U)[:bands]


def shape(m: int) -> tuple[int, int]:
    """(step, window length) of the class of m shingles."""
    w = 1 << (m - 1).bit_length()
    return (1, w) if w <= 2 else (w // 2, 3 * (w // 2))


def bands_needed(m: int, length: int, containment: float = CONTAINMENT, recall: float = RECALL) -> int:
    """Bands of one value that find a window of ``length`` shingles with the required share of m with that probability."""
    shared = math.ceil(containment * m - 1e-9)
    j = shared / (length + m - shared)
    return 1 if j >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - j))


def classes(templates: dict[str, str], containment: float = CONTAINMENT) -> list[SizeClass]:
    by: dict[tuple[int, int], list[tuple[str, np.ndarray]]] = {}
    for name, text in sorted(templates.items()):
        own, _ = shingle_hashes(*words([text]), K)
        own = np.unique(own)
        if len(own):
            by.setdefault(shape(len(own)), []).append((name, own))
    out = []
    for (step, length), own in sorted(by.items()):
        bands = max(bands_needed(len(s), length, containment) for _, s in own)
        odd, plus = _odd(bands)
        values = np.array([[((s * odd[j] + plus[j]) >> _U(32)).min() for j in range(bands)] for _, s in own], _U)
        out.append(SizeClass(step, length, bands, [n for n, _ in own], [s for _, s in own], values))
    return out


def scan(texts: list[str], known: list[SizeClass], containment: float = CONTAINMENT) -> list[tuple[int, str, float, int, int]]:
    """(text, template, best containment, first word and word after the last of that window)."""
    hashes, first = words(texts)
    sh, at = shingle_hashes(hashes, first, K)
    if not len(sh):
        return []
    n = np.diff(at)
    has = np.flatnonzero(n)
    found: dict[tuple[int, str], tuple[float, int, int]] = {}
    odd, plus = _odd(max((c.bands for c in known), default=0))
    # where the steps of each class begin: every text has its own
    plans = []
    for c in known:
        steps = -(-n[has] // c.step)
        begin = np.concatenate([[0], np.cumsum(steps)])
        start = (np.arange(begin[-1]) - np.repeat(begin[:-1], steps)) * c.step + np.repeat(at[has], steps)
        table = np.zeros((c.bands, 1 << 12), bool)
        for j in range(c.bands):
            table[j, (c.values[:, j] & _U(0xFFF)).astype(int)] = True
        plans.append((c, start, np.repeat(at[has + 1], steps), np.repeat(has, steps), table, set()))
    for j in range(len(odd)):
        h = ((sh * odd[j] + plus[j]) >> _U(32)).astype(np.uint32)
        for c, start, stop, _, table, hits in plans:
            if j >= c.bands:
                continue
            low = h if c.step == 1 else np.minimum.reduceat(h, start)
            for back in range(1, c.length // c.step):  # a window is several steps, as far as its text goes
                nxt = np.append(low[1:], np.uint32(0xFFFFFFFF)) if back == 1 else np.append(nxt[1:], np.uint32(0xFFFFFFFF))
                inside = start + back * c.step < stop
                best = np.where(inside, nxt, np.uint32(0xFFFFFFFF)) if back == 1 else np.minimum(best, np.where(inside, nxt, np.uint32(0xFFFFFFFF)))
            value = np.minimum(low, best) if c.length > c.step else low
            near = np.flatnonzero(table[j][value & np.uint32(0xFFF)])
            for t in range(len(c.names)):
                hits.update((int(w), t) for w in near[value[near] == c.values[t, j]])
    for c, start, stop, owner, _, hits in plans:
        for w, t in sorted(hits):
            a, b = int(start[w]), min(int(stop[w]), int(start[w]) + c.length)
            share = len(np.intersect1d(sh[a:b], c.sets[t])) / len(c.sets[t])
            if share >= containment - 1e-9:
                i = int(owner[w])
                key = (i, c.names[t])
                if key not in found or share > found[key][0]:
                    found[key] = (share, a - int(at[i]), b - int(at[i]) + K - 1)
    return [(i, name, *rest) for (i, name), rest in sorted(found.items())]


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """One row per document and template found: doc_id, license, containment, start_word, end_word."""
    known = classes(templates or TEMPLATES, containment)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in freed(frames):
            keys = pdf["doc_id"].tolist()
            rows = [(keys[first + i], *rest) for first, texts in slices(pdf["text"].tolist())
                    for i, *rest in scan(texts, known, containment)]
            yield pd.DataFrame(rows, columns=["doc_id", "license", "containment", "start_word", "end_word"])

    out = docs.select(inner_id(F.col("doc_id")).alias("doc_id"), "text").mapInPandas(
        run, "doc_id long, license string, containment double, start_word long, end_word long")
    return out.withColumn("doc_id", outer_id(F.col("doc_id")))


def sql(templates: dict[str, str] | None = None, containment: float = CONTAINMENT) -> str:
    """DuckDB SQL for (doc_id, license, containment): every window of every text against every template."""
    rows = []
    for name, text in sorted((templates or TEMPLATES).items()):
        step, length = shape(len(np.unique(shingle_hashes(*words([text]), K)[0])))
        rows.append("('{}', '{}', {}, {})".format(name, text.lower().replace("'", "''"), step, length))
    pattern = "'[a-z0-9\\x{80}-\\x{10FFFF}]+'"
    gram = " || ' ' || ".join(f"w[i + {j}]" if j else "w[i]" for j in range(K))
    return f"""
WITH t(license, body, step, len) AS (VALUES {', '.join(rows)}),
tw AS (SELECT *, regexp_extract_all(body, {pattern}) AS w FROM t),
tg AS (SELECT DISTINCT license, step, len, {gram} AS g FROM (SELECT *, unnest(range(1, len(w) - {K - 2})) AS i FROM tw)),
size AS (SELECT license, count(*) AS m FROM tg GROUP BY license),
dw AS (SELECT doc_id, regexp_extract_all(lower(text), {pattern}) AS w FROM documents),
dg AS (SELECT doc_id, i - 1 AS p, {gram} AS g FROM (SELECT *, unnest(range(1, len(w) - {K - 2})) AS i FROM dw)),
hit AS (SELECT doc_id, license, g, unnest(range(greatest(0, CAST(ceil((p - len + 1) / step) AS BIGINT)), CAST(floor(p / step) AS BIGINT) + 1)) AS win
        FROM dg JOIN tg USING (g)),
held AS (SELECT doc_id, license, win, count(DISTINCT g) AS n FROM hit GROUP BY ALL)
SELECT doc_id, license, max(n / m) AS containment FROM held JOIN size USING (license)
GROUP BY doc_id, license HAVING max(n / m) >= {containment} - 1e-9"""
