"""BPE encoding by prefix-sharing trie traversal, and decoding (operator 6).

The distinct words of a slice of texts form a trie over their symbols (a byte, or a byte
that ends its word). A node's state is the last token of the encoding of its prefix: the
one token that ends the prefix and may follow the last token of what is left before it.
States are propagated depth first, so the encoding of a prefix is worked out once for all
words below it; a word's tokens are read back from the states on its path.

Two tokens may follow each other if no merge across their border comes first. Ranks only grow while
a word is merged (a merge has a higher rank than those that made its parts), so the parts that
touch the border at rank r are known from how the two tokens were built.

Pieces between white space keep their ids while a worker runs (``PieceMemo``, bounded). Special-token
strings, which the library finds before it splits words, and pieces with control characters
that count as white space go through the library.

Defined cases: a null text is empty; an empty text has no ids and decodes to the
empty text; repeated rows are encoded alike; a null doc_id stays null; no rows in, no rows out;
other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import freed, inner_id, outer_id, slices
from tripmart.llm.pieces import PieceMemo
from tripmart.llm.word_bpe import ODD, SPECIAL, WORDS, library, parts, vocabulary_path

_MEMO_PAIRS = 400_000


class Vocabulary:
    """Tokens as strings of symbols: chr(byte), or chr(256 + byte) for the byte that ends a word."""

    def __init__(self, path: str):
        strings, _, letters = parts(path)
        with open(path, encoding="utf-8") as f:
            merges = json.load(f)["model"]["merges"]

        def symbols(token: str) -> str:
            core = token.removesuffix("</w>")
            s = "".join(chr(letters[c]) for c in core)
            return s if core == token else s[:-1] + chr(256 + ord(s[-1]))

        id_of = {t: i for i, t in enumerate(strings)}
        self.merge: dict[tuple[int, int], int] = {}  # pair -> rank
        made: list[tuple[int, int, int]] = []
        for rank, m in enumerate(merges):
            a, b = m if isinstance(m, list) else m.split(" ")
            pair = (id_of[a], id_of[b])
            self.merge[pair] = rank
            made.append((id_of[a + b], *pair))
        self.ids: dict[str, int] = {}
        # what touches a token's left / right end, with the rank at which it becomes part of more
        self.left: dict[int, list[tuple[int, float]]] = {}
        self.right: dict[int, list[tuple[int, float]]] = {}
        for i, t in enumerate(strings):
            if t and len(t.removesuffix("</w>")) == 1:
                self.ids[symbols(t)] = i
                self.left[i] = self.right[i] = [(i, float("inf"))]
        for rank, (new, a, b) in enumerate(made):
            if a not in self.left or b not in self.left:
                continue
            cut = lambda side: [(t, min(r, rank)) for t, r in side]  # noqa: B023, E731
            la, rb = self.left[a], self.right[b]
            if self.apart(cut(self.right[a]), cut(self.left[b]), (a, b)):
                self.ids[symbols(strings[new])] = new
                self.left[new] = [(new, float("inf")), *((t, min(r, rank)) for t, r in la)]
                self.right[new] = [(new, float("inf")), *((t, min(r, rank)) for t, r in rb)]
        self.longest = max(map(len, self.ids))
        self.size = {i: len(s) for s, i in self.ids.items()}
        self.known: dict[int, bool] = {}

    def apart(self, right: list[tuple[int, float]], left: list[tuple[int, float]], but: tuple[int, int] | None = None) -> bool:
        """No merge joins a part at the right end of one token to one at the left end of the next before either is used up.
        Equal ranks go from left to right."""
        for a, until_a in right:
            for b, until_b in left:
                rank = self.merge.get((a, b))
                if rank is not None and rank < until_a and rank <= until_b and (a, b) != but:
                    return False
        return True

    def follows(self, a: int, b: int) -> bool:
        key = a << 20 | b
        got = self.known.get(key)
        if got is None:
            if len(self.known) >= _MEMO_PAIRS:
                self.known.clear()
            got = self.known[key] = self.apart(self.right[a], self.left[b])
        return got

    def encode_words(self, words: set[str]) -> dict[str, list[int]]:
        """Ids of distinct words. Sorted words visit their trie depth first: ``state`` is the path
        from the root, and what a word shares with the one before it is kept."""
        ids, follows, size, longest = self.ids, self.follows, self.size, self.longest
        out: dict[str, list[int]] = {}
        state: list[int] = []
        before = ""
        symbols = {}
        for word in words:
            s = word.encode("utf-8", "surrogatepass").decode("latin-1")
            symbols[s[:-1] + chr(256 + ord(s[-1]))] = word
        for s in sorted(symbols):
            n = min(len(s), len(before))
            shared = next((i for i in range(n) if s[i] != before[i]), n)
            del state[shared:]
            for d in range(shared, len(s)):
                for begin in range(max(0, d + 1 - longest), d + 1):
                    token = ids.get(s[begin:d + 1])
                    if token is not None and (begin == 0 or follows(state[begin - 1], token)):
                        state.append(token)
                        break
            before = s
            tokens, d = [], len(s)
            while d:
                tokens.append(state[d - 1])
                d -= size[state[d - 1]]
            out[symbols[s]] = tokens[::-1]
        return out


def lowered(piece: str) -> str:
    """The vocabulary's normal form: composed, then each character lower-cased by itself."""
    piece = unicodedata.normalize("NFC", piece)
    return piece.lower() if piece.isascii() or "Σ" not in piece else "".join(c.lower() for c in piece)


def learner(path: str):
    vocabulary = Vocabulary(path)

    def learn(pieces: list[str]) -> list[list[int]]:
        split = [None if SPECIAL in p or ODD.search(p) else WORDS.findall(lowered(p)) for p in pieces]
        known = vocabulary.encode_words({w for s in split if s for w in s})
        return [library(path).encode(p, add_special_tokens=False).ids if s is None
                else known[s[0]] if len(s) == 1 else [i for w in s for i in known[w]] for p, s in zip(pieces, split)]

    return learn


@functools.cache
def encoder(path: str) -> PieceMemo:
    """This worker's encoder (its memory serves all tasks of the worker)."""
    return PieceMemo(learner(path), "<u2")


def decode(ids: list[int], strings: list[str]) -> str:
    """The vocabulary names no decoder: its tokens are set side by side with spaces."""
    return " ".join(map(strings.__getitem__, ids))


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, ids (array<int>), decoded of every document."""
    path = vocabulary or vocabulary_path()
    return _run(docs, path, lambda ids, text: (ids.astype(np.int32), text), "ids array<int>, decoded string")


def digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    path = vocabulary or vocabulary_path()
    sha = lambda data: hashlib.sha256(data).hexdigest()
    return _run(docs, path, lambda ids, text: (len(ids), sha(ids.astype("<u4").tobytes()), sha(text.encode("utf-8"))),
                "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _run(docs: DataFrame, path: str, made, schema: str) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        strings = parts(path)[0]
        memo = encoder(path)
        for pdf in freed(frames):
            rows = []
            for _, texts in slices(pdf["text"].tolist()):
                flat, at = memo.lookup(texts)
                for i in range(len(texts)):
                    ids = flat[at[i]:at[i + 1]]
                    rows.append(made(ids, decode(ids.tolist(), strings)))
            yield pd.DataFrame(rows, columns=names).assign(doc_id=pdf["doc_id"].to_numpy())[["doc_id", *names]]

    out = docs.select(inner_id(F.col("doc_id")).alias("doc_id"), "text").mapInPandas(run, f"doc_id long, {schema}")
    return out.withColumn("doc_id", outer_id(F.col("doc_id")))
