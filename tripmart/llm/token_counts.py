"""Token counts by a finite-state transducer compiled from a sentencepiece BPE model (operator 5).

After each code point the last token of the encoding of the text so far is the one token that ends it and
may follow the last token of what is left before it (two tokens may follow each other if they, set
side by side, are encoded as themselves). What is to come can only depend on the longest text end that
begins some token, and on the last tokens at the places inside it where a token may still begin.
That is the transducer's state; a transition carries the change of the token count. States and
transitions are compiled when first met and kept.

A text is cut into chunks. A chunk's state map is: the part before its first space (run from
whatever state enters), the tokens after it, and the state that leaves; a token holds the mark
of a space only at its beginning, so a space after another character resets the state. Maps of
neighbours compose, associatively, and a prefix scan over the chunks gives the text's count.

Defined cases: a null text is empty and has no tokens; characters outside the vocabulary
count one token a UTF-8 byte; repeated rows count alike; a null doc_id stays null; no rows in, no rows
out; other columns are ignored. Strings of special tokens are ordinary text, as in the library.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import freed, inner_id, outer_id, slices
from tripmart.llm.pieces import PieceMemo
from tripmart.llm.word_bpe import vocabulary_path

SPACE = "\u2581"  # the vocabulary's mark of a space
CHUNK = 65_536
LIMIT = 4096
_START = -1  # in the place of a last token: anything may follow
_MEMO = 300_000
_UNEVEN = re.compile("^ |  | $|" + SPACE)


class Transducer:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        own = [(p.piece, p.score) for p in model.pieces if p.type in (1, 4, 5)]  # normal, user-defined, unused
        self.score = {piece: s for piece, s in own}
        if not model.normalizer_spec.add_dummy_prefix or model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("the model normalises text in a way this compiler does not know")
        if any(SPACE in p.lstrip(SPACE) for p in self.score):
            raise ValueError("a token has the mark of a space inside")
        self.prefixes = {p[:i] for p in self.score for i in range(len(p) + 1)}
        self.tokens: list[str] = []
        self.number: dict[str, int] = {}
        for p in sorted(self.score):
            if len(p) == 1 or self.merged(p) == [p]:
                self.number[p] = len(self.tokens)
                self.tokens.append(p)
        self._reset()

    def _reset(self) -> None:
        self.pairs: dict[tuple[int, int], bool] = {}
        self.states: list[tuple] = [("", ((0, _START, 0),))]
        self.state_of = {self.states[0]: 0}
        self.moves: dict[tuple[int, str], tuple[int, int]] = {}

    def merged(self, text: str) -> list[str]:
        """Best-first merges: the highest score, of equal ones the leftmost."""
        parts, score, none = list(text), self.score.get, -np.inf
        joins = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while joins and (best := max(joins)) != none:
            i = joins.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del joins[i]
            if i < len(joins):
                joins[i] = score(parts[i] + parts[i + 1], none)
            if i:
                joins[i - 1] = score(parts[i - 1] + parts[i], none)
        return parts

    def follows(self, a: int, b: int) -> bool:
        if a == _START:
            return True
        got = self.pairs.get((a, b))
        if got is None:
            x, y = self.tokens[a], self.tokens[b]
            crossing = any(x[i:] + y[:j] in self.score for i in range(len(x)) if x[i:] + y[0] in self.prefixes for j in range(1, len(y) + 1))
            got = self.pairs[a, b] = not crossing or self.merged(x + y) == [x, y]
        return got

    def step(self, state: int, c: str) -> tuple[int, int]:
        """(next state, change of the count); compiled when first asked for."""
        held, places = self.states[state]
        if c not in self.score:  # spelt in bytes, which join nothing
            new, delta = ("", ((0, _START, 0),)), len(c.encode("utf-8", "surrogatepass"))
        else:
            if c == SPACE and held and held[-1] != SPACE:
                held, places = "", ((0, _START, places[-1][2]),)
            grown = held + c
            for length, last, count in places:  # the longest end first
                token = self.number.get(grown[len(grown) - length - 1:])
                if token is not None and self.follows(last, token):
                    break
            delta = count + 1
            kept = [(n + 1, t, k - delta) for n, t, k in places if grown[len(grown) - n - 1:] in self.prefixes]
            longest = kept[0][0] if kept else 0
            new = (grown[len(grown) - longest:], (*kept, (0, token, 0)))
        at = self.state_of.get(new)
        if at is None:
            at = self.state_of[new] = len(self.states)
            self.states.append(new)
        self.moves[state, c] = (at, delta)
        return at, delta

    def run(self, state: int, text: str) -> tuple[int, int]:
        """(state after the text, tokens added to the count)."""
        total = 0
        moves = self.moves
        for c in text:
            move = moves.get((state, c)) or self.step(state, c)
            state = move[0]
            total += move[1]
        return state, total

    def count(self, piece: str) -> int:
        """Tokens of a piece that a reset precedes and follows."""
        if len(self.moves) > _MEMO:
            self._reset()
        return self.run(0, piece)[1]


class StateMap:
    """What a chunk does to the state that enters it. ``reset``: a space after another
    character lies in it; then ``head`` is what comes before, ``count`` the tokens after, ``tail`` the
    text since the last reset. Else ``head`` is the chunk."""

    __slots__ = ("head", "reset", "count", "tail")

    def __init__(self, head: str, reset: bool = False, count: int = 0, tail: str = ""):
        self.head, self.reset, self.count, self.tail = head, reset, count, tail

    def then(self, other: StateMap, counter) -> StateMap:
        """This map followed by ``other`` (associative); ``counter`` counts the pieces that meet."""
        if not self.reset:
            return StateMap(self.head + other.head, other.reset, other.count, other.tail)
        if not other.reset:
            return StateMap(self.head, True, self.count, self.tail + other.head)
        return StateMap(self.head, True, self.count + counter(self.tail + other.head) + other.count, other.tail)


def state_map(chunk: str, counter) -> StateMap:
    """The map of a chunk of marked text, whose first character may belong to a piece begun before."""
    cuts = [m.start() + 1 for m in re.finditer(f"[^{SPACE}]{SPACE}", chunk)]
    if chunk[:1] == SPACE:
        cuts = [0, *cuts]  # chunks are not cut inside a run of spaces, so another character or nothing comes before
    if not cuts:
        return StateMap(chunk)
    inner = sum(counter(chunk[a:b]) for a, b in zip(cuts, cuts[1:]))
    return StateMap(chunk[:cuts[0]], True, inner, chunk[cuts[-1]:])


def scan_count(text: str, counter, chunk: int = CHUNK) -> int:
    """Tokens of a whole text from the maps of its chunks, composed in a tree."""
    marked = (SPACE + text).replace(" ", SPACE) if text else ""
    at, maps = 0, []
    while at < len(marked):
        end = min(len(marked), at + chunk)
        while end < len(marked) and marked[end - 1] == SPACE:  # a run of spaces stays together
            end += 1
        maps.append(state_map(marked[at:end], counter))
        at = end
    while len(maps) > 1:
        maps = [a.then(b, counter) for a, b in zip(maps[0::2], maps[1::2])] + (maps[-1:] if len(maps) % 2 else [])
    return sum(counter(m.head) + m.count + counter(m.tail) for m in maps)


@functools.cache
def _worker(path: str) -> tuple[Transducer, PieceMemo]:
    t = Transducer(path)
    return t, PieceMemo(lambda pieces: [(t.count(SPACE + p),) for p in pieces], "<i8", b" ")


def count_texts(texts: list[str], path: str) -> np.ndarray:
    """Token counts of whole texts."""
    transducer, memo = _worker(path)
    out = np.zeros(len(texts), np.int64)
    uneven = [i for i, t in enumerate(texts) if _UNEVEN.search(t)]
    even = sorted(set(range(len(texts))).difference(uneven))
    if even:  # one space between pieces: every piece is "mark + piece" between resets
        values, at = memo.lookup([texts[i] for i in even])
        out[even] = np.diff(np.concatenate([[0], np.cumsum(values)])[at])
    known: dict[str, int] = {}

    def counter(piece: str) -> int:
        got = known.get(piece)
        if got is None:
            got = known[piece] = transducer.count(piece)
        return got

    for i in uneven:
        out[i] = scan_count(texts[i], counter)
    return out


def token_counts(docs: DataFrame, limit: int = LIMIT, model: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    path = model or vocabulary_path("piece_bpe_32k.model")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in freed(frames):
            counts = [count_texts(texts, path) for _, texts in slices(pdf["text"].tolist())]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_bytes": pdf["n_bytes"], "n_tokens": np.concatenate(counts) if counts else []})

    text = F.coalesce("text", F.lit(""))
    out = docs.select(inner_id(F.col("doc_id")).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")).mapInPandas(
        run, "doc_id long, n_bytes long, n_tokens long")
    return out.select(outer_id(F.col("doc_id")).alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
