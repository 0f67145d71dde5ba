"""Token ids of the word-end BPE vocabulary (``word_bpe_49k.json``), fast, inside tasks.

The ids are those of the tokenizers library. That library takes over a second a
megabyte of this kind of text, so words go through tiktoken's merge loop with the
same vocabulary: a word's end is the byte 0x00 after it, the 256 "last byte" symbols
are the merges of highest rank, and a rank is the token's id. Text between spaces
and newlines is encoded once per worker while remembered (``PieceMemo``). Pieces with
a NUL, another white space, ``<|`` (special tokens), characters that composition
changes, a capital sigma or a dotted capital i go through the tokenizers library itself.
"""

from __future__ import annotations

import functools
import json
import os
import unicodedata

import regex

from tripmart.llm.pieces import PieceMemo

SPECIAL = "<|"
END = 1
#: The pattern of the vocabulary's file that cuts text into words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
ODD = regex.compile(r"[\s\x00]")


def vocabulary_path(name: str = "word_bpe_49k.json", folder: str | None = None) -> str:
    if folder is None:
        import public_tokenizers

        return public_tokenizers.path(name)
    return os.path.join(folder, name)


@functools.cache
def library(path: str):
    """The tokenizers library's encoder without truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@functools.cache
def parts(path: str) -> tuple[list[str], list[bytes], dict[str, int]]:
    """(token string by id, bytes by id with 0x00 for the word's end, letters of the byte alphabet)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab = spec["model"]["vocab"]
    strings = [""] * (1 + max([*vocab.values(), *(a["id"] for a in spec["added_tokens"])]))
    for token, i in vocab.items():
        strings[i] = token
    # the byte alphabet: printable Latin-1 stands for itself, the others for letters from U+0100 on
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    letters = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}
    merged = {a + b for a, b in (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])}
    raw = [b""] * len(strings)
    for i, token in enumerate(strings):
        core = token.removesuffix("</w>")
        if token and (token in merged or len(core) == 1):
            raw[i] = bytes(letters[c] for c in core) + b"\x00" * (token != core)
    for a in spec["added_tokens"]:
        strings[a["id"]] = a["content"]
    return strings, raw, letters


@functools.cache
def _merger(path: str):
    import tiktoken

    ranks = {b: i for i, b in enumerate(parts(path)[1]) if b}
    return tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


def learner(path: str):
    """Ids of pieces without spaces or newlines."""
    merge = _merger(path)

    def ids(piece: str) -> list[int]:
        if piece.isalpha():
            words = (piece,)
        elif piece[-1] in ".,;:!?" and piece[:-1].isalpha():
            words = (piece[:-1], piece[-1])
        elif SPECIAL in piece or ODD.search(piece):
            words = None
        else:
            words = WORDS.findall(piece.lower())
        if words is None or "Σ" in piece or "İ" in piece or not unicodedata.is_normalized("NFC", piece):
            return library(path).encode(piece, add_special_tokens=False).ids
        if len(words) == 1:
            return merge(words[0].lower().encode("utf-8", "surrogatepass") + b"\x00")
        return [i for word in words for i in merge(word.lower().encode("utf-8", "surrogatepass") + b"\x00")]

    marks = {c: merge(c.encode() + b"\x00") for c in ".,;:!?"}

    def plain(piece: str) -> list[int]:
        """The same, with a short way for ASCII letters, alone or before one mark."""
        if piece.isascii():
            if piece.isalpha():
                return merge(piece.lower().encode() + b"\x00")
            if piece[-1] in marks and piece[:-1].isalpha():
                return merge(piece[:-1].lower().encode() + b"\x00") + marks[piece[-1]]
        return ids(piece)

    return lambda pieces: [plain(p) for p in pieces]


_held: dict[str, PieceMemo] = {}


def word_ids(path: str) -> PieceMemo:
    """This worker's encoder (its memory serves all tasks of the worker): ``lookup(texts)`` gives
    all ids and where each text's begin."""
    if path not in _held:
        _held[path] = PieceMemo(learner(path), "<u2")
    return _held[path]
