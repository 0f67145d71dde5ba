"""Word and shingle hashes of many texts at once, with numpy inside tasks.

Words are runs of anything but space and \\t..\\r in the lower-cased text.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
#: Bytes of a run are hashed by two polynomials modulo a prime: modulo 2^64 texts built on a doubling pattern always collide.
_PRIME = 2**31 - 1
_BASES = 1_610_612_741, 805_306_457
#: Products of a byte and a power are below 2^39, so as many add up in 64 bits without a remainder in between.
_PLAIN_BYTES = 1 << 24
#: Bytes hashed at once (a longer run alone): a worker keeps tables of as many powers, and what is made of a block stays in the processor's cache.
_BLOCK = 1 << 16
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: list[np.ndarray] = []
_prime_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _powers_of(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n - 1) modulo the prime, doubled in length at a time."""
    out = np.ones(n, dtype=_U)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = out[:more] * _U(pow(base, done, _PRIME)) % _U(_PRIME)
        done += more
    return out


def _prime_tables(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each base, at least n powers of it and of its inverse modulo the prime."""
    if not _prime_powers or len(_prime_powers[0][0]) < n:
        size = max(_BLOCK, n)
        _prime_powers[:] = [(_powers_of(b, size), _powers_of(pow(b, -1, _PRIME), size)) for b in _BASES]
    return _prime_powers


def _tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least n of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(_BLOCK, 1 << (n - 1).bit_length())
        _powers[:] = [np.cumprod(np.concatenate([np.ones(1, _U), np.full(size - 1, b, dtype=_U)]), dtype=_U)
                      for b in (_BASE, _INVERSE)]
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def joined(texts: list[str], after: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of the texts, each with the byte ``after`` behind it; first byte of each text, the total at the end)."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    return np.frombuffer(after.join([*data, b""]), dtype=np.uint8), np.cumsum([0, *(len(d) + 1 for d in data)])


def hash_runs(raw: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of every run of bytes outside the table ``cut``; ``raw`` ends with a byte inside it."""
    if not len(raw):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, _U)
    outside = cut[raw]
    edge = np.flatnonzero(outside[1:] != outside[:-1]) + 1
    if not outside[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    found = np.zeros(len(starts), dtype=_U)
    lo = 0
    while lo < len(starts):
        base = starts[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, base + _BLOCK, side="right")))
        first, last = starts[lo:hi] - base, ends[lo:hi] - base
        value = raw[base:ends[hi - 1]].astype(_U) + _U(1)
        total = np.zeros(len(value) + 1, dtype=_U)
        for power, inverse in _prime_tables(len(value)):
            term = value * power[: len(value)]
            if len(value) > _PLAIN_BYTES:
                term %= _U(_PRIME)
            np.cumsum(term, out=total[1:])
            part = (total[last] - total[first]) % _U(_PRIME) * inverse[first] % _U(_PRIME)
            found[lo:hi] = (found[lo:hi] << _U(32)) | part
        lo = hi
    return starts, ends, mix(found)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text with the total at the end)."""
    raw, first = joined([t.lower() for t in texts])
    starts, _, words = hash_runs(raw, _SPACE)
    return words, np.searchsorted(starts, first)


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every k-word shingle in order, first shingle of each text with the total at the end).

    A text of 1 to k-1 words has one shingle, all of it; one without words has none.
    """
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    at = np.concatenate([[0], np.cumsum(count)])
    if not at[-1]:
        return np.empty(0, _U), at
    pos = np.arange(at[-1]) + np.repeat(first[:-1] - at[:-1], count)
    padded = np.concatenate([words, np.zeros(k, _U)])
    h = np.zeros(at[-1], dtype=_U)
    for j in range(k):
        h = h * _U(0xD6E8FEB86659FD93) + padded[pos + j]
    for i in np.flatnonzero((n > 0) & (n < k)):
        short = 0
        for w in words[first[i]:first[i + 1]].tolist():
            short = (short * 0xD6E8FEB86659FD93 + w + 1) % 2**64
        h[at[i]] = short
    return mix(h), at


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each word on that has as many behind it, whatever texts they are of."""
    if len(words) < k:
        return np.empty(0, _U)
    power, inverse = _tables(len(words) + 1)
    total = np.zeros(len(words) + 1, dtype=_U)
    np.cumsum(words * power[: len(words)], out=total[1:])
    return mix((total[k:] - total[:-k]) * inverse[: len(words) - k + 1])
