"""Vectorised 64-bit hashes of words, word sequences and byte strings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from archivesearch.llm.common import forget_kept

U = np.uint64
ODD = U(0x9E3779B97F4A7C15)
BASE = 0xD1342543DE82EF95  # an odd 64-bit base of the polynomial
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijective scramble of 64-bit integers."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, b in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, b, dtype=U)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=U)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def hashed_spans(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the ASCII-white-space-separated words of all texts: hashes, first and last place (exclusive) in the joined bytes,
    those bytes, and the number of each text's words."""
    bodies = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b" ".join([b"", *bodies, b""]), dtype=np.uint8)
    if lower:
        raw = np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)
    gap = (raw == 32) | ((raw >= 9) & (raw <= 13))
    turns = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    starts, ends = turns[0::2], turns[1::2]
    up, down = _powers(len(raw))
    total = np.zeros(len(raw) + 1, dtype=U)
    np.cumsum((raw.astype(U) + U(1)) * up, out=total[1:])
    words = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U) * ODD)
    edges = np.cumsum([1, *(len(b) + 1 for b in bodies)])
    return words, starts, ends, raw, np.diff(np.searchsorted(starts, edges))


def hashed_words(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ASCII-white-space-separated words of all texts, and the number of each text's words."""
    words, _, _, _, counts = hashed_spans(texts, lower)
    return words, counts


def sequences(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words."""
    h = np.full(max(0, len(words) - k + 1), k, dtype=U)
    for j in range(k):
        h = (h + words[j:j + len(h)]) * (ODD + U(2 * j + 2))
        h ^= h >> U(29)
    return mix(h)


def shingle_sets(texts: list[str], k: int, chunk: int = 1 << 18) -> Iterator[np.ndarray]:
    """The sorted distinct ``k``-word shingles of each text; the whole sequence of a text with fewer words.

    Texts are hashed in parts of about ``chunk`` characters; the arrays of a part take about 40 times as many bytes."""
    forget_kept()
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) < chunk):
            size += len(texts[to])
            to += 1
        words, counts = hashed_words(texts[at:to])
        all_k = sequences(words, k)
        start = 0
        for n in counts.tolist():
            if n >= k:
                yield np.unique(all_k[start:start + n - k + 1])
            elif n:
                yield sequences(words[start:start + n], n)
            else:
                yield np.empty(0, U)
            start += n
        at = to
