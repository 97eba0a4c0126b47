"""Vectorised word and shingle hashes (64 bits, equal in every process)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_RANDOM = np.random.Generator(np.random.PCG64(20240131))
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_BYTE[_WHITE] = 0
_STEP = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """At least n powers of the odd step, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            grown = np.full(max(n, 2 * len(_powers)), _STEP)
            grown[0] = 1
            _powers = np.cumprod(grown, dtype=np.uint64)
    return _powers


def mix(z: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection."""
    with np.errstate(over="ignore"):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def lower_bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower() if text else b""


def word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """The hashes of each text's words."""
    if not texts:
        return []
    raw = b"\n".join(texts) + b"\n"
    b = np.frombuffer(raw, np.uint8)
    white = _WHITE[b]
    starts = np.flatnonzero(~white & np.concatenate([[True], white[:-1]]))
    if not len(starts):
        return [np.empty(0, np.uint64) for _ in texts]
    within = np.arange(len(b)) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(b)]])))
    with np.errstate(over="ignore"):
        h = mix(np.add.reduceat(_BYTE[b] * powers(int(within.max()) + 1)[within], starts))
    ends = np.cumsum([len(t) + 1 for t in texts])
    cuts = np.searchsorted(starts, ends)
    return [h[a:z] for a, z in zip(np.concatenate([[0], cuts[:-1]]), cuts, strict=True)]


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of size words; of all words together where there are fewer."""
    if not len(words):
        return np.empty(0, np.uint64)
    size = min(size, len(words))
    with np.errstate(over="ignore"):
        h = np.full(len(words) - size + 1, np.uint64(size))
        for k in range(size):
            h = h * np.uint64(0xD6E8FEB86659FD93) + words[k : len(words) - size + 1 + k]
    return np.unique(mix(h))


def in_runs(texts: list[bytes], size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Runs of texts of about size bytes, in order, so that hashing holds little memory."""
    run: list[bytes] = []
    held = 0
    for t in texts:
        run.append(t)
        held += len(t)
        if held >= size:
            yield run
            run, held = [], 0
    if run:
        yield run


def each_shingles(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    for run in in_runs([lower_bytes(t) for t in texts]):
        for words in word_hashes(run):
            yield shingles(words, size)
