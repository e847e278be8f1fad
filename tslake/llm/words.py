"""Words of many texts at once: their places and hashes, and hashes of runs of words, with numpy.

Word bytes are given as a table of 256 booleans, which is enough for patterns that treat all bytes of a multi-byte
character alike. A hash has one or two lanes of 64 bits with their own constants. It takes a word's eight bytes at a
time and mixes after each step by shifts and products, as joins of runs do: sums of powers modulo 2**64, which collide
on regular strings whatever their base, are used where nothing depends on equality alone (``powers``).
"""

from __future__ import annotations

import hashlib

import numpy as np

U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240501))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BASES = (_RNG.integers(1, 2**62, 3, dtype=np.uint64) * U(8) + U(5)).tolist()
#: Keys of two lanes, four odd numbers each; masks of the first 0 to 8 bytes.
_KEYS = _RNG.integers(1, 2**63, (2, 4), dtype=np.uint64) * U(2) + U(1)
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Bytes beyond which a word is hashed by itself.
LONG_WORD = 512

#: ``[^\\x20\\x09-\\x0D]+``
BLANK_SEPARATED = np.array([c not in (9, 10, 11, 12, 13, 32) for c in range(256)])
#: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` once A-Z are lower case
ALPHANUMERIC = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the lane's base, and of its inverse modulo 2**64."""
    have = _powers.get(lane)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        base = _BASES[lane]
        out = []
        for r in (base, pow(base, -1, 2**64)):
            a = np.full(size, r, np.uint64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        have = _powers[lane] = tuple(out)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads a 64-bit value over all bits, in place."""
    h ^= h >> U(32)
    h *= U(0xD6E8FEB86659FD93)
    h ^= h >> U(32)
    h *= U(0xD6E8FEB86659FD93)
    h ^= h >> U(32)
    return h


def _step(h: np.ndarray, lane: int) -> np.ndarray:
    """One keyed step of a lane: distinct values stay distinct."""
    h = h * _KEYS[lane, 0]
    h ^= h >> U(32)
    h *= _KEYS[lane, 1]
    h ^= h >> U(29)
    return h


def eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes that begin at each place of ``data``, as one number each; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lanes: int = 2) -> np.ndarray:
    """(lanes x words) hashes of ``data[starts[i]:ends[i]]``, by eight bytes at a time, each step mixed."""
    size = ends - starts
    h = np.empty((lanes, len(starts)), np.uint64)
    if not lanes:
        return h
    at, todo, own = starts, np.arange(len(starts)), eight(data)
    for lane in range(lanes):
        h[lane] = size.astype(np.uint64) * _KEYS[lane, 2] + _KEYS[lane, 3]
    long = size > LONG_WORD
    if long.any():
        for i in np.flatnonzero(long).tolist():
            h[:, i] = np.frombuffer(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=16).digest(), np.uint64)[:lanes]
        todo = np.flatnonzero(~long)
    done = 0
    while len(todo):
        left = size[todo] - done
        x = own[at[todo] + done] & _MASKS[np.minimum(left, 8)]
        for lane in range(lanes):
            h[lane, todo] = _step(h[lane, todo] ^ x, lane)
        todo, done = todo[left > 8], done + 8
    return h


def words(data: np.ndarray, off: np.ndarray, kind: np.ndarray, fold: np.ndarray | None = None, lanes: int = 2):
    """(starts, ends, count per text, lanes x hashes) of the words of texts ``data[off[i]:off[i+1]]``; places are in ``data``."""
    base, last = int(off[0]), int(off[-1])
    fresh = np.zeros(last - base + 1, bool)  # a text begins here
    fresh[off - base] = True
    own = data[base:last]
    w = kind[own]
    before = np.empty(len(w) + 1, bool)
    before[0] = False
    before[1:] = w
    after = np.append(w, False)
    starts = np.flatnonzero(after & (~before | fresh))
    ends = np.flatnonzero(before & (~after | fresh))
    counts = np.diff(np.searchsorted(starts, off - base))
    return starts + base, ends + base, counts, spelled(own if fold is None else fold[own], starts, ends, lanes)


def runs(hashes: np.ndarray, n: int, lane: int = 0) -> np.ndarray:
    """Hashes of all ``n`` consecutive word hashes, wherever they begin (boundaries of texts aren't looked at).

    Runs are put together from runs of powers of two, and each join is mixed.
    """
    m = len(hashes)
    if m < n:
        return np.zeros(0, np.uint64)
    level, size, out, taken = hashes, 1, None, 0
    while True:
        if n & size:
            most = m - taken - size + 1
            out = level if out is None else _step(out[:most] * _KEYS[lane, 2] + level[taken : taken + most], lane)
            taken += size
        if 2 * size > n:
            return out[: m - n + 1]
        level = _step(level[:-size] * _KEYS[lane, 3] + level[size:], lane)
        size *= 2


def sequences(hashes: np.ndarray, counts: np.ndarray, lane: int = 0) -> np.ndarray:
    """A hash of each text's whole sequence of words: a sum of values that depend on word and place."""
    end = np.cumsum(counts)
    place = (np.arange(len(hashes)) - np.repeat(end - counts, counts)).astype(np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_step(hashes + place * _KEYS[lane, 2], lane))])
    return _step(sums[end] - sums[end - counts] + counts.astype(np.uint64) * _KEYS[lane, 3], lane)


def inside(counts: np.ndarray, n: int) -> np.ndarray:
    """Whether a run of ``n`` words beginning at each word ends in the same text, for each possible beginning."""
    total = int(counts.sum())
    if total < n:
        return np.zeros(0, bool)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(total)
    return left[: total - n + 1] >= n


def cover(begins: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of ``total`` places lie in a run of ``n`` that starts at one of ``begins``."""
    step = np.bincount(begins, minlength=total + 1)[: total + 1] - np.bincount(np.minimum(begins + n, total), minlength=total + 1)
    return np.cumsum(step[:total]) > 0


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words at ``starts`` and ``ends``, joined by one space."""
    raw = memoryview(data)
    return b" ".join([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())])


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
