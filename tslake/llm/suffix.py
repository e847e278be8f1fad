"""Suffix arrays with common prefixes by external induced sorting.

Suffixes that begin a valley (the left-most S-type ones) are sorted first: the pieces of text between them are named in
order, and the string of names is sorted by the same procedure, recursively. Two scans then induce the order of all
suffixes. Each takes tuples (leading character, position, prefix shared with the tuple before) in order from a priority
queue and pushes those of the suffixes one place to the left, whose common prefix is one more than the least that lies
between their sources. The queues' priorities never go back, so a queue is a list of bins of characters, each a list of
runs; runs beyond a memory bound lie in a file. Text, types, names and orders are arrays that are mapped to files where
they are large, and all steps take them by blocks. Orders and common prefixes need be right only to a bounded depth.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: Bytes of tuples that a queue holds in memory; larger arrays than that are mapped to files.
MEMORY = 64 << 20
_BIG = np.int16(1 << 14)


class Disk:
    """Arrays of one sort, in memory or mapped to files in the task's folder; ``spilled`` counts the bytes in files."""

    def __init__(self, memory: int = MEMORY):
        self.memory, self.block, self.spilled = memory, max(256, min(1 << 15, memory // 512)), 0

    def array(self, n: int, kind) -> np.ndarray:
        if n * np.dtype(kind).itemsize <= self.memory:
            return np.zeros(n, kind)
        self.spilled += n * np.dtype(kind).itemsize
        with tempfile.TemporaryFile() as f:  # the mapping keeps the file, which has no name
            return np.memmap(f, kind, "w+", shape=(n,))

    def blocks(self, n: int) -> Iterator[tuple[int, int]]:
        for lo in range(0, n, self.block):
            yield lo, min(n, lo + self.block)


class Queue:
    """A monotone priority queue of (key, position, common prefix); equal keys leave in the order in which they came.

    ``counts`` tells how many tuples each key gets in all; a bin holds keys of a bounded number of tuples together, or
    one frequent key, which is read run by run.
    """

    def __init__(self, counts: np.ndarray, disk: Disk):
        self.disk, self.file, self.end, self.held = disk, None, 0, 0
        before = np.cumsum(counts) - counts
        most = max(64, disk.block // 16)
        frequent = counts >= most
        new = np.ones(len(counts), bool)
        new[1:] = (before[1:] // most != before[:-1] // most) | frequent[1:] | frequent[:-1]
        self.bin = (np.cumsum(new) - 1).astype(np.int32)
        self.single = np.bincount(self.bin) == 1
        self.runs: list[list] = [[] for _ in range(len(self.single))]
        self.at = 0
        self.keys, self.values = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def push(self, keys: np.ndarray, positions: np.ndarray, common: np.ndarray) -> None:
        """Adds tuples whose keys are in order."""
        if not len(keys):
            return
        values, keys = (positions << 16) | common, keys.astype(np.int32)
        bins = self.bin[keys]
        edge = ((bins[1:] != bins[:-1]).nonzero()[0] + 1).tolist()
        runs, lo = self.runs, 0
        for b, hi in zip(bins[[0, *edge]].tolist(), [*edge, len(keys)]):
            runs[b].append((keys[lo:hi], values[lo:hi]))
            lo = hi
        self.held += 12 * len(keys)
        if self.held > self.disk.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(self.end)
        for b, runs in enumerate(self.runs):
            held = [r for r in runs if isinstance(r[0], np.ndarray)]
            if held:  # the last ones: what is on disk came before
                keys, values = (np.concatenate([r[k] for r in held]) for k in (0, 1))
                self.file.write(keys.tobytes() + values.tobytes())
                self.runs[b] = [*runs[: len(runs) - len(held)], (self.end, len(keys))]
                self.end += 12 * len(keys)
        self.disk.spilled += self.held
        self.held = 0

    def _load(self, run: tuple) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(run[0], np.ndarray):
            self.held -= 12 * len(run[0])
            return run
        self.file.seek(run[0])
        return np.frombuffer(self.file.read(4 * run[1]), np.int32), np.frombuffer(self.file.read(8 * run[1]), np.int64)

    def look(self, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """The next tuples in order, at least one and at most ``most``, or None at the end; ``drop`` removes them."""
        while self.at < len(self.runs) and not len(self.keys) and not self.runs[self.at]:
            self.at += 1
        if self.at == len(self.runs):
            return None
        waiting = self.runs[self.at]
        if waiting and not (self.single[self.at] and len(self.keys)):
            if self.single[self.at]:
                size, k = 0, 0
                while k < len(waiting) and size < self.disk.block:
                    size += len(waiting[k][0]) if isinstance(waiting[k][0], np.ndarray) else waiting[k][1]
                    k += 1
                taken, self.runs[self.at] = waiting[:k], waiting[k:]
            else:
                taken, self.runs[self.at] = waiting, []
            keys, values = zip(*map(self._load, taken))
            if len(self.keys) or len(keys) > 1:
                self.keys, self.values = np.concatenate([self.keys, *keys]), np.concatenate([self.values, *values])
            else:
                self.keys, self.values = keys[0], values[0]
            if not self.single[self.at]:
                order = self.keys.argsort(kind="stable")
                self.keys, self.values = self.keys[order], self.values[order]
        some = self.values[:most]
        return self.keys[:most], some >> 16, (some & 0xFFFF).astype(np.int16)

    def ends_key(self, n: int) -> bool:
        """Whether the ``n``-th of the next tuples is the last that now waits under its key."""
        return self.keys[n] != self.keys[n - 1] if n < len(self.keys) else not self.runs[self.at]

    def drop(self, n: int) -> None:
        self.keys, self.values = self.keys[n:], self.values[n:]

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Between:
    """For each character, the least common prefix since the last tuple that was pushed under it."""

    def __init__(self, characters: int, disk: Disk):
        self.last, self.tail = disk.array(characters, np.int32), disk.array(characters, np.int16)
        self.time, self.times, self.least = 1, [], []  # later batches' minima, in rising order

    def push(self, common: np.ndarray, source: np.ndarray, target: np.ndarray, depth: int) -> np.ndarray:
        """Common prefixes of tuples induced by the batch's ``source`` places under ``target`` (sorted), from those of the batch."""
        n, m = len(common), len(source)
        if not m:
            return self._past(common, source)
        first = np.ones(m, bool)
        np.not_equal(target[1:], target[:-1], out=first[1:])
        begin = first.nonzero()[0]
        c, at = target[begin], source[begin]
        last, start = self.last[c], np.minimum.accumulate(common)[at]
        own = np.minimum(np.minimum(self.tail[c], np.array([*self.least, _BIG], np.int16)[np.searchsorted(self.times, last, side="right")]), start)
        out = np.empty(m, np.int64)
        out[begin] = np.where(last > 0, own + np.int64(1), 0)
        if len(begin) < m:
            more = (~first).nonzero()[0]
            out[more] = least_between(common, source[more - 1] + 1, source[more] + 1) + np.int64(1)
        end = np.empty(len(begin), np.int64)
        end[:-1], end[-1] = source[begin[1:] - 1], source[-1]
        behind = np.empty(n + 1, np.int16)
        behind[n] = _BIG
        behind[:n] = np.minimum.accumulate(common[::-1])[::-1]
        self.last[c], self.tail[c] = self.time, behind[end + 1]
        return self._past(common, np.minimum(out, depth))

    def _past(self, common: np.ndarray, out: np.ndarray) -> np.ndarray:
        low = int(common.min())
        while self.least and self.least[-1] >= low:
            self.times.pop()
            self.least.pop()
        self.times.append(self.time)
        self.least.append(low)
        self.time += 1
        return out


def least_between(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least of ``x[lo:hi]`` for each pair."""
    level = np.frexp(hi - lo)[1] - 1
    deepest = int(level.max())
    if not deepest:
        return x[lo]
    out, row, width = np.empty(len(lo), x.dtype), x, 1
    for k in range(deepest + 1):
        own = (level == k).nonzero()[0]
        out[own] = np.minimum(row[lo[own]], row[hi[own] - width])
        if k < deepest:
            row, width = np.minimum(row[:-width], row[width:]), 2 * width
    return out


def types(text: np.ndarray, disk: Disk) -> np.ndarray:
    """Whether each suffix is of S-type: smaller than the one after it. The last is."""
    n = len(text)
    out = disk.array(n, bool)
    out[n - 1] = True
    following = True
    for lo in range((n - 2) // disk.block * disk.block, -1, -disk.block) if n > 1 else ():
        hi = min(n - 1, lo + disk.block)
        d = np.diff(text[lo : hi + 1].astype(np.int32))
        place = np.where(d != 0, np.arange(len(d)), len(d))  # the next place where neighbours differ
        place = np.minimum.accumulate(place[::-1])[::-1]
        out[lo:hi] = np.append(d > 0, following)[place]
        following = out[lo]
    return out


def shared(text: np.ndarray, p: np.ndarray, q: np.ndarray, known: np.ndarray, depth: int) -> np.ndarray:
    """Common prefixes, up to ``depth``, of the suffixes at ``p`` and ``q`` that share ``known`` characters at least."""
    out, todo, step = known.copy(), np.flatnonzero(known < depth), np.arange(8)
    while len(todo):
        a = np.minimum((p[todo] + out[todo])[:, None] + step, len(text) - 1)
        b = np.minimum((q[todo] + out[todo])[:, None] + step, len(text) - 1)
        differ = text[a] != text[b]
        more = np.where(differ.any(axis=1), differ.argmax(axis=1), 8)
        out[todo] += more
        todo = todo[(more == 8) & (out[todo] < depth)]
    return np.minimum(out, depth)


def repeats(text: np.ndarray, p: np.ndarray, depth: int) -> np.ndarray:
    """How often the character at each place is repeated from there on, up to ``depth``."""
    out, todo = np.ones(len(p), np.int64), np.arange(len(p))
    while len(todo):
        todo = todo[(out[todo] < depth) & (p[todo] + out[todo] < len(text))]
        todo = todo[text[p[todo] + out[todo]] == text[p[todo]]]
        out[todo] += 1
    return out


def run_up(text: np.ndarray, positions: np.ndarray, common: np.ndarray, depth: int, most: int) -> tuple[np.ndarray, np.ndarray] | None:
    """What suffixes of one character, all that others induce, induce under the same character in turn: (positions, common prefixes) in order.

    First those one place to the left of each, then those two places to the left, and so on, as far as the character is
    repeated there. None if they are more than ``most``.
    """
    left, todo, step = np.zeros(len(positions), np.int64), np.arange(len(positions)), np.arange(1, 17)
    c = text[positions[0]]
    while len(todo):
        at = (positions[todo] - left[todo])[:, None] - step
        other = (text[np.maximum(at, 0)] != c) | (at < 0)
        more = np.where(other.any(axis=1), other.argmax(axis=1), 16)
        left[todo] += more
        todo = todo[more == 16]
        if left.sum() > most:
            return None
    owner = np.repeat(np.arange(len(positions)), left)
    place = np.arange(1, len(owner) + 1) - np.repeat(np.cumsum(left) - left, left)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    out = place.copy()  # the first of a round and the last of the round before share that many of the character
    same = np.flatnonzero(place[1:] == place[:-1]) + 1
    if len(same):
        out[same] += least_between(common, owner[same - 1] + 1, owner[same] + 1)
    return positions[owner] - place, np.minimum(out, depth).astype(np.int16)


class Pieces:
    """The pieces of text from each left-most S-type place to the next, both included; of equal characters the L-type is smaller."""

    def __init__(self, text: np.ndarray, s: np.ndarray, at: np.ndarray, disk: Disk):
        self.text, self.s, self.at, self.disk = text, s, at, disk
        self.bits = max(2, int(2 * int(text.max()) + 3).bit_length())
        self.step = max(1, 62 // self.bits)

    def keys(self, k: np.ndarray, offset: int) -> tuple[np.ndarray, np.ndarray]:
        """The next characters of pieces ``k`` from ``offset`` on as one number, 0 beyond the end; whether a piece ends there."""
        begin, n = self.at[k], len(self.text)
        after = np.where(k + 1 < len(self.at), self.at[np.minimum(k + 1, len(self.at) - 1)], n - 1)
        length = after - begin + 1
        key = np.zeros(len(k), np.int64)
        for j in range(offset, offset + self.step):
            place = np.minimum(begin + j, n - 1)
            key = (key << self.bits) | np.where(j < length, 2 * self.text[place].astype(np.int64) + 1 + self.s[place], 0)
        return key, length <= offset + self.step

    def sorted(self, k: np.ndarray, offset: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(pieces in order, whether each differs from the one before it): parts beyond memory are dealt by key into files first."""
        if len(k) <= 4 * self.disk.block:
            yield self._sorted_in_memory(np.array(k), offset)
            return
        sample = np.sort(self.keys(np.array(k[:: max(1, len(k) // 1024)]), offset)[0])
        marks = np.unique(sample[:: max(1, len(sample) // 64)])
        parts = Queue(np.full(2 * len(marks) + 1, self.disk.block), self.disk)
        size, ended = np.zeros(2 * len(marks) + 1, np.int64), np.zeros(2 * len(marks) + 1, bool)
        for lo, hi in self.disk.blocks(len(k)):
            own = np.array(k[lo:hi])
            key, end = self.keys(own, offset)
            part = np.searchsorted(marks, key) + np.searchsorted(marks, key, side="right")
            order = np.argsort(part, kind="stable")
            parts.push(part[order], own[order], np.zeros(len(own), np.int64))
            size += np.bincount(part, minlength=len(size))
            ended[part[end]] = True
        for p in np.flatnonzero(size).tolist():
            own, n = self.disk.array(int(size[p]), np.int64), 0
            while n < size[p]:
                _, some, _ = parts.look(min(self.disk.block, int(size[p]) - n))
                own[n : n + len(some)] = some
                parts.drop(len(some))
                n += len(some)
            if p % 2 and ended[p]:  # all of one key, which holds the whole piece
                for lo, hi in self.disk.blocks(len(own)):
                    new = np.zeros(hi - lo, bool)
                    new[0] = lo == 0
                    yield np.array(own[lo:hi]), new
            else:
                yield from self.sorted(own, offset + self.step if p % 2 else offset)
        parts.close()

    def _sorted_in_memory(self, k: np.ndarray, offset: int) -> tuple[np.ndarray, np.ndarray]:
        group = np.zeros(len(k), np.int64)  # place of the first piece that is equal so far
        todo = np.arange(len(k))
        while len(todo):
            key, end = self.keys(k[todo], offset)
            order = np.lexsort((key, group[todo]))
            k[todo], key, end, g = k[todo[order]], key[order], end[order], group[todo][order]
            new = np.concatenate([[True], (g[1:] != g[:-1]) | (key[1:] != key[:-1])])
            begin = np.flatnonzero(new)
            group[todo] = todo[np.repeat(begin, np.diff(np.append(begin, len(todo))))]
            alone = np.repeat(np.diff(np.append(begin, len(todo))) == 1, np.diff(np.append(begin, len(todo))))
            todo, offset = todo[~alone & ~end], offset + self.step
        return k, group == np.arange(len(k))


def _scan(text: np.ndarray, s: np.ndarray, given: Iterator, counts: tuple[np.ndarray, np.ndarray], s_type: bool, depth: int, disk: Disk) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Induces the suffixes of one type from ``given`` ones (positions in the scan's order, common prefixes with the one before).

    Yields (positions, common prefix with the one before, whether given) of all, in the scan's order: ascending for
    L-types, descending for S-types. Of one character, induced suffixes come before given ones.
    """
    sigma = len(counts[0])
    rank = lambda c: sigma - 1 - c if s_type else c
    both = np.zeros(2 * sigma, np.int64)
    both[2 * rank(np.arange(sigma))], both[2 * rank(np.arange(sigma)) + 1] = counts
    queue, between = Queue(both, disk), Between(sigma, disk)
    for positions, common in given:
        queue.push(2 * rank(text[positions].astype(np.int64)) + 1, positions, common.astype(np.int64))
    last_key, last_position, most = -2, 0, disk.block
    while (batch := queue.look(most)) is not None:
        keys, positions, common = batch
        before = positions - 1  # of the first suffix that is the last one's place, which is no source for what follows
        fit = ((s[before] == s_type) & (positions > 0)).nonzero()[0]
        target = text[before[fit]].astype(np.int64)
        target = 2 * (sigma - 1 - target) if s_type else 2 * target
        low = np.full(len(keys) + 1, 2 * sigma)
        low[fit + 1] = target
        n = int((keys <= np.minimum.accumulate(low)[:-1]).sum())  # those that no tuple to come precedes: the first ones
        whole = queue.ends_key(n)
        queue.drop(n)
        most = min(disk.block, max(256, 2 * n))  # about as many as can be taken at once
        if n < len(keys):
            keys, positions, common = keys[:n], positions[:n], common[:n]
            fit = fit[: fit.searchsorted(n)]
            target = target[: len(fit)]
        given = (keys & 1).astype(bool)
        if given.any():
            edge = given.copy()
            edge[1:] &= keys[:-1] == keys[1:] - 1
            edge[0] &= last_key == keys[0] - 1
            edge = edge.nonzero()[0]
            if len(edge):  # a given suffix after an induced one of the same character: they share the repeats of that character
                previous = np.where(edge > 0, positions[edge - 1], last_position)
                common[edge] = np.minimum(repeats(text, positions[edge], depth), repeats(text, previous, depth))
        own = (target == keys[-1]).nonzero()[0]
        if whole and len(own) and keys[fit[own[0]]] == keys[-1]:  # all tuples under this character are here
            begin = int(keys.searchsorted(keys[-1]))
            tail = positions[begin:]
            more = None if (text[tail + 1] == text[tail]).any() else run_up(text, tail, common[begin:], depth, 4 * disk.block)
            if more is not None:  # its runs, at once
                positions, common = np.concatenate([positions, more[0]]), np.concatenate([common, more[1]])
                keys, given = np.concatenate([keys, np.full(len(more[0]), keys[-1], keys.dtype)]), np.concatenate([given, np.zeros(len(more[0]), bool)])
                before = positions - 1
                fit = ((s[before] == s_type) & (positions > 0)).nonzero()[0]
                target = text[before[fit]].astype(np.int64)
                target = 2 * (sigma - 1 - target) if s_type else 2 * target
                other = target != keys[-1]
                fit, target = fit[other], target[other]
        last_key, last_position = int(keys[-1]), int(positions[-1])
        order = target.argsort(kind="stable")
        own, target = fit[order], target[order]
        queue.push(target, positions[own] - 1, between.push(common, own, target >> 1, depth))
        yield positions, common, given
    queue.close()


def _named_order(names: np.ndarray, count: int, depth: int, disk: Disk) -> tuple[np.ndarray, np.ndarray]:
    """``suffix_array`` of a string of names, by recursion on a shorter string.

    No comparison goes beyond a name that occurs once: such names are left out unless a name that recurs comes before them.
    """
    m = len(names)
    uses, again = disk.array(count, np.int64), np.zeros(1, bool)
    for lo, hi in disk.blocks(m):
        np.add.at(uses, names[lo:hi], 1)
    kept, k = disk.array(m, np.int64), 0
    for lo, hi in disk.blocks(m):
        recurs = np.concatenate([again, uses[names[lo:hi]] > 1])
        own = np.flatnonzero(recurs[1:] | recurs[:-1]) + lo
        if hi == m and not (len(own) and own[-1] == m - 1):
            own = np.append(own, m - 1)
        kept[k : k + len(own)], k, again = own, k + len(own), recurs[-1:]
    here = disk.array(count, np.int64)
    for lo, hi in disk.blocks(k):
        np.add.at(here, names[kept[lo:hi]], 1)
    rank, shift, short = disk.array(count, np.int32), disk.array(count, np.int64), disk.array(k, np.int32)
    at = np.zeros(3, np.int64)  # names, and suffixes in all and here, before a block of names
    for lo, hi in disk.blocks(count):
        some = np.array(here[lo:hi])
        rank[lo:hi] = at[0] + np.cumsum(some > 0) - (some > 0)
        shift[lo:hi] = (at[1] + np.cumsum(uses[lo:hi]) - uses[lo:hi]) - (at[2] + np.cumsum(some) - some)
        at += [(some > 0).sum(), uses[lo:hi].sum(), some.sum()]
    for lo, hi in disk.blocks(k):
        short[lo:hi] = rank[names[kept[lo:hi]]]
    found, alike = suffix_array(short, depth, disk)
    order, out, begin = disk.array(m, np.int64), disk.array(m, np.int16), disk.array(count, np.int64)
    total = 0
    for lo, hi in disk.blocks(count):
        begin[lo:hi] = total + np.cumsum(uses[lo:hi]) - uses[lo:hi]
        total += int(uses[lo:hi].sum())
    for lo, hi in disk.blocks(m):
        order[begin[names[lo:hi]]] = np.arange(lo, hi)  # right for names that occur once; the others follow
    for lo, hi in disk.blocks(k):
        own = kept[found[lo:hi]]
        slot = np.arange(lo, hi) + shift[names[own]]
        order[slot], out[slot] = own, alike[lo:hi]
    return order, out


def suffix_array(text: np.ndarray, depth: int, disk: Disk | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(positions of all suffixes in order, prefix that each shares with the one before it), right to the first ``depth`` characters.

    ``text`` holds non-negative integers; its last character is smaller than all others. Suffixes that share ``depth``
    characters are in any order, and their common prefix is ``depth``.
    """
    disk, n, depth = disk or Disk(), len(text), min(depth, 1 << 13)
    out, out_common = disk.array(n, np.int64), disk.array(n + 1, np.int16)
    if n < 2:
        return out, out_common[:n]
    s, sigma = types(text, disk), int(text.max()) + 1
    counts = {kind: np.zeros(sigma, np.int64) for kind in ("L", "S", "valley")}
    for lo, hi in disk.blocks(n):
        x, own = text[lo:hi], s[lo:hi]
        valley = own & ~s[lo - 1 : hi - 1] if lo else own & ~np.concatenate([[True], own[:-1]])
        for kind, which in (("L", ~own), ("S", own), ("valley", valley)):
            counts[kind] += np.bincount(x[which], minlength=sigma)
    m = int(counts["valley"].sum())
    at, k = disk.array(m, np.int64), 0
    for lo, hi in disk.blocks(n):
        own = np.flatnonzero(s[lo:hi] & ~(s[lo - 1 : hi - 1] if lo else np.concatenate([[True], s[: hi - 1]]))) + lo
        at[k : k + len(own)] = own
        k += len(own)
    names, order, count, k = disk.array(m, np.int32), disk.array(m, np.int64), -1, 0
    every = disk.array(m, np.int64)
    for lo, hi in disk.blocks(m):
        every[lo:hi] = np.arange(lo, hi)
    for own, new in Pieces(text, s, at, disk).sorted(every):
        order[k : k + len(own)], k = own, k + len(own)
        rank = count + np.cumsum(new)
        names[own], count = rank, int(rank[-1])
    del every
    half = -(-depth // 2)  # a piece has two characters at least that the next doesn't
    alike = np.zeros(0, np.int16)
    if count + 1 < m:
        order, alike = _named_order(names, count + 1, half, disk)

    def valleys() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        last = 0
        for lo, hi in disk.blocks(m):
            own = np.array(order[lo:hi])
            pieces = np.array(alike[lo:hi], np.int64) if len(alike) else np.zeros(hi - lo, np.int64)
            known = np.where(pieces >= half, depth, np.minimum(depth, at[np.minimum(own + pieces, m - 1)] - at[own]))
            p, previous = at[own], np.concatenate([[last], at[own[:-1]]])
            common = shared(text, p, previous, known, depth)
            if lo == 0:
                common[0] = 0
            last = p[-1]
            yield p, common

    larger, larger_common, k = disk.array(int(counts["L"].sum()), np.int64), disk.array(int(counts["L"].sum()) + 1, np.int16), 0
    for positions, common, given in _scan(text, s, valleys(), (counts["L"], counts["valley"]), False, depth, disk):
        own = ~given
        size = int(own.sum())
        larger[k : k + size], larger_common[k : k + size] = positions[own], common[own]
        k += size

    def descending() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for lo, hi in disk.blocks(k):
            yield np.array(larger[k - hi : k - lo][::-1]), np.array(larger_common[k - hi + 1 : k - lo + 1][::-1])

    end = n
    for positions, common, _ in _scan(text, s, descending(), (counts["S"], counts["L"]), True, depth, disk):
        size = len(positions)
        out[end - size : end], out_common[end - size + 1 : end + 1] = positions[::-1], common[::-1]
        end -= size
    assert end == 1, "the last suffix, which nothing induces, is the least"
    out[0], out_common[:2] = n - 1, 0
    return out, out_common[:n]
