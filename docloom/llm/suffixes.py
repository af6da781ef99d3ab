"""Hash-compared suffix sort: prefix polynomial hashes, common extensions by binary search, mergesort (numpy)."""

from __future__ import annotations

import numpy as np

from .bytetext import power_of, prefix_hash


class Suffixes:
    """A byte text with prefix hashes; compares spans of it in a logarithmic number of hash comparisons."""

    def __init__(self, text: np.ndarray):
        self.text = text
        self.prefix = prefix_hash(text)

    def equal(self, a, b, length) -> np.ndarray:
        """Do the hashes of text[a:a+length] and text[b:b+length] agree?"""
        return self.prefix[a + length] - self.prefix[b + length] == (self.prefix[a] - self.prefix[b]) * power_of(length)

    def extension(self, a, b, most, common: int = 0) -> np.ndarray:
        """Length of the longest common extension from a and b, at most ``most``; the first ``common`` bytes are known to agree."""
        out = most.astype(np.int64).copy()
        rest = np.flatnonzero(~self.equal(a, b, out))
        a, b = a[rest], b[rest]
        low, high = np.minimum(common, out[rest]), np.maximum(out[rest] - 1, 0)
        for _ in range(int((high - low).max(initial=0)).bit_length()):
            mid = (low + high + 1) >> 1
            same = self.equal(a, b, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        out[rest] = low
        return out

    def compare(self, a, len_a, b, len_b, common: int = 0) -> np.ndarray:
        """-1, 0, 1 as span a sorts before, with or after span b (a proper prefix comes first)."""
        most = np.minimum(len_a, len_b)
        ext = self.extension(a, b, most, common)
        last = max(0, len(self.text) - 1)
        x, y = self.text[np.minimum(a + ext, last)].astype(np.int16), self.text[np.minimum(b + ext, last)].astype(np.int16)
        return np.where(ext == most, np.sign(len_a - len_b), np.sign(x - y))

    def classes(self, start: np.ndarray, width: int, group: np.ndarray, common: int = 0) -> np.ndarray:
        """A number for each width-byte string, equal for equal ones of one group.

        The strings are put in suffix order; neighbours whose common extension reaches the width are
        equal. Every pair of neighbours is verified byte by byte, both what is common and the first
        byte that differs: if all hold, the order is right. A group where a hash has lied is told
        apart by its bytes.
        """
        n = len(start)
        out = np.empty(n, np.int64)
        if not n:
            return out
        length = np.full(n, width, np.int64)
        order = self.sort(start, length, group, common)
        a, b = start[order[:-1]], start[order[1:]]
        near = group[order[1:]] == group[order[:-1]]
        at = np.flatnonzero(near)
        ext = self.extension(a[at], b[at], length[at], common)
        true = same_bytes(self.text, a[at], b[at], ext)
        short = ext < width
        true[short] &= self.text[(a[at] + ext)[short]] < self.text[(b[at] + ext)[short]]
        new = np.ones(n, bool)
        new[1 + at[~short]] = False
        out[order] = np.cumsum(new) - 1
        for g in np.unique(group[order[at[~true]]]):
            seen: dict[bytes, int] = {}
            for k in np.flatnonzero(group == g):
                out[k] = seen.setdefault(self.text[start[k] : start[k] + width].tobytes(), n + int(k))
        return out

    def sort(self, start: np.ndarray, length: np.ndarray, group: np.ndarray, common: int = 0) -> np.ndarray:
        """The order of spans by (group, content), stable: a bottom-up mergesort of all groups side by side.

        In each pass every span finds its rank in the sibling run by binary search.
        """
        order = np.argsort(group, kind="stable")
        g = group[order]
        n = len(order)
        if not n:
            return order
        edge = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        size = np.diff(np.r_[edge, n])
        width = 1
        live = np.repeat(size, size) > 1
        first, count = np.repeat(edge, size), np.repeat(size, size)
        while width < size.max():
            at = np.flatnonzero(live & (count > width))
            local = at - first[at]
            run = local // width
            own = first[at] + run * width
            other = first[at] + (run ^ 1) * width
            stop = np.minimum(other + width, first[at] + count[at])
            has = other < stop
            at, own, other, stop, run = at[has], own[has], other[has], stop[has], run[has]
            low, high = other.copy(), stop.copy()
            a, la = start[order[at]], length[order[at]]
            right = (run & 1) == 1
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                mid = (low[open_] + high[open_]) >> 1
                c = self.compare(start[order[mid]], length[order[mid]], a[open_], la[open_], common)
                before = (c < 0) | ((c == 0) & right[open_])
                low[open_] = np.where(before, mid + 1, low[open_])
                high[open_] = np.where(before, high[open_], mid)
            place = np.minimum(own, other) + (at - own) + (low - other)
            moved = order.copy()
            moved[place] = order[at]
            order = moved
            width *= 2
        return order


def same_bytes(text: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray, step: int = 1 << 14) -> np.ndarray:
    """Are text[a:a+length] and text[b:b+length] equal byte by byte? Verifies what hashes say."""
    out = np.ones(len(a), bool)
    for i in range(0, len(a), step):
        x, y, n = a[i : i + step], b[i : i + step], length[i : i + step]
        total = int(n.sum())
        if not total:
            continue
        lead = np.cumsum(n) - n
        idx = np.arange(total)
        bad = text[idx + np.repeat(x - lead, n)] != text[idx + np.repeat(y - lead, n)]
        full = n > 0
        out[i : i + step][full] = ~np.logical_or.reduceat(bad, lead[full])
    return out
