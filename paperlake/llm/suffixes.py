"""Suffix arrays by induced sorting, and permuted longest common prefixes, in numpy.

Induced sorting handles a bucket (all suffixes of one first symbol) at a time instead of one suffix at a time: what a
bucket's suffixes induce is grouped by symbol with a stable sort and written at once. A suffix induced into the bucket
at hand joins its next wave.
"""

from __future__ import annotations

import numpy as np

#: Alphabets up to this size, or up to one symbol in SHARE positions, are sorted as they are; symbols of larger ones are
#: written as two digits.
ALPHABET, SHARE = 1024, 32


def doubling(t: np.ndarray) -> np.ndarray:
    """Suffix array of a short string by doubling the sorted prefix; for inputs that don't shrink."""
    n = len(t)
    rank = np.unique(t, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        second = np.full(n, -1, np.int64)
        second[: n - step] = rank[step:]
        key = rank * (n + 1) + second + 1
        sa = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[sa] = np.cumsum(np.concatenate([[False], key[sa][1:] != key[sa][:-1]]))
        rank, step = new, step * 2
        if rank[sa[-1]] == n - 1 or step >= n:
            return sa


def falling(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one (type S)."""
    n = len(t)
    up = np.empty(n, np.int8)
    up[:-1] = np.sign(t[1:] - t[:-1])
    up[-1] = 1
    at = np.where(up != 0, np.arange(n, dtype=np.int32), np.int32(n))
    return up[np.minimum.accumulate(at[::-1])[::-1]] > 0


def induce(t: np.ndarray, small: np.ndarray, seeds: np.ndarray, k: int) -> np.ndarray:
    """All suffixes in order, given the leftmost-smaller ones (seeds) in an order that is right within each bucket."""
    n = len(t)
    counts = np.bincount(t, minlength=k)
    ends = np.cumsum(counts)
    starts = ends - counts
    sa = np.full(n, -1, np.int32)
    first = t[seeds]
    seeds = seeds[np.argsort(first, kind="stable")]
    seeded = np.bincount(first, minlength=k)
    sa[np.repeat(ends - np.cumsum(seeded), seeded) + np.arange(len(seeds))] = seeds
    head, tail = starts.copy(), ends.copy()
    full = np.flatnonzero(counts).tolist()
    # of every suffix, the type and the symbol of the one that starts a symbol earlier
    before = np.zeros(n, np.uint16 if k <= 1 << 16 else np.int32)
    before[1:] = t[:-1]
    is_small, is_large = np.zeros(n, bool), np.zeros(n, bool)
    is_small[1:] = small[:-1]
    is_large[1:] = ~small[:-1]
    steps = np.arange(int(counts.max()) + 1, dtype=np.int32)

    def push(block: np.ndarray, want_small: bool) -> None:
        block = block[(is_small if want_small else is_large)[block]]
        m = len(block)
        if not m:
            return
        c = before[block]
        order = c.argsort(kind="stable")
        c, j = c[order], block[order]
        j -= 1
        cut = (c[1:] != c[:-1]).nonzero()[0]
        at = np.zeros(len(cut) + 1, np.int64)
        at[1:] = cut + 1
        size = np.empty_like(at)
        size[:-1] = at[1:] - at[:-1]
        size[-1] = m - at[-1]
        u = c[at].astype(np.int64)
        if want_small:
            sa[(tail[u] - 1 + at).repeat(size) - steps[:m]] = j
            tail[u] -= size
        else:
            sa[(head[u] - at).repeat(size) + steps[:m]] = j
            head[u] += size

    for c in full:
        i = starts[c]
        while i < head[c]:
            a, i = i, head[c]
            push(sa[a:i], False)
        if seeded[c]:
            push(sa[ends[c] - seeded[c] : ends[c]], False)
    for c in reversed(full[1:]):
        i = ends[c]
        while i > tail[c]:
            b, i = i, tail[c]
            push(sa[i:b][::-1], True)
        push(sa[starts[c] : head[c]][::-1], True)
    return sa


def named(t: np.ndarray, small: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """Of each substring from one leftmost-smaller position to the next, its number among the distinct ones in order.

    Substrings of few symbols are put into one or more numbers and these sorted. Behind its end a substring counts as
    larger than any symbol: there it has a smaller-type suffix, and a longer substring with the same symbols so far a
    larger-type one, which comes first. Longer ones are sorted by inducing.
    """
    n = len(t)
    length = np.ones(len(lms), np.int64)
    length[:-1] = np.diff(lms) + 1
    bits = int(k).bit_length()
    per, longest = 63 // bits, int(length.max())
    if longest <= 4 * per:
        rank = None
        for at in range(0, longest, per):
            key = np.zeros(len(lms), np.int64)
            for j in range(at, at + per):
                key <<= bits
                key |= np.where(j < length, t[np.minimum(lms + j, n - 1)], k)
            live = slice(None) if rank is None else np.flatnonzero(length > at)
            values, own = np.unique(key[live], return_inverse=True)
            if rank is None:
                rank = own
            else:  # shorter ones have no like among the longer
                more = np.full(len(lms), len(values), np.int64)
                more[live] = own
                rank = np.unique(rank * (len(values) + 1) + more, return_inverse=True)[1]
        return rank
    sorted_once = induce(t, small, lms, k)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = sorted_once[is_lms[sorted_once]]
    # name the substrings from one leftmost-smaller position to the next; equal ones share a name
    size = np.zeros(n, np.int64)
    size[lms] = length
    a, b = order[:-1], order[1:]
    same = size[a] == size[b]
    live = np.flatnonzero(same)
    offset = 0
    while len(live):
        equal = t[a[live] + offset] == t[b[live] + offset]
        same[live[~equal]] = False
        offset += 1
        live = live[equal]
        live = live[size[a[live]] > offset]
    name = np.empty(n, np.int64)
    name[order] = np.cumsum(np.concatenate([[False], ~same]))
    return name[lms]


def suffix_array(t: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of t (shorter than 2**31): symbols 0 to k-1, of which 0 stands at the end and nowhere else."""
    n = len(t)
    if n <= 64:
        return doubling(t)
    small = falling(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    reduced, m = named(t, small, lms, k), len(lms)
    names = int(reduced.max()) + 1
    if names == m:
        deep = np.empty(m, np.int64)
        deep[reduced] = np.arange(m)
    elif names <= max(ALPHABET, m // SHARE):
        deep = suffix_array(reduced.astype(np.int32), names)
    elif 2 * m > 0.9 * n:
        deep = doubling(reduced)
    else:
        base = int(np.ceil(np.sqrt(names)))
        digits = np.zeros(2 * m - 1, np.int32)
        digits[0:-1:2], digits[1::2] = reduced[:-1] // base + 1, reduced[:-1] % base + 1
        deep = suffix_array(digits, base + 1)
        deep = deep[deep % 2 == 0] // 2
    return induce(t, small, lms[deep], k)


def common_prefixes(raw: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each position, the length it shares with its predecessor in the suffix array, and that predecessor (-1: none).

    Permuted order: where the symbols before a position and before its predecessor are equal, the value is one less
    than the position before has. The others only are compared, eight bytes at a time. raw: bytes, without the end
    symbol, as long as sa less one.
    """
    n = len(raw)
    sa = sa[1:]  # the end symbol
    phi = np.full(n, -1, np.int32)
    phi[sa[1:]] = sa[:-1]
    i = np.arange(n, dtype=np.int32)
    lead = phi <= 0
    lead[1:] |= raw[:-1] != raw[np.maximum(phi[1:], 1) - 1]
    lead[:1] = True
    word = np.ndarray(n + 8, "<u8", np.concatenate([raw, np.zeros(16, np.uint8)]), strides=(1,)).copy()
    a = np.flatnonzero(lead & (phi >= 0))
    b = phi[a]
    value = np.zeros(n, np.int32)
    start, end, done = a, n - np.maximum(a, b), 0
    while len(a):
        x = word[a] ^ word[b]
        differ = x != 0
        low = x[differ]
        low &= ~low + np.uint64(1)
        value[start[differ]] = np.minimum(done + (np.frexp(low.astype(np.float64))[1] - 1 >> 3), end[differ])
        done += 8
        live = np.flatnonzero(~differ)
        more = end[live] > done
        value[start[live[~more]]] = end[live[~more]]
        live = live[more]
        a, b, start, end = a[live] + 8, b[live] + 8, start[live], end[live]
    last = np.maximum.accumulate(np.where(lead, i, np.int32(0)))
    return value[last] - (i - last), phi
