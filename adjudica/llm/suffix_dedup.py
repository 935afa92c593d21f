"""Remove byte strings that occur elsewhere, by suffix arrays from induced sorting.

Equal strings of ``length`` bytes meet in one shard (``spans``). A shard's distinct spans are
put together with separators, its suffixes sorted by induction: classify suffixes, sort the
leftmost-smaller (LMS) substrings by inducing from unsorted LMS positions, name them, sort
the string of names, and induce the rest from the sorted LMS suffixes. Induction is linear and
runs bucket by bucket on whole arrays. The string of names has a large alphabet; its
recursion pairs names (names of names), each level halving what a name does not
yet decide, until names are unique or cover ``length`` bytes: beyond that the order is free.

Common prefixes are computed permuted (in text order): compared byte by byte only where the
preceding bytes differ, carried over elsewhere. Neighbours with a common prefix of ``length``
form a class; a class of more than one place is a repeat.

Defined results: a null text is empty; a text shorter than ``length`` keeps all its bytes;
repeated rows repeat each other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans

LENGTH = 200
RUN = 32


def _is_smaller(t: np.ndarray) -> np.ndarray:
    """Whether the suffix from each position is smaller than the next (S type); the last is not."""
    n = len(t)
    ends = np.flatnonzero(np.concatenate((t[1:] != t[:-1], [True])))
    rising = np.zeros(len(ends), bool)
    rising[:-1] = t[ends[:-1]] < t[ends[:-1] + 1]
    return np.repeat(rising, np.diff(np.concatenate(([-1], ends)))) if n else np.zeros(0, bool)


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix array induced from LMS positions in their given order."""
    n = len(t)
    seeds = np.split(lms[np.argsort(t[lms], kind="stable")], np.cumsum(np.bincount(t[lms], minlength=sigma))[:-1])
    large: list[list[np.ndarray]] = [[] for _ in range(sigma)]

    def spread(frontier, into, want_small, now):
        """Predecessors of the wanted type go to the buckets of their bytes; returns those of this bucket."""
        j = frontier[frontier > 0] - 1
        j = j[small[j] == want_small]
        if not len(j):
            return j
        c = t[j]
        by = np.argsort(c, kind="stable")
        j, c = j[by], c[by]
        cuts = np.flatnonzero(c[1:] != c[:-1]) + 1
        again = j[:0]
        for part in np.split(j, cuts) if len(cuts) else [j]:
            at = t[part[0]]
            into[at].append(part)
            if at == now:
                again = part
        return again

    # the end of the text comes first of all and brings in the last suffix
    large[t[n - 1]].append(np.array([n - 1], lms.dtype))
    for c in range(sigma):
        if large[c]:
            frontier = np.concatenate(large[c])
            while len(frontier):
                frontier = spread(frontier, large, False, c)
        if len(seeds[c]):
            spread(seeds[c], large, False, -1)
    falling: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    for c in range(sigma - 1, -1, -1):
        if falling[c]:
            frontier = np.concatenate(falling[c])
            while len(frontier):
                frontier = spread(frontier, falling, True, c)
        if large[c]:
            spread(np.concatenate(large[c])[::-1], falling, True, -1)
    out = []
    for c in range(sigma):
        out += large[c]
        if falling[c]:
            out.append(np.concatenate(falling[c])[::-1])
    return np.concatenate(out)


def _order_names(names: np.ndarray, depth: int | None) -> np.ndarray:
    """Order of the suffixes of a string of names, exact for ``depth`` names (None: entirely)."""
    n = len(names)
    rank, covered = names.astype(np.int32), 1
    order = np.argsort(rank, kind="stable").astype(np.int32)
    while covered < n and (depth is None or covered < depth):
        sorted_ = rank[order]
        tied = np.empty(n, bool)
        same = sorted_[1:] == sorted_[:-1]
        tied[0], tied[1:] = False, same
        tied[:-1] |= same
        open_ = order[tied]
        if not len(open_):
            break
        # ranks with gaps: the first index of the class; only tied suffixes are sorted again
        nxt = np.where(open_ + covered < n, rank[np.minimum(open_ + covered, n - 1)] + 1, 0).astype(np.int32)
        by = np.lexsort((nxt, rank[open_]))
        open_, nxt = open_[by], nxt[by]
        slots = np.flatnonzero(tied)
        order[slots] = open_
        fresh = np.concatenate(([True], (rank[open_][1:] != rank[open_][:-1]) | (nxt[1:] != nxt[:-1])))
        base = np.empty(n, np.int32)
        base[slots] = np.maximum.accumulate(np.where(fresh, slots, 0))
        rank = rank.copy() if covered == 1 else rank
        rank[open_] = base[slots]
        if covered == 1:  # from now on ranks are positions in the order
            settled = order[~tied]
            rank[settled] = np.flatnonzero(~tied)
        covered *= 2
    return order


def suffix_array(t: np.ndarray, sigma: int, depth: int | None = None) -> np.ndarray:
    """Suffix array of a string over 0 .. sigma - 1 by induced sorting, exact for ``depth`` places (None: entirely)."""
    n = len(t)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: t[i:].tolist()), np.int32)
    small = _is_smaller(t)
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    if len(lms) < 2:
        return _induce(t, small, lms, sigma)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    first = _induce(t, small, lms, sigma)
    sorted_lms = first[is_lms[first]]
    # name LMS substrings: from one LMS position to the next, both included
    nth = np.empty(n, np.int32)
    nth[lms] = np.arange(len(lms))
    length = np.concatenate((np.diff(lms) + 1, [n - lms[-1] + 1]))
    a, b = sorted_lms[:-1], sorted_lms[1:]
    la, lb = length[nth[a]], length[nth[b]]
    differ = la != lb
    differ |= (b == lms[-1]) | (a == lms[-1])
    active = np.flatnonzero(~differ)
    k = 0
    while len(active):
        unequal = t[a[active] + k] != t[b[active] + k]
        differ[active[unequal]] = True
        active = active[~unequal]
        k += 1
        active = active[la[active] > k]
    names = np.empty(len(lms), np.int32)
    names[nth[sorted_lms]] = np.concatenate(([0], np.cumsum(differ)))
    order = _order_names(names, depth)
    return _induce(t, small, lms[order], sigma)


def permuted_prefixes(t: np.ndarray, sa: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Per text position: common prefix with the suffix before it in the order, ended by ``stop`` places.

    Where the preceding symbols agree, the value is one less than that of the position
    before; only the others, and the first after a stop, are compared.
    """
    n = len(t)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    at = np.arange(n, dtype=np.int32)
    has = before >= 0
    carried = has & (before > 0) & (at > 0)
    carried[carried] = (t[at[carried] - 1] == t[before[carried] - 1]) & ~stop[at[carried] - 1]
    fresh = ~carried
    value = np.zeros(n, np.int32)
    active = np.flatnonzero(fresh & has).astype(np.int32)
    k = 0
    while len(active):
        i, j = active + k, before[active] + k
        inside = (i < n) & (j < n)
        active = active[inside]
        i, j = i[inside], j[inside]
        active = active[(t[i] == t[j]) & ~stop[i]]
        value[active] += 1
        k += 1
    source = np.maximum.accumulate(np.where(fresh, at, 0))
    return np.maximum(value[source] - (at - source), 0)


def repeats_in_shard(texts: list[bytes], counts: np.ndarray, length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each span the runs of starts whose ``length`` bytes occur at more than one place."""
    data = np.frombuffer(b"\x00".join(texts) + b"\x00", np.uint8).astype(np.int16) + 1
    sizes = np.array([len(x) for x in texts])
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    stop = np.zeros(len(data), bool)
    stop[starts + sizes] = True
    data[stop] = 0
    sa = suffix_array(data, 257, length)
    common = permuted_prefixes(data, sa, stop)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes + 1)
    place = np.arange(len(data), dtype=np.int32) - starts.astype(np.int32)[owner]
    window = place <= sizes[owner] - length
    classes = np.cumsum(common[sa] < length, dtype=np.int32)
    del common
    in_order = window[sa]
    totals = np.bincount(classes[in_order], counts[owner[sa[in_order]]], classes[-1] + 1)
    repeated = np.zeros(len(data), bool)
    repeated[sa[in_order]] = totals[classes[in_order]] > 1
    return runs_by_owner(repeated, owner, place, len(texts))


def runs_by_owner(marked: np.ndarray, owner: np.ndarray, place: np.ndarray, n: int) -> list[list[tuple[int, int]]]:
    """Runs (first, last) of marked places, by owner."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    at = np.flatnonzero(marked)
    if len(at):
        new = np.concatenate(([True], (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])))
        first = at[new]
        last = at[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(at) - 1]))]
        for o, a, b in zip(owner[first].tolist(), place[first].tolist(), place[last].tolist()):
            out[o].append((a, b))
    return out


def byte_units(text: bytes):
    data = np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)
    view = memoryview(text)
    return data, lambda a, b: view[a:b]


def repeated_bytes(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The packed texts and (b1, b2, runs) of repeated starts; see ``spans.repeated_windows``."""

    def kernel(texts, counts):
        return repeats_in_shard(texts, counts, length)

    return spans.repeated_windows(docs, byte_units, kernel, length, min(RUN, length), 1.0, key, text)


def kept_bytes(text: bytes, ranges: list[tuple[int, int]]) -> bytes:
    """The bytes outside of the ranges, one after the other."""
    out, at = [], 0
    for a, b in ranges:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans) of every document; ``kept`` is its text without repeats."""
    packed, runs = repeated_bytes(docs, length, key, text)

    def apply(text: bytes, ranges):
        kept = kept_bytes(text, ranges)
        return kept, len(text), len(text) - len(kept), len(ranges)

    return spans.remove_repeats(docs, packed, runs, apply, length, "kept binary, n_bytes long, n_removed long, n_spans long", key, text)


def repeat_digests(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256): the kept text as its digest, made where it is cut."""
    packed, runs = repeated_bytes(docs, length, key, text)

    def apply(text: bytes, ranges):
        kept = kept_bytes(text, ranges)
        return len(text), len(text) - len(kept), len(ranges), hashlib.sha256(kept).hexdigest()

    return spans.remove_repeats(docs, packed, runs, apply, length, "n_bytes long, n_removed long, n_spans long, kept_sha256 string", key, text)
