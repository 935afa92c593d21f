"""Remove passages of ``window`` words that occur elsewhere, by prefix-partitioned suffix trees.

Only suffixes that can begin a repeat are looked at: those of the distinct spans whose
anchor, a prefix of ``RUN`` words met inside the passage, stands at several places
(``spans``). They are dealt by that prefix into shards of bounded size, prefixes that too many
different spans share by ever longer ones. In a shard the suffixes
are split by their first word, then by ever longer prefixes; a prefix that only one suffix
has is a leaf and drops out, a prefix with several is an internal node of the tree. Its depth
doubles from level to level, so a level is one grouping of (node, node further on). The
internal nodes ``window`` words deep are the repeats; neighbouring starts make them maximal.

Defined results: a null text has no words; a text with fewer words than ``window`` keeps them
all; repeated rows repeat each other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from . import spans
from .suffix_dedup import runs_by_owner

WINDOW = 35
RUN = 6


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words; quicker than to look them up in a memory of many words."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def word_units(text: bytes):
    words = text.split()
    return word_hashes(words), lambda a, b: b" ".join(words[a:b])


def deep_starts(words: np.ndarray, left: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """Positions whose suffixes run through an internal node ``depth`` words deep.

    ``left``: words from a position to the end of its text; ``places``: how many places of
    the corpus a position stands for. A node is internal if it stands for several places.
    A level joins the node of a prefix with the node where the prefix ends; a suffix
    that has reached a leaf at either stays a leaf.
    """
    node = np.full(len(words), -1, np.int64)
    alive, keys, size = np.flatnonzero(left > 0), None, 0
    while len(alive):
        if size:
            step = min(size, depth - size)
            alive = alive[left[alive] >= size + step]
            alive = alive[node[alive + step] >= 0]
            keys = node[alive] * np.int64(len(words)) + node[alive + step]
            size += step
        else:
            keys, size = words[alive], 1
        if not len(alive):
            break
        _, classes = np.unique(keys, return_inverse=True)
        internal = np.bincount(classes, places[alive])[classes] > 1
        node[:] = -1
        alive = alive[internal]
        node[alive] = classes[internal]
        if size == depth:
            break
    return alive


def repeats_in_shard(texts: list[bytes], counts: np.ndarray, window: int = WINDOW) -> list[list[tuple[int, int]]]:
    """For each span the runs of starts whose ``window`` words occur at more than one place."""
    split = [t.split() for t in texts]
    sizes = np.array([len(w) for w in split])
    words = np.concatenate([np.empty(0, np.uint64), *map(word_hashes, split)])
    owner = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(words)) - (np.cumsum(sizes) - sizes)[owner]
    starts = deep_starts(words, sizes[owner] - place, counts[owner], window)
    marked = np.zeros(len(words), bool)
    marked[starts] = True
    return runs_by_owner(marked, owner, place, len(texts))


def repeated_words(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The packed texts and (b1, b2, runs) of repeated starts, in words."""

    def kernel(texts, counts):
        return repeats_in_shard(texts, counts, window)

    return spans.repeated_windows(docs, word_units, kernel, window, min(RUN, window), 6.5, key, text)


def kept_words(words: list[bytes], ranges: list[tuple[int, int]]) -> list[bytes]:
    out, at = [], 0
    for a, b in ranges:
        out += words[at:a]
        at = b
    return out + words[at:]


def remove_repeated_words(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, kept, n_words, n_removed, removed): the words outside of repeats, and the repeats as word ranges."""
    packed, runs = repeated_words(docs, window, key, text)

    def apply(text: bytes, ranges):
        words = text.split()
        kept = kept_words(words, ranges)
        return b" ".join(kept), len(words), len(words) - len(kept), [list(r) for r in ranges]

    return spans.remove_repeats(docs, packed, runs, apply, window, "kept binary, n_words long, n_removed long, removed array<array<long>>", key, text)


def repeat_digests(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256): the kept words as their digest, made where they are cut."""
    packed, runs = repeated_words(docs, window, key, text)

    def apply(text: bytes, ranges):
        words = text.split()
        kept = kept_words(words, ranges)
        return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()

    return spans.remove_repeats(docs, packed, runs, apply, window, "n_words long, n_removed long, kept_sha256 string", key, text)
