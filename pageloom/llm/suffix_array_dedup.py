"""Removal of repeated byte strings, found by sorting suffixes by bucket-pointer refinement.

The suffixes of a shard's passages are put into buckets by their first ``Q`` bytes. A bucket is then
sorted by the pointers, at an offset of the depth reached, to the buckets of the suffixes there, and
each round reads the pointers that the rounds before it have refined, so the depth doubles. Only
buckets of more than one suffix are sorted on. At the depth of the window, the suffixes of one bucket
are the places of one string.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from pageloom.llm.repeats import HOT, BLOCK_BYTES, Repeats, Shard

WINDOW = 50
GRAM = 18
Q = 8
PORTION = 1 << 17


def refined(pointer: np.ndarray, crowd: np.ndarray, at: np.ndarray, ahead: np.ndarray) -> None:
    """Sort the suffixes ``at`` within their buckets by the buckets at ``ahead``; pointers and sizes change in place.

    A pointer is the place of the bucket's first suffix in the sorted order, ``crowd`` the bucket's size.
    """
    own = pointer[at].astype(np.uint64) << np.uint64(32)
    order = np.argsort(own | pointer[ahead].astype(np.uint64), kind="stable")
    ahead, at, own = pointer[ahead][order], at[order], own[order]
    bucket = np.append(True, own[1:] != own[:-1])
    new = bucket.copy()
    new[1:] |= ahead[1:] != ahead[:-1]
    start = np.flatnonzero(new)
    inside = start - np.flatnonzero(bucket)[np.cumsum(bucket)[start] - 1]
    size = np.diff(np.append(start, len(at)))
    pointer[at] += np.repeat(inside, size)
    crowd[at] = np.repeat(size, size)


def same_windows(text: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of windows in buckets of more than one, by bucket, and where each bucket begins.

    ``ends`` gives for each place of ``text`` the end of its passage.
    """
    n, q = len(text), min(Q, window)
    place = np.arange(n)
    gram = np.zeros(n, np.uint64)
    for i in range(q):
        gram[: n - i] = gram[: n - i] << np.uint64(8) | text[i:].astype(np.uint64)
    whole = np.flatnonzero(place + q <= ends)
    order = whole[np.argsort(gram[whole], kind="stable")]
    start = np.flatnonzero(np.append(True, gram[order][1:] != gram[order][:-1]))
    size = np.diff(np.append(start, len(order)))
    pointer, crowd = np.zeros(n, np.int64), np.zeros(n, np.int64)
    pointer[order], crowd[order] = np.repeat(start, size), np.repeat(size, size)
    depth = q
    while depth < window:
        step = min(depth, window - depth)
        at = np.flatnonzero((crowd > 1) & (place + depth + step <= ends))
        if len(at):
            refined(pointer, crowd, at, at + step)
        depth += step
    at = np.flatnonzero((crowd > 1) & (place + window <= ends))
    at = at[np.argsort(pointer[at], kind="stable")]
    begin = np.flatnonzero(np.append(True, pointer[at][1:] != pointer[at][:-1])) if len(at) else at
    return at, begin


def earlier(window: int):
    """For each passage of a shard, its windows that stand in a passage of a smaller key."""

    def portion(shard: Shard, own: list[int], out: list[np.ndarray]) -> None:
        sizes = np.array([len(shard.texts[i]) for i in own])
        stops = np.cumsum(sizes)
        text = np.frombuffer(b"".join(shard.texts[i] for i in own), np.uint8)
        owner = np.repeat(np.arange(len(own)), sizes)
        at, begin = same_windows(text, stops[owner], window)
        if not len(at):
            return
        key = shard.key[own][owner[at]]
        least = np.repeat(np.minimum.reduceat(key, begin), np.diff(np.append(begin, len(at))))
        found = np.zeros(len(text), bool)
        found[at] = least < key
        for i, stop, size in zip(own, stops.tolist(), sizes.tolist(), strict=True):
            out[i] = found[stop - size : stop - window + 1]

    def found(shard: Shard) -> list[np.ndarray]:
        out = [np.zeros(len(t) - window + 1, bool) for t in shard.texts]
        ends = np.append(np.flatnonzero(np.diff(shard.anchor)) + 1, len(out)).tolist() if out else ()
        held, size, begin = [], 0, 0
        for end in ends:
            # A lone passage has its windows in one text.
            if end - begin > 1:
                held += range(begin, end)
                size += sum(len(shard.texts[i]) for i in range(begin, end))
            begin = end
            if size > PORTION:
                portion(shard, held, out)
                held, size = [], 0
        if held:
            portion(shard, held, out)
        return out

    return found


def without_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, hot: int = HOT, block_bytes: int = BLOCK_BYTES,
    extra: str | None = None,
) -> DataFrame:
    """``key``, ``n_tokens`` (bytes), ``n_removed``, ``n_spans`` and ``kept`` (bytes) of every row.

    A byte goes if a string of ``window`` bytes over it also stands in a text of a smaller key.
    Strings are judged on the input and never cross texts. A null text is empty; a null key is
    larger than all others; rows that share a key do not remove each other. Other columns are not read, but
    for one string column ``extra`` that is carried along.
    """
    return Repeats(window, min(GRAM, window), False, earlier(window), hot, block_bytes).kept(docs, key, text, extra)
