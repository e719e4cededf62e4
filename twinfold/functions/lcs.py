"""Longest common subsequences of many text pairs at once.

Two batch kernels, each working on all pairs of an Arrow batch together:

* ``lcs_lengths``: the bit-vector recurrence of Hyyro (2004), one 64-bit word
  per 64 characters of the shorter text.
* ``window_scores``: semi-local comparison by iterative combing (Tiskin), which
  yields the subsequence length of one text against every window of the other
  from one pass over the length product.
"""

from __future__ import annotations

import math

import numpy as np

LANES_PER_WORD = 32
VECTOR_CHARS = 1 << 18
COMB_CHARS = 1 << 17
SHORT_STRANDS = 1 << 15  # numbers of strands that 16 bits hold beside a bit that is free
SHORT_CODES = 0xFFFE  # the fillers -2 and -1 in 16 bits begin here
MASK_WORDS = 1 << 22


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters in a row, and where each text begins (one entry more)."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.int32)
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    return flat, starts


def _columns(texts: list[str], filler: int) -> np.ndarray:
    """One column of character codes per text, filled up below."""
    flat, starts = _codes(texts)
    lengths = np.diff(starts)
    grid = np.full((int(lengths.max(initial=0)), len(texts)), filler, dtype=np.int32)
    column = np.repeat(np.arange(len(texts)), lengths)
    grid[np.arange(len(flat)) - starts[column], column] = flat
    return grid


def _batches(lengths: list[int], items: list, chars: int):
    """Neighbours together while they are of similar length and not too much text."""
    start = 0
    for at, length in enumerate(lengths):
        low, high = sorted((length, lengths[start]))
        if at > start and (high > 1.5 * low + 16 or (at - start + 1) * high > chars):
            yield items[start:at]
            start = at
    if items:
        yield items[start:]


def _long_lcs(short: str, long: str) -> int:
    masks: dict[str, int] = {}
    for i, c in enumerate(short):
        masks[c] = masks.get(c, 0) | (1 << i)
    row = full = (1 << len(short)) - 1
    for c in long:
        hit = row & masks.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(short) - row.bit_count()


def _vector_lcs(shorts: list[str], longs: list[str]) -> np.ndarray:
    """Subsequence lengths of a batch; ``longs`` sorted by falling length."""
    pattern, text = _columns(shorts, -1), _columns(longs, -1)
    seen = np.zeros(max(pattern.max(), text.max()) + 2, dtype=np.int32)
    seen[0], seen[pattern + 1], seen[text + 1] = 1, 1, 1
    letter = np.cumsum(seen) - 1  # the filler is letter 0
    pattern_code, text_code = letter[pattern + 1], letter[text + 1]
    width, pairs = (pattern.shape[0] + 63) // 64, pattern.shape[1]
    if pairs > 1 and width * int(letter[-1] + 1) * pairs > MASK_WORDS:  # a large alphabet
        half = pairs // 2
        return np.concatenate(
            [_vector_lcs(shorts[:half], longs[:half]), _vector_lcs(shorts[half:], longs[half:])]
        )
    lane = np.arange(pairs)
    masks = np.zeros((width, letter[-1] + 1, pairs), dtype=np.uint64)
    for i in range(pattern.shape[0]):
        masks[i // 64, pattern_code[i], lane] |= np.uint64(1 << (i % 64))
    masks[:, 0, :] = 0
    masks = masks.reshape(width, -1)
    place = text_code.astype(np.int64) * pairs + lane
    rows = np.full((width, pairs), ~np.uint64(0))
    running = np.count_nonzero(text >= 0, axis=1)
    for j in range(text.shape[0]):
        row = rows[:, : running[j]]
        hit = masks.take(place[j, : running[j]], axis=1)
        hit &= row
        total = row + hit
        # All words at once; a carry goes on into the next word as long as it overflows.
        over = (total < row)[:-1]
        while over.any():
            above = total[-len(over) :]
            above += over
            over = (above < over)[:-1]
        row &= ~hit
        row |= total
    return np.bitwise_count(~rows).sum(axis=0).astype(np.int64)


def lcs_lengths(left: list[str], right: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair.

    Pairs with shorter texts of equally many words go together, in order of the
    longer text.  Groups too small to pay for the array calls go one by one.
    """
    out = np.zeros(len(left), dtype=np.int64)
    pairs = [(a, b) if len(a) <= len(b) else (b, a) for a, b in zip(left, right)]
    groups: dict[int, list[int]] = {}
    for i, (a, b) in enumerate(pairs):
        if a == b:
            out[i] = len(a)
        elif a:
            groups.setdefault((len(a) + 63) // 64, []).append(i)
    for words, group in groups.items():
        group.sort(key=lambda i: -len(pairs[i][1]))
        for batch in _batches([len(pairs[i][1]) for i in group], group, VECTOR_CHARS):
            if len(batch) < LANES_PER_WORD * words:
                out[batch] = [_long_lcs(*pairs[i]) for i in batch]
            else:
                out[batch] = _vector_lcs([pairs[i][0] for i in batch], [pairs[i][1] for i in batch])
    return out


def _comb(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Where the strand that leaves below each column of ``long`` came in.

    A strand entering above column s is numbered ``len(short) + s``; smaller
    numbers came in from the left.  Cells are visited by anti-diagonal; in a
    cell the strands swap sides if the characters agree or they met before.

    Numbers leave the highest bit free, in 16 bits if they can.  A strand whose cell has agreeing
    characters gets that bit, so that the smaller of the two strands is the one that goes on across.
    """
    n, m, pairs = short.shape[0], long.shape[0], short.shape[1]
    kind, high = (np.uint16, 15) if n + m <= SHORT_STRANDS else (np.uint32, 31)
    if max(short.max(initial=0), long.max(initial=0)) < SHORT_CODES:  # the fillers stay apart
        short, long = short.astype(np.uint16), long.astype(np.uint16)
    across = np.repeat(np.arange(n - 1, -1, -1, dtype=kind)[:, None], pairs, axis=1)
    # Columns are kept backwards, so that a diagonal is one block in both arrays.
    down = np.repeat(np.arange(n + m - 1, n - 1, -1, dtype=kind)[:, None], pairs, axis=1)
    backwards = np.ascontiguousarray(long[::-1])
    agree = np.empty((min(n, m), pairs), dtype=bool)
    marked, total = (np.empty((min(n, m), pairs), dtype=kind) for _ in range(2))
    for d in range(n + m - 1):
        top, bottom = max(0, d - m + 1), min(d, n - 1) + 1
        shift = m - 1 - d
        a, b = across[top:bottom], down[top + shift : bottom + shift]
        same, one, both = agree[: bottom - top], marked[: bottom - top], total[: bottom - top]
        np.equal(short[top:bottom], backwards[top + shift : bottom + shift], out=same)
        np.copyto(one, same)
        np.left_shift(one, high, out=one)
        np.bitwise_or(one, a, out=one)
        np.add(a, b, out=both)
        np.minimum(one, b, out=a)
        np.subtract(both, a, out=b)
    return down[::-1]


def _best_windows(shorts: list[str], longs: list[str]) -> np.ndarray:
    """Best score of each short text against the windows of its long text.

    A strand that begins and ends inside a window costs it one character, so
    all windows of all pairs are scored by running sums over strand ends.
    """
    came_in = _comb(_columns(shorts, -1), _columns(longs, -2))
    m_pad, pairs = came_in.shape
    n = np.array([len(t) for t in shorts])
    m = np.array([len(t) for t in longs])
    begin = came_in.astype(np.int64) - max(len(t) for t in shorts)
    end, lane = np.nonzero((begin >= 0) & (np.arange(m_pad)[:, None] < m))
    begin = begin[end, lane]

    def running(at: np.ndarray, lanes: np.ndarray) -> np.ndarray:
        hits = np.bincount(at * pairs + lanes, minlength=(m_pad + 1) * pairs)
        return np.cumsum(hits.reshape(m_pad + 1, pairs)[:m_pad], axis=0)

    k = np.arange(1, m_pad + 1)[:, None]
    lost = np.minimum(running(end, lane), running(m[lane] - 1 - begin, lane))
    edges = np.where(k <= n, 200.0 * (k - lost) / (n + k), 0.0).max(axis=0)
    first = np.maximum(end - n[lane] + 1, 0)
    kept = first <= begin
    lost = running(first[kept], lane[kept]) - running(begin[kept] + 1, lane[kept])
    fewest = np.where(k <= m - n + 1, lost, m_pad).min(axis=0)
    return np.maximum(edges, 100.0 * (n - fewest) / n)


def window_scores(left: list[str], right: list[str]) -> np.ndarray:
    """Best similarity of the shorter text with a window of the longer one.

    Windows are all runs as long as the shorter text and all shorter prefixes
    and suffixes of the longer one; texts of equal length are compared both ways.
    """
    out = np.zeros(len(left))
    jobs: list[tuple[int, str, str]] = []
    for i, (a, b) in enumerate(zip(left, right)):
        if len(a) > len(b):
            a, b = b, a
        if a in b and (a or not b):
            out[i] = 100.0
        elif a:
            jobs.append((i, a, b))
            if len(a) == len(b):
                jobs.append((i, b, a))
    # Similar short texts together, in order of the long ones.
    jobs.sort(key=lambda job: (round(2 * math.log2(len(job[1]))), len(job[2])))
    for batch in _batches([len(b) for _, _, b in jobs], jobs, COMB_CHARS):
        which, shorts, longs = zip(*batch)
        np.maximum.at(out, list(which), _best_windows(list(shorts), list(longs)))
    return out
