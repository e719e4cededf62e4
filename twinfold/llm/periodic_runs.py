"""Periodic runs of words, by common extensions over a difference cover.

Documents are taken many at a time and laid one behind the other as numbers of words, with a number
of its own after each, so that nothing extends from one document into the next.

1. Harmonic grid: a run of four periods ``p`` or more holds four multiples of ``p`` in a row, which
   all carry the same word.  For each ``p`` only every ``p``-th place is looked at, and longer
   periods only where documents are long enough, so the grid has about ``n log n`` places.
2. Each place left is extended to both sides by two queries for the longest common extension of
   the suffixes (for the left side: of the reversed words) at the place and a period further.
3. Extensions: only suffixes at places of a difference cover are sorted.  Two places are compared
   word by word until both lie in the cover, which takes fewer steps than the cover's modulus;
   there the answer is a minimum over the common prefixes of neighbours, from a sparse table.

Runs of one stretch are found by each multiple of its period; the smallest stays.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import schema_of, text_or_empty

# A perfect difference set, whose differences are all numbers modulo 31.
MODULUS = 31
COVER = (0, 1, 3, 8, 12, 18)

TOGETHER = 200_000  # words that are searched together; a longer document is searched alone
AT_ONCE = 1_000_000  # places that are extended together
LEAST = 6  # words of the shortest run
PERIODS = 4  # that a run has at least

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]  # start, length, period


class Extensions:
    """Longest common extensions to the right between places of ``words``.

    ``words`` are numbers from 0; one that is met once ends every extension, and the last
    word must be such a one.
    """

    def __init__(self, words: np.ndarray):
        self.words, self.n = words, len(words)
        place = np.arange(self.n)
        in_cover = np.isin(place % MODULUS, COVER)
        # Sampled places class by class, so that the next entry lies one modulus further.
        order = np.argsort(place[in_cover] % MODULUS, kind="stable")
        self.places = place[in_cover][order]
        self.index = np.full(self.n, -1, np.int64)
        self.index[self.places] = np.arange(len(self.places))
        m = len(self.places)
        ends = np.append(np.flatnonzero(np.diff(self.places) != MODULUS), m - 1) + 1
        self.end = np.repeat(ends, np.diff(np.append(0, ends)))  # of the entry's class
        self._steps()
        self._sort()
        self._table()

    def _steps(self) -> None:
        """By the difference of two places modulo 31, the cover's element that the first reaches."""
        self.target = np.zeros(MODULUS, np.int64)
        for x in COVER:
            for y in COVER:
                self.target[(y - x) % MODULUS] = x
        self.target[0] = -1  # any element will do

    def _sort(self) -> None:
        """Ranks of sampled suffixes: by their first 31 words, then twice as many, and so on."""
        m = len(self.places)
        rank = np.zeros(m, np.int64)
        top = int(self.words.max()) + 2
        padded = np.append(self.words, np.full(MODULUS, -1))
        for k in range(MODULUS):
            rank = _dense(rank * top + padded[self.places + k] + 1)
        self.levels = [rank]
        step = 1
        while rank.max(initial=-1) + 1 < m:
            after = np.zeros(m, np.int64)
            has = np.arange(m) + step < self.end
            after[has] = rank[np.flatnonzero(has) + step] + 1
            rank = _dense(rank * (m + 1) + after)
            self.levels.append(rank)
            step *= 2
        self.rank = rank

    def _table(self) -> None:
        """Common prefixes of neighbours in sorted order, and their minima over 2, 4, 8, ..."""
        m = len(self.places)
        sorted_ = np.empty(m, np.int64)
        sorted_[self.rank] = np.arange(m)
        a, b = sorted_[:-1].copy(), sorted_[1:].copy()
        common = np.zeros(m - 1 if m else 0, np.int64)
        live = np.ones(len(common), bool)  # neither has run out of its class
        for level in range(len(self.levels) - 1, -1, -1):
            same = np.flatnonzero(live)
            same = same[self.levels[level][a[same]] == self.levels[level][b[same]]]
            common[same] += MODULUS << level
            a[same] += 1 << level
            b[same] += 1 << level
            live[same] = (a[same] < self.end[sorted_[same]]) & (b[same] < self.end[sorted_[same + 1]])
        left = np.flatnonzero(live)
        common[left] += self._compare(self.places[a[left]], self.places[b[left]], MODULUS)
        self.minima = [common]
        width = 1
        while 2 * width <= len(common):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _compare(self, i: np.ndarray, j: np.ndarray, most: np.ndarray | int) -> np.ndarray:
        """Equal words from ``i`` and ``j`` on, at most ``most``; ``i`` and ``j`` differ."""
        found = np.zeros(len(i), np.int64)
        most = np.broadcast_to(most, len(i))
        live = np.flatnonzero(most > 0)
        k = 0
        while len(live):
            live = live[self.words[i[live] + k] == self.words[j[live] + k]]
            k += 1
            found[live] = k
            live = live[most[live] > k]
        return found

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For each pair of different places, how many words from them on are equal."""
        target = self.target[(j - i) % MODULUS]
        shift = np.where(target < 0, -1, (target - i) % MODULUS)
        multiples = np.flatnonzero(shift < 0)  # equal modulo 31: the next element after both
        if len(multiples):
            cover = np.array([*COVER, MODULUS + COVER[0]])
            r = i[multiples] % MODULUS
            shift[multiples] = cover[np.searchsorted(cover, r)] - r
        found = self._compare(i, j, shift)
        whole = np.flatnonzero(found == shift)
        a = self.rank[self.index[i[whole] + shift[whole]]]
        b = self.rank[self.index[j[whole] + shift[whole]]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        width = np.floor(np.log2(high - low)).astype(np.int64)
        least = np.empty(len(whole), np.int64)
        for w in np.unique(width):
            of = width == w
            least[of] = np.minimum(self.minima[w][low[of]], self.minima[w][high[of] - (1 << w)])
        found[whole] += least
        return found


def _dense(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].reshape(-1)


def _grid(words: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """(places, period): places that begin four equal words a period apart.

    Documents come with the longest first, each followed by a word of its own.
    """
    ends = np.cumsum(lengths + 1)
    for p in range(1, int(lengths[0]) // PERIODS + 1):
        long_enough = int(np.searchsorted(-lengths, -PERIODS * p, "right"))
        every = words[: ends[long_enough - 1] : p]
        same = every[1:] == every[:-1]
        if len(same) >= PERIODS - 1:
            all_same = same[2:] & same[1:-1] & same[:-2]
            at = np.flatnonzero(all_same)
            if len(at):
                yield at * p, p


def runs_of(words: np.ndarray, lengths: np.ndarray) -> Runs:
    """All runs of documents laid one behind the other (see ``_grid``), by place."""
    found: list[Runs] = []
    forward = backward = None
    places: list[np.ndarray] = []
    periods: list[np.ndarray] = []

    def extend() -> None:
        nonlocal forward, backward
        if forward is None:
            forward, backward = Extensions(words), _backward(words)
        i, p = np.concatenate(places), np.concatenate(periods)
        places.clear()
        periods.clear()
        right = forward(i, i + p)
        left = np.zeros(len(i), np.int64)
        inner = np.flatnonzero(i > 0)
        at = len(words) - i[inner]  # of the word before, in the reversed words
        left[inner] = backward(at, at - p[inner])
        length = left + right + p
        good = length >= np.maximum(LEAST, PERIODS * p)
        found.append(_smallest(i[good] - left[good], length[good], p[good]))

    held = 0
    for at, p in _grid(words, lengths):
        places.append(at)
        periods.append(np.full(len(at), p))
        held += len(at)
        if held >= AT_ONCE:
            extend()
            held = 0
    if held:
        extend()
    if not found:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing
    return _smallest(*(np.concatenate(c) for c in zip(*found)))


def _backward(words: np.ndarray) -> Extensions:
    """Extensions over the reversed words, with a word of its own at the end."""
    return Extensions(np.append(words[::-1], words.max() + 1))


def _smallest(start: np.ndarray, length: np.ndarray, period: np.ndarray) -> Runs:
    """Each stretch once, with its smallest period, ordered by start and period."""
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[first], length[first], period[first]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def search(texts: list[list[bytes]]) -> list[Runs]:
    """The runs of each text, given as its words."""
    lengths = np.array([len(t) for t in texts], np.int64)
    out: list[Runs] = [(np.zeros(0, np.int64),) * 3] * len(texts)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] >= LEAST]
    at = 0
    while at < len(order):
        size, to = 0, at
        while to < len(order) and (to == at or size + lengths[order[to]] <= TOGETHER):
            size += int(lengths[order[to]])
            to += 1
        part = order[at:to]
        at = to
        numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        laid = np.empty(size + len(part), np.int64)
        begins = np.cumsum(np.append(0, lengths[part] + 1))
        for k, b in zip(part.tolist(), begins.tolist()):
            laid[b : b + lengths[k]] = [*map(numbers.__getitem__, texts[k])]
        laid[begins[1:] - 1] = len(numbers) + np.arange(len(part))
        # Extensions are only asked for in documents with a place on the grid.
        asked = np.zeros(len(part), bool)
        for places, _ in _grid(laid, lengths[part]):
            asked[np.searchsorted(begins, places, "right") - 1] = True
        if not asked.any():
            continue
        laid = laid[np.repeat(asked, lengths[part] + 1)]
        part = part[asked]
        begins = np.cumsum(np.append(0, lengths[part] + 1))
        start, length, period = runs_of(laid, lengths[part])
        owner = np.searchsorted(begins, start, "right") - 1
        cut = np.searchsorted(owner, np.arange(len(part) + 1))
        for k, b, low, high in zip(part.tolist(), begins.tolist(), cut.tolist(), cut[1:].tolist()):
            if high > low:
                out[k] = start[low:high] - b, length[low:high], period[low:high]
    return out


def collapse(words: list[bytes], runs: Runs) -> list[bytes]:
    """Words that no run holds after its first period."""
    start, length, period = runs
    if not len(start):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    return [w for w, keep in zip(words, kept.tolist()) if keep]


def find_runs(documents: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed``: per document its runs (structs of ``start, length,
    period`` in words from 0, by start and period) and its text without what repeats.

    Words are what ASCII white space divides.  A run is a stretch with smallest period ``q`` of at
    least 6 and at least ``4 * q`` words that no neighbour extends.  Null and empty texts have no
    words and no runs.  Rows that repeat an id are judged each; an empty table gives an empty one;
    other columns are not read.  A text of any length is searched whole; memory grows with the
    longest text, not with the table.
    """
    schema = schema_of(
        "doc_id long, n_words long, runs array<struct<start:long, length:long, period:long>>, "
        "collapsed string"
    )
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [t.encode().split() for t in batch.column("text").to_pylist()]
            found = search(words)
            flat = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in zip(*found)]
            ends = np.cumsum([0, *(len(r[0]) for r in found)])
            structs = pa.StructArray.from_arrays(
                [pa.array(c, pa.int64()) for c in (flat or [[], [], []])], fields=[*run]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs),
                    pa.array([b" ".join(collapse(w, r)).decode() for w, r in zip(words, found)]),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(step, schema)


def most_repeated(runs: str = "runs") -> F.Column:
    """The run with the greatest exact ``length / period``; of equals the one that starts first,
    then the one with the smallest period.  Null where there is none."""

    def better(a, b):
        # Exact: products of whole numbers, and the first of equals stays (runs are in order).
        return F.when(
            a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b
        ).otherwise(a)

    nothing = F.lit(None).cast("struct<start:long, length:long, period:long>")
    return F.aggregate(F.col(runs), nothing, better)
