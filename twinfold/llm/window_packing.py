"""Packing of tokenized documents into windows, by non-negative least squares.

Documents may be cut anywhere, but a cut parts text that belongs together, so only what has to be
cut is.  Whole windows are taken off each document's head; what is left of it, its tail, is
shorter than a window.  The plan is made on the histogram of tails, which has as many rows as a
window has tokens however many documents there are:

1. Combinations of two or three lengths (or one, repeated) that fill a window are listed.
2. How often each is used is fitted to the histogram by non-negative least squares, rounded, and
   held to what the histogram has.
3. Tails left over are packed greedily: next to the longest goes the fullest choice of others, as
   often as there are enough of them, where that fills a window.
4. Tails that fill no window with others are laid one behind the other and cut where a window ends.
   The last of these windows is cut into powers of two, which need no padding.

The result is a table of runs: so many tails of one length, from this rank on, go to these windows
at this offset.  A tail then only needs its rank among those of its length, in any order.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import held, map_batches, schema_of, text_or_empty
from twinfold.session import stage

WINDOW = 1024
SEPARATOR = 0
CACHED_BYTES = 256 << 20  # of words whose ids are kept by a worker
TOGETHER = 8 << 20  # bytes of texts that are encoded together
CACHED_LENGTH = 64
SPECIAL = "<|"  # a text with this may hold a special token and is encoded as a whole
ROUNDS = 400  # of the fit
CLOSE = 1e-4  # of the histogram: change between rounds that ends the fit

# A space before a character that is no white space begins a word of the tokenizer.
WORDS = re.compile(r"(?<=.)(?= \S)", re.DOTALL)
# White space that is neither single nor a pair of line ends, or ends the text; special tokens.
OTHER_SPACE = (
    r"\x{9}\x{b}-\x{d}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
UNEVEN = rf"  | \n|\n |\n\n\n|[ \n]\z|<\||[{OTHER_SPACE}]"
LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
PUNCTUATION = b"!\"#$%&()*+,./:;<=>?@[]^_`{|}~-"

Run = tuple[int, int, int, int, int, int]  # length, first rank, tails, window, each, offset


def _longer(array: np.ndarray, size: int) -> np.ndarray:
    """``array`` with room for ``size`` numbers."""
    if size <= len(array):
        return array
    longer = np.zeros(2 * size, array.dtype)
    longer[: len(array)] = array
    return longer


def _even_words(texts: pa.BinaryArray) -> tuple[pa.BinaryArray, np.ndarray]:
    """Words of texts in which no white space is ``UNEVEN``, and where each text's begin and the last's end.

    A space begins a word, a line end is one.  The words are stretches of the bytes that the texts lie in.
    """
    _, bounds, data = texts.buffers()
    bounds = np.frombuffer(bounds, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    size = int(bounds[-1] - bounds[0])
    if not size:
        return pa.array([], pa.binary()), np.zeros(len(texts) + 1, np.int64)
    data = data.slice(int(bounds[0]), size)
    chars, bounds = np.frombuffer(data, np.uint8), bounds - bounds[0]
    line = chars == ord("\n")
    begins = line | (chars == ord(" "))
    begins[1:] |= line[:-1]
    begins[bounds[bounds < size]] = True
    at = np.append(np.flatnonzero(begins), size).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), data])
    return words, np.searchsorted(at, bounds)


class WordEncoder:
    """Token ids as little-endian bytes, by the tokenizers library.

    A byte-level tokenizer begins a token at a space before a visible character, on either side of a line
    end, and where a letter meets punctuation.  So ids of the stretches between are kept and joined.
    Known words have numbers; the ids of all lie in one array.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.first, self.count = np.zeros(1024, np.int64), np.zeros(1024, np.int64)  # by number
        self.ids = np.zeros(4096, np.uint32)
        self.filled = 0  # of ``ids``
        self.held = 0

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", f.ids).tobytes() for f in found]

    def _add(self, words: list[bytes], ids: list[bytes]) -> None:
        at, n = len(self.known), len(self.known) + len(words)
        joined = np.frombuffer(b"".join(ids), np.uint32)
        self.first, self.count = _longer(self.first, n), _longer(self.count, n)
        self.ids = _longer(self.ids, self.filled + len(joined))
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        self.count[at:n] = counts
        self.first[at:n] = self.filled + np.cumsum(counts) - counts
        self.ids[self.filled : self.filled + len(joined)] = joined
        self.filled += len(joined)
        self.known.update(zip(words, range(at, n)))
        self.held += 200 * len(words) + 4 * len(joined) + sum(map(len, words))

    def _learn(self, words: list[bytes]) -> None:
        cut = {}
        for word in words:
            stem = word.rstrip(PUNCTUATION)
            if stem != word and stem and stem[-1] in LETTERS:
                cut[word] = stem, word[len(stem) :]
        parts = {p for pair in cut.values() for p in pair}.union(w for w in words if w not in cut)
        new = list(parts.difference(self.known))
        self._add(new, self._ids([w.decode() for w in new]))
        new = [w for w in cut if w not in self.known]
        self._add(new, [self._of(cut[w][0]) + self._of(cut[w][1]) for w in new])

    def _of(self, word: bytes) -> bytes:
        number = self.known[word]
        at = self.first[number]
        return self.ids[at : at + self.count[number]].tobytes()

    def _joined(self, words: pa.BinaryArray, bounds: np.ndarray) -> list[bytes]:
        """Ids of each text, whose words are those from its bound to the next."""
        encoded = words.dictionary_encode()
        different = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = list(map(self.known.get, different))
        new = [w for w, n in zip(different, number) if n is None]
        self._learn([w for w in new if len(w) <= CACHED_LENGTH])
        before = len(self.known), self.filled, self.held
        long = [w for w in new if len(w) > CACHED_LENGTH]
        self._add(long, self._ids([w.decode() for w in long]))
        number = np.array([self.known[w] if n is None else n for w, n in zip(different, number)], np.int64)
        each = encoded.indices.to_numpy()
        count = self.count[number][each]
        ends = np.cumsum(count)
        shift = self.first[number][each] - (ends - count)
        places = np.repeat(shift, count)
        places += np.arange(len(places))
        ids = self.ids[places].astype("<u4", copy=False).tobytes()
        for word in long:
            del self.known[word]
        _, self.filled, self.held = before
        at = (4 * np.concatenate([[0], ends])[bounds]).tolist()
        return [ids[a:b] for a, b in zip(at, at[1:])]

    def _uneven(self, texts: list[str]) -> list[bytes]:
        split = [[] if SPECIAL in t else [w.encode() for w in WORDS.split(t)] for t in texts]
        words = pa.array([w for ws in split for w in ws], pa.binary())
        found = self._joined(words, np.cumsum([0, *map(len, split)]))
        return [ids if words else self._ids([t])[0] for t, words, ids in zip(texts, split, found)]

    def each(self, texts: list[str] | pa.StringArray) -> Iterator[bytes]:
        """Ids of each text, some texts at a time."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        a, size = 0, 0
        for b, n in enumerate(pc.binary_length(texts).to_pylist(), 1):
            size += n
            if size >= TOGETHER or b == len(texts):
                yield from self(texts.slice(a, b - a))
                a, size = b, 0

    def __call__(self, texts: list[str] | pa.StringArray) -> list[bytes]:
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        uneven = pc.match_substring_regex(texts, UNEVEN)
        even = iter(self._joined(*_even_words(texts.filter(pc.invert(uneven)).cast(pa.binary()))))
        others = iter(self._uneven(texts.filter(uneven).to_pylist()))
        out = [next(others if odd else even) for odd in uneven.to_pylist()]
        if self.held > CACHED_BYTES:
            self.clear()
        return out


def cut_documents(
    documents: DataFrame, tokenizer_path: str, window: int = WINDOW, with_ids: bool = False
) -> DataFrame:
    """``doc_id, doc_tokens, start, length, ids_crc32, ids, wide``: each document's whole windows and
    its tail, where there is one.

    ``ids`` are bytes of little-endian unsigned numbers, of 32 bits where ``wide`` and else of 16; whole
    windows carry theirs if asked for.  ``ids_crc32`` is over numbers of 32 bits.
    """
    ddl = "doc_id long, doc_tokens long, start long, length int, ids_crc32 long, ids binary, wide boolean"
    names = schema_of(ddl).names

    def start():
        encode = held("window packing", tokenizer_path, lambda: WordEncoder(tokenizer_path))
        end = np.array([SEPARATOR], "<u4").tobytes()

        def step(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {c: [] for c in names}
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode.each(batch.column("text"))):
                ids += end
                n = len(ids) // 4
                for at in range(0, n, window):
                    part = ids[4 * at : 4 * (at + window)]
                    length = len(part) // 4
                    kept, wide = None, False
                    if with_ids or length < window:
                        kept, wide = narrow(part)
                    row = (doc, n, at, length, zlib.crc32(part), kept, wide)
                    for c, value in zip(names, row):
                        out[c].append(value)
            return out

        return step

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return map_batches(rows, ddl, start)


def narrow(ids: bytes) -> tuple[bytes, bool]:
    """Numbers of 32 bits as numbers of 16, if all fit, and whether they do not."""
    numbers = np.frombuffer(ids, "<u4")
    if numbers.max(initial=0) > 0xFFFF:
        return ids, True
    return numbers.astype("<u2").tobytes(), False


def widened(ids: bytes, wide: bool) -> bytes:
    return ids if wide else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Rows of three ascending indexes into the ascending ``lengths``, whose sum is ``window``.

    A combination of two has -1 in the first place.
    """
    at = np.full(window + 1, -1, np.int64)
    at[lengths] = np.arange(len(lengths))
    rest = window - lengths
    two = np.flatnonzero((at[rest] >= 0) & (lengths <= rest))
    found = [np.column_stack([np.full(len(two), -1), two, at[rest[two]]])]
    for i, x in enumerate(lengths.tolist()):
        if 3 * x > window:
            break
        middle = lengths[i:]
        last = window - x - middle
        good = np.flatnonzero(last >= middle)
        good = good[at[last[good]] >= 0]
        found.append(np.column_stack([np.full(len(good), i), i + good, at[last[good]]]))
    return np.concatenate(found)


def fit_counts(shapes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How often each combination is used, none less than never, so that the squared differences
    from ``counts`` are least.

    Differences are weighed by the square root of the count, as in a fit of frequencies.
    Accelerated projected gradients, restarted when they overshoot.
    """
    scale = 1 / np.sqrt(np.maximum(counts, 1.0))
    used = [(shapes[shapes[:, c] >= 0, c], np.flatnonzero(shapes[:, c] >= 0)) for c in range(3)]

    def times(x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(counts))
        for rows, of in used:
            total += np.bincount(rows, x[of], len(counts))
        return total * scale

    def back(r: np.ndarray) -> np.ndarray:
        total = np.zeros(len(shapes))
        for rows, of in used:
            total[of] += (r * scale)[rows]
        return total

    want = counts * scale
    # Steps of each combination's own size; the sum over a row bounds the matrix.
    reach = times(back(np.ones(len(counts)))) if len(shapes) else np.zeros(1)
    step = 1 / max(reach.max(initial=0.0), 1e-12)
    x = np.zeros(len(shapes))
    ahead, momentum, last = x, 1.0, np.inf
    for _ in range(ROUNDS):
        off = times(ahead) - want
        new = np.maximum(ahead - step * back(off), 0)
        loss = float(off @ off)
        if loss > last:
            ahead, momentum, last = x, 1.0, np.inf
            continue
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / following * (new - x)
        change = float(np.abs(new - x).sum())
        x, momentum, last = new, following, loss
        if change <= CLOSE * max(float(x.sum()), 1.0):
            break
    return x


def repeat_counts(shapes: np.ndarray, fitted: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``fitted`` rounded, and held to what ``counts`` has: the most used come first."""
    left = counts.copy()
    used = np.zeros(len(shapes), np.int64)
    wanted = np.rint(fitted).astype(np.int64)
    for k in np.lexsort((np.arange(len(shapes)), -fitted)).tolist():
        if not wanted[k]:
            break
        parts, times = np.unique(shapes[k][shapes[k] >= 0], return_counts=True)
        n = min(int(wanted[k]), int((left[parts] // times).min()))
        used[k] = n
        left[parts] -= n * times
    return used


def fullest(lengths: list[int], left: list[int], largest: int, window: int) -> list[int]:
    """Indexes of the lengths that, with the largest, come nearest to a full window."""
    room = window - lengths[largest]
    mask = (1 << (room + 1)) - 1
    sums, steps = 1, []
    for i in range(largest, -1, -1):
        if lengths[i] > room:
            continue
        for _ in range(min(left[i] - (i == largest), room // lengths[i])):
            wider = sums | (sums << lengths[i]) & mask
            if wider == sums:
                break
            steps.append((i, sums))
            sums = wider
        if sums >> room & 1:
            break
    total, chosen = sums.bit_length() - 1, [largest]
    for i, before in reversed(steps):
        rest = total - lengths[i]
        if rest >= 0 and before >> rest & 1 and not before >> total & 1:
            chosen.append(i)
            total = rest
    return chosen


class Plan:
    """Where the tails of each length go; ``counts`` has the tails per length.

    ``runs`` are those in full windows.  ``stream`` lists (length, first rank, tails, place) of those laid
    one behind the other; place ``x`` of the stream lies in a window by ``position``.
    """

    def __init__(self, counts: dict[int, int], window: int = WINDOW):
        self.window = window
        self.runs: list[Run] = []
        self.windows = 0
        self.stream: list[tuple[int, int, int, int]] = []
        self.total = 0  # tokens of the stream
        lengths = np.array(sorted(x for x, n in counts.items() if n), np.int64)
        self.lengths = lengths.tolist()
        self.left = [counts[x] for x in self.lengths]
        self.taken = [0] * len(self.lengths)
        if len(lengths):
            self._fitted(lengths)
            self._greedy()
        self.stream_from = self.windows
        self.whole = self.total // window  # full windows of the stream
        rest, self.ends = self.total % window, []
        for bit in range(rest.bit_length() - 1, -1, -1):
            if rest >> bit & 1:
                self.ends.append(1 << bit)
        self.windows += self.whole + len(self.ends)

    def _use(self, chosen: list[int], n: int) -> None:
        offset = 0
        for i in chosen:
            self.runs.append((self.lengths[i], self.taken[i], n, self.windows, 1, offset))
            self.taken[i] += n
            self.left[i] -= n
            offset += self.lengths[i]
        self.windows += n

    def _fitted(self, lengths: np.ndarray) -> None:
        shapes = combinations(lengths, self.window)
        counts = np.array(self.left, np.int64)
        used = repeat_counts(shapes, fit_counts(shapes, counts.astype(float)), counts)
        for k in np.flatnonzero(used).tolist():
            self._use([i for i in shapes[k].tolist() if i >= 0], int(used[k]))

    def _greedy(self) -> None:
        for largest in range(len(self.lengths) - 1, -1, -1):
            while self.left[largest]:
                chosen = fullest(self.lengths, self.left, largest, self.window)
                if sum(self.lengths[i] for i in chosen) < self.window:
                    n, x = self.left[largest], self.lengths[largest]
                    self.stream.append((x, self.taken[largest], n, self.total))
                    self.total += n * x
                    self.left[largest] = 0
                    break
                self._use(chosen, min(self.left[i] // chosen.count(i) for i in set(chosen)))

    def position(self, x: int) -> tuple[int, int, int]:
        """(window, offset, tokens to the window's end) of a place of the stream."""
        if x < self.whole * self.window:
            return self.stream_from + x // self.window, x % self.window, self.window - x % self.window
        window, at = self.stream_from + self.whole, self.whole * self.window
        for size in self.ends:
            if x < at + size:
                return window, x - at, at + size - x
            window, at = window + 1, at + size
        raise IndexError(x)

    def places(self) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Per length the first ranks, ascending, and for each (window or place, offset or -1)."""
        by: dict[int, list[tuple[int, int, int]]] = {}
        for length, rank, _, window, _, offset in self.runs:
            by.setdefault(length, []).append((rank, window, offset))
        for length, rank, _, place in self.stream:
            by.setdefault(length, []).append((rank, place, -1))
        return {
            x: (np.array([r[0] for r in sorted(rows)]), np.array([r[1:] for r in sorted(rows)]))
            for x, rows in by.items()
        }

    def of(self, places: dict, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start, tokens, window, offset) of each part of a tail."""
        first, rows = places[length]
        k = int(np.searchsorted(first, rank, "right")) - 1
        number, offset = rows[k].tolist()
        rank -= int(first[k])
        if offset >= 0:
            return [(0, length, number + rank, offset)]
        at, parts = 0, []
        while at < length:
            window, inside, room = self.position(number + rank * length + at)
            n = min(room, length - at)
            parts.append((at, n, window, inside))
            at += n
        return parts


def _counted(tails: DataFrame, window: int) -> DataFrame:
    """Rows with the task's number and their rank by length within the task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seen = np.zeros(window + 1, np.int64)
        task = TaskContext.get().partitionId()
        for batch in batches:
            ranks = []
            for x in batch.column("length").to_pylist():
                ranks.append(int(seen[x]))
                seen[x] += 1
            columns = [*batch.columns, pa.array([task] * len(ranks), pa.int64()), pa.array(ranks, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "task", "rank"])

    schema = type(tails.schema)([*tails.schema.fields]).add("task", "long").add("rank", "long")
    return tails.mapInArrow(count, schema)


def pack_windows(
    documents: DataFrame, tokenizer_path: str, window: int = WINDOW, with_ids: bool = False
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, if
    asked for, ``ids`` (bytes of little-endian unsigned 32-bit numbers).

    Sequences hold at most ``window`` tokens; each is full or holds a power of two, so none needs
    padding.  Null and empty texts are the separator alone.  Rows that repeat an id are packed
    each.  An empty table gives an empty one.  Other columns are not read.  Equal lengths are ranked in
    tasks dealt by range, so a length that a third of all documents has fills several tasks.
    """
    cut = stage(cut_documents(documents, tokenizer_path, window, with_ids))
    # Rows of one length lie together, except those that fill several tasks.
    tails = cut.where(F.col("length") < window).repartitionByRange(
        "length", F.xxhash64("doc_id", "start", "ids_crc32")
    )
    ranked = stage(_counted(tails, window))

    # A row per length and task: lengths and tasks together at most, by the range partitioning.
    per_task = ranked.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts: dict[int, int] = {}
    before: dict[tuple[int, int], int] = {}
    for task, length, n in sorted(map(tuple, per_task)):
        before[task, length] = counts.get(length, 0)
        counts[length] = counts.get(length, 0) + n
    plan = Plan(counts, window)

    out = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
        "offset long" + ", ids binary" * with_ids
    )
    names = schema_of(out).names
    read = ("doc_id", "doc_tokens", "start", "ids_crc32", "ids", "wide", "length", "task", "rank")

    def start():
        places = plan.places()

        def step(batch: pa.RecordBatch) -> dict:
            found: dict[str, list] = {c: [] for c in names}
            columns = (batch.column(c).to_pylist() for c in read)
            for doc, tokens, first, checksum, ids, wide, length, task, rank in zip(*columns):
                parts = plan.of(places, length, rank + before[task, length])
                whole = widened(ids, wide) if with_ids or len(parts) > 1 else b""
                for at, n, sequence, offset in parts:
                    piece = whole[4 * at : 4 * (at + n)]
                    crc = checksum if len(parts) == 1 else zlib.crc32(piece)
                    # ``ids`` comes last and is left out by ``zip`` where it is not asked for.
                    row = (doc, first + at, n, crc, tokens, sequence, offset, piece)
                    for c, value in zip(names, row):
                        found[c].append(value)
            return found

        return step

    placed = map_batches(ranked, out, start)

    def widen():
        def step(batch: pa.RecordBatch) -> dict:
            found = {c: batch.column(c) for c in names}
            kept = zip(batch.column("ids").to_pylist(), batch.column("wide").to_pylist())
            found["ids"] = [widened(*k) for k in kept]
            return found

        return step

    # A full window is a sequence by itself; its number need not follow the others.
    alone = cut.where(F.col("length") == window).select(
        "doc_id",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        (F.monotonically_increasing_id() + plan.windows).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        *(["ids", "wide"] * with_ids),
    )
    return placed.unionByName(map_batches(alone, out, widen) if with_ids else alone)
