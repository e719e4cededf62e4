"""Best-fit packing of tokenized documents into sequences, by linear grouping.

The plan is made on the histogram of lengths, which has as many rows as a sequence has
tokens however many documents there are:

1. Lengths above ``small`` are sorted and cut into groups of equal cardinality; each is
   rounded up to the longest of its group.
2. For these few sizes configurations are chosen, each with the subset of remaining
   sizes that fills a sequence best next to the largest one, and used as often as the
   counts allow.
3. Actual lengths take the place of the rounded ones, which leaves exact gaps.
4. Small lengths, longest first, go to the tightest gap that holds them.

The result is a table of runs: so many pieces of one length, from this rank on, go to these
sequences at this offset.  Every piece then only needs its rank among the pieces of its
length, in any order: a range partitioning, a running count in each task and one small
table of counts per task give it, without a sort in one place.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import held, map_batches, text_or_empty
from twinfold.session import stage

CAPACITY = 2048
SEPARATOR = 0
CACHED_WORDS = 1_000_000
TOGETHER = 1000  # new words that are encoded together
PUNCTUATION = "!\"#$%&()*+,./:;=?@[]^_`{|}~-"
CACHED_LENGTH = 64
SPECIAL = "<|"  # a text with this may hold a special token and is encoded as a whole

Run = tuple[int, int, int, int, int, int]  # length, first rank, pieces, sequence, each, offset


class Encoder:
    """Token ids as little-endian bytes.

    No token spans white space or the place where a letter meets punctuation, and A-Z
    count as a-z.  So ids of words are kept and joined; the library encodes each new
    word, many at a time, and offsets tell whose tokens they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), TOGETHER):
            some = words[at : at + TOGETHER]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            starts = np.cumsum([0, *(len(w) + 1 for w in some)])
            cuts = np.searchsorted(np.array([a for a, _ in found.offsets], np.int64), starts)
            for word, a, b in zip(some, cuts.tolist(), cuts[1:].tolist()):
                self.known[word] = ids[a:b].tobytes()

    def _add(self, words: set[str]) -> None:
        new = [w for w in words.difference(self.known) if len(w) <= CACHED_LENGTH]
        if len(self.known) + 2 * len(new) > CACHED_WORDS:
            self.known = {"": b""}
            new = [w for w in words if 0 < len(w) <= CACHED_LENGTH]
        cut = {}
        for word in new:
            stem = word.rstrip(PUNCTUATION)
            if stem and stem != word and "a" <= stem[-1] <= "z":
                cut[word] = stem, word[len(stem) :]
        parts = {p for pair in cut.values() for p in pair}.union(w for w in new if w not in cut)
        self._learn(list(parts.difference(self.known)))
        for word, (stem, end) in cut.items():
            self.known[word] = self.known[stem] + self.known[end]

    def __call__(self, text: str) -> bytes:
        if SPECIAL in text:
            return self._whole(text)
        words = text.encode().lower().decode().replace("\n", " ").split(" ")
        if not self.known.keys() >= (different := {*words}):
            self._add(different)
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:  # long words are not kept
            known = self.known
            return b"".join(known[w] if w in known else self._whole(w) for w in words)


def encoder(path: str) -> Encoder:
    """One for all tasks of a worker, which keeps the words it has met."""
    return held("packing", path, lambda: Encoder(path))


def pieces(
    documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` (bytes of
    little-endian unsigned 32-bit numbers).

    A null text is an empty one; the separator after each document belongs to it, so
    every document has at least one piece.
    """
    columns = "doc_id long, piece int, start long, length long, ids_crc32 long"

    def start():
        encode, end = encoder(tokenizer_path), np.array([SEPARATOR], "<u4").tobytes()

        def step(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {c.split()[0]: [] for c in columns.split(", ")}
            out["ids"] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encode(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out["doc_id"].append(doc)
                    out["piece"].append(k)
                    out["start"].append(at // 4)
                    out["length"].append(len(part) // 4)
                    out["ids_crc32"].append(zlib.crc32(part))
                    if with_ids:
                        out["ids"].append(part)
            return out

        return step

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return map_batches(rows, columns + ", ids binary" * with_ids, start)


def _configuration(sizes: list[int], left: list[int], capacity: int) -> list[int]:
    """Sizes (indexes, ascending sizes) of the fullest sequence with the largest size left."""
    largest = max(i for i, n in enumerate(left) if n)
    room = capacity - sizes[largest]
    chosen = [largest]
    mask = (1 << (room + 1)) - 1
    sums, steps = 1, []
    for i, size in enumerate(sizes):
        if size > room:
            break
        for _ in range(min(left[i] - (i == largest), room // size)):
            wider = sums | (sums << size) & mask
            if wider == sums:
                break
            steps.append((i, sums))
            sums = wider
    total = sums.bit_length() - 1
    for i, before in reversed(steps):
        rest = total - sizes[i]
        if rest >= 0 and before >> rest & 1:
            chosen.append(i)
            total = rest
    return chosen


def _configurations(
    sizes: list[int], counts: list[int], capacity: int
) -> Iterator[tuple[list[int], int]]:
    """(indexes of sizes, how often) until all counts are used."""
    left = list(counts)
    while any(left):
        chosen = _configuration(sizes, left, capacity)
        use = {i: chosen.count(i) for i in chosen}
        often = min(left[i] // n for i, n in use.items())
        for i, n in use.items():
            left[i] -= n * often
        yield chosen, often


class _Gaps:
    """Runs of sequences by how much room they have left."""

    def __init__(self):
        self.rooms: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def add(self, room: int, sequence: int, n: int) -> None:
        if n and room:
            if room not in self.runs:
                insort(self.rooms, room)
                self.runs[room] = []
            self.runs[room].append((sequence, n))

    def tightest(self, length: int) -> tuple[int, int, int] | None:
        at = bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        sequence, n = self.runs[room].pop()
        if not self.runs[room]:
            del self.runs[room], self.rooms[at]
        return room, sequence, n


def best_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """The plan with the fewest sequences over a few numbers of groups and limits of small."""
    settings = [(512, capacity // 3), (2048, capacity // 3), (2048, capacity // 2)]
    plans = [plan(counts, capacity, groups, small) for groups, small in settings]
    return min(plans, key=lambda runs: max((r[3] + -(-r[2] // r[4]) for r in runs), default=0))


def plan(counts: dict[int, int], capacity: int, groups: int, small: int) -> list[Run]:
    """Where the pieces of each length go; ``counts`` has the pieces per length.

    A run (length, first rank, pieces, sequence, each, offset): piece ``i`` of the run lies in
    sequence ``sequence + i // each`` at ``offset + i % each * length``.
    """
    runs: list[Run] = []
    gaps, used = _Gaps(), 0

    # Large lengths, longest first; a place in this order is a length and a rank.
    lengths = sorted((x for x, n in counts.items() if n and x > small), reverse=True)
    ends = np.cumsum([counts[x] for x in lengths]).tolist() if lengths else []
    total = ends[-1] if ends else 0
    share = -(-total // groups) if total else 1
    sizes: dict[int, int] = {}
    first: dict[int, int] = {}  # the next place of each rounded size
    for at in range(0, total, share):
        size = lengths[next(i for i, e in enumerate(ends) if e > at)]
        first.setdefault(size, at)
        sizes[size] = sizes.get(size, 0) + min(share, total - at)
    ascending = sorted(sizes)

    def stretch(place: int, n: int) -> Iterator[tuple[int, int, int]]:
        """(length, first rank, pieces) of ``n`` places from ``place`` on."""
        i = int(np.searchsorted(ends, place, "right"))
        while n:
            take = min(n, ends[i] - place)
            yield lengths[i], place - (ends[i] - counts[lengths[i]]), take
            place, n, i = place + take, n - take, i + 1

    for chosen, often in _configurations(ascending, [sizes[s] for s in ascending], capacity):
        slots = []
        for i in chosen:
            slots.append(list(stretch(first[ascending[i]], often)))
            first[ascending[i]] += often
        done = 0
        while done < often:  # as far as the length in every slot stays the same
            n = min(s[0][2] for s in slots)
            offset = 0
            for s in slots:
                length, rank, rest = s[0]
                runs.append((length, rank, n, used + done, 1, offset))
                offset += length
                if rest == n:
                    s.pop(0)
                else:
                    s[0] = (length, rank + n, rest - n)
            gaps.add(capacity - offset, used + done, n)
            done += n
        used += often

    for length in sorted((x for x, n in counts.items() if n and x <= small), reverse=True):
        rank, left = 0, counts[length]
        while left:
            gap = gaps.tightest(length)
            if gap is None:
                n = -(-left // (capacity // length))
                gap, used = (capacity, used, n), used + n
            room, sequence, n = gap
            each = room // length
            full = min(n, left // each)
            if full:
                runs.append((length, rank, full * each, sequence, each, capacity - room))
                gaps.add(room - each * length, sequence, full)
                rank, left = rank + full * each, left - full * each
            if full < n and left < each:
                if left:
                    runs.append((length, rank, left, sequence + full, left, capacity - room))
                    gaps.add(room - left * length, sequence + full, 1)
                    full, left = full + 1, 0
                gaps.add(room, sequence + full, n - full)
    return runs


class _Runs:
    """The runs as arrays, looked up by length and rank."""

    def __init__(self, runs: list[Run]):
        rows = np.array(sorted(runs), np.int64).reshape(-1, 6)
        self.lengths, first = np.unique(rows[:, 0], return_index=True)
        self.first = np.append(first, len(rows))
        self.rows = rows

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.empty(len(length), np.int64)
        for x in np.unique(length):
            i = int(np.searchsorted(self.lengths, x))
            low, high = self.first[i], self.first[i + 1]
            mine = length == x
            at[mine] = low + np.searchsorted(self.rows[low:high, 1], rank[mine], "right") - 1
        _, start, _, sequence, each, offset = self.rows[at].T
        i = rank - start
        return sequence + i // each, offset + i % each * length


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` (with ``length``, at least 1 and at most ``capacity``) and their ``sequence_id`` and
    ``offset``.  Columns of these names are replaced."""
    rows = rows.drop("sequence_id", "offset")
    names = rows.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with the task's number and their rank by length within the task."""
        from pyspark import TaskContext

        seen = np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            order = np.argsort(length, kind="stable")
            values, first, n = np.unique(length[order], return_index=True, return_counts=True)
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - np.repeat(first, n) + np.repeat(seen[values], n)
            seen[values] += n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(length), part)), pa.array(rank)],
                names=[*names, "pack_part", "pack_rank"],
            )

    # Equal lengths lie together, except those that fill several tasks.
    dealt = rows.repartitionByRange("length", F.xxhash64(*names))
    schema = rows.schema
    for extra in ("pack_part", "pack_rank"):
        schema = type(schema)([*schema.fields]).add(extra, "long")
    ranked = stage(dealt.mapInArrow(count, schema))

    # A row per length and task: lengths and tasks together at most, by the range partitioning.
    per_task = (
        ranked.groupBy("pack_part", "length")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("length", "pack_part")
        .collect()
    )
    counts: dict[int, int] = {}
    before: dict[tuple[int, int], int] = {}
    for part, length, n in per_task:
        before[part, length] = counts.get(length, 0)
        counts[length] = counts.get(length, 0) + n
    runs = best_plan(counts, capacity)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Runs(runs)
        for batch in batches:
            if not len(batch):
                continue
            length, part, rank = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "pack_part", "pack_rank")
            )
            ahead = np.fromiter((before[k] for k in zip(part.tolist(), length.tolist())), np.int64, len(batch))
            sequence, offset = table.place(length, rank + ahead)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    schema = rows.schema
    for extra in ("sequence_id", "offset"):
        schema = type(schema)([*schema.fields]).add(extra, "long")
    return ranked.mapInArrow(place, schema)


def pack_documents(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Null and empty texts are the separator alone.  Rows that repeat a ``doc_id`` are
    packed each.  An empty table gives an empty one.  Other columns are not read.
    """
    return pack(stage(pieces(documents, tokenizer_path, capacity)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` (bytes) of packed pieces that carry their ``ids``.

    A sequence holds at most its capacity, so a group is bounded.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.array_join(F.transform(parts, lambda p: F.hex(p["ids"])), "")
    return packed.groupBy("sequence_id").agg(F.unhex(joined).alias("ids"))
