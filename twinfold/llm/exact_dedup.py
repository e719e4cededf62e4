"""Exact duplicates through a cuckoo-filter index of live digests.

Rows are dealt by digest.  Every task holds one ``CuckooIndex``: four-slot
buckets of 16-bit tags, each next to the number of the stored key it stands for.
A tag that does not occur proves a digest new; a tag that occurs is checked
against the keys stored in those two buckets.  The first pass, before the
shuffle, leaves one row per digest and task, so a text that a third of all rows
share reaches the second pass as one row per task.  An index grows by doubling
its buckets and re-entering the stored keys; it can also delete, which
``remove`` uses to withdraw rows from a written index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import row_key, text_or_empty
from twinfold.session import stage

SLOTS = 4
MAX_KICKS = 200
FLUSH_KEYS = 500_000  # keys a task of the first pass holds before it hands them on

GROUP = "digest string, keep_id long, group_size long"


class CuckooIndex:
    """Live digests with a count and the largest id of each."""

    def __init__(self, buckets: int = 64):
        self.keys: list[bytes | None] = []
        self.best: list[int | None] = []
        self.count: list[int] = []
        self.free: list[int] = []
        self._table(buckets)

    def _table(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.slots: list[list[tuple[int, int]]] = [[] for _ in range(buckets)]

    @staticmethod
    def _spread(tag: int) -> int:
        return (tag * 0x5BD1E995) & 0xFFFFFFFF

    def _places(self, key: bytes) -> tuple[int, int, int]:
        tag = int.from_bytes(key[8:10], "little") or 1
        first = int.from_bytes(key[:8], "little") & self.mask
        return tag, first, (first ^ self._spread(tag)) & self.mask

    def find(self, key: bytes) -> int | None:
        """The number of the stored key, after the check that follows a tag's hit."""
        tag, first, second = self._places(key)
        for place in (first, second):
            for have, number in self.slots[place]:
                if have == tag and self.keys[number] == key:
                    return number
        return None

    def add(self, key: bytes, row_id: int | None, rows: int = 1) -> None:
        number = self.find(key)
        if number is None:
            number = self.free.pop() if self.free else len(self.keys)
            if number == len(self.keys):
                self.keys.append(key)
                self.best.append(row_id)
                self.count.append(rows)
            else:
                self.keys[number], self.best[number], self.count[number] = key, row_id, rows
            if not self._enter(key, number):
                self._grow()
            return
        self.count[number] += rows
        if row_id is not None and (self.best[number] is None or row_id > self.best[number]):
            self.best[number] = row_id

    def _enter(self, key: bytes, number: int) -> bool:
        tag, first, second = self._places(key)
        for place in (first, second):
            if len(self.slots[place]) < SLOTS:
                self.slots[place].append((tag, number))
                return True
        place = second
        for kick in range(MAX_KICKS):
            slot = kick % SLOTS
            (tag, number), self.slots[place][slot] = self.slots[place][slot], (tag, number)
            place = (place ^ self._spread(tag)) & self.mask
            if len(self.slots[place]) < SLOTS:
                self.slots[place].append((tag, number))
                return True
        return False

    def _grow(self) -> None:
        """Double the buckets until all stored keys find a place."""
        live = [(k, n) for n, k in enumerate(self.keys) if k is not None]
        buckets = self.mask + 1
        while True:
            buckets *= 2
            self._table(buckets)
            if all(self._enter(k, n) for k, n in live):
                return

    def delete(self, key: bytes) -> bool:
        """Take a live digest out; False if it is not live."""
        number = self.find(key)
        if number is None:
            return False
        tag, first, second = self._places(key)
        for place in (first, second):
            if (tag, number) in self.slots[place]:
                self.slots[place].remove((tag, number))
                break
        self.keys[number] = None
        self.free.append(number)
        return True

    def live(self) -> tuple[list[bytes], list[int | None], list[int]]:
        numbers = [n for n, k in enumerate(self.keys) if k is not None]
        return (
            [self.keys[n] for n in numbers],
            [self.best[n] for n in numbers],
            [self.count[n] for n in numbers],
        )

    def __len__(self) -> int:
        return len(self.keys) - len(self.free)


def _batch(index: CuckooIndex) -> pa.RecordBatch:
    keys, best, count = index.live()
    return pa.RecordBatch.from_arrays(
        [
            pa.array([k.hex() for k in keys], pa.string()),
            pa.array(best, pa.int64()),
            pa.array(count, pa.int64()),
        ],
        names=["digest", "keep_id", "group_size"],
    )


def _gather(flush_keys: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CuckooIndex()
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("digest", "keep_id", "group_size")]
            for digest, row_id, rows in zip(*columns):
                index.add(bytes.fromhex(digest), row_id, rows)
            if flush_keys and len(index) >= flush_keys:
                yield _batch(index)
                index = CuckooIndex()
        yield _batch(index)

    return run


def digest_of(text: Column) -> Column:
    """SHA-256 (lower-case hex) of a text after lower-casing A-Z; null counts as empty."""

    @F.arrow_udf("string")
    def digest(texts: pa.Array) -> pa.Array:
        sha = hashlib.sha256
        return pa.array(
            [sha(t.encode().lower()).hexdigest() for t in texts.to_pylist()], pa.string()
        )

    return digest(text)


def build_index(digests: DataFrame) -> DataFrame:
    """One row per live digest: ``digest, keep_id`` (largest id), ``group_size``.

    ``digests`` has ``digest`` and ``doc_id``, one row per document.
    """
    rows = digests.select(
        "digest", F.col("doc_id").cast("long").alias("keep_id"), F.lit(1).cast("long").alias("group_size")
    )
    return merge(rows.mapInArrow(_gather(FLUSH_KEYS), GROUP))


def merge(*parts: DataFrame) -> DataFrame:
    """The index of several part indexes; insertion is a merge with an index of the new rows."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.repartition(F.col("digest")).mapInArrow(_gather(None), GROUP)


def remove(index: DataFrame, digests: DataFrame) -> DataFrame:
    """``index`` without the digests that ``digests`` names.  Unknown ones are ignored."""
    marked = index.select("*", F.lit(False).alias("gone")).unionByName(
        digests.select(
            "digest",
            F.lit(None).cast("long").alias("keep_id"),
            F.lit(0).cast("long").alias("group_size"),
            F.lit(True).alias("gone"),
        ).distinct()
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        live, gone = CuckooIndex(), []
        for batch in batches:
            rows = [batch.column(c).to_pylist() for c in ("digest", "keep_id", "group_size", "gone")]
            for digest, row_id, size, out in zip(*rows):
                if out:
                    gone.append(bytes.fromhex(digest))
                else:
                    live.add(bytes.fromhex(digest), row_id, size)
        for key in gone:
            live.delete(key)
        yield _batch(live)

    return marked.repartition(F.col("digest")).mapInArrow(run, GROUP)


def exact_dedup(documents: DataFrame, keyed: bool = False) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; a null text is an empty
    one.  The largest ``doc_id`` of equal texts stays.  Repeated rows of a ``doc_id``
    each count and share its decision.  A null ``doc_id`` only stays where no row
    of its group has an id.  Other columns are not read.  ``keyed`` adds the
    ``row_key`` of each row.
    """
    key = ["row_key"] if keyed else []
    rows = stage(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            *(row_key().alias(k) for k in key),
            digest_of(text_or_empty()).alias("digest"),
        )
    )
    # Joined on the digest: a hot digest is many rows on this side and one on the other,
    # which adaptive execution splits.
    return rows.join(build_index(rows), "digest").select(
        "doc_id",
        *key,
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
