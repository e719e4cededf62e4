"""Near duplicates by SimHash, found with BK-trees.

A fingerprint has 64 bits.  Two that differ in at most ``radius`` bits agree in all
but ``radius`` of any ``BLOCKS`` blocks they are cut into; so each fingerprint goes to
one shard for each choice of ``BLOCKS - radius`` blocks, named by their bits, and
every linked pair meets in a shard.  Each shard is a BK-tree whose children are keyed
by their Hamming distance to the parent; a search follows only the edges within the
radius of the distance at hand.

A tree is sent to the tasks that search it and no further: one broadcast of the
trees of all shards would grow with the corpus.  A shard of more than ``TILE``
fingerprints is cut into tiles, and each pair of tiles is a tree and its searches in
a task's own row group, so no task holds more than ``2 * TILE`` of one shard.

Equal fingerprints are one vertex.  A tile gives a spanning forest of the links it finds,
not the links, so a group of thousands of near copies gives thousands of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import map_batches, row_key, text_or_empty
from twinfold.llm.components import components
from twinfold.session import stage

BLOCKS = 6
TILE = 4096
SEARCHES = 1024  # searches that walk the trees together
CHUNK = 1 << 16  # shingles whose bits are counted together


def fingerprint(text: str, shingle: int = 4) -> int:
    """The SimHash of the word shingles of ``text``, unsigned.

    Words are what ASCII white space parts, after lower-casing A-Z.  Fewer words than a
    shingle are one shingle; no words give zero.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(words) - shingle, 0)
    first_byte = starts[: last + 1].tolist()
    last_byte = ends[min(shingle, len(words)) - 1 :].tolist()
    ones, hashed = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, last + 1, CHUNK):
        spans = zip(first_byte[at : at + CHUNK], last_byte[at : at + CHUNK])
        h = np.array([hashed(joined[s:e], 42) for s, e in spans], np.dtype("<u8"))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > last + 1, bitorder="little").tobytes(), "little")


def fingerprints(documents: DataFrame, shingle: int = 4, keyed: bool = False) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long); a null text is an empty one.

    ``keyed`` adds the ``row_key``.
    """
    key = ["row_key"] if keyed else []

    def start():
        def step(batch: pa.RecordBatch) -> dict:
            found = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            return {
                "doc_id": batch.column("doc_id"),
                "fp": np.array(found, np.uint64).view(np.int64),
                **{k: batch.column(k) for k in key},
            }

        return step

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_or_empty().alias("text"),
        *(row_key().alias(k) for k in key),
    )
    return map_batches(rows, ", ".join(["doc_id long, fp long", *(f"{k} string" for k in key)]), start)


class BKForest:
    """The BK-trees of several shards, built and searched level by level for all at once.

    ``shard`` tells for each fingerprint its shard, as numbers that do not decrease.
    """

    def __init__(self, shard: np.ndarray, fps: np.ndarray):
        self.fps = fps
        self.shards, self.roots = np.unique(shard, return_index=True)
        items = np.setdiff1d(np.arange(len(fps)), self.roots, assume_unique=True)
        at = self.roots[np.searchsorted(self.shards, shard[items])]
        edges, children = [], []
        while len(items):
            # An item that finds its edge taken moves to the child there; the first takes it.
            edge = at * 65 + np.bitwise_count(fps[items] ^ fps[at])
            taken, first, which = np.unique(edge, return_index=True, return_inverse=True)
            edges.append(taken)
            children.append(items[first])
            at = items[first][which]
            stays = np.ones(len(items), bool)
            stays[first] = False
            items, at = items[stays], at[stays]
        self.edges = np.concatenate(edges) if edges else np.empty(0, np.int64)
        self.children = np.concatenate(children) if children else np.empty(0, np.int64)
        order = np.argsort(self.edges)
        self.edges, self.children = self.edges[order], self.children[order]

    def search(
        self, shard: np.ndarray, fps: np.ndarray, radius: int
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (search, node) within ``radius`` bits, in portions."""
        place = np.searchsorted(self.shards, shard)
        place[place == len(self.shards)] = 0
        known = np.flatnonzero(self.shards[place] == shard) if len(self.shards) else []
        for at in range(0, len(known), SEARCHES):
            q = known[at : at + SEARCHES]
            node = self.roots[place[q]]
            while len(q):
                d = np.bitwise_count(fps[q] ^ self.fps[node]).astype(np.int64)
                near = d <= radius
                yield q[near], node[near]
                low = np.searchsorted(self.edges, node * 65 + np.maximum(d - radius, 0))
                high = np.searchsorted(self.edges, node * 65 + np.minimum(d + radius, 64), "right")
                n = high - low
                q = np.repeat(q, n)
                first = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n)
                node = self.children[first + np.arange(len(q))]


def _join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links ``a - b``: the smallest index of each connected set."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels = further


def forest_links(
    shard: np.ndarray, fps: np.ndarray, role: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within each shard, as pairs of fingerprints.

    ``role``: 1 node of the tree, 2 search, 3 both.
    """
    nodes, searches = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
    labels = np.arange(len(fps))
    tree = BKForest(shard[nodes], fps[nodes])
    for q, node in tree.search(shard[searches], fps[searches], radius):
        labels = _join_labels(labels, searches[q], nodes[node])
    moved = np.flatnonzero(labels != np.arange(len(fps)))
    return fps[moved], fps[labels[moved]]


def _blocks(blocks: int) -> list[tuple[int, int]]:
    """First bit and width of each block of a fingerprint."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def shards_of(fps: np.ndarray, radius: int, blocks: int = BLOCKS) -> np.ndarray:
    """A row of shard numbers for each fingerprint: one per choice of blocks."""
    parts = [
        (fps >> np.uint64(at)) & np.uint64((1 << width) - 1) for at, width in _blocks(blocks)
    ]
    width = max(w for _, w in _blocks(blocks))
    columns = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        key = np.full(len(fps), number, np.uint64)
        for block in chosen:
            key = (key << np.uint64(width)) | parts[block]
        columns.append(key.view(np.int64))
    return np.stack(columns, axis=1)


def _sharded(vertices: DataFrame, radius: int) -> DataFrame:
    """``shard, fp``, a row for each shard a fingerprint goes to."""

    def start():
        def step(batch: pa.RecordBatch) -> dict:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            shards = shards_of(fps.view(np.uint64), radius)
            return {"shard": shards.ravel(), "fp": np.repeat(fps, shards.shape[1])}

        return step

    return map_batches(vertices.select("fp"), "shard long, fp long", start)


def _tiled(rows: DataFrame) -> DataFrame:
    """Rows with the tiles they take part in: ``shard, tree, searching, fp, role``."""
    large = (
        rows.groupBy("shard")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > TILE)
        .select("shard", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    )
    tiles = F.coalesce("tiles", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    dealt = rows.join(large, "shard", "left").select(
        "shard", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other")
    )
    return dealt.select(
        "shard",
        F.least("own", "other").alias("tree"),
        F.greatest("own", "other").alias("searching"),
        "fp",
        F.when(F.col("own") == F.col("other"), 3)
        .when(F.col("own") < F.col("other"), 1)
        .otherwise(2)
        .cast("int")
        .alias("role"),
    )


def _forests(radius: int):
    cell = ["shard", "tree", "searching"]

    def links(batch: pa.Table) -> pa.RecordBatch:
        columns = {c: batch.column(c).to_numpy() for c in [*cell, "fp", "role"]}
        changes = np.zeros(len(batch), bool)
        for c in cell:
            changes[1:] |= columns[c][1:] != columns[c][:-1]
        group = np.cumsum(changes)
        keep = np.bincount(group)[group] > 1  # a fingerprint alone has no links
        a, b = forest_links(
            group[keep], columns["fp"][keep].view(np.uint64), columns["role"][keep], radius
        )
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole cells at a time; a cell that a batch cuts waits for its rest."""
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            same = np.ones(len(batch), bool)
            for c in cell:
                values = batch.column(c).to_numpy()
                same &= values == values[-1]
            cut = len(batch) - int(np.argmin(same[::-1])) if not same.all() else 0
            head = batch.slice(0, cut)
            goes_on = waiting and all(
                waiting[-1].column(c)[-1].as_py() == batch.column(c)[-1].as_py() for c in cell
            )
            if cut or (waiting and not goes_on):
                yield links(pa.Table.from_batches([*waiting, head]))
                waiting = []
            waiting.append(batch.slice(cut))
        if waiting:
            yield links(pa.Table.from_batches(waiting))

    return run


def near_links(vertices: DataFrame, radius: int = 4) -> DataFrame:
    """Links ``a, b`` that connect the fingerprints (``fp``, all different) within ``radius``
    bits of each other, directly or over others, and no more than these."""
    cells = _tiled(stage(_sharded(vertices, radius)))
    cell = ["shard", "tree", "searching"]
    dealt = cells.repartition(*cell).sortWithinPartitions(*cell)
    return dealt.mapInArrow(_forests(radius), "a long, b long")


def simhash_components(
    documents: DataFrame, shingle: int = 4, radius: int = 4, keyed: bool = False
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits), ``component_id``.

    Documents whose fingerprints differ in at most ``radius`` bits are linked;
    ``component_id`` is the smallest ``doc_id`` reachable.  Null and empty texts have
    the fingerprint zero and are linked like any other.  Repeated rows are linked to
    each other.  A null ``doc_id`` only names a component without any id.  Other
    columns are not read.  ``keyed`` adds the ``row_key`` of each row and ``root``, the
    fingerprint that names its component, as ids may be null or repeated.
    """
    rows = stage(fingerprints(documents, shingle, keyed))
    vertices = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = stage(components(near_links(vertices, radius)))
    rooted = vertices.join(
        roots.select(F.col("vertex").alias("fp"), "root"), "fp", "left"
    ).withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    extra = ["row_key", "root"] if keyed else []
    named = rooted.join(least, "root").select("fp", "component_id", *extra[1:])
    return rows.join(named, "fp").select(
        "doc_id", *extra, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
