"""An interpolated modified Kneser-Ney bigram model, kept as sorted hash arrays.

Words are known by 64-bit hashes.  Tasks count n-grams in NumPy arrays and hand on one
sorted block per shard; shards add the blocks up and write their part of the model as
files of sorted keys with values, which workers map into memory and search by
bisection.  Words are sharded by hash, bigrams by the hash of their first word; bigrams of
a first word with more than a shard's share of all tokens are spread over several
shards, whose sums for that word are added up afterwards.

With c(v w) the count of a bigram, N(. w) the number of different words before w, N(. .) that
of different bigrams, and D the discount for a count of 1, 2 or more:

    p(w | v) = (c(v w) - D(c)) / c(v .) + g(v) p(w)      p(w) = (N(. w) - D'(N)) / N(. .) + g' / (V + 1)

where g gives the discounted mass back, V counts the words met, and the last term is shared
with one unknown word.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import map_batches, text_or_empty
from twinfold.llm.language import remainder
from twinfold.llm.storage import local_path, new_folder
from twinfold.session import stage

BEGIN = np.uint64(xxhash.xxh64_intdigest(b" begin"))
END = np.uint64(xxhash.xxh64_intdigest(b" end"))  # no word has a space
FLUSH = 3_000_000  # tokens a task holds before it hands their counts on
SHARD_TOKENS = 4_000_000  # tokens of the corpus per shard of the model

WORD = np.dtype([("key", "<u8"), ("n", "<u8")])
PAIR = np.dtype([("a", "<u8"), ("b", "<u8"), ("n", "<u4")])  # of one flush
SUM = np.dtype([("a", "<u8"), ("b", "<u8"), ("n", "<u8")])
MOST = 2**32 - 1  # a count in the files from which on it stands in an array of its own


def token_hashes(text: str) -> np.ndarray:
    """Hashes of the lower-cased words and of one end."""
    words = text.encode().lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out[-1] = END
    return out


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two."""
    x = (a ^ (a >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of the upper half of the hash."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def summed_words(rows: np.ndarray) -> np.ndarray:
    """Rows of WORD with different, ascending keys."""
    keys, which = np.unique(rows["key"], return_inverse=True)
    out = np.empty(len(keys), WORD)
    out["key"], out["n"] = keys, np.bincount(which, rows["n"], minlength=len(keys))
    return out


def summed_pairs(rows: np.ndarray) -> np.ndarray:
    """Rows of SUM with different, ascending pairs."""
    rows = rows[np.lexsort((rows["b"], rows["a"]))]
    if not len(rows):
        return rows.astype(SUM)
    new = np.ones(len(rows), bool)
    new[1:] = (rows["a"][1:] != rows["a"][:-1]) | (rows["b"][1:] != rows["b"][:-1])
    first = np.flatnonzero(new)
    out = rows[first].astype(SUM)
    out["n"] = np.add.reduceat(rows["n"].astype(np.uint64), first)
    return out


def counts_of_counts(n: np.ndarray) -> np.ndarray:
    return np.array([(n == k).sum() for k in (1, 2, 3, 4)], np.int64)


def discounts(times: np.ndarray) -> np.ndarray:
    """Discounts for counts of 1, 2 and more, from how many counts are 1, 2, 3 and 4."""
    n1, n2, n3, n4 = (float(t) for t in times)
    if not n1 or not n2 or not n3:
        return np.array([0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    d = np.array([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(d, 0.05, [0.95, 1.95, 2.95])


def blocks_by_shard(rows: np.ndarray, shard: np.ndarray, parts: list) -> None:
    order = np.argsort(shard, kind="stable")
    rows, shard = rows[order], shard[order]
    at = np.flatnonzero(np.diff(shard, prepend=-1)) if len(shard) else np.empty(0, np.int64)
    for a, b in zip(at, [*at[1:], len(rows)]):
        parts.append((int(shard[a]), rows[a:b].tobytes()))


def _blocks(parts: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.binary())],
        names=["shard", "block"],
    )


class Hot:
    """First words that need several cells, and how many."""

    def __init__(self, words: list[tuple[int, int]]):
        words = sorted((int(np.int64(k).view(np.uint64)), n) for k, n in words)
        self.keys = np.array([w[0] for w in words], np.uint64)
        self.cells = np.array([w[1] for w in words], np.uint64)

    def shard(self, a: np.ndarray, b: np.ndarray, shards: int) -> np.ndarray:
        key = a
        if len(self.keys):
            at = np.searchsorted(self.keys, a).clip(max=len(self.keys) - 1)
            hot = self.keys[at] == a
            cell = mixed(b, a) % self.cells[at]
            key = np.where(hot, mixed(a, cell), a)
        return shard_of(mixed(key, np.zeros_like(key)), shards)


def _count(texts: DataFrame, shards: int, hot: Hot | None) -> DataFrame:
    """Blocks of the counts of words (``hot`` None) or bigrams, a row per shard and flush."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0

        def flush() -> pa.RecordBatch:
            nonlocal n
            parts: list = []
            if hot is None:
                keys, times = np.unique(np.concatenate(held), return_counts=True)
                rows = np.empty(len(keys), WORD)
                rows["key"], rows["n"] = keys, times
                blocks_by_shard(rows, shard_of(keys, shards), parts)
            else:
                rows = np.empty(n, PAIR)
                at = 0
                for h in held:
                    rows["a"][at], rows["a"][at + 1 : at + len(h)] = BEGIN, h[:-1]
                    rows["b"][at : at + len(h)], at = h, at + len(h)
                rows["n"] = 1
                rows = summed_pairs(rows).astype(PAIR)
                blocks_by_shard(rows, hot.shard(rows["a"], rows["b"], shards), parts)
            held.clear()
            n = 0
            return _blocks(parts)

        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.append(token_hashes(text))
                n += len(held[-1])
                if n >= FLUSH:
                    yield flush()
        if n:
            yield flush()

    return texts.mapInArrow(run, "shard int, block binary")


def _by_shard(blocks: DataFrame, dtype: np.dtype, finish, ddl: str, shards: int) -> DataFrame:
    """``finish(shard, rows)``, a list of output rows, for all rows of each shard, in a task for each."""
    names = [c.split()[0] for c in ddl.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(shard: int, parts: list[bytes]) -> pa.RecordBatch:
            rows = finish(shard, np.frombuffer(b"".join(parts), dtype))
            return pa.RecordBatch.from_pydict({n: [r[i] for r in rows] for i, n in enumerate(names)})

        last, parts = None, []
        for batch in batches:
            for shard, block in zip(batch.column("shard").to_pylist(), batch.column("block")):
                if shard != last and parts:
                    yield done(last, parts)
                    parts = []
                last = shard
                parts.append(block.as_py())
        if parts:
            yield done(last, parts)

    dealt = blocks.repartitionById(shards, F.col("shard").cast("int"))
    return dealt.sortWithinPartitions("shard").mapInArrow(run, ddl)


def _save(folder: str, columns: dict[str, np.ndarray]) -> str:
    """Files of the columns under a new name, which is returned."""
    name = uuid.uuid4().hex
    for column, values in columns.items():
        path = os.path.join(folder, f"{name}.{column}")
        with open(path, "wb") as file:
            file.write(values.tobytes())
    return name


class Part:
    """A shard's sorted keys and values, mapped into memory."""

    def __init__(self, folder: str, name: str, columns: dict[str, str]):
        for column, dtype in columns.items():
            path = os.path.join(folder, f"{name}.{column}")
            empty = os.path.getsize(path) == 0
            setattr(self, column, np.empty(0, dtype) if empty else np.memmap(path, dtype, "r"))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ascending ``keys``, and which of them are there."""
        at = np.searchsorted(self.key, keys)
        there = at < len(self.key)
        there[there] = self.key[at[there]] == keys[there]
        return at, there


WORD_COLUMNS = {"key": "<u8", "count": "<u8", "before": "<u8", "after": "<u8", "one": "<u4", "two": "<u4", "more": "<u4"}
PAIR_COLUMNS = {"key": "<u8", "count": "<u4", "large_key": "<u8", "large": "<u8"}
CONTEXT = np.dtype([("key", "<u8"), ("before", "<u8"), ("after", "<u8"), ("one", "<u4"), ("two", "<u4"), ("more", "<u4")])


class Model:
    """Where the parts of the model are, and its few global numbers."""

    def __init__(self, folder: str, shards: int, words: dict[int, str], pairs: dict[int, list[str]],
                 tokens: int, vocabulary: int, types: int, word_discounts: np.ndarray, pair_discounts: np.ndarray,
                 word_types: np.ndarray, hot: Hot, most: int):
        self.__dict__.update({k: v for k, v in locals().items() if k != "self"})


def _context_sums(pairs: np.ndarray) -> np.ndarray:
    """Per word: bigrams before it, tokens after it, and bigrams after it by their count."""
    words, first = np.unique(pairs["a"], return_index=True)
    out = np.zeros(len(words), CONTEXT)
    out["key"] = words
    out["after"] = np.add.reduceat(pairs["n"].astype(np.int64), first)
    for name, holds in (("one", pairs["n"] == 1), ("two", pairs["n"] == 2), ("more", pairs["n"] > 2)):
        out[name] = np.add.reduceat(holds.astype(np.int64), first)
    seconds, times = np.unique(pairs["b"], return_counts=True)
    more = np.zeros(len(seconds), CONTEXT)
    more["key"], more["before"] = seconds, times
    return np.concatenate([out, more])


def train(documents: DataFrame) -> Model:
    """The model of the texts of ``documents`` (null: empty), in files of the shared folder."""
    spark, most = documents.sparkSession, MOST
    folder = local_path(new_folder(spark, "ngrams"))
    texts = documents.select(text_or_empty().alias("text"))
    size = texts.agg(F.sum(F.length("text") / 5 + 1)).first()[0] or 1
    shards = max(1, int(size / SHARD_TOKENS) + 1)

    def count_words(shard: int, rows: np.ndarray) -> list[tuple]:
        rows = summed_words(rows)
        large = rows[np.argsort(rows["n"])[::-1][:64]]  # at most 1/64 of a shard's tokens beyond
        most = ",".join(f"{np.uint64(k).view(np.int64)}:{n}" for k, n in large.tolist())
        return [(shard, _save(folder, {"key": rows["key"], "count": rows["n"]}), int(rows["n"].sum()), len(rows), most)]

    counted = stage(
        _by_shard(_count(texts, shards, None), WORD, count_words, "shard long, name string, tokens long, words long, most string", shards)
    ).collect()  # a row per shard
    tokens, vocabulary = sum(r["tokens"] for r in counted), sum(r["words"] for r in counted)
    share = max(tokens // shards // 4, 1)
    hot = Hot(
        [
            (int(k), -(-int(n) // share))
            for r in counted
            for k, n in (x.split(":") for x in r["most"].split(",") if x)
            if int(n) > share
        ]
    )

    def count_pairs(shard: int, rows: np.ndarray) -> list[tuple]:
        rows = summed_pairs(rows)
        key = mixed(rows["a"], rows["b"])
        order = np.argsort(key)
        key, count = key[order], rows["n"][order]
        large = count >= most
        columns = {"key": key, "count": np.minimum(count, most).astype("<u4")}
        name = _save(folder, columns | {"large_key": key[large], "large": count[large]})
        sums = _context_sums(rows)
        parts: list = []
        blocks_by_shard(sums, shard_of(sums["key"], shards), parts)
        times = counts_of_counts(rows["n"]).tolist()
        out = [(shard, name, len(rows), *times, -1, b"")]
        return out + [(shard, "", 0, 0, 0, 0, 0, s, b) for s, b in parts]

    ddl = "pair_shard long, name string, types long, n1 long, n2 long, n3 long, n4 long, shard long, block binary"
    paired = stage(_by_shard(_count(texts, shards, hot), PAIR, count_pairs, ddl, shards))
    pair_rows = paired.where("shard < 0").drop("block").collect()  # a row per shard
    word_names = {r["shard"]: r["name"] for r in counted}

    def finish_words(shard: int, rows: np.ndarray) -> list[tuple]:
        keys, which = np.unique(rows["key"], return_inverse=True)
        known = Part(folder, word_names[shard], {"key": "<u8", "count": "<u8"}) if shard in word_names else None
        count = np.zeros(len(keys), np.uint64)
        if known is not None:
            at, there = known.find(keys)
            count[there] = known.count[at[there]]
        columns = {"key": keys, "count": count}
        for column in ("before", "after", "one", "two", "more"):
            total = np.bincount(which, rows[column], minlength=len(keys))
            columns[column] = total.astype(WORD_COLUMNS[column])
        before = columns["before"]
        by_count = [int((before == 1).sum()), int((before == 2).sum()), int((before > 2).sum())]
        return [(shard, _save(folder, columns), *counts_of_counts(before).tolist(), *by_count)]

    blocks = paired.where("shard >= 0").select("shard", "block")
    ddl = "shard long, name string, n1 long, n2 long, n3 long, n4 long, one long, two long, more long"
    words = stage(_by_shard(blocks, CONTEXT, finish_words, ddl, shards)).collect()  # a row per shard
    for name in word_names.values():  # replaced by the finished tables
        for column in ("key", "count"):
            os.remove(os.path.join(folder, f"{name}.{column}"))
    sums = lambda rows, names: np.array([sum(r[n] for r in rows) for n in names])
    quarters = ("n1", "n2", "n3", "n4")
    return Model(
        folder, shards, {r["shard"]: r["name"] for r in words}, {r["pair_shard"]: r["name"] for r in pair_rows},
        tokens, vocabulary, sum(r["types"] for r in pair_rows), discounts(sums(words, quarters)),
        discounts(sums(pair_rows, quarters)), sums(words, ("one", "two", "more")), hot, most,
    )


class Scorer:
    """Scores texts by the parts of a model, mapped into memory when first needed."""

    def __init__(self, model: Model):
        self.m, self.parts = model, {}

    def _part(self, names: dict[int, str], shard: int, columns: dict[str, str]) -> Part | None:
        if shard not in names:
            return None
        name = names[shard]
        if name not in self.parts:
            self.parts[name] = Part(self.m.folder, name, columns)
        return self.parts[name]

    def _look_up(self, names, columns, keys: np.ndarray, shard: np.ndarray, wanted: list[str]) -> list[np.ndarray]:
        """Values of ``keys`` (ascending within each shard); 0 where a key is unknown."""
        out = [np.zeros(len(keys)) for _ in wanted]
        for s in np.unique(shard):
            part = self._part(names, int(s), columns)
            if part is None:
                continue
            mine = np.flatnonzero(shard == s)
            at, there = part.find(keys[mine])
            for values, column in zip(out, wanted):
                values[mine[there]] = getattr(part, column)[at[there]]
                if column == "count" and "large" in columns and len(part.large):
                    over = mine[there][values[mine[there]] >= self.m.most]
                    values[over] = part.large[np.searchsorted(part.large_key, keys[over])]
        return out

    def log_probabilities(self, before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 p(word | before), and the counts of ``word``."""
        m = self.m
        words, which = np.unique(np.concatenate([before, word]), return_inverse=True)
        columns = ["count", "before", "after", "one", "two", "more"]
        count, met, after, one, two, more = self._look_up(
            m.words, WORD_COLUMNS, words, shard_of(words, m.shards), columns
        )
        context, own = which[: len(before)], which[len(before) :]
        pair_key = mixed(before, word)
        keys, first, back = np.unique(pair_key, return_index=True, return_inverse=True)
        shard = m.hot.shard(before[first], word[first], m.shards)
        (c,) = self._look_up(m.pairs, PAIR_COLUMNS, keys, shard, ["count"])
        c = c[back]

        def taken(n: np.ndarray, d: np.ndarray) -> np.ndarray:
            return n - np.where(n > 2, d[2], np.where(n > 1, d[1], np.where(n > 0, d[0], 0.0)))

        types = max(m.types, 1)
        lower_mass = float(m.word_discounts @ m.word_types) / types if m.types else 1.0
        lower = taken(met, m.word_discounts) / types + lower_mass / (m.vocabulary + 1)
        d = m.pair_discounts
        known = after > 0
        given_back = np.where(known, (d[0] * one + d[1] * two + d[2] * more) / np.maximum(after, 1), 1.0)
        p = taken(c, d) / np.maximum(after, 1)[context] + given_back[context] * lower[own]
        return np.log10(p), count[own]


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, n_known, train_tokens, base_score, score``.

    ``score`` is the log10 probability of the text by the model, ``base_score`` by unigrams
    with half a count added.  Null and empty texts are the end token alone.  Rows are scored
    each on their own.  Other columns are not read.
    """
    shipped = documents.sparkSession.sparkContext.broadcast(model)  # names and numbers, no arrays

    def start():
        scorer = Scorer(shipped.value)
        m = scorer.m

        def some(tokens: list[np.ndarray]) -> list[np.ndarray]:
            lengths = np.array([len(t) for t in tokens])
            word = np.concatenate(tokens)
            before = np.empty_like(word)
            before[1:] = word[:-1]
            starts = np.cumsum(lengths) - lengths
            before[starts] = BEGIN
            logs, counts = scorer.log_probabilities(before, word)
            base = np.log10((counts + 0.5) / (m.tokens + 0.5 * (m.vocabulary + 1)))
            total = lambda x: np.add.reduceat(x, starts)
            return [lengths, total((counts > 0).astype(np.int64)), total(base), total(logs)]

        def step(batch: pa.RecordBatch) -> dict | None:
            texts = batch.column("text")
            if not len(texts):
                return None
            done, held, n = [], [], 0
            for text in texts:
                held.append(token_hashes(text.as_py()))
                n += len(held[-1])
                if n >= FLUSH // 2:
                    done.append(some(held))
                    held, n = [], 0
            if held:
                done.append(some(held))
            lengths, known, base, logs = (np.concatenate(x) for x in zip(*done))
            return {
                "doc_id": batch.column("doc_id"),
                "n_tokens": lengths,
                "n_known": known,
                "train_tokens": np.full(len(texts), m.tokens),
                "base_score": base,
                "score": logs,
            }

        return step

    columns = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return map_batches(rows, columns, start)


def score_held_out(documents: DataFrame) -> DataFrame:
    """``score_documents`` of all documents by a model of those not held out, and ``held_out``."""
    held_out = remainder() == 1
    scored = score_documents(documents, train(documents.where(~held_out)))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
