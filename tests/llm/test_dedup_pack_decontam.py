"""Small tables with awkward rows, and the test tables, against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from twinfold.llm.decontam import _map_words, decontaminate
from twinfold.llm.exact_dedup import CuckooIndex, build_index, digest_of, exact_dedup, merge, remove
from twinfold.llm.packing import best_plan, pack, pack_documents, pieces, plan, sequences
from twinfold.llm.simhash import BKForest, fingerprint, simhash_components

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
DDL = "doc_id long, text string, kept string, component_id string, length string, w string, places int"
LONG = "Lorem ipsum DOLOR sit amet " * 4000
ROWS = [
    (1, "The same TEXT here, word for word", "x", "y", "z", "w", 1),
    (2, "the same text here, word for word", None, None, None, None, None),
    (2, "the same text here, word for word", None, None, None, None, None),
    (3, None, "x", "y", "z", "w", 1),
    (4, "", "x", "y", "z", "w", 1),
    (None, "no id at all", "x", "y", "z", "w", 1),
    (None, None, "x", "y", "z", "w", 1),
    (5, LONG, "x", "y", "z", "w", 1),
    (6, LONG.lower(), "x", "y", "z", "w", 1),
    (7, "É<|endoftext|> é ÀB́ " + "x" * 300, "x", "y", "z", "w", 1),
    (8, " \t\n ", "x", "y", "z", "w", 1),
]


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, DDL).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="module", params=["odd", "sf"])
def docs(request, spark, odd):
    return odd if request.param == "odd" else spark.read.parquet(f"{SF}/documents.parquet").repartition(5)


def plain(df):
    return [tuple(r) for r in df.collect()]


def test_exact_dedup(docs):
    rows = plain(docs.select("doc_id", "text"))
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256(ascii_lower(t).encode()).hexdigest()].append(i)
    want = Counter()
    for sha, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        want.update((i, best, len(ids), i == best, sha) for i in ids)
    out = exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert Counter(plain(out)) == want


def test_cuckoo_index_grows_deletes_and_verifies():
    rng = np.random.default_rng(1)
    index, truth = CuckooIndex(buckets=2), {}
    keys = [hashlib.sha256(str(k).encode()).digest() for k in range(3000)]
    # Keys that share both buckets and the tag of another are told apart by the stored keys.
    keys += [k[:16] + b"?" * 16 for k in keys[:3]]
    for _ in range(20000):
        key = keys[rng.integers(len(keys))]
        if rng.random() < 0.6:
            index.add(key, 1)
            truth[key] = truth.get(key, 0) + 1
        else:
            assert index.delete(key) == (truth.pop(key, None) is not None)
    live = dict(zip(index.live()[0], index.live()[2]))
    assert live == truth and len(index) == len(truth)


def test_index_insert_and_remove(spark):
    digests = lambda names: spark.createDataFrame(
        [(i, n) for i, n in names], "doc_id long, text string"
    ).select("doc_id", digest_of(F.col("text")).alias("digest"))
    index = merge(build_index(digests([(1, "a"), (2, "b"), (3, "A")])), build_index(digests([(9, "b")])))
    sizes = {r.keep_id: r.group_size for r in index.collect()}
    assert sizes == {3: 2, 9: 2}
    left = remove(index, digests([(0, "a"), (0, "unknown")])).collect()
    assert [(r.keep_id, r.group_size) for r in left] == [(9, 2)]


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 4:
            root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(fps))]


def test_simhash(docs):
    rows = plain(docs.select("doc_id", "text"))
    fps = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(fps, [i for i, _ in rows])
    want = Counter((i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, roots))
    assert Counter(plain(simhash_components(docs).select("doc_id", "fingerprint", "component_id"))) == want


def test_fingerprint_counts_across_chunks(monkeypatch):
    monkeypatch.setattr("twinfold.llm.simhash.CHUNK", 7)
    assert fingerprint(LONG[:3000]) == brute_fingerprint(LONG[:3000])


def test_bk_trees_find_all_within_radius():
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 2**64, 40, np.uint64)
    flips = np.array([np.bitwise_xor.reduce(np.uint64(1) << rng.integers(0, 64, rng.integers(0, 6)).astype(np.uint64), initial=np.uint64(0)) for _ in range(600)], np.uint64)
    fps = np.unique(centres[rng.integers(0, 40, 600)] ^ flips)
    shard = np.sort(rng.integers(0, 3, len(fps)))
    found = set()
    for q, node in BKForest(shard, fps).search(shard, fps, 4):
        found |= set(zip(q.tolist(), node.tolist()))
    d = np.bitwise_count(fps[:, None] ^ fps[None, :])
    want = {(i, j) for i, j in zip(*np.nonzero((d <= 4) & (shard[:, None] == shard[None, :])))}
    assert found == want


def test_simhash_tiles_of_a_large_shard(spark, monkeypatch):
    """Near copies that all meet in the same shards, with tiles of a few rows."""
    monkeypatch.setattr("twinfold.llm.simhash.TILE", 5)
    from twinfold.llm.simhash import near_links

    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 2, np.uint64)
    fps = {int(base[i % 2] ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b))) for i, (a, b) in enumerate(rng.integers(0, 16, (60, 2)))}
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    links = near_links(df).collect()
    index = {int(np.uint64(f).view(np.int64)): i for i, f in enumerate(fps)}
    near = {i: [j for j, g in enumerate(fps) if (f ^ g).bit_count() <= 4] for i, f in enumerate(fps)}
    want = {}
    for i in range(len(fps)):  # who can be reached
        reached, ahead = {i}, [i]
        while ahead:
            ahead = [j for x in ahead for j in near[x] if j not in reached and not reached.add(j)]
        want[i] = frozenset(reached)
    root = list(range(len(fps)))
    for r in links:
        assert index[r.b] in want[index[r.a]]
        a, b = root[index[r.a]], root[index[r.b]]
        root = [a if x == b else x for x in root]
    assert {frozenset(j for j, x in enumerate(root) if x == y) for y in set(root)} == set(want.values())


def test_components_of_a_star(spark, monkeypatch):
    """The links of a centre are dealt over several tasks, and nothing is lost."""
    from twinfold.llm import components as module

    monkeypatch.setattr(module, "LEAST_SHARE", 3)
    dealt = []
    join = module.spread_join
    monkeypatch.setattr(module, "spread_join", lambda a, b, k, hot, **w: dealt.append(hot is not None) or join(a, b, k, hot, **w))
    rows = [(500, i) for i in range(1, 300)] + [(i, i + 1) for i in range(1000, 1040)] + [(7, 7)]
    links = spark.createDataFrame(rows + rows[:9], "a long, b long")
    found = {r.vertex: r.root for r in module.components(links).collect()}
    assert found == {i: 1 for i in [*range(2, 300), 500]} | {i: 1000 for i in range(1001, 1041)}
    assert any(dealt)


def test_pieces_and_packing(docs):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = plain(docs.select("doc_id", "text"))
    want = Counter()
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want[i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    packed = plain(pack_documents(docs, TOKENIZER).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))
    assert Counter(r[:5] for r in packed) == want
    bins = defaultdict(list)
    for r in packed:
        bins[r[5]].append((r[6], r[3]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r[3] for r in packed)
    best_fit = []
    for length in sorted((r[3] for r in packed), reverse=True):
        room = min((x for x in best_fit if x >= length), default=None)
        if room is None:
            best_fit.append(2048 - length)
        else:
            best_fit[best_fit.index(room)] -= length
    assert len(bins) <= max(-(-total // 2048), len(best_fit)) * 1.01


def test_plan_is_gapless_and_complete():
    rng = np.random.default_rng(4)
    for _ in range(200):
        counts = Counter(rng.integers(1, 65, rng.integers(0, 60)).tolist())
        runs = plan(counts, 64, int(rng.integers(1, 20)), int(rng.integers(1, 40)))
        used, ranks = defaultdict(list), defaultdict(list)
        for length, rank, n, sequence, each, offset in runs:
            ranks[length] += range(rank, rank + n)
            for i in range(n):
                used[sequence + i // each].append((offset + i % each * length, length))
        assert {x: len(r) for x, r in ranks.items()} == counts
        assert all(sorted(r) == list(range(len(r))) for r in ranks.values())
        for parts in used.values():
            ends = [a + b for a, b in sorted(parts)]
            assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 64


def test_plan_size_does_not_follow_the_number_of_pieces():
    counts = {x: 1000 + 37 * x % 101 for x in range(1, 2049)}
    few, many = best_plan(counts), best_plan({x: n * 1_000_000 for x, n in counts.items()})
    assert len(many) < 2 * len(few)


def test_sequences_hold_the_ids(spark, odd):
    packed = pack(pieces(odd.where("doc_id < 5"), TOKENIZER, with_ids=True))
    rows = packed.collect()
    built = {r.sequence_id: bytes(r.ids) for r in sequences(packed).collect()}
    for r in rows:
        part = built[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)]
        assert zlib.crc32(part) == r.ids_crc32


def brute_decontaminate(rows, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t))
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(item)
    sizes = {len(w) for w in windows}
    out = Counter()
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                owners = windows.get(tuple(w[i : i + n]))
                if owners is not None:
                    hit.update(range(i, i + n))
                    found |= owners
        names = sorted(str(i) for i in found if i is not None)
        sha = hashlib.sha256(",".join(names).encode()).hexdigest()
        out[doc, len(w), len(hit), len(names), sha, bool(hit) and 20 * len(hit) >= len(w)] += 1
    return out


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_decontamination_of_the_test_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute_decontaminate(plain(docs.select("doc_id", "text")), plain(items.select("item_id", "text")))
    assert any(k[5] for k in want)
    assert Counter(plain(decontaminate(docs, items).select(*COLUMNS))) == want


def test_decontamination_of_awkward_rows(spark, odd):
    ddl = "item_id long, text string, words string, n int, bits string"
    items = [
        (1, "Word for", "a", 1, "b"),
        (2, "HERE", "a", 1, "b"),
        (3, None, "a", 1, "b"),
        (4, " .,", "a", 1, "b"),
        (5, "amet lorem ipsum dolor " * 5, "a", 1, "b"),
        (6, "sit amet lorem ipsum dolor " * 5, "a", 1, "b"),
        (6, "sit amet lorem ipsum dolor " * 5, "a", 1, "b"),
        (None, "no id", "a", 1, "b"),
        (7, "É", "a", 1, "b"),
        (8, "same text here word", "a", 1, "b"),
    ]
    benchmark = spark.createDataFrame(items, ddl)
    want = brute_decontaminate(plain(odd.select("doc_id", "text")), [i[:2] for i in items])
    assert Counter(plain(decontaminate(odd, benchmark).select(*COLUMNS))) == want
    none = decontaminate(odd, spark.createDataFrame([], ddl)).select(*COLUMNS)
    assert Counter(plain(none)) == brute_decontaminate(plain(odd.select("doc_id", "text")), [])


def test_bit_map_of_any_size_gives_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    results = []
    for least, most in ((1, 1), (1, 1 << 21)):
        monkeypatch.setattr("twinfold.llm.decontam.MAP_WORDS", (least, most))
        results.append(Counter(plain(decontaminate(docs, items).select(*COLUMNS))))
    assert results[0] == results[1] and any(k[5] for k in results[0])


def test_bit_map_grows_with_the_shingles_to_a_bound():
    assert [_map_words(n) for n in (0, 1 << 16, 1 << 20, 1 << 40)] == [1 << 14, 1 << 15, 1 << 19, 1 << 21]


def test_empty_tables(spark, empty):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert exact_dedup(empty).count() == 0
    assert simhash_components(empty).count() == 0
    assert pack_documents(empty, TOKENIZER).count() == 0
    assert decontaminate(empty, items).count() == 0


@pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")
def test_decontamination_runs_no_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = decontaminate(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
