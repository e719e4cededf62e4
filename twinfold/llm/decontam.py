"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions alone.

A window (13 consecutive words of an item, or all words of a shorter item) is found where
a document holds exactly its words, so all its shingles must occur there and one of them
is prefix enough: the rarest over the documents.

1. One pass over the texts keeps the places of shingles that may occur in the benchmark,
   each with the words a window around it can cover.  The test is a bit map, a scalar
   subquery; it grows with the benchmark's shingles up to a fixed size, beyond which
   it lets more places through and loses none.
2. Shingles are counted at these places; each window keeps its rarest one, and a
   window with a shingle that does not occur is out.
3. Places join windows on the prefix shingle.  The position of the shingle in the
   window fixes the start; it must lie within the document, as must the end.
4. The words there are compared with those of the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import ascii_lower, row_key, text_or_empty
from twinfold.session import stage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
SHINGLE = 3
# The bit map, in longs of 64 bits: 16 bits a shingle, from 128 KB to 16 MB.
MAP_WORDS = (1 << 14, 1 << 21)
SHINGLES_PER_WORD = 4
# Prefix rows that may be broadcast: at most a few hundred bytes each.
BROADCAST_ROWS = 100_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def _shingles(words: str, size: int) -> str:
    """SQL for the shingles of an array of words: ``at`` (from 1) and the hash ``h``."""
    parts = ", ".join(f"{words}[i + {k - 1}]" for k in range(size))
    return (
        f"if(size({words}) < {size}, cast(array() as array<struct<at int, h bigint>>), "
        f"transform(sequence(1, size({words}) - {size - 1}), "
        f"i -> struct(i as at, xxhash64({parts}) as h)))"
    )


def windows(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Different windows (``w`` the joined words, ``words``, ``n``), and ``w, item_id``."""
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), words_of(text_or_empty()).alias("item_words")
    ).where(F.size("item_words") > 0)
    last = F.greatest(F.size("item_words") - window, F.lit(0)) + 1
    cut = items.select(
        "item_id", "item_words", F.explode(F.sequence(F.lit(1), last)).alias("at")
    ).select("item_id", F.slice("item_words", F.col("at"), F.lit(window)).alias("words"))
    owned = stage(cut.select(F.array_join("words", " ").alias("w"), "words", "item_id"))
    different = owned.select("w", "words").distinct().withColumn("n", F.size("words"))
    return different, owned.select("w", "item_id").distinct()


def _window_shingles(different: DataFrame, shingle: int) -> tuple[list[int], DataFrame]:
    """Sizes of shingles in use, and the shingles of the windows."""
    size = F.least(F.col("n"), F.lit(shingle))
    sized = different.withColumn("k", size)
    sizes = sorted(r["k"] for r in sized.select("k").distinct().collect())  # at most ``shingle``
    parts = [
        sized.where(F.col("k") == k).select(
            "w", "words", "n", "k", F.explode(F.expr(_shingles("words", k))).alias("s")
        )
        for k in sizes
    ]
    found = different.select("w", "words", "n", F.lit(0).alias("k"), F.lit(None).cast("struct<at int, h bigint>").alias("s")).where("false")
    for part in parts:
        found = found.unionByName(part)
    return sizes, found.select("w", "words", "n", "k", F.col("s.at").alias("at"), F.col("s.h").alias("h"))


def _map_words(shingles: int) -> int:
    """Longs of the bit map for so many different shingles: a power of two."""
    least, most = MAP_WORDS
    return min(max(1 << (shingles // SHINGLES_PER_WORD).bit_length(), least), most)


def _bit_map(hashes: DataFrame, map_words: int) -> Column:
    """The column ``h`` as ``map_words`` longs of bits."""
    slots = hashes.select(
        F.expr(f"cast(shiftrightunsigned(h, 6) & {map_words - 1} as int)").alias("slot"),
        F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"),
    )
    spark = hashes.sparkSession
    every = spark.range(map_words).select(F.col("id").cast("int").alias("slot"), F.lit(0).cast("long").alias("bit"))
    per_slot = slots.unionByName(every).groupBy("slot").agg(F.bit_or("bit").alias("bit"))
    in_order = F.sort_array(F.collect_list(F.struct("slot", "bit")))
    return per_slot.agg(F.transform(in_order, lambda x: x["bit"]).alias("bits")).scalar()


def places(
    documents: DataFrame, sizes: list[int], hashes: DataFrame, window: int = WINDOW
) -> DataFrame:
    """A row per document: ``doc_id, row_key, n_words`` and the ``places`` of likely shingles.

    ``row_key`` is the digest of id and text, which repeated rows share.
    """
    hashes = hashes.distinct()
    map_words = _map_words(hashes.count()) if sizes else 0
    parts = []
    for k in sizes:
        context = (
            f"struct({k} as k, s.at as at, s.h as h, greatest(s.at - {window - k}, 1) as since, "
            f"slice(words, greatest(s.at - {window - k}, 1), "
            f"s.at + {window} - greatest(s.at - {window - k}, 1)) as around)"
        )
        likely = (
            f"filter({_shingles('words', k)}, s -> getbit(element_at(bits, "
            f"cast(shiftrightunsigned(s.h, 6) & {map_words - 1} as int) + 1), cast(s.h & 63 as int)) = 1)"
        )
        parts.append(f"transform({likely}, s -> {context})")
    kind = "array<struct<k int, at int, h bigint, since int, around array<string>>>"
    all_places = f"concat({', '.join(parts)})" if parts else f"cast(array() as {kind})"
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")
    ).select(
        "doc_id",
        row_key().alias("row_key"),
        words_of(F.col("text")).alias("words"),
    )
    if parts:
        rows = rows.withColumn("bits", _bit_map(hashes, map_words))
    return rows.select(
        "doc_id",
        "row_key",
        F.size("words").cast("long").alias("n_words"),
        F.expr(all_places).alias("places"),
    )


def _prefixes(shingles: DataFrame, seen: DataFrame) -> DataFrame:
    """The rarest shingle of each window, ties by hash and position."""
    counts = seen.groupBy("k", "h").agg(F.count(F.lit(1)).alias("times"))
    ranked = shingles.join(counts, ["k", "h"], "left").groupBy("w").agg(
        F.min(F.coalesce("times", F.lit(0))).alias("least"),
        F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "h", "at")).alias("rarest"),
        F.first("words").alias("words"),
        F.first("n").alias("n"),
        F.first("k").alias("k"),
    )
    return ranked.where("least > 0").select(
        "w", "words", "n", "k", F.col("rarest.h").alias("h"), F.col("rarest.at").alias("offset")
    )


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    keyed: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    ``n_hit`` counts the document's words inside any occurrence of a window, ``n_items``
    the items with an occurring window; a document is contaminated if at least a
    twentieth of its words, and at least one, is hit.  Null and empty texts have no
    words and are clean; an item without words has no windows; a null ``item_id`` hits
    words but is not counted or listed.  Repeated rows get equal results.  Other columns
    are not read.  ``keyed`` adds the ``row_key`` of each row.
    """
    different, owners = windows(benchmark, window)
    sizes, shingles = _window_shingles(different, shingle)
    shingles = stage(shingles)
    rows = stage(places(documents, sizes, shingles.select("h"), window))
    seen = rows.select("row_key", "n_words", F.explode("places").alias("p")).select(
        "row_key", "n_words", "p.*"
    )
    prefixes = stage(_prefixes(shingles, seen))
    if prefixes.count() <= BROADCAST_ROWS:
        prefixes = F.broadcast(prefixes)
    start = F.col("at") - F.col("offset") + 1
    found = (
        seen.join(prefixes, ["k", "h"])
        .withColumn("start", start)
        .where("start >= 1 and start + n - 1 <= n_words and start >= since")
        .where("slice(around, start - since + 1, n) = words")
        .select("row_key", F.col("start").cast("long").alias("start"), (F.col("start") + F.col("n") - 1).cast("long").alias("end"), "w")
    )
    hits = stage(found.distinct())

    spans = hits.groupBy("row_key", "start").agg(F.max("end").alias("end"))
    covered = F.expr(
        "max(end) over (partition by row_key order by start rows between unbounded preceding and 1 preceding)"
    )
    words_hit = (
        spans.withColumn("covered", F.coalesce(covered, F.lit(0)))
        .groupBy("row_key")
        .agg(
            F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start") - 1, "covered"))).alias("n_hit")
        )
    )
    items = (
        hits.select("row_key", "w").distinct().join(owners, "w")
        .groupBy("row_key")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
        .select(
            "row_key",
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        )
    )
    return (
        rows.select("doc_id", "row_key", "n_words")
        .join(words_hit, "row_key", "left")
        .join(items, "row_key", "left")
        .select(
            "doc_id",
            *(["row_key"] if keyed else []),
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
            (
                (F.coalesce("n_hit", F.lit(0)) > 0)
                & (F.lit(20) * F.coalesce("n_hit", F.lit(0)) >= F.col("n_words"))
            ).alias("contaminated"),
        )
    )
