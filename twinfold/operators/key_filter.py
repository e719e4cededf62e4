"""A filter of bounded size that lets every rare key through and stops nearly all common ones.

Two bit maps, one behind the other.  The first holds the common keys; a rare key may
look common there.  The second holds exactly the rare keys that do, and lets them
through again.  A row is dropped if its key looks common and is not let through, so no rare key is
ever lost; a common key that slips through costs a row in a shuffle and is dropped by the join
on the rare keys.  The second map is small however many rare keys there are, which a
map of all rare keys would not be.

The first map takes as many of the common keys as it has room for, heaviest first by powers of
two; lighter ones go the ordinary way.
"""

from __future__ import annotations

from math import exp
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.session import stage

MAP_WORDS = (1 << 10, 1 << 21)  # longs of a map: 8 KB to 16 MB
BLOCK = 1024  # longs that one row of a map under construction holds
BITS_PER_KEY = 16
PROBES = 2
# With fewer rare keys the join on them is a broadcast join, which shuffles no common key either.
LEAST_RARE = 200_000


class BitMap(NamedTuple):
    """A written table of one row, ``bits``: an array of ``words`` longs."""

    table: DataFrame
    words: int
    salt: int

    def has(self, key_hash: Column) -> Column:
        bits = self.table.scalar()
        at = _probes(key_hash, self.words, self.salt)
        hit = F.lit(True)
        for slot, bit in at:
            hit = hit & (F.getbit(F.element_at(bits, slot + 1), bit) == 1)
        return hit


class KeyFilter(NamedTuple):
    keys: list[str]
    common: BitMap
    let_through: BitMap

    def apply(self, rows: DataFrame) -> DataFrame:
        h = _hash(self.keys)
        return rows.where(~self.common.has(h) | self.let_through.has(h))


def _hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _probes(key_hash: Column, words: int, salt: int) -> list[tuple[Column, Column]]:
    """Slots (from 0) and bits of a key."""
    drawn = [F.xxhash64(key_hash, F.lit(salt + i)) for i in range(PROBES)]
    return [
        (
            F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(words - 1)).cast("int"),
            h.bitwiseAND(F.lit(63)).cast("int"),
        )
        for h in drawn
    ]


def _words_for(keys: float) -> int:
    """A power of two with room for so many keys, within ``MAP_WORDS``."""
    least, most = MAP_WORDS
    return min(max(1 << int(keys * BITS_PER_KEY / 64).bit_length(), least), most)


def _looks_present(keys: int, words: int) -> float:
    """Share of other keys that a map holding ``keys`` keys takes for its own."""
    return (1 - exp(-PROBES * keys / (64 * words))) ** PROBES


def _bit_map(hashes: DataFrame, words: int, salt: int) -> BitMap:
    """The map of the column ``h``, put together from blocks, each by a task of its own."""
    both = F.array(
        *[F.struct(slot.alias("slot"), bit.alias("bit")) for slot, bit in _probes(F.col("h"), words, salt)]
    )
    found = hashes.select(F.inline(both)).select("slot", F.expr("shiftleft(1L, bit)").alias("bits"))
    every = hashes.sparkSession.range(words).select(
        F.col("id").cast("int").alias("slot"), F.lit(0).cast("long").alias("bits")
    )
    slots = found.unionByName(every).groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    in_order = lambda c: F.transform(F.sort_array(F.collect_list(c)), lambda x: x["bits"])
    blocks = slots.groupBy(F.expr(f"slot div {BLOCK}").alias("slot")).agg(
        in_order(F.struct("slot", "bits")).alias("bits")
    )
    whole = blocks.agg(F.flatten(in_order(F.struct("slot", "bits"))).alias("bits"))
    return BitMap(stage(whole), words, salt)


def key_filter(frequency: DataFrame, keys: list[str], cap: int, listed: int) -> KeyFilter | None:
    """The filter for keys of which ``frequency`` (a written table) counts more than ``cap``.

    None where it would spare no shuffle: if there are at most ``listed`` such keys, which an
    exact list can name, or fewer than ``LEAST_RARE`` others.
    """
    digits = F.length(F.bin("frequency"))  # powers of two, counted exactly
    sizes = {
        r["digits"]: r["n"]
        for r in frequency.groupBy(F.when(F.col("frequency") > cap, digits).otherwise(0).alias("digits"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()  # at most 65 rows
    }
    rare = sizes.pop(0, 0)
    if sum(sizes.values()) <= listed or rare < LEAST_RARE:
        return None
    room = MAP_WORDS[1] * 64 // BITS_PER_KEY
    held, least = 0, 65
    for size in sorted(sizes, reverse=True):
        if held and held + sizes[size] > room:
            break
        held, least = held + sizes[size], size
    common = frequency.where((F.col("frequency") > cap) & (digits >= least)).select(_hash(keys).alias("h"))
    first = _bit_map(common, _words_for(held), salt=0)
    hashes = frequency.where(F.col("frequency") <= cap).select(_hash(keys).alias("h"))
    look_common = rare * _looks_present(held, first.words)
    second = _bit_map(hashes.where(first.has(F.col("h"))), _words_for(look_common), salt=PROBES)
    return KeyFilter(keys, first, second)
