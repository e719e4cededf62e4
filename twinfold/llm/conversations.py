"""Repair of damaged conversations, by Viterbi over chunks that start from guessed costs.

Rows are sorted by a range partitioning over conversation, turn, role and text, so a conversation of
any size is spread over as many tasks as it needs, and each task cuts what it has of a
conversation into chunks of bounded size.  A row of a chunk is one byte for the search: what its
role begins with, whether it must go, whether it is cut short.

The least cost from a place to the conversation's end, by the role that came last, follows
backwards from row to row.  Chunks do not wait for those after them:

1. Every chunk runs backwards from a guess, equal costs at its end.
2. Per conversation the chunks are stitched from the last one on: where a chunk's end has the
   costs it was run from, up to a constant, its own beginning is known.  Costs that come up at a
   border and were not tried are asked for.
3. Fix-up passes rerun chunks from the costs asked for, side by side with the run from the guess,
   until both differ by a constant only; the rest of the guess's run then holds.  Differences
   between the four costs are bounded, so there are few to ask for, and few passes.

With the true costs at each chunk's end, edits are traced forward, the first letter of those that
stay on a cheapest path.  A chunk says where it ends for each role that can come before it, the
conversation's chunks are stitched once more, and each writes its own edits.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from twinfold.llm.common import schema_of
from twinfold.session import stage

CHUNK_ROWS = 4096
CHUNK_BYTES = 1 << 20  # of text; a longer text is a chunk by itself

# What came last: nothing, a system row, a user row, an assistant row.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"  # of the roles that may stay
BLANK, SEEN, CUT_SHORT = 4, 8, 16  # flags of a row's byte, beside the index of its initial (3: other)
DELETE, KEEP, REROLE, INSERT = 2, 0, 1, 5  # costs
UNFINISHED = 5  # cost of a row that is cut short and stays
NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
LEGAL = ("su", "ua", "au")  # neighbours that fit
NAMES = {USER: "user", ASSISTANT: "assistant"}
AT_END = (0, 2 * INSERT, INSERT, 0)  # inserts that complete the last pair
GUESS = (0, 0, 0, 0)

Costs = tuple[int, int, int, int]


def _kept_as(code: int, last: int) -> int | None:
    """What has come last when a row stays as it is, if it may."""
    initial = code & 3
    if initial == 0:
        return SYSTEM if last == NOTHING else None
    return initial + 1 if initial < 3 and NEXT[last] == initial + 1 else None


@lru_cache(maxsize=None)
def before(code: int, after: Costs) -> tuple[Costs, int]:
    """Costs before a row from those after it, with the least as 0, and that least."""
    forced, extra = code & (BLANK | SEEN), UNFINISHED if code & CUT_SHORT else 0
    found = []
    for last in range(4):
        cost = DELETE + after[last]
        if not forced:
            cost = min(cost, REROLE + extra + after[NEXT[last]])
            kept = _kept_as(code, last)
            if kept is not None:
                cost = min(cost, KEEP + extra + after[kept])
        found.append(cost)
    for _ in range(2):  # inserts, up to two in a row
        found = [min(c, INSERT + found[NEXT[last]]) for last, c in enumerate(found)]
    least = min(found)
    return tuple(c - least for c in found), least


def normal(costs: Costs) -> Costs:
    """Costs with the least as 0: two vectors that differ by a constant have one normal form."""
    least = min(costs)
    return tuple(c - least for c in costs)


def backward(codes: bytes, end: Costs) -> Costs:
    """Costs at the beginning of rows from those at their end, up to a constant."""
    costs = normal(end)
    for code in reversed(codes):
        costs = before(code, costs)[0]
    return costs


def fix_up(codes: bytes, end: Costs, guessed: Costs) -> tuple[Costs, int]:
    """As ``backward``, run beside a run from the guess, which began with the costs ``guessed``, until
    both differ by a constant; and how many rows that took (all, if they never do)."""
    costs, other = normal(end), normal(GUESS)
    for done, code in enumerate(reversed(codes)):
        if costs == other:
            return guessed, done
        costs, other = before(code, costs)[0], before(code, other)[0]
    return costs, len(codes)


def trace(codes: bytes, end: Costs, last: int, closing: bool) -> tuple[str, list[int], int]:
    """The least edits from ``last`` on, in order; what has come last after each; and after all.

    ``end`` are the costs after the rows; ``closing`` adds the inserts that end a conversation.
    """
    after = [normal(end)]
    for code in reversed(codes):
        after.append(before(code, after[-1])[0])
    after.reverse()  # after[i]: before row i
    audit, made = [], []
    for at, code in enumerate(codes):
        here, there = after[at], after[at + 1]
        offset = before(code, there)[1]
        forced, extra = code & (BLANK | SEEN), UNFINISHED if code & CUT_SHORT else 0
        while True:
            need = here[last] + offset
            kept = None if forced else _kept_as(code, last)
            if need == DELETE + there[last]:
                audit.append("D")
                made.append(last)
                break
            following = NEXT[last]
            if here[last] == INSERT + here[following]:
                audit.append("I")
                made.append(following)
                last = following
                continue
            if kept is not None and need == KEEP + extra + there[kept]:
                audit.append("K")
                made.append(kept)
                last = kept
                break
            audit.append("R")
            made.append(following)
            last = following
            break
    while closing and last not in (NOTHING, ASSISTANT):
        last = NEXT[last]
        audit.append("I")
        made.append(last)
    return "".join(audit), made, last


def edited(audit: str, made: list[int], roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """Roles and texts after the edits."""
    out: tuple[list[str], list[str]] = ([], [])
    rows = zip(roles, texts)
    for letter, state in zip(audit, made):
        role, text = (NAMES[state], "") if letter == "I" else next(rows)
        if letter != "D":
            out[0].append(NAMES[state] if letter == "R" else role)
            out[1].append(text)
    return out


def row_code(role: str, text: str, seen: bool) -> int:
    """A row for the search: its initial, and its first fault if it has one."""
    initial = INITIALS.find(role[0]) if role else -1
    code = initial if initial >= 0 else 3
    shown = text.rstrip(" \t\n\r\x0b\x0c")
    if not shown:
        return code | BLANK
    if seen:
        return code | SEEN
    return code | (0 if shown[-1] in ".!?" else CUT_SHORT)


FACTS = (
    "illegal long, first_initial string, last_initial string, first_turn long, last_turn long, "
    "turns long, low long, high long"
)


def _cut_up(rows: DataFrame) -> DataFrame:
    """One row per chunk, numbered so that a conversation's chunks sort by their number.

    ``alone`` chunks hold the whole of their conversation; the first and the last conversation of a
    task may go on in another, so theirs never count as such.  ``digests`` tell rows that were not seen
    in the chunk before, and are null for others and blank ones.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = schema_of(
        f"conv_id {kind}, conv string, chunk long, alone boolean, codes binary, roles array<string>, "
        f"texts array<string>, digests array<binary>, {FACTS}"
    )
    ordered = ["conv", "turn", "role", F.substring("text", 1, 200), F.md5("text")]
    # Rows that agree in all of these are alike; the last column spreads them over tasks.
    dealt = rows.withColumn("spread", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(*ordered, "spread").sortWithinPartitions(*ordered, "spread")
    arrow = to_arrow_schema(schema)
    read = ("conv_id", "conv", "turn", "role", "text", "lost")

    def chunk_of(held: list[tuple], number: int, alone: bool) -> tuple:
        live = [row for row in held if not row[5]]
        turns = [row[2] for row in live if row[2] is not None]
        roles, texts = [row[3] for row in live], [row[4] for row in live]
        initials = [role[:1] for role in roles]
        seen: set[bytes] = set()
        codes, digests = bytearray(), []
        for role, text in zip(roles, texts):
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            codes.append(row_code(role, text, digest in seen))
            digests.append(None if codes[-1] & (BLANK | SEEN) else digest)
            seen.add(digest)
        return (
            *held[0][:2],
            number,
            alone,
            bytes(codes),
            roles,
            texts,
            None if alone else digests,
            sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            *((initials[0], initials[-1]) if initials else (None, None)),
            *((turns[0], turns[-1]) if turns else (None, None)),
            len({*turns}),
            min(turns, default=None),
            max(turns, default=None),
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        made: list[tuple] = []
        held: list[tuple] = []
        size = waiting = 0
        whole = False  # the conversation began in this task, with the chunk that is held

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, type=f.type) for c, f in zip(zip(*made), arrow)]
            made.clear()
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in read)):
                length = len(row[4])
                other = bool(held) and row[1] != held[0][1]
                if other or held and (len(held) >= CHUNK_ROWS or size + length > CHUNK_BYTES):
                    made.append(chunk_of(held, number, other and whole))
                    number, waiting = number + 1, waiting + size + 100 * len(held)
                    held, size, whole = [], 0, other
                    if waiting > CHUNK_BYTES:
                        yield flush()
                        waiting = 0
                held.append(row)
                size += length
        if held:
            made.append(chunk_of(held, number, False))
        if made:
            yield flush()

    return dealt.select(*read).mapInArrow(cut, schema)


def _mapped(df: DataFrame, ddl: str, step, keep: list[str]) -> DataFrame:
    """``df`` with each row's ``keep`` and what ``step`` makes of the row (a dictionary of its columns)."""
    schema = type(df.schema)([df.schema[c] for c in keep] + schema_of(ddl).fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            if rows:
                made = list(zip(*map(step, rows)))
                columns = [batch.column(c) for c in keep]
                columns += [pa.array(c, type=f.type) for c, f in zip(made, [*arrow][len(keep) :])]
                yield pa.RecordBatch.from_arrays([*columns], schema=arrow)

    return df.mapInArrow(run, schema)


def _seen_before(chunks: DataFrame) -> DataFrame:
    """Chunks whose codes also tell rows seen in an earlier chunk of the conversation.

    Only the first of equal rows of a chunk takes part, so a text that fills a conversation has one
    row per chunk here.
    """
    each = chunks.select("conv", "chunk", F.posexplode("digests").alias("row", "digest")).where(
        "digest is not null"
    )
    first = F.min("chunk").over(Window.partitionBy("conv", "digest"))
    again = each.withColumn("first", first).where("chunk > first")
    again = again.groupBy("conv", "chunk").agg(F.collect_list("row").alias("again"))
    joined = chunks.drop("digests").join(again, ["conv", "chunk"], "left")

    def mark(row: dict) -> tuple:
        codes = bytearray(row["codes"])
        for at in row["again"] or ():
            codes[at] = codes[at] & 3 | SEEN
        return (bytes(codes),)

    keep = [c for c in joined.columns if c not in ("codes", "again")]
    return _mapped(joined, "codes binary", mark, keep)


TRIED = "after array<int>, costs array<int>"  # costs a chunk was run from, and those at its beginning


def _stitched(tried: DataFrame) -> DataFrame:
    """``conv, chunk, after, known``: the true costs at each chunk's end, or those to try next.

    A group has a row per chunk and costs tried, so about a four-thousandth of the rows.
    """

    def stitch(rows: pd.DataFrame) -> pd.DataFrame:
        memo: dict[int, dict[Costs, Costs]] = defaultdict(dict)
        for chunk, after, costs in zip(rows["chunk"], rows["after"], rows["costs"]):
            memo[chunk][tuple(map(int, after))] = tuple(map(int, costs))
        order = sorted(memo, reverse=True)
        end, found = normal(AT_END), []
        for at, chunk in enumerate(order):
            if end not in memo[chunk]:
                at_borders = {end, *(c for of in memo.values() for c in of.values())}
                asked = [(c, costs) for c in order[at:] for costs in sorted(at_borders) if costs not in memo[c]]
                break
            found.append((chunk, end))
            end = memo[chunk][end]
        else:
            asked = []
        out = [(c, list(e), True) for c, e in found] + [(c, list(e), False) for c, e in asked]
        made = pd.DataFrame(out, columns=["chunk", "after", "known"])
        made.insert(0, "conv", rows["conv"].iloc[0])
        return made

    ddl = "conv string, chunk long, after array<int>, known boolean"
    return tried.groupBy("conv").applyInPandas(stitch, schema_of(ddl))


def _true_ends(chunks: DataFrame) -> DataFrame:
    """``conv, chunk, after``: the true costs at each chunk's end, by fix-up passes."""
    codes = chunks.select("conv", "chunk", "codes")

    def guess(row: dict) -> tuple:
        return list(GUESS), list(backward(row["codes"], GUESS))

    def again(row: dict) -> tuple:
        return (list(fix_up(row["codes"], tuple(row["after"]), tuple(row["guessed"]))[0]),)

    tried = stage(_mapped(codes, TRIED, guess, ["conv", "chunk"]))
    codes = codes.join(tried.select("conv", "chunk", F.col("costs").alias("guessed")), ["conv", "chunk"])
    while True:
        stitched = stage(_stitched(tried))
        asked = stitched.where("not known").select("conv", "chunk", "after")
        if asked.isEmpty():
            return stitched.select("conv", "chunk", "after")
        more = _mapped(asked.join(codes, ["conv", "chunk"]), "costs array<int>", again, ["conv", "chunk", "after"])
        tried = tried.unionByName(stage(more))


def _begins(chunks: DataFrame) -> DataFrame:
    """``chunks`` with ``last``, what has come last before each, and ``closing``, whether none follows."""

    def ways(row: dict) -> tuple:
        return ([trace(row["codes"], tuple(row["after"]), last, row["closing"])[2] for last in range(4)],)

    def stitch(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        last, found = NOTHING, []
        for way in rows["ways"]:
            found.append(last)
            last = int(way[last])
        return rows[["conv", "chunk"]].assign(last=found)

    goes = _mapped(chunks.select("conv", "chunk", "codes", "after", "closing"), "ways array<int>", ways, ["conv", "chunk"])
    begins = goes.groupBy("conv").applyInPandas(stitch, schema_of("conv string, chunk long, last int"))
    return chunks.join(begins, ["conv", "chunk"])


MADE = "audit string, cost long, blank long, duplicate long, truncated long, new_roles array<string>, new_texts array<string>"


def _edit(row: dict) -> tuple:
    codes = row["codes"]
    alone = row["alone"]
    end, last, closing = (AT_END, NOTHING, True) if alone else (tuple(row["after"]), row["last"], row["closing"])
    audit, made, _ = trace(codes, end, last, closing)
    stay = [letter for letter in audit if letter != "I"]
    cost = DELETE * stay.count("D") + REROLE * stay.count("R") + INSERT * audit.count("I")
    cost += UNFINISHED * sum(bool(c & CUT_SHORT) and e != "D" for c, e in zip(codes, stay))
    faults = [sum(bool(c & flag) for c in codes) for flag in (BLANK, SEEN, CUT_SHORT)]
    return audit, cost, *faults, *edited(audit, made, row["roles"], row["texts"])


def repair_conversations(rows: DataFrame, lost: Column | None = None) -> DataFrame:
    """One row per chunk: ``conv_id, conv, chunk, alone``, its ``audit`` (an initial for each edit: Delete,
    Insert, Keep, Rerole), ``cost``, faults, and ``roles`` and ``texts`` after the edits.

    Chunks of a conversation sort by ``chunk``; ``alone`` ones are the whole of theirs, and ``conv`` names
    it (``i`` and the id, or ``n`` where the id is null).  Rows come by turn, null ones first; ties by
    role, text and, beyond 200 characters, its digest.  Null roles and texts count as one space; null ids are
    one conversation.  Rows where ``lost`` holds are not there, but their conversation is.  A text of any
    length is kept whole.  Repeated rows are duplicates.  An empty table gives an empty one; columns
    other than ``conv_id, turn, role, text`` are not read.
    """
    space = F.lit(" ")
    given = rows.select(
        "conv_id",
        F.coalesce(F.concat(F.lit("i"), F.col("conv_id").cast("string")), F.lit("n")).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        F.coalesce(lost if lost is not None else F.lit(False), F.lit(False)).alias("lost"),
    )
    chunks = stage(_cut_up(given))
    facts = schema_of(FACTS).names
    keep = ["conv_id", "conv", "chunk", "alone", *facts]
    alone = chunks.where("alone").drop("digests")
    shared = stage(_seen_before(chunks.where("not alone")))
    place = Window.partitionBy("conv").orderBy("chunk")
    closing = shared.select("conv", "chunk", F.lead("chunk").over(place).isNull().alias("closing"))
    ends = _true_ends(shared).join(closing, ["conv", "chunk"])
    begun = _begins(shared.join(ends, ["conv", "chunk"]))
    made = _mapped(alone, MADE, _edit, keep).unionByName(_mapped(begun, MADE, _edit, keep))
    return made.withColumnsRenamed({"new_roles": "roles", "new_texts": "texts"})


def _hash_shared(parts: DataFrame) -> DataFrame:
    """``conv, repaired_sha256`` of conversations in several chunks.

    A digest of one text can only be taken from its beginning to its end: one task reads a
    conversation's chunks in order, a few at a time, whatever their number.
    """
    schema = schema_of("conv string, repaired_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, begun = None, None, False
        for batch in batches:
            done = []
            for conv, said in zip(batch.column("conv").to_pylist(), batch.column("said").to_pylist()):
                if conv != current:
                    if current is not None:
                        done.append((current, digest.hexdigest()))
                    current, digest, begun = conv, hashlib.sha256(), False
                if said is not None:
                    digest.update((b"\n" if begun else b"") + said.encode())
                    begun = True
            yield _pairs(done)
        if current is not None:
            yield _pairs([(current, digest.hexdigest())])

    def _pairs(done: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(list(c), pa.string()) for c in (zip(*done) if done else ([], []))]
        return pa.RecordBatch.from_arrays(columns, names=["conv", "repaired_sha256"])

    said = parts.select("conv", "chunk", F.when(F.size("roles") > 0, _said()).alias("said"))
    return said.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(run, schema)


def _said() -> Column:
    lines = F.zip_with("roles", "texts", lambda role, text: F.concat(role, F.lit(":"), text))
    return F.array_join(lines, "\n")


def report(parts: DataFrame) -> DataFrame:
    """One row per conversation of ``repair_conversations``: ``conv_id``, ``gaps`` in the turns, faults,
    ``illegal`` neighbours, ``cost``, ``audit`` and the digest of the repaired conversation.

    The audit of a conversation is one field, however many rows it has.
    """
    parts = stage(parts)
    whole = parts.where("alone").select(
        "conv_id",
        *(F.col(c) for c in ("low", "high", "turns", "blank", "duplicate", "truncated", "illegal", "cost", "audit")),
        F.sha2(_said().cast("binary"), 256).alias("repaired_sha256"),
    )
    shared = parts.where("not alone")
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    initial = F.last("last_initial", ignorenulls=True).over(earlier)
    turn = F.last("last_turn", ignorenulls=True).over(earlier)
    meeting = F.concat(initial, F.col("first_initial"))
    facts = shared.select(
        *(c for c in shared.columns if c not in ("roles", "texts")),
        F.coalesce(~meeting.isin(*LEGAL), F.lit(False)).cast("long").alias("met"),
        F.coalesce(turn == F.col("first_turn"), F.lit(False)).cast("long").alias("same_turn"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("chunk", "audit")))
    joined = facts.groupBy("conv").agg(
        F.first("conv_id").alias("conv_id"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        (F.sum("turns") - F.sum("same_turn")).alias("turns"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")),
        (F.sum("illegal") + F.sum("met")).alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(ordered, lambda x: x["audit"]), "").alias("audit"),
    )
    joined = joined.join(_hash_shared(shared), "conv").drop("conv")
    return whole.unionByName(joined).select(
        "conv_id",
        F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps"),
        "blank",
        "duplicate",
        "truncated",
        "illegal",
        "cost",
        "audit",
        "repaired_sha256",
    )
