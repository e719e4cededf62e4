"""Secret scans by a linear-chain conditional random field over tokens.

Base patterns find assignments of named secrets, access keys and long hexadecimal runs.
The field tags tokens as the beginning (B) or the inside (I) of a secret or as outside (O),
from the token's shape and text, the tokens next to it and features of the whole text.  It
is fitted on a bounded sample whose tokens inside base spans are labelled B and I, and on variants
of its secrets: other characters, other alphabets, between other words.  So it learns what
secrets look like, not only the patterns, and adds those it finds elsewhere, decoded by Viterbi.

Nearly all tokens are words whose score for O is out of reach of the other tags whatever
their neighbours are.  There the best path is O for certain, so the chain falls into
short pieces between such tokens, and only these are decoded.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import map_batches, text_or_empty
from twinfold.llm.crf import Chain, Features, KindScores, hashed
from twinfold.session import stage

# Patterns and kinds of the contract.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)
ASSIGN_MIN = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "field")

NAMES = ("passw", "secret", "token", "api")  # one is in every text with an assignment

TOKEN = re.compile(r"[\w+/.-]+=*|[^\w\s+/.-]+")
OUTSIDE, BEGIN, INSIDE = range(3)
SIZE = 1 << 14
PLACES = 3

# Bounds of the sample that the model is fitted on.
SAMPLE_WITH, SAMPLE_WITHOUT = 150, 100

# Variants of each secret of the sample, and the text kept on either side of one.
VARIANTS, AROUND, BARE = 4, 120, 0.75
LOWER = "abcdefghijklmnopqrstuvwxyz"
DIGITS = "0123456789"
ALPHABETS = (DIGITS + LOWER[:6], DIGITS + LOWER, DIGITS + LOWER.upper(), DIGITS + LOWER + LOWER.upper())

Span = tuple[int, int, int]  # start, number of the kind, end


def base_spans(text: str) -> list[Span]:
    """Matches of the base patterns, whole, in code points."""
    found = []
    lower = text.lower()
    if any(name in lower for name in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def secret_parts(text: str) -> list[tuple[int, int]]:
    """The secrets themselves: of an assignment, what is assigned."""
    parts = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    parts += [m.span() for m in ACCESS.finditer(text)] + [m.span() for m in HEX.finditer(text)]
    return parts


def shape(token: str) -> str:
    """Classes of the characters, runs shortened."""
    out = []
    for c in token[:64]:
        k = "9" if c.isdigit() else "h" if c in "abcdef" else "a" if c.islower() else "A" if c.isupper() else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out)[:12]


@lru_cache(100_000)
def _look(length: int, tenths: int, mixed: bool, hexadecimal: bool, upper: bool, capitals: int, variety: int, form: str) -> list[int]:
    """Features of what a token looks like; few tokens look unlike all others."""
    return hashed(
        [
            "bias",
            f"l{length}",
            f"d{tenths}",
            f"m{mixed}{length}",
            f"x{hexadecimal}{length}",
            f"u{upper}{mixed}",
            f"c{capitals}{mixed}",
            f"v{variety}{length}",
            f"s{form}",
        ],
        SIZE,
    )


@lru_cache(100_000)
def _look_beside(side: str, length: int, mixed: bool) -> tuple[list[int], list[int]]:
    """Features of a neighbour's look, before and after the one for its text."""
    first, last = [f"{side}bias", f"{side}l{length}"], [f"{side}m{mixed}"]
    return hashed(first, SIZE), hashed(last, SIZE)


def token_features(token: str) -> list[list[int]]:
    """Features of a token for its own tag, and for the tags of the tokens after and before."""
    size = len(token)
    length = min(size.bit_length(), 5)  # 16 characters and more are one class
    if token.isalpha():
        digits, letters = 0, size
    else:
        digits, letters = sum(map(str.isdigit, token)), sum(map(str.isalpha, token))
    mixed = digits > 0 and letters > 0
    capitals = 0 if token.islower() else min(sum(map(str.isupper, token)), 4)
    own = _look(
        length,
        10 * digits // size,
        mixed,
        not token.strip("0123456789abcdef"),
        token.isupper(),
        capitals,
        10 * len({*token}) // size,
        shape(token) if mixed or not letters else "word",
    )
    short = size <= 12
    text = token.lower() if short else ""
    if short and not digits:
        own = [*own, zlib.crc32(f"w{text}".encode()) & (SIZE - 1)]
    beside = []
    for side in "ba":
        first, last = _look_beside(side, length, mixed)
        beside.append([*first, zlib.crc32(f"{side}w{text}".encode()) & (SIZE - 1), *last])
    return [own, *beside]


def file_features(text: str) -> list[int]:
    """Features of the whole text, which count for all its tokens."""
    lines = text.count("\n") + 1
    return hashed(
        [
            f"f={min(text.count('='), 8)}",
            f"f:{min(8 * text.count(':') // lines, 8)}",
            f"fq{min(text.count(chr(34)), 4)}",
            f"fk{any(n in text.lower() for n in NAMES)}",
        ],
        SIZE,
    )


def redrawn(texts: list[str], rng: np.random.Generator) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Stretches of text with other secrets, and where these lie: for each secret of ``texts`` some
    in its place, and some bare between any words of the sample."""
    for text in texts:
        for start, end in secret_parts(text):
            for _ in range(VARIANTS):
                letters = ALPHABETS[rng.integers(len(ALPHABETS))]
                drawn = "".join(letters[i] for i in rng.integers(0, len(letters), rng.integers(16, 49)))
                before, after = text[:start], text[end:]
                if rng.random() < BARE:
                    other = texts[rng.integers(len(texts))]
                    at = other.find(" ", rng.integers(len(other) + 1)) + 1  # 0: before all words
                    before, after = other[:at], " " + other[at:]
                before = before[-AROUND:]
                variant, place = before + drawn + after[:AROUND], (len(before), len(before) + len(drawn))
                yield variant, [place, *secret_parts(variant)]


def fit(texts: list[str]) -> Chain:
    """The field fitted on texts labelled by the base patterns, and on variants of their secrets.

    File features enter as one further kind in front of each text's tokens: they are added
    to all tokens of the text when scoring, and learned from the same sums.
    """
    kinds: dict[str, int] = {}
    tokens, labels, files = [], [], []
    rng = np.random.default_rng(0)
    labelled = [(t, secret_parts(t)) for t in texts]
    labelled += redrawn(texts, rng)
    for text, parts in labelled:
        row, tags = [], []
        for m in TOKEN.finditer(text):
            row.append(kinds.setdefault(m[0], len(kinds)))
            inside = next((p for p in parts if p[0] < m.end() and m.start() < p[1]), None)
            before = inside is not None and tags and tags[-1][1] == inside
            tags.append((OUTSIDE if inside is None else INSIDE if before else BEGIN, inside))
        tokens.append(np.array(row, np.int64))
        labels.append(np.array([t for t, _ in tags], np.int64))
        files.append(file_features(text))
    described = [token_features(k) for k in kinds]
    # A text's own kinds: file features make kinds of (token, file) where they differ.
    variants: dict[tuple[int, tuple], int] = {}
    own: list[list[int]] = []
    nears: list[list[list[int]]] = [[], []]
    for row, extra in zip(tokens, files):
        for i, k in enumerate(row):
            key = (int(k), tuple(extra))
            if key not in variants:
                variants[key] = len(own)
                own.append(described[k][0] + extra)
                nears[0].append(described[k][1])
                nears[1].append(described[k][2])
            row[i] = variants[key]
    chain = Chain(3, SIZE, PLACES)
    if own:
        chain.fit([Features(own), Features(nears[0]), Features(nears[1])], tokens, labels, rounds=40)
    return chain


def viterbi(scores: np.ndarray, transitions: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The best path; ``first`` and ``last`` are what the neighbours at its ends add."""
    best, back = scores[0] + first, []
    for row in scores[1:]:
        ways = best[:, None] + transitions
        back.append(ways.argmax(axis=0))
        best = ways.max(axis=0) + row
    path = [int((best + last).argmax())]
    for step in reversed(back):
        path.append(int(step[path[-1]]))
    return np.array(path[::-1])


class Tagger:
    def __init__(self, chain: Chain):
        self.chain = chain
        self.kinds = KindScores(chain, token_features)
        t = chain.transitions
        # The most that neighbours can add to a tag over O.
        gains = [
            (t[:, s][:, None] + t[s][None, :] - t[:, OUTSIDE][:, None] - t[OUTSIDE][None, :]).max()
            for s in (BEGIN, INSIDE)
        ]
        ends = [max((t[:, s] - t[:, OUTSIDE]).max(), (t[s] - t[OUTSIDE]).max(), 0.0) for s in (BEGIN, INSIDE)]
        self.reach = np.array([max(g, e) for g, e in zip(gains, ends)])

    def tags(self, text: str, tokens: list[str]) -> np.ndarray:
        """The best tags of all tokens."""
        self.kinds.add({*tokens})
        kinds = np.fromiter(map(self.kinds.numbers.__getitem__, tokens), np.int64, len(tokens))
        own, before, after = self.kinds.tables
        scores = own[kinds] + self.chain.weights[0][file_features(text)].sum(axis=0)
        scores[1:] += before[kinds[:-1]]
        scores[:-1] += after[kinds[1:]]
        tags = np.full(len(tokens), OUTSIDE)
        open_ = np.flatnonzero(
            ((scores[:, 1:] - scores[:, :1] + self.reach) >= 0).any(axis=1)
        )
        if len(open_):
            t, none = self.chain.transitions, np.zeros(3)
            for piece in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1):
                a, b = piece[0], piece[-1] + 1
                first = t[OUTSIDE] if a else none
                last = t[:, OUTSIDE] if b < len(tokens) else none
                tags[a:b] = viterbi(scores[a:b], t, first, last)
        return tags

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Secrets as the field finds them; one that goes on without a beginning begins there."""
        tokens = TOKEN.findall(text)
        if not tokens:
            return []
        tags = self.tags(text, tokens)
        if not tags.any():
            return []
        places = [m.span() for m in TOKEN.finditer(text)]
        found: list[tuple[int, int]] = []
        for i in np.flatnonzero(tags):
            if tags[i] == INSIDE and found and i and tags[i - 1]:
                found[-1] = (found[-1][0], places[i][1])
            else:
                found.append(places[i])
        return found


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _hint() -> Column:
    """Whether a text may have base spans.  Plain words come first, as they are found fastest."""
    lower = F.lower("text")
    names = [lower.contains(n) for n in ("passw", "secret", "token", "apikey", "api_key")]
    access = lower.contains("akia") & lower.rlike("akia[a-z0-9]{16}")
    return reduce(Column.__or__, [*names, access, lower.rlike("[0-9a-f]{24}")])


def sample(documents: DataFrame) -> list[str]:
    """Texts to fit on, by a hash of the id: ``SAMPLE_WITH`` that may have base spans and
    ``SAMPLE_WITHOUT`` others.

    All texts are looked at once, for a written table of hints and hashes; then texts are read
    for the hashes that may be chosen.
    """
    rows = documents.select(text_or_empty().alias("text"), F.xxhash64("doc_id").alias("draw"))
    drawn = stage(rows.select("draw", _hint().alias("hint")))
    out = []
    for hint, most in ((True, SAMPLE_WITH), (False, SAMPLE_WITHOUT)):
        first = drawn.where(F.col("hint") == hint).select("draw").orderBy("draw").limit(most)
        last = first.agg(F.max("draw")).first()[0]
        if last is not None:
            near = rows.where(F.col("draw") <= last).where(_hint() == hint)
            chosen = near.orderBy("draw", F.length("text"), "text")
            out += [r["text"] for r in chosen.limit(most).collect()]
    return out


COLUMNS = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan(documents: DataFrame, chain: Chain) -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    ``spans`` lists ``kind:start:end`` of whole base matches (assign, access, hex) and of what the
    field adds (field), which never overlaps a base match.  Null and empty texts have none.
    Rows are scanned each on their own.  Other columns are not read.
    """
    shipped = documents.sparkSession.sparkContext.broadcast(chain)  # of fixed size

    def start():
        chain = shipped.value
        if not hasattr(chain, "tagger"):  # one for all tasks of a worker, which keeps the tokens it has met
            chain.tagger = Tagger(chain)
        tagger = chain.tagger

        def one(text: str) -> tuple:
            base = base_spans(text)
            added = [
                (a, 3, b) for a, b in tagger.spans(text) if not any(x < b and a < y for x, _, y in base)
            ]
            counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
            sha = hashlib.sha256(listed(base).encode()).hexdigest()
            return (*counts, sha, listed(sorted(base + added)))

        def step(batch: pa.RecordBatch) -> dict:
            found = [one(t) for t in batch.column("text").to_pylist()]
            names = [c.split()[0] for c in COLUMNS.split(", ")]
            columns = zip(*found) if found else [[]] * len(names)
            return {"doc_id": batch.column("doc_id")} | {n: list(c) for n, c in zip(names, columns)}

        return step

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return map_batches(rows, "doc_id long, " + COLUMNS, start)


def scan_secrets(documents: DataFrame) -> DataFrame:
    """``scan`` with a field fitted on a sample of the same documents."""
    return scan(documents, fit(sample(documents)))
