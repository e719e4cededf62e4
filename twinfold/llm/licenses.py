"""License scans: one pass of an Aho-Corasick automaton for phrases and one for tags.

Notice phrases are sought in the words of a text, tags such as ``SPDX-License-Identifier:``
in the text itself.  What follows a tag is read as a license expression: a
shunting-yard parser puts it in postfix order, and evaluating that gives the licenses it
names and how freely the text may be used (``or``: the freer one, ``and``: the
stricter, ``with``: a step freer).
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import map_batches, text_or_empty

# Phrases and labels of the contract.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
NOTICES = {
    "gnu general public license version 3": "gpl-3.0",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl-3.0",
    "mozilla public license": "mpl-2.0",
    "eclipse public license": "epl-2.0",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "permission is hereby granted free of charge": "mit",
    "creative commons attribution": "cc-by",
    "dedicated to the public domain": "cc0-1.0",
    "all rights reserved": "all-rights-reserved",
}
# Tags that only a license expression follows, and tags that also stand before other text.
EXACT_TAGS = ("spdx-license-identifier:", "license-expression:")
LOOSE_TAGS = ("license:", "licence:")

# Families of licenses, by what their identifiers begin with.
FAMILIES = (
    "0bsd afl agpl apache apl apsl artistic beerware bittorrent blessing boost bsd bsl bzip2 cc cc0 cddl cdla "
    "cecill cern cpl curl ecl efl epl eupl fsfap ftl gfdl gpl hpnd icu ijg imagemagick intel ipl isc json lgpl "
    "libpng libtiff linux-openib lppl lpl miros mit mpl ms-pl ms-rl mulanpsl nasa ncsa netcdf ngpl nokia ntp "
    "odbl odc ofl openssl osl pddl php postgresql psf python qpl ruby sendmail sgi sissl sleepycat spl tcl "
    "unicode unlicense upl vim w3c wtfpl x11 xfree86 xnet zend zlib zpl"
).split()

# How freely a text under a license may be used; of the first prefix that fits.
FREEDOM = (
    ("all-rights-reserved", 0.0),
    ("cc-by-nc", 0.2),
    ("agpl", 0.3),
    ("lgpl", 0.6),
    ("gpl", 0.4),
    ("mpl", 0.6),
    ("epl", 0.6),
    ("cc-by-sa", 0.5),
    ("cc-by", 0.8),
    ("cc0", 1.0),
    ("mit", 1.0),
    ("apache", 1.0),
    ("bsd", 1.0),
    ("isc", 1.0),
)
UNKNOWN = 0.5
EXCEPTION = 0.1

SEPARATORS = bytes.maketrans(
    bytes(range(0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80)),
    b" " * (0x30 + 0x61 - 0x3A + 0x80 - 0x7B),
)
BINDING = {"or": 1, "and": 2, "with": 3}
PIECE = re.compile(r"[ \t]*([()]|[a-z0-9][a-z0-9.+-]*)")
# An identifier after a loose tag: a family, then versions and variants.
KNOWN = re.compile(rf"({'|'.join(FAMILIES)})(v?\d[\d.]*\+?)?(-[a-z0-9.+]+)*\+?\.?$")
EXCEPTIONS = re.compile(r".*exception|.*-note\.?$")


def freedom(license_id: str) -> float:
    return next((f for prefix, f in FREEDOM if license_id.startswith(prefix)), UNKNOWN)


def postfix(text: str, at: int = 0, exact: bool = False) -> list[str]:
    """The license expression from ``at`` on in lower-case ``text``, operators behind operands.

    Where it is ``exact``, any identifier is an operand, else those of known families are, and names
    of exceptions after ``with``.  Reading stops where the expression can't go on; an operator without its right side and
    parentheses without their other half are left out.
    """
    out: list[str] = []
    waiting: list[str] = []
    operand_next, open_count = True, 0
    pieces: list[str] = []
    while m := PIECE.match(text, at):
        piece = m[1]
        if operand_next:
            if piece in BINDING or piece == ")":
                break
            if piece != "(" and not exact and not KNOWN.match(piece):
                if not (pieces and pieces[-1] == "with" and EXCEPTIONS.match(piece)):
                    break
            open_count += piece == "("
            operand_next = piece == "("
        else:
            if piece == "(" or (piece != ")" and piece not in BINDING) or (piece == ")" and not open_count):
                break
            open_count -= piece == ")"
            operand_next = piece in BINDING
        pieces.append(piece.rstrip(".") if piece not in "()" else piece)
        at = m.end()
    while pieces and (pieces[-1] in BINDING or pieces[-1] == "("):
        pieces.pop()
    for piece in pieces:
        if piece == "(":
            waiting.append(piece)
        elif piece == ")":
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if waiting:
                waiting.pop()
        elif piece in BINDING:
            while waiting and BINDING.get(waiting[-1], 0) >= BINDING[piece]:
                out.append(waiting.pop())
            waiting.append(piece)
        else:
            out.append(piece)
    out += [p for p in reversed(waiting) if p != "("]
    return out


def evaluate(expression: list[str]) -> tuple[set[str], float] | None:
    """Licenses of a postfix expression and how freely the text may be used."""
    stack: list[tuple[set[str], float]] = []
    for piece in expression:
        if piece in BINDING:
            right, left = stack.pop(), stack.pop()
            if piece == "with":
                stack.append((left[0], min(1.0, left[1] + EXCEPTION)))
            else:
                stack.append((left[0] | right[0], (max if piece == "or" else min)(left[1], right[1])))
        else:
            stack.append(({piece}, freedom(piece)))
    return stack.pop() if stack else None


def _automaton(words: dict[str, object]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for word, value in words.items():
        automaton.add_word(word, (value, len(word)))
    automaton.make_automaton()
    return automaton


class Scanner:
    def __init__(self):
        # Words stand between single spaces, so a phrase is found as " phrase ".
        phrases = {f" {p} ": (label, p in BASE) for p, label in (NOTICES | BASE).items()}
        self.phrases = _automaton(phrases)
        self.tags = _automaton({t: t in EXACT_TAGS for t in EXACT_TAGS + LOOSE_TAGS})

    def __call__(self, text: str) -> dict:
        lower = text.encode().lower()
        words = b" ".join(lower.translate(SEPARATORS).split()).decode()
        base, labels, values, starts = set(), set(), [], []
        for end, ((label, is_base), length) in self.phrases.iter(f" {words} "):
            labels.add(label)
            values.append(freedom(label))
            if is_base:
                base.add(label)
                starts.append(end + 1 - length)
        plain = lower.decode()
        for end, (exact, length) in self.tags.iter(plain):
            before = plain[end - length] if end >= length else " "
            if before.isalnum() or before == "-":
                continue
            found = evaluate(postfix(plain, end + 1, exact))
            if found:
                labels |= found[0]
                values.append(found[1])
        # The n-th space of " w0 w1 ..." stands before word n.
        places = [words.count(" ", 0, s) if s else 0 for s in (min(starts), max(starts))] if starts else [None, None]
        return {
            "n_words": words.count(" ") + 1 if words else 0,
            "n_base": len(starts),
            "first_word": places[0],
            "last_word": places[1],
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(labels | base)),
            "score": min(values, default=0.0),
        }


COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan_licenses(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score``.

    ``n_base`` counts the places of the base phrases; ``score`` is how freely the text may be
    used by the strictest statement in it, 0 without any.  Null and empty texts have no
    words and no labels.  Rows are scanned each on their own, without a shuffle.  Other
    columns are not read.
    """

    def start():
        scan = Scanner()

        def step(batch: pa.RecordBatch) -> dict:
            found = [scan(t) for t in batch.column("text").to_pylist()]
            names = [c.split()[0] for c in COLUMNS.split(", ")]
            return {"doc_id": batch.column("doc_id")} | {n: [f[n] for f in found] for n in names}

        return step

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return map_batches(rows, "doc_id long, " + COLUMNS, start)
