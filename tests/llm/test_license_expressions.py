"""License expressions against a parser that descends, and what follows loose tags."""

import random

import pytest

from twinfold.llm import licenses

SCAN = licenses.Scanner()
NAMES = "MIT OpenSSL Apache-2.0 GPL-3.0-only WTFPL LicenseRef-own CC-BY-SA-4.0 Beerware NCSA 0BSD".split()


def drawn(draw, depth=0):
    kind = draw.random()
    if depth > 3 or kind < 0.35:
        return draw.choice(NAMES)
    if kind < 0.5:
        return f"({drawn(draw, depth + 1)})"
    if kind < 0.6:
        return f"{draw.choice(NAMES)} WITH {draw.choice(['Classpath-exception-2.0', 'LLVM-exception'])}"
    return f"{drawn(draw, depth + 1)} {draw.choice(['AND', 'OR', 'and', 'Or'])} {drawn(draw, depth + 1)}"


class Descent:
    """or < and < with, by a function for each."""

    def __init__(self, text):
        self.pieces = text.lower().replace("(", " ( ").replace(")", " ) ").split()

    def take(self, *wanted):
        if self.pieces and self.pieces[0] in wanted:
            return self.pieces.pop(0)

    def either(self):
        names, free = self.both()
        while self.take("or"):
            more, other = self.both()
            names, free = names | more, max(free, other)
        return names, free

    def both(self):
        names, free = self.one()
        while self.take("and"):
            more, other = self.one()
            names, free = names | more, min(free, other)
        return names, free

    def one(self):
        if self.take("("):
            found = self.either()
            assert self.take(")")
        else:
            name = self.pieces.pop(0)
            found = {name}, licenses.freedom(name)
        if self.take("with"):
            self.pieces.pop(0)
            found = found[0], min(1.0, found[1] + licenses.EXCEPTION)
        return found


@pytest.mark.parametrize("seed", range(300))
def test_expressions(seed):
    text = drawn(random.Random(seed))
    names, free = Descent(text).either()
    found = SCAN(f"x\nSPDX-License-Identifier: {text}\nand so on")
    # The line's end is no blank, so that reading stops there.
    assert found["labels"] == ",".join(sorted(names)) and found["score"] == pytest.approx(free)
    assert found["base_labels"] == "" and found["n_base"] == 0


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("License: 2024 edition", ""),
        ("driver license: b-123", ""),
        ("license: see-below", ""),
        ("SPDX-License-Identifier: OpenSSL", "openssl"),
        ("License: GPL", "gpl"),
        ("License: BSD.", "bsd"),
        ("Licence: Apache", "apache"),
        ("SPDX-License-Identifier: MIT AND OpenSSL", "mit,openssl"),
        ("license: mit OR gplv3", "gplv3,mit"),
        ("license: GPL-2.0+ with Classpath-exception-2.0 or mitigated", "gpl-2.0+"),
        ("license: gpl with some words", "gpl"),
        ("license: the usual", ""),
        ("license: mitigation", ""),
        ("license: AND MIT", ""),
        ("SPDX-License-Identifier: OR", ""),
        ("sub-license: MIT", ""),
        ("license: (mit or (bsd-3-clause", "bsd-3-clause,mit"),
        ("License-Expression: own-1", "own-1"),
        ("license: 0bsd", "0bsd"),
    ],
)
def test_tags(text, labels):
    assert SCAN(text)["labels"] == labels
