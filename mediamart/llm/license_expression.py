"""Licence expressions: a shunting-yard parser and their evaluation.

    expression := term {("and" | "or") term}      "and" binds before "or"
    term       := identifier ["with" exception] | "(" expression ")"

An expression ends before the first token that cannot go on with it, so it can be
read from running text.
"""

from __future__ import annotations

import re
from typing import NamedTuple

TOKEN = re.compile(r"[ \t]*(?:([()])|([a-z0-9](?:[a-z0-9.:-]*[a-z0-9])?\+?))", re.A)
BINDS = {"with": 3, "and": 2, "or": 1}

# Families of licence identifiers and what their terms ask of a reader:
# 0 nothing, 1 attribution, 2 the same licence for changed files, 3 the same licence
# for the whole work, 4 no free use.
DUTY = {
    "cc0": 0, "unlicense": 0, "0bsd": 0, "wtfpl": 0, "public-domain": 0,
    "mit": 1, "apache": 1, "bsd": 1, "isc": 1, "zlib": 1, "bsl": 1, "psf": 1, "ofl": 1, "cc-by": 1,
    "lgpl": 2, "mpl": 2, "epl": 2, "cddl": 2,
    "gpl": 3, "agpl": 3, "eupl": 3, "cc-by-sa": 3,
    "cc-by-nc": 4, "cc-by-nd": 4, "proprietary": 4,
}
UNKNOWN = 4


class Terms(NamedTuple):
    """``duty``: the least a reader has to keep to; ``families``: licences named."""
    duty: int
    families: frozenset


def family(identifier: str) -> str | None:
    """The longest known family an identifier begins with, or None."""
    parts = re.split(r"[-.:]", identifier.rstrip("+"))
    return next((x for k in range(min(len(parts), 3), 0, -1) if (x := "-".join(parts[:k])) in DUTY), None)


def is_identifier(word: str) -> bool:
    """Known, or written like an identifier (LicenseRef-Acme, Foo-1.0)."""
    return word not in BINDS and (family(word) is not None or re.search(r"[0-9-]", word) is not None)


def postfix(text: str, at: int = 0) -> tuple[list[str], int]:
    """The expression at ``at`` of a lower-case text in postfix order, and its end.

    Brackets never closed and an operator without a second operand are left out;
    where no expression begins the list is empty. Linear in the tokens read.
    """
    out, waiting, operand = [], [], True  # operand: whether one is due
    while m := TOKEN.match(text, at):
        bracket, word = m.groups()
        if operand and bracket == "(":
            waiting.append(bracket)
        elif operand and word and is_identifier(word):
            out.append(word)
            operand = False
        elif not operand and bracket == ")" and "(" in waiting:
            while (top := waiting.pop()) != "(":
                out.append(top)
        elif not operand and word in BINDS and not (word == "with" and ("with" in waiting[-1:] or out[-1] in BINDS)):
            while waiting and BINDS.get(waiting[-1], 0) >= BINDS[word]:
                out.append(waiting.pop())
            waiting.append(word)
            operand = True
        else:
            break
        at = m.end()
    if operand:
        while waiting and waiting[-1] == "(":
            waiting.pop()
        if waiting:
            waiting.pop()
    return out + [x for x in reversed(waiting) if x != "("], at


def evaluate(tokens: list[str]) -> Terms | None:
    """Duty and families of a postfix expression; None if it is empty.

    Of alternatives a reader takes the lighter, of joint terms the heavier holds,
    and an exception makes a duty of 2 or 3 lighter by one. An unknown licence
    counts as no free use."""
    stack: list[Terms] = []
    for token in tokens:
        if token not in BINDS:
            name = family(token)
            stack.append(Terms(DUTY.get(name, UNKNOWN), frozenset([name] if name else ())))
            continue
        b, a = stack.pop(), stack.pop()
        if token == "with":
            stack.append(Terms(a.duty - (a.duty in (2, 3)), a.families))
        else:
            stack.append(Terms((min if token == "or" else max)(a.duty, b.duty), a.families | b.families))
    return stack[0] if stack else None
