"""License scans: an Aho-Corasick automaton over words, and a parser of licence expressions."""

import re
from collections import deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.text import ALNUM, Words, hash_words, pieces, words

# Base phrases, and the label of each.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Further notice phrases, and the label of each.
NOTICES = (
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("bsd license", "bsd"),
    ("isc license", "isc"),
    ("boost software license", "bsl"),
    ("creative commons attribution", "cc-by"),
)
# Phrases that a licence expression follows.
TAGS = ("spdx license identifier",)
LEADS = ("licensed under", "released under")
# Licence identifiers, by how far they restrict who passes a work on.
PERMISSIVE = (
    "0BSD Apache-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 CC0-1.0 ISC MIT Unlicense Zlib"
).split()
WEAK = (
    "CDDL-1.0 EPL-2.0 LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only "
    "LGPL-3.0-or-later MPL-2.0"
).split()
STRONG = (
    "AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later CC-BY-SA-4.0 GPL-2.0 GPL-2.0-only "
    "GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later"
).split()
TERMS = ("permissive", "weak copyleft", "strong copyleft", "unknown")

_LEVEL = {name.lower(): level for level, names in enumerate((PERMISSIVE, WEAK, STRONG)) for name in names}
_BINDS = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(rb"[ \t]*([()]|[A-Za-z0-9](?:[A-Za-z0-9.+:-]*[A-Za-z0-9+])?)")
_LEAD = re.compile(rb"[ \t:]*")

COLUMNS = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, expression string, terms string"
)


@dataclass
class Automaton:
    """Finds all places where patterns, given as sequences of symbols, stand."""

    patterns: Sequence[tuple[int, ...]]
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    fail: list[int] = field(default_factory=lambda: [0])
    ends: list[tuple[int, ...]] = field(default_factory=lambda: [()])

    def __post_init__(self) -> None:
        for number, pattern in enumerate(self.patterns):
            state = 0
            for symbol in pattern:
                if symbol not in self.step[state]:
                    self.step[state][symbol] = len(self.step)
                    self.step.append({})
                    self.fail.append(0)
                    self.ends.append(())
                state = self.step[state][symbol]
            self.ends[state] += (number,)
        queue = deque(self.step[0].values())
        while queue:
            state = queue.popleft()
            for symbol, child in self.step[state].items():
                self.fail[child] = self.next(self.fail[state], symbol)
                self.ends[child] += self.ends[self.fail[child]]
                queue.append(child)

    def next(self, state: int, symbol: int) -> int:
        while symbol not in self.step[state]:
            if not state:
                return 0
            state = self.fail[state]
        return self.step[state][symbol]


@dataclass(frozen=True)
class Expression:
    """A licence expression in normal form, its licences and how far it restricts."""

    text: str
    names: tuple[str, ...]
    level: int
    binds: int = 4


def parse_expression(text: str) -> Expression | None:
    """The longest licence expression that ``text`` begins with, or None.

    Operators ``or``, ``and`` and ``with`` in any case, ``with`` binding closest, and
    parentheses. A conjunction restricts as its strictest part does, a choice as its
    freest, and an exception turns strong copyleft into weak. An expression that breaks
    off is cut where it was last complete.
    """
    data = text.encode(errors="replace")
    return _evaluate(_longest(data, 0, len(data)))


def _longest(data: bytes | memoryview, start: int, end: int) -> list[str]:
    """Tokens of the longest whole expression at ``start``, read until none can follow."""
    tokens: list[str] = []
    whole = depth = 0
    operand, last = True, ""
    while found := _TOKEN.match(data, start, end):
        start = found.end()
        token = found[1].decode()
        name = token.lower()
        if token == "(":
            if not operand:
                break
            depth += 1
        elif token == ")":
            if operand or not depth:
                break
            depth -= 1
        elif name in _BINDS:
            if operand:
                break
            operand = True
        else:
            known = name in _LEVEL or name.startswith("licenseref-") or last == "with"
            if not operand or not known:
                break
            operand = False
        tokens.append(token)
        last = name
        if not operand and not depth:
            whole = len(tokens)
    return tokens[:whole]


def _evaluate(tokens: Sequence[str]) -> Expression | None:
    """Shunting-yard over a whole expression: operators wait until one that binds less closely comes.

    A value is its text, as nested parts that are put together once, its level and how
    closely it binds.
    """
    values: list[tuple] = []
    waiting: list[str] = []
    names: dict[str, None] = {}

    def reduce() -> None:
        right, left = values.pop(), values.pop()
        values.append(_join(waiting.pop(), left, right))

    for token in tokens:
        name = token.lower()
        if token == "(":
            waiting.append("(")
        elif token == ")":
            while waiting[-1] != "(":
                reduce()
            waiting.pop()
        elif name in _BINDS:
            while waiting and waiting[-1] != "(" and _BINDS[waiting[-1]] >= _BINDS[name]:
                reduce()
            waiting.append(name)
        elif waiting and waiting[-1] == "with":
            values.append((token, 0, 4))
        else:
            names[name] = None
            values.append((token, _LEVEL.get(name, 3), 4))
    while waiting:
        reduce()
    if not values:
        return None
    parts, level, binds = values[0]
    return Expression(_flat(parts), tuple(names), level, binds)


def _join(operator: str, left: tuple, right: tuple) -> tuple:
    binds = _BINDS[operator]
    sides = [("(", parts, ")") if b < binds else parts for parts, _, b in (left, right)]
    if operator == "with":
        level = 1 if left[1] == 2 else left[1]
    else:
        level = (min if operator == "or" else max)(left[1], right[1])
    return (sides[0], f" {operator.upper()} ", sides[1]), level, binds


def _flat(parts: str | tuple) -> str:
    found, waiting = [], [parts]
    while waiting:
        part = waiting.pop()
        if isinstance(part, str):
            found.append(part)
        else:
            waiting += reversed(part)
    return "".join(found)


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with what their whole texts say about licences.

    Words are runs of letters and digits, A-Z lower-cased; one automaton finds all phrases
    in one pass. ``n_base`` counts the places where base phrases stand, overlaps included;
    ``first_word`` and ``last_word`` are the least and greatest of their first words,
    counted from 0. ``labels`` adds those of further notices, and ``spdx:`` with each
    licence of an expression behind an identifier tag or behind "licensed under".
    ``expression`` is the first such expression and ``terms`` what it evaluates to, else
    null. ``score`` is 1 for a tag with an expression, 0.9 for a base phrase, 0.6 for other
    notices, else 0. Null and empty texts have no words and no labels. Every row is judged by
    itself, so repeated rows are judged alike, and a table without rows gives none. Columns
    of ``docs`` with one of the names are replaced.
    """
    added = T.StructType.fromDDL(COLUMNS)
    rows = docs.drop(*added.names)
    schema = T.StructType([*rows.schema.fields, *added.fields])
    at = rows.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _Scanner()
        for batch in batches:
            found = []
            for _, data, offsets in pieces(batch.column(at)):
                found += scanner.scan(data, offsets)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.string(), pa.string())
            columns = [pa.array(c, k) for c, k in zip(zip(*found) if found else [[]] * len(kinds), kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], schema.names)

    return rows.mapInArrow(run, schema)


class _Scanner:
    def __init__(self) -> None:
        phrases = [p for p, _ in (*BASE, *NOTICES)] + [*TAGS, *LEADS]
        self.phrases = [p.encode() for p in phrases]
        known = sorted({w for p in self.phrases for w in p.split()})
        number = {w: i for i, w in enumerate(known)}
        self.automaton = Automaton([tuple(number[w] for w in p.split()) for p in self.phrases])
        self.length = [len(p.split()) for p in self.phrases]
        hashes = hash_words(known)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple]:
        found = words(data, offsets, ALNUM)
        counts, first = found.per_row(), found.first()
        places: dict[int, list[tuple[int, int]]] = {}
        for i, pattern in self._matches(found):
            places.setdefault(int(found.row[i]), []).append((i, pattern))
        out = []
        for row in range(found.rows):
            mine = places.get(row)
            if not mine:
                out.append((int(counts[row]), 0, None, None, "", "", 0.0, None, None))
            else:
                end = offsets[row + 1]
                out.append((int(counts[row]), *self._report(found, data, end, first[row], mine)))
        return out

    def _matches(self, found: Words) -> Iterator[tuple[int, int]]:
        """First word and number of every phrase; only words of phrases move the automaton."""
        place = np.minimum(np.searchsorted(self.hashes, found.hash), len(self.hashes) - 1)
        at = np.flatnonzero(self.hashes[place] == found.hash)
        symbols = self.order[place[at]].tolist()
        fresh = np.ones(len(at), bool)
        fresh[1:] = (np.diff(at) > 1) | (np.diff(found.row[at]) > 0)
        state = 0
        for i, symbol, new in zip(at.tolist(), symbols, fresh.tolist()):
            state = self.automaton.next(0 if new else state, symbol)
            for pattern in self.automaton.ends[state]:
                begin = i - self.length[pattern] + 1
                if b" ".join(found.word(k) for k in range(begin, i + 1)) == self.phrases[pattern]:
                    yield begin, pattern

    def _report(self, found: Words, data: np.ndarray, end: int, first: int, places: list[tuple[int, int]]) -> tuple:
        base, more, score, expression = set(), set(), 0.0, None
        starts = []
        labels = [label for _, label in (*BASE, *NOTICES)]
        for i, pattern in places:
            if pattern < len(BASE):
                starts.append(i - first)
                base.add(labels[pattern])
                score = max(score, 0.9)
            elif pattern < len(labels):
                more.add(labels[pattern])
                score = max(score, 0.6)
            else:
                parsed = self._behind(found, data, end, i + self.length[pattern] - 1)
                if parsed:
                    tag = pattern < len(labels) + len(TAGS)
                    score = max(score, 1.0 if tag else 0.6)
                    more.update(f"spdx:{n}" for n in parsed.names)
                    expression = expression or parsed
        return (
            len(starts),
            int(min(starts)) if starts else None,
            int(max(starts)) if starts else None,
            ",".join(sorted(base)),
            ",".join(sorted(base | more)),
            score,
            expression.text if expression else None,
            TERMS[expression.level] if expression else None,
        )

    def _behind(self, found: Words, data: np.ndarray, end: int, word: int) -> Expression | None:
        """The expression on the rest of the line, read as far as it goes on."""
        line = memoryview(data)
        start = _LEAD.match(line, int(found.end[word]), int(end)).end()
        return _evaluate(_longest(line, start, int(end)))
