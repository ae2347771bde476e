"""Secret scans: a trigram inverted index narrows the texts that each rule is run on.

Only DataFrame operations. The Boolean trigram query of a rule is derived from its
regular expression when the plan is built.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from re import _constants as sre
from re import _parser as sre_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.staging import staged


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, kept when ``group`` of the match has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules, in the order in which their kinds are listed.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # A run of 32 and more is what is left of all runs when the shorter are dropped.
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
# Further rules.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)

#: One of these sets of trigrams is in every text that can match.
Clause = frozenset[frozenset[str]]

_MOST_STRINGS = 64
_RUN = 256


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses that all hold for the lower-cased text of any match of ``pattern``.

    Literals, small character classes, alternatives and options are spelled out as the
    strings that they can be; where that ends, the strings so far give a clause. A pattern
    without mandatory trigrams has no clause.
    """
    exact, clauses = _required(sre_parser.parse(pattern))
    return [c for c in [*clauses, *_clause(exact)] if c]


def _clause(strings: set[str]) -> list[Clause]:
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    least = {s for s in sets if not any(other < s for other in sets)}
    return [] if frozenset() in sets or not sets else [frozenset(least)]


def _required(sequence: Sequence) -> tuple[set[str], list[Clause]]:
    """The strings that ``sequence`` may end with, exact if there is no clause, and clauses."""
    ends: set[str] = {""}
    clauses: list[Clause] = []
    whole = True

    def broken() -> None:
        nonlocal ends, whole
        clauses.extend(_clause(ends))
        ends, whole = {""}, False

    for operator, value in sequence:
        strings: set[str] | None = None
        if operator is sre.LITERAL:
            strings = {chr(value).lower()}
        elif operator is sre.IN:
            strings = _characters(value)
        elif operator is sre.SUBPATTERN:
            strings = _exactly(value[-1])
            if strings is None:
                broken()
                inner, more = _required(value[-1])
                clauses += [*more, *_clause(inner)]
                continue
        elif operator is sre.BRANCH:
            sides = [_exactly(side) for side in value[1]]
            strings = None if None in sides else set().union(*sides)
        elif operator in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            low, high, inner = value
            once = _exactly(inner)
            if once is not None and (low, high) == (0, 1):
                strings = once | {""}
            elif once is not None and low == high and low <= 8 and len(once) == 1:
                strings = {s * low for s in once}
            elif low and once is not None and len(ends) * len(once) <= _MOST_STRINGS:
                ends = {a + b for a in ends for b in once}
        elif operator is sre.AT:
            continue
        if strings is None or len(ends) * len(strings) > _MOST_STRINGS:
            broken()
        else:
            ends = {a + b for a in ends for b in strings}
    if not whole:
        return ends, [*clauses, frozenset()]
    return ends, clauses


def _exactly(sequence: Sequence) -> set[str] | None:
    """All strings of ``sequence``, or None when they cannot be spelled out."""
    ends, clauses = _required(sequence)
    return None if clauses else ends


def _characters(value: Sequence, most: int = 8) -> set[str] | None:
    found: set[str] = set()
    for operator, arg in value:
        if operator is sre.LITERAL:
            found.add(chr(arg).lower())
        elif operator is sre.RANGE and arg[1] - arg[0] < most:
            found.update(chr(c).lower() for c in range(arg[0], arg[1] + 1))
        else:
            return None
    return found if len(found) <= most else None


def postings(docs: DataFrame, trigrams: Sequence[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(trigram, key)``: the inverted index of the lower-cased texts over some trigrams."""
    low = docs.select(key, F.lower(text).alias("low"))
    found = [F.when(F.col("low").contains(t), F.lit(t)) for t in trigrams]
    if not found:
        found = [F.lit(None).cast("string")]
    return low.select(F.explode(F.array_compact(F.array(*found))).alias("trigram"), key)


def candidates(index: DataFrame, rules: Sequence[Rule], key: str = "doc_id") -> DataFrame:
    """``(key, rules)``: what the intersected postings leave to verify, for rules with a query."""
    held = index.groupBy(key).agg(F.collect_set("trigram").alias("held"))

    def fits(clause: Clause) -> Column:
        sides = [F.size(F.array_except(F.array(*map(F.lit, sorted(s))), "held")) == 0 for s in sorted(clause, key=sorted)]
        return reduce(lambda a, b: a | b, sides)

    hits = [
        F.when(reduce(lambda a, b: a & b, map(fits, query)), F.lit(rule.kind))
        for rule in rules
        if (query := trigram_query(rule.pattern))
    ]
    named = F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")
    return held.select(key, named.alias("rules")).filter(F.size("rules") > 0)


def scan_secrets(
    docs: DataFrame, rules: Sequence[Rule] = (*BASE, *MORE), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with ``found``: ``(start, kind, end)`` of every match, in that order.

    ``kind`` is the number of the rule. Offsets are characters, ends exclusive. Matches are
    leftmost and do not overlap within a rule. A rule with a trigram query is run on the
    documents that its postings leave, found again by ``key``; a rule without one on all.
    Null texts are empty. A null or repeated ``key`` is allowed: the index then only leaves
    more to verify. A column ``found`` of ``docs`` is replaced.
    """
    rows = docs.drop("found")
    wanted = sorted({t for r in rules for clause in trigram_query(r.pattern) for s in clause for t in s})
    index = postings(rows, wanted, key, text)
    left = staged(candidates(index, rules, key).select(F.col(key).alias("__key"), F.col("rules").alias("__rules")), "candidates")
    joined = rows.join(left, F.col(key).eqNullSafe(F.col("__key")), "left")
    whole = F.coalesce(F.col(text), F.lit(""))
    spans = []
    for number, rule in enumerate(rules):
        run = _matches(whole, rule, number)
        if trigram_query(rule.pattern):
            run = F.when(F.array_contains("__rules", rule.kind), run)
        spans.append(F.coalesce(run, F.array().cast("array<struct<start:int,kind:int,end:int>>")))
    return joined.withColumn("found", F.array_sort(F.concat(*spans))).drop("__key", "__rules")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _matches(text: Column, rule: Rule, number: int) -> Column:
    pattern = F.lit(rule.pattern)

    def spans(found: Column) -> Column:
        parts = F.struct(
            found.alias("match"),
            F.transform(F.split(text, rule.pattern), F.char_length).alias("between"),
            F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.char_length).alias("kept"),
        )
        return _let(parts, placed)

    def placed(p: Column) -> Column:
        length = F.transform(p["match"], F.char_length)
        steps = F.zip_with(F.slice(p["between"], 1, F.size(length)), length, lambda b, m: b + m)
        return _let(
            F.struct(length.alias("length"), steps.alias("steps"), p["between"].alias("between"), p["kept"].alias("kept")),
            lambda q: _let(
                F.struct(q.alias("q"), _sums(q["steps"]).alias("sums")), lambda r: listed(r["q"], r["sums"])
            ),
        )

    def listed(q: Column, sums: Column) -> Column:
        def span(i: Column) -> Column:
            run = F.floor(i / _RUN).cast("int")
            before = _total(F.slice(sums, F.lit(1), run)) + _total(F.slice(q["steps"], run * _RUN + 1, i - run * _RUN))
            start = before + F.get(q["between"], i)
            return F.struct(
                start.cast("int").alias("start"), F.lit(number).alias("kind"), (start + F.get(q["length"], i)).cast("int").alias("end")
            )

        every = F.transform(F.sequence(F.lit(0), F.size(q["length"]) - 1), lambda i: F.struct(i.alias("i"), F.get(q["kept"], i).alias("kept")))
        return F.transform(F.filter(every, lambda e: e["kept"] >= rule.least), lambda e: span(e["i"]))

    found = F.regexp_extract_all(text, pattern, F.lit(0))
    return _let(found, lambda m: F.when(F.size(m) > 0, spans(m)))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def _sums(steps: Column) -> Column:
    """Sums of consecutive runs, so that a start is not the sum of all steps before it."""
    return F.transform(
        F.sequence(F.lit(0), F.floor(F.size(steps) / _RUN).cast("int")),
        lambda c: _total(F.slice(steps, c * _RUN + 1, F.lit(_RUN))),
    )


def secrets_report(found: DataFrame, rules: Sequence[Rule] = (*BASE, *MORE), key: str = "doc_id") -> DataFrame:
    """One row per document: matches per base kind, a digest of them, and all spans."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])

    def text(spans: Column) -> Column:
        return F.concat_ws(
            ",", F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
        )

    base = F.filter("found", lambda s: s["kind"] < len(BASE))

    def count(number: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == number)).cast("long")

    counts = [count(n).alias(f"n_{r.kind}") for n, r in enumerate(BASE)]
    return found.select(
        F.col(key).alias("doc_id"), *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("found")).alias("spans")
    )
