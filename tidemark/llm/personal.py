"""Personal data: base patterns, and a semi-Markov conditional random field for the rest."""

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.text import pieces

# The kinds, in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
OUTSIDE = len(KINDS)

#: Most tokens and characters of an entity.
MOST_TOKENS = 16
MOST_CHARS = 64

_MAIL_LEFT = re.compile(r"[A-Za-z0-9._%+-]")
_MAIL_RIGHT = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_CHUNK = re.compile(r"\S+")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")
_TRIGGER = re.compile(r"[0-9@]")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """``(kind, start, end)`` of the base patterns, by kind, then start.

    Written so that a long run of one character class is read once: an address is found
    from its sign, and a number only begins where its run of digits does.
    """
    found: list[Span] = []
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and _MAIL_LEFT.match(text[start - 1]):
            start -= 1
        right = _MAIL_RIGHT.match(text, at + 1) if start < at else None
        if right:
            last = right.end()
            found.append((EMAIL, start, last))
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text):
        if all(len(q := p.lstrip("0")) <= 3 and int(q or "0") <= 255 for p in m[0].split(".")):
            found.append((IP, *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((CARD, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            found.append((PHONE, *m.span()))
    return found


@dataclass
class Zone:
    """Consecutive chunks that may hold an entity, and the chunk before them."""

    text: str
    start: int
    before: str
    tokens: np.ndarray

    def word(self) -> str:
        """The word before the first chunk, as far as it is known."""
        return self.before.strip(".,:;()\"'").lower()


def zones(text: str) -> Iterator[Zone]:
    """Runs of chunks between white space that have a digit or an at sign.

    Outside of them no candidate can score, so they are decoded on their own.
    """
    first = last = None
    before = previous = ""
    for m in _CHUNK.finditer(text):
        if _TRIGGER.search(m[0]):
            if first is None:
                first, before = m.start(), previous
            last = m.end()
        elif first is not None:
            yield _zone(text, first, last, before)
            first = None
        previous = m[0][-24:]
    if first is not None:
        yield _zone(text, first, last, before)


def _zone(text: str, first: int, last: int, before: str) -> Zone:
    inside = text[first:last]
    borders = np.fromiter((at for m in _TOKEN.finditer(inside) for at in m.span()), np.int32)
    return Zone(inside, first, before, borders.reshape(-1, 2))


def _side(char: str) -> str:
    return "s" if not char or char.isspace() else "a" if char.isalnum() else char if char in "\"'.,:;=()-+@_/" else "p"


def candidates(zone: Zone) -> Iterator[tuple[int, int, list[str]]]:
    """First and end token, and whole-span features, of every candidate segment."""
    text, tokens = zone.text, zone.tokens.tolist()
    word = zone.word()
    for i, (start, _) in enumerate(tokens):
        yield i, i + 1, ["o", "o:" + ("d" if text[start].isdigit() else "a" if text[start].isalpha() else "p")]
        trigger = False
        for j in range(i, min(len(tokens), i + MOST_TOKENS)):
            begin, end = tokens[j]
            if end - start > MOST_CHARS:
                break
            trigger = trigger or bool(_TRIGGER.match(text[begin]))
            if trigger:
                yield i, j + 1, _features(text, start, end, word if i == 0 else "")


def _mail(span: str) -> str:
    left, _, right = span.partition("@")
    return "mail" if left and _MAIL_RIGHT.fullmatch(right) and not re.search(r"[^A-Za-z0-9._%+-]", left) else "nomail"


def _ip(span: str) -> str:
    return "ip" if all(int(p[:4]) <= 255 for p in span.split(".")) else "noip"


def _features(text: str, start: int, end: int, word: str) -> list[str]:
    span = text[start:end]
    digits = _digits(span)
    letters = any(c.isalpha() for c in span)
    out = ["b", "l" + _side(text[start - 1 : start]), "r" + _side(text[end : end + 1]), "f" + _side(span[0]), "e" + _side(span[-1])]
    if "@" in span:
        out.append(_mail(span))
    elif letters:
        out.append("letters")
    else:
        out.append(f"d{len(digits)}")
        if len(digits) >= 13:
            out.append("luhn" if luhn(digits) else "noluhn")
        if span.count(".") == 3 and _IP.fullmatch(span):
            out.append(_ip(span))
        shape = re.sub(r"[0-9]+", "9", span)
        out.append("shape" + shape[:16])
    if any(c.isspace() for c in span):
        out.append("space")
    if word.isalpha():
        out.append("w:" + word)
    return out


@dataclass(frozen=True)
class Field:
    """Weights of the features by label; unknown features weigh nothing."""

    weights: dict[str, tuple[float, ...]]

    def decode(self, zone: Zone) -> list[Span]:
        """The best segmentation of the zone, as spans of the text.

        A segment is worth what its score is above that of its tokens outside of entities.
        Those that are worth something are few; among them the best chain is found from left
        to right. Of equal chains the one with the longer last segment is taken.
        """
        n = len(zone.tokens)
        best, back, done = [0.0] * (n + 1), {}, 0
        late: list[np.ndarray] = []
        for high, *segments in self._worth(zone):
            i, j, kind, worth = (np.concatenate(x) for x in zip(late, segments)) if late else segments
            order = np.lexsort((i, j))
            i, j, kind, worth = i[order], j[order], kind[order], worth[order]
            # Those that end behind the part may still be joined by others that end there.
            cut = int(np.searchsorted(j, high, side="right"))
            late = [x[cut:] for x in (i, j, kind, worth)]
            for first, end, label, gain in zip(*(x[:cut].tolist() for x in (i, j, kind, worth))):
                if done < end:
                    best[done + 1 : end + 1] = [best[done]] * (end - done)
                    done = end
                total = best[first] + gain
                if total > best[end] or total == best[end] and end not in back and end - first > 1:
                    best[end], back[end] = total, (first, label)
            best[done + 1 : high + 1] = [best[done]] * (high - done)
            done = max(done, high)
        found, at = [], n
        while at:
            if at in back:
                first, label = back[at]
                found.append((label, zone.start + int(zone.tokens[first, 0]), zone.start + int(zone.tokens[at - 1, 1])))
                at = first
            else:
                at -= 1
        return found

    @cached_property
    def _tables(self) -> "_Tables":
        return _Tables(self.weights)

    def _worth(self, zone: Zone) -> Iterator[tuple]:
        """By part of the zone: its end, and first and end token, kind and worth of the segments
        that begin in it and are worth taking.

        Scores are those of ``candidates``, for all segments of a length and some thousand
        first tokens at a time, so that memory does not grow with what a zone may hold. What
        is costly to tell of a segment is only told where it can still matter.
        """
        w, text = self._tables, zone.text
        n = len(zone.tokens)
        start, end = zone.tokens[:, 0].astype(np.int64), zone.tokens[:, 1].astype(np.int64)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        chars, which = np.unique(codes, return_inverse=True)
        known = [chr(c) for c in chars]
        side = np.array([_SIDES.index(_side(c)) for c in known])[which]
        edge = np.append(side, _SIDES.index("s"))
        left, right = np.where(start > 0, side[start - 1], _SIDES.index("s")), edge[end]
        first, last = side[start], side[end - 1]
        digit = (codes >= ord("0")) & (codes <= ord("9"))
        alpha = np.array([c.isalpha() for c in known])[which]
        numeral = np.array([c.isdigit() for c in known])[which]
        number, at_sign = digit[start], codes[start] == ord("@")
        outside = w.outside[np.where(numeral[start], 0, np.where(alpha[start], 1, 2))]

        def summed(values: np.ndarray) -> np.ndarray:
            return np.concatenate([[0], np.cumsum(values)])

        digits, letters, signs = summed(digit), summed(alpha), summed(at_sign)
        triggers, dots = summed(number | at_sign), summed(codes[start] == ord("."))
        gap = np.append(start[1:] > end[:-1], False)
        gaps, rest = summed(gap), summed(outside)
        # Sums of check digits, by the parity of the last digit's place.
        value = (codes[digit] - ord("0")).astype(np.int64)
        twice = 2 * value - 9 * (value > 4)
        even = np.arange(len(value)) % 2 == 0
        checks = [summed(np.where(even, value, twice)), summed(np.where(even, twice, value))]
        # Shapes: a run of digits is one 9; hashes of their beginnings by polynomial.
        shown = ~digit | ~np.append(False, digit[:-1])
        shape = np.where(digit[shown], ord("9"), codes[shown]).astype(np.uint64)
        place = summed(shown)
        hashes, powers = _running(shape)
        word = w.vector("w:" + zone.word()) if zone.word().isalpha() else None

        begins, closes = w.left[left] + w.first[first], w.right[right] + w.last[last]
        # At most this, whatever the label.
        most_begin, most_close = begins.max(1) + rest[:-1], closes.max(1) - rest[1:]
        fixed = w.one("b").max() + max(0.0, w.one("space").max(), 0.0 if word is None else word.max())
        most = w.count.max(1) + w.most_plain + fixed
        other = max(w.most_mail, float(w.one("letters").max())) + fixed

        for low in range(0, n, _DECODED):
            none = np.zeros(0, np.int64)
            parts = [(none, none, none, np.zeros(0))]
            for length in range(1, min(MOST_TOKENS, n - low) + 1):
                high = min(low + _DECODED, n - length + 1)
                here, there = slice(low, high), slice(low + length - 1, high + length - 1)
                a, b = start[here], end[there]
                fits = (b - a <= MOST_CHARS) & (triggers[low + length : high + length] > triggers[here])
                count = np.minimum(digits[b] - digits[a], MOST_CHARS)
                mixed = (signs[low + length : high + length] > signs[here]) | (letters[b] > letters[a])
                bound = most_begin[here] + most_close[there] + np.where(mixed, other, most[count])
                i = np.flatnonzero(fits & (bound >= -1e-9)) + low
                if not len(i):
                    continue
                j = i + length
                a, b = start[i], end[j - 1]
                score = w.one("b") + begins[i] + closes[j - 1]
                mail, lettered = signs[j] > signs[i], letters[b] > letters[a]
                plain = ~mail & ~lettered
                count = digits[b] - digits[a]
                score += np.where((lettered & ~mail)[:, None], w.one("letters"), 0)
                score += np.where(plain[:, None], w.count[count], 0)
                score += np.where((gaps[j - 1] > gaps[i])[:, None], w.one("space"), 0)
                if word is not None and i[0] == 0:
                    score[0] += word
                without = rest[j] - rest[i]
                for k in np.flatnonzero(mail):
                    score[k] += w.one(_mail(text[a[k] : b[k]]))
                many = plain & (count >= 13)
                ahead = digits[b]
                check = np.where(ahead % 2 == 1, checks[0][ahead] - checks[0][digits[a]], checks[1][ahead] - checks[1][digits[a]])
                score += np.where((many & (check % 10 == 0))[:, None], w.one("luhn"), 0)
                score += np.where((many & (check % 10 != 0))[:, None], w.one("noluhn"), 0)
                if length == 7:
                    for k in np.flatnonzero(plain & (dots[j] - dots[i] == 3)):
                        score[k] += w.ip(text[a[k] : b[k]])
                size = np.minimum(place[b] - place[a], 16)
                score += np.where(plain[:, None], w.shape((hashes[place[a] + size] - hashes[place[a]]) * powers[place[a]], size), 0)
                kind = score.argmax(1)
                worth = score.max(1) - without
                good = worth >= 0
                parts.append((i[good], j[good], kind[good], worth[good]))
            yield min(low + _DECODED, n), *(np.concatenate(x) for x in zip(*parts))


#: First tokens of the segments that are scored at once.
_DECODED = 8192

# Sides of a segment: the values of ``_side``.
_SIDES = ["s", "a", "p", *"\"'.,:;=()-+@_/"]
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _running(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of values times powers of the base, and powers of its inverse: the sum over
    a run, times that of where it begins, does not depend on where it stands."""
    base, inverse = (np.full(len(values), b, np.uint64) for b in (_BASE, pow(int(_BASE), -1, 1 << 64)))
    one = np.ones(1, np.uint64)
    ahead, back = (np.cumprod(np.concatenate([one, b])) for b in (base, inverse))
    return np.concatenate([one - one, np.cumsum((values + one) * ahead[:-1])]), back


class _Tables:
    """The weights of the labels by what a segment has, as arrays."""

    def __init__(self, weights: dict[str, tuple[float, ...]]):
        self._weights = weights

        def rows(names: list[str]) -> np.ndarray:
            return np.array([self.vector(n) for n in names])

        self.left, self.right, self.first, self.last = (rows([a + s for s in _SIDES]) for a in "lrfe")
        self.count = rows([f"d{n}" for n in range(MOST_CHARS + 1)])
        none = (0.0,) * (OUTSIDE + 1)
        self.outside = np.array([weights.get("o", none)[OUTSIDE] + weights.get("o:" + c, none)[OUTSIDE] for c in "dap"])
        shapes = [f for f in weights if f.startswith("shape")]
        codes = np.array([_running(np.array([ord(c) for c in f[5:]], np.uint64))[0][-1] for f in shapes], np.uint64)
        order = np.argsort(codes)
        self._codes, self._sizes = codes[order], np.array([len(f) - 5 for f in shapes], np.int64)[order]
        self._shapes = rows(shapes).reshape(-1, OUTSIDE)[order]
        self.most_plain = max(
            0.0, *(float(max(0.0, *self.vector(f))) for f in ("luhn", "noluhn"))
        ) + max(0.0, *(float(max(0.0, *self.vector(f))) for f in ("ip", "noip"))) + float(self._shapes.max(initial=0.0))
        self.most_mail = max(0.0, *(float(max(self.vector(f))) for f in ("mail", "nomail")))

    def vector(self, name: str) -> np.ndarray:
        return np.array(self._weights.get(name, (0.0,) * (OUTSIDE + 1))[:OUTSIDE])

    def one(self, name: str) -> np.ndarray:
        return self.vector(name)

    def ip(self, span: str) -> np.ndarray:
        return self.vector(_ip(span)) if _IP.fullmatch(span) else np.zeros(OUTSIDE)

    def shape(self, codes: np.ndarray, size: np.ndarray) -> np.ndarray:
        if not len(self._codes):
            return np.zeros((len(codes), OUTSIDE))
        at = np.minimum(np.searchsorted(self._codes, codes), len(self._codes) - 1)
        known = (self._codes[at] == codes) & (self._sizes[at] == size)
        return np.where(known[:, None], self._shapes[at], 0.0)


def train(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    sample_rows: int = 400,
    drawn_rows: int = 20_000,
    epochs: int = 12,
) -> Field:
    """Fit the field on zones of at most ``sample_rows`` documents that have a digit or an at sign.

    They are the first by a hash of ``key`` and text among about ``drawn_rows`` documents
    that the hash draws from all, so that what is ordered does not grow with the corpus. Of
    each document the first zones of up to 40 tokens come to the driver, four at most. The
    base patterns label them. Telephone numbers are learned a second time without their
    plus and country code, so that the field knows what they look like on their own. The
    gradient is that of the conditional log-likelihood, by the forward-backward recursion
    over segments.
    """
    share = min(1.0, drawn_rows / max(1, docs.count()))
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    drawn = rows.withColumn("draw", F.pmod(F.xxhash64("key", "text"), F.lit(1 << 31))).filter(F.col("draw") <= int(share * (1 << 31)))
    sample = drawn.filter(F.col("text").rlike("[0-9@]")).orderBy("draw", "key", "text").limit(sample_rows)

    def shown(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for value in batch["text"]:
                short = [z for z in zones(value) if len(z.tokens) <= 40 and len(z.text) <= 200][:4]
                out += [(z.before, z.text) for z in short]
            yield pd.DataFrame(out, columns=["before", "zone"])

    shows = sample.mapInPandas(shown, "before string, zone string").toPandas().sort_values(["zone", "before"])
    examples = []
    for before, inside in zip(shows["before"], shows["zone"]):
        spans = base_spans(inside)
        examples.append((before, inside, spans))
        for kind, start, end in spans:
            bare = re.sub(r"^\+[0-9]{1,3}[ .-]", "", inside[start:end])
            if kind == PHONE and bare != inside[start:end]:
                examples.append((before, inside[:start] + bare + inside[end:], [(PHONE, start, start + len(bare))]))
    return _fit(examples, epochs)


def _fit(examples: list[tuple[str, str, list[Span]]], epochs: int) -> Field:
    number: dict[str, int] = {"o": 0}
    lattices = []
    for before, inside, spans in examples:
        zone = _zone(inside, 0, len(inside), before)
        gold = _gold(zone, spans)
        start, end, kind, owner, feature, wanted = [], [], [], [], [], []
        for i, j, names in candidates(zone):
            ids = [number.setdefault(f, len(number)) for f in names]
            for k in [OUTSIDE] if names[0] == "o" else range(OUTSIDE):
                owner += [len(start)] * len(ids)
                feature += [f * (OUTSIDE + 1) + k for f in ids]
                start.append(i)
                end.append(j)
                kind.append(k)
                wanted.append((i, j, k) in gold)
        lattices.append((len(zone.tokens), *map(np.array, (start, end, owner, feature, wanted))))
    weights = np.zeros(len(number) * (OUTSIDE + 1))
    weights[OUTSIDE] = 1.0
    pace = np.full(len(weights), 1e-2)
    for _ in range(epochs):
        for n, start, end, owner, feature, wanted in lattices:
            score = np.bincount(owner, weights[feature], len(start))
            change = (wanted - _marginals(n, start, end, score))[owner]
            slope = np.bincount(feature, change, len(weights)) - 1e-4 * weights
            pace += slope**2
            weights += 0.5 * slope / np.sqrt(pace)
    table = weights.reshape(-1, OUTSIDE + 1)
    return Field({f: tuple(table[i].round(6).tolist()) for f, i in number.items()})


def _marginals(n: int, start: np.ndarray, end: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Probability of every segment, over all segmentations."""
    front, back = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    front[0] = back[n] = 0.0
    ends = [np.flatnonzero(end == j) for j in range(n + 1)]
    starts = [np.flatnonzero(start == i) for i in range(n + 1)]
    for j in range(1, n + 1):
        front[j] = np.logaddexp.reduce(front[start[ends[j]]] + score[ends[j]])
    for i in range(n - 1, -1, -1):
        back[i] = np.logaddexp.reduce(back[end[starts[i]]] + score[starts[i]])
    return np.exp(front[start] + score + back[end] - front[n])


def _gold(zone: Zone, spans: list[Span]) -> set[tuple[int, int, int]]:
    """The labelled segmentation: spans at token borders, the longest first; the rest outside."""
    begin = {s: i for i, (s, _) in enumerate(zone.tokens.tolist())}
    finish = {e: i + 1 for i, (_, e) in enumerate(zone.tokens.tolist())}
    free = np.ones(len(zone.tokens), bool)
    gold = set()
    for kind, start, end in sorted(spans, key=lambda s: s[1] - s[2]):
        i, j = begin.get(start), finish.get(end)
        if i is not None and j is not None and free[i:j].all() and j - i <= MOST_TOKENS and end - start <= MOST_CHARS:
            free[i:j] = False
            gold.add((i, j, kind))
    return gold | {(i, i + 1, OUTSIDE) for i in np.flatnonzero(free).tolist()}


COLUMNS = "found array<struct<kind:int,start:int,end:int,base:boolean>>"


def find_personal(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """``docs`` with ``found``: spans of personal data by kind, then start.

    ``kind`` numbers ``KINDS``; offsets are characters, ends exclusive. ``base`` spans are
    those of the patterns; the field adds what it finds apart from them. Null and empty
    texts have none. Long texts are read whole, in time and memory in proportion to their
    length, also where all of it is digits. Repeated rows are searched each by itself, and a
    table without rows gives none. A column ``found`` of ``docs`` is replaced.
    """
    rows = docs.drop("found")
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL(COLUMNS).fields])
    at = rows.columns.index(text)
    marks = np.zeros(256, bool)
    marks[[*range(ord("0"), ord("9") + 1), ord("@")]] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[dict]] = []
            for _, data, offsets in pieces(batch.column(at)):
                here: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
                some = np.searchsorted(offsets, np.flatnonzero(marks[data]), side="right") - 1
                for i in np.unique(some).tolist():
                    here[i] = _spans(data[offsets[i] : offsets[i + 1]].tobytes().decode(), field)
                out += here
            kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], schema.names)

    return rows.mapInArrow(run, schema)


def _spans(text: str, field: Field) -> list[dict]:
    base = base_spans(text)
    cover = sorted((s, e) for _, s, e in base)
    starts = [s for s, _ in cover]
    reach = np.maximum.accumulate([e for _, e in cover]) if cover else []
    spans = [(*s, True) for s in base]
    for zone in zones(text):
        for kind, start, end in field.decode(zone):
            before = bisect_left(starts, end)
            if not before or reach[before - 1] <= start:
                spans.append((kind, start, end, False))
    return [dict(zip(("kind", "start", "end", "base"), s)) for s in sorted(spans)]


def personal_report(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: base spans per kind, a digest of them, and all spans."""
    kinds = F.array(*[F.lit(k) for k in KINDS])

    def text(spans):
        return F.concat_ws(
            ",", F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
        )

    def count(number: int):
        return F.size(F.filter("found", lambda s: s["base"] & (s["kind"] == number))).cast("long")

    return found.select(
        F.col(key).alias("doc_id"),
        *[count(n).alias(f"n_{k}") for n, k in enumerate(KINDS)],
        F.sha2(text(F.filter("found", lambda s: s["base"])), 256).alias("base_sha256"),
        text(F.col("found")).alias("spans"),
    )


def redact(found: DataFrame, text: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets."""
    rows = found.drop("found")
    names = rows.columns
    at, spans = found.columns.index(text), found.columns.index("found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, mine in zip(batch.column(at).to_pylist(), batch.column(spans).to_pylist()):
                done, last = [], 0
                for s in sorted(mine or (), key=lambda s: (s["start"], -s["end"])):
                    if s["start"] >= last:
                        done += [value[last : s["start"]], f"<{KINDS[s['kind']]}>"]
                    last = max(last, s["end"])
                out.append("".join(done) + value[last:] if mine else value)
            columns = [pa.array(out, batch.column(at).type) if i == at else c for i, c in enumerate(batch.columns) if i != spans]
            yield pa.RecordBatch.from_arrays(columns, names)

    return found.mapInArrow(run, rows.schema)
