"""Words of whole Arrow columns as arrays: byte positions and 64-bit hashes.

Everything works on the UTF-8 bytes of a column at once. The word classes below only
name ASCII separators, so bytes from 0x80 on are always word bytes and a character is
never cut.
"""

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from inspect import isgenerator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A piece of a column that is worked on at once; one longer text is a piece by itself.
#: The arrays over a piece take about 50 times its bytes.
PIECE_BYTES = 1 << 20

_U = np.uint64


def tidied(fn: Callable) -> Callable:
    """``fn``, a function that Spark runs in a Python worker, giving back the memory that it
    has freed when it ends: a worker waits for its next task with what it held last."""

    def run(given):
        out = fn(given)
        if isgenerator(out):
            return _then_give_back(out)
        _give_back()
        return out

    return run


def _then_give_back(out: Iterator) -> Iterator:
    try:
        yield from out
    finally:
        _give_back()


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not a GNU system
        pass


def _scramble(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = _scramble(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_STEP = _U(0xD1342543DE82EF95)
_PLACE = _scramble(np.arange(1001, 1129, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)

FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32


def _word_bytes(separators: list[tuple[int, int]]) -> np.ndarray:
    table = np.ones(256, bool)
    for low, high in separators:
        table[low : high + 1] = False
    return table[FOLD]


#: ``[^\x20\x09-\x0D]+`` and ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z are lower-cased.
SPACED = _word_bytes([(0x20, 0x20), (0x09, 0x0D)])
ALNUM = _word_bytes([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


@dataclass
class Words:
    """The words of some rows: the row, first byte, end byte and hash of each."""

    rows: int
    data: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def per_row(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)

    def first(self) -> np.ndarray:
        """Index of the first word of each row, and the number of words at the end."""
        return np.concatenate([[0], np.cumsum(self.per_row())])

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of ``width`` words within one row."""
        count = max(0, len(self.hash) - width + 1)
        at = np.flatnonzero(self.row[:count] == self.row[width - 1 : width - 1 + count])
        total = np.full(len(at), width, _U)
        for k in range(width):
            total += self.hash[at + k] * _PLACE[k]
        return at, _scramble(total)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and row offsets of consecutive pieces; null texts are empty."""
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(filled):
        return
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    raw = filled.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(filled):
        last = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        last = min(max(last, row + 1), row + 60_000, len(filled))
        yield row, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    """The words of a piece, A-Z lower-cased."""
    rows = len(offsets) - 1
    data = FOLD[data]
    inside = table[data]
    at = np.flatnonzero(inside)
    if not len(at):
        none = np.zeros(0, np.int64)
        return Words(rows, data, none, none, none, np.zeros(0, _U))
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    opens[edges] = inside[edges]
    start = np.flatnonzero(opens)
    first = np.searchsorted(at, start)
    length = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, length)
    power = np.cumprod(np.full(int(length.max()), _STEP, _U))
    total = np.add.reduceat(_BYTE[data[at]] * power[place], first)
    row = np.searchsorted(offsets, start, side="right") - 1
    return Words(rows, data, row, start, start + length, _scramble(total + length.astype(_U)))


def hash_words(sequence: list[bytes]) -> np.ndarray:
    """Hashes of single words, as ``words`` gives them."""
    data = np.frombuffer(b" ".join(sequence), np.uint8)
    return words(data, np.array([0, len(data)]), SPACED).hash
