"""Whitening of vectors by components from an exact characteristic polynomial.

Vectors become whole numbers, so their scatter is an integer matrix that Spark sums exactly.
Its characteristic polynomial is found modulo many primes, a Spark task for a few of them,
and put together by Chinese remainders; its roots are isolated in exact arithmetic and the
components follow by inverse iteration. Nothing that comes to the driver grows with the
number of vectors: for a dimension ``d`` it is a matrix of ``d`` by ``d`` and a polynomial.
"""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from decimal import Decimal, localcontext
from fractions import Fraction
from itertools import islice
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.staging import scratch, staged

#: Roots are known to this many bits below the largest power of two that bounds them.
#: Roots closer than that are taken as one of several components.
ROOT_BITS = 256
#: Digits of the arithmetic that finds components; more than the bits of a root.
DIGITS = 130

#: Entries worked on at once.
_SLICE = 1 << 21
_LIMB = 24
_PRIMES_A_TASK = 8
_EXACT = 1 << 53
_LONG = 2.0**63

_LIMBS = [f"limb{k}" for k in range(5)]
_SUMS = "dimension int, i int, j int, " + ", ".join(f"{name} long" for name in _LIMBS)
ADDED = (
    "n long, deviation decimal(38,0), "
    "whitened array<struct<component:int,value:double,explained:double>>, identity_error double"
)


@dataclass(frozen=True)
class Whitening:
    """What is known of the vectors of one dimension.

    ``sums`` are those of the ``n`` different vectors by dimension. ``directions`` are the
    components divided by the square root of their variance, empty where that is zero.
    """

    dimension: int
    n: int
    sums: tuple[int, ...]
    most: int
    variances: tuple[float, ...]
    explained: tuple[float | None, ...]
    directions: tuple[tuple[float, ...], ...]
    identity_error: float | None = None

    def deviations(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``n * x - sums`` as it is, and the sum of its squares, both exact."""
        limit = max(self.n, 1) * max(self.most, _largest(x)) + max(map(abs, self.sums))
        whole = limit * limit * self.dimension < 1 << 63
        kind = np.int64 if whole else object
        off = x.astype(kind) * self.n - np.array(self.sums, kind)
        return off, (off * off).sum(1)

    def project(self, off: np.ndarray) -> np.ndarray:
        """Whitened values of rows that ``deviations`` gave."""
        ways = np.array([d or (np.nan,) * self.dimension for d in self.directions]).reshape(-1, self.dimension)
        return (off.astype(np.float64) / self.n) @ ways.T


def fit_whitening(
    vectors: DataFrame, column: str = "embedding", components: int = 4, scale: int = 256
) -> list[Whitening]:
    """Means, components and variances of the different vectors of ``column``.

    An entry ``c`` counts as ``floor(scale * c)``, held at the ends of long. Vectors that are
    null, empty or hold null or non-finite entries are left out, repeated ones count once.
    Vectors of different lengths are whitened apart, each length by a model of its own; a
    table without vectors has no model. A component without variance has no direction;
    components of equal variance are any orthogonal ones in their space.
    """
    spark = vectors.sparkSession
    with scratch(spark, "whitening") as folder:
        packed = vectors.select(column).mapInArrow(_packing(scale), "dimension int, x binary")
        fit = staged(packed.distinct(), "fit", folder=folder)
        limbs = [F.sum(name).alias(name) for name in _LIMBS]
        sums = fit.mapInArrow(_scatter, _SUMS).groupBy("dimension", "i", "j").agg(*limbs).toPandas()
        models = [_model(spark, int(d), rows, components) for d, rows in sums.groupby("dimension")]
        errors = _identity_errors(fit, models, components)
    return [replace(m, identity_error=errors.get(m.dimension)) for m in models]


def whiten(
    vectors: DataFrame, models: Sequence[Whitening], column: str = "embedding", scale: int = 256
) -> DataFrame:
    """The rows of ``vectors`` whose vector is usable, with the columns of ``ADDED``.

    ``deviation`` is the sum over the dimensions of ``(n * x - sums) ** 2``, null beyond 38
    digits. ``whitened`` has the components by falling variance; a component without
    variance has the value null. Repeated rows stay; vectors of a length that no model knows
    are left out. Columns that bear the names of the added ones are replaced.
    """
    added = T.StructType.fromDDL(ADDED)
    rows = vectors.drop(*added.names)
    known = {m.dimension: m for m in models}
    at = rows.columns.index(column)
    names = [*rows.columns, *added.names]
    whitened = pa.list_(pa.struct([("component", pa.int32()), ("value", pa.float64()), ("explained", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, x in _usable(batch.column(at), scale):
                model = known.get(x.shape[1])
                if model is None:
                    continue
                off, squares = model.deviations(x)
                values = model.project(off)
                count = values.shape[1]
                parts = [
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(values.ravel(), from_pandas=True),
                    pa.array(list(model.explained) * len(x), pa.float64()),
                ]
                offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * count)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.take(pa.array(where)) for c in batch.columns),
                        pa.array(np.full(len(x), model.n)),
                        pa.array([v if v < 10**38 else None for v in map(Decimal, squares.tolist())], pa.decimal128(38, 0)),
                        pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(parts, fields=list(whitened.value_type))),
                        pa.array([model.identity_error] * len(x), pa.float64()),
                    ],
                    names,
                )

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *added.fields]))


def whitening_report(done: DataFrame, key: str = "vec_id") -> DataFrame:
    """One row per vector and component; a deviation that no long holds is null."""
    parts = done.select(key, "n", F.col("deviation").try_cast("long").alias("deviation"), "identity_error", F.inline("whitened"))
    return parts.select(
        F.col(key).alias("vec_id"), "component", "n", "deviation", F.col("value").alias("whitened"), "explained", "identity_error"
    )


def _largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def _usable(column: pa.Array, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """By length: the rows of the usable vectors, and their entries as whole numbers."""
    lists = column.cast(pa.list_(pa.float64()))
    there = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False))
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths[there]).astype(int).tolist():
        mine = there[lengths[there] == length]
        step = max(1, _SLICE // max(1, length))
        for first in range(0, len(mine) if length else 0, step):
            rows = mine[first : first + step]
            entries = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
            grid = entries.reshape(len(rows), length)
            good = np.isfinite(grid).all(1)
            with np.errstate(over="ignore"):
                scaled = np.floor(grid[good] * scale)
            x = np.where(np.abs(scaled) < _LONG, scaled, 0).astype(np.int64)
            x[scaled >= _LONG] = np.iinfo(np.int64).max
            x[scaled <= -_LONG] = np.iinfo(np.int64).min
            if len(x):
                yield rows[good], x


def _packing(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Vectors as bytes, in the narrowest whole numbers that hold them."""
        for batch in batches:
            for _, x in _usable(batch.column(0), scale):
                most = np.maximum(x.max(1), -(x.min(1) + 1))
                width = 1 << np.searchsorted([1 << 7, 1 << 15, 1 << 31], most, side="right")
                for w in np.unique(width).tolist():
                    some = x[width == w].astype(f"<i{w}")
                    ends = np.arange(len(some) + 1, dtype=np.int32) * (w * x.shape[1])
                    packed = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(ends), pa.py_buffer(some.tobytes())])
                    size = pa.array(np.full(len(some), x.shape[1], np.int32))
                    yield pa.RecordBatch.from_arrays([size, packed], ["dimension", "x"])

    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        size = batch.column(0).to_numpy()
        width = pc.binary_length(batch.column(1)).to_numpy() // size
        for d, w in sorted({*zip(size.tolist(), width.tolist())}):
            some = batch.column(1).filter(pa.array((size == d) & (width == w))).to_pylist()
            yield np.frombuffer(b"".join(some), f"<i{w}").reshape(-1, d).astype(np.int64)


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the vectors of a task: number, sums and sums of products, in limbs of 32 bits.

    The number is at (-1, -1), the sum of dimension ``j`` at (-1, ``j``).
    """
    count: dict[int, int] = {}
    total: dict[int, np.ndarray] = {}
    for x in _unpacked(batches):
        d = x.shape[1]
        count[d] = count.get(d, 0) + len(x)
        with_one = np.concatenate([np.ones((len(x), 1), np.int64), x], 1)
        total[d] = total.get(d, 0) + _products(with_one)
    for d, square in total.items():
        i, j = np.triu_indices(d + 1)
        values = square[i, j]
        limbs = [((values >> (32 * k)) & 0xFFFFFFFF).astype(np.int64) for k in range(4)] + [(values >> 128).astype(np.int64)]
        places = [np.full(len(i), d, np.int32), i.astype(np.int32) - 1, j.astype(np.int32) - 1]
        columns = [pa.array(c.astype(np.int32)) for c in places] + [pa.array(c) for c in limbs]
        yield pa.RecordBatch.from_arrays(columns, ["dimension", "i", "j", *_LIMBS])


def _products(x: np.ndarray) -> np.ndarray:
    """Exact sums of products of all pairs of columns, as Python's whole numbers.

    Float products of limbs are summed over so few rows that every sum is below 2^53.
    """
    limbs, rest = [], x
    while _largest(rest) >= 1 << _LIMB:
        limbs.append((rest & ((1 << _LIMB) - 1)).astype(np.float64))
        rest = rest >> _LIMB
    limbs.append(rest.astype(np.float64))
    most = max(1, *(int(np.abs(part).max()) for part in limbs)) if len(x) else 1
    step = max(1, (_EXACT - 1) // (most * most))
    out = np.zeros((x.shape[1], x.shape[1]), object)
    for first in range(0, len(x), step):
        for a, left in enumerate(limbs):
            for b, right in enumerate(limbs):
                part = left[first : first + step].T @ right[first : first + step]
                out += part.astype(np.int64).astype(object) << (_LIMB * (a + b))
    return out


def _model(spark: SparkSession, d: int, rows: pd.DataFrame, components: int) -> Whitening:
    square = np.zeros((d + 1, d + 1), object)
    for i, j, *limbs in rows.drop(columns="dimension").itertuples(index=False):
        value = sum(int(limb) << (32 * k) for k, limb in enumerate(limbs))
        square[i + 1, j + 1] = square[j + 1, i + 1] = value
    n, sums = square[0, 0], square[0, 1:]
    scatter = square[1:, 1:] * n - np.outer(sums, sums)
    trace = sum(scatter.diagonal())
    roots = top_roots(characteristic(spark, scatter), min(components, d))
    found: list[list[Decimal]] = []
    with localcontext() as context:
        context.prec = DIGITS
        whole = np.array([[Decimal(int(v)) for v in row] for row in scatter], object)
        for k, root in enumerate(roots):
            value = Decimal(root.numerator) / root.denominator
            same = [found[i] for i in range(k) if roots[i] == root and root]
            found.append(_null_vector(whole, value, Decimal(int(trace)), same) if root else [])
        shares = [float(Decimal(r.numerator) / r.denominator / int(trace)) if trace else None for r in roots]
        spread = [(Decimal(r.numerator) / r.denominator).sqrt() / int(n) for r in roots]
        ways = [tuple(float(v / s) for v in vector) for vector, s in zip(found, spread)]
    # Every entry is at most the square root of its sum of squares.
    most = max(int(square[i, i]) for i in range(1, d + 1))
    bound = 1 << ((most.bit_length() + 1) // 2)
    return Whitening(
        d, int(n), tuple(map(int, sums)), bound, tuple(float(r / (int(n) ** 2)) for r in roots), tuple(shares), tuple(ways)
    )


def primes() -> Iterator[int]:
    """Primes below 2^31, from the largest down."""
    for p in range((1 << 31) - 1, 2, -2):
        odd, twos = p - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):  # decides for all numbers below 3.2e9
            power = pow(base, odd, p)
            if power not in (1, p - 1) and all((power := power * power % p) != p - 1 for _ in range(twos - 1)):
                break
        else:
            yield p


def characteristic(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Coefficients of ``det(x - matrix)``, the leading one first, of an integer matrix whose
    eigenvalues are real and not negative.

    The sums of products of such eigenvalues are bounded by their mean, which gives the
    number of primes that settles every coefficient.
    """
    d, trace = len(matrix), int(sum(matrix.diagonal()))
    bits = max((comb(d, k) * trace**k // d**k + 1).bit_length() for k in range(d + 1)) + 2
    moduli = list(islice(primes(), -(-bits // 30)))
    tasks = -(-len(moduli) // _PRIMES_A_TASK)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for task in batch["id"]:
                mine = np.array(moduli[task::tasks])
                yield pd.DataFrame({"prime": mine, "c": list(characteristic_mod(matrix, mine))})

    rows = spark.range(0, tasks, 1, tasks).mapInPandas(run, "prime long, c array<long>").toPandas()
    whole = 1
    for p in moduli:
        whole *= p
    out = [0] * (d + 1)
    for p, residues in zip(rows["prime"].tolist(), rows["c"]):
        unit = whole // p * pow(whole // p, -1, p)
        out = [c + unit * r for c, r in zip(out, map(int, residues))]
    return [(c + whole // 2) % whole - whole // 2 for c in out]


def characteristic_mod(matrix: np.ndarray, moduli: np.ndarray) -> np.ndarray:
    """The polynomial modulo each prime, by reduction to Hessenberg form, all primes at once."""
    d, p = len(matrix), moduli.astype(np.int64)
    a = np.array([(matrix % int(q)).astype(np.int64) for q in p])
    p1, p2, every = p[:, None], p[:, None, None], np.arange(len(p))
    for k in range(d - 2):
        pivot = k + 1 + np.argmax(a[:, k + 1 :, k] != 0, axis=1)
        a[every, k + 1], a[every, pivot] = a[every, pivot].copy(), a[every, k + 1].copy()
        a[every, :, k + 1], a[every, :, pivot] = a[every, :, pivot].copy(), a[every, :, k + 1].copy()
        factor = a[:, k + 2 :, k] * _inverse(a[:, k + 1, k], p)[:, None] % p1
        a[:, k + 2 :] = (a[:, k + 2 :] - factor[:, :, None] * a[:, None, k + 1] % p2) % p2
        a[:, :, k + 1] = (a[:, :, k + 1] + (a[:, :, k + 2 :] * factor[:, None] % p2).sum(2)) % p1
    # Polynomials of the leading blocks, the constant first.
    poly = np.zeros((len(p), d + 1, d + 1), np.int64)
    poly[:, 0, 0] = 1
    for k in range(d):
        poly[:, k + 1, 1:] = poly[:, k, :-1]
        poly[:, k + 1] -= a[:, k, k][:, None] * poly[:, k] % p1
        chain = np.ones(len(p), np.int64)
        for i in range(k - 1, -1, -1):
            chain = chain * a[:, i + 1, i] % p
            poly[:, k + 1] -= (a[:, i, k] * chain % p)[:, None] * poly[:, i] % p1
        poly[:, k + 1] %= p1
    return poly[:, d, ::-1]


def _inverse(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Inverses modulo primes; 0 for 0."""
    out, square, power = np.ones_like(a), a.copy(), p - 2
    while power.any():
        out = np.where(power & 1, out * square % p, out)
        square, power = square * square % p, power >> 1
    return np.where(a == 0, 0, out)


def roots_above(poly: Sequence[int], at: Fraction) -> int:
    """How many roots of a polynomial with only real roots are greater than ``at``.

    The signs of its coefficients, moved to ``at``, change as often as that: Descartes's
    bound is exact where all roots are real.
    """
    moved = [c * at.denominator**i for i, c in enumerate(poly)]
    for last in range(len(moved) - 1, 0, -1):
        for i in range(1, last + 1):
            moved[i] += at.numerator * moved[i - 1]
    signs = [c > 0 for c in moved if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def top_roots(poly: Sequence[int], count: int) -> list[Fraction]:
    """The greatest roots with their multiplicity, of a polynomial with only real roots that
    are not negative: exact if found so, else the middle of an interval of 2^-ROOT_BITS of
    the bound. Equal ones are the same number."""
    top = Fraction(1 << (max(1, -poly[1]) if len(poly) > 1 else 1).bit_length())
    least = top / (1 << ROOT_BITS)
    above = {Fraction(0): roots_above(poly, Fraction(0)), top: 0}
    out = []
    for k in range(1, count + 1):
        if above[Fraction(0)] < k:
            out.append(Fraction(0))
            continue
        low = max(t for t, n in above.items() if n >= k)
        high = min(t for t, n in above.items() if n < k)
        while above[low] - above[high] > 1 and high - low > least:
            middle = (low + high) / 2
            above[middle] = roots_above(poly, middle)
            low, high = (middle, high) if above[middle] >= k else (low, middle)
        if above[low] - above[high] == 1:
            low, high = _narrowed(poly, low, high, least)
        out.append(high if low == high else (low + high) / 2)
    return out


def _narrowed(poly: Sequence[int], low: Fraction, high: Fraction, least: Fraction) -> tuple[Fraction, Fraction]:
    """A smaller interval around the only root that is above ``low`` and at most ``high``."""

    def sign(at: Fraction) -> int:
        value, scale = 0, 1
        for c in poly:
            value, scale = value * at.numerator + c * scale, scale * at.denominator
        return (value > 0) - (value < 0)

    beyond = sign(high)
    while beyond and high - low > least:
        middle = (low + high) / 2
        here = sign(middle)
        if not here:
            return middle, middle
        low, high = (low, middle) if here == beyond else (middle, high)
    return (low, high) if beyond else (high, high)


def _null_vector(matrix: np.ndarray, value: Decimal, size: Decimal, others: list[list[Decimal]]) -> list[Decimal]:
    """A unit vector that ``matrix`` multiplies by ``value``, orthogonal to ``others``; its
    largest entry is positive. By inverse iteration, in the digits of the current context."""
    d = len(matrix)
    rest = matrix.copy()
    rest[range(d), range(d)] -= value
    order = list(range(d))
    for k in range(d):
        pivot = max(range(k, d), key=lambda i: abs(rest[i, k]))
        rest[[k, pivot]] = rest[[pivot, k]]
        order[k], order[pivot] = order[pivot], order[k]
        if not rest[k, k]:
            rest[k, k] = size.scaleb(-DIGITS)
        rest[k + 1 :, k] /= rest[k, k]
        rest[k + 1 :, k + 1 :] -= np.outer(rest[k + 1 :, k], rest[k, k + 1 :])
    vector = np.array([Decimal(1 + (i * 7919 + len(others) * 104729) % 1009) for i in range(d)], object)
    for _ in range(8):
        vector = vector[order]
        for k in range(1, d):
            vector[k] -= rest[k, :k] @ vector[:k]
        for k in range(d - 1, -1, -1):
            vector[k] = (vector[k] - (rest[k, k + 1 :] @ vector[k + 1 :] if k + 1 < d else 0)) / rest[k, k]
        vector = vector / max(map(abs, vector))
        for other in others:
            vector = vector - np.array(other, object) * (vector @ np.array(other, object))
        vector = vector / (vector @ vector).sqrt()
        if max(map(abs, matrix @ vector - vector * value)) <= size.scaleb(-40):
            return list(vector * (1 if max(vector, key=abs) > 0 else -1))
    raise ArithmeticError("inverse iteration found no component")


def _identity_errors(fit: DataFrame, models: Sequence[Whitening], components: int) -> dict[int, float]:
    """By dimension: the largest entry of the whitened covariance, measured over the list
    that was fitted, less the identity."""
    known = {m.dimension: m for m in models}
    names = [f"w{k}" for k in range(components)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _unpacked(batches):
            values = np.full((len(x), components), np.nan)
            part = known[x.shape[1]].project(known[x.shape[1]].deviations(x)[0])
            values[:, : part.shape[1]] = part
            size = pa.array(np.full(len(x), x.shape[1], np.int32))
            yield pa.RecordBatch.from_arrays([size, *(pa.array(v, from_pandas=True) for v in values.T)], ["dimension", *names])

    schema = "dimension int, " + ", ".join(f"{n} double" for n in names)
    pairs = [(a, b) for a in range(components) for b in range(a, components)]
    errors = [F.abs(F.covar_pop(names[a], names[b]) - float(a == b)) for a, b in pairs]
    worst = F.greatest(*errors) if len(errors) > 1 else errors[0]
    rows = fit.mapInArrow(run, schema).groupBy("dimension").agg(worst.alias("worst")).collect()
    return {r.dimension: r.worst for r in rows}
