"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

Vectors become whole numbers, so n times their scatter about the mean is a matrix of whole numbers. Its
characteristic polynomial is computed exactly: modulo many primes, by reduction to Hessenberg form, one group
of primes per task, then joined by Chinese remaindering. The real roots are isolated with certified sign
changes and refined to many digits; components come from inverse iteration in the null space of the scatter
less its root, in high precision. Spark reads the rows; what is left on the driver and in a task depends on
the width of the vectors alone.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.topk import matrix, usable
from tidewire.session import materialize

SHIFT = 1_000_000
SCALE = 64
PRIMES_PER_TASK = 8
# Certified relative error of a root, and digits carried beyond it by the inverse iteration.
ROOT_DIGITS = 50
SPARE_DIGITS = 40
# Eigenvalues are no cheaper for wider vectors: the work grows with the fourth power of the width.
MAX_WIDTH = 1024


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """vec_id and `y`: floor(64 * x) of every entry; unusable vectors are left out, a NULL vec_id is kept."""
    y = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    return vectors.where(usable(F.col("embedding"))).select(F.col("vec_id").cast("bigint"), y.alias("y"))


# ---- scatter --------------------------------------------------------------------------------------


def products(y: np.ndarray) -> np.ndarray:
    """y' y of whole numbers without rounding, in the fastest type that holds every partial sum."""
    top = int(np.abs(y).max(initial=0))
    bound = top * top * max(1, len(y))
    if bound < 1 << 53:
        return np.rint(y.astype(np.float64).T @ y.astype(np.float64)).astype(np.int64)
    return y.T @ y if bound < 1 << 62 else y.astype(object).T @ y.astype(object)


def scatter(rows: DataFrame, n: int, width: int) -> tuple[list[list[int]], list[int]]:
    """n * sum(y y') - S S' and the sums S; the sums of products are added up by Spark as decimals."""
    if width > MAX_WIDTH:
        raise ValueError(f"vectors of {width} entries; an exact polynomial is bounded to {MAX_WIDTH}")
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = np.zeros((width, width), object), np.zeros(width, object)
        for batch in batches:
            y = matrix(batch.column("y").to_pylist(), width)
            total += products(y)
            sums += y.astype(object).sum(axis=0) if len(y) else 0
        values = [int(v) for v in (*total[upper], *sums)]
        yield pa.record_batch([
            pa.array([*upper[0].tolist(), *[-1] * width], pa.int32()),
            pa.array([*upper[1].tolist(), *range(width)], pa.int32()),
            pa.array([Decimal(v) for v in values], pa.decimal128(38, 0)),
        ], ["i", "j", "value"])

    parts = rows.select("y").mapInArrow(run, "i int, j int, value decimal(38,0)")
    found = {(r.i, r.j): int(r.value) for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}
    s = [found[-1, j] for j in range(width)]
    m = [[n * found[min(i, j), max(i, j)] - s[i] * s[j] for j in range(width)] for i in range(width)]
    return m, s


# ---- characteristic polynomial --------------------------------------------------------------------


def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every number below 3.4e14."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7, 11, 13, 17)):
        return n in (2, 3, 5, 7, 11, 13, 17)
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7, 11, 13, 17):
        x = pow(a, d, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(s - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2^31, the largest first, until their product exceeds the bound."""
    found, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def inverses(values: np.ndarray, primes: np.ndarray) -> np.ndarray:
    """Inverses modulo the primes; 0 for 0."""
    return np.array([pow(int(v), -1, int(p)) if v else 0 for v, p in zip(values, primes, strict=True)], np.int64)


def hessenberg(a: np.ndarray, primes: np.ndarray) -> np.ndarray:
    """Matrices modulo one prime each, by similarity in Hessenberg form: zeros below the first subdiagonal."""
    a, d, every = a.copy(), a.shape[1], np.arange(len(a))
    p1, p2 = primes[:, None], primes[:, None, None]
    for k in range(d - 2):
        pivot = k + 1 + (a[:, k + 1 :, k] != 0).argmax(axis=1)
        moved = every[pivot != k + 1]
        if len(moved):
            at = pivot[moved]
            a[moved, at], a[moved, k + 1] = a[moved, k + 1], a[moved, at]
            a[moved, :, at], a[moved, :, k + 1] = a[moved, :, k + 1], a[moved, :, at]
        u = a[:, k + 2 :, k] * inverses(a[:, k + 1, k], primes)[:, None] % p1
        a[:, k + 2 :] = (a[:, k + 2 :] - u[:, :, None] * a[:, k + 1, None] % p2) % p2
        a[:, :, k + 1] = (a[:, :, k + 1] + (a[:, :, k + 2 :] * u[:, None] % p2).sum(axis=2)) % p1
    return a


def polynomials(m: list[list[int]], primes: list[int]) -> np.ndarray:
    """Coefficients of det(z - m) modulo each prime, the constant first."""
    ps = np.array(primes, np.int64)
    h = hessenberg(np.array([[[v % p for v in row] for row in m] for p in primes], np.int64), ps)
    d, col = len(m), ps[:, None]
    polys = [np.zeros((len(ps), d + 1), np.int64)]
    polys[0][:, 0] = 1
    for k in range(d):
        new = np.zeros((len(ps), d + 1), np.int64)
        new[:, 1:] = polys[k][:, :-1]
        new = (new - h[:, k, k, None] * polys[k]) % col
        factor = np.ones(len(ps), np.int64)
        for i in range(k - 1, -1, -1):
            factor = factor * h[:, i + 1, i] % ps
            new = (new - (h[:, i, k] * factor % ps)[:, None] * polys[i]) % col
        polys.append(new)
    return polys[d]


def characteristic(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """det(z - m) of a matrix without negative eigenvalues, exactly; the constant first.

    The coefficients, apart from their sign, are elementary symmetric sums of the eigenvalues, so they are at
    most those of equal eigenvalues with the same trace. That bound says how many primes are needed.
    """
    d = len(m)
    trace = sum(m[i][i] for i in range(d))
    bound = max(math.comb(d, k) * trace**k // d**k for k in range(d + 1)) + 1
    primes = primes_beyond(bound)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine = batch.column("id").to_pylist()
            for start in range(0, len(mine), PRIMES_PER_TASK):
                chosen = mine[start : start + PRIMES_PER_TASK]
                found = polynomials(m, [primes[i] for i in chosen])
                yield pa.record_batch([pa.array(chosen, pa.int64()), pa.array(found.tolist(), pa.list_(pa.int64()))], ["id", "c"])

    tasks = -(-len(primes) // PRIMES_PER_TASK)
    residues = spark.range(0, len(primes), 1, tasks).mapInArrow(run, "id bigint, c array<bigint>").collect()
    product = math.prod(primes)
    joined = [0] * (d + 1)
    for row in residues:
        rest = product // primes[row.id]
        unit = rest * pow(rest, -1, primes[row.id])
        joined = [c + r * unit for c, r in zip(joined, row.c, strict=True)]
    # Signs alternate from the leading coefficient down.
    joined = [c % product if (d - k) % 2 == 0 else c % product - product if c % product else 0 for k, c in enumerate(joined)]
    return joined


# ---- roots ----------------------------------------------------------------------------------------


def trimmed(p: list[int]) -> list[int]:
    """Without leading zeros and common factor."""
    while p and p[-1] == 0:
        p = p[:-1]
    g = math.gcd(*p) if p else 1
    return [c // g for c in p] if g > 1 else p


def derivative(p: list[int]) -> list[int]:
    return [k * c for k, c in enumerate(p)][1:]


def quotient(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """a = q * b + r up to a constant factor, in whole numbers."""
    r, q = list(a), [0] * max(0, len(a) - len(b) + 1)
    while len(r) >= len(b):
        g = math.gcd(r[-1], b[-1])
        up, take, shift = b[-1] // g, r[-1] // g, len(r) - len(b)
        r, q = [c * up for c in r], [c * up for c in q]
        q[shift] += take
        for i, c in enumerate(b):
            r[shift + i] -= take * c
        r.pop()
        while r and r[-1] == 0:
            r.pop()
    return trimmed(q), trimmed(r)


def common(a: list[int], b: list[int]) -> list[int]:
    while b:
        a, b = b, quotient(a, b)[1]
    return trimmed(a)


def coprime_modulo(a: list[int], b: list[int], p: int = (1 << 61) - 1) -> bool:
    """Whether they have no common factor modulo a prime; then they have none at all."""
    a, b = [c % p for c in a], [c % p for c in b]
    if a[-1] == 0:
        return False
    while any(b):
        while b[-1] == 0:
            b.pop()
        inverse = pow(b[-1], -1, p)
        while len(a) >= len(b):
            f, shift = a[-1] * inverse % p, len(a) - len(b)
            for i, c in enumerate(b):
                a[shift + i] = (a[shift + i] - f * c) % p
            a.pop()
        a, b = b, a
    return len(a) == 1


def factors(p: list[int]) -> list[tuple[list[int], int]]:
    """Polynomials with simple roots and the multiplicity that their roots have in p."""
    if coprime_modulo(p, derivative(p)):
        return [(p, 1)]
    found, k = [], 1
    shared = common(p, derivative(p))
    simple = quotient(p, shared)[0]
    while len(simple) > 1:
        still = common(simple, shared)
        if len(still) < len(simple):
            found.append((quotient(simple, still)[0], k))
        simple, shared, k = still, quotient(shared, still)[0], k + 1
    return found


def sign_at(p: list[int], x: Decimal) -> int:
    """The exact sign of p at a decimal number."""
    sign, digits, exponent = x.as_tuple()
    top = int("".join(map(str, digits))) * (-1 if sign else 1)
    top, bottom = (top * 10**exponent, 1) if exponent >= 0 else (top, 10**-exponent)
    value, power = 0, 1
    for c in reversed(p):
        value = value * top + c * power
        power *= bottom
    return (value > 0) - (value < 0)


def approximations(p: list[int], digits: int) -> list[Decimal]:
    """Roots of a polynomial with real simple positive roots, the largest first, not yet certified.

    Laguerre's step, started above the largest root, comes down to it without passing it; the root is then
    divided out. Newton's steps on the whole polynomial end the search.
    """
    with decimal.localcontext(decimal.Context(prec=digits, Emax=decimal.MAX_EMAX, Emin=decimal.MIN_EMIN)):
        whole = [Decimal(c) for c in p]
        rest, roots = list(whole), []
        x = 1 - whole[-2] / whole[-1]
        near, close = Decimal(10) ** -(digits // 3), Decimal(10) ** -(ROOT_DIGITS + 10)
        while len(rest) > 1:
            n = len(rest) - 1
            for _ in range(200):
                f, f1, f2 = values(rest, x)
                if f == 0:
                    break
                g = f1 / f
                inner = (n - 1) * (n * (g * g - 2 * f2 / f) - g * g)
                step = n / (g + (inner.sqrt() if inner > 0 else 0)) if g > 0 else Decimal(0)
                x -= step
                if step <= near * abs(x):
                    break
            root = x
            for _ in range(20):
                f, f1, _ = values(whole, root)
                if f1 == 0:
                    break
                step = f / f1
                root -= step
                if abs(step) <= close * abs(root):
                    break
            roots.append(root)
            quotient_, carry = [], Decimal(0)
            for c in reversed(rest):
                carry = carry * root + c
                quotient_.append(carry)
            rest = quotient_[:-1][::-1]
    return roots


def values(p: list[Decimal], x: Decimal) -> tuple[Decimal, Decimal, Decimal]:
    """The polynomial, its derivative and half its second derivative."""
    f = f1 = f2 = Decimal(0)
    for c in reversed(p):
        f2 = f2 * x + f1
        f1 = f1 * x + f
        f = f * x + c
    return f, f1, f2


def isolated(p: list[int]) -> list[Decimal]:
    """All roots of a polynomial with real simple positive roots, each to ROOT_DIGITS digits.

    A root counts as found when the exact signs of p on both sides of it differ. As many disjoint intervals as
    the degree hold all roots. When one fails, everything is done again with twice the digits.
    """
    digits = 300
    while digits < 200_000:
        roots = sorted(approximations(p, digits), reverse=True)
        with decimal.localcontext(decimal.Context(prec=ROOT_DIGITS + 20, Emax=decimal.MAX_EMAX, Emin=decimal.MIN_EMIN)):
            roots = [+r for r in roots]
            apart = Decimal(10) ** -ROOT_DIGITS
            ends = [(r * (1 - apart), r * (1 + apart)) for r in roots]
            disjoint = all(low > high for (low, _), (_, high) in zip(ends, ends[1:], strict=False))
        if disjoint and all(sign_at(p, a) * sign_at(p, b) < 0 for a, b in ends):
            return roots
        digits *= 2
    raise ArithmeticError("roots could not be isolated")


def eigenvalues(poly: list[int]) -> list[tuple[Decimal, int]]:
    """Positive eigenvalues and their multiplicity, the largest first."""
    while poly and poly[0] == 0:
        poly = poly[1:]
    if len(poly) < 2:
        return []
    return sorted(((r, k) for f, k in factors(trimmed(poly)) for r in isolated(f)), reverse=True)


# ---- components -----------------------------------------------------------------------------------


def solve(a: list[list[Decimal]], rights: list[list[Decimal]], least: Decimal) -> list[list[Decimal]]:
    """Solutions for several right sides by elimination with row pivots; pivots below `least` become it."""
    a, b, d = [row[:] for row in a], [list(col) for col in zip(*rights, strict=True)], len(a)
    for k in range(d):
        at = max(range(k, d), key=lambda i: abs(a[i][k]))
        a[k], a[at], b[k], b[at] = a[at], a[k], b[at], b[k]
        if abs(a[k][k]) < least:
            a[k][k] = least
        head = a[k]
        for i in range(k + 1, d):
            if f := a[i][k] / head[k]:
                row = a[i]
                a[i] = row[: k + 1] + [x - f * y for x, y in zip(row[k + 1 :], head[k + 1 :], strict=True)]
                b[i] = [x - f * y for x, y in zip(b[i], b[k], strict=True)]
    out = [[Decimal(0)] * len(rights) for _ in range(d)]
    for k in range(d - 1, -1, -1):
        for c in range(len(rights)):
            out[k][c] = (b[k][c] - sum((a[k][j] * out[j][c] for j in range(k + 1, d)), Decimal(0))) / a[k][k]
    return [list(col) for col in zip(*out, strict=True)]


def orthonormal(vectors: list[list[Decimal]]) -> list[list[Decimal]]:
    """Gram-Schmidt, twice, in the precision at hand."""
    done: list[list[Decimal]] = []
    for v in vectors:
        for _ in range(2):
            for u in done:
                dot = sum((x * y for x, y in zip(u, v, strict=True)), Decimal(0))
                v = [x - dot * y for x, y in zip(v, u, strict=True)]
            length = sum((x * x for x in v), Decimal(0)).sqrt()
            v = [x / length for x in v]
        done.append(v)
    return done


def components(m: list[list[int]], root: Decimal, count: int) -> list[list[float]]:
    """Orthonormal vectors that m only stretches by the root, as many as its multiplicity.

    Inverse iteration: the root is off by 1 in ROOT_DIGITS digits, so a step shrinks everything else by about
    that factor over the gap to the next root. Of a component's two signs the one whose first largest entry
    is positive is taken.
    """
    with decimal.localcontext(decimal.Context(prec=ROOT_DIGITS + SPARE_DIGITS, Emax=decimal.MAX_EMAX, Emin=decimal.MIN_EMIN)):
        shifted = [[Decimal(v) - (root if i == j else 0) for j, v in enumerate(row)] for i, row in enumerate(m)]
        vectors = [
            [Decimal(int(i % count == c)) + Decimal(1 + i * (7 + c) % 11) / 100 for i in range(len(m))] for c in range(count)
        ]
        for _ in range(3):
            vectors = orthonormal(solve(shifted, vectors, root * Decimal(10) ** -(ROOT_DIGITS + SPARE_DIGITS // 2)))
        found = [[float(x) for x in v] for v in vectors]
    peaks = [v[int(np.abs(v).argmax())] for v in found]
    return [[-x for x in v] if peak < 0 else v for v, peak in zip(found, peaks, strict=True)]


@dataclass(frozen=True)
class Whitener:
    """Sums of the fitted rows, and per component its vector, root and share of the trace."""

    n: int
    width: int
    sums: list[int]
    vectors: np.ndarray
    roots: list[Decimal]
    explained: list[float]


def fit(rows: DataFrame, top: int = 32) -> Whitener:
    """Components of the rows (`y`) with positive eigenvalues, at most `top`, numbered by falling eigenvalue."""
    spark = rows.sparkSession
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("y")), F.lit(0)).alias("width")).first()
    n, width = size["n"], size["width"]
    if n == 0 or width == 0:
        return Whitener(n, width, [0] * width, np.zeros((0, width)), [], [])
    m, sums = scatter(rows, n, width)
    trace = sum(m[i][i] for i in range(width))
    roots = eigenvalues(characteristic(spark, m))
    wanted, taken = [], 0
    while len(wanted) < len(roots) and taken < top:
        wanted.append(roots[len(wanted)])
        taken += wanted[-1][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column("id").to_pylist():
                found = components(m, *wanted[i])
                yield pa.record_batch([pa.array([i] * len(found), pa.int64()), pa.array(range(len(found)), pa.int64()), pa.array(found, pa.list_(pa.float64()))], ["id", "part", "v"])

    found = spark.range(0, len(wanted), 1, max(1, len(wanted))).mapInArrow(run, "id bigint, part bigint, v array<double>").collect() if wanted else []
    found = sorted(found, key=lambda r: (r.id, r.part))[:top]
    of = [wanted[r.id][0] for r in found]
    with decimal.localcontext(decimal.Context(prec=ROOT_DIGITS)):
        explained = [float(r / trace) for r in of]
    return Whitener(n, width, sums, np.array([r.v for r in found]).reshape(len(found), width), of, explained)


def project(rows: DataFrame, model: Whitener) -> DataFrame:
    """vec_id, deviation and `z`, the whitened components, of every row.

    A deviation beyond a long is NULL.
    """
    n, width, sums = model.n, model.width, model.sums
    with decimal.localcontext(decimal.Context(prec=ROOT_DIGITS)):
        weights = model.vectors.T / np.array([float(r.sqrt()) for r in model.roots])
    # n * y - S = n * (y - base) - rest, and y - base is small where y is near its mean.
    base = np.array([s // n for s in sums], object) if n else np.zeros(width, object)
    rest = np.array([s % n for s in sums], object) if n else base

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = matrix(batch.column("y").to_pylist(), width)
            top = (int(np.abs(y).max(initial=0)) + max((abs(int(b)) for b in base), default=0) + 1) * n
            kind = np.int64 if top * top * max(1, width) < 1 << 62 else object
            off = (y.astype(kind) - base.astype(kind)) * n - rest.astype(kind)
            squares = (off * off).sum(axis=1).tolist()
            z = off.astype(np.float64) @ weights
            yield pa.record_batch([
                batch.column("vec_id"),
                pa.array([s if s < 1 << 63 else None for s in squares], pa.int64()),
                pa.array(z.tolist(), pa.list_(pa.float64())),
            ], ["vec_id", "deviation", "z"])

    return rows.select("vec_id", "y").mapInArrow(run, "vec_id bigint, deviation bigint, z array<double>")


def identity_error(whitened: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the covariance of `z` minus the identity; centred before multiplying."""

    def added(measure) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(k * k)
            for batch in batches:
                z = np.array(batch.column("z").to_pylist(), np.float64).reshape(-1, k)
                part = measure(z).ravel()
                total[: len(part)] += part
            yield pa.record_batch([pa.array(range(k * k), pa.int32()), pa.array(total)], ["i", "value"])

        parts = whitened.select("z").mapInArrow(run, "i int, value double").groupBy("i").agg(F.sum("value").alias("value"))
        found = {r.i: r.value for r in parts.collect()}
        return np.array([found[i] for i in range(k * k)])

    mean = added(lambda z: z.sum(axis=0))[:k] / n
    covariance = added(lambda z: (z - mean).T @ (z - mean)).reshape(k, k) / n
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(vectors: DataFrame, top: int = 32) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row and component.

    Vectors that are NULL or hold a NULL or an infinite or undefined entry are left out; a NULL vec_id is
    not. Missing entries of shorter vectors count as 0. Repeated rows count as often as they occur; equal
    eigenvalues get any orthonormal set of components. Components without variance cannot be scaled and are left
    out, so a table whose vectors are all equal, like an empty one, gives no rows. Other columns are not
    looked at. Vectors of more than MAX_WIDTH entries are refused.
    """
    rows = materialize(whole_numbers(vectors), "whole-numbers")
    model = fit(rows, top)
    k = len(model.roots)
    if not k:
        schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], schema)
    whitened = materialize(project(rows, model), "whitened")
    error = identity_error(whitened, model.n, k)
    long = whitened.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
    share = F.get(F.array(*[F.lit(x) for x in model.explained]), F.col("at"))
    return long.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        share.alias("explained"), F.lit(error).alias("identity_error"),
    )
