"""Whitening of vectors by an incremental eigendecomposition.

1. Every component becomes an integer, and each distinct vector is fitted once. Their sums are
   exact, so what is left after the mean is subtracted has one rounding.
2. Each task walks its vectors and keeps the eigenvalues and vectors of their scatter. A vector
   is a rank-one update, centred at the mean so far: the new eigenvalues are the roots of a
   secular equation, eigenvalues that it leaves alone or that coincide are deflated first, and
   the new vectors come from weights recomputed out of the roots, which keeps them orthogonal.
3. Tasks' spectra are merged in groups of ``FAN``, in as many rounds as it takes: every pair of
   one side is a rank-one update of the other, as is the difference of the means.
4. A Rayleigh-Ritz step over all vectors removes the rounding that the updates gathered, and
   another one measures how far the whitened covariance is from the identity; it is repeated
   while that is more than rounding.

Memory is a square matrix of the dimension per task and on the driver, whatever the rows.

Edge cases: vectors that are null, empty, or hold null or non-finite components are left out, as
are those with a component of 2 ** 56 or more, which has no exact integer here, and those that
are not of the most frequent length (of the longest of these). Repeated vectors are fitted once
and come back once a row; ids may be null or repeat. Where an eigenvalue is zero up to rounding
the whitened value is null; with no variance at all, so are ``explained`` and the error. A
deviation that a long can't hold is null. An empty table gives no rows. Other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from songweave.llm.common import store

SCALE, OFFSET = 64, 1_000_000
LARGEST = float(2**56)
FAN = 8
# Rows of which a task holds the doubles at once.
ROWS = 2048
REFINEMENTS = 4
ROUNDING = 1e-9
EPS = np.finfo(np.float64).eps
STATE = "part long, n long, mean binary, vals binary, basis binary"


# --------------------------------------------------------------------------- rank-one updates


def secular_roots(poles: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + sum(squares / (poles - x)), ascending, one above every pole.

    ``poles`` ascend strictly and squares are positive. A root is given as (number of the pole
    that is nearer, distance from it), which loses no digits where they are close. All roots
    are iterated at once by interpolation with the two poles around each; bisection takes over
    where a step leaves the bracket.
    """
    n = len(poles)
    own = np.arange(n)
    gap = np.append(np.diff(poles), squares.sum())
    half = gap / 2
    value = 1 + (squares / (poles - poles[:, None] - half[:, None])).sum(1)
    right = (value < 0) & (own < n - 1)
    origin = own + right
    low = np.where(right, -half, np.where(value < 0, half, 0.0))
    high = np.where(right, 0.0, np.where(value < 0, gap, half))
    delta = poles - poles[origin][:, None]
    below = own[None, :] <= own[:, None]
    left, next_ = delta[own, own], delta[own, np.minimum(own + 1, n - 1)]
    x = (low + high) / 2
    for _ in range(100):
        apart = delta - x[:, None]
        terms = squares / apart
        value = 1 + terms.sum(1)
        done = np.abs(value) <= EPS * (1 + np.abs(terms).sum(1)) * 4
        if done.all():
            break
        terms /= apart
        slope_below = np.where(below, terms, 0.0).sum(1)
        slope_above = terms.sum(1) - slope_below
        low, high = np.where(value < 0, x, low), np.where(value < 0, high, x)
        a, b = left - x, next_ - x
        with np.errstate(all="ignore"):
            c = value - a * slope_below - b * slope_above
            p = (a + b) * value - a * b * (slope_below + slope_above)
            q = a * b * value
            root = np.sqrt(np.maximum(p * p - 4 * q * c, 0))
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
            # The last root has a pole on one side only.
            step[-1] = a[-1] + a[-1] ** 2 * slope_below[-1] / (value[-1] - a[-1] * slope_below[-1])
            to = x + step
        fits = (to > low) & (to < high)
        to = np.where(fits, to, (low + high) / 2)
        stuck = (to <= low) | (to >= high) | (to == x)
        x = np.where(done | stuck, x, to)
        if (done | stuck).all():
            break
    return origin, x


def rank_one(
    values: np.ndarray, basis: np.ndarray, vector: np.ndarray, weight: float
) -> tuple[np.ndarray, np.ndarray]:
    """The spectrum of ``basis diag(values) basis' + weight vector vector'``, weight above 0.

    ``values`` ascend, and so do the ones returned.
    """
    z = vector @ basis
    length = np.sqrt(z @ z)
    scale = max(values[-1], weight * length * length)
    if not scale > 0:
        return values, basis
    little = 8 * EPS * scale
    # Values that coincide: turn their vectors so that only the last meets the update.
    ends = np.append(np.flatnonzero(np.diff(values) > little), len(values) - 1)
    starts = np.append(0, ends[:-1] + 1)
    for s, e in zip(starts[ends > starts].tolist(), ends[ends > starts].tolist()):
        part = z[s : e + 1]
        size = np.sqrt(part @ part)
        if size > 0 and np.abs(part[:-1]).max() > 0:
            mirror = part.copy()
            sign = 1.0 if part[-1] >= 0 else -1.0
            mirror[-1] += sign * size
            mirror /= np.sqrt(mirror @ mirror)
            basis = basis.copy()
            basis[:, s : e + 1] -= 2 * np.outer(basis[:, s : e + 1] @ mirror, mirror)
            z[s : e + 1] = 0
            z[e] = -sign * size
    active = np.flatnonzero(weight * np.abs(z) * length > little)
    if not len(active):
        return values, basis
    poles, w = values[active], z[active]
    origin, x = secular_roots(poles, weight * w * w)
    # root i - pole j, and the weights for which these are the exact roots.
    apart = x[:, None] - (poles - poles[origin][:, None])
    between = poles[:, None] - poles
    np.fill_diagonal(between, 1.0)
    exact = np.sqrt(np.abs(apart / between).prod(0)) * np.where(w < 0, -1.0, 1.0)
    turn = (exact / -apart).T
    turn /= np.sqrt((turn * turn).sum(0))
    values, basis = values.copy(), basis.copy()
    values[active] = poles[origin] + x
    basis[:, active] = basis[:, active] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]


@dataclass
class Spectrum:
    """Number, mean and eigendecomposed scatter of some vectors."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @staticmethod
    def empty(size: int) -> Spectrum:
        return Spectrum(0, np.zeros(size), np.zeros(size), np.eye(size))

    def update(self, vector: np.ndarray, weight: float = 1.0) -> None:
        self.values, self.basis = rank_one(self.values, self.basis, vector, weight)

    def add(self, vector: np.ndarray) -> None:
        """One more vector."""
        off = vector - self.mean
        self.n += 1
        self.mean = self.mean + off / self.n
        if self.n > 1:
            self.update(off, (self.n - 1) / self.n)

    def merge(self, other: Spectrum) -> None:
        """All vectors of another spectrum."""
        least = EPS * max(other.values[-1], 0.0)
        for value, vector in zip(other.values, other.basis.T):
            if value > least:
                self.update(vector, value)
        total = self.n + other.n
        off = other.mean - self.mean
        self.update(off, self.n * (other.n / total))
        self.mean = self.mean + off * (other.n / total)
        self.n = total

    def row(self, part: int) -> list:
        raw = [a.astype("<f8").tobytes() for a in (self.mean, self.values, self.basis)]
        return [part, self.n, *raw]

    @staticmethod
    def of(row) -> Spectrum:
        mean, values, basis = (np.frombuffer(row[c], "<f8") for c in ("mean", "vals", "basis"))
        return Spectrum(int(row["n"]), mean, values, basis.reshape(len(mean), -1))


def merged_spectra(pdf: pd.DataFrame) -> pd.DataFrame:
    """At most ``FAN`` tasks' spectra as one."""
    pdf = pdf.sort_values("part")
    whole = Spectrum.of(pdf.iloc[0])
    for i in range(1, len(pdf)):
        whole.merge(Spectrum.of(pdf.iloc[i]))
    return pd.DataFrame([whole.row(int(pdf["part"].iloc[0]) // FAN)], columns=list(pdf.columns))


def summed_squares(pdf: pd.DataFrame) -> pd.DataFrame:
    """At most ``FAN`` tasks' matrices as their sum."""
    pdf = pdf.sort_values("part")
    total = sum(np.frombuffer(m, "<f8") for m in pdf["matrix"])
    part = int(pdf["part"].iloc[0]) // FAN
    return pd.DataFrame({"part": [part], "matrix": [total.tobytes()]})


def _as_one(states: DataFrame, together: Callable, schema: str):
    """The only row left after merging states in groups of ``FAN`` parts, round by round."""
    states = store(states)
    most = states.agg(F.max("part")).first()[0]
    while most > 0:
        states = store(
            states.groupBy(F.floor(F.col("part") / FAN).alias("group")).applyInPandas(together, schema)
        )
        most //= FAN
    return states.first()


# --------------------------------------------------------------------------- Spark


def whole_numbers(vector: Column) -> Column:
    """The integer vector, null where the row takes no part."""
    good = F.forall(
        vector, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)) & ~F.isnan(c)
    )
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + OFFSET)
    return F.when((F.size(vector) > 0) & good, x)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


@dataclass
class Whitening:
    """``n`` fitted vectors, their exact sums, and the leading components, greatest first."""

    n: int
    sums: list[int]
    values: np.ndarray
    basis: np.ndarray  # a component a column
    trace: float
    error: float | None

    @property
    def size(self) -> int:
        return len(self.sums)

    def usable(self) -> np.ndarray:
        """Which components have variance beyond rounding."""
        return self.values > self.size * EPS * max(self.values.max(initial=0.0), 0.0)


def _shift(sums: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The mean as whole part and remainder (over n)."""
    return np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)


def _sums(fit: DataFrame, size: int) -> list[int]:
    """Exact sums of each dimension, in halves that can't overflow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in _batches(batches):
            x = _matrix(batch.column("x"), size)
            high += (x >> 32).sum(0)
            low += (x & 0xFFFFFFFF).sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size)), pa.array(high), pa.array(low)], ["at", "high", "low"]
        )

    parts = fit.mapInArrow(run, "at long, high long, low long")
    total = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    rows = parts.groupBy("at").agg(*total).orderBy("at").collect()
    return [int(r["high"]) * 2**32 + int(r["low"]) for r in rows]


def _spectra(fit: DataFrame, whole: np.ndarray, rest: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        own = Spectrum.empty(len(whole))
        for pdf in batches:
            for at in range(0, len(pdf), ROWS):
                for row in np.stack(pdf["x"].iloc[at : at + ROWS].to_list()) - whole - rest:
                    own.add(row)
        if own.n:
            row = own.row(TaskContext.get().partitionId())
            yield pd.DataFrame([row], columns=["part", "n", "mean", "vals", "basis"])

    return fit.mapInPandas(run, STATE)


def _projected_squares(fit: DataFrame, whole, rest, basis: np.ndarray) -> np.ndarray:
    """basis' * scatter * basis over all fitted vectors."""
    size = len(whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((basis.shape[1], basis.shape[1]))
        for batch in _batches(batches):
            on = (_matrix(batch.column("x"), size) - whole - rest) @ basis
            total += on.T @ on
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()]), pa.array([total.astype("<f8").tobytes()])],
            ["part", "matrix"],
        )

    schema = "part long, matrix binary"
    one = _as_one(fit.mapInArrow(run, schema), summed_squares, schema)
    return np.frombuffer(one["matrix"], "<f8").reshape(basis.shape[1], -1)


def fit(vectors: DataFrame, column: str = "embedding", components: int = 16) -> Whitening | None:
    """The whitening of the distinct vectors; None without any."""
    x = vectors.select(whole_numbers(F.col(column)).alias("x")).where("x is not null")
    common = (
        x.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    )
    if common is None:
        return None
    size = common["size"]
    distinct = store(x.where(F.size("x") == size).distinct())
    n = distinct.count()
    sums = _sums(distinct, size)
    whole, over = _shift(sums, n)
    rest = over / n
    one = _as_one(_spectra(distinct, whole, rest), merged_spectra, STATE)
    basis, _ = np.linalg.qr(Spectrum.of(one).basis[:, ::-1])
    squares = _projected_squares(distinct, whole, rest, basis) / n
    for _ in range(REFINEMENTS):
        values, turn = np.linalg.eigh((squares + squares.T) / 2)
        values, basis = values[::-1], basis @ turn[:, ::-1]
        squares = _projected_squares(distinct, whole, rest, basis) / n
        found = Whitening(
            n, sums, values[:components], basis[:, :components], float(np.trace(squares)), None
        )
        good = np.flatnonzero(found.usable())
        if len(good):
            lengths = np.sqrt(values[good])
            whitened = squares[np.ix_(good, good)] / lengths / lengths[:, None]
            found.error = float(np.abs(whitened - np.eye(len(good))).max())
        if found.error is None or found.error <= ROUNDING:
            break
    top = np.abs(found.basis).argmax(0)
    found.basis = found.basis * np.sign(found.basis[top, np.arange(found.basis.shape[1])])
    return found


def deviations(x: np.ndarray, whole: np.ndarray, over: np.ndarray, n: int) -> list[int | None]:
    """Sum of (n * x - sums) ** 2 of each row, exact; None beyond a long."""
    off = x - whole
    most = int(np.abs(off).max(initial=0)) * n + n
    if most * most * len(whole) < 2**63:
        return ((off * n - over) ** 2).sum(1).tolist()
    exact = ((off.astype(object) * n - over.astype(object)) ** 2).sum(1)
    return [int(e) if e < 2**63 else None for e in exact]


def whitened(
    vectors: DataFrame, model: Whitening | None, id_: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for every
    component of every vector that takes part."""
    schema = (
        f"`{id_}` long, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double"
    )
    rows = vectors.select(F.col(id_).cast("long").alias("id"), whole_numbers(F.col(column)).alias("x"))
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    whole, over = _shift(model.sums, model.n)
    width = len(model.values)
    good = model.usable()
    lengths = np.sqrt(np.where(good, model.values, 1.0))
    shares = model.values / model.trace if model.trace > 0 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            x = _matrix(batch.column("x"), model.size)
            on = (x - whole - over / model.n) @ model.basis / lengths
            m, each = len(x), np.repeat(np.arange(len(x)), width)
            exact = pa.array(deviations(x, whole, over, model.n), pa.int64())
            no_share = pa.nulls(m * width, pa.float64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, width + 1), m), pa.int32()),
                    pa.array(np.full(m * width, model.n)),
                    exact.take(pa.array(each)),
                    pa.array(on.ravel(), mask=np.tile(~good, m)),
                    no_share if shares is None else pa.array(np.tile(shares, m)),
                    pa.array([model.error] * (m * width), pa.float64()),
                ],
                [id_, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.where(F.size("x") == model.size).mapInArrow(run, schema)
