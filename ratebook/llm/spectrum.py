"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The inertia of A - s*I (signs of the pivots of its LDL^T factors) says how many eigenvalues lie
above s.  Counts isolate each leading eigenvalue in an interval, Rayleigh quotient iteration
closes in on it (cubically), and two more counts certify that the pair found is the one of that
number.  Eigenvalues closer to each other than the matrix can tell form a cluster; its vectors
are found one after the other, each at right angles to those before.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bunch-Kaufman's constant: the growth of 1x1 and of 2x2 pivots is balanced.
_ALPHA = (1 + 17**0.5) / 8
_EPS = np.finfo(float).eps


class NotCertified(ArithmeticError):
    """A pair whose number the counts do not confirm."""


def above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric `a` are larger than `shift`.

    LDL^T with 1x1 and 2x2 pivots (Bunch-Kaufman, one column searched a step); by Sylvester's
    law the signs of the blocks of D are those of the eigenvalues.  A 2x2 pivot is taken only
    where its determinant is negative: it stands for one eigenvalue on each side.
    """
    m = a - shift * np.eye(len(a))
    positive = 0
    while len(m):
        column = np.abs(m[1:, 0])
        if not len(column) or column.max() == 0:
            positive += m[0, 0] > 0
            m = m[1:, 1:]
            continue
        r = 1 + int(column.argmax())
        largest = column[r - 1]
        pair = False
        if abs(m[0, 0]) < _ALPHA * largest:
            other = np.abs(np.delete(m[:, r], r)).max()
            if abs(m[0, 0]) * other < _ALPHA * largest**2:
                pair = abs(m[r, r]) < _ALPHA * other
                swapped = 1 if pair else 0
                if swapped != r:
                    order = np.arange(len(m))
                    order[[swapped, r]] = order[[r, swapped]]
                    m = m[np.ix_(order, order)]
        if pair:
            block, rest = m[:2, :2], m[2:, :2]
            positive += 1
            m = m[2:, 2:] - rest @ np.linalg.solve(block, rest.T)
        else:
            positive += m[0, 0] > 0
            m = m[1:, 1:] - np.outer(m[1:, 0], m[1:, 0]) / m[0, 0]
    return int(positive)


@dataclass
class Pairs:
    """The largest eigenvalues, falling, and their unit vectors as rows."""

    values: np.ndarray
    vectors: np.ndarray


class _Interval:
    """Where eigenvalue `number` (from 1) lies, by counts at both ends."""

    def __init__(self, a: np.ndarray, number: int, low: float, high: float) -> None:
        self.a, self.number, self.low, self.high = a, number, low, high
        self.above_low, self.above_high = above(a, low), above(a, high)

    @property
    def alone(self) -> bool:
        return self.above_low == self.number and self.above_high == self.number - 1

    def halve(self) -> None:
        middle = (self.low + self.high) / 2
        count = above(self.a, middle)
        if count >= self.number:
            self.low, self.above_low = middle, count
        else:
            self.high, self.above_high = middle, count


def _refined(a, low, high, earlier, start, close):
    """Rayleigh quotient iteration from inside the interval, at right angles to `earlier`."""
    identity = np.eye(len(a))

    def clean(v):
        for _ in range(2):
            v = v - earlier.T @ (earlier @ v)
        return v / np.linalg.norm(v)

    def solved(shift, v):
        try:
            out = np.linalg.solve(a - shift * identity, v)
        except np.linalg.LinAlgError:
            out = np.linalg.solve(a - (shift + close) * identity, v)
        return clean(out) if np.all(np.isfinite(out)) else v

    v = clean(start)
    # Steps at a fixed shift turn the vector towards the interval's own eigenvalue.
    for _ in range(3):
        v = solved((low + high) / 2, v)
    for _ in range(30):
        value = float(v @ a @ v)
        if np.linalg.norm(a @ v - value * v) <= close:
            break
        # A quotient that has left the interval would converge to another pair.
        v = solved(value if low <= value <= high else (low + high) / 2, v)
    else:
        value = float(v @ a @ v)
    # One more step: the residual was small, the cubic step takes it to rounding.
    v = solved(float(v @ a @ v), v)
    return float(v @ a @ v), v


def leading(a: np.ndarray, k: int) -> Pairs:
    """The `k` largest positive eigenvalues (all of them, if fewer) and their unit vectors.

    Eigenvalues that rounding cannot tell from zero are left out.  The first component of
    largest size is positive in every vector, so a rerun gives the same signs.
    """
    a = (a + a.T) / 2
    d = len(a)
    scale = float(np.abs(a).sum(axis=1).max()) if d else 0.0
    if not scale:
        return Pairs(np.zeros(0), np.zeros((0, d)))
    close = 8 * d * _EPS * scale
    found = min(k, above(a, close))
    values, vectors = np.zeros(0), np.zeros((0, d))
    rng = np.random.default_rng(0)
    # Gershgorin: no eigenvalue lies beyond the largest row sum.
    high = scale * (1 + 4 * _EPS) + close
    for number in range(1, found + 1):
        interval = _Interval(a, number, 0.0, high)
        while not interval.alone and interval.high - interval.low > close:
            interval.halve()
        while True:
            start = rng.standard_normal(d)
            value, v = _refined(a, interval.low, interval.high, vectors, start, close)
            slack = 4 * close
            if above(a, value + slack) < number <= above(a, value - slack):
                break
            # The iteration went to a neighbour: start again nearer to the eigenvalue.
            if interval.high - interval.low <= close:
                raise NotCertified(f"eigenvalue {number} near {value}")
            for _ in range(3):
                interval.halve()
        if v[np.argmax(np.abs(v))] < 0:
            v = -v
        values, vectors = np.append(values, value), np.vstack((vectors, v))
    return Pairs(values, vectors)
