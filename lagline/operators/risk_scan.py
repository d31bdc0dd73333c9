"""Sums of a Cox partial likelihood by scans over rows that are range partitioned by time.

A risk set is all rows from a time on, so its sums are suffix sums. Partitions return their totals; from these the driver
knows what lies behind each partition, and a second pass adds up likelihood, gradient and Hessian inside the partitions.
Rows meet the Hessian with the sum of the factors of all earlier event times: a prefix sum, of which partitions know
their own part and the driver the rest. Times that lie in more than one partition (there are fewer than two a partition)
are put together by the driver. What it receives is a few matrices as wide as the model per partition, whatever the number
of distinct times; no pass shuffles. Inside a partition the products of rows and covariates are worked out for STEP rows at a
time, so that a task holds its rows once, in the few bytes they are kept in, and sums per distinct time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame

from lagline.session import hold

STEP = 8_192  # rows whose products with the covariates are held at once


def efron_sums(a: float, b: float, d: int, exact: int = 4096) -> np.ndarray:
    """Sums over l = 0..d-1 of log f, 1/f, x/f, 1/f^2, x/f^2, x^2/f^2 with x = l/d and f = a - b x.

    The last `exact` terms are summed. What comes before, nothing if there are no more, is integrated by Gauss-Legendre
    on panels that halve towards the end, with Euler-Maclaurin corrections: f changes by less than 1 / exact of itself
    from term to term there, so the neglected fourth-order term is below exact ** -4 of a term.
    """
    def terms(x: np.ndarray) -> np.ndarray:
        f = a - b * x
        return np.stack([np.log(f), 1 / f, x / f, 1 / f**2, x / f**2, (x / f) ** 2])

    head = max(0, d - exact)
    tail = terms(np.arange(head, d) / d).sum(axis=1)
    if not head:
        return tail
    end = head / d
    nodes, weights = np.polynomial.legendre.leggauss(16)
    edges = [0.0]
    while 1 - edges[-1] > 2 * (1 - end):
        edges.append(1 - (1 - edges[-1]) / 2)
    edges.append(end)
    total = np.zeros(6)
    for lo, hi in zip(edges[:-1], edges[1:]):
        total += (terms((hi + lo) / 2 + (hi - lo) / 2 * nodes) * weights).sum(axis=1) * (hi - lo) / 2 * d
    ends = terms(np.array([0.0, end]))

    def slope(x: float) -> np.ndarray:
        f = a - b * x
        return np.array([-b / f, b / f**2, (f + b * x) / f**2, 2 * b / f**3, (f + 2 * b * x) / f**3, 2 * x * (f + b * x) / f**3])

    return tail + total + (ends[:, 0] - ends[:, 1]) / 2 + (slope(end) - slope(0.0)) / (12 * d)


def efron_rows(s0: np.ndarray, e0: np.ndarray, d: np.ndarray) -> np.ndarray:
    """`efron_sums` per time; zeros where there is no event."""
    out = np.zeros((len(d), 6))
    one = d == 1
    out[one, 0], out[one, 1], out[one, 3] = np.log(s0[one]), 1 / s0[one], 1 / s0[one] ** 2
    for i in np.flatnonzero(d > 1):
        out[i] = efron_sums(float(s0[i]), float(e0[i]), int(d[i]))
    return out


@dataclass
class Part:
    """Rows of one partition in order of time."""

    time: np.ndarray
    event: np.ndarray
    weight: np.ndarray
    numbers: np.ndarray
    marks: np.ndarray  # indicators, a byte each

    def standard(self, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
        return (np.concatenate((self.numbers, self.marks), axis=1) - mean) / scale

    def rows(self, first: int, end: int) -> Part:
        return Part(*[x[first:end] for x in (self.time, self.event, self.weight, self.numbers, self.marks)])

    def heads(self) -> np.ndarray:
        """The first row of each distinct time."""
        return np.flatnonzero(np.r_[True, self.time[1:] != self.time[:-1]]) if len(self.time) else np.zeros(0, int)

    def steps(self, beta: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> Iterator[tuple[slice, Part, np.ndarray, np.ndarray]]:
        """A few rows after the other: where they stand, they, their standardised covariates and their risks."""
        for a in range(0, len(self.time), STEP):
            some = self.rows(a, a + STEP)
            z = some.standard(mean, scale)
            yield slice(a, a + STEP), some, z, some.weight * np.exp(z @ beta)


@dataclass
class PerTime:
    """Sums per distinct time: of risks r over all rows (r0, r1 with covariates) and event rows (e0, e1), events d, ex."""

    time: np.ndarray
    r0: np.ndarray
    r1: np.ndarray
    e0: np.ndarray
    e1: np.ndarray
    d: np.ndarray
    ex: np.ndarray


def _sums(part: Part, beta: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> tuple[PerTime, np.ndarray]:
    """Sums per distinct time, and the number of each row's time."""
    heads, p = part.heads(), len(beta)
    n = len(heads)
    at = np.repeat(np.arange(n, dtype=np.int32), np.diff(np.r_[heads, len(part.time)]))
    sums = PerTime(part.time[heads], np.zeros(n), np.zeros((n, p)), np.zeros(n), np.zeros((n, p)), np.zeros(n), np.zeros((n, p)))
    for where, some, z, r in part.steps(beta, mean, scale):
        own = some.heads()
        times = slice(at[where.start], at[where.start] + len(own))
        dead = some.event == 1
        e, seen = np.where(dead, r, 0.0), np.where(dead, some.weight, 0.0)
        for total, weight in ((sums.r0, r), (sums.e0, e), (sums.d, seen)):
            total[times] += np.add.reduceat(weight, own)
        for total, weight in ((sums.r1, r), (sums.e1, e), (sums.ex, seen)):
            total[times] += np.add.reduceat(weight[:, None] * z, own, axis=0)
    return sums, at


def _moments(part: Part, at: np.ndarray, beta: np.ndarray, mean: np.ndarray, scale: np.ndarray, own: np.ndarray, dead: np.ndarray) -> list[np.ndarray]:
    """Second moments of all rows with the factors `own` of their times, of event rows with `dead`, and of all rows without a factor."""
    out = [np.zeros((len(beta), len(beta))) for _ in range(3)]
    for where, some, z, r in part.steps(beta, mean, scale):
        time, e = at[where], some.event == 1
        out[0] += z.T @ ((r * own[time])[:, None] * z)
        out[1] += z[e].T @ ((r * dead[time])[e][:, None] * z[e])
        out[2] += z.T @ (r[:, None] * z)
    return out


@dataclass
class Piece:
    """What a stretch of times adds to the likelihood, before the factors of earlier times are known."""

    likelihood: float
    gradient: np.ndarray
    second: np.ndarray  # second moments with the stretch's own factors, less outer products
    moments: np.ndarray  # second moments of all its rows, to be multiplied by the factors of earlier times
    factors: float
    hazard: float
    ranks: np.ndarray  # sums of rank d, rank^2 d
    turned: np.ndarray  # sum of rank times residual
    residual: np.ndarray


def _piece(s: PerTime, s0: np.ndarray, s1: np.ndarray, rank: np.ndarray, beta: np.ndarray, moments: Callable) -> Piece:
    """moments: `_moments` of the rows by factors per time."""
    a = efron_rows(s0, s.e0, s.d)
    expected = s1 * a[:, 1:2] - s.e1 * a[:, 2:3]
    residual = s.ex - expected
    cross = s1.T @ (a[:, 4:5] * s.e1)
    outer = s1.T @ (a[:, 3:4] * s1) - cross - cross.T + s.e1.T @ (a[:, 5:6] * s.e1)
    own, dead, plain = moments(np.cumsum(a[:, 1]), a[:, 2])
    second = own - dead - outer
    return Piece(
        float((s.ex @ beta).sum() - a[:, 0].sum()), residual.sum(axis=0), second, plain, float(a[:, 1].sum()),
        float((s.d / s0).sum()), np.array([(rank * s.d).sum(), (rank**2 * s.d).sum()]), rank @ residual, residual.sum(axis=0),
    )


@dataclass
class Value:
    """A partial likelihood at some coefficients."""

    likelihood: float
    gradient: np.ndarray
    hessian: np.ndarray
    events: float
    spread: float  # of the events' ranks (0 to 1) around their mean
    turned: np.ndarray  # sum of centred rank times residual
    behind: dict[int, tuple[float, np.ndarray]]  # per partition the risk sums of all later times
    before: dict[int, float]  # per partition the hazard of all earlier times
    shared: list[tuple[float, float, float]]  # time, hazard, hazard of all earlier times


class RiskScan:
    """Kept arrays of a table `time`, `event`, `w` and covariates, range partitioned by time and sorted."""

    def __init__(self, rows: DataFrame, columns: list[str], numeric: int):
        width = len(columns)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                values = [b.column(i).to_numpy(zero_copy_only=False) for i in range(3 + width)]
                numbers = np.array(values[3 : 3 + numeric], float).T.reshape(b.num_rows, numeric)
                marks = np.array(values[3 + numeric :], np.uint8).T.reshape(b.num_rows, width - numeric)
                arrays = [values[0].astype(float), values[1].astype(np.int8), values[2].astype(float), numbers, marks]
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in arrays], list("tewnm"))

        def whole(index: int, found: Iterator) -> Iterator[tuple[int, Part]]:
            parts = []
            for r in found:
                t = np.frombuffer(r["t"])
                parts.append((
                    t, np.frombuffer(r["e"], np.int8), np.frombuffer(r["w"]), np.frombuffer(r["n"]).reshape(len(t), numeric),
                    np.frombuffer(r["m"], np.uint8).reshape(len(t), width - numeric),
                ))
            if parts:
                yield index, Part(*[np.concatenate(x) for x in zip(*parts)])

        packed = rows.select("time", "event", "w", *columns).mapInArrow(pack, "t binary, e binary, w binary, n binary, m binary")
        self.parts: RDD = hold(packed.rdd.mapPartitionsWithIndex(whole))
        ends = self.parts.map(lambda x: (float(x[1].time[0]), float(x[1].time[-1]))).collect()
        at = [t for first, last in ends for t in {first, last}]
        self.shared = np.array(sorted({t for t in at if at.count(t) > 1}))

    def release(self) -> None:
        self.parts.unpersist()

    def evaluate(self, beta: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> Value:
        shared = self.shared

        def totals(item: tuple[int, Part]) -> tuple:
            index, part = item
            inner, common = _stretches(part, shared)
            times = {}
            for own in common:
                s, at = _sums(own, beta, mean, scale)
                one = np.ones(1)
                _, dead, moments = _moments(own, at, beta, mean, scale, one, one)
                times[float(own.time[0])] = (s, moments, dead)
            first = float(inner.time[0]) if len(inner.time) else None
            s0, s1, events = 0.0, np.zeros(len(beta)), 0.0
            for _, some, z, r in inner.steps(beta, mean, scale):
                s0, s1, events = s0 + float(r.sum()), s1 + r @ z, events + float(some.weight[some.event == 1].sum())
            return index, first, s0, s1, events, times

        found = self.parts.map(totals).collect()
        # stretches of times in order: the inner times of a partition, and each shared time
        order: list[tuple] = [(first, "inner", index, s0, s1, d) for index, first, s0, s1, d, _ in found if first is not None]
        per_time: dict[float, list] = {}
        for *_, times in found:
            for t, value in times.items():
                per_time.setdefault(t, []).append(value)
        joined = {}
        for t, values in per_time.items():
            fields = [sum(getattr(s, f) for s, _, _ in values) for f in ("r0", "r1", "e0", "e1", "d", "ex")]
            joined[t] = PerTime(np.array([t]), *fields), sum(m for _, m, _ in values), sum(m for _, _, m in values)
            order.append((t, "shared", t, float(fields[0][0]), fields[1][0], float(fields[4][0])))
        order.sort(key=lambda x: x[0])
        p = len(beta)
        behind, ahead, later0, later1 = {}, {}, 0.0, np.zeros(p)
        for _, kind, key, s0, s1, _ in reversed(order):
            behind[kind, key] = later0, later1
            later0, later1 = later0 + s0, later1 + s1
        events = sum(x[5] for x in order)
        so_far = 0.0
        for _, kind, key, _, _, d in order:
            ahead[kind, key] = so_far
            so_far += d
        offsets = {key: (*behind["inner", key], ahead["inner", key]) for _, kind, key, *_ in order if kind == "inner"}

        def inside(item: tuple[int, Part]) -> Iterator[tuple[int, Piece]]:
            index, part = item
            if index not in offsets:
                return
            part, _ = _stretches(part, shared)
            s, at = _sums(part, beta, mean, scale)
            o0, o1, before = offsets[index]
            s0 = np.cumsum(s.r0[::-1])[::-1] + o0
            s1 = np.cumsum(s.r1[::-1], axis=0)[::-1] + o1
            moments = lambda own, dead: _moments(part, at, beta, mean, scale, own, dead)
            yield index, _piece(s, s0, s1, _ranks(s.d, before, events), beta, moments)

        pieces = {("inner", i): piece for i, piece in self.parts.flatMap(inside).collect()}
        for t, (s, moments, dead) in joined.items():
            o0, o1 = behind["shared", t]
            rank = _ranks(s.d, ahead["shared", t], events)
            by = lambda f, g, m=moments, e=dead: (m * f[0], e * g[0], m)
            pieces["shared", t] = _piece(s, s.r0 + o0, s.r1 + o1, rank, beta, by)
        second, factor, hazard = np.zeros((p, p)), 0.0, 0.0
        before, commons = {}, []
        for _, kind, key, *_ in order:
            piece = pieces[kind, key]
            second += piece.second + factor * piece.moments
            if kind == "inner":
                before[key] = hazard
            else:
                commons.append((key, piece.hazard, hazard))
            factor, hazard = factor + piece.factors, hazard + piece.hazard
        every = list(pieces.values())
        ranks = sum((x.ranks for x in every), np.zeros(2))
        centre = ranks[0] / events if events else 0.0
        residual = sum((x.residual for x in every), np.zeros(p))
        return Value(
            sum(x.likelihood for x in every), sum((x.gradient for x in every), np.zeros(p)), -second, events,
            float(ranks[1] - centre**2 * events), sum((x.turned for x in every), np.zeros(p)) - centre * residual,
            {k: behind["inner", k] for k in offsets}, before, commons,
        )

    def hazards(self, value: Value, beta: np.ndarray, mean: np.ndarray, scale: np.ndarray, spark) -> DataFrame:
        """Breslow increments at the covariate means, one row per distinct time: `time`, `hazard`, `cumulative_hazard`."""
        shared = self.shared

        def inside(item: tuple[int, Part]) -> Iterator[tuple[float, float, float]]:
            index, part = item
            if index not in value.behind:
                return
            s, _ = _sums(_stretches(part, shared)[0], beta, mean, scale)
            h = s.d / (np.cumsum(s.r0[::-1])[::-1] + value.behind[index][0])
            yield from zip(s.time.tolist(), h.tolist(), (np.cumsum(h) + value.before[index]).tolist())

        schema = "time double, hazard double, cumulative_hazard double"
        inner = spark.createDataFrame(self.parts.flatMap(inside), schema)
        return inner.union(spark.createDataFrame([(t, h, h + b) for t, h, b in value.shared], schema))


def _stretches(part: Part, shared: np.ndarray) -> tuple[Part, list[Part]]:
    """The rows of a partition's own times, and those of each time that it shares: its first, its last or both."""
    heads = part.heads()
    ends = np.r_[heads[1:], len(part.time)]
    common = np.isin(part.time[heads], shared)
    own = np.flatnonzero(~common)
    inner = part.rows(heads[own[0]], ends[own[-1]]) if len(own) else part.rows(0, 0)
    return inner, [part.rows(heads[i], ends[i]) for i in np.flatnonzero(common)]


def _ranks(d: np.ndarray, before: float, events: float) -> np.ndarray:
    """Mean ranks of tied events among all events, as shares of them."""
    return (before + np.cumsum(d) - d + (d + 1) / 2) / max(events, 1.0)
