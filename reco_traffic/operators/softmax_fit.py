"""Multinomial logistic regression for many targets at once, by L-BFGS.

Every target (camera) has a model of its own, and all of them are fitted
together: an evaluation is one Spark job that adds up loss and gradient per
target over all partitions, whatever the number of targets. Between jobs the
driver holds only the models and, per target, the last curvature pairs; each
target goes its own way through its line searches, and leaves when it has
converged. No target's rows ever come together in one task.

The objective is Spark ML's: mean log-loss over standardised features plus
reg / 2 * |weights|^2, intercepts free, started from the labels' frequencies.
Without regularisation weights and intercepts are centred over the classes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: Curvature pairs kept per target, and objective values compared for an end.
MEMORY = 10
#: Rows of one target that a stored block holds at most.
BLOCK_ROWS = 4096
SUFFICIENT = 1e-4


def blocks(rows: DataFrame, targets: Sequence[str], num_classes: int) -> DataFrame:
    """(t, n, y, x): rows of one target (by its place in ``targets``) as binary
    blocks, written once; labels are clamped to the classes."""
    spark = rows.sparkSession
    is_vector = rows.schema["features"].dataType.typeName() not in ("array",)
    x = vector_to_array("features") if is_vector else F.col("features").cast("array<double>")
    place = {t: k for k, t in enumerate(targets)}
    wanted = rows.where(F.col("target_id").isin(list(targets)) & F.col("label").isNotNull()).select(
        "target_id", F.col("label").cast("double").alias("y"), x.alias("x"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            t = np.array([place[v] for v in b.column("target_id").to_pylist()])
            y = np.clip(b.column("y").to_numpy(), 0, num_classes - 1).astype(np.int32)
            v = np.asarray(b.column("x").flatten()).reshape(b.num_rows, -1)
            for k in np.unique(t):
                mine = np.flatnonzero(t == k)
                for s in range(0, len(mine), BLOCK_ROWS):
                    m = mine[s : s + BLOCK_ROWS]
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([len(m)], pa.int32()), pa.array([y[m].tobytes()], pa.binary()),
                                                      pa.array([v[m].astype(float).tobytes()], pa.binary())], names=["t", "n", "y", "x"])

    path = scratch_path(spark, "softmax-blocks")
    wanted.mapInArrow(pack, "t int, n int, y binary, x binary").write.parquet(path)
    return spark.read.schema("t int, n int, y binary, x binary").parquet(path)


def _summed(table: DataFrame, of, size: int) -> dict[int, np.ndarray]:
    """Per target the sum of ``of(t, y, x)``, a vector of ``size``, over its
    blocks: one job, partial sums per task and target."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for t, n, y, x in zip(*(b.column(c).to_pylist() for c in ("t", "n", "y", "x"))):
                v = of(t, np.frombuffer(y, np.int32), np.frombuffer(x).reshape(n, -1))
                if v is not None:
                    total[t] = total[t] + v if t in total else v
        for t, v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(size, t, np.int32)), pa.array(np.arange(size, dtype=np.int32)), pa.array(v)], names=["t", "at", "v"])

    out: dict[int, np.ndarray] = {}
    for r in table.mapInArrow(add, "t int, at int, v double").groupBy("t", "at").agg(F.sum("v").alias("v")).collect():
        out.setdefault(r["t"], np.zeros(size))[r["at"]] = r["v"]
    return out


def loss_and_gradient(w: np.ndarray, y: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Summed log-loss and its gradient; w is (classes, features + 1), the last
    column the intercepts."""
    m = z @ w[:, :-1].T + w[:, -1]
    m -= m.max(1, keepdims=True)
    e = np.exp(m)
    total = e.sum(1)
    loss = (np.log(total) - m[np.arange(len(y)), y]).sum()
    p = e / total[:, None]
    p[np.arange(len(y)), y] -= 1
    return np.concatenate([[loss], np.concatenate([p.T @ z, p.sum(0)[:, None]], axis=1).ravel()])


class Search:
    """One target's L-BFGS: ``trial`` is the point to evaluate next, ``tell``
    takes its value and gradient, ``done`` says when it is over."""

    def __init__(self, start: np.ndarray, max_iter: int, tol: float):
        self.x, self.trial, self.done = start, start, max_iter <= 0
        self.max_iter, self.tol, self.iterations = max_iter, tol, 0
        self.f = self.g = None
        self.values: list[float] = []
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def direction(self) -> np.ndarray:
        q, used = self.g.copy(), []
        for s, y in reversed(self.pairs):
            a = (s @ q) / (s @ y)
            q -= a * y
            used.append(a)
        if self.pairs:
            s, y = self.pairs[-1]
            q *= (s @ y) / (y @ y)
        for (s, y), a in zip(self.pairs, reversed(used)):
            q += (a - (y @ q) / (s @ y)) * s
        return -q

    def _set_out(self) -> None:
        self.d = self.direction()
        self.slope = float(self.g @ self.d)
        if not np.isfinite(self.slope) or self.slope >= 0:
            self.pairs, self.d = [], -self.g
            self.slope = -float(self.g @ self.g)
        self.step = 1.0 if self.pairs else min(1.0, 1.0 / max(float(np.sqrt(self.g @ self.g)), 1e-300))
        self.trial = self.x + self.step * self.d

    def tell(self, f: float, g: np.ndarray) -> None:
        if self.f is None:
            self.f, self.g, self.values = f, g, [f]
        elif not np.isfinite(f) or f > self.f + SUFFICIENT * self.step * self.slope:
            fall = 2 * (f - self.f - self.step * self.slope)
            shorter = -self.slope * self.step ** 2 / fall if np.isfinite(fall) and fall > 0 else self.step / 10
            self.step = min(max(shorter, 0.1 * self.step), 0.5 * self.step)
            self.done = self.step < 1e-12
            self.trial = self.x + self.step * self.d
            return
        else:
            s, y = self.trial - self.x, g - self.g
            if s @ y > 1e-12 * (y @ y):
                self.pairs = [*self.pairs[-(MEMORY - 1) :], (s, y)]
            self.x, self.f, self.g = self.trial, f, g
            self.iterations += 1
            self.values = [*self.values[-MEMORY:], f]
        still = len(self.values) > MEMORY and max(self.values) - f <= self.tol * abs(f)
        flat = np.sqrt(self.g @ self.g) <= max(self.tol * abs(f), 1e-8)
        self.done = bool(self.iterations >= self.max_iter or still or flat)
        if not self.done:
            self._set_out()


def fit_all(rows: DataFrame, targets: Sequence[str], num_classes: int, max_iter: int, tol: float, reg: float = 0.0) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """{target: (weights, intercepts)} of the targets that have rows. ``rows``
    (target_id, label, features); features of one width."""
    table = blocks(rows, targets, num_classes)
    first = table.select((F.length("x") / 8 / F.col("n")).cast("int").alias("d")).first()
    if first is None:
        return {}
    d, k = first["d"], num_classes
    about = _summed(table, lambda t, y, x: np.concatenate([[len(y)], x.sum(0), (x * x).sum(0), np.bincount(y, minlength=k)]), 1 + 2 * d + k)
    mean, scale, count, search = {}, {}, {}, {}
    for t, v in about.items():
        n = v[0]
        mean[t] = v[1 : 1 + d] / n
        var = np.maximum(v[1 + d : 1 + 2 * d] - n * mean[t] ** 2, 0) / max(n - 1, 1)
        flat = var <= 1e-12 * (1 + mean[t] ** 2)
        scale[t], count[t] = np.where(flat, 0.0, 1 / np.sqrt(np.where(flat, 1, var))), n
        b = np.log1p(v[1 + 2 * d :])
        search[t] = Search(np.concatenate([np.zeros((k, d)), (b - b.mean())[:, None]], axis=1).ravel(), max_iter, tol)
    while open_ := {t: s.trial.reshape(k, d + 1) for t, s in search.items() if not s.done}:
        got = _summed(table.where(F.col("t").isin(list(open_))),
                      lambda t, y, x: loss_and_gradient(open_[t], y, (x - mean[t]) * scale[t]) if t in open_ else None, 1 + k * (d + 1))  # noqa: B023
        for t, w in open_.items():
            f, g = got[t][0] / count[t], got[t][1:] / count[t]
            if reg:
                free = w.copy()
                free[:, -1] = 0
                f, g = f + reg / 2 * float((free * free).sum()), g + reg * free.ravel()
            search[t].tell(f, g)
    out = {}
    for t, s in search.items():
        w = s.x.reshape(k, d + 1)
        weights = w[:, :-1] * scale[t]
        bias = w[:, -1] - weights @ mean[t]
        if not reg:
            weights = weights - weights.mean(0)
        out[targets[t]] = (weights, bias - bias.mean())
    return out
