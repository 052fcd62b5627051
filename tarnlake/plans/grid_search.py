"""Grid search for logistic regression in passes that all grid points and folds share.

Rows become blocks of sparse vectors once. A pass reads the blocks, and one matrix holds a trial point of every model
(grid point x fold), so its products with a block give the loss and gradient of all of them: each model leaves out
its fold's rows. Blocks' sums are added up in the map tasks, then per stripe of features, and a result of (features + 1) x
models numbers reaches the driver, which holds the models anyway. There a limited-memory quasi-Newton step per model, with
an orthant-wise proximal form where the penalty has an l1 part, proposes the next trial points; models that are done leave the matrix.
So the number of passes is that of the slowest model, not the sum over all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import unwrap_udt

#: Rows of a block, and those whose products are held at once; features of a stripe.
BLOCK_ROWS, AT_ONCE, STRIPE = 4096, 256, 1024
#: Bytes of trial points that a pass takes; more models go in several passes.
POINT_BYTES = 64 << 20
MEMORY = 10

_BLOCK = "n int, ends binary, features binary, data binary, label binary, fold binary"


def sparse_blocks(rows: DataFrame, features: str, label: str, fold: str) -> DataFrame:
    """Rows of (vector, label, fold) as blocks in compressed row form."""
    entries = rows.select(unwrap_udt(F.col(features)).alias("v"), F.col(label).cast("double").alias("label"), F.col(fold).cast("int").alias("fold"))
    # a dense vector has no indices
    entries = entries.select(F.coalesce("v.indices", F.sequence(F.lit(0), F.size("v.values") - 1)).alias("i"), F.col("v.values").alias("x"),
                             "label", "fold")

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(lo, BLOCK_ROWS)
                i, x = part.column(0), part.column(1)
                sizes = i.value_lengths().to_numpy().astype(np.int64)
                made = [np.cumsum(sizes), i.flatten().to_numpy().astype(np.int32), x.flatten().to_numpy(),
                        part.column(2).to_numpy(), part.column(3).to_numpy().astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array([part.num_rows], pa.int32()), *[pa.array([m.tobytes()], pa.binary()) for m in made]],
                                                 names=["n", "ends", "features", "data", "label", "fold"])

    return entries.mapInArrow(run, _BLOCK)


@dataclass
class Model:
    """One grid point on one fold's training rows, and the state of its minimisation."""

    l1: float
    l2: float
    left_out: int  # the fold whose rows it does not see; -1: none
    rows: int
    x: np.ndarray
    f: float = np.inf
    g: np.ndarray | None = None
    trial: np.ndarray | None = None
    step: float = 1.0
    direction: np.ndarray | None = None
    pairs: list = field(default_factory=list)
    done: bool = False
    rounds: int = 0

    def value(self, loss: float, x: np.ndarray) -> float:
        w = x[:-1]  # the last one is the intercept, which is not penalised
        return loss / self.rows + 0.5 * self.l2 * float(w @ w) + self.l1 * float(np.abs(w).sum())

    def smooth(self, gradient: np.ndarray, x: np.ndarray) -> np.ndarray:
        g = gradient / self.rows
        g[:-1] += self.l2 * x[:-1]
        return g

    def pseudo(self) -> np.ndarray:
        """The steepest one-sided gradient; with l1, zero where the penalty holds a weight at zero."""
        if not self.l1:
            return self.g
        out, w, g = self.g.copy(), self.x[:-1], self.g[:-1]
        zero = np.where(g + self.l1 < 0, g + self.l1, np.where(g - self.l1 > 0, g - self.l1, 0.0))
        out[:-1] = np.where(w == 0, zero, g + self.l1 * np.sign(w))
        return out

    def propose(self) -> None:
        """A quasi-Newton direction and its first trial point."""
        pseudo = self.pseudo()
        q, kept = pseudo.copy(), []
        for s, y, rho in reversed(self.pairs):
            a = rho * (s @ q)
            q -= a * y
            kept.append(a)
        if self.pairs:
            s, y, rho = self.pairs[-1]
            q *= 1 / (rho * (y @ y))
        for (s, y, rho), a in zip(self.pairs, reversed(kept)):
            q += s * (a - rho * (y @ q))
        d = -q
        if self.l1:
            d = np.where(d * pseudo < 0, d, 0.0)
        if d @ pseudo >= 0:
            self.pairs, d = [], -pseudo
        self.direction, self.step = d, 1.0 if self.pairs else min(1.0, 1.0 / max(np.abs(d).sum(), 1e-12))
        self.aim()

    def aim(self) -> None:
        x = self.x + self.step * self.direction
        if self.l1:  # a weight may reach zero, not cross it
            side = np.where(self.x != 0, np.sign(self.x), -np.sign(self.pseudo()))
            x[:-1] = np.where(x[:-1] * side[:-1] > 0, x[:-1], 0.0)
        self.trial = x

    def take(self, loss: float, gradient: np.ndarray, tolerance: float, max_rounds: int) -> None:
        """The loss and gradient at the trial point: step there, or shorten the step."""
        f, g = self.value(loss, self.trial), self.smooth(gradient, self.trial)
        if self.g is None:
            self.f, self.g = f, g
            self.propose()
            return
        moved = self.trial - self.x
        if f > self.f + 1e-4 * float(self.pseudo() @ moved):
            self.step /= 2
            if self.step < 1e-10:
                self.done = True
            self.aim()
            return
        y = g - self.g
        if moved @ y > 1e-12 * (y @ y):
            self.pairs = [*self.pairs, (moved, y, 1 / (moved @ y))][-MEMORY:]
        gain, self.f, self.x, self.g = self.f - f, f, self.trial, g
        self.rounds += 1
        self.done = gain <= tolerance * max(abs(f), 1e-3) or self.rounds >= max_rounds or not np.abs(self.pseudo()).max() > 1e-9
        if not self.done:
            self.propose()


def _pass(blocks: DataFrame, points: np.ndarray, left_out: np.ndarray, score: bool) -> tuple[np.ndarray, np.ndarray]:
    """Per model the loss over its rows and the gradient; or, to score, right guesses and rows of the fold left out."""
    spark = blocks.sparkSession
    width, n_models = points.shape
    shared = spark.sparkContext.broadcast(points)

    def run(batches):
        w = shared.value
        totals, gradient = np.zeros((2, n_models)), np.zeros((0 if score else width, n_models))
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                ends, feature, data, label, fold = (np.frombuffer(b, t) for b, t in zip(row[1:], (np.int64, np.int32, np.float64, np.float64, np.int32)))
                for lo in range(0, row[0], AT_ONCE):
                    hi = min(lo + AT_ONCE, row[0])
                    first = ends[lo - 1] if lo else 0
                    at = np.concatenate([[first], ends[lo:hi]]) - first
                    i, x = feature[first:ends[hi - 1]], data[first:ends[hi - 1]]
                    margin = np.zeros((hi - lo, n_models))
                    some = np.flatnonzero(np.diff(at))
                    if len(some):
                        margin[some] = np.add.reduceat(w[i] * x[:, None], at[:-1][some], axis=0)
                    margin += w[-1]
                    mine = fold[lo:hi, None] != left_out[None, :]
                    sign = (2 * label[lo:hi] - 1)[:, None]
                    if score:
                        totals[0] += (((margin > 0) == (sign > 0)) & ~mine).sum(axis=0)
                        totals[1] += (~mine).sum(axis=0)
                        continue
                    z = sign * margin
                    totals[0] += np.where(mine, np.logaddexp(0, -z), 0.0).sum(axis=0)
                    pull = np.where(mine, -sign / (1 + np.exp(np.clip(z, -700, 700))), 0.0)
                    gradient[-1] += pull.sum(axis=0)
                    if len(i):
                        order = np.argsort(i, kind="stable")
                        owner = np.repeat(np.arange(hi - lo), np.diff(at))[order]
                        j = i[order]
                        head = np.flatnonzero(np.concatenate([[True], j[1:] != j[:-1]]))
                        gradient[j[head]] += np.add.reduceat(pull[owner] * x[order][:, None], head, axis=0)
        stripes = [totals, *[gradient[a:a + STRIPE] for a in range(0, len(gradient), STRIPE)]]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(stripes) - 1), pa.int32()), pa.array([s.tobytes() for s in stripes], pa.binary())],
                                         names=["stripe", "sums"])

    def added(batches):
        at, total = None, None
        for batch in batches:
            for stripe, sums in zip(*[c.to_pylist() for c in batch.columns]):
                if stripe != at and at is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["stripe", "sums"])
                value = np.frombuffer(sums)
                at, total = stripe, value if stripe != at else total + value
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["stripe", "sums"])

    ddl = "stripe int, sums binary"
    # one range of stripes for each task, in order: a task adds up one stripe at a time
    parts = blocks.mapInArrow(run, ddl).repartition("stripe").sortWithinPartitions("stripe").mapInArrow(added, ddl)
    try:
        found = {r.stripe: np.frombuffer(r.sums).reshape(-1, n_models) for r in parts.collect()}
    finally:
        shared.unpersist()
    totals = found.pop(-1, np.zeros((2, n_models)))
    gradient = np.concatenate([found[k] for k in sorted(found)]) if found else np.zeros((width, n_models))
    return totals, gradient


def _groups(models: Sequence[Model], width: int) -> list[list[Model]]:
    most = max(1, POINT_BYTES // (8 * width))
    return [list(models[i:i + most]) for i in range(0, len(models), most)]


def grid_scores(blocks: DataFrame, width: int, grid: Sequence[tuple[float, str]], fold_rows: Sequence[int], *, tolerance: float,
                max_iter: int) -> tuple[list[float], list[np.ndarray]]:
    """Mean accuracy over the folds of each (regularisation, penalty), and the models' weights (intercept last).

    ``fold_rows`` has the rows of each fold. The loss is the mean over a model's rows plus the penalty, so weights and
    scores are those of one fit for each grid point and fold.
    """
    n = sum(fold_rows)
    models = [Model(reg if penalty == "l1" else 0.0, reg if penalty == "l2" else 0.0, k, n - fold_rows[k], np.zeros(width + 1))
              for reg, penalty in grid for k in range(len(fold_rows))]
    for m in models:
        m.trial, m.done = m.x, m.rows == 0
    while any(not m.done for m in models):
        for some in _groups([m for m in models if not m.done], width + 1):
            totals, gradient = _pass(blocks, np.stack([m.trial for m in some], axis=1), np.array([m.left_out for m in some]), False)
            for k, m in enumerate(some):
                m.take(float(totals[0, k]), gradient[:, k].copy(), tolerance, max_iter)
    hits = []
    for some in _groups(models, width + 1):
        totals, _ = _pass(blocks, np.stack([m.x for m in some], axis=1), np.array([m.left_out for m in some]), True)
        hits += [totals[0, k] / totals[1, k] if totals[1, k] else np.nan for k in range(len(some))]
    folds = len(fold_rows)
    return [float(np.nanmean(hits[i * folds:(i + 1) * folds])) for i in range(len(grid))], [m.x for m in models]
