"""Linear models and SVMs of all folds at once, by Newton steps on aggregated passes.

Training sets of folds are nested prefixes, so rows carry one block number and
a model says before which block its rows end. One pass over the rows gives the
loss, gradient and curvature of every model that is not finished yet; equal rows
come as one with their number, so a pass costs what the distinct rows cost. A task
sends one small array per model, arrays are added up per model in a second
stage, and the driver solves one small system per model. Steps that do not lower
the objective are halved.

Binary losses are functions of the margin: logistic, or the hinge with log
barriers on a row's slack and on its constraint, whose weight is halved as the
search goes on. The slack has a closed form, so a row needs no state. When a
Newton step is short (below the barrier's weight in its own norm), the slopes at
its end are a point of the dual problem, and primal minus dual value bounds the
distance from the optimum of the hinge itself: an SVM is done when that gap is
small enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_PASSES = 200
FIRST_BARRIER = 1.0
SHRINK = 0.5
#: The barrier's weight falls when the step's squared norm is below this many times the weight.
NEAR = 25.0


class Design(NamedTuple):
    """Which columns a model sees, plain or as kernel features of a few landmark rows."""

    columns: tuple[int, ...]
    landmarks: np.ndarray | None = None
    whiten: np.ndarray | None = None
    gamma: float = 0.0

    def apply(self, x: np.ndarray) -> np.ndarray:
        """One row of features per row of x, a constant last."""
        mine = x[:, list(self.columns)]
        if self.landmarks is not None:
            mine = rbf(mine, self.landmarks, self.gamma) @ self.whiten
        return np.hstack([mine, np.ones((len(x), 1))])


def rbf(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2.0 * x @ y.T
    return np.exp(-gamma * np.maximum(square, 0.0))


def nystroem(columns: tuple[int, ...], landmarks: np.ndarray, gamma: float) -> Design:
    """Features whose inner products are the kernel's, as far as the landmarks span it (Williams and Seeger, 2001)."""
    values, vectors = np.linalg.eigh(rbf(landmarks, landmarks, gamma))
    kept = values > 1e-8 * max(values.max(), 1e-300)
    return Design(columns, landmarks, vectors[:, kept] / np.sqrt(values[kept]), gamma)


@dataclass
class Binary:
    """One two-class model: rows before a block with one of two labels; the first label is the positive one."""

    design: Design
    before: int
    sides: tuple[float, float]
    c: float
    hinge: bool
    shift: np.ndarray | None = None
    scale: np.ndarray | None = None
    point: np.ndarray | None = None
    rows: int = 0
    passes: int = 0
    #: what is left: norm of the gradient, or the duality gap relative to the objective
    residual: float = float("inf")
    converged: bool = False
    barrier: float = FIRST_BARRIER

    def transform(self, size: int) -> np.ndarray:
        """Matrix from a row's features to the standardised ones, constant included."""
        t = np.eye(size)
        if self.scale is not None:
            t[:-1, :-1] = np.diag(1.0 / self.scale)
            t[:-1, -1] = -self.shift / self.scale
        return t


@dataclass
class Multinomial:
    """Softmax regression over classes, one coefficient vector each."""

    design: Design
    before: int
    classes: np.ndarray
    c: float
    point: np.ndarray | None = None
    rows: int = 0
    passes: int = 0
    residual: float = float("inf")
    converged: bool = False


def barrier_slope(short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slope a in (0, 1) with 1 / (1 - a) - 1 / a = short, and 1 - a; neither loses digits at its end."""
    root = np.sqrt(short * short + 4.0)
    far = root + np.abs(short)
    small = 2.0 / (2.0 + far)
    large = far / (2.0 + far)
    return np.where(short < 0, small, large), np.where(short < 0, large, small)


def _binary_sums(model: Binary, point: np.ndarray, z: np.ndarray, block: np.ndarray, label: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """rows, loss with barriers, loss, slopes, and per feature: slopes, bends, pull towards a smaller barrier; then the curvature."""
    mine = (block < model.before) & ((label == model.sides[0]) | (label == model.sides[1]))
    z, sign, copies = z[mine], np.where(label[mine] == model.sides[0], 1.0, -1.0), copies[mine]
    margin = sign * (z @ point)
    if model.hinge:
        short = 1.0 - margin
        loss = np.maximum(short, 0.0)
        slope, rest = barrier_slope(short / model.barrier)
        smooth = model.barrier * (1.0 / rest + np.log(rest) + np.log(slope))
        bend = 1.0 / (model.barrier * (1.0 / rest**2 + 1.0 / slope**2))
        pull = bend * (1.0 / slope - 1.0 / rest)
    else:
        smooth = loss = np.logaddexp(0.0, -margin)
        slope = np.exp(-np.logaddexp(0.0, margin))
        bend = slope * (1.0 - slope)
        pull = np.zeros(len(z))
    slope, bend, pull = copies * slope, copies * bend, copies * pull
    signed = z * sign[:, None]
    curvature = (z * bend[:, None]).T @ z
    return np.concatenate([[copies.sum(), copies @ smooth, copies @ loss, slope.sum()], slope @ signed, bend @ signed, pull @ signed, curvature.ravel()])


def _multinomial_sums(model: Multinomial, point: np.ndarray, z: np.ndarray, block: np.ndarray, label: np.ndarray, copies: np.ndarray) -> np.ndarray:
    mine = (block < model.before) & np.isin(label, model.classes)
    z, label, copies = z[mine], label[mine], copies[mine]
    k, d = len(model.classes), z.shape[1]
    which = np.searchsorted(model.classes, label)
    score = z @ point.reshape(k, d).T
    score -= score.max(axis=1, keepdims=True)
    share = np.exp(score)
    total = share.sum(axis=1, keepdims=True)
    share /= total
    loss = copies @ (np.log(total[:, 0]) - score[np.arange(len(z)), which])
    miss = share.copy()
    miss[np.arange(len(z)), which] -= 1.0
    miss *= copies[:, None]
    wide = (share[:, :, None] * z[:, None, :]).reshape(len(z), k * d)
    curvature = -((wide * copies[:, None]).T @ wide)
    share *= copies[:, None]
    for j in range(k):
        curvature[j * d : (j + 1) * d, j * d : (j + 1) * d] += (z * share[:, j : j + 1]).T @ z
    return np.concatenate([[copies.sum(), loss], (miss.T @ z).ravel(), curvature.ravel()])


def one_pass(rows: DataFrame, features: list[str], models: dict[int, Binary | Multinomial], points: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Sums of every model at its point. rows: block, label, features, and copies where a row stands for several."""
    if "copies" not in rows.columns:
        rows = rows.withColumn("copies", F.lit(1))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x = np.stack([np.asarray(batch.column(f), np.float64) for f in features], axis=1)
            block, label, copies = (np.asarray(batch.column(c)) for c in ("block", "label", "copies"))
            copies = copies.astype(np.float64)
            designs: dict[int, np.ndarray] = {}
            for i, model in models.items():
                z = designs.setdefault(id(model.design), None)
                if z is None:
                    z = designs[id(model.design)] = model.design.apply(x)
                found = (_binary_sums if isinstance(model, Binary) else _multinomial_sums)(model, points[i], z, block, label, copies)
                sums[i] = sums[i] + found if i in sums else found
        task = TaskContext.get().partitionId()
        n = len(sums)
        blobs = [s.tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([task] * n, pa.int32()), pa.array(blobs, pa.binary())], ["model", "task", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, blob in zip(batch.column("model").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                part = np.frombuffer(blob)
                sums[i] = sums[i] + part if i in sums else part
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["model", "sums"])

    parts = rows.select("block", "label", "copies", *features).mapInArrow(work, "model int, task int, sums binary")
    # in the same order on every run, so that rounding is the same too
    whole = parts.repartition("model").sortWithinPartitions("model", "task").mapInArrow(add, "model int, sums binary")
    return {row["model"]: np.frombuffer(row["sums"]) for row in whole.collect()}


@dataclass
class _Walk:
    """Where a model's search stands: coefficients in its standardised scale."""

    at: np.ndarray
    step: np.ndarray
    length: float = 1.0
    value: float = float("inf")
    slope: float = 0.0
    transform: np.ndarray = field(default_factory=lambda: np.eye(1))

    @property
    def trial(self) -> np.ndarray:
        return self.at + self.length * self.step


def _penalty(size: int, blocks: int = 1) -> np.ndarray:
    """1 for coefficients, 0 for constants."""
    one = np.ones(size)
    one[-1] = 0.0
    return np.tile(one, blocks)


def solve(rows: DataFrame, features: list[str], models: list[Binary | Multinomial], tolerance: float, gap: float, max_passes: int = MAX_PASSES) -> None:
    """Fits all models in place. ``tolerance`` bounds the gradient per row, ``gap`` the relative duality gap of SVMs."""
    walks: dict[int, _Walk] = {}
    for i, m in enumerate(models):
        size = len(m.design.columns) + 1 if m.design.whiten is None else m.design.whiten.shape[1] + 1
        count = len(m.classes) if isinstance(m, Multinomial) else 1
        walks[i] = _Walk(np.zeros(size * count), np.zeros(size * count))
        walks[i].transform = m.transform(size) if isinstance(m, Binary) else np.eye(size * count)
    pending = dict(enumerate(models))
    for _ in range(max_passes):
        if not pending:
            break
        points = {i: walks[i].transform.T @ walks[i].trial for i in pending}
        for i, sums in one_pass(rows, features, pending, points).items():
            m, walk = pending[i], walks[i]
            m.passes += 1
            m.rows = int(sums[0])
            done = _advance_binary(m, walk, sums, tolerance, gap) if isinstance(m, Binary) else _advance(m, walk, sums, tolerance)
            if done:
                m.converged = m.residual <= (gap if isinstance(m, Binary) and m.hinge else tolerance)
                m.point = walk.transform.T @ walk.at
                del pending[i]
    for i, m in pending.items():
        m.point = walks[i].transform.T @ walks[i].at


def _accepts(walk: _Walk, value: float) -> bool:
    """Takes the trial point if it lowers the objective enough, else halves the step."""
    if value <= walk.value + 1e-4 * walk.length * walk.slope + 1e-12 * abs(value):
        walk.at, walk.value, walk.length = walk.trial, value, 1.0
        return True
    walk.length /= 2.0
    return False


def _direct(walk: _Walk, gradient: np.ndarray, curvature: np.ndarray) -> None:
    walk.step = -np.linalg.solve(curvature, gradient)
    walk.slope = float(gradient @ walk.step)


def _advance(m: Multinomial, walk: _Walk, sums: np.ndarray, tolerance: float) -> bool:
    size = len(walk.at)
    penalty = _penalty(size // len(m.classes), len(m.classes))
    trial = walk.trial
    if not _accepts(walk, 0.5 * penalty @ trial**2 + m.c * sums[1]):
        return walk.length < 1e-9
    gradient = penalty * walk.at + m.c * sums[2 : 2 + size]
    m.residual = float(np.abs(gradient).max()) / max(m.c * m.rows, 1.0)
    # constants can move together without an effect, so the system needs a little weight on them
    _direct(walk, gradient, m.c * sums[2 + size :].reshape(size, size) + np.diag(np.where(penalty > 0, penalty, 1e-6)))
    return m.residual <= tolerance


def _advance_binary(m: Binary, walk: _Walk, sums: np.ndarray, tolerance: float, gap: float) -> bool:
    size, t = len(walk.at), walk.transform
    penalty = _penalty(size)
    trial = walk.trial
    if not _accepts(walk, 0.5 * penalty @ trial**2 + m.c * sums[1]):
        return walk.length < 1e-9
    slopes, bends, pull = (m.c * t @ part for part in sums[4 : 4 + 3 * size].reshape(3, size))
    gradient = penalty * walk.at - slopes
    curvature = m.c * t @ sums[4 + 3 * size :].reshape(size, size) @ t.T + np.diag(np.where(penalty > 0, penalty, 1e-9))
    _direct(walk, gradient, curvature)
    if not m.hinge:
        m.residual = float(np.abs(gradient).max()) / max(m.c * m.rows, 1.0)
        return m.residual <= tolerance
    primal = 0.5 * penalty @ walk.at**2 + m.c * sums[2]
    dual = m.c * sums[3] - bends @ walk.step - 0.5 * penalty @ (walk.at + walk.step) ** 2
    short = -walk.slope <= m.c * m.barrier
    near_enough = 0 <= primal - dual <= gap * max(primal, 1e-12)
    if short:
        m.residual = float(primal - dual) / max(float(primal), 1e-12)
    if short and near_enough:
        return True
    if -walk.slope <= NEAR * m.c * m.barrier and not near_enough:
        smaller = m.barrier * SHRINK
        _direct(walk, gradient - (smaller - m.barrier) * pull, curvature)
        m.barrier, walk.value = smaller, float("inf")
    return m.barrier < 1e-13


def pairs(design: Design, before: int, classes: list[float], c: float) -> list[Binary]:
    """One SVM per two classes."""
    return [Binary(design, before, sides, c, hinge=True) for sides in combinations(classes, 2)]


class Signs(NamedTuple):
    """Two classes by the sign of the margin."""

    model: Binary

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.where(self.model.design.apply(x) @ self.model.point > 0, *self.model.sides)


class Softmax(NamedTuple):
    model: Multinomial

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = self.model.design.apply(x)
        return self.model.classes[(z @ self.model.point.reshape(len(self.model.classes), -1).T).argmax(axis=1)]


class Votes(NamedTuple):
    """One against one: the class that wins most pairs, of equal ones the smallest."""

    models: list[Binary]
    classes: list[float]

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not self.models:
            return np.full(len(x), self.classes[0])
        z = self.models[0].design.apply(x)
        order = {c: k for k, c in enumerate(self.classes)}
        votes = np.zeros((len(x), len(self.classes)))
        for m in self.models:
            won = z @ m.point > 0
            votes[:, order[m.sides[0]]] += won
            votes[:, order[m.sides[1]]] += ~won
        return np.array(self.classes)[votes.argmax(axis=1)]
