"""Many perceptrons fitted on the same rows at once.

Spark's perceptron runs a job per step of its solver, for one model. Here one job takes a step of
several models: each task reads its rows once and adds up loss and slope of all of them. The objective (the
mean over blocks of each block's mean loss), the first weights and the solver's steps are those of
``MultilayerPerceptronClassifier`` with solver "l-bfgs".
"""

from __future__ import annotations

import math
import sys
from collections import defaultdict
from collections.abc import Generator, Iterable, Iterator, Sequence
from itertools import islice

import numpy as np
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this package

# Rows of a matrix; rows of a product of matrices, whose results then stay in a core's cache;
# partitions whose slopes the driver adds up itself; corrections and losses that the solver remembers.
PACKED_ROWS, STEP_ROWS, FEW_PARTITIONS, CORRECTIONS, LOSSES = 16_384, 512, 32, 10, 20


def fits_together(model: Estimator) -> bool:
    """Whether :func:`weights_of_all` can fit it."""
    return isinstance(model, MultilayerPerceptronClassifier) and model.getSolver() == "l-bfgs"


def scorer(model: MultilayerPerceptronClassifier, weights: np.ndarray, one: DataFrame) -> Model:
    """The fitted model that has these weights; ``one`` is a row to fit no step on."""
    return model.copy({model.initialWeights: Vectors.dense(weights), model.maxIter: 0}).fit(one)


def weights_of_all(
    models: Sequence[MultilayerPerceptronClassifier], df: DataFrame, one: DataFrame
) -> list[np.ndarray]:
    """What fitting each model on ``df`` gives, as the weights.

    Models that differ in ``maxIter`` only take the same steps, so the longest is fitted and the
    others' weights are noted on its way. ``df`` holds label and vector in the partitions that blocks
    are cut from, all models have the same inputs and classes; ``one`` is a row of it.
    """
    ways: dict[tuple, list[int]] = defaultdict(list)
    for j, m in enumerate(models):
        first = tuple(m.getInitialWeights()) if m.isSet(m.initialWeights) else m.getSeed()
        ways[tuple(m.getLayers()), first, m.getBlockSize(), m.getTol()].append(j)
    starts = {}
    for (layers, first, _, _), members in ways.items():
        if (layers, first) not in starts:
            m = models[members[0]]
            starts[layers, first] = m.copy({m.maxIter: 0}).fit(one).weights.toArray()

    if not models:
        return []
    packed = _packed(df, models[0]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes: dict[int, int] = defaultdict(int)
        for part, n in packed.map(lambda p: (p[0], len(p[3]))).collect():  # a pair for PACKED_ROWS
            sizes[part] += n
        walks, found = {}, {}
        for way, members in ways.items():
            walks[way] = _descend(starts[way[:2]], [models[j].getMaxIter() for j in members], way[3])
        asked = {way: next(walk) for way, walk in walks.items()}
        while asked:
            got = _evaluated(packed, sizes, [(layers, block, asked[way]) for way in asked for layers, _, block, _ in [way]])
            for way, at in zip(list(asked), got):
                try:
                    asked[way] = walks[way].send(at)
                except StopIteration as end:
                    del asked[way]
                    found.update({j: end.value[models[j].getMaxIter()] for j in ways[way]})
    finally:
        packed.unpersist()
    return [found[j] for j in range(len(models))]


def _packed(df: DataFrame, model: MultilayerPerceptronClassifier) -> RDD:
    """Rows of a partition as a few pairs of matrix and labels, with the partition and the place of their first row in it."""
    classes = model.getLayers()[-1]

    def pack(part: int, rows: Iterator[tuple]) -> Iterator[tuple]:
        place = 0
        while some := list(islice(rows, PACKED_ROWS)):
            y = np.array([r[0] for r in some])
            if not np.isin(y, np.arange(classes)).all():
                raise ValueError(f"labels must be whole numbers from 0 to {classes - 1}")
            yield part, place, np.array([r[1] for r in some]), y
            place += len(y)

    rows = df.select(F.col(model.getLabelCol()).cast("double"), vector_to_array(model.getFeaturesCol()))
    return rows.rdd.mapPartitionsWithIndex(pack)


def _evaluated(
    packed: RDD, sizes: dict[int, int], points: list[tuple[tuple, int, np.ndarray]]
) -> list[tuple[float, np.ndarray]]:
    """Loss and slope at each point (layers, block size, weights)."""
    shared = packed.context.broadcast(points)

    def run(packs: Iterator[tuple]) -> Iterator[tuple]:
        sums, part = _Sums(shared.value), None
        for part, place, x, y in packs:
            for low in range(0, len(y), STEP_ROWS):
                high = min(len(y), low + STEP_ROWS)
                sums.add(x[low:high], y[low:high], np.arange(place + low, place + high), sizes[part])
        if part is not None:
            yield from ((k, (part, float(loss), slope)) for k, (loss, slope) in enumerate(zip(sums.loss, sums.slopes)))

    def total(parts: Iterable[tuple]) -> tuple:
        _, loss, slopes = zip(*sorted(parts, key=lambda p: p[0]))  # in order, so that the sum is always the same
        return 0, math.fsum(loss), sum(slopes)

    sums = packed.mapPartitions(run)
    if len(sizes) > FEW_PARTITIONS:
        sums = sums.groupByKey(len(points)).mapValues(total)
    found = defaultdict(list)
    try:
        for k, parts in sums.collect():  # at most FEW_PARTITIONS per point
            found[k].append(parts)
    finally:
        shared.destroy()
    out = []
    for k, (_, block, _) in enumerate(points):
        blocks = sum(-(-n // block) for n in sizes.values())
        _, loss, slope = total(found[k])
        out.append((loss / blocks, slope / blocks))
    return out


def _split(weights: np.ndarray, layers: tuple) -> list[tuple[np.ndarray, np.ndarray]]:
    """Matrix and bias of each layer, as views."""
    parts, at = [], 0
    for a, b in zip(layers, layers[1:]):
        parts.append((weights[at:at + a * b].reshape(a, b), weights[at + a * b:at + a * b + b]))
        at += a * b + b
    return parts


class _Sums:
    """Loss and slope of several models, added up over rows."""

    def __init__(self, points: list[tuple[tuple, int, np.ndarray]]):
        self.points = points
        self.loss, self.slopes = np.zeros(len(points)), [np.zeros(len(w)) for _, _, w in points]
        self.layers = [_split(w, layers) for layers, _, w in points]
        self.into = [_split(s, p[0]) for s, p in zip(self.slopes, points)]
        # The first layers of all models are one product of matrices, there and back.
        self.matrix = np.hstack([p[0][0] for p in self.layers])
        self.bias = np.concatenate([p[0][1] for p in self.layers])
        ends = np.cumsum([p[0][1].size for p in self.layers])
        self.mine = [slice(end - p[0][1].size, end) for p, end in zip(self.layers, ends)]
        self.room = np.empty((2, STEP_ROWS, len(self.bias)))  # used again and again: new memory costs as much as the work

    def add(self, x: np.ndarray, y: np.ndarray, place: np.ndarray, size: int) -> None:
        """Some rows of a partition of ``size`` rows, a row counting by its block's size."""
        hidden, back = self.room[:, :len(y)]
        np.matmul(x, self.matrix, out=hidden)
        hidden += self.bias
        _sigmoid(hidden)
        z, inputs = np.empty((self.points[0][0][-1], len(y), len(self.points))), []
        for k, layers in enumerate(self.layers):
            inputs.append([x, hidden[:, self.mine[k]]])
            for matrix, bias in layers[1:-1]:
                inputs[k].append(_sigmoid(inputs[k][-1] @ matrix + bias))
            matrix, bias = layers[-1]
            z[:, :, k] = (inputs[k][-1] @ matrix + bias).T
        z -= z.max(axis=0)
        rows, label = np.arange(len(y)), y.astype(int)
        weight = np.stack([1.0 / np.minimum(block, size - place // block * block) for _, block, _ in self.points], axis=1)
        delta = np.exp(z)
        total = delta.sum(axis=0)
        self.loss += (weight * (np.log(total) - z[label, rows])).sum(axis=0)
        delta *= weight / total
        delta[label, rows] -= weight
        for k, layers in enumerate(self.layers):
            d = np.ascontiguousarray(delta[:, :, k].T)
            for i in range(len(layers) - 1, 0, -1):
                if i < len(layers) - 1:
                    d = d * inputs[k][i + 1] * (1.0 - inputs[k][i + 1])
                matrix, bias = self.into[k][i]
                matrix += inputs[k][i].T @ d
                bias += d.sum(axis=0)
                d = d @ layers[i][0].T
            back[:, self.mine[k]] = d
        back *= hidden
        back *= np.subtract(1.0, hidden, out=hidden)
        slope, bias = x.T @ back, back.sum(axis=0)
        for mine, layers in zip(self.mine, self.into):
            matrix, shift = layers[0]
            matrix += slope[:, mine]
            shift += bias[mine]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    """In the place of ``z``."""
    with np.errstate(over="ignore"):  # far below zero it is zero
        np.exp(np.negative(z, out=z), out=z)
    z += 1.0
    return np.reciprocal(z, out=z)


class _NoStep(Exception):
    """A line search found no step."""


Asked = Generator[np.ndarray, tuple[float, np.ndarray], object]


def _descend(x: np.ndarray, stops: Sequence[int], tol: float) -> Asked:
    """L-BFGS as a generator: gives points, is sent loss and slope there, returns the weights after each number of steps."""
    value, slope = yield x
    first, recent, memory, found, failed, step = value, [math.inf], [], {}, False, 0
    while True:
        if step in stops:
            found[step] = x
        flat = len(recent) > 1 and abs(value - max(recent)) <= tol * abs(first)
        if step >= max(stops) or flat or np.linalg.norm(slope) <= max(tol * value, 1e-8):
            break
        try:
            way = _direction(slope, memory)
            length = 1.0 / np.linalg.norm(way) if step == 0 else 1.0
            t, new, new_value, new_slope = yield from _line_search(x, value, slope, way, length)
            if t * np.linalg.norm(slope) < 1e-10:
                raise _NoStep
        except _NoStep:
            if failed:
                break
            failed, memory = True, []  # once more, along the slope
            continue
        memory = [(new - x, new_slope - slope), *memory][:CORRECTIONS]
        x, value, slope, step, failed = new, new_value, new_slope, step + 1, False
        recent = [*recent, value][-LOSSES:]
    return {n: found.get(n, x) for n in stops}


def _direction(slope: np.ndarray, memory: list) -> np.ndarray:
    """Minus the slope times what the last steps say of the inverse Hessian."""
    way, scale = slope.copy(), 1.0
    if memory:
        moved, turned = memory[0]
        scale = (moved @ turned) / (turned @ turned)
        if not scale >= 0:
            raise _NoStep
    shares = []
    for moved, turned in memory:
        shares.append((moved @ way) / (moved @ turned))
        if math.isnan(shares[-1]):
            raise _NoStep
        way -= shares[-1] * turned
    way *= scale
    for (moved, turned), share in zip(reversed(memory), reversed(shares)):
        way += (share - (turned @ way) / (moved @ turned)) * moved
    return -way


def _line_search(x: np.ndarray, value: float, slope: np.ndarray, way: np.ndarray, t: float) -> Asked:
    """A step along ``way`` that meets the strong Wolfe conditions: its length, point, loss and slope."""
    fall = float(slope @ way)
    if fall > 0:
        raise _NoStep

    def at(t: float) -> Asked:
        if math.isnan(t):
            raise _NoStep
        point = x + way * t
        v, g = yield point
        return t, v, float(g @ way), point, g

    low = (0.0, value, fall)
    for i in range(10):
        c = yield from at(t)
        if not math.isfinite(c[1]):
            t /= 2.0
            continue
        if c[1] > value + 1e-4 * t * fall or (c[1] >= low[1] and i > 0):
            sides = low, c
        elif abs(c[2]) <= 0.9 * abs(fall):
            return c[0], c[3], c[1], c[4]
        elif c[2] >= 0:
            sides = c, low
        else:
            low, t = c, t * 1.5
            continue
        break
    else:
        raise _NoStep
    low, high = sides
    for _ in range(10):
        c = yield from at(_between(high, low) if low[0] > high[0] else _between(low, high))
        if c[1] > value + 1e-4 * c[0] * fall or c[1] >= low[1]:
            high = c
            continue
        if abs(c[2]) <= 0.9 * abs(fall):
            return c[0], c[3], c[1], c[4]
        if c[2] * (high[0] - low[0]) >= 0:
            high = low
        low = c
    raise _NoStep


def _between(left: tuple, right: tuple) -> float:
    """Where the cubic through both ends, their losses and slopes, is least; not too near an end."""
    (a, va, da), (b, vb, db) = left[:3], right[:3]
    d1 = da + db - 3 * (va - vb) / (a - b)
    square = d1 * d1 - da * db
    if not square >= 0:
        return math.nan
    d2 = math.sqrt(square)
    bottom = db - da + 2 * d2
    if bottom == 0:
        return math.nan
    return min(max(b - (b - a) * (db + d2 - d1) / bottom, a + 0.1 * (b - a)), a + 0.9 * (b - a))
