"""Adaptive hyper-parameter search (L4): tree-structured Parzen sampling over the trials that have finished.

The driver holds one small record a trial; what a trial costs (fits, scoring, metrics) are Spark jobs of its own.
Draws come from md5(trial:n:seed), so a search that sees the same losses chooses the same points again.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.operators import clean as CL
from featureflow.operators import ml as ML

START = 10         # trials at seeded random points, before any is chosen from what was seen
GAMMA = 0.1        # share of the finished trials that count as good
CANDIDATES = 24    # points drawn a trial from the good ones' density

# The dimensions of a boosted-tree search that Spark's learner has. Names of its parameters.
GBT_SPACE = {
    "maxIter": ("quniform", 10, 100, 1),
    "maxDepth": ("quniform", 2, 8, 1),
    "stepSize": ("loguniform", 0.02, 0.5),
    "maxBins": ("quniform", 32, 256, 1),
    "minInstancesPerNode": ("quniform", 1, 100, 1),
    "minInfoGain": ("loguniform", 1e-6, 0.1),
    "subsamplingRate": ("uniform", 0.5, 1.0),
    "featureSubsetStrategy": ("choice", ["all", "sqrt", "onethird"]),
}


@dataclass
class Trial:
    """One point, its loss, its metrics by split (split -> name -> value) and whether it was drawn adaptively."""
    trial: int
    params: dict[str, object]
    loss: float
    metrics: dict[str, dict[str, float]] = field(default_factory=dict)
    adaptive: bool = False


@dataclass
class Search:
    """Trials in the order they ran, the one of the smallest loss (ties: the earlier) and its model."""
    trials: list[Trial]
    best: Trial | None
    model: object = None

    def table(self, spark: SparkSession) -> DataFrame:
        """A row a trial, split and metric: (trial, adaptive, loss, best, split, metric, value)."""
        rows = [(t.trial, t.adaptive, t.loss, t is self.best, s, m, float(v))
                for t in self.trials for s, by in sorted(t.metrics.items()) for m, v in sorted(by.items())]
        return spark.createDataFrame(rows, "trial int, adaptive boolean, loss double, best boolean, split string, metric string, value double")


class Parzen:
    """Density of one numeric dimension on [0, 1]: a normal kernel, cut at the ends, on every seen value, as wide as
    the gap to its farther neighbour, and one wide kernel in the middle for what has not been seen."""

    def __init__(self, seen: Sequence[float]):
        points = sorted([*seen, 0.5])
        ends = [0.0, *points, 1.0]
        least = 1.0 / min(100, len(points) + 1)
        self.kernels = [(x, min(1.0, max(ends[i + 2] - x, x - ends[i], least))) for i, x in enumerate(points)]
        self.kernels[points.index(0.5)] = (0.5, 1.0)

    @staticmethod
    def _below(x: float, mid: float, width: float) -> float:
        return 0.5 * (1.0 + math.erf((x - mid) / (width * math.sqrt(2.0))))

    def draw(self, draws: ML.HashDraws) -> float:
        mid, width = draws.choice(self.kernels)
        lo, hi = self._below(0.0, mid, width), self._below(1.0, mid, width)
        want, a, b = draws.uniform(lo, hi), 0.0, 1.0
        for _ in range(40):  # the cut normal's quantile, by halving
            m = (a + b) / 2
            a, b = (m, b) if self._below(m, mid, width) < want else (a, m)
        return (a + b) / 2

    def log_density(self, x: float) -> float:
        total = 0.0
        for mid, width in self.kernels:
            mass = self._below(1.0, mid, width) - self._below(0.0, mid, width)
            total += math.exp(-0.5 * ((x - mid) / width) ** 2) / (width * mass * math.sqrt(2.0 * math.pi))
        return math.log(max(total / len(self.kernels), 1e-300))


class Shares:
    """Density of one categorical dimension: counts of the seen values, and one more for each."""

    def __init__(self, values: Sequence, seen: Sequence):
        self.weights = [(v, 1 + sum(1 for s in seen if s == v)) for v in values]
        self.total = sum(w for _, w in self.weights)

    def draw(self, draws: ML.HashDraws):
        at = draws.random() * self.total
        for v, w in self.weights:
            at -= w
            if at < 0:
                return v
        return self.weights[-1][0]

    def log_density(self, x) -> float:
        return math.log(next(w for v, w in self.weights if v == x) / self.total)


def _to_unit(spec: tuple, value) -> float:
    lo, hi = spec[1], spec[2]
    if spec[0] == "loguniform":
        lo, hi, value = math.log(lo), math.log(hi), math.log(value)
    return min(1.0, max(0.0, (value - lo) / (hi - lo))) if hi > lo else 0.5


def _from_unit(spec: tuple, u: float):
    kind, lo, hi = spec[0], spec[1], spec[2]
    if kind == "loguniform":
        return math.exp(math.log(lo) + u * (math.log(hi) - math.log(lo)))
    x = lo + u * (hi - lo)
    return int(round(x / spec[3]) * spec[3]) if kind == "quniform" else x


def propose(space: Mapping[str, tuple], done: Sequence[Trial], draws: ML.HashDraws, gamma: float = GAMMA,
            candidates: int = CANDIDATES) -> dict[str, object]:
    """The next point: of points drawn from the good trials' densities, dimension by dimension, the one that is likeliest
    under them against the other trials'."""
    ranked = sorted(done, key=lambda t: (t.loss, t.trial))
    n_good = max(1, math.ceil(gamma * len(ranked)))
    point = {}
    for name, spec in space.items():
        good, rest = ([t.params[name] for t in part] for part in (ranked[:n_good], ranked[n_good:]))
        if spec[0] == "choice":
            likely, other = Shares(spec[1], good), Shares(spec[1], rest)
            drawn = [likely.draw(draws) for _ in range(candidates)]
        else:
            likely, other = (Parzen([_to_unit(spec, v) for v in part]) for part in (good, rest))
            drawn = [likely.draw(draws) for _ in range(candidates)]
        best = max(drawn, key=lambda x: likely.log_density(x) - other.log_density(x))
        point[name] = best if spec[0] == "choice" else _from_unit(spec, best)
    return point


def adaptive_search(space: Mapping[str, tuple], n_trials: int, run: Callable[[dict], tuple], seed: int = 42,
                    start: int = START) -> Search:
    """L4: minimises the loss over ``space`` (as ``sample_space`` describes it). ``run(params)`` returns (loss, metrics
    by split, model); the first ``start`` points are those of ``random_search``, every later one is proposed from all
    trials before. A loss that is not a number counts as infinite. Only the best model so far is kept."""
    found = Search([], None)
    for i in range(n_trials):
        draws, adaptive = ML.HashDraws(i, seed), i >= start
        params = propose(space, found.trials, draws) if adaptive else ML.sample_space(space, draws)
        loss, by_split, model = run(params)
        t = Trial(i, params, math.inf if math.isnan(loss) else float(loss), by_split, adaptive)
        found.trials.append(t)
        if found.best is None or t.loss < found.best.loss:
            found.best, found.model = t, model
    return found


def split_metrics(model: PipelineModel, data: DataFrame, label: str = "label", split_col: str = "split") -> dict[str, dict[str, float]]:
    """Counts, accuracy, precision, recall and F1 of class 1 of every split, from one scoring of all rows."""
    hit = lambda y, p: F.sum(((F.col(label) == y) & (F.col("prediction") == p)).cast("long"))
    cells = model.transform(data).groupBy(F.col(split_col).alias("split")).agg(
        hit(1, 1).alias("tp"), hit(0, 1).alias("fp"), hit(1, 0).alias("fn"), hit(0, 0).alias("tn"))
    out = {}
    for r in cells.collect():  # a row a split
        n, named = r.tp + r.fp + r.fn + r.tn, 2 * r.tp + r.fp + r.fn
        out[r.split] = {"rows": n, "positives": r.tp + r.fn, "accuracy": (r.tp + r.tn) / n if n else 0.0,
                        "precision": r.tp / (r.tp + r.fp) if r.tp + r.fp else 0.0,
                        "recall": r.tp / (r.tp + r.fn) if r.tp + r.fn else 0.0, "f1": 2 * r.tp / named if named else 0.0}
    return out


def search_gbt(data: DataFrame, features: Sequence[str], space: Mapping[str, tuple] = GBT_SPACE, n_trials: int = 20,
               label: str = "label", seed: int = 42, start: int = START) -> Search:
    """Adaptive search of boosted trees: fitted on split train, stopped early and judged by F1 on validate, with the
    metrics of every split a trial."""
    train, val = CL.split_of(data, "train"), CL.split_of(data, "validate")

    def run(params):
        model = ML.train_gbt(train, val, features, label, params, seed)
        by = split_metrics(model, data, label)
        return -by.get("validate", {"f1": 0.0})["f1"], by, model
    return adaptive_search(space, n_trials, run, seed, start)
