"""Gradient-boosted trees for many targets at once, grown from summed histograms.

Features are binned once. A row carries its bins and what is left to explain of each target,
so a model for each of 96 horizons needs no copy of the rows for each horizon. One pass over
the rows serves one more layer of the current trees of all targets: every task sums residuals
by leaf, feature and bin; the sums of a leaf meet in one task, which finds its best split;
the driver gets one row a leaf. Trees grow by their best leaves first, as many in a pass as
the budget of leaves allows. Residuals are written every few rounds, so that a pass
evaluates only the trees since then.

A tree of 64 leaves takes some seven passes. With several trees in flight, each pass serves a
layer of each of them, and an eighth of their number starts anew with every pass: with eight
in flight, the passes are about as many as the rounds, with sixteen half as many. All trees
in flight work on the residuals of the finished ones, as in boosting with a step as many
times larger that is shared by them; keep ``flight * step`` below one.

What the driver and a pass hold depends on the settings (targets, leaves, features, bins),
never on the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.session import Shared, stage

# A fitted model is broadcast to score; beyond this size that is an error, not a slow job.
MOST_BYTES = 256 << 20


@dataclass(frozen=True)
class Boosting:
    """Trees a target, leaves a tree, step, bins a feature, share of features a tree sees, rows a leaf needs.

    Every ``stage_every`` rounds, residuals are written. ``flight`` is how many trees grow at
    once; with one, every tree sees the residuals of all before it.
    """

    rounds: int = 500
    leaves: int = 64
    step: float = 0.05
    bins: int = 64
    column_share: float = 0.8
    least_rows: int = 20
    least_gain: float = 1e-6
    seed: int = 42
    stage_every: int = 20
    flight: int = 1


@dataclass(frozen=True)
class Trees:
    """One round: a tree for each target as arrays (targets x nodes); node 0 is the root, a leaf has feature -1.

    Rows whose bin is at most ``cut`` go to node ``left``, others to ``left + 1``.
    """

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray

    @staticmethod
    def roots(targets: int, leaves: int) -> Trees:
        shape = (targets, 2 * leaves - 1)
        return Trees(np.full(shape, -1, np.int32), np.zeros(shape, np.int32), np.zeros(shape, np.int32), np.zeros(shape))

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row in every tree (rows x targets)."""
        rows, trees = np.arange(len(bins))[:, None], np.arange(len(self.feature))[None, :]
        at = np.zeros((len(bins), len(self.feature)), np.int64)
        while True:
            feature = self.feature[trees, at]
            inner = feature >= 0
            if not inner.any():
                return at
            right = bins[rows, np.maximum(feature, 0)] > self.cut[trees, at]
            at = np.where(inner, self.left[trees, at] + right, at)

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.take_along_axis(self.value, self.nodes(bins).T, axis=1).T


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted ensemble: feature names, bin borders, the mean of each target, and its rounds of trees."""

    features: tuple[str, ...]
    borders: tuple[np.ndarray, ...]
    base: np.ndarray
    rounds: tuple[Trees, ...]

    def inputs(self) -> Column:
        return F.array(*[F.col(c).cast("double") for c in self.features])

    def bins(self, x: np.ndarray) -> np.ndarray:
        return binned(x, self.borders)

    def predict_bins(self, bins: np.ndarray) -> np.ndarray:
        out = np.tile(self.base, (len(bins), 1))
        for trees in self.rounds:
            out += trees.predict(bins)
        return out

    def forecast(self, x: np.ndarray) -> np.ndarray:
        """Forecasts (rows x targets) from features (rows x features, NaN if missing)."""
        return self.predict_bins(self.bins(x))

    def changed(self, x: np.ndarray, known: np.ndarray, i: int, values: np.ndarray) -> np.ndarray:
        """The forecasts if feature ``i`` had other values; ``known`` are those of ``x``."""
        if not any((t.feature == i).any() for t in self.rounds):
            return known
        other = x.copy()
        other[:, i] = values
        return self.forecast(other)

    def shared(self, spark: SparkSession) -> Shared:
        size = sum(t.feature.nbytes * 3 + t.value.nbytes for t in self.rounds)
        if size > MOST_BYTES:
            raise ValueError(f"the ensemble has {size} bytes; more than {MOST_BYTES} are not broadcast")
        return Shared(spark, self)

    def predict(self, df: DataFrame, name: str = "forecasts") -> DataFrame:
        """``df`` with the array of forecasts for all targets, from one Arrow map; missing features are missing values."""
        for c in self.features:
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast("double"))
        shared = self.shared(df.sparkSession)

        @F.pandas_udf("array<double>")
        def apply(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            model = shared.value
            return pd.Series(list(model.predict_bins(model.bins(np.vstack(x.to_numpy()).astype(float)))))

        return df.withColumn(name, apply(self.inputs()))

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the model as one table: a row for the head, then one for each round."""
        plain = lambda a: [float(v) for v in np.asarray(a).reshape(-1)]
        rows = [(-1, list(self.features), [plain(b) for b in self.borders] + [plain(self.base)])]
        rows += [(i, [], [plain(a) for a in (t.feature, t.cut, t.left, t.value)]) for i, t in enumerate(self.rounds)]
        spark.createDataFrame(rows, "round int, features array<string>, numbers array<array<double>>").write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        head, *rounds = spark.read.parquet(path).orderBy("round").collect()  # one row a round
        base = np.array(head.numbers[-1])
        shaped = [[np.array(a).reshape(len(base), -1) for a in r.numbers] for r in rounds]
        trees = [Trees(*(a.astype(np.int32) for a in x[:3]), x[3]) for x in shaped]
        return BoostedTrees(tuple(head.features), tuple(np.array(b) for b in head.numbers[:-1]), base, tuple(trees))


def binned(x: np.ndarray, borders: Sequence[np.ndarray]) -> np.ndarray:
    """Bins of feature values (rows x features): 0 for a missing one, else one more than the borders below the value."""
    out = np.zeros(x.shape, np.uint8)
    for f, border in enumerate(borders):
        known = ~np.isnan(x[:, f])
        out[known, f] = 1 + np.searchsorted(border, x[known, f], side="left")
    return out


def bin_borders(rows: DataFrame, features: Sequence[str], bins: int) -> tuple[np.ndarray, ...]:
    """Borders between at most ``bins`` bins of known values, from two aggregates over all rows.

    A feature with no more different values than bins has one for each, others have
    approximate quantiles. A value equal to a border lies below it.
    """
    shares = [i / bins for i in range(1, bins)]
    known = [F.when(~F.isnan(c.cast("double")), c.cast("double")) for c in map(F.col, features)]
    wanted = [F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(known)]
    wanted += [F.percentile_approx(c, shares, 10_000).alias(f"q{i}") for i, c in enumerate(known)]
    found = rows.agg(*wanted).first().asDict()
    # The estimate bounds what the sets hold; a little above the bins, it may still be too high.
    few = [i for i in range(len(known)) if found[f"n{i}"] <= 1.2 * bins]
    if few:
        sets = rows.agg(*[F.collect_set(known[i]).alias(f"q{i}") for i in few]).first().asDict()
        found |= {k: v for k, v in sets.items() if len(v) <= bins}
    borders = [np.unique(np.array(found[f"q{i}"] or [], float)) for i in range(len(known))]
    return tuple(b if len(b) < bins else b[:-1] for b in borders)


def _best_splits(sums: np.ndarray, counts: np.ndarray, plan: Boosting) -> tuple[int, int, float, np.ndarray, np.ndarray]:
    """Best ``(feature, cut, gain)`` of a leaf's histograms (features x bins), and sums and rows on both sides.

    Gains are compared as 32-bit numbers, so that the order of addition does not decide
    between equal splits; then the first feature and the lowest cut win.
    """
    left, n_left = np.cumsum(sums, axis=1)[:, :-1], np.cumsum(counts, axis=1)[:, :-1]
    total, n = sums.sum(axis=1, keepdims=True), counts.sum(axis=1, keepdims=True)
    right, n_right = total - left, n - n_left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left**2 / n_left + right**2 / n_right - total**2 / n
    gain = np.where((n_left >= plan.least_rows) & (n_right >= plan.least_rows), gain, -1).astype(np.float32)
    feature, cut = np.unravel_index(np.argmax(gain), gain.shape)
    sides = np.array([left[feature, cut], right[feature, cut]]), np.array([n_left[feature, cut], n_right[feature, cut]])
    return int(feature), int(cut), float(gain[feature, cut]), *sides


class Growing:
    """Trees of one round while they grow: a tree for each target, what features it may use, and the leaves to look at next."""

    def __init__(self, targets: int, features: int, plan: Boosting, rng: np.random.Generator):
        self.plan, self.trees = plan, Trees.roots(targets, plan.leaves)
        seen = max(1, round(plan.column_share * features))
        self.allowed = np.zeros((targets, features), bool)
        for t in range(targets):
            self.allowed[t, rng.permutation(features)[:seen]] = True
        self.used, self.spare = np.ones(targets, int), np.full(targets, plan.leaves - 1)
        self.open = [np.zeros(1, int)] * targets
        self.best: list[dict[int, tuple]] = [{} for _ in range(targets)]  # leaves that wait, by their best split

    def done(self) -> bool:
        return not any(len(x) for x in self.open)

    def slots(self) -> np.ndarray:
        """Place among the open leaves of every node, -1 for all others (targets x nodes)."""
        out = np.full(self.trees.feature.shape, -1)
        for t, own in enumerate(self.open):
            out[t, own] = np.arange(len(own))
        return out

    def found(self, t: int, row) -> None:
        """The best split of an open leaf."""
        if row.gain > self.plan.least_gain:
            self.best[t][int(self.open[t][row.leaf])] = (row.gain, row.feature, row.cut, row.sums, row.counts)
        if self.used[t] == 1 and sum(row.counts):
            self.trees.value[t, 0] = self.plan.step * sum(row.sums) / sum(row.counts)

    def grow(self) -> None:
        """Split the best leaves that wait, as many as the budget allows; their children are looked at next."""
        trees = self.trees
        for t in range(len(self.open)):
            fresh = []
            for leaf in sorted(self.best[t], key=lambda x: (-self.best[t][x][0], x))[: self.spare[t]]:
                _, feature, cut, sums, counts = self.best[t].pop(leaf)
                child = self.used[t]
                trees.feature[t, leaf], trees.cut[t, leaf], trees.left[t, leaf] = feature, cut, child
                trees.value[t, child : child + 2] = [self.plan.step * s / n for s, n in zip(sums, counts)]
                fresh += [child, child + 1]
                self.used[t] += 2
                self.spare[t] -= 1
            self.open[t] = np.array(fresh if self.spare[t] else [], int)


def _histograms(state: DataFrame, recent: Sequence[Trees], growing: Sequence[Growing], width: int) -> DataFrame:
    """Rows ``(tree, leaf, sums, counts)``: a task's residuals and rows by feature and bin, for the open leaves of each tree.

    Trees are numbered through rounds, then targets.
    """
    targets, features = growing[0].allowed.shape
    most = max(len(x) for g in growing for x in g.open)
    size = features * width
    shared = Shared(state.sparkSession, (tuple(recent), [(g.trees, g.slots(), g.allowed) for g in growing]))

    def run(batches):
        recent, growing = shared.value
        sums = np.zeros((len(growing) * targets, most * size))
        counts = np.zeros(sums.shape, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, left = _arrays(batch, features, targets)
            for trees in recent:
                left = left - trees.predict(bins)
            place = np.arange(features)[None, :] * width + bins
            for i, (trees, slots, allowed) in enumerate(growing):
                slot = np.take_along_axis(slots, trees.nodes(bins).T, axis=1).T
                for t in range(targets):
                    rows, columns, k = np.flatnonzero(slot[:, t] >= 0), np.flatnonzero(allowed[t]), i * targets + t
                    at = ((slot[rows, t] * size)[:, None] + place[np.ix_(rows, columns)]).ravel()
                    sums[k] += np.bincount(at, np.repeat(left[rows, t], len(columns)), sums.shape[1])
                    counts[k] += np.bincount(at, minlength=sums.shape[1])
        kinds = [pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.int64())]
        for k in range(len(sums)):
            own = np.flatnonzero(counts[k].reshape(most, size).any(axis=1))
            if len(own):
                cells = [list(x[k].reshape(most, size)[own]) for x in (sums, counts)]
                columns = [pa.array(c, kind) for c, kind in zip([np.full(len(own), k), own, *cells], kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["tree", "leaf", "sums", "counts"])

    return state.select("bins", "left").mapInArrow(run, "tree int, leaf int, sums array<double>, counts array<long>")


def _arrays(batch: pa.RecordBatch, features: int, targets: int) -> tuple[np.ndarray, np.ndarray]:
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, features)
    return bins, batch.column("left").flatten().to_numpy(zero_copy_only=False).reshape(-1, targets)


def _splits(parts: DataFrame, features: int, plan: Boosting) -> list:
    """The best split of every leaf: parts of a leaf meet in one task, one after another."""

    def run(batches):
        held: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:
            for t, leaf, *cells in zip(*(batch.column(i) for i in range(4))):
                key, cells = (t.as_py(), leaf.as_py()), [c.values.to_numpy().reshape(features, -1) for c in cells]
                held[key] = [a + b for a, b in zip(held[key], cells)] if key in held else cells
        out = [(*key, *_best_splits(*cells, plan)) for key, cells in held.items()]
        if out:
            rows = [(t, s, f, c, g, list(a), list(map(int, n))) for t, s, f, c, g, a, n in out]
            kinds = [pa.int32()] * 4 + [pa.float64(), pa.list_(pa.float64()), pa.list_(pa.int64())]
            names = ["tree", "leaf", "feature", "cut", "gain", "sums", "counts"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    schema = "tree int, leaf int, feature int, cut int, gain double, sums array<double>, counts array<long>"
    return parts.repartition("tree", "leaf").mapInArrow(run, schema).collect()


def fit_boosted(
    train: DataFrame, features: Sequence[str], target: str = "targets", plan: Boosting = Boosting()
) -> BoostedTrees:
    """Least-squares boosting of all targets of ``train``.

    ``target`` is an array of known numbers of one length (a model for each) or one numeric
    column. Rows without a target (null) are left out; missing features (null, NaN) count
    as below all others. Without rows, the model is an error.
    """
    if not 2 <= plan.bins < 256 or plan.leaves < 2:
        raise ValueError("bins must be between 2 and 255, leaves at least 2")
    y = F.col(target) if train.schema[target].dataType.typeName() == "array" else F.array(target)
    y = y.cast("array<double>")
    rows = train.where(F.col(target).isNotNull())
    borders = bin_borders(rows, features, plan.bins)
    ends = rows.agg(F.min(F.size(y)), F.max(F.size(y)), F.count(F.lit(1))).first()
    if not ends[2] or ends[0] != ends[1]:
        raise ValueError("targets must be there and of one length")
    targets = ends[0]
    means = rows.agg(*[F.avg(F.get(y, F.lit(i))) for i in range(targets)]).first()
    model = BoostedTrees(tuple(features), borders, np.array(list(means), float), ())
    base = model.base

    def prepare(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1)
            left = batch.column("y").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) - base
            bins = [b.tobytes() for b in binned(x, borders)]
            yield pa.RecordBatch.from_arrays([pa.array(bins, pa.binary()), pa.array(list(left), pa.list_(pa.float64()))], ["bins", "left"])

    schema = "bins binary, left array<double>"
    state = stage(rows.select(model.inputs().alias("x"), y.alias("y")).mapInArrow(prepare, schema), "boosting")
    rng, started, growing, rounds, recent = np.random.default_rng(plan.seed), 0, [], [], []
    while started < plan.rounds or growing:
        fresh = min(plan.rounds - started, plan.flight - len(growing), -(-plan.flight // 8))
        growing += [Growing(targets, len(features), plan, rng) for _ in range(fresh)]
        started += fresh
        for r in _splits(_histograms(state, recent, growing, plan.bins + 1), len(features), plan):
            growing[r.tree // targets].found(r.tree % targets, r)
        for g in growing:
            g.grow()
        ended = [g.trees for g in growing if g.done()]
        growing = [g for g in growing if not g.done()]
        rounds += ended
        recent += ended
        if len(recent) >= plan.stage_every and (growing or started < plan.rounds):
            state, recent = stage(_less(state, recent, len(features), targets), "boosting"), []
    return replace(model, rounds=tuple(rounds))


def _less(state: DataFrame, recent: Sequence[Trees], features: int, targets: int) -> DataFrame:
    """Residuals after the recent rounds."""
    shared = Shared(state.sparkSession, tuple(recent))

    def run(batches):
        recent = shared.value
        for batch in batches:
            bins, left = _arrays(batch, features, targets)
            for trees in recent:
                left = left - trees.predict(bins)
            yield pa.RecordBatch.from_arrays([batch.column("bins"), pa.array(list(left), pa.list_(pa.float64()))], ["bins", "left"])

    return state.mapInArrow(run, state.schema)
