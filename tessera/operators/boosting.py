"""Boosting on distinct rows: what :func:`tessera.operators.model.fit` learns, without keeping a row for each pair.

A tree sees no more of a row than its label and the bins of its features. Rows that agree on them are one row with their
number ``n``; each of the n is drawn for a tree or not by hash, so draws are the same on any cluster. Trees, as there:
logistic loss, the first on labels -1 and 1 and the others on its gradients, splits by variance.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS, BITS = 32, 5
#: Features whose bins share a long.
PACK = 12
#: Rows whose draws are made at once.
DRAWS = 1 << 20


@dataclass(frozen=True)
class Boosting:
    rounds: int = 20
    depth: int = 5
    step: float = 0.06
    least: int = 20
    rows: float = 0.9
    features: float = 0.9
    seed: int = 42


def value(f: str) -> Column:
    return F.coalesce(F.col(f).cast("double"), F.lit(-1.0))


def splits(rows: DataFrame, features: list[str]) -> dict[str, list[float]]:
    """At most 31 limits between a feature's values: all, if they are few, or those nearest to equal shares of the rows, ``n`` of each."""
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), value(f).alias("v")) for k, f in enumerate(features))))
    counts = rows.select("n", each.alias("x")).groupBy("x.k", "x.v").agg(F.sum("n").alias("n"))
    own, row = W.partitionBy("k"), W.partitionBy("k").orderBy("v")
    placed = counts.withColumns({"to": F.sum("n").over(row), "next": F.lead("v").over(row), "more": F.lead("n").over(row), "share": F.sum("n").over(own) / BINS, "values": F.count("*").over(own)})
    # A limit after a value is the nearest to all shares from the middle of its rows to the middle of the next one's.
    first = F.ceil((F.col("to") - F.col("n") / 2) / F.col("share"))
    near = (first < (F.col("to") + F.col("more") / 2) / F.col("share")) & (first < BINS)
    limits = placed.where(F.col("next").isNotNull() & ((F.col("values") <= BINS) | near)).select("k", ((F.col("v") + F.col("next")) / 2).alias("at"))
    out: dict[str, list[float]] = {f: [] for f in features}
    for r in limits.collect():
        out[features[r.k]].append(r.at)
    return {f: sorted(set(x)) for f, x in out.items()}


def packed(features: list[str], limits: dict[str, list[float]]) -> list[Column]:
    """The bins of features, :data:`PACK` of them in a long."""

    def one(some: list[str]) -> Column:
        cuts = [np.array(limits[f], float) for f in some]

        @F.arrow_udf(T.LongType())
        def bins(*columns: pa.Array) -> pa.Array:
            out = np.zeros(len(columns[0]), np.int64)
            for k, (x, at) in enumerate(zip(columns, cuts, strict=True)):
                out |= np.searchsorted(at, x.to_numpy(zero_copy_only=False), side="left").astype(np.int64) << BITS * k
            return pa.array(out)

        return bins(*map(value, some))

    return [one(features[k : k + PACK]) for k in range(0, len(features), PACK)]


def unpacked(codes: list[np.ndarray], sizes: list[int]) -> np.ndarray:
    """Bins, a row for each feature, from columns of :func:`packed` of so many features each."""
    return np.array([(c >> BITS * k & BINS - 1).astype(np.uint8) for c, n in zip(codes, sizes, strict=True) for k in range(n)])


@dataclass
class Tree:
    """Nodes by number; an inner node's rows with a bin up to ``cut`` go to ``left``, the others to the node after it."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, values: tuple[float, float]) -> list[int]:
        self.feature[node], self.cut[node], self.left[node] = feature, cut, len(self.feature)
        for v in values:
            for at, x in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.value, v)):
                at.append(x)
        return [len(self.feature) - 2, len(self.feature) - 1]

    def leaves(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """The node that each row of bins ends in."""
        feature, cut, left = map(np.array, (self.feature, self.cut, self.left))
        node, every = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
        for _ in range(depth):
            inner = feature[node] >= 0
            right = bins[np.maximum(feature[node], 0), every] > cut[node]
            node = np.where(inner, left[node] + right, node)
        return node


def mixed(x: np.ndarray) -> np.ndarray:
    """Well mixed bits of numbers (the last steps of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(key: np.ndarray, n: np.ndarray, share: float) -> np.ndarray:
    """How many of the n rows of each key are drawn, each by its own number."""
    # Keys with many rows come in pieces, so that no step holds more than DRAWS rows and a piece.
    pieces = -(-n // DRAWS)
    of = np.repeat(np.arange(len(n)), pieces)
    first = (np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * DRAWS
    size = np.minimum(DRAWS, n[of] - first)
    ends = np.cumsum(size)
    limit, out, at = np.uint64(int(share * 2**64)) if share < 1 else None, np.zeros(len(n), np.int64), 0
    if limit is None:
        return n.copy()
    while at < len(of):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] - size[at] + DRAWS, side="right")))
        start = ends[at:to] - size[at:to] - (ends[at] - size[at])
        number = np.arange(int(size[at:to].sum())) - np.repeat(start - first[at:to], size[at:to])
        taken = mixed(np.repeat(key[of[at:to]], size[at:to]) + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) < limit
        np.add.at(out, of[at:to], np.add.reduceat(taken, start, dtype=np.int64))
        at = to
    return out


def target(label: np.ndarray, bins: np.ndarray, trees: list[Tree], cfg: Boosting) -> np.ndarray:
    """What the next tree learns: labels -1 and 1, then the gradients of the logistic loss."""
    y = 2.0 * label - 1
    if not trees:
        return y
    score = sum((1.0 if k == 0 else cfg.step) * np.array(t.value)[t.leaves(bins, cfg.depth)] for k, t in enumerate(trees))
    return 4 * y / (1 + np.exp(2 * y * score))


def histograms(rows: DataFrame, codes: list[str], sizes: list[int], trees: list[Tree], tree: Tree, active: list[int], cfg: Boosting) -> np.ndarray:
    """Number, sum and sum of squares of the target, of the rows drawn for ``tree`` in each active node, by feature and bin."""
    shape = (3, sum(sizes), len(active), BINS)

    def count(batches):
        total = np.zeros(shape)
        slot = np.full(len(tree.feature), -1)
        slot[active] = np.arange(len(active))
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in (*codes, "label", "n")]
            bins, label, n = unpacked(columns[: len(codes)], sizes), columns[-2], columns[-1]
            node = slot[tree.leaves(bins, cfg.depth)]
            key = np.full(len(n), (cfg.seed << 20) + len(trees), np.uint64)
            for c in columns[:-1]:
                key = mixed(key + c.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
            here = np.flatnonzero(node >= 0)
            bins, node = bins[:, here], node[here]
            k = drawn(key[here], n[here], cfg.rows).astype(float)
            y = target(label[here], bins, trees, cfg)
            for f in range(len(bins)):
                cell = node * BINS + bins[f]
                for s, w in enumerate((k, k * y, k * y * y)):
                    total[s, f] += np.bincount(cell, w, len(active) * BINS).reshape(len(active), BINS)
        yield pa.RecordBatch.from_pydict({"x": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros(shape)
    for r in rows.select(*codes, "label", "n").mapInArrow(count, "x binary").toLocalIterator():
        out += np.frombuffer(r.x).reshape(shape)
    return out


def best_split(stats: np.ndarray, features: np.ndarray, cfg: Boosting) -> tuple[float, int, int, tuple[float, float]] | None:
    """(gain by rows, feature, cut, values) of the split of a node (number, sum, squares by feature and bin) that lowers the variance most."""
    number, total, square = stats[:, 0].sum(axis=1)
    low = stats.cumsum(axis=2)[:, :, :-1]
    high = stats.sum(axis=2)[:, :, None] - low
    with np.errstate(invalid="ignore", divide="ignore"):
        gain = low[1] ** 2 / low[0] + high[1] ** 2 / high[0] - total**2 / number
    allowed = (low[0] >= cfg.least) & (high[0] >= cfg.least)
    allowed[np.setdiff1d(np.arange(len(gain)), features)] = False
    gain = np.where(allowed, gain, -np.inf)
    f, cut = divmod(int(gain.argmax()), gain.shape[1])
    # What rounding leaves of no gain is none.
    if not gain[f, cut] > 1e-12 * max(1.0, square):
        return None
    return float(gain[f, cut]), f, cut, (low[1, f, cut] / low[0, f, cut], high[1, f, cut] / high[0, f, cut])


def importances(rows: DataFrame, codes: dict[str, list[str]], cfg: Boosting) -> list[tuple[str, float]]:
    """Features by the share of the gain that their splits bring; ``rows``: (label, n) and the columns ``codes`` of :func:`packed` features."""
    names = [f for some in codes.values() for f in some]
    sizes = [len(some) for some in codes.values()]
    gains, trees = np.zeros(len(names)), []
    for k in range(cfg.rounds):
        tree = Tree()
        active = [0]
        for _ in range(cfg.depth):
            if not active:
                break
            found = histograms(rows, list(codes), sizes, trees, tree, active, cfg)
            below = []
            for place, node in enumerate(active):
                stats = found[:, :, place]
                if node == 0:
                    tree.value[0] = float(stats[1, 0].sum() / max(1.0, stats[0, 0].sum()))
                some = np.random.default_rng([cfg.seed, k, node]).permutation(len(names))[: int(np.ceil(cfg.features * len(names)))]
                best = best_split(stats, some, cfg)
                if best:
                    gain, f, cut, values = best
                    gains[f] += gain
                    below += tree.split(node, f, cut, values)
            active = below
        trees.append(tree)
    total = gains.sum()
    return sorted(zip(names, (gains / total if total > 0 else gains).tolist(), strict=True), key=lambda x: -x[1])
