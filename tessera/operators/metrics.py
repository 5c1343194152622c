"""Precision-weighted quality: F at beta 0.5, flat and by entity, sweeps and intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BETA2 = 0.25


def f_half(tp: Column, n_pred: Column, n_true: Column) -> Column:
    """F from counts: 1 where there is nothing to find and nothing was found, 0 where just one is empty."""
    p, r = tp / n_pred, tp / n_true
    value = F.when((n_pred == 0) & (n_true == 0), 1.0).when((n_pred == 0) | (n_true == 0) | (tp == 0), 0.0)
    return value.otherwise((1 + BETA2) * p * r / (BETA2 * p + r))


def by_entity(entities: DataFrame, predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """(s1_id, tp, n_pred, n_true) of every entity, those without any pair too."""
    p = predicted.select("s1_id", "id").distinct().withColumn("p", F.lit(1))
    t = truth.select("s1_id", "id").distinct().withColumn("t", F.lit(1))
    both = p.join(t, ["s1_id", "id"], "full").groupBy("s1_id").agg(F.count_if(F.col("p").isNotNull() & F.col("t").isNotNull()).alias("tp"), F.count("p").alias("n_pred"), F.count("t").alias("n_true"))
    out = entities.select(F.col("id").alias("s1_id")).join(both, "s1_id", "left")
    return out.select("s1_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("tp", "n_pred", "n_true")))


def macro(entities: DataFrame, predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: the mean F by entity, and rates over all pairs; a rate of nothing (no pair predicted, or none true) is NULL."""
    rows = by_entity(entities, predicted, truth).withColumn("f", f_half(F.col("tp"), F.col("n_pred"), F.col("n_true")))
    return rows.agg(
        F.round(F.avg("f"), 6).alias("f05_macro"),
        F.round(F.try_divide(F.sum("tp"), F.sum("n_pred")), 6).alias("precision"),
        F.round(F.try_divide(F.sum("tp"), F.sum("n_true")), 6).alias("recall"),
        F.count_if(F.col("f") == 1).alias("n_perfect"),
        F.round(F.avg("n_pred"), 6).alias("mean_pred"),
    )


def counts_at(rows: DataFrame, threshold: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """tp, fp, fn and the measures of rows (label, score) at a threshold; rows without label are left out."""
    hit, true = F.col("score") >= threshold, F.col("label") == 1
    out = rows.where("label IS NOT NULL").groupBy(*by).agg(F.count_if(hit & true).alias("tp"), F.count_if(hit & ~true).alias("fp"), F.count_if(~hit & true).alias("fn"))
    tp, n_pred, n_true = F.col("tp"), F.col("tp") + F.col("fp"), F.col("tp") + F.col("fn")
    p, r = F.when(n_pred > 0, tp / n_pred).otherwise(0.0), F.when(n_true > 0, tp / n_true).otherwise(0.0)
    return out.select(*by, "tp", "fp", "fn", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0), 6).alias("f1"), F.round(f_half(tp, n_pred, n_true), 6).alias("f05"))


def sweep(rows: DataFrame, start: float = 0.1, stop: float = 0.9, step: float = 0.05) -> DataFrame:
    """The measures at every threshold of a grid, in one pass: a row counts for the grid points up to its score.

    Scores fall into grid cells first, so what meets for the running sums is one row a cell.
    """
    n = round((stop - start) / step)
    cell = F.least(F.greatest(F.floor((F.col("score") - F.lit(start)) / F.lit(step) + F.lit(1e-9)), F.lit(-1)), F.lit(n))
    cells = rows.where("label IS NOT NULL").groupBy(cell.alias("cell")).agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg"))
    grid = rows.sparkSession.range(-1, n + 1).select(F.col("id").alias("cell"))
    full = grid.join(F.broadcast(cells), "cell", "left").select("cell", F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("neg", F.lit(0)).alias("neg"))
    up = W.orderBy(F.col("cell").desc()).rowsBetween(W.unboundedPreceding, 0)
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    full = full.select("cell", F.sum("pos").over(up).alias("tp"), F.sum("neg").over(up).alias("fp"), F.sum("pos").over(every).alias("n_true")).where("cell >= 0")
    tp, n_pred, n_true = F.col("tp"), F.col("tp") + F.col("fp"), F.col("n_true")
    p, r = F.when(n_pred > 0, tp / n_pred).otherwise(0.0), F.when(n_true > 0, tp / n_true).otherwise(0.0)
    return full.select(F.round(F.lit(start) + F.col("cell") * F.lit(step), 4).alias("threshold"), "tp", "fp", (n_true - tp).alias("fn"), F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(f_half(tp, n_pred, n_true), 6).alias("f05"))


def best_threshold(swept: DataFrame) -> DataFrame:
    """The threshold of the best F; the higher one of equals."""
    return swept.agg(F.max_by("threshold", F.struct("f05", "threshold")).alias("threshold"), F.max("f05").alias("f05"))


def dense_sweep(rows: DataFrame, points: int = 200) -> DataFrame:
    """The measures at ``points`` thresholds from the least to the greatest score, and at 0.5; rows (label, score).

    Scores fall between grid points in one pass; what is summed up afterwards is one row a grid point.
    """
    known = rows.where("label IS NOT NULL AND score IS NOT NULL")
    ends = known.agg(F.greatest(F.lit(0.0), F.min("score")).alias("lo"), F.least(F.lit(1.0), F.max("score")).alias("hi")).head()
    lo, hi = (0.0, 1.0) if ends.lo is None else ends
    grid = sorted({lo + k * ((hi - lo) / (points - 1)) for k in range(points - 1)} | {hi, 0.5})
    place = F.size(F.filter(F.array(*map(F.lit, grid)), lambda g: g <= F.col("score")))
    cells = known.groupBy(place.alias("cell")).agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg"))
    table = rows.sparkSession.createDataFrame([(0, None), *((k + 1, t) for k, t in enumerate(grid))], "cell int, threshold double")
    full = table.join(F.broadcast(cells), "cell", "left").select("cell", "threshold", F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("neg", F.lit(0)).alias("neg"))
    up = W.orderBy(F.col("cell").desc()).rowsBetween(W.unboundedPreceding, 0)
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    full = full.select("threshold", F.sum("pos").over(up).alias("tp"), F.sum("neg").over(up).alias("fp"), F.sum("pos").over(every).alias("n_true")).where("threshold IS NOT NULL")
    tp, n_pred, n_true = F.col("tp"), F.col("tp") + F.col("fp"), F.col("n_true")
    p, r = F.when(n_pred > 0, tp / n_pred).otherwise(0.0), F.when(n_true > 0, tp / n_true).otherwise(0.0)
    return full.select(F.round("threshold", 6).alias("threshold"), "tp", "fp", (n_true - tp).alias("fn"), F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0), 6).alias("f1"), F.round(f_half(tp, n_pred, n_true), 6).alias("f05"), n_pred.alias("n_predicted"))


def recommended(swept: DataFrame, precision: float = 0.99, least: int = 5) -> DataFrame:
    """One row of thresholds from a dense sweep: of the best F at beta 0.5, of the best F1, and of the best F1 among those that reach the precision on enough predictions; the lowest of equals."""
    ok = (F.col("precision") >= precision) & (F.col("n_predicted") >= least)

    def top(measure: str, among: Column | None = None) -> Column:
        order = F.struct(measure, -F.col("threshold"))
        return F.max_by("threshold", order if among is None else F.when(among, order))

    return swept.agg(top("f05").alias("max_f05"), top("f1").alias("max_f1"), top("f1", ok).alias("at_precision"))


def run_score(entities: DataFrame, predicted: DataFrame, offered: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: the macro measures, and the recall that the offered candidates allow at most."""
    true = truth.select("s1_id", "id").distinct()
    reach = true.join(offered.select("s1_id", "id").distinct().withColumn("hit", F.lit(1)), ["s1_id", "id"], "left").agg(F.round(F.try_divide(F.count("hit"), F.count("*")), 6).alias("recall_ceiling")).head()
    return macro(entities, predicted, truth).withColumn("recall_ceiling", F.lit(reach.recall_ceiling).cast("double"))


def wilson(successes: Column, trials: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds of a proportion; NULL without trials."""
    p = successes / trials
    mid = (p + F.lit(z * z) / (2 * trials)) / (1 + F.lit(z * z) / trials)
    half = F.lit(z) * F.sqrt(p * (1 - p) / trials + F.lit(z * z) / (4 * trials * trials)) / (1 + F.lit(z * z) / trials)
    return F.when(trials > 0, F.greatest(F.lit(0.0), mid - half)), F.when(trials > 0, F.least(F.lit(1.0), mid + half))
