"""Splits, samples and label sets, all drawn by hash: the same rows on any cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators.features import once


def bucket(key: Column, salt: str) -> Column:
    """A place in [0, 1) from the first 32 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{salt}:"), key).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def entity_split(rows: DataFrame, key: str = "id", salt: str = "er-split", held: float = 0.2, tune: float = 0.5) -> DataFrame:
    """``rows`` with split: train, tune or report."""
    b = bucket(F.col(key), salt)
    return rows.withColumn("split", F.when(b >= held, "train").when(b < held * tune, "tune").otherwise("report"))


def drawn(key: Column, seed: int) -> Column:
    """A string whose order is random but fixed by the seed."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary"))


def stratified_split(rows: DataFrame, key: Column, seed: int = 42, parts: tuple[float, float] = (0.6, 0.8)) -> DataFrame:
    """``rows`` with split: train, val or test in equal shares of each label, by percent rank of the drawn order.

    Only the digests at which a label's splits begin are needed. They come from counts by the first digits and the exact
    ranks of the few rows whose digits lie on a limit, so rows are neither sorted nor shuffled; they are read three times.
    """
    digest = drawn(key, seed)
    thin = rows.select(F.col("label").alias("of"), digest.alias("digest")).withColumn("start", F.substring("digest", 1, 4))
    sizes = thin.groupBy("of", "start").agg(F.count("*").alias("n"))
    sizes = sizes.withColumns({"before": F.sum("n").over(W.partitionBy("of").orderBy("start")) - F.col("n"), "total": F.sum("n").over(W.partitionBy("of"))})

    def place(less: Column) -> Column:
        return F.when(F.col("total") > 1, less / (F.col("total") - 1)).otherwise(0.0)

    first, last = place(F.col("before")), place(F.col("before") + F.col("n") - 1)
    mixed = sizes.where(((first < parts[0]) & (last >= parts[0])) | ((first < parts[1]) & (last >= parts[1])))
    mixed = mixed.select(F.col("of").alias("of_"), F.col("start").alias("start_"), "before", "total")
    near = thin.join(F.broadcast(mixed), F.col("of").eqNullSafe(F.col("of_")) & (F.col("start") == F.col("start_")))
    near = near.withColumn("less", F.col("before") + F.rank().over(W.partitionBy("of", "start").orderBy("digest")) - 1)
    known = sizes.select("of", F.col("start").alias("at"), first.alias("place")).unionByName(near.select("of", F.col("digest").alias("at"), place(F.col("less")).alias("place")))
    cuts = known.groupBy("of").agg(*(F.min(F.when(F.col("place") >= p, F.col("at"))).alias(f"cut_{k}") for k, p in enumerate(parts)))
    out = rows.join(F.broadcast(cuts), F.col("label").eqNullSafe(F.col("of")), "left")
    before = [F.col(f"cut_{k}").isNull() | (digest < F.col(f"cut_{k}")) for k in range(len(parts))]
    return out.withColumn("split", F.when(before[0], "train").when(before[1], "val").otherwise("test")).drop("of", *(f"cut_{k}" for k in range(len(parts))))


def first_of(rows: DataFrame, n: Column, order: list[Column], by: list[str] | None = None) -> DataFrame:
    place = F.row_number().over(W.partitionBy(*(by or [])).orderBy(*order))
    return rows.withColumn("place", place).where(F.col("place") <= n).drop("place")


def hard_negatives(negatives: DataFrame, truth: DataFrame, budget: int, score: str = "score", hard: float = 0.7, local: float = 0.5, per_entity: int = 40, seed: int = 42) -> DataFrame:
    """(s1_id, id, band): negatives for training, most of them alike; true pairs never.

    Bands: hard and in the same place, hard elsewhere, and random from the rest.
    """
    rows = negatives.join(truth.select("s1_id", "id"), ["s1_id", "id"], "left_anti")
    near = F.coalesce((F.col("country_exact") > 0) & (F.col("city_exact") > 0), F.lit(False))
    rows = rows.withColumn("near", near)
    n_hard = round(budget * hard)
    n_local = round(n_hard * local)
    order = [F.col(score).desc_nulls_last(), F.col("s1_id"), F.col("id")]
    # Each pool gives at most the budget, so its global order is a top-k.
    top = [rows.where("near").orderBy(*order).limit(n_local).withColumn("band", F.lit("local")), rows.where("NOT near").orderBy(*order).limit(n_hard - n_local).withColumn("band", F.lit("hard"))]
    taken = top[0].unionByName(top[1])
    rest = rows.join(taken.select("s1_id", "id"), ["s1_id", "id"], "left_anti")
    key = F.concat_ws("|", "s1_id", "id")
    more = rest.orderBy(drawn(key, seed), "s1_id", "id").limit(budget - n_hard).withColumn("band", F.lit("random"))
    out = taken.unionByName(more).withColumn("key", F.concat_ws("|", "s1_id", "id"))
    return first_of(out, F.lit(per_entity), order, ["s1_id"]).select("s1_id", "id", "band")


def training_sample(rows: DataFrame, truth: DataFrame, most: int, score: str = "score", seed: int = 42) -> DataFrame:
    """(s1_id, id, label): all positives of ``rows`` and at most ``most`` less their number of negatives, chosen by :func:`hard_negatives`."""
    positives = rows.join(truth.select("s1_id", "id").distinct(), ["s1_id", "id"], "left_semi").select("s1_id", "id").distinct().withColumn("label", F.lit(1))
    negatives = hard_negatives(rows, truth, max(0, most - positives.count()), score, seed=seed).select("s1_id", "id").withColumn("label", F.lit(0))
    return positives.unionByName(negatives)


def thinned(rows: DataFrame, key: Column, step: int) -> DataFrame:
    """Every ``step``-th row or so, by hash: the same rows at any partitioning."""
    return rows.where(F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long") % step == 0)


def label_distribution(rows: DataFrame) -> DataFrame:
    """(stratum, n) of rows with silver labels."""
    return rows.groupBy("stratum").agg(F.count("*").alias("n"))


def rule_score(f: str = "") -> Column:
    """The hand-made score of a pair in [0, 1] from independent signals."""

    def v(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0.0))

    def no(c: str) -> Column:
        return F.coalesce((F.col(c) == 0).cast("double"), F.lit(0.0))

    core = v("name_jw_core")
    far = F.coalesce(F.col("geo_dist_km"), F.lit(0.0))
    good = (
        0.45 * (v("phone10_equal") + 0.5 * v("phone7_equal"))
        + F.when(core > 0.93, 0.30).when(core > 0.85, 0.18).otherwise(0.0)
        + 0.20 * v("name_substring")
        + 0.15 * v("name_first_tok_equal")
        + 0.20 * F.least(F.lit(1.0), v("geo_within_1km") + v("zip5_equal"))
        + 0.10 * v("house_number_equal")
        + 0.10 * v("city_equal")
        + 0.05 * v("category_equal")
        + 0.10 * F.col("blk_n_keys") / 7
    )
    bad = (
        F.when(far > 50, 0.60).when(far > 10, 0.25).otherwise(0.0)
        + 0.35 * no("zip3_equal")
        + 0.30 * no("state_equal")
        + 0.30 * no("city_equal")
        + 0.20 * no("house_number_equal")
        + F.when(F.coalesce(F.col("name_jw_core"), F.lit(1.0)) < 0.55, 0.25).otherwise(0.0)
    )
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), good - bad))


def silver_labels(rows: DataFrame, sure: float = 0.80, sure_not: float = 0.12) -> DataFrame:
    """``rows`` with rule_score, stratum and silver_label; only the sure ends get a label."""
    rows = once(rows, ["*"], {"rule_score": rule_score()})
    strong = (F.coalesce(F.col("phone10_equal"), F.lit(0.0)) > 0) | (F.coalesce(F.col("name_jw_core"), F.lit(0.0)) > 0.90) | ((F.coalesce(F.col("zip5_equal"), F.lit(0.0)) > 0) & (F.coalesce(F.col("house_number_equal"), F.lit(0.0)) > 0))
    s = F.col("rule_score")
    stratum = F.when(s >= sure, "certain_match").when(s <= sure_not, "certain_nonmatch").when(strong, "probable_match").otherwise("ambiguous")
    rows = once(rows, ["*"], {"stratum": stratum})
    return rows.withColumn("silver_label", F.when(F.col("stratum") == "certain_match", 1).when(F.col("stratum") == "certain_nonmatch", 0))


SHEET = {"certain_match": 150, "probable_match": 300, "ambiguous": 500, "certain_nonmatch": 250}


def labeling_sheet(rows: DataFrame, sizes: dict[str, int] = SHEET, seed: int = 42) -> DataFrame:
    """A random sheet with so many rows of each stratum and a blank label."""
    n = F.lit(0)
    for name, size in sizes.items():
        n = F.when(F.col("stratum") == name, size).otherwise(n)
    key = F.concat_ws("|", "s1_id", "id")
    return first_of(rows, n, [drawn(key, seed), F.col("s1_id"), F.col("id")], ["stratum"]).select("s1_id", "id", "stratum", F.lit(None).cast("int").alias("label"))


def reviewed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with a reviewer's label; repeats count once, a pair with two labels or one beyond 0 and 1 is an error."""
    given = labels.where("label IS NOT NULL").groupBy("s1_id", "id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    checked = given.select("s1_id", "id", F.when((F.col("label") == F.col("other")) & F.col("label").isin(0, 1), F.col("label")).otherwise(F.raise_error(F.lit("conflicting or unknown label"))).cast("int").alias("label"))
    return rows.join(checked, ["s1_id", "id"], "left")


def review_sample(scored: DataFrame, threshold: float, n: int = 200, seed: int = 42, score: str = "score") -> DataFrame:
    key = F.concat_ws("|", "s1_id", "id")
    return scored.where(F.col(score) >= threshold).orderBy(drawn(key, seed), "s1_id", "id").limit(n)


def subsample(s1: DataFrame, others: DataFrame, truth: DataFrame, share: float, negatives: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Sampled entities, and the records that match them with a share of the rest."""
    some = s1.where(bucket(F.col("id"), f"s1-{seed}") < share)
    wanted = truth.join(some.select(F.col("id").alias("s1_id")), "s1_id", "left_semi").select("id").distinct()
    matched = others.join(wanted, "id", "left_semi")
    rest = others.join(truth.select("id").distinct(), "id", "left_anti").where(bucket(F.col("id"), f"neg-{seed}") < negatives)
    return some, matched.unionByName(rest)
