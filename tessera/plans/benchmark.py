"""The benchmark on generated records of the richer schema, end to end.

Seven-key blocking, 59 pair features, labels (silver, reviewed or the truth),
boosting, a threshold from the dense sweep, acceptance with or without a margin,
the entity table and its summary.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import address
from tessera.operators import blocking as B
from tessera.operators import decide as D
from tessera.operators import features as X
from tessera.operators import metrics as M
from tessera.operators import model as G
from tessera.operators import sampling as S
from tessera.sources import sinks, synth
from tessera.sources.ship import ship
from tessera.sources.staging import stage

NOT_FEATURES = ("s1_id", "src", "id", "mask")


@dataclass(frozen=True)
class Benchmark:
    max_block: int = 40
    df_ratio: float = 0.01
    rounds: int = 40
    target_precision: float | None = None
    margin: float | None = None
    oracle: bool = False


def prepared(records: DataFrame) -> DataFrame:
    """Cleaned rows with the parts of their address."""
    rows = B.bench_clean(records)
    parsed = address.with_address(rows, "address", None, "state", "zip").select(*[c for c in rows.columns if c not in ("state", "zip5")], "parts.*")
    return parsed.withColumn("city_norm", F.col("city"))


WEIGHED = {"name_tfidf_cos": ("word_", X.word_grams), "name_tfidf_char_cos": ("char_", X.char_grams)}


def weighed(rows: DataFrame) -> DataFrame:
    """``rows`` with the weights of their names' grams."""
    units = {p: stage(X.tfidf_units(rows.select("name_norm"), grams)) for p, grams in WEIGHED.values()}
    for p, unit in units.items():
        rows = rows.join(unit.select("name_norm", *(F.col(c).alias(p + c) for c in ("norm", "v"))), "name_norm", "left")
    return rows


def features(s1: DataFrame, others: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (s1_id, src, id, mask) of :func:`weighed` rows with all 59 features, made where their sides meet; ``right``: the keys of ``others``."""
    columns = (*X.BENCH_FIELDS, *(p + c for p, _ in WEIGHED.values() for c in ("norm", "v")))
    cosines = {n: F.coalesce(X.cosine_of(f"a_{p}", f"b_{p}"), F.lit(0.0)) for n, (p, _) in WEIGHED.items()}
    return X.bench_of(B.bench_carried(s1, others, right, columns), ["s1_id", "src", "id", "mask"], cosines)


def feature_names(rows: DataFrame) -> list[str]:
    """Numeric columns that are features, in order of their names."""
    return sorted(f.name for f in rows.schema.fields if f.name not in NOT_FEATURES and f.dataType.simpleString() in ("double", "int", "bigint"))


def run(spark: SparkSession, n: int = 1296, seed: int = 42, cfg: Benchmark = Benchmark(), labels: DataFrame | None = None, out: str | None = None) -> dict:
    """All steps; ``labels`` (s1_id, id, label) are a reviewer's and win over silver labels, ``cfg.oracle`` learns from the truth."""
    ship(spark)
    records, truth = map(stage, synth.generate(spark, n, seed, traps=True))
    rows = stage(weighed(stage(prepared(records))))
    s1, others = rows.where("src = 0"), rows.where("src > 0")
    cutoff = max(2, int(cfg.df_ratio * s1.count()))
    right = B.bench_keys(others, vocabulary=B.token_df(s1).where(F.col("df") <= cutoff))
    pairs = features(s1, others, stage(B.cool(right, ["key_type", "key"], cfg.max_block)))
    names = feature_names(pairs)
    # Wide rows are written once, with their labels; splits are told by a pair's columns when it is read.
    silver = stage(S.silver_labels(pairs))
    found = silver.select("s1_id", "id", "mask")
    true = truth.select("s1_id", "id").distinct().withColumn("true", F.lit(1))
    if cfg.oracle:
        labelled = stage(silver.join(true, ["s1_id", "id"], "left").withColumn("label", F.coalesce("true", F.lit(0))).drop("true"))
    elif labels is not None:
        labelled = stage(S.reviewed(silver, labels))
    else:
        labelled = silver.withColumn("label", F.col("silver_label"))
    labelled = S.stratified_split(labelled, F.concat_ws("|", "s1_id", "id"), seed)
    model = G.fit(labelled.where("label IS NOT NULL AND split <> 'test'"), names, cfg.rounds, seed)
    known = stage(G.score(model, labelled, names, "label", "split").withColumnRenamed("probability", "score"))
    scores = known.select("s1_id", "src", "id", "score")
    held = known.where("label IS NOT NULL AND split = 'val'")
    choice = M.recommended(M.dense_sweep(held), 0.99 if cfg.target_precision is None else cfg.target_precision).head()
    threshold = choice.max_f1 if cfg.target_precision is None or choice.at_precision is None else choice.at_precision
    accepted = scores.where(F.col("score") >= threshold) if cfg.margin is None else D.margin_dedup(scores, threshold, cfg.margin)
    accepted = stage(accepted.select("s1_id", "src", "id", "score"))
    table = D.entity_table(s1, accepted, [1, 2])
    summary = D.pair_summary(s1, scores, threshold)
    quality = M.run_score(s1, accepted, found, truth).head()
    if out:
        sinks.write_benchmark(table, scores, S.review_sample(accepted, threshold), out)
    report = {"threshold": threshold, "features": len(names), "candidates": found.count(), "labels": {r.stratum: r.n for r in S.label_distribution(silver).collect()}, **quality.asDict()}
    return {"table": table, "scores": scores, "accepted": accepted, "summary": summary, "sheet": S.labeling_sheet(silver), "importances": G.importances(model, names)[:20], "by_key": B.recall_by_key(truth, found, {1 << k: x for k, x in enumerate(B.BENCH_KEYS)}), "missed": B.missed(truth, found), "report": report}
