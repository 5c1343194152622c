"""The entity linkage pipeline: validate or predict."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import blocking as B
from tessera.operators import decide as D
from tessera.operators import features as X
from tessera.operators import metrics as M
from tessera.operators import model as G
from tessera.operators import sampling as S
from tessera.sources import readers, sinks
from tessera.sources.ship import ship
from tessera.sources.staging import stage


@dataclass(frozen=True)
class Run:
    blocking: B.Blocking = field(default_factory=B.Blocking)
    low_ratio: float = 0.6
    margin: float = 0.05
    high: float = 0.85
    rounds: int = 40
    fallback: bool = True


def candidates(s1: DataFrame, others: DataFrame, run: Run) -> tuple[DataFrame, DataFrame]:
    """Pairs (s1_id, src, id, mask) after caps and fallback, and every record's status."""
    cfg = run.blocking
    found = stage(B.capped(B.narrowed(B.pairs(s1, others, cfg), s1, others, cfg), cfg.cap))
    rescued = stage(B.fallback(s1, others, found, cfg)) if run.fallback else None
    every = found.select("s1_id", "src", "id", "mask")
    if rescued is not None:
        every = every.unionByName(rescued)
    return every, B.record_status(others, found, rescued)


def link(spark: SparkSession, records: DataFrame, truth: DataFrame | None = None, model_path: str | None = None, out: str | None = None, run: Run = Run()) -> dict:
    """Link raw records (id, src, name, address, country); src 0 is the reference.

    With ``truth`` (s1_id, id): learn on its train entities, tune the threshold on
    the tune entities, report on the rest; the model is saved to ``model_path`` if
    given. Without it: score with the saved model.
    """
    ship(spark)
    if truth is None and model_path is None:
        raise ValueError("predicting needs a model")
    clean = stage(B.clean(records))
    s1, others = clean.where("src = 0"), clean.where("src > 0")
    pairs, status = candidates(s1, others, run)
    rows = X.composite(X.entity_features(pairs, s1, others))
    rows = S.entity_split(rows, "s1_id")
    if truth is not None:
        true = truth.select("s1_id", "id").distinct().withColumn("label", F.lit(1))
        rows = rows.join(true, ["s1_id", "id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))
    rows = stage(rows)
    features, high = list(X.ENTITY_FEATURES), run.high
    if truth is not None:
        fitted = G.fit(S.stratified_split(rows.where("split = 'train'").drop("split"), F.concat_ws("|", "s1_id", "id")), features, run.rounds)
        if model_path:
            G.save(fitted, model_path, features)
    else:
        fitted, features = G.load(spark, model_path)
    scored = stage(rows.join(G.score(fitted, rows, features).withColumnRenamed("probability", "score"), ["s1_id", "src", "id"]))
    if truth is not None:
        high = float(M.best_threshold(M.sweep(scored.where("split = 'tune'"))).head().threshold or run.high)
    decided = stage(D.decisions(scored, D.Decision.from_high(high, run.low_ratio, margin=run.margin)))
    table = D.record_table(status, decided)
    won = decided.where("match_status = 'matched'").select(F.col("matched_s1_id").alias("s1_id"), "src", "id")
    report = {"threshold": high, **D.run_report(table).head().asDict()}
    if truth is not None:
        held = S.entity_split(s1).where("split = 'report'")
        ids = held.select(F.col("id").alias("s1_id"))
        report |= M.macro(held, won.join(ids, "s1_id", "left_semi"), truth.join(ids, "s1_id", "left_semi")).head().asDict()
    rollup, offered = D.entity_rollup(s1, won, "matched_entity_ids"), D.entity_rollup(s1, pairs, "candidate_entity_ids")
    if out:
        sinks.write_records(table, out)
        for frame, name, column in ((rollup, "matching_results", "matched_entity_ids"), (offered, "candidate_pairs", "candidate_entity_ids")):
            sinks.assert_coverage(frame, s1, column)
            sinks.write_tsv(frame, f"{out}/{name}", ("source1_entity_id", column))
        sinks.write_report(spark, spark.createDataFrame([tuple(report.values())], list(report)).head(), f"{out}/summary_report")
    return {"records": table, "rollup": rollup, "candidates": offered, "report": report, "model": fitted}


def from_config(spark: SparkSession, config: dict, mode: str, root: str) -> tuple[DataFrame, DataFrame | None]:
    """Records of the three sources that a configuration names, and truth pairs when validating."""
    sep, paths = config.get("sep", "\t"), config["paths"][mode]
    parts = []
    for src, name in enumerate(("source1", "source2", "source3")):
        spec = config["sources"][name]
        parts.append(readers.mapped(readers.read_delimited(spark, f"{root}/{paths[name]}", sep), src, spec["id_col"], spec["fields"]))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    truth = readers.read_truth(spark, f"{root}/{paths['ground_truth']}", sep)[1] if mode == "validate" else None
    return rows, truth
