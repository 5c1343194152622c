"""Command line: ``python -m tessera.cli er --config er.yaml`` or ``benchmark``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from tessera.operators import blocking as B
from tessera.plans import benchmark, pipeline
from tessera.sources import readers


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera")
    p.add_argument("mode", choices=("er", "benchmark"))
    p.add_argument("--config")
    p.add_argument("--root", default=".")
    p.add_argument("--out-dir")
    p.add_argument("--er-mode", choices=("validate", "predict"), default="validate")
    p.add_argument("--model-path")
    p.add_argument("--n-entities", type=int, default=1200)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--margin", type=float)
    p.add_argument("--labels")
    p.add_argument("--oracle-run", action="store_true")
    p.add_argument("--target-precision", type=float)
    p.add_argument("--max-block-size", type=int, default=40)
    p.add_argument("--log-level", default="WARN")
    p.add_argument("--max-source1", type=int)
    p.add_argument("--max-source2", type=int)
    p.add_argument("--max-source3", type=int)
    return p


def main(argv: list[str] | None = None) -> dict:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    spark.sparkContext.setLogLevel(args.log_level)
    if args.mode == "benchmark":
        labels = spark.read.option("header", True).csv(args.labels).selectExpr("s1_id", "id", "CAST(label AS INT) AS label") if args.labels else None
        cfg = benchmark.Benchmark(args.max_block_size, target_precision=args.target_precision, margin=args.margin, oracle=args.oracle_run)
        out = benchmark.run(spark, args.n_entities, args.seed, cfg, labels, args.out_dir)
    else:
        if args.er_mode == "predict" and not args.model_path:
            raise ValueError("predict needs --model-path")
        config = readers.load_config(args.config)
        known = {"max_candidates_per_record": "cap", "per_rule_cap": "rule_cap", "name_prefix_len": "prefix_len", "phonetic_scheme": "phonetic", "min_token_len": "min_token_len", "max_bucket_size": "max_bucket", "max_token_df_ratio": "df_ratio", "max_token_df_absolute": "df_most", "scope_token_index_by_country": "scope_tokens", "fallback_window": "window", "fallback_neighborhood_window": "near", "fallback_max_candidates": "fallback_cap"}
        given = config.get("blocking", {})
        cfg = B.Blocking(**{own: given[k] for k, own in known.items() if k in given}, floor=100 * given.get("fallback_fuzzy_floor", 0.72))
        rows, truth = pipeline.from_config(spark, config, args.er_mode, args.root)
        for src, most in enumerate((args.max_source1, args.max_source2, args.max_source3)):
            if most is not None:
                rows = rows.where(f"src <> {src}").unionByName(rows.where(f"src = {src}").limit(most))
        run = pipeline.Run(cfg, margin=0.05 if args.margin is None else args.margin, high=config.get("decision", {}).get("high_threshold", 0.85))
        out = pipeline.link(spark, rows, truth, args.model_path, args.out_dir, run)
    print(json.dumps(out["report"], default=str))
    return out["report"]


if __name__ == "__main__":
    main()
