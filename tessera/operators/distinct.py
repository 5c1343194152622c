"""Entity features of many pairs by what they depend on: two names, two addresses, or the rest of a pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import blocking as B
from tessera.operators import boosting as G
from tessera.operators import features as X
from tessera.sources.staging import stage

#: A text, the columns of cleaned rows that follow from it, and their pairs' features.
PARTS = {"name": (X.NAME_SIDE, X.NAME_FEATURES, X.name_features), "address": (X.ADDRESS_SIDE, X.ADDRESS_FEATURES, X.address_features)}


def numbered(rows: DataFrame, part: str) -> DataFrame:
    """(text, <part>_no, the part's columns): each distinct text with a number, written once."""
    side = PARTS[part][0]
    known = rows.select(F.col(part).alias("text"), *side).dropDuplicates(["text"])
    return stage(known.withColumn(f"{part}_no", F.monotonically_increasing_id()))


def numbers(part: str) -> list[str]:
    return [f"{p}_{part}_no" for p in "ab"]


def featured(pairs: DataFrame, texts: DataFrame, part: str) -> DataFrame:
    """The distinct pairs of a part's texts with ``n`` and features, written once; ``pairs`` has their numbers."""
    side, _, of = PARTS[part]
    rows = pairs
    for p, no in zip("ab", numbers(part), strict=True):
        rows = rows.join(texts.select(F.col(f"{part}_no").alias(no), *(F.col(c).alias(f"{p}_{c}") for c in side)), no)
    return stage(of(rows, *numbers(part), "n"))


def groups(s1: DataFrame, others: DataFrame, cfg: B.Blocking, cut: DataFrame, columns: tuple[str, ...], label: Column) -> tuple[DataFrame, dict[str, list[str]]]:
    """(label, n, codes) of the pairs after the cap with ENTITY_FEATURES, and the features of each code: pairs alike in the bins of all features are one row.

    Pairs carry numbers of names and addresses, and each distinct pair of texts gets its features once. ``label`` is told from
    both sides' ``columns``.
    """
    every = s1.unionByName(others)
    texts = {part: numbered(B.with_phonetic(every, B.Blocking(rules=B.PHONETIC)) if part == "name" else every, part) for part in PARTS}

    def slim(rows: DataFrame) -> DataFrame:
        for part, known in texts.items():
            rows = rows.join(known.select(F.col("text").alias("known"), f"{part}_no"), F.col(part).eqNullSafe(F.col("known")), "left").drop("known")
        return rows

    both = [c for part in PARTS for c in numbers(part)]
    country = X.country_of(X.side("a"), X.side("b"))
    pairs = B.capped_pairs(slim(s1), slim(others), cfg, tuple(dict.fromkeys((*(f"{part}_no" for part in PARTS), "country_norm", *columns))), cut)
    # The limits of address features need all pairs' counts before any pair can be told by bins, so pairs are written, thin.
    pairs = stage(pairs.select(*both, "mask", label.alias("label"), *(v.alias(c) for c, v in country.items())))

    def coded(found: DataFrame, part: str) -> tuple[DataFrame, dict[str, list[str]]]:
        names = PARTS[part][1]
        made = G.packed(names, G.splits(found, names))
        codes = {f"{part}_{k}": names[k * G.PACK : (k + 1) * G.PACK] for k in range(len(made))}
        gone = sum((F.col(c).cast("int") for c in names if c.endswith("_missing_either")), F.lit(0))
        return found.select(*numbers(part), gone.alias(f"{part}_gone"), *(m.alias(c) for m, c in zip(made, codes, strict=True))), codes

    rows, codes = pairs.withColumn("n", F.lit(1).cast("long")), {}
    # Addresses first: the groups left then are few.
    for part in ("address", "name"):
        found = featured(rows.groupBy(*numbers(part)).agg(F.sum("n").alias("n")), texts[part], part)
        known, own = coded(found, part)
        codes |= own
        left = [c for c in rows.columns if c not in (*numbers(part), "n")]
        rows = rows.join(known.hint("shuffle_hash"), numbers(part))
        rows = stage(rows.groupBy(*left, f"{part}_gone", *own).agg(F.sum("n").alias("n")))
    rest = rows.withColumns(X.rules_of(F.col("mask")) | {"n_fields_missing_total": F.col("name_gone") + F.col("address_gone") + F.col("country_missing_either").cast("int")})
    made = G.packed(X.REST_FEATURES, G.splits(rest, X.REST_FEATURES))
    codes |= {f"rest_{k}": X.REST_FEATURES[k * G.PACK : (k + 1) * G.PACK] for k in range(len(made))}
    rest = rest.select("label", "n", *[c for c in codes if c in rows.columns], *(m.alias(f"rest_{k}") for k, m in enumerate(made)))
    return stage(rest.groupBy("label", *codes).agg(F.sum("n").alias("n"))), codes
