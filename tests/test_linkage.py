"""Blocking, decisions and metrics on small frames."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import blocking as B
from tessera.operators import decide as D
from tessera.operators import metrics as M
from tessera.operators import sampling as S
from tessera.streaming.link import link_batch

S1 = [("S1-1", 0, "Zenith Bakery"), ("S1-2", 0, "Cobalt Clinic"), ("S1-3", 0, "Ivy Tailors"), ("S1-4", 0, "Onyx Legal")]


def frame(spark, rows, address="1 Main St, Austin, TX", country="US"):
    return B.clean(spark.createDataFrame([(*r, address, country) for r in rows], "id string, src long, name string, address string, country string"))


def reached(spark, name, rules, country="US", **more):
    cfg = B.Blocking(rules=rules, df_ratio=1.0, **more)
    other = frame(spark, [("S2-1", 1, name)], "2 Oak St, Dallas, TX", country)
    return {r.s1_id for r in B.pairs(frame(spark, S1), other, cfg).collect()}


def test_rules_alone(spark):
    assert reached(spark, "Zenith Clinic", B.TOKEN) == {"S1-1", "S1-2"}
    assert reached(spark, "Zenith Bakeries", B.PREFIX) == {"S1-1"}
    assert reached(spark, "Zenith Bakery", B.CITY_PREFIX) == set()
    assert reached(spark, "Zenith Bakery", B.PREFIX, country="France") == set()
    mill = frame(spark, [("S1-9", 0, "Halberston Mill")])
    other = frame(spark, [("S2-9", 1, "Halberstun Mill")])
    assert B.pairs(mill, other, B.Blocking(rules=B.PHONETIC)).count() == 1
    assert B.pairs(mill, other, B.Blocking(rules=B.PREFIX, prefix_len=12)).count() == 0


def test_cap_keeps_the_best(spark):
    many = frame(spark, [(f"S1-{k:03d}", 0, f"Acme Widget {k:03d}") for k in range(60)])
    other = frame(spark, [("S2-1", 1, "Acme Widget 007")])
    cfg = B.Blocking(rules=B.PREFIX | B.TOKEN, df_ratio=1.0, cap=10)
    kept = B.capped(B.pairs(many, other, cfg), 10).collect()
    assert len(kept) == 10


def test_no_theta_join(spark):
    plan = B.neighborhood(frame(spark, S1), frame(spark, [("S2-1", 1, "Xenon")]), 3)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_fallback_rescues(spark):
    s1, other = frame(spark, S1), frame(spark, [("S2-1", 1, "Zenyth Bakry"), ("S2-2", 1, None)])
    none = B.pairs(s1, other, B.Blocking(rules=B.PREFIX))
    found = B.fallback(s1, other, none, B.Blocking())
    assert {r.id for r in found.collect()} == {"S2-1"}
    status = {r.id: r.status for r in B.record_status(other, none, found).collect()}
    assert status == {"S2-1": "resolved_by_fallback", "S2-2": "unresolved_after_fallback"}


def test_decisions(spark):
    cols = "src long, id string, s1_id string, score double, country_exact double, city_exact double, city_similarity double"
    rows = [
        (1, "a", "A", 0.95, 1.0, 1.0, 1.0), (1, "a", "B", 0.93, 1.0, 1.0, 1.0),
        (1, "b", "A", 0.95, 1.0, 1.0, 1.0), (1, "b", "B", 0.70, 1.0, 1.0, 1.0),
        (1, "c", "A", 0.90, None, None, None),
        (1, "d", "A", 0.90, 0.0, 1.0, 1.0),
        (1, "e", "A", 0.90, 1.0, 0.0, 0.1),
        (1, "f", "A", 0.90, 1.0, 0.0, 0.93),
        (1, "g", "A", 0.10, 1.0, 1.0, 1.0),
        (1, "h", "A", 0.50, 1.0, 1.0, 1.0),
    ]
    out = {r.id: r for r in D.decisions(spark.createDataFrame(rows, cols), D.Decision(0.8, 0.4, 0.05)).collect()}
    want = {"a": "ambiguous", "b": "matched", "c": "matched", "d": "manual_review", "e": "manual_review", "f": "matched", "g": "unmatched", "h": "manual_review"}
    assert {k: r.match_status for k, r in out.items()} == want
    assert out["a"].second_s1_id == "B" and out["d"].decision_notes == "veto:country_conflict"
    with pytest.raises(ValueError):
        D.Decision(0.3, 0.5)


def test_margin(spark):
    rows = [("A", 1, "x1", 0.95), ("A", 1, "x2", 0.88), ("A", 2, "y1", 0.9), ("B", 1, "x3", 0.7), ("B", 1, "x4", 0.3)]
    scored = spark.createDataFrame(rows, "s1_id string, src long, id string, score double")
    assert {r.id for r in D.margin_dedup(scored, 0.5, 0.0).collect()} == {"x1", "y1", "x3"}
    assert {r.id for r in D.margin_dedup(scored, 0.5, 0.1).collect()} == {"x1", "x2", "y1", "x3"}
    s1 = spark.createDataFrame([("A",), ("B",), ("C",)], "id string")
    out = {r.s1_id: r for r in D.entity_table(s1, scored.where("score > 0.5"), [1, 2]).collect()}
    assert out["A"].source2_ids == "x1|x2" and out["A"].total == 3 and out["C"].source2_ids == "" and out["C"].total == 0


def test_metrics(spark):
    entities = spark.createDataFrame([("e1",), ("e2",), ("e3",)], "id string")
    true = spark.createDataFrame([("e1", "x"), ("e3", "y"), ("e3", "z")], "s1_id string, id string")
    got = spark.createDataFrame([("e1", "x"), ("e2", "w"), ("e3", "y")], "s1_id string, id string")
    assert M.macro(entities, got, true).head().f05_macro == pytest.approx((1 + 0 + 0.625 / 0.75) / 3, abs=1e-6)
    rows = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.7), (0, 0.2)], "label int, score double")
    swept = M.sweep(rows)
    assert swept.count() == 17 and M.best_threshold(swept).head().threshold == pytest.approx(0.8)
    low, high = M.wilson(F.col("k"), F.col("n"))
    bounds = spark.createDataFrame([(10, 10), (1000, 1000), (0, 0)], "k int, n int").select(low.alias("l"), high.alias("h")).collect()
    assert bounds[0].h == 1.0 and bounds[0].l < 0.8 and bounds[1].l > 0.99 and bounds[2].l is None


def test_splits_and_negatives(spark):
    ids = spark.createDataFrame([(f"E{k}",) for k in range(200)], "id string")
    again = [S.entity_split(ids.repartition(n)).orderBy("id").collect() for n in (1, 7)]
    assert again[0] == again[1] and {r.split for r in again[0]} == {"train", "tune", "report"}
    rows = spark.createDataFrame([(f"s{k % 20}", f"r{k}", k / 200, 1.0, float(k % 2)) for k in range(200)], "s1_id string, id string, score double, country_exact double, city_exact double")
    true = spark.createDataFrame([("s19", "r199")], "s1_id string, id string")
    out = S.hard_negatives(rows, true, 40, per_entity=3).collect()
    assert ("s19", "r199") not in {(r.s1_id, r.id) for r in out} and len(out) <= 40
    labels = spark.createDataFrame([("s0", "r0", 1), ("s0", "r0", 0)], "s1_id string, id string, label int")
    with pytest.raises(Exception, match="conflicting"):
        S.reviewed(rows, labels).collect()


def test_stream_equals_batch(spark, tmp_path):
    from tessera.streaming import link

    s1 = frame(spark, S1)
    raw = spark.createDataFrame([("S2-1", 1, "Zenith Bakery", "1 Main St, Austin, TX", "US"), ("S2-2", 1, "Nothing Like", "", "US")], "id string, src long, name string, address string, country string")
    raw.write.parquet(f"{tmp_path}/in")
    cfg, decision = B.Blocking(rules=B.PREFIX | B.TOKEN, df_ratio=1.0), D.Decision()
    stream = spark.readStream.schema(raw.schema).parquet(f"{tmp_path}/in")
    link.start(stream, s1, f"{tmp_path}/out", f"{tmp_path}/state", cfg, decision).awaitTermination(120)
    streamed = sorted(map(str, spark.read.parquet(f"{tmp_path}/out").drop("batch").collect()))
    assert streamed == sorted(map(str, link_batch(s1, raw, cfg, decision).collect())) and len(streamed) == 2


def test_readers(spark, tmp_path):
    from tessera.sources import readers, sinks

    path = tmp_path / "truth.tsv"
    path.write_text("source1_entity_id\tmatched_entity_ids\nE1\tS2-1, S3-2\nE2\t\n")
    whole, pairs = readers.read_truth(spark, str(path))
    assert whole.count() == 2 and {(r.s1_id, r.id) for r in pairs.collect()} == {("E1", "S2-1"), ("E1", "S3-2")}
    raw = spark.createDataFrame([("NA", "x")], "k string, n string")
    out = readers.mapped(raw, 1, "k", {"name": "n", "address": None}).head()
    assert out.id == "NA" and out.address is None
    with pytest.raises(KeyError):
        readers.mapped(raw, 1, "gone", {})
    s1 = spark.createDataFrame([("E1",), ("E2",)], "id string")
    with pytest.raises(AssertionError):
        sinks.assert_coverage(spark.createDataFrame([("E1", "x")], "s1_id string, ids string"), s1, "ids")


def test_capped_pairs_where_they_meet(spark):
    s1 = frame(spark, [(f"S1-{k:03d}", 0, f"Acme Widget {('Oak', 'Elm', 'Ash')[k % 3]} {k % 7}") for k in range(60)])
    others = frame(spark, [(f"S2-{k}", 1, f"Acme Widget {('Oak', 'Elm', 'Fir')[k % 3]} {k % 5}") for k in range(12)])
    # Some keys are hot, and most records have more pairs than the cap.
    cfg = B.Blocking(rules=B.PREFIX | B.CITY_PREFIX | B.TOKEN, prefix_len=13, df_ratio=1.0, max_bucket=25, cap=5)
    want = sorted(map(tuple, B.capped(B.pairs(s1, others, cfg), cfg.cap).collect()))
    got = sorted(map(tuple, B.capped_pairs(s1, others, cfg).select("s1_id", "src", "id", "mask", "token_hits").collect()))
    assert got == want and want


def test_distances_are_computed_once_a_pair(spark):
    from tessera.operators import features as X

    s1, others = frame(spark, S1), frame(spark, [("S2-1", 1, "Zenith Clinic")])
    cfg = B.Blocking(rules=B.PREFIX | B.TOKEN, df_ratio=1.0)
    rows = X.composite(X.light_features(B.pairs(s1, others, cfg), s1, others), groups=X.LIGHT_GROUPS)
    plan = rows.where("weighted_composite_score >= 0.1")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("levenshtein(") == 3


def test_edit_distances_side_by_side(spark):
    import random

    import numpy as np

    from tessera.functions import kernels

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            last, row[0] = row[0], i
            for k, d in enumerate(b, 1):
                last, row[k] = row[k], min(row[k] + 1, row[k - 1] + 1, last + (c != d))
        return row[-1]

    draw = random.Random(1)
    # Lengths around the words of 64 bits, letters beyond one byte.
    left, right = (["".join(draw.choice("abé漢😀 ") for _ in range(draw.choice((0, 1, 9, 63, 64, 65, 129)))) for _ in range(n)] for n in (30, 40))
    i, j = (np.array([draw.randrange(len(x)) for _ in range(400)]) for x in (left, right))
    assert kernels.edit_distances(left, right, i, j).tolist() == [plain(left[x], right[y]) for x, y in zip(i, j, strict=True)]
    rows = spark.createDataFrame([("kitten", "sitting", 3), ("", "abc", 3), ("é", "e", 1), ("a", None, None), (None, None, None), ("kitten", "sitting", 3)], "a string, b string, n int")
    assert [r.d for r in rows.select("n", kernels.levenshtein("a", "b").alias("d")).collect()] == [3, 3, 1, None, None, 3]


def test_cosines_once_a_pair_of_names(spark):
    import math

    from tessera.operators import features as X

    names = [("a1", "red fox"), ("a2", "red fox"), ("b1", "red dog"), ("b2", "red dog"), ("b3", None), ("b4", "blue")]
    records = spark.createDataFrame(names, "id string, name_norm string")
    pairs = spark.createDataFrame([(a, b) for a in ("a1", "a2") for b in ("b1", "b2", "b3", "b4")], "s1_id string, id string")
    rare, common = math.log(6 / 3) + 1, math.log(6 / 5) + 1
    want = common**2 / (common**2 + 2 * rare**2)
    cosines = X.tfidf_cosine(pairs, records)
    got = {(r.s1_id, r.id): r.cosine for r in cosines.collect()}
    assert got == {(a, b): pytest.approx(want if b in ("b1", "b2") else 0) for a in ("a1", "a2") for b in ("b1", "b2", "b3", "b4")}
    # Vectors meet by name, not by record: no join of vectors is on a record's id.
    plan = cosines._jdf.queryExecution().optimizedPlan().toString()
    assert "a_name_norm" in plan and not any("Join" in line and "_id#" in line and "norm" not in line for line in plan.splitlines() if "_v#" in line)


def test_stratified_split_without_sorting_all_rows(spark):
    from pyspark.sql import Window as W

    # Many rows of a label, repeated keys, a label with one row, and rows without a label.
    rows = spark.range(3000).select((F.col("id") % 2900).cast("string").alias("k"), F.when(F.col("id") == 7, 2).when(F.col("id") % 11 != 0, (F.col("id") % 3 == 0).cast("int")).alias("label"))
    place = F.percent_rank().over(W.partitionBy("label").orderBy(S.drawn(F.col("k"), 42)))
    want = rows.withColumn("split", F.when(place < 0.6, "train").when(place < 0.8, "val").otherwise("test"))
    got = S.stratified_split(rows, F.col("k"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "percent_rank" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_rates_of_nothing_are_null(spark):
    s1 = spark.createDataFrame([("e1",), ("e2",)], "id string")
    none = spark.createDataFrame([], "s1_id string, id string, src long")
    true = spark.createDataFrame([("e1", "x", 1)], "s1_id string, id string, src long")
    assert tuple(M.macro(s1, none, true).head()) == (0.5, None, 0.0, 1, 0.0)
    assert tuple(M.macro(s1, true.select("s1_id", "id"), none).head()) == (0.5, 0.0, None, 1, 0.5)
    got = M.run_score(s1, none, none, none).head()
    assert (got.f05_macro, got.precision, got.recall, got.recall_ceiling) == (1.0, None, None, None)
    table = spark.createDataFrame([], "match_status string, candidate_count long")
    assert D.run_report(table).head().match_rate is None


def test_fallback_pairs_where_they_meet(spark):
    import bisect

    # Several blocks of places, equal names on both sides, and places at both ends.
    s1 = frame(spark, [(f"S1-{k:03d}", 0, f"{'Acme' if k < 90 else 'Zenith'} {chr(97 + k * 7 % 26)}{k * 13 % 50}") for k in range(180)])
    others = frame(spark, [(f"S2-{k}", 1, f"{('Aaron', 'Acme', 'Zenith', 'Zz')[k % 4]} {chr(97 + k * 5 % 26)}{k % 50}") for k in range(60)])
    order = sorted((r.name_core, r.id) for r in s1.collect())
    want = set()
    for r in others.collect():
        low = bisect.bisect_left(order, (r.name_core,))
        want |= {(order[p][1], r.id, p - low) for p in range(max(0, low - 15), min(len(order), low + 16))}
    near = B.neighborhood(s1, others, 15, ("address",))
    got = [(r.s1_id, r.id, r.gap) for r in near.where("a_address IS NOT NULL AND b_address IS NOT NULL").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    # Pairs are made after the last shuffle, and none of them is sorted or shuffled again.
    plan = B.fallback_pairs(s1, others, B.Blocking(), ("address",))._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Window" in x or "Aggregate" in x for x in plan[: plan.index("Join")].splitlines())
    # Records without a pair are told by their keys alone.
    cfg = B.Blocking(rules=B.PREFIX | B.TOKEN | B.PHONETIC, df_ratio=0.02, max_bucket=60)
    lost = others.join(B.pairs(s1, others, cfg).select("id").distinct(), "id", "left_anti")
    assert sorted(r.id for r in B.without_pairs(s1, others, cfg).collect()) == sorted(r.id for r in lost.collect()) != []


def test_synthetic_linkage_scores_where_pairs_meet(spark):
    from tessera import catalog
    from tessera.operators import features as X
    from tessera.sources import synth
    from tessera.sources.staging import stage

    clean = stage(B.clean(synth.generate(spark, 150)[0]))
    cfg = B.Blocking(df_ratio=0.05, max_bucket=4, cap=5)
    s1, others = clean.where("src = 0"), clean.where("src > 0")
    first = stage(B.capped(B.pairs(s1, others, cfg), cfg.cap))
    every = first.select("s1_id", "src", "id", "mask").unionByName(B.fallback(s1, others, first, cfg))
    pairs = X.composite(X.entity_features(every, s1, others)).withColumn("score", F.col("weighted_composite_score"))
    want = D.decisions(pairs, D.Decision()).where("match_status = 'matched'").select("matched_s1_id", "id")
    got = catalog.linked(clean, cfg)[1]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_each_distinct_text_is_cleaned_once(spark):
    """Records cleaned by distinct names and addresses are those cleaned one by one: NULL, empty and repeated texts too."""
    texts = ["The Acme Shop, LLC", "N/A", "", None, "Café Ünï", "  acme  "]
    places = ["12 N Main St, Austin, TX 78701", "-", None, "", "Near City Hall, Bengaluru, Karnataka 560001"]
    data = [(f"r{k}", k % 3, texts[k % 6], places[k % 5], [None, "US", "N/A"][k % 3]) for k in range(90)]
    rows = spark.createDataFrame(data, "id string, src int, name string, address string, country string")
    once, each = B.clean_distinct(rows), B.clean(rows)
    assert once.columns == each.columns
    assert sorted(map(str, once.collect())) == sorted(map(str, each.collect())) and once.count() == 90
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2
