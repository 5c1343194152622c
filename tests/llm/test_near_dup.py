"""Links that the likely ones leave out."""

import random

from tessera.llm import near_dup


def family(rng, variants, words=204, edits=3):
    """A text and copies of it with a few words changed: near the text, most of them not near each other."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = [" ".join(base)]
    for k in range(variants):
        copy = list(base)
        for at in rng.sample(range(5, words - 5), edits):
            copy[at] = f"v{k}x{at}"
        out.append(" ".join(copy))
    return out


def kept(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id for r in near_dup.deduplicated(docs).collect()}


def test_family_of_copies(spark):
    assert kept(spark, family(random.Random(3), 150)) == {0}


def test_hot_family(spark, monkeypatch):
    monkeypatch.setattr(near_dup.likely_links, "__defaults__", (near_dup.RADIUS, 16))
    monkeypatch.setattr(near_dup.missing_links, "__defaults__", (16,))
    assert kept(spark, family(random.Random(4), 100)) == {0}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def classes(sets):
    label = list(range(len(sets)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return {find(i) for i in range(len(sets))}


def test_chains_of_edits_against_all_pairs(spark):
    """Groups of eight texts with 0.5 to 3 % of the words changed: one of each true component stays."""
    rng = random.Random(9)
    texts = []
    for _ in range(60):
        words = [f"w{rng.randrange(10**5)}" for _ in range(rng.randrange(100, 300))]
        for _ in range(8):
            texts.append(" ".join(words))
            words = list(words)
            for at in rng.sample(range(len(words)), max(1, int(len(words) * rng.uniform(0.005, 0.03)))):
                words[at] = f"x{rng.randrange(10**5)}"
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    assert kept(spark, texts) == classes(sets)


def test_recall_of_queries_against_all_rows(spark):
    """Rows whose id 100 divides, against all rows of the table, by brute force: every near pair shares a component."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = {r.node: r.component for r in near_dup.surplus(docs).select("node", "component").collect()}
    rows = [(r.doc_id, r.node, r.text or "") for r in docs.withColumn("node", near_dup.node(docs.text)).collect()]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, _, t in rows:
        w = t.translate(lower).encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    pairs = hits = 0
    for i, (doc, a, _) in enumerate(rows):
        if doc % 100 == 0:
            for j, (_, b, _) in enumerate(rows):
                if i != j and jaccard(sets[i], sets[j]) >= 0.8:
                    pairs += 1
                    hits += a == b or (a in found and found[a] == found.get(b))
    assert pairs and hits == pairs


def test_short_texts(spark):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(8)) for _ in range(200)]
    assert kept(spark, [x for t in texts for x in (t, f"{t} more")]) == set(range(0, 400, 2))
