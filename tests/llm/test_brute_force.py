"""The methods' own results against plain re-tellings that share no code with them."""

import hashlib
import math
import random

import numpy as np
import pytest
import xxhash

from tessera.llm import langid, licenses, lz_fingerprint

RNG = random.Random(21)


# --- op2: spans -------------------------------------------------------------


def spans_of(words):
    """Matching statistics by looking every template up at every place, then chains by the stated rule."""
    templates = [(label, licenses.words_of(t.encode())) for label, t in licenses.TEMPLATES]
    sequences = [t for _, t in templates] + [p.encode().split() for p, _ in licenses.PHRASES]

    def ends(stretch):
        n = len(stretch)
        return {(k, at + n) for k, t in enumerate(sequences) for at in range(len(t) - n + 1) if t[at : at + n] == stretch}

    longest, size = [], 0
    for i in range(len(words)):
        size += 1
        while size and not ends(words[i + 1 - size : i + 1]):
            size -= 1
        longest.append(size)
    stretches = []
    for i, n in enumerate(longest):
        if n < licenses.MIN_STRETCH:
            continue
        here = ends(words[i + 1 - n : i + 1])
        # A template that still holds the stretch one word longer goes on, others end here.
        on = {k for k, _ in ends(words[i + 1 - n : i + 2])} if i + 1 < len(words) else set()
        stretches += [(i + 1, k, stop, n) for k, stop in sorted(here) if k not in on and k < len(templates)]
    best, chains = set(), {}

    def close(k):
        first, end, _, covered = chains.pop(k)
        if covered >= licenses.MIN_COVER * len(templates[k][1]):
            best.add((templates[k][0], first, end, covered / len(templates[k][1])))

    for end, k, stop, n in stretches:
        if k in chains:
            first, last, reached, covered = chains[k]
            if stop - n >= reached and end - n - last <= licenses.MAX_GAP:
                chains[k] = (first, end, stop, covered + n)
                continue
            if end - n < last and n <= covered:
                continue
            close(k)
        chains[k] = (end - n, end, stop, n)
    for k in list(chains):
        close(k)
    return best


def licence_text():
    out = []
    for _ in range(RNG.randrange(1, 4)):
        words = licenses.words_of(RNG.choice(licenses.TEMPLATES)[1].encode())
        for _ in range(RNG.randrange(0, 4)):
            at = RNG.randrange(len(words))
            words[at : at + RNG.randrange(0, 2)] = [RNG.choice([b"the", b"other", b"license", b"software"])]
        out += [RNG.choice([b"some", b"the", b"of", b"cc", b"by"]) for _ in range(RNG.randrange(0, 5))] + words[: RNG.randrange(len(words) // 2, len(words) + 1)]
    return out


def test_license_spans_against_brute_force():
    own = licenses.Scanner()
    found = 0
    for _ in range(60):
        words = licence_text()
        got = set(own.scan(words)[1])
        assert got == spans_of(words), b" ".join(words)
        found += len(got)
    assert found > 30


def test_license_labels_and_score(spark):
    texts = [b" ".join(licence_text()).decode() for _ in range(12)] + ["cc by", "nothing here", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.digest(licenses.scan(docs)).collect():
        spans = spans_of(licenses.words_of(texts[r.doc_id].encode()))
        base = set(filter(None, r.base_labels.split(",")))
        assert set(filter(None, r.labels.split(","))) == base | {s[0] for s in spans}
        assert r.score == pytest.approx(1.0 if base else max((s[3] for s in spans), default=0.0))


# --- op6: expectation-maximisation ------------------------------------------


def plain_prediction(counts, languages, grams):
    """The same inference with lists and loops."""
    if not grams:
        return "und", 0.0
    total = [sum(row[k] + 0.5 for row in counts) for k in range(len(languages))]

    def chance(g, k):
        return (counts[g][k] + 0.5) / total[k]

    def fit(chosen):
        part = [1 / len(chosen)] * len(chosen)
        size = sum(grams.values())
        for _ in range(langid.STEPS):
            new = [0.0] * len(chosen)
            for g, w in grams.items():
                mix = sum(p * chance(g, k) for p, k in zip(part, chosen, strict=True))
                for i, k in enumerate(chosen):
                    new[i] += w * part[i] * chance(g, k) / mix
            part = [x / size for x in new]
        return part, sum(w * math.log(sum(p * chance(g, k) for p, k in zip(part, chosen, strict=True))) for g, w in grams.items())

    single = [sum(w * math.log(chance(g, k)) for g, w in grams.items()) for k in range(len(languages))]
    first = max(range(len(languages)), key=lambda k: single[k])
    every, _ = fit(list(range(len(languages))))
    chosen, share, best = [first], [1.0], single[first]
    penalty = langid.PENALTY * math.log(sum(grams.values()) + 1)
    for k in sorted((k for k in range(len(languages)) if k != first), key=lambda k: -every[k]):
        if every[k] < 0.02:
            break
        more, gained = fit([*chosen, k])
        if gained - best < penalty:
            break
        chosen, share, best = [*chosen, k], more, gained
    top = min(range(len(chosen)), key=lambda c: (-share[c], languages[chosen[c]]))
    return languages[chosen[top]], min(1.0, share[top])


def bucket(gram):
    """A trigram's place, in plain integers of 64 bits."""
    full = 2**64 - 1
    a, b, c = map(ord, gram)
    mix = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) & full
    mix ^= mix >> 15
    return (((mix * 0x27D4EB2F) & full) >> 12) % langid.BUCKETS


def plain_grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    line = f" {' '.join(words)} "
    out = {}
    for i in range(len(line) - 2):
        out[bucket(line[i : i + 3])] = out.get(bucket(line[i : i + 3]), 0) + 1
    return out if words else {}


def test_language_mixture_against_loops():
    alphabets = {"aa": "abcdefgh", "bb": "efghijkl", "cc": "ijklmnop"}

    def words(lang, n):
        return " ".join("".join(RNG.choice(alphabets[lang]) for _ in range(RNG.randrange(2, 7))) for _ in range(n))

    languages = sorted(alphabets)
    counts = np.zeros((langid.BUCKETS, 3), np.int64)
    for k, lang in enumerate(languages):
        for _ in range(20):
            for g, w in plain_grams(words(lang, 60)).items():
                counts[g, k] += w
    model, table = langid.Model(languages, counts), counts.tolist()
    several = 0
    for _ in range(40):
        parts = RNG.sample(languages, RNG.randrange(1, 4))
        text = ", ".join(words(x, RNG.randrange(1, 40)) for x in parts) + RNG.choice(["", " 12!", " é"])
        grams = plain_grams(text)
        assert {g: int(n) for g, n in enumerate(langid.gram_counts(text)) if n} == grams
        want = plain_prediction(table, languages, grams)
        got = model.predict(text)
        assert got[0] == want[0] and got[1] == pytest.approx(want[1], abs=1e-9)
        several += want[1] < 1
    assert several > 5


def test_pieces_of_long_texts_count_alike(monkeypatch):
    text = " ".join("".join(RNG.choice("abcΣσéß ,.") for _ in range(RNG.randrange(1, 9))) for _ in range(3000))
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "PIECE", 97)
    assert (langid.gram_counts(text) == whole).all()


def test_letters_of_every_plane():
    for text in ("\U000313a0\U000313a1", "\U00020000", "ö"):
        assert langid.gram_counts(text).sum() > 0
    assert langid.gram_counts("12 !? \U0001f600").sum() == 0


# --- op10: phrases ----------------------------------------------------------


def plain_fingerprint(text):
    """Phrases as tuples of word pieces: the longest one met before and one piece more; their hashes from the definition."""
    pieces = [w[i : i + 16] for w in text.encode().split() for i in range(0, len(w), 16)]
    known, current = set(), ()
    for p in pieces:
        current += (p,)
        if current not in known:
            known.add(current)
            current = ()
    full, out = 2**64 - 1, set()
    for phrase in known:
        h = 0
        for p in phrase:
            h = (h * 0x9E3779B97F4A7C15 + (xxhash.xxh64_intdigest(p) | 1)) & full
        h = ((h ^ (h >> 33)) * 0xFF51AFD7ED558CCD) & full
        out.add((h ^ (h >> 33)) >> 32)
    return sorted(out)


def plain_likeness(a, b):
    """The share of the union's least hashes that both sets have."""
    if not a or not b:
        return float(a == b)
    k = lz_fingerprint.SKETCH
    union = sorted(set(a) | set(b))
    union = union[:k] if max(len(a), len(b)) >= k else union
    return sum(x in a and x in b for x in union) / len(union)


def test_phrase_fingerprints_against_tuples(spark):
    few = ["ab", "cd", "ef", "a" * 40, "é" * 20]
    texts = [" ".join(RNG.choice(few) for _ in range(RNG.randrange(0, 300))) for _ in range(30)] + ["", None, "one", "x" * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in lz_fingerprint.edited_likeness(docs).collect()}
    k = lz_fingerprint.SKETCH
    for i, text in enumerate(texts):
        text, after = text or "", texts[i - 1] or ""
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        a, b, c = map(plain_fingerprint, (text, edited, after))
        r = got[i]
        assert r.fingerprint == "".join(f"{x:08x}" for x in a[:k]) and r.edited_fingerprint == "".join(f"{x:08x}" for x in b[:k])
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(plain_likeness(a[:k], b[:k])) and r.near_next == pytest.approx(plain_likeness(a[:k], c[:k]))
