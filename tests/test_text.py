"""Golden values of the text functions."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import address, kernels, text


def column(spark, values, make):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in rows.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


def test_names(spark):
    raw = ["The Acme Bicycle Co., LLC", "ACME BICYCLE COMPANY LLC", "Acme Bike Shop", "Cafe de Paris LLC dba Little Paris", "The Shop", "Café Ünïon GmbH"]
    assert column(spark, raw, lambda c: text.name_core(text.name_norm(c))) == ["acme bicycle", "acme bicycle", "acme bike", "cafe de paris", "the shop", "cafe union"]
    assert column(spark, raw[4:5], text.name_norm) == ["the shop"]
    assert column(spark, [None, "", "N/A", "n/a", "null", "  ", "-"], text.name_norm) == [None] * 7


@pytest.mark.parametrize(
    ("raw", "city", "state"),
    [
        ("123 N Main St, Springfield, IL 62704", "springfield", "IL"),
        ("BROWNING, 19 VAC RD, MT", "browning", "MT"),
        ("Unit APT 1, Anchorage, AK, 1350 27th Avenue", "anchorage", None),
        ("12101 State Street, Unit 146, Draper City (sl Co), UT", "draper city sl co", "UT"),
        ("Near SBI ATM, MG Road, Bengaluru, Karnataka 560001", "bengaluru", "KA"),
        ("Yadgarpally Village, Miryalguda Mandal, Survey No. 328/A/1, Miryalguda, Telangana", "miryalguda", "TG"),
        ("PO Box 42, Chicago, 60601", "chicago", None),
        ("12 Rue de la Paix, Paris", "paris", None),
    ],
)
def test_localities(spark, raw, city, state):
    rows = spark.createDataFrame([(raw,)], "v string").select(text.primary_locality(text.localities(F.col("v"))).alias("c"), text.trailing_region(F.col("v")).alias("s"))
    assert tuple(rows.head()) == (city, state)


def test_placeholders(spark):
    raw = ["", "na", "N/A", "unknown", "-", "Unnamed: 0", None]
    assert column(spark, raw, lambda c: F.size(text.localities(c))) == [0] * 7
    assert column(spark, raw, text.safe_value) == [None] * 7


def test_phones(spark):
    raw = ["(217) 555-0142", "217-555-0142", "+1 217 555 0142", "1.217.555.0142", "2175550142 x89", "555-0142", "1-800-FLOWERS"]
    assert column(spark, raw, lambda c: text.phone(c)[0]) == ["2175550142"] * 5 + [None, None]
    assert column(spark, raw, lambda c: text.phone(c)[1]) == ["5550142"] * 6 + [None]


def test_codes(spark):
    assert column(spark, ["62704-1234", "274"], lambda c: text.zip_codes(c)[0]) == ["62704", None]
    assert column(spark, ["Illinois", "il", "IL", "Ontario", "New York"], text.state) == ["IL", "IL", "IL", None, "NY"]
    assert column(spark, ["Restaurants", "Eating Places", "Auto Repair Shops", "Blue Widgets"], text.category) == ["restaurant", "restaurant", "auto", "blue widget"]


def parse(spark, *rows):
    full = [(k, *r, *[None] * (4 - len(r))) for k, r in enumerate(rows)]
    found = address.with_address(spark.createDataFrame(full, "k int, a string, c string, s string, z string"), "a", "c", "s", "z")
    return [r.parts.asDict() for r in found.orderBy("k").collect()]


def test_addresses(spark):
    raw = ("123 N Main St, Springfield, IL 62704", "123 North Main Street, Springfield, Illinois 62704", "123 N Main St Springfield IL 62704")
    for p in parse(spark, *((r,) for r in raw)):
        assert (p["house_number"], p["street_name"], p["street_suffix"], p["city"], p["state"], p["zip5"]) == ("123", "main", "street", "springfield", "IL", "62704")
    suite, elm, broadway, box = parse(spark, ("123 North Main Street Suite 200",), ("789 N Elm Rd Salt Lake City UT 84101",), ("55 Broadway, New York, NY, 10006",), ("P.O. Box 99, Denver, CO 80202",))
    assert (suite["street_name"], suite["street_suffix"], suite["unit"]) == ("main", "street", "200")
    assert (elm["street_dir"], elm["street_name"], elm["street_suffix"], elm["city"], elm["state"]) == ("n", "elm", "road", "salt lake city", "UT")
    assert (broadway["city"], broadway["state"]) == ("new york", "NY")
    assert (box["po_box"], box["city"], box["state"], box["zip5"], box["street_name"]) == ("99", "denver", "CO", "80202", None)


def test_address_forms_agree(spark):
    forms = [("123 North Main St., Ste. 200, Springfield, IL 62704",), ("123 N MAIN ST STE 200, SPRINGFIELD, IL  62704-1234",), ("123 N Main St", "Springfield", "IL", "62704"), ("123 N Main St, Springfield, Illinois 62704",)]
    found = parse(spark, *forms)
    for p in found:
        assert [p[k] for k in ("house_number", "street_name", "street_suffix", "city", "state", "zip5")] == ["123", "main", "street", "springfield", "IL", "62704"]
    assert [p["unit"] for p in found] == [None, "200", None, None]
    for p in parse(spark, (None,), ("",), ("N/A",), (",",)):
        assert p["house_number"] is None and p["address_norm"] is None


def plain_jaro_winkler(a, b):
    """Character by character: each of a takes the first free equal one of b within reach."""
    n, m = len(a), len(b)
    reach, free, left = max(0, max(n, m) // 2 - 1), [True] * m, []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(m, i + reach + 1)):
            if free[j] and b[j] == c:
                free[j] = False
                left.append(c)
                break
    k = len(left)
    if not k:
        return 0.0
    right = [c for c, f in zip(b, free, strict=True) if not f]
    half = sum(x != y for x, y in zip(left, right, strict=True)) // 2
    jaro = (k / n + k / m + (k - half) / k) / 3
    prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, n, m))
    return jaro if jaro <= 0.7 else jaro + prefix * 0.1 * (1 - jaro)


def plain_subsequence(a, b):
    """The table of the definition."""
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def plain_token_set(a, b):
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    shared, p, q = (" ".join(sorted(t)) for t in (x & y, x - y, y - x))
    if shared and (not p or not q):
        return 100.0
    whole_p, whole_q = (f"{shared} {t}" if shared else t for t in (p, q))
    gone = [(len(p) + len(q) - 2 * plain_subsequence(p, q)) / (len(whole_p) + len(whole_q))]
    if shared:
        gone += [(len(t) - len(shared)) / (len(t) + len(shared)) for t in (whole_p, whole_q)]
    return 100 * (1 - min(gone))


def test_kernels():
    assert kernels.jaro_winklers(["martha", "abc"], ["marhta", "xyz"]) == pytest.approx([0.9611, 0], abs=1e-4)
    assert kernels.token_set_ratios(["acme bicycle"], ["acme bicycle shop"]) == [100]
    assert kernels.token_sort_ratios(["b a"], ["a b"]) == [100]
    assert kernels.common_subsequence("abcbdab", "bdcaba") == 4
    assert kernels.nysiis_of("halberston mill") == kernels.nysiis_of("halberstun mill") != ""


def test_kernels_against_definitions(monkeypatch):
    monkeypatch.setattr(kernels, "CELLS", 500)
    rng = random.Random(3)
    texts = ["".join(rng.choice("abé 北\U0001f600") for _ in range(rng.choice((1, 2, 3, 8, 20, 63, 64, 65, 130)))) for _ in range(600)] + ["x", " ", "a" * 64, "ab" * 32]
    a, b = texts, [rng.choice((t, rng.choice(texts), t[1:] + "a", t[::-1])) for t in texts]
    pairs = list(zip(a, b, strict=True))
    assert kernels.jaro_winklers(a, b).tolist() == [plain_jaro_winkler(*p) for p in pairs]
    assert kernels.common_subsequences(a, b).tolist() == [plain_subsequence(*p) for p in pairs]
    assert kernels.token_set_ratios(a, b) == pytest.approx([plain_token_set(*p) for p in pairs])
    tidy = [tuple(" ".join(sorted(t.split())) for t in p) for p in pairs]
    assert kernels.token_sort_ratios(a, b) == pytest.approx([200 * plain_subsequence(x, y) / (len(x) + len(y)) if x or y else 0 for x, y in tidy])


def test_pairwise_kernels_pass_nulls(spark):
    rows = spark.createDataFrame([("a b", None), (None, None), ("", "a"), ("a b", "b a")], "a string, b string")
    got = rows.select(kernels.jaro_winkler("a", "b"), kernels.token_set_ratio("a", "b"), kernels.token_sort_ratio("a", "b")).collect()
    assert [tuple(r) for r in got[:3]] == [(None, None, None)] * 3 and got[3][1:] == (100, 100)
