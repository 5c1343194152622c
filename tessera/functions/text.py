"""Scalar text functions as Column expressions: missingness, names, phones, codes, localities.

A missing value is NULL throughout; nothing here leaves the JVM.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import vocab


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str]:
    """Characters whose compatibility form without marks is one ASCII character, and those characters; then marks, which go."""
    source, target, marks = [], [], []
    for code in _coded():
        c = chr(code)
        if unicodedata.combining(c):
            marks.append(c)
            continue
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if len(plain) == 1 and plain != c and ord(plain) < 0x80:
            source.append(c)
            target.append(plain)
    return "".join(source + marks), "".join(target)


def _coded():
    """Code points beyond ASCII that may have a compatibility form; later planes have ideographs and signs only."""
    return (c for a, b in ((0x80, 0xD800), (0xE000, 0x10000), (0x1D400, 0x1D800), (0x1E000, 0x20000)) for c in range(a, b))


@lru_cache(maxsize=1)
def _fold_wide() -> dict[str, str]:
    """Characters whose compatibility form has several characters with some of ASCII, like ligatures and fractions."""
    found = {}
    for code in _coded():
        plain = "".join(x for x in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(x))
        if len(plain) > 1 and any(x.isascii() and x != " " for x in plain):
            found[chr(code)] = plain
    return found


def fold(col: Column) -> Column:
    """The text without accents, in compatibility form as far as that is ASCII."""
    wide = _fold_wide()
    spelled = F.array_join(F.transform(F.split(col, ""), lambda c: F.coalesce(_table(wide)[c], c)), "")
    one = F.when(col.rlike("[" + "".join(wide) + "]"), spelled).otherwise(col)
    return F.when(F.length(col) == F.octet_length(col), col).otherwise(F.translate(one, *_fold_table()))


def blank_to_null(col: Column) -> Column:
    return F.when(col != "", col)


def squash(col: Column) -> Column:
    """Folded, lower case, all but a-z and 0-9 as single spaces."""
    return F.trim(F.regexp_replace(F.lower(fold(col)), "[^a-z0-9]+", " "))


def is_missing(col: Column) -> Column:
    return F.coalesce(F.lower(F.trim(col)).isin(*vocab.MISSING), F.lit(True))


def is_placeholder(col: Column) -> Column:
    text = squash(col)
    return is_missing(col) | text.isin(*vocab.PLACEHOLDERS) | text.startswith("unnamed") | text.startswith("unknown name")


def safe_value(col: Column) -> Column:
    """Squashed text, NULL for missing values and placeholders."""
    return F.when(~is_placeholder(col), blank_to_null(squash(col)))


def strip_trailing(col: Column, words) -> Column:
    """The text without its trailing run of ``words``."""
    single = "|".join(w for w in dict.fromkeys(words) if " " not in w)
    return F.regexp_replace(col, f"(^| )(?:(?:{single})(?: |$))+$", "")


def name_norm(raw: Column) -> Column:
    marks = "|".join(sorted(vocab.SECOND_NAME, key=len, reverse=True))
    first = F.regexp_replace(F.lower(fold(raw)), rf"(?s)\b(?:{marks})\b.*$", "")
    return F.when(~is_missing(raw), blank_to_null(squash(first)))


def name_core(norm: Column) -> Column:
    core = strip_trailing(strip_trailing(norm, vocab.LEGAL), vocab.GENERIC)
    core = F.regexp_replace(core, "^the( |$)", "")
    return F.coalesce(blank_to_null(core), norm)


def tokens(norm: Column) -> Column:
    return F.coalesce(F.filter(F.split(norm, " "), lambda t: t != ""), F.array().cast("array<string>"))


def phone(raw: Column) -> tuple[Column, Column]:
    """(ten digits, seven digits): national number and local part, NULL if it is neither."""
    cut = F.regexp_replace(F.lower(fold(raw)), r"(?:x|ext\.?|extension)\s*\d+\s*$", "")
    digits = F.regexp_replace(cut, r"\D", "")
    digits = F.when((F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)).otherwise(digits)
    known = ~is_missing(raw)
    ten = F.when(known & (F.length(digits) == 10), digits)
    seven = F.when(known & F.length(digits).isin(7, 10), F.right(digits, F.lit(7)))
    return ten, seven


def zip_codes(raw: Column) -> tuple[Column, Column]:
    digits = F.regexp_replace(raw, r"\D", "")
    five = F.when(~is_missing(raw) & (F.length(digits) >= 5), F.substring(digits, 1, 5))
    return five, F.substring(five, 1, 3)


def _table(pairs: dict[str, str]) -> Column:
    """A map literal, made of one string that the optimiser reads once."""
    return F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")


def state(raw: Column) -> Column:
    """Postal code of a state's name or code."""
    text = squash(raw)
    code = F.when(F.upper(text).isin(*sorted(set(vocab.STATES.values()))), F.upper(text))
    return F.when(~is_missing(raw), F.coalesce(_table(vocab.STATES)[text], code))


def singular(word: Column) -> Column:
    long = F.length(word) > 3
    return (
        F.when(long & word.endswith("ies"), F.regexp_replace(word, "ies$", "y"))
        .when(long & word.endswith("sses"), F.regexp_replace(word, "es$", ""))
        .when(long & word.rlike("s$") & ~word.rlike("(ss|us|is)$"), F.regexp_replace(word, "s$", ""))
        .otherwise(word)
    )


def category(raw: Column) -> Column:
    """The type that a business label means; an unknown label is its own singular."""
    text = squash(raw)
    single = F.array_join(F.transform(tokens(text), singular), " ")
    table = _table(vocab.CATEGORIES)
    return F.when(~is_missing(raw), blank_to_null(F.coalesce(table[text], table[single], single)))


def lat_lon(lat: Column, lon: Column) -> tuple[Column, Column]:
    x, y = lat.try_cast("double"), lon.try_cast("double")
    ok = x.between(-90, 90) & y.between(-180, 180)
    return F.when(ok, x), F.when(ok, y)


def has_non_latin(col: Column) -> Column:
    return F.coalesce(col.rlike("[\\u0370-\\u1cff\\u4e00-\\u9fff]"), F.lit(False))


def split_scripts(col: Column) -> tuple[Column, Column]:
    """Tokens with a Latin letter, and those with other letters only."""
    words = F.filter(F.split(F.lower(col), r"[^\p{L}\p{M}\p{N}]+"), lambda t: t != "")
    return F.filter(words, lambda t: t.rlike("[a-z]")), F.filter(words, lambda t: ~t.rlike("[a-z]") & t.rlike(r"\p{L}"))


def domain(raw: Column) -> Column:
    """Host named in a text, without ``www.``; NULL below five characters."""
    host = F.regexp_replace(F.regexp_extract(F.lower(raw), r"([a-z0-9-]+(?:\.[a-z0-9-]+)+)", 1), r"^www\.", "")
    return F.when(F.length(host) >= 5, host)


def domain_suffix(host: Column) -> Column:
    return F.array_join(F.slice(F.concat(F.array(F.lit("")), F.split(host, r"\.")), -2, 2), ".")


# --- localities -------------------------------------------------------------

_POSTCODE = r"(?: ?\b\d{4,6})+$"


def _any(words) -> str:
    return "|".join(sorted(words, key=lambda w: (-len(w), w)))


def region_code(text: Column) -> Column:
    codes = sorted(set(vocab.REGIONS.values()))
    return F.coalesce(_table(vocab.REGIONS)[text], F.when(F.upper(text).isin(*codes), F.upper(text)))


def _region_words() -> str:
    return _any({*vocab.REGIONS, *(c.lower() for c in vocab.REGIONS.values())})


def localities(raw: Column) -> Column:
    """Every part of an address that may name a place, in order; empty if there is none."""
    text = F.regexp_replace(F.lower(raw), r"\bp\.?\s*o\.?\s*box\s+\w+", " ")
    chunks = F.filter(F.split(text, ","), lambda c: F.trim(c) != "")
    flat = F.transform(chunks, lambda c: F.regexp_replace(squash(c), r"(^| )\d{4,6}( \d{4,6})*$", ""))
    last = F.size(flat) - 1
    peeled = F.transform(flat, lambda c, i: F.when(i == last, F.regexp_replace(c, f"(?:(?:^| )(?:{_region_words()}))+$", "")).otherwise(c))
    unit = _any(w for w in {*vocab.UNITS, *vocab.NOT_LOCAL} if w.isalnum())
    landmark = _any(vocab.LANDMARKS)

    def local(c: Column) -> Column:
        return (c != "") & ~c.rlike(rf"\b(?:{unit})\b") & ~c.rlike(rf"^(?:{landmark})\b") & ~c.rlike(r"^[a-z]?\s*\d+[a-z]?$") & ~c.rlike(r"^\d+(?: \d+)*$")

    return F.when(~is_placeholder(raw), F.filter(peeled, local)).otherwise(F.array().cast("array<string>"))


def primary_locality(found: Column) -> Column:
    """The last locality that is neither region nor street; else the one of most words, the first of equals."""
    words = _region_words()
    street = _any(vocab.STREET)

    def usable(c: Column) -> Column:
        size = F.size(F.split(c, " "))
        return ~c.rlike(rf"^(?:{words})$") & ~(c.rlike(r"^\d+[a-z]?( |$)") & (size <= 5)) & ~c.rlike(rf"(?:^| )(?:{street})$")

    good = F.filter(found, usable)
    most = F.array_max(F.transform(found, lambda c: F.size(F.split(c, " "))))
    longest = F.get(F.filter(found, lambda c: F.size(F.split(c, " ")) == most), F.lit(0))
    return F.when(F.size(good) > 0, F.element_at(good, -1)).otherwise(longest)


def trailing_region(raw: Column) -> Column:
    """Region code of an address's last word or two, postcodes aside."""
    text = F.regexp_replace(squash(raw), r"(^| )\d{4,6}( \d{4,6})*$", "")
    words = F.split(text, " ")
    two = F.array_join(F.slice(F.concat(F.array(F.lit(""), F.lit("")), words), -2, 2), " ")
    return F.when(~is_placeholder(raw), F.coalesce(_table(vocab.REGIONS)[two], region_code(F.element_at(words, -1))))
