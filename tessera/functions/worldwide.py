"""Names and addresses of any script and country, as Column expressions. Marks of other scripts are kept."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import text

# Trailing legal words (US and UK, France, India), in their given order.
LEGAL = (
    "llc", "inc", "incorporated", "corp", "corporation", "co", "company", "ltd", "limited", "lp", "llp", "plc", "pc", "pa", "lc",
    "sarl", "sas", "sasu", "eurl", "snc", "scs", "scop", "sa", "gi",
    "pvt", "private", "enterprises", "traders", "industries", "expo", "agency", "agencies", "store", "stores", "shop", "mart", "resto", "restos",
)
# Generic words, in their given order.
GENERIC = (
    "group", "holdings", "enterprises", "ventures", "partners", "services", "service", "systems", "supply", "supplies", "solutions", "international",
    "worldwide", "global", "national", "company", "co", "and", "the", "of", "business", "center", "centre", "bureau", "agency", "works", "house",
)
# Marks of a second name.
SECOND_NAME = ("dba", "d b a", "aka", "a k a", "fka", "f k a")
# Street words and their long form, in their given order.
STREET = {
    "st": "street", "str": "street", "street": "street", "ave": "avenue", "av": "avenue", "aven": "avenue", "avenue": "avenue",
    "rd": "road", "road": "road", "blvd": "boulevard", "boulevard": "boulevard", "blv": "boulevard", "dr": "drive", "drive": "drive",
    "ln": "lane", "lane": "lane", "ct": "court", "court": "court", "pl": "place", "place": "place", "way": "way", "hwy": "highway",
    "highway": "highway", "pkwy": "parkway", "parkway": "parkway", "r": "rue", "rue": "rue", "bd": "boulevard", "imp": "impasse",
    "allee": "allee", "chem": "chemin", "quai": "quai", "cours": "cours", "square": "square", "sq": "square", "villa": "villa",
    "cite": "cite", "cit": "cite",
}
# Words before a unit, in their given order.
UNITS = ("apt", "apartment", "ste", "suite", "unit", "rm", "room", "fl", "floor", "bldg", "building", "lot", "no", "num", "dept", "trlr", "flat", "door", "hno", "shop", "grd", "ground", "first", "second", "third")
# Words that name no place, in their given order.
SCAFFOLD = (
    "near", "opp", "opposite", "behind", "beside", "next", "adjacent", "cross", "road", "street", "avenue", "floor", "flat", "door", "no", "towards",
    "landmark", "building", "sector", "phase", "block", "plot", "house", "the", "and", "of", "at", "by", "in", "new", "old", "via",
)

#: Blocks of marks that are accents of Latin, Greek and Cyrillic letters; other scripts' signs stay.
MARKS = ((0x0300, 0x0370), (0x1AB0, 0x1B00), (0x1DC0, 0x1E00), (0x20D0, 0x2100), (0xFE20, 0xFE30))


@lru_cache(maxsize=1)
def _table() -> tuple[str, str]:
    accents = {c for a, b in MARKS for c in range(a, b)}
    source, target = [], []
    for code in range(0xA0, 0x2000):
        plain = [x for x in unicodedata.normalize("NFKD", chr(code)) if ord(x) not in accents]
        if code not in accents and len(plain) == 1 and plain[0] != chr(code):
            source.append(chr(code))
            target.append(plain[0])
    return "".join(source) + "".join(map(chr, sorted(accents))), "".join(target)


def fold(col: Column) -> Column:
    return F.when(F.length(col) == F.octet_length(col), col).otherwise(F.translate(col, *_table()))


def squash(col: Column) -> Column:
    """Folded, lower case, all but letters, marks and digits of any script as single spaces."""
    return F.trim(F.regexp_replace(F.lower(fold(col)), r"[^\p{L}\p{M}\p{N}]+", " "))


def name(raw: Column) -> tuple[Column, Column, Column, Column]:
    """(norm, core, Latin tokens, tokens of other scripts) of a name in any script."""
    first = F.regexp_replace(F.lower(fold(raw)), rf"(?s)\b(?:{'|'.join(sorted(SECOND_NAME, key=len, reverse=True))})\b.*$", "")
    norm = F.when(~text.is_missing(raw), text.blank_to_null(squash(first)))
    core = text.strip_trailing(text.strip_trailing(norm, LEGAL), GENERIC)
    return norm, F.coalesce(text.blank_to_null(core), norm), *text.split_scripts(norm)


def address(raw: Column) -> dict[str, Column]:
    """zip, number, street_core, city and region of an address of any country."""
    words = text.tokens(squash(raw))
    chunks = F.filter(F.transform(F.split(raw, ","), squash), lambda c: c != "")
    first_zip = F.get(F.filter(words, lambda t: t.rlike(r"^\d{5,6}$")), F.lit(0))
    head = F.split(F.get(chunks, F.lit(0)), " ")
    long = F.create_map(*(F.lit(x) for kv in STREET.items() for x in kv))
    plain = F.filter(head, lambda t: ~t.isin(*SCAFFOLD))
    street = F.transform(F.filter(plain, lambda t: ~t.isin(*UNITS)), lambda t: F.coalesce(long[t], t))
    street = F.slice(F.when(F.size(street) > 0, street).otherwise(plain), 1, 6)
    tail = F.slice(chunks, 2, 1000)
    inner = F.filter(F.slice(chunks, 2, 1000), lambda c, i: (i < F.size(chunks) - 2) & (F.coalesce(F.array_contains(F.split(c, " "), first_zip), F.lit(False)) | (F.size(F.split(c, " ")) <= 2)))
    others = F.filter(words, lambda t: first_zip.isNull() | (t != first_zip))

    def last(col: Column) -> Column:
        return F.when(F.size(col) > 0, F.element_at(col, -1))

    return {
        "zip": first_zip,
        "number": F.when(F.get(words, F.lit(0)).rlike(r"^\d+[a-z]?$"), F.get(words, F.lit(0))),
        "street_core": F.when(F.size(street) > 0, F.array_join(street, " ")),
        "city": F.when(F.size(tail) > 0, F.element_at(tail, -1)).otherwise(last(others)),
        "region": last(inner),
    }
