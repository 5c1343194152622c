"""The linkage queries in DuckDB's SQL, built from common table expressions; written apart from the Spark plans to check them."""

from __future__ import annotations

from tessera.functions import vocab
from tessera.plans.views import LINES, RECORDS


def listed(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def either(words) -> str:
    return "|".join(sorted(words, key=lambda w: (-len(w), w)))


def sq(x: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents({x})), '[^a-z0-9]+', ' ', 'g'))"


def missing(x: str) -> str:
    return f"coalesce(lower(trim({x})) IN ({listed(vocab.MISSING)}), true)"


def placeholder(x: str) -> str:
    return f"({missing(x)} OR {sq(x)} IN ({listed(vocab.PLACEHOLDERS)}) OR starts_with({sq(x)}, 'unnamed') OR starts_with({sq(x)}, 'unknown name'))"


def name_norm(x: str) -> str:
    return rf"CASE WHEN NOT {missing(x)} THEN nullif({sq(rf"regexp_replace(lower(strip_accents({x})), '\b(?:{either(vocab.SECOND_NAME)})\b.*$', '', 's')")}, '') END"


def _tail(x: str, words) -> str:
    return f"regexp_replace({x}, '(^| )(?:(?:{'|'.join(w for w in words if ' ' not in w)})(?: |$))+$', '')"


def name_core(x: str) -> str:
    return f"coalesce(nullif(regexp_replace({_tail(_tail(x, vocab.LEGAL), vocab.GENERIC)}, '^the( |$)', ''), ''), {x})"


def cased(x: str, table: dict[str, str]) -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + " END"


def soundex(x: str) -> str:
    """Soundex of the first Latin token, as the classic code has it: H and W do not part equal sounds."""
    word = f"upper(regexp_extract({x}, '([a-z]+)', 1))"
    codes = "01230127022455012623017202"
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    run = f"(replace(translate(left({word}, 1), '{letters}', '{codes}'), '7', '0') || replace(translate(substring({word}, 2), '{letters}', '{codes}'), '7', ''))"
    for d in "0123456":
        run = f"regexp_replace({run}, '{d}+', '{d}', 'g')"
    return f"CASE WHEN {word} <> '' THEN left({word}, 1) || left(replace(substring({run}, 2), '0', '') || '000', 3) END"


REGION_WORDS = either({*vocab.REGIONS, *(c.lower() for c in vocab.REGIONS.values())})
UNIT_WORDS = either(w for w in {*vocab.UNITS, *vocab.NOT_LOCAL} if w.isalnum())
POST = r"(^| )\d{4,6}( \d{4,6})*$"
NO_WORDS = "CAST([] AS VARCHAR[])"


def region(x: str) -> str:
    codes = listed(sorted(set(vocab.REGIONS.values())))
    return f"coalesce({cased(x, vocab.REGIONS)}, CASE WHEN upper({x}) IN ({codes}) THEN upper({x}) END)"


CTE: dict[str, str] = {
    "rec": RECORDS,
    "line": LINES,
    "named": f"SELECT *, {name_norm('name')} AS name_norm FROM rec",
    "chunked": rf"""SELECT *, {name_core('name_norm')} AS name_core, coalesce(list_filter(string_split(name_norm, ' '), lambda t: t <> ''), {NO_WORDS}) AS tokens,
        CASE WHEN NOT {placeholder('country')} THEN nullif({sq('country')}, '') END AS country_norm,
        CASE WHEN NOT {missing('address')} THEN nullif({sq('address')}, '') END AS address_norm,
        regexp_replace({sq('address')}, '{POST}', '') AS tail,
        list_transform(list_filter(string_split(regexp_replace(lower(address), '\bp\.?\s*o\.?\s*box\s+\w+', ' ', 'g'), ','), lambda c: trim(c) <> ''),
            lambda c: regexp_replace({sq('c')}, '{POST}', '')) AS flat FROM named""",
    "local": rf"""SELECT * EXCLUDE (flat, tail),
        CASE WHEN {placeholder('address')} THEN {NO_WORDS} ELSE list_filter(
            list_transform(flat, lambda c, i: CASE WHEN i = len(flat) THEN regexp_replace(c, '(?:(?:^| )(?:{REGION_WORDS}))+$', '') ELSE c END),
            lambda c: c <> '' AND NOT regexp_matches(c, '\b(?:{UNIT_WORDS})\b') AND NOT regexp_matches(c, '^(?:{either(vocab.LANDMARKS)})\b')
              AND NOT regexp_matches(c, '^[a-z]?\s*\d+[a-z]?$') AND NOT regexp_matches(c, '^\d+(?: \d+)*$')) END AS localities,
        CASE WHEN NOT {placeholder('address')} THEN coalesce({cased("array_to_string(list_slice(string_split(tail, ' '), -2, -1), ' ')", vocab.REGIONS)}, {region("string_split(tail, ' ')[-1]")}) END AS state_norm
        FROM chunked""",
    "clean": rf"""SELECT *, CASE WHEN len(good) > 0 THEN good[-1] ELSE
          list_filter(localities, lambda c: len(string_split(c, ' ')) = list_max(list_transform(localities, lambda d: len(string_split(d, ' ')))))[1] END AS city_norm
        FROM (SELECT *, list_filter(localities, lambda c: NOT regexp_matches(c, '^(?:{REGION_WORDS})$')
          AND NOT (regexp_matches(c, '^\d+[a-z]?( |$)') AND len(string_split(c, ' ')) <= 5) AND NOT regexp_matches(c, '(?:^| )(?:{either(vocab.STREET)})$')) AS good FROM local)""",
    "s1": "SELECT * FROM clean WHERE src = 0",
    "oth": "SELECT * FROM clean WHERE src > 0",
    "truth": "SELECT a.id AS s1_id, b.id, b.src FROM rec a JOIN rec b ON a.true_name = b.true_name AND a.country = b.country AND a.true_type = b.true_type WHERE a.src = 0 AND b.src > 0",
    "df": "SELECT token, count(*) AS df FROM (SELECT unnest(list_distinct(tokens)) AS token FROM s1) GROUP BY token",
    "rare": "SELECT token, df FROM df WHERE df <= (SELECT least(greatest(2, floor({ratio} * count(*))), {most}) FROM s1)",
    "allkeys": """SELECT 1::BIGINT AS bit, country_norm || '|' || substring(name_core, 1, 8) AS key, id, src FROM clean
        UNION ALL SELECT 2, country_norm || '|' || city_norm || '|' || substring(name_core, 1, 8), id, src FROM clean
        UNION ALL SELECT 4, concat_ws('|', country_norm, token), id, src FROM (SELECT id, src, country_norm, unnest(list_distinct(list_filter(tokens, lambda t: length(t) >= 3))) AS token FROM clean)
          WHERE src > 0 OR token IN (SELECT token FROM rare)""",
    "keys": "SELECT bit, key, id, src FROM allkeys WHERE key IS NOT NULL",
    "cool": "SELECT bit, key, id FROM (SELECT *, count(*) OVER (PARTITION BY bit, key) AS n FROM keys WHERE src = 0) WHERE n <= {bucket}",
    "found": """SELECT a.id AS s1_id, b.src, b.id, bit_or(a.bit)::BIGINT AS mask, count(CASE WHEN a.bit = 4 THEN 1 END) AS token_hits
        FROM cool a JOIN keys b ON a.bit = b.bit AND a.key = b.key WHERE b.src > 0 GROUP BY ALL""",
    "kept": """SELECT * EXCLUDE place FROM (SELECT *, row_number() OVER (PARTITION BY src, id ORDER BY bit_count(mask) DESC,
        CASE WHEN mask & 2 <> 0 THEN 0 WHEN mask & 1 <> 0 THEN 1 WHEN mask & 4 <> 0 THEN 3 ELSE 99 END, s1_id) AS place FROM found) WHERE place <= {cap}""",
    "light": """SELECT f.s1_id, f.src, f.id, f.mask,
        1 - levenshtein(a.name_core, b.name_core) / greatest(length(a.name_core), length(b.name_core)) AS name_levenshtein_ratio,
        CASE WHEN len(a.tokens) > 0 AND len(b.tokens) > 0 THEN len(list_intersect(a.tokens, b.tokens)) / least(len(list_distinct(a.tokens)), len(list_distinct(b.tokens))) END AS name_token_overlap_ratio,
        1 - levenshtein(a.address_norm, b.address_norm) / greatest(length(a.address_norm), length(b.address_norm)) AS address_levenshtein_ratio,
        CASE WHEN len(a.localities) > 0 AND len(b.localities) > 0 THEN list_has_any(a.localities, b.localities)::DOUBLE END AS city_exact,
        1 - levenshtein(a.city_norm, b.city_norm) / greatest(length(a.city_norm), length(b.city_norm)) AS city_similarity,
        (a.state_norm = b.state_norm)::DOUBLE AS state_exact, (a.country_norm = b.country_norm)::DOUBLE AS country_exact
        FROM kept f JOIN s1 a ON f.s1_id = a.id JOIN oth b ON f.id = b.id""",
    "grouped": """SELECT *, list_avg([name_levenshtein_ratio, name_token_overlap_ratio]) AS wcs_name, address_levenshtein_ratio AS wcs_address,
        list_avg([city_exact, city_similarity, state_exact]) AS wcs_city_state, country_exact AS wcs_country FROM light""",
    "scored": """SELECT *, round((coalesce(0.45 * wcs_name, 0) + coalesce(0.30 * wcs_address, 0) + coalesce(0.15 * wcs_city_state, 0) + coalesce(0.10 * wcs_country, 0))
        / (CASE WHEN wcs_name IS NULL THEN 0 ELSE 0.45::DOUBLE END + CASE WHEN wcs_address IS NULL THEN 0 ELSE 0.30::DOUBLE END + CASE WHEN wcs_city_state IS NULL THEN 0 ELSE 0.15::DOUBLE END
           + CASE WHEN wcs_country IS NULL THEN 0 ELSE 0.10::DOUBLE END), 6) AS score FROM grouped""",
    "labelled": "SELECT s.*, (t.id IS NOT NULL)::INT AS label FROM scored s LEFT JOIN truth t ON s.s1_id = t.s1_id AND s.id = t.id",
    "ranked": "SELECT *, row_number() OVER (PARTITION BY src, id ORDER BY score DESC NULLS LAST, s1_id) AS place, count(*) OVER (PARTITION BY src, id) AS n FROM scored",
    "decided": """SELECT src, id, matched_s1_id, probability, second_s1_id, second_probability, n_scored_candidates,
          CASE WHEN amb THEN 'ambiguous' WHEN vc OR vl THEN 'manual_review' WHEN probability >= {high} THEN 'matched' WHEN probability >= {low} THEN 'manual_review' ELSE 'unmatched' END AS match_status,
          CASE WHEN amb THEN printf('ambiguous:second_best_within_margin(%.4f<={margin})', probability - second_probability) WHEN vc THEN 'veto:country_conflict' WHEN vl THEN 'veto:city_or_state_conflict' ELSE '' END AS decision_notes
        FROM (SELECT *, hi AND NOT amb AND coalesce(country_exact = 0, false) AS vc,
            hi AND NOT amb AND NOT coalesce(country_exact = 0, false) AND (coalesce(city_exact = 0, false) AND coalesce(city_similarity, 1) < {floor} OR coalesce(state_exact = 0, false) AND false) AS vl
          FROM (SELECT *, probability >= {high} AS hi, coalesce(probability >= {high} AND probability - second_probability <= {margin} AND second_probability >= 0, false) AS amb
            FROM (SELECT a.src, a.id, a.s1_id AS matched_s1_id, a.score AS probability, b.s1_id AS second_s1_id, b.score AS second_probability, a.n AS n_scored_candidates, a.country_exact, a.city_exact, a.city_similarity, a.state_exact
                  FROM ranked a LEFT JOIN ranked b ON a.src = b.src AND a.id = b.id AND b.place = 2 WHERE a.place = 1)))""",
    "status": """SELECT o.id, o.src, coalesce(n, 0) AS candidate_count,
        coalesce(nullif(concat_ws('|', CASE WHEN m & 1 <> 0 THEN 'country_prefix' END, CASE WHEN m & 2 <> 0 THEN 'country_city_prefix' END, CASE WHEN m & 4 <> 0 THEN 'shared_token' END), ''), 'none') AS reasons,
        CASE WHEN n > 0 THEN 'resolved' ELSE 'unresolved' END AS status
        FROM oth o LEFT JOIN (SELECT id, count(*) AS n, bit_or(mask) AS m FROM kept GROUP BY id) k ON o.id = k.id""",
    "record": """SELECT s.src, s.id, coalesce(match_status, 'unmatched') AS match_status, matched_s1_id, probability, second_s1_id, second_probability, candidate_count, reasons,
        concat_ws(';', nullif(CASE WHEN match_status IS NULL THEN 'no_candidate_pairs' ELSE decision_notes END, ''), status) AS notes
        FROM status s LEFT JOIN decided d ON s.src = d.src AND s.id = d.id""",
    "matched": "SELECT matched_s1_id AS s1_id, src, id FROM decided WHERE match_status = 'matched'",
    "tally": """SELECT e.id AS s1_id, coalesce(tp, 0) AS tp, coalesce(n_pred, 0) AS n_pred, coalesce(n_true, 0) AS n_true FROM s1 e LEFT JOIN (
        SELECT coalesce(p.s1_id, t.s1_id) AS s1_id, count(CASE WHEN p.id IS NOT NULL AND t.id IS NOT NULL THEN 1 END) AS tp, count(p.id) AS n_pred, count(t.id) AS n_true
        FROM matched p FULL JOIN (SELECT DISTINCT s1_id, id FROM truth) t ON p.s1_id = t.s1_id AND p.id = t.id GROUP BY 1) x ON e.id = x.s1_id""",
    "grid": "SELECT k AS cell, 0.1 + k * 0.05::DOUBLE AS t FROM range(17) g(k)",
    "swept": """SELECT round(t, 4) AS threshold, tp, fp, fn, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
        round(CASE WHEN tp + fp = 0 AND tp + fn = 0 THEN 1 WHEN tp = 0 THEN 0 ELSE 1.25 * (tp / (tp + fp)) * (tp / (tp + fn)) / (0.25 * (tp / (tp + fp)) + tp / (tp + fn)) END, 6) AS f05
        FROM (SELECT cell, t, count(CASE WHEN hit AND label = 1 THEN 1 END) AS tp, count(CASE WHEN hit AND label = 0 THEN 1 END) AS fp, count(CASE WHEN NOT hit AND label = 1 THEN 1 END) AS fn
          FROM (SELECT cell, t, label, floor((score - 0.1::DOUBLE) / 0.05::DOUBLE + 1e-9) >= cell AS hit FROM labelled, grid) GROUP BY cell, t)""",
    "benchrec": rf"""SELECT *, CASE WHEN NOT {missing('phone')} THEN d END AS digits FROM (SELECT *, {name_core('name_norm')} AS name_core, coalesce(list_filter(string_split(name_norm, ' '), lambda t: t <> ''), {NO_WORDS}) AS tokens,
        CASE WHEN length(d0) = 11 AND starts_with(d0, '1') THEN substring(d0, 2, 10) ELSE d0 END AS d FROM
        (SELECT *, regexp_replace(regexp_replace(lower(phone), '(?:x|ext\.?|extension)\s*\d+\s*$', ''), '\D', '', 'g') AS d0 FROM named))""",
    "fields": rf"""SELECT * , CASE WHEN length(digits) = 10 THEN digits END AS phone10, CASE WHEN length(digits) IN (7, 10) THEN right(digits, 7) END AS phone7,
        CASE WHEN NOT {missing('zip')} AND length(regexp_replace(zip, '\D', '', 'g')) >= 5 THEN substring(regexp_replace(zip, '\D', '', 'g'), 1, 5) END AS zip5 FROM benchrec""",
    "benchkeys": """SELECT * FROM (SELECT 1::BIGINT AS bit, phone10 AS key, id, src FROM fields UNION ALL SELECT 2, zip5, id, src FROM fields
        UNION ALL SELECT 4, substring(zip5, 1, 3) || '|' || substring(name_core, 1, 3), id, src FROM fields UNION ALL SELECT 8, {soundex_core}, id, src FROM fields UNION ALL SELECT 16, substring(name_core, 1, 4), id, src FROM fields
        UNION ALL SELECT 32, round_even(lat / 0.02, 0)::BIGINT::VARCHAR || '|' || round_even(lon / 0.02, 0)::BIGINT::VARCHAR, id, src FROM fields
        UNION ALL SELECT 64, unnest(list_distinct(tokens)), id, src FROM fields) WHERE key IS NOT NULL""",
}

CTE["benchkeys"] = CTE["benchkeys"].replace("{soundex_core}", soundex("name_core"))
CTE["benchfound"] = """SELECT a.id AS s1_id, b.id, b.src, bit_or(a.bit)::BIGINT AS mask FROM benchkeys a JOIN (SELECT *, count(*) OVER (PARTITION BY bit, key) AS n FROM benchkeys WHERE src > 0) b
        ON a.bit = b.bit AND a.key = b.key WHERE a.src = 0 AND b.n <= 40 GROUP BY ALL"""

#: What each expression reads.
NEEDS = {name: [other for other in CTE if other != name and any(f"{word} {other}{end}" in sql.replace("\n", " ") + " " for word in ("FROM", "JOIN", ",") for end in (" ", ")", ","))] for name, sql in CTE.items()}

#: The harness's parameters, as the test tables' sizes call for.
PARAMETERS = {"ratio": "0.14::DOUBLE", "most": "400", "bucket": "400", "cap": "100", "rule_cap": "40", "high": "0.85", "low": "0.51", "margin": "0.05", "floor": "0.8"}


def query(final: str, *tables: str, **changed: str) -> str:
    """``final`` after the expressions it needs, in order of need."""
    order: list[str] = []

    def need(name: str) -> None:
        if name not in order:
            for other in NEEDS[name]:
                need(other)
            order.append(name)

    for t in tables:
        need(t)
    values = PARAMETERS | changed

    def filled(sql: str) -> str:
        for k, v in values.items():
            sql = sql.replace("{" + k + "}", v)
        return sql

    if not order:
        return filled(final)
    return "WITH " + ",\n".join(f"{n} AS ({filled(CTE[n])})" for n in order) + "\n" + filled(final)
