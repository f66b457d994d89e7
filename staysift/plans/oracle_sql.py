"""DuckDB SQL for the correctness oracle.

Each registered query has an independent DuckDB formulation here. The helpers
below build DuckDB expressions (RE2 regexes, list lambdas, ``QUALIFY``) for the
same semantics the Spark column expressions implement; the fixture SQL is shared
with Spark (see ``fixtures.py``). Float outputs are rounded to a relative binary grid (about 9 significant
digits) with the same exact formula on both sides.
"""

from __future__ import annotations

import math

from staysift.functions.text import FACILITY_KEYWORDS, STAR_WORDS, STRICT_STAR_LABELS
from staysift.plans.fixtures import COUNTRY_DIM_SQL, GAZETTEER_RAW_SQL, LISTINGS_RAW_SQL

WS = r"[\t\n\x0B\f\r\x{85}\p{Z}]"


def rnd(e: str, digits: int = 6) -> str:
    bits = math.ceil(digits * math.log2(10)) + 10
    x = f"({e})"
    scale = f"pow(2.0, {bits - 1} - floor(log2(abs({x}))))"
    return (f"(CASE WHEN {x} = 0 OR isnan({x}) OR isinf({x}) THEN {x} "
            f"ELSE floor({x} * {scale} + 0.5) / {scale} END)")


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^{WS}+|{WS}+$', '', 'g')"


def squish(e: str) -> str:
    return strip(f"regexp_replace({e}, '{WS}+', ' ', 'g')")


def missing(e: str) -> str:
    return f"({e} IS NULL OR {strip(e)} = '' OR lower({strip(e)}) = 'nan')"


def tidy(e: str) -> str:
    return f"(CASE WHEN {missing(e)} THEN '' ELSE upper({strip(e)}) END)"


def city_key(e: str) -> str:
    s = f"lower({strip(f'coalesce({e}, {chr(39)}{chr(39)})')})"
    s = f"regexp_replace({s}, '{WS}+', ' ', 'g')"
    s = f"regexp_replace({s}, '[^a-z0-9\\t\\n\\x0B\\f\\r\\x{{85}}\\p{{Z}}-]', '', 'g')"
    return squish(s)


def number(e: str) -> str:
    s = strip(e)
    return (
        f"(CASE WHEN regexp_matches({s}, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') "
        f"OR regexp_matches(lower({s}), '^[+-]?inf(inity)?$') THEN TRY_CAST({s} AS DOUBLE) END)"
    )


def star(e: str) -> str:
    words = " ".join(f"WHEN '{k}' THEN {v}" for k, v in STAR_WORDS.items())
    s = strip(e)
    word = f"(CASE lower(regexp_replace({s}, '{WS}+', '', 'g')) {words} END)"
    dig = f"TRY_CAST(regexp_extract({s}, '(?i)([0-9]){WS}*star', 1) AS INTEGER)"
    return f"(CASE WHEN {missing(e)} THEN NULL ELSE coalesce({word}, CASE WHEN {dig} BETWEEN 1 AND 5 THEN {dig} END) END)"


def strict_star(e: str) -> str:
    words = " ".join(f"WHEN '{k}' THEN {v}" for k, v in STRICT_STAR_LABELS.items())
    return f"CAST((CASE {e} {words} END) AS INTEGER)"


def lat_lon(e: str) -> tuple[str, str]:
    s = strip(f"coalesce({e}, '')")
    p0 = f"(CASE WHEN strpos({s}, '|') > 0 THEN substr({s}, 1, strpos({s}, '|') - 1) ELSE {s} END)"
    p1 = f"(CASE WHEN strpos({s}, '|') > 0 THEN substr({s}, strpos({s}, '|') + 1) END)"
    lat, lon = number(p0), number(p1)
    ok = f"(coalesce({lat} BETWEEN -90 AND 90, false) AND coalesce({lon} BETWEEN -180 AND 180, false))"
    return f"(CASE WHEN {ok} THEN {lat} END)", f"(CASE WHEN {ok} THEN {lon} END)"


def lat_lon_loose(e: str) -> tuple[str, str]:
    parts = f"string_split({e}, '|')"
    return number(f"{parts}[1]"), number(f"(CASE WHEN len({parts}) >= 2 THEN {parts}[2] END)")


def strip_tags(e: str) -> str:
    return f"regexp_replace({e}, '<[^>]+>', ' ', 'g')"


def plain(e: str) -> str:
    return f"(CASE WHEN {missing(e)} THEN '' ELSE lower({squish(strip_tags(strip(e)))}) END)"


def word_count(e: str) -> str:
    return f"len(list_filter(string_split_regex({e}, '{WS}+'), lambda w: w <> ''))"


def facility_tokens(e: str) -> str:
    t = f"regexp_replace({squish(strip_tags(strip(e)))}, '[,;/]+', ' ', 'g')"
    return f"CAST(CASE WHEN {missing(e)} THEN 0 ELSE {word_count(t)} END AS BIGINT)"


def raw_tokens(e: str) -> str:
    return f"CAST({word_count(f'coalesce({e}, {chr(39)}{chr(39)})')} AS BIGINT)"


WORD = r"[\pL\p{Nd}\pM\p{Pc}]"


def keyword_hits(e: str, keywords: tuple[str, ...] = FACILITY_KEYWORDS) -> str:
    low = plain(e)
    spaced = f"replace({low}, '/', ' ')"
    terms = []
    for kw in keywords:
        if " " in kw or "/" in kw:
            terms.append(f"CASE WHEN strpos({spaced}, '{kw.replace('/', ' ')}') > 0 THEN 1 ELSE 0 END")
        else:
            esc = "".join("\\" + ch if not ch.isalnum() else ch for ch in kw)
            pat = f"(^|[^{WORD[1:-1]}]){esc}([^{WORD[1:-1]}]|$)"
            terms.append(f"CASE WHEN regexp_matches({low}, '{pat}') THEN 1 ELSE 0 END")
    return "CAST((" + " + ".join(terms) + ") AS BIGINT)"


METRE = r"(?i)within" + WS + r"+[0-9]+" + WS + "*metre"
DIST = r"(?i)[-\x{2013}\x{2014}]" + WS + r"*[0-9]+\.?[0-9]*" + WS + r"*(km|mi)\b"


def attractions(e: str) -> str:
    s = strip(e)
    low = f"lower({s})"
    has_br = f"(strpos({low}, '<br') > 0)"
    is_html = f"({has_br} OR strpos({low}, '<p>') > 0 OR strpos({low}, '</p>') > 0)"
    metre = f"len(regexp_extract_all({s}, '{METRE}'))"
    t = squish(strip_tags("p"))
    tl = f"lower({t})"
    line_ok = (
        f"length({t}) >= 10 AND NOT (strpos({tl}, 'preferred airport') > 0 OR "
        f"(strpos({tl}, 'airport for') > 0 AND strpos({tl}, 'intl') > 0)) AND "
        f"(regexp_matches({t}, '{DIST}') OR regexp_matches({t}, '{METRE}'))"
    )
    lines = f"len(list_filter(string_split_regex({s}, '(?i)<br{WS}*/?>'), lambda p: {line_ok}))"
    rpos = f"strpos(reverse({low}), reverse('preferred airport'))"
    body = f"(CASE WHEN strpos({low}, 'preferred airport') > 0 THEN left({s}, length({low}) - {rpos} - 16) ELSE {s} END)"
    spans = f"len(regexp_extract_all({body}, '{DIST}'))"
    comma = f"(CASE WHEN strpos({s}, ',') > 0 THEN len(list_filter(string_split({s}, ','), lambda p: {strip('p')} <> '')) ELSE 0 END)"
    value = (
        f"CASE WHEN NOT {has_br} AND {metre} > 0 THEN {metre} "
        f"WHEN {is_html} AND {lines} > 0 THEN {lines} "
        f"WHEN {is_html} AND {spans} > 0 THEN {spans} ELSE {comma} END"
    )
    return f"CAST(CASE WHEN {missing(e)} THEN 0 ELSE {value} END AS BIGINT)"


def iso2_expr(code_e: str | None, name_e: str | None, dim: str = "dim") -> tuple[str, str]:
    """Returns (FROM-clause joins, result expression) for the ISO2 lookup of ``l``."""
    joins = []
    code_hit = "CAST(NULL AS VARCHAR)"
    if code_e is not None:
        joins.append(
            f"LEFT JOIN (SELECT upper(trim(iso2)) AS k, min(upper(iso2)) AS v FROM {dim} GROUP BY 1) dc "
            f"ON dc.k = {tidy(code_e)}"
        )
        code_hit = "dc.v"
    if name_e is not None:
        joins.append(
            f"LEFT JOIN (SELECT upper(trim(name)) AS k, min(upper(iso2)) AS v FROM {dim} GROUP BY 1) dn "
            f"ON dn.k = (CASE WHEN {code_hit} IS NULL THEN {tidy(name_e)} END)"
        )
        res = f"coalesce({code_hit}, dn.v)"
    else:
        res = code_hit
    return " ".join(joins), f"(CASE WHEN regexp_matches({res}, '^[A-Z]{{2}}$') THEN {res} END)"


def _listings_clean_sql() -> str:
    joins, iso = iso2_expr("l.countyCode", "l.countyName")
    lat, lon = lat_lon("l.Map")
    return f"""
    SELECT l.*, {iso} AS country_iso2, {city_key('l.cityName')} AS city_join_key,
      {star('l.HotelRating')} AS hotel_star_rating,
      {lat} AS hotel_latitude, {lon} AS hotel_longitude,
      {attractions('l.Attractions')} AS attractions_count,
      {facility_tokens('l.HotelFacilities')} AS facilities_token_count,
      {keyword_hits('l.HotelFacilities')} AS facilities_keyword_hits
    FROM listings_raw l {joins}
    """


def _gazetteer_clean_sql() -> str:
    joins, iso = iso2_expr("l.Country", None)
    order = ", ".join(
        f"{c} DESC NULLS LAST"
        for c in ["pop", "City", "Country", "AccentCity", "Region", "Population", "Latitude", "Longitude"]
    )
    return f"""
    SELECT * EXCLUDE (pop) FROM (
      SELECT l.*, {number('l.Population')} AS pop, {iso} AS country_iso2,
        {city_key('l.City')} AS city_join_key
      FROM gazetteer_raw l {joins}
    ) QUALIFY row_number() OVER (PARTITION BY country_iso2, city_join_key ORDER BY {order}) = 1
    """


JOINED_SELECT = """
SELECT l.countyCode, l.countyName, l.cityCode, l.cityName, l.HotelCode, l.HotelName,
  l.hotel_star_rating, l.attractions_count, l.facilities_token_count AS facilities_count,
  l.facilities_keyword_hits, l.hotel_latitude, l.hotel_longitude, g.city_population
FROM listings_clean l
LEFT JOIN (SELECT country_iso2, city_join_key, {pop} AS city_population FROM gazetteer_clean) g
  ON l.country_iso2 IS NOT DISTINCT FROM g.country_iso2
 AND l.city_join_key IS NOT DISTINCT FROM g.city_join_key
""".format(pop=number("Population"))


def with_base(body: str, joined: bool = True) -> str:
    """Prefix the shared fixture + cleaning CTEs."""
    ctes = [
        f"dim AS ({COUNTRY_DIM_SQL})",
        f"listings_raw AS ({LISTINGS_RAW_SQL})",
        f"gazetteer_raw AS ({GAZETTEER_RAW_SQL})",
        f"listings_clean AS ({_listings_clean_sql()})",
        f"gazetteer_clean AS ({_gazetteer_clean_sql()})",
    ]
    if joined:
        ctes.append(f"joined AS ({JOINED_SELECT})")
    return "WITH " + ",\n".join(ctes) + "\n" + body



def normal_p(z: str) -> str:
    """Two-sided normal p-value: the density integrated from |z| over 12 deviations by
    Simpson's rule in 6000 steps (a scalar subquery of the row that holds ``z``)."""
    return f"""(SELECT least(1.0, 2 * sum(CASE WHEN g.i IN (0, 6000) THEN 1 WHEN g.i % 2 = 1 THEN 4 ELSE 2 END
          * exp(-pow(abs({z}) + g.i * 0.002, 2) / 2)) * 0.002 / 3 / sqrt(2 * pi())) FROM range(0, 6001) g(i))"""


def t_p(t: str, dof: str) -> str:
    """As :func:`normal_p` for Student's t with ``dof`` (many) degrees of freedom."""
    area = f"""(SELECT 2 * sum(CASE WHEN g.i IN (0, 6000) THEN 1 WHEN g.i % 2 = 1 THEN 4 ELSE 2 END
          * exp(-({dof} + 1) / 2.0 * ln(1 + pow(abs({t}) + g.i * 0.002, 2) / {dof}))) * 0.002 / 3 FROM range(0, 6001) g(i))"""
    return f"least(1.0, {area} * exp(lgamma(({dof} + 1) / 2.0) - lgamma({dof} / 2.0)) / sqrt({dof} * pi()))"


def p_label(p: str) -> str:
    return (f"CASE WHEN {p} < 0.01 THEN 'strong evidence against null' "
            f"WHEN {p} < 0.05 THEN 'moderate evidence against null' ELSE 'no significant evidence' END")


def d_label(d: str) -> str:
    return (f"CASE WHEN abs({d}) < 0.2 THEN 'negligible' WHEN abs({d}) < 0.5 THEN 'small' "
            f"WHEN abs({d}) < 0.8 THEN 'medium' ELSE 'large' END")


def cohens_d_value(src: str, v: str, high: str) -> str:
    """Cohen's d (high minus low) as a one-row query with the column ``d``."""
    hi, lo = f"CASE WHEN {high} THEN {v} END", f"CASE WHEN NOT ({high}) THEN {v} END"
    return f"""SELECT (avg({hi}) - avg({lo})) / sqrt(((count({hi}) - 1) * var_samp({hi}) + (count({lo}) - 1) * var_samp({lo}))
        / (count({hi}) + count({lo}) - 2)) AS d FROM {src}"""


def mann_whitney_value(src: str, v: str, high: str) -> str:
    """U of the high sample and z (ties and continuity corrected): columns ``u1``, ``z``."""
    return f"""SELECT u1, (greatest(u1, n1 * n2 - u1) - n1 * n2 / 2.0 - 0.5)
          / sqrt(n1 * n2 / 12.0 * ((n1 + n2 + 1) - tie / ((n1 + n2) * (n1 + n2 - 1)))) AS z
      FROM (SELECT *, r1 - n1 * (n1 + 1) / 2.0 AS u1 FROM (
        SELECT CAST(sum(nh) AS DOUBLE) AS n1, CAST(sum(cnt - nh) AS DOUBLE) AS n2,
               sum(nh * (before + (cnt + 1) / 2.0)) AS r1, sum(CAST(cnt AS DOUBLE) * cnt * cnt - cnt) AS tie
        FROM (SELECT *, sum(cnt) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - cnt AS before
              FROM (SELECT CAST({v} AS DOUBLE) AS v, sum(CASE WHEN {high} THEN 1 ELSE 0 END) AS nh, count(*) AS cnt
                    FROM {src} WHERE {v} IS NOT NULL AND ({high}) IS NOT NULL GROUP BY 1))))"""
