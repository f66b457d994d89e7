"""Text column expressions for messy listing fields.

Every function takes a column name or ``Column`` and returns a ``Column`` built
from native Spark SQL functions, so the work stays in the JVM (no Python UDF).
Regexes carry ``(?U)`` so ``\\s``, ``\\d`` and ``\\b`` follow Unicode classes, as
Python's ``re`` does on ``str``; plain ``F.trim`` would only strip U+0020.

Expressions that use higher-order functions (``filter``/``transform``) cannot be
whole-stage code generated; callers keep them in their own projection.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# --- fixed values: must equal the source project's for the same results --------
# Spelled-out star labels (lowercase, spaces removed) and their star count.
STAR_WORDS: dict[str, int] = {
    "fivestar": 5,
    "fourstar": 4,
    "threestar": 3,
    "twostar": 2,
    "onestar": 1,
}
# Exact, case-sensitive star labels used by the strict mapping.
STRICT_STAR_LABELS: dict[str, int] = {
    "OneStar": 1,
    "TwoStar": 2,
    "ThreeStar": 3,
    "FourStar": 4,
    "FiveStar": 5,
}
# Amenity phrases counted by ``keyword_hits`` (45, lowercase).
FACILITY_KEYWORDS: tuple[str, ...] = (
    "24-hour front desk",
    "airport transportation",
    "airport pick up",
    "airport drop off",
    "air conditioning",
    "non-smoking throughout",
    "non-smoking rooms",
    "dry cleaning/laundry",
    "private check-in",
    "express check-in",
    "business centre",
    "business center",
    "meeting/banquet",
    "currency exchange",
    "luggage storage",
    "private parking",
    "free self parking",
    "free parking",
    "airport shuttle",
    "shuttle service",
    "room service",
    "dry cleaning",
    "family rooms",
    "free wifi",
    "free wi-fi",
    "concierge",
    "restaurant",
    "breakfast",
    "elevator",
    "internet",
    "laundry",
    "parking",
    "smoking",
    "terrace",
    "garden",
    "heating",
    "fitness",
    "sauna",
    "wifi",
    "wi-fi",
    "pool",
    "gym",
    "spa",
    "pets",
    "bar",
)
# Patterns of the attraction counter.
METRE_SPAN = r"within\s+\d+\s*metre"
DISTANCE_SPAN = r"[-\u2013\u2014]\s*\d+\.?\d*\s*(?:km|mi)\b"
LINE_BREAK = r"<br\s*/?>"
AIRPORT_MARK = "preferred airport"
# --- end of fixed values -----------------------------------------------------------

HTML_TAG = r"<[^>]+>"
_WS = r"(?U)\s+"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Every character Python's ``str.strip()`` removes (``str.isspace``), built by rule.
PY_WHITESPACE = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


def strip_ws(c: ColumnOrName) -> Column:
    """Strip leading/trailing whitespace exactly as Python ``str.strip`` does
    (character-set trim, no regex)."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def squish_ws(c: ColumnOrName) -> Column:
    """Collapse whitespace runs to one space and strip the ends."""
    return strip_ws(F.regexp_replace(_col(c), _WS, " "))


def is_missing_text(c: ColumnOrName) -> Column:
    """NULL, blank, or the text ``nan`` in any case (the missing-like idiom)."""
    s = strip_ws(c)
    return _col(c).isNull() | (s == "") | (F.lower(s) == "nan")


def blank_if_missing(c: ColumnOrName) -> Column:
    """Stripped text, or ``""`` when missing-like."""
    return F.when(is_missing_text(c), F.lit("")).otherwise(strip_ws(c))


def tidy_code(c: ColumnOrName) -> Column:
    """Code/name tidy: missing-like -> ``""``, else stripped and upper-cased."""
    return F.upper(blank_if_missing(c))


def city_join_key(c: ColumnOrName) -> Column:
    """Join key for city names.

    Lower-case, collapse whitespace, delete every character outside
    ``[a-z0-9]``, whitespace and ``-`` (accented letters are deleted, not folded),
    collapse again, strip. NULL becomes ``""``.
    """
    s = F.lower(strip_ws(F.coalesce(_col(c), F.lit(""))))
    s = F.regexp_replace(s, _WS, " ")
    s = F.regexp_replace(s, r"(?U)[^a-z0-9\s-]", "")
    return squish_ws(s)


def _map_lookup(mapping: dict[str, int], key: Column) -> Column:
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), key)


def star_rating(c: ColumnOrName) -> Column:
    """Lenient star label -> 1..5 (INT), else NULL.

    The spelled-out word (whitespace removed, any case) wins; otherwise the first
    digit directly before ``star`` (``4 Stars`` -> 4, ``4.5 Star`` -> 5) when it is
    1..5. ``3-star`` and ``10 star`` give NULL.
    """
    raw = _col(c)
    s = strip_ws(raw)
    squished = F.lower(F.regexp_replace(s, _WS, ""))
    word = _map_lookup(STAR_WORDS, squished)
    digit = F.regexp_extract(s, r"(?iU)(\d)\s*star", 1).try_cast("int")
    from_digit = F.when(digit.between(1, 5), digit)
    value = F.coalesce(word, from_digit)
    return F.when(is_missing_text(raw), F.lit(None).cast("int")).otherwise(value).cast("int")


def strict_star_rating(c: ColumnOrName) -> Column:
    """Exact, case-sensitive label map (``FourStar`` -> 4); anything else NULL."""
    return _map_lookup(STRICT_STAR_LABELS, _col(c)).cast("int")


def to_number(c: ColumnOrName) -> Column:
    """Coerce text to DOUBLE; text that is not a number becomes NULL.

    Accepts what a lenient numeric parser accepts (``+4.5``, ``1e1``, `` 19.0``,
    ``inf``) and rejects what ``try_cast`` alone would let through (``41d``).
    ``nan`` is missing, so NULL.
    """
    s = strip_ws(_col(c))
    numeric = s.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    infinite = F.lower(s).rlike(r"^[+-]?inf(inity)?$")
    return F.when(numeric | infinite, s.try_cast("double"))


def strip_tags(c: ColumnOrName) -> Column:
    """Replace every ``<...>`` tag with a space (the regex only runs on text
    that contains a ``<``)."""
    c = _col(c)
    return F.when(F.instr(c, "<") > 0, F.regexp_replace(c, HTML_TAG, " ")).otherwise(c)


def plain_text(c: ColumnOrName) -> Column:
    """Tags stripped, whitespace collapsed, lower-cased; missing-like -> ``""``."""
    return F.when(is_missing_text(c), F.lit("")).otherwise(
        F.lower(squish_ws(strip_tags(strip_ws(c))))
    )


def _word_count(s: Column) -> Column:
    return F.size(F.filter(F.split(s, _WS), lambda t: t != ""))


def facility_token_count(c: ColumnOrName) -> Column:
    """Tokens of a facilities list: tags stripped, ``[,;/]+`` as separators."""
    t = squish_ws(strip_tags(strip_ws(c)))
    t = F.regexp_replace(t, r"[,;/]+", " ")
    return F.when(is_missing_text(c), F.lit(0)).otherwise(_word_count(t)).cast("bigint")


def raw_token_count(c: ColumnOrName) -> Column:
    """Whitespace tokens of the raw text (no tag strip); NULL counts 0."""
    return _word_count(F.coalesce(_col(c), F.lit(""))).cast("bigint")


def text_length(c: ColumnOrName) -> Column:
    """Character length; NULL counts 0."""
    return F.length(F.coalesce(_col(c), F.lit(""))).cast("bigint")


def presence_flag(c: ColumnOrName) -> Column:
    """1 when the value is present, else 0."""
    return _col(c).isNotNull().cast("int")


def keyword_hits(c: ColumnOrName, keywords: tuple[str, ...] = FACILITY_KEYWORDS) -> Column:
    """How many *distinct* keywords occur in the plain text.

    A keyword containing a space or ``/`` is matched as a substring after ``/`` is
    read as a space on both sides; a single token must match on word boundaries.
    Overlaps count (``free wifi`` hits both ``free wifi`` and ``wifi``).
    """
    low = plain_text(c)
    spaced = F.translate(low, "/", " ")
    # \bword\b holds exactly when the word is one of the maximal word-character
    # runs, so one split serves every plain single-word keyword
    words = F.split(low, r"(?U)\W+")
    single = [kw for kw in dict.fromkeys(keywords) if re.fullmatch(r"\w+", kw)]
    hits = []
    if single:
        # distinct single-word keywords present: one hash-set intersection
        hits.append(F.size(F.array_intersect(words, F.array(*[F.lit(k) for k in single]))))
    for kw in keywords:
        if kw in single:
            continue
        if " " in kw or "/" in kw:
            hit = F.instr(spaced, kw.replace("/", " ")) > 0
        else:
            # the substring test is a cheap guard: the regex only runs where it can match
            hit = (F.instr(low, kw) > 0) & low.rlike(r"(?U)\b" + re.escape(kw) + r"\b")
        hits.append(hit.cast("int"))
    total = hits[0]
    for h in hits[1:]:
        total = total + h
    return total.cast("bigint")


def attractions_count(c: ColumnOrName) -> Column:
    """Number of nearby points of interest in free text, first rule that applies:

    1. no ``<br`` and ``within N metre`` spans present: the number of such spans;
    2. HTML (``<br``, ``<p>`` or ``</p>``): lines split on ``<br>``, tags stripped,
       lines of 10+ characters that carry a ``- N km/mi`` or metre span and are not
       the preferred-airport line; if none, the ``- N km/mi`` spans before the last
       ``preferred airport``; if still none, fall through;
    3. text with a comma: the number of non-blank comma items;
    4. otherwise 0. Missing-like text counts 0.
    """
    raw = _col(c)
    s = strip_ws(raw)
    low = F.lower(s)
    has_br = F.instr(low, "<br") > 0
    is_html = has_br | (F.instr(low, "<p>") > 0) | (F.instr(low, "</p>") > 0)
    metre = F.regexp_count(s, F.lit("(?iU)" + METRE_SPAN))

    def line_counts(part: Column) -> Column:
        t = squish_ws(strip_tags(part))
        tl = F.lower(t)
        airport = (F.instr(tl, AIRPORT_MARK) > 0) | (
            (F.instr(tl, "airport for") > 0) & (F.instr(tl, "intl") > 0)
        )
        has_span = t.rlike("(?iU)" + DISTANCE_SPAN) | t.rlike("(?iU)" + METRE_SPAN)
        return (F.length(t) >= 10) & ~airport & has_span

    lines = F.split(s, "(?iU)" + LINE_BREAK)
    line_hits = F.size(F.filter(lines, line_counts))
    cut = F.length(low) - F.length(F.substring_index(low, AIRPORT_MARK, -1)) - len(AIRPORT_MARK)
    body = F.when(F.instr(low, AIRPORT_MARK) > 0, F.left(s, cut)).otherwise(s)
    span_hits = F.regexp_count(body, F.lit("(?iU)" + DISTANCE_SPAN))
    comma_items = F.size(F.filter(F.split(s, ","), lambda t: strip_ws(t) != ""))
    comma_rule = F.when(F.instr(s, ",") > 0, comma_items).otherwise(F.lit(0))

    # each rule is evaluated at most once and only when the earlier ones gave
    # nothing: nullif(x, 0) turns "no hit" into NULL for coalesce to skip
    zero = F.lit(0)
    value = F.coalesce(
        F.when(~has_br, F.nullif(metre, zero)),
        F.when(is_html, F.coalesce(F.nullif(line_hits, zero), F.nullif(span_hits, zero))),
        comma_rule,
    )
    return F.when(is_missing_text(raw), F.lit(0)).otherwise(value).cast("bigint")


def p_value_label(p: ColumnOrName) -> Column:
    """Evidence label for a p-value (cut-offs 0.01 and 0.05)."""
    p = _col(p)
    return (
        F.when(p < 0.01, F.lit("strong evidence against null"))
        .when(p < 0.05, F.lit("moderate evidence against null"))
        .otherwise(F.lit("no significant evidence"))
    )


def effect_size_label(d: ColumnOrName) -> Column:
    """Magnitude label for Cohen's d (cut-offs 0.2, 0.5, 0.8 on ``|d|``)."""
    a = F.abs(_col(d))
    return (
        F.when(a < 0.2, F.lit("negligible"))
        .when(a < 0.5, F.lit("small"))
        .when(a < 0.8, F.lit("medium"))
        .otherwise(F.lit("large"))
    )


def flag_label(c: ColumnOrName, labels: dict[int, str]) -> Column:
    """Map a 0/1 flag (or any small int code) to text; unknown -> NULL."""
    expr = None
    for k, v in labels.items():
        cond = _col(c) == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr


def group_label(city: ColumnOrName, country: ColumnOrName) -> Column:
    """``city (country)``; NULL when either part is NULL."""
    return F.concat(_col(city), F.lit(" ("), _col(country), F.lit(")"))
