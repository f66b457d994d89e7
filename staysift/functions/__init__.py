"""Column expressions (``str | Column -> Column``), all native Spark SQL."""

from staysift.functions.geo import in_range, lat_lon, lat_lon_loose
from staysift.functions.text import (
    FACILITY_KEYWORDS,
    attractions_count,
    blank_if_missing,
    city_join_key,
    effect_size_label,
    facility_token_count,
    flag_label,
    group_label,
    is_missing_text,
    keyword_hits,
    p_value_label,
    plain_text,
    presence_flag,
    raw_token_count,
    squish_ws,
    star_rating,
    strict_star_rating,
    strip_tags,
    strip_ws,
    text_length,
    tidy_code,
    to_number,
)

__all__ = [
    "FACILITY_KEYWORDS",
    "attractions_count",
    "blank_if_missing",
    "city_join_key",
    "effect_size_label",
    "facility_token_count",
    "flag_label",
    "group_label",
    "in_range",
    "is_missing_text",
    "keyword_hits",
    "lat_lon",
    "lat_lon_loose",
    "p_value_label",
    "plain_text",
    "presence_flag",
    "raw_token_count",
    "squish_ws",
    "star_rating",
    "strict_star_rating",
    "strip_tags",
    "strip_ws",
    "text_length",
    "tidy_code",
    "to_number",
]
