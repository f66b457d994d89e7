"""Cleaning, de-duplication and the null-safe enrichment join.

Scale notes
-----------
* ``dedupe_keep_max`` is a hash/sort aggregate on the keys with a partial
  (map-side) step: a key that holds a third of all rows is reduced to one row per
  map task before the shuffle. No window, so no task ever sorts a whole group.
* ``null_safe_left_join`` broadcasts the right side only after counting it.
  Beyond the limit it shuffles both sides on the keys and salts the hot keys
  (by default the NULL/empty city key that every non-Latin name collapses to):
  hot left rows are spread over ``salt_buckets`` sub-keys and the (unique per key)
  right row is replicated to each of them, so no reducer receives the hot key
  whole. The row count of the left side is preserved exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staysift.functions.geo import lat_lon
from staysift.functions.text import (
    attractions_count,
    city_join_key,
    facility_token_count,
    keyword_hits,
    star_rating,
    to_number,
)
from staysift.operators.heavy_hitters import is_one_of, summarise_keys
from staysift.operators.lookup import iso2_lookup, row_count
from staysift.operators.schema import canonical_columns
from staysift.session import written

# Right side of an enrichment join is broadcast up to this many rows.
JOIN_BROADCAST_MAX_ROWS = 2_000_000
SALT_BUCKETS = 64


def dedupe_keep_max(
    df: DataFrame,
    keys: Sequence[str],
    measure: str,
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """One row per key tuple: the row with the greatest ``measure`` (NULL last).

    NULL keys form their own group (as in a drop-duplicates). Ties on the measure
    are broken by ``tie_breakers`` (greatest first), then by the remaining
    columns, so the result is deterministic. Implemented as ``max(struct)`` per
    group: struct ordering compares fields left to right with NULL lowest.
    """
    rest = [c for c in df.columns if c not in keys and c != measure and c not in tie_breakers]
    order = [measure, *tie_breakers, *rest]
    packed = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(order)])
    best = df.groupBy(*keys).agg(F.max(packed).alias("__best"))
    return best.select(
        *keys, *[F.col(f"__best.f{i}").alias(c) for i, c in enumerate(order)]
    ).select(*df.columns)


def _key_condition(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k]) if null_safe else left[k] == right[k]
        cond = c if cond is None else cond & c
    return cond


def default_hot_keys(keys: Sequence[str]) -> Column:
    """Hot keys: any key NULL or empty (non-Latin names all become "")."""
    cond = None
    for k in keys:
        c = F.col(k).isNull() | (F.col(k) == "")
        cond = c if cond is None else cond | c
    return cond


def detect_hot_keys(left: DataFrame, keys: Sequence[str], share: float = 0.01, most: int = 100) -> Column:
    """Keys that may hold ``share`` of the rows (at most ``most`` of them, the commonest), and
    NULL or empty ones. One pass over ``left`` keeps a bounded summary per task; a stream
    is not looked at: its hot keys are the NULL and empty ones."""
    hot = default_hot_keys(keys)
    if left.isStreaming:
        return hot
    return hot | is_one_of(keys, summarise_keys(left, keys).above(share)[:most])


def null_safe_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    attrs: Sequence[str],
    null_safe: bool = True,
    broadcast_max_rows: int = JOIN_BROADCAST_MAX_ROWS,
    hot_keys: Column | None = None,
    salt_buckets: int = SALT_BUCKETS,
    right_rows: int | None = None,
) -> DataFrame:
    """Left equi-join attaching ``attrs`` from ``right`` (unique per key).

    With ``null_safe`` (the default, matching the source semantics) a NULL key
    matches a NULL key. The left row count is unchanged because ``right`` must be
    unique per key (use ``dedupe_keep_max`` first). ``right_rows`` passes a known
    row count and skips counting.
    """
    n_right = right_rows if right_rows is not None else row_count(right)
    small = n_right <= broadcast_max_rows
    right = right.select(*keys, *attrs)
    if small:
        r = F.broadcast(right)
        joined = left.join(r, _key_condition(left, r, keys, null_safe), "left")
        return joined.select(*[left[c] for c in left.columns], *[r[a] for a in attrs])

    hot = hot_keys if hot_keys is not None else detect_hot_keys(left, keys)
    salt_l = F.when(hot, F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(salt_buckets)))
    l2 = left.withColumn("__salt", F.coalesce(salt_l, F.lit(0)).cast("int"))
    fan = F.when(hot, F.sequence(F.lit(0), F.lit(salt_buckets - 1))).otherwise(F.array(F.lit(0)))
    r2 = right.withColumn("__salt", F.explode(fan))
    cond = _key_condition(l2, r2, keys, null_safe) & (l2["__salt"] == r2["__salt"])
    # beyond the broadcast limit Spark must not choose a broadcast from an estimate
    joined = l2.join(r2.hint("merge"), cond, "left")
    return joined.select(*[l2[c] for c in left.columns], *[r2[a] for a in attrs])


def join_coverage(df: DataFrame, attr: str) -> DataFrame:
    """Share (and count) of rows the enrichment did not match (attr NULL)."""
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.sum(F.col(attr).isNull().cast("bigint")).cast("bigint").alias("unmatched"),
        F.avg(F.col(attr).isNull().cast("double")).alias("unmatched_share"),
    )


def unmatched_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct left keys with no partner on the right (null-safe anti join)."""
    l = left.select(*keys).distinct()
    r = right.select(*keys).distinct()
    return l.join(r, _key_condition(l, r, keys, True), "left_anti")


def clean_listings(raw: DataFrame, country_dim: DataFrame) -> DataFrame:
    """Canonical headers plus the eight derived listing columns, one projection.

    Adds ``country_iso2``, ``city_join_key``, ``hotel_star_rating``,
    ``hotel_latitude``, ``hotel_longitude``, ``attractions_count``,
    ``facilities_token_count``, ``facilities_keyword_hits``. Row-local apart from
    the broadcast country lookup, so it also runs on a stream.
    """
    df = canonical_columns(raw)
    df = iso2_lookup(df, "countyCode", "countyName", "country_iso2", country_dim)
    lat, lon = lat_lon("Map")
    return df.withColumns(
        {
            "city_join_key": city_join_key("cityName"),
            "hotel_star_rating": star_rating("HotelRating"),
            "hotel_latitude": lat,
            "hotel_longitude": lon,
            "attractions_count": attractions_count("Attractions"),
            "facilities_token_count": facility_token_count("HotelFacilities"),
            "facilities_keyword_hits": keyword_hits("HotelFacilities"),
        }
    )


def clean_gazetteer(raw: DataFrame, country_dim: DataFrame) -> DataFrame:
    """Gazetteer: ISO2 from ``Country``, city key from ``City``, numeric
    population, then one row per (ISO2, key) with the largest population."""
    df = raw.withColumn("__pop", to_number("Population"))
    df = iso2_lookup(df, "Country", None, "country_iso2", country_dim)
    df = df.withColumn("city_join_key", city_join_key("City"))
    out = dedupe_keep_max(df, ["country_iso2", "city_join_key"], "__pop", ["City", "Country"])
    return out.drop("__pop")


def attach_population(listings: DataFrame, gazetteer: DataFrame, **join_kwargs) -> DataFrame:
    """Left-join ``Population`` (as ``city_population`` DOUBLE) on ISO2 + city key."""
    right = gazetteer.select(
        "country_iso2", "city_join_key", to_number("Population").alias("city_population")
    )
    if join_kwargs.get("right_rows") is None:
        if join_kwargs.get("broadcast_max_rows", JOIN_BROADCAST_MAX_ROWS) < 0:
            join_kwargs["right_rows"] = 0  # never broadcast: its size does not matter
        else:  # the dedupe runs once, for the count and for the join
            right = written(right, "gazetteer")
    return null_safe_left_join(
        listings, right, ["country_iso2", "city_join_key"], ["city_population"], **join_kwargs
    )
