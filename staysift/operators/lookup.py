"""Country code/name lookups and region roll-up maps.

The ISO dimension is a bounded table (one row per country, a few hundred rows),
so it is always broadcast; its size is checked before the hint is applied.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staysift.functions.text import ColumnOrName, _col, tidy_code

# A lookup dimension above this many rows is not broadcast.
DIM_BROADCAST_MAX_ROWS = 200_000

# --- fixed values: must equal the source project's for the same results --------
# Country name -> sub-region (names as written in the listing data).
SUB_REGION_BY_COUNTRY: dict[str, str] = {
    "United States": "North America", "Canada": "North America", "Mexico": "North America",
    "Argentina": "South America", "Bolivia": "South America", "Brazil": "South America",
    "Chile": "South America", "Colombia": "South America", "Ecuador": "South America",
    "Paraguay": "South America", "Peru": "South America", "Uruguay": "South America",
    "Venezuela": "South America",
    "Antigua": "Central America/Caribbean", "Aruba": "Central America/Caribbean",
    "Bahamas": "Central America/Caribbean", "Barbados": "Central America/Caribbean",
    "Costa Rica": "Central America/Caribbean", "Dominican Republic": "Central America/Caribbean",
    "Grenada": "Central America/Caribbean", "Guadeloupe": "Central America/Caribbean",
    "Guatemala": "Central America/Caribbean", "Jamaica": "Central America/Caribbean",
    "Panama": "Central America/Caribbean", "Puerto Rico": "Central America/Caribbean",
    "St Kitts & Nevis": "Central America/Caribbean", "St Lucia": "Central America/Caribbean",
    "St Vincent & Grenadi": "Central America/Caribbean",
    "Trinidad & Tobago": "Central America/Caribbean",
    "Turks & Caicos Islan": "Central America/Caribbean",
    "Virgin Islands (USA)": "Central America/Caribbean",
    "China": "East Asia", "Hong Kong": "East Asia", "Japan": "East Asia", "Macau": "East Asia",
    "Mongolia": "East Asia", "South Korea": "East Asia", "Taiwan": "East Asia",
    "Brunei Darussalam": "Southeast Asia", "Cambodia": "Southeast Asia",
    "Indonesia": "Southeast Asia", "Laos": "Southeast Asia", "Malaysia": "Southeast Asia",
    "Myanmar": "Southeast Asia", "Philippines": "Southeast Asia", "Singapore": "Southeast Asia",
    "Thailand": "Southeast Asia", "Vietnam": "Southeast Asia",
    "India": "South Asia", "Nepal": "South Asia", "Sri Lanka": "South Asia",
    "Bahrain": "Middle East", "Israel": "Middle East", "Jordan": "Middle East",
    "Kuwait": "Middle East", "Lebanon": "Middle East", "Oman": "Middle East",
    "Qatar": "Middle East", "Saudi Arabia": "Middle East", "Turkey": "Middle East",
    "United Arab Emirates": "Middle East", "Yemen Republic": "Middle East",
    "Albania": "Europe", "Andorra": "Europe", "Austria": "Europe", "Azerbaijan": "Europe",
    "Belarus": "Europe", "Belgium": "Europe", "Bosnia Herzegovina": "Europe",
    "Bulgaria": "Europe", "Croatia": "Europe", "Cyprus": "Europe", "Czech Republic": "Europe",
    "Denmark": "Europe", "Estonia": "Europe", "Finland": "Europe", "France": "Europe",
    "Germany": "Europe", "Gibraltar": "Europe", "Greece": "Europe", "Hungary": "Europe",
    "Iceland": "Europe", "Ireland(Republic of)": "Europe", "Italy": "Europe",
    "Latvia": "Europe", "Liechtenstein": "Europe", "Lithuania": "Europe",
    "Luxembourg": "Europe", "Malta": "Europe", "Monaco": "Europe", "Netherlands": "Europe",
    "Norway": "Europe", "Poland": "Europe", "Portugal": "Europe", "Romania": "Europe",
    "Russia": "Europe", "Russian Federation": "Europe", "San Marino": "Europe",
    "Serbia": "Europe", "Slovakia": "Europe", "Slovenia": "Europe", "Spain": "Europe",
    "Sweden": "Europe", "Switzerland": "Europe", "Ukraine": "Europe",
    "United Kingdom": "Europe",
    "Botswana": "Africa", "Cameroon": "Africa", "Egypt": "Africa", "Ethiopia": "Africa",
    "Kenya": "Africa", "Libya": "Africa", "Mauritius": "Africa", "Morocco": "Africa",
    "Namibia": "Africa", "Nigeria": "Africa", "Senegal": "Africa", "Seychelles": "Africa",
    "South Africa": "Africa", "Tanzania": "Africa", "Tunisia": "Africa", "Zambia": "Africa",
    "Zimbabwe": "Africa", "Swaziland": "Africa",
    "Australia": "Oceania", "Cook Islands": "Oceania", "Fiji": "Oceania", "Guam": "Oceania",
    "New Caledonia": "Oceania", "New Zealand": "Oceania", "Northern Mariana Isl": "Oceania",
    "Palau": "Oceania", "Samoa": "Oceania", "Tonga": "Oceania", "Vanuatu": "Oceania",
    "French Polynesia": "Oceania",
}
# Sub-region -> continent.
CONTINENT_BY_SUB_REGION: dict[str, str] = {
    "North America": "North America",
    "South America": "South America",
    "Central America/Caribbean": "North America",
    "East Asia": "Asia",
    "Southeast Asia": "Asia",
    "South Asia": "Asia",
    "Middle East": "Asia",
    "Europe": "Europe",
    "Africa": "Africa",
    "Oceania": "Oceania",
}
OTHER = "Other"
# --- end of fixed values -----------------------------------------------------------


def map_with_default(c: ColumnOrName, mapping: dict[str, str], default: str | None = OTHER) -> Column:
    """Dictionary map as an inline literal map (no join, no shuffle); misses ->
    ``default``. Suits maps of up to a few thousand entries."""
    pairs: list[Column] = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    hit = F.try_element_at(F.create_map(*pairs), _col(c))
    return hit if default is None else F.coalesce(hit, F.lit(default))


def sub_region(country: ColumnOrName, mapping: dict[str, str] = SUB_REGION_BY_COUNTRY) -> Column:
    return map_with_default(country, mapping)


def continent(region: ColumnOrName, mapping: dict[str, str] = CONTINENT_BY_SUB_REGION) -> Column:
    return map_with_default(region, mapping)


# --- fixed values: English short names that the ISO 3166 table spells otherwise ----
COUNTRY_NAME_ALIASES: dict[str, str] = {
    "American Samoa": "AS", "Antigua and Barbuda": "AG", "Bosnia and Herzegovina": "BA", "Brunei Darussalam": "BN",
    "Cocos (Keeling) Islands": "CC", "Congo Republic": "CG", "DR Congo": "CD", "Eswatini": "SZ", "Myanmar": "MM",
    "North Korea": "KP", "Samoa": "WS", "Sao Tome and Principe": "ST", "Sint Maarten": "SX", "South Korea": "KR",
    "St. Barths": "BL", "St. Helena": "SH", "St. Kitts and Nevis": "KN", "St. Lucia": "LC",
    "St. Pierre and Miquelon": "PM", "St. Vincent and the Grenadines": "VC", "Trinidad and Tobago": "TT",
    "Turks and Caicos Islands": "TC", "United Kingdom": "GB", "United States Virgin Islands": "VI",
    "British Virgin Islands": "VG", "Wallis and Futuna Islands": "WF",
}
# --- end of fixed values -----------------------------------------------------------


def iso_country_rows() -> list[tuple[str, str]]:
    """(ISO2, English name): the ISO 3166 table shipped with ``tzdata`` and the short
    names that it spells otherwise (``COUNTRY_NAME_ALIASES``)."""
    text = resources.files("tzdata").joinpath("zoneinfo/iso3166.tab").read_text(encoding="utf-8")
    rows = []
    for line in text.splitlines():
        if not line or line.startswith("#"):
            continue
        code, name = line.split("\t", 1)
        rows.append((code.strip(), name.strip()))
    return rows + [(code, name) for name, code in COUNTRY_NAME_ALIASES.items()]


def iso_country_dim(spark: SparkSession) -> DataFrame:
    """Default country dimension ``(iso2, name)``; a few hundred rows."""
    return spark.createDataFrame(iso_country_rows(), "iso2 string, name string")


def checked_broadcast(dim: DataFrame, max_rows: int = DIM_BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast a dimension only after proving it is small.

    Counting a dimension is cheap; a dimension above ``max_rows`` is returned
    unhinted and joined by shuffle (AQE may still broadcast it at runtime).
    """
    return F.broadcast(dim) if row_count(dim) <= max_rows else dim


def row_count(df: DataFrame) -> int:
    """Row count, remembered on the DataFrame object (dimensions are reused)."""
    n = getattr(df, "_staysift_rows", None)
    if n is None:
        n = df.count()
        try:
            df._staysift_rows = n
        except AttributeError:
            pass
    return n


def _prepared_dim(dim: DataFrame, key_col: str) -> DataFrame:
    # One row per lookup key so the join never fans out; smallest code wins.
    keyed = dim.select(F.upper(F.trim(F.col(key_col))).alias("__k"), F.upper(F.col("iso2")).alias("__iso2"))
    return keyed.groupBy("__k").agg(F.min("__iso2").alias("__iso2"))


def _valid_iso2(c: Column) -> Column:
    return F.when(c.rlike("^[A-Z]{2}$"), c)


def iso2_lookup(
    df: DataFrame,
    code_col: str | None,
    name_col: str | None,
    out_col: str,
    dim: DataFrame,
    on_unknown: str = "null",
) -> DataFrame:
    """Country -> validated ISO2, code first and name only where the code failed.

    ``code_col`` is tidied (missing-like -> "", trim, upper) and looked up in
    ``dim.iso2``; ``name_col`` in ``upper(dim.name)``. Unknown values give NULL,
    or with ``on_unknown="passthrough"`` the tidied code when it is two letters.
    Both lookups are broadcast hash joins against the bounded dimension; the name
    key is NULL wherever the code already matched, so those rows skip the probe.
    """
    if on_unknown not in ("null", "passthrough"):
        raise ValueError("on_unknown must be 'null' or 'passthrough'")
    out = df
    small = row_count(dim) <= DIM_BROADCAST_MAX_ROWS  # prepared dims have at most as many rows
    hint = F.broadcast if small else (lambda d: d)
    code_hit = F.lit(None).cast("string")
    if code_col is not None:
        codes = hint(_prepared_dim(dim, "iso2")).withColumnRenamed("__iso2", "__from_code")
        out = out.withColumn("__code_key", tidy_code(code_col))
        out = out.join(codes, out["__code_key"] == codes["__k"], "left").drop("__k")
        code_hit = F.col("__from_code")
        if on_unknown == "passthrough":
            code_hit = F.coalesce(code_hit, _valid_iso2(F.col("__code_key")))
        out = out.withColumn("__from_code", code_hit)
        code_hit = F.col("__from_code")
    if name_col is not None:
        names = hint(_prepared_dim(dim, "name")).withColumnRenamed("__iso2", "__from_name")
        name_key = F.when(code_hit.isNull(), tidy_code(name_col))
        out = out.withColumn("__name_key", name_key)
        out = out.join(names, out["__name_key"] == names["__k"], "left").drop("__k")
        result = F.coalesce(code_hit, F.col("__from_name"))
    else:
        result = code_hit
    out = out.withColumn(out_col, _valid_iso2(result))
    return out.drop("__code_key", "__from_code", "__name_key", "__from_name")
