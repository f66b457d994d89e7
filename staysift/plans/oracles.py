"""DuckDB oracle SQL per registered query (same keys as ``queries.REGISTRY``)."""

from __future__ import annotations

from staysift.plans import oracle_sql as O
from staysift.plans.fixtures import COUNTRY_DIM_SQL, LISTINGS_RAW_SQL

_RAW = f"WITH listings_raw AS ({LISTINGS_RAW_SQL}), dim AS ({COUNTRY_DIM_SQL})\n"


def _cleaning() -> dict[str, str]:
    lat, lon = O.lat_lon("Map")
    lat2, lon2 = O.lat_lon_loose("Map")
    q: dict[str, str] = {}
    q["canonical_headers"] = _RAW + f"""
    SELECT countyCode, countyName, cityCode, cityName, HotelCode, HotelName, HotelRating, Map,
      Attractions, HotelFacilities, Address, {O.raw_tokens('HotelFacilities')} AS facilities_count
    FROM listings_raw"""
    q["star_label_parse"] = _RAW + f"""
    SELECT HotelCode, HotelRating, CAST({O.star('HotelRating')} AS INTEGER) AS star_lenient,
      {O.strict_star('HotelRating')} AS star_strict
    FROM listings_raw"""
    q["lat_lon_parse"] = _RAW + f"""
    SELECT HotelCode, {O.rnd(lat)} AS lat, {O.rnd(lon)} AS lon,
      {O.rnd(lat2)} AS lat_loose, {O.rnd(lon2)} AS lon_loose
    FROM listings_raw"""
    q["city_join_key"] = _RAW + f"""
    SELECT 'd' || CAST(doc_id AS VARCHAR) AS id, {O.city_key('text')} AS city_key FROM documents
    UNION ALL
    SELECT 'h' || HotelCode AS id, {O.city_key('cityName')} AS city_key FROM listings_raw"""
    q["poi_count"] = _RAW + f"""
    SELECT HotelCode, {O.attractions('Attractions')} AS attractions_count FROM listings_raw"""
    q["facility_tokens"] = _RAW + f"""
    SELECT 'p' || CAST(page_id AS VARCHAR) AS id, {O.facility_tokens('html')} AS facility_tokens,
      {O.raw_tokens('html')} AS raw_tokens FROM pages
    UNION ALL
    SELECT 'h' || HotelCode AS id, {O.facility_tokens('HotelFacilities')} AS facility_tokens,
      {O.raw_tokens('HotelFacilities')} AS raw_tokens FROM listings_raw"""
    q["keyword_hits"] = _RAW + f"""
    SELECT 'd' || CAST(doc_id AS VARCHAR) AS id, {O.keyword_hits('text')} AS hits FROM documents
    UNION ALL
    SELECT 'h' || HotelCode AS id, {O.keyword_hits('HotelFacilities')} AS hits FROM listings_raw"""
    q["text_length_flag"] = f"""
    SELECT d.doc_id, CAST(length(coalesce(d.text, '')) AS BIGINT) AS description_length,
      {O.raw_tokens('d.text')} AS facility_count,
      CAST(l.quality IS NOT NULL AS INTEGER) AS has_label,
      CASE WHEN l.quality IS NOT NULL THEN 'Has Label Info' ELSE 'No Label Info' END AS label_text
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
    j_both, iso_both = O.iso2_expr("l.countyCode", "l.countyName")
    j_code, iso_code = O.iso2_expr("l.countyCode", None)
    j_name, iso_name = O.iso2_expr(None, "l.countyName")
    q["country_lookup"] = _RAW + f"""
    SELECT a.HotelCode, a.code_tidy, a.country_iso2, b.iso2_from_code, c.iso2_from_name FROM
      (SELECT l.HotelCode, {O.tidy('l.countyCode')} AS code_tidy, {iso_both} AS country_iso2
       FROM listings_raw l {j_both}) a
      JOIN (SELECT l.HotelCode, {iso_code} AS iso2_from_code FROM listings_raw l {j_code}) b
        ON a.HotelCode = b.HotelCode
      JOIN (SELECT l.HotelCode, {iso_name} AS iso2_from_name FROM listings_raw l {j_name}) c
        ON a.HotelCode = c.HotelCode"""
    q["dedupe_keep_max"] = O.with_base(
        "SELECT country_iso2, city_join_key, City, Country, Population FROM gazetteer_clean", joined=False
    )
    q["null_safe_left_join"] = O.with_base(
        f"SELECT * REPLACE ({O.rnd('hotel_latitude')} AS hotel_latitude, "
        f"{O.rnd('hotel_longitude')} AS hotel_longitude) FROM joined"
    )
    q["null_safe_left_join_shuffled"] = O.with_base("SELECT HotelCode, city_population FROM joined")
    q["join_coverage"] = O.with_base(
        "SELECT CAST(count(*) AS BIGINT) AS rows, "
        "CAST(sum(CASE WHEN city_population IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unmatched, "
        f"{O.rnd('avg(CASE WHEN city_population IS NULL THEN 1.0 ELSE 0.0 END)')} AS unmatched_share FROM joined"
    )
    q["unmatched_keys"] = O.with_base(
        """SELECT DISTINCT l.country_iso2, l.city_join_key FROM listings_clean l
        WHERE NOT EXISTS (SELECT 1 FROM gazetteer_clean g
          WHERE l.country_iso2 IS NOT DISTINCT FROM g.country_iso2
            AND l.city_join_key IS NOT DISTINCT FROM g.city_join_key)""",
        joined=False,
    )
    return q


MEASURES = ["city_population", "attractions_count", "facilities_count", "facilities_keyword_hits", "hotel_latitude"]
NUMERIC = [
    "hotel_star_rating", "city_population", "attractions_count", "facilities_count",
    "facilities_keyword_hits", "hotel_latitude", "hotel_longitude",
]
JOINED_COLS = [
    "countyCode", "countyName", "cityCode", "cityName", "HotelCode", "HotelName", "hotel_star_rating",
    "attractions_count", "facilities_count", "facilities_keyword_hits", "hotel_latitude",
    "hotel_longitude", "city_population",
]


def _case_map(e: str, mapping: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"coalesce(CASE {e} {whens} END, '{default}')"


def _explore() -> dict[str, str]:
    from staysift.operators.lookup import CONTINENT_BY_SUB_REGION, OTHER, SUB_REGION_BY_COUNTRY

    q: dict[str, str] = {}
    B = O.with_base
    q["label_counts"] = B("""SELECT hotel_star_rating, CAST(count(*) AS BIGINT) AS n FROM joined
        WHERE hotel_star_rating IS NOT NULL GROUP BY 1""")
    q["label_counts_with_null"] = B("""SELECT hotel_star_rating, CAST(count(*) AS BIGINT) AS n FROM joined GROUP BY 1""")
    means = ", ".join(f"{O.rnd(f'avg({m})')} AS mean_{m}" for m in MEASURES)
    q["mean_by_label"] = B(f"""SELECT hotel_star_rating, {means},
        {O.rnd('avg(abs(hotel_longitude))')} AS mean_abs_hotel_longitude
        FROM joined WHERE hotel_star_rating IS NOT NULL GROUP BY 1""")
    sub = _case_map("countyName", SUB_REGION_BY_COUNTRY, OTHER)
    cont = _case_map("sub_region", CONTINENT_BY_SUB_REGION, OTHER)
    q["region_rollup"] = B(f"""SELECT 'sub_region' AS level, sub_region AS grp, {O.rnd('avg(hotel_star_rating)')} AS mean
        FROM (SELECT *, {sub} AS sub_region FROM joined) GROUP BY sub_region
        UNION ALL
        SELECT 'continent' AS level, continent AS grp, {O.rnd('avg(hotel_star_rating)')} AS mean
        FROM (SELECT *, {cont} AS continent FROM (SELECT *, {sub} AS sub_region FROM joined)) GROUP BY continent""")
    cm = """(SELECT countyName, avg(hotel_star_rating) AS mean FROM joined WHERE countyName IS NOT NULL
             GROUP BY 1 HAVING avg(hotel_star_rating) IS NOT NULL)"""
    q["top_countries"] = B(f"SELECT countyName, {O.rnd('mean')} AS mean FROM {cm} ORDER BY mean DESC, countyName LIMIT 10")
    q["bottom_countries"] = B(f"SELECT countyName, {O.rnd('mean')} AS mean FROM {cm} ORDER BY mean ASC, countyName LIMIT 10")
    cs = """(SELECT cityName, countyName, avg(hotel_star_rating) AS mean,
               CAST(count(hotel_star_rating) AS BIGINT) AS count,
               cityName || ' (' || countyName || ')' AS city_label
             FROM joined WHERE cityName IS NOT NULL AND countyName IS NOT NULL
             GROUP BY cityName, countyName HAVING avg(hotel_star_rating) IS NOT NULL)"""
    cols = f"cityName, countyName, {O.rnd('mean')} AS mean, count, city_label"
    q["city_stats"] = B(f"SELECT {cols} FROM {cs}")
    q["top_cities"] = B(f"SELECT {cols} FROM {cs} WHERE count >= 10 ORDER BY mean DESC, cityName, countyName LIMIT 10")
    q["bottom_cities"] = B(f"SELECT {cols} FROM {cs} WHERE count >= 10 ORDER BY mean ASC, cityName, countyName LIMIT 10")
    q["map_points"] = B(f"""SELECT * FROM (SELECT cityName, countyName,
          {O.rnd('avg(hotel_star_rating)')} AS hotel_star_rating, {O.rnd('avg(hotel_latitude)')} AS hotel_latitude,
          {O.rnd('avg(hotel_longitude)')} AS hotel_longitude
        FROM joined WHERE cityName IS NOT NULL AND countyName IS NOT NULL GROUP BY 1, 2)
        WHERE hotel_star_rating IS NOT NULL AND hotel_latitude IS NOT NULL AND hotel_longitude IS NOT NULL""")
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100.0 AS p FROM joined"
        for c in JOINED_COLS
    )
    q["missing_profile"] = B(f"""SELECT "column", {O.rnd('p')} AS missing_pct FROM ({parts})
        ORDER BY p DESC, "column" LIMIT 12""")
    q["shape"] = B("SELECT CAST(count(*) AS BIGINT) AS rows, CAST(13 AS BIGINT) AS columns FROM joined")
    pairs = []
    for i, a in enumerate(NUMERIC):
        for b in NUMERIC[i:]:
            pairs.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {O.rnd(f'corr({a}, {b})')} AS corr FROM joined")
            if a != b:
                pairs.append(f"SELECT '{b}' AS col_a, '{a}' AS col_b, {O.rnd(f'corr({a}, {b})')} AS corr FROM joined")
    q["correlation_matrix"] = B(" UNION ALL ".join(pairs))
    diag = " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, {O.rnd(f'skewness({c})')} AS skewness,
            CAST(count(DISTINCT {c}) AS BIGINT) AS unique_values,
            CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_values FROM joined"""
        for c in ["city_population", "facilities_count", "attractions_count"]
    )
    q["feature_diagnostics"] = B(diag)

    def box(src: str, g: str, v: str) -> str:
        return f"""SELECT b.{g}, {O.rnd('b.q1')} AS q1, {O.rnd('b.median')} AS median, {O.rnd('b.q3')} AS q3,
            {O.rnd(f'min(CASE WHEN s.v >= b.q1 - 1.5 * (b.q3 - b.q1) AND s.v <= b.q3 + 1.5 * (b.q3 - b.q1) THEN s.v END)')} AS whisker_low,
            {O.rnd(f'max(CASE WHEN s.v >= b.q1 - 1.5 * (b.q3 - b.q1) AND s.v <= b.q3 + 1.5 * (b.q3 - b.q1) THEN s.v END)')} AS whisker_high,
            CAST(sum(CASE WHEN s.v >= b.q1 - 1.5 * (b.q3 - b.q1) AND s.v <= b.q3 + 1.5 * (b.q3 - b.q1) THEN 0 ELSE 1 END) AS BIGINT) AS outliers,
            CAST(count(*) AS BIGINT) AS n
          FROM (SELECT {g}, CAST({v} AS DOUBLE) AS v FROM {src} WHERE {g} IS NOT NULL AND {v} IS NOT NULL) s
          JOIN (SELECT {g}, quantile_cont(CAST({v} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({v} AS DOUBLE), 0.5) AS median,
                  quantile_cont(CAST({v} AS DOUBLE), 0.75) AS q3
                FROM {src} WHERE {g} IS NOT NULL AND {v} IS NOT NULL GROUP BY 1) b ON s.{g} = b.{g}
          GROUP BY b.{g}, b.q1, b.median, b.q3"""

    q["box_summary"] = B(box("joined", "hotel_star_rating", "facilities_count"))
    q["box_summary_lineitem"] = box("lineitem", "l_returnflag", "l_extendedprice")
    q["cohens_d"] = f"""SELECT n_high, n_low, {O.rnd('mean_high')} AS mean_high, {O.rnd('mean_low')} AS mean_low,
        {O.rnd('var_high')} AS var_high, {O.rnd('var_low')} AS var_low, {O.rnd('d')} AS cohens_d,
        CASE WHEN abs(d) < 0.2 THEN 'negligible' WHEN abs(d) < 0.5 THEN 'small'
             WHEN abs(d) < 0.8 THEN 'medium' ELSE 'large' END AS effect_size
      FROM (SELECT *, (mean_high - mean_low) / sqrt(((n_high - 1) * var_high + (n_low - 1) * var_low)
                 / (n_high + n_low - 2)) AS d
        FROM (SELECT count(CASE WHEN l.quality = 1 THEN length(d.text) END) AS n_high,
                     count(CASE WHEN l.quality <> 1 THEN length(d.text) END) AS n_low,
                     avg(CASE WHEN l.quality = 1 THEN length(d.text) END) AS mean_high,
                     avg(CASE WHEN l.quality <> 1 THEN length(d.text) END) AS mean_low,
                     var_samp(CASE WHEN l.quality = 1 THEN length(d.text) END) AS var_high,
                     var_samp(CASE WHEN l.quality <> 1 THEN length(d.text) END) AS var_low
              FROM documents d JOIN labels l ON d.doc_id = l.doc_id))"""
    q["mann_whitney"] = f"""WITH c AS (
        SELECT CAST(value AS DOUBLE) AS v, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS nh,
               sum(CASE WHEN event_type = 'click' THEN 0 ELSE 1 END) AS nl, count(*) AS cnt
        FROM events WHERE event_type IS NOT NULL AND value IS NOT NULL GROUP BY 1),
      r AS (SELECT *, sum(cnt) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - cnt AS before FROM c),
      a AS (SELECT CAST(sum(nh) AS DOUBLE) AS n1, CAST(sum(nl) AS DOUBLE) AS n2,
                   sum(nh * (before + (cnt + 1) / 2.0)) AS r1,
                   sum(CAST(cnt AS DOUBLE) * cnt * cnt - cnt) AS tie FROM r),
      u AS (SELECT *, r1 - n1 * (n1 + 1) / 2.0 AS u1 FROM a),
      s AS (SELECT *, (greatest(u1, n1 * n2 - u1) - n1 * n2 / 2.0 - 0.5)
          / sqrt(n1 * n2 / 12.0 * ((n1 + n2 + 1) - tie / ((n1 + n2) * (n1 + n2 - 1)))) AS z FROM u),
      p AS (SELECT *, {O.normal_p('s.z')} AS p_value FROM s)
      SELECT CAST(n1 AS BIGINT) AS n_high, CAST(n2 AS BIGINT) AS n_low, {O.rnd('u1')} AS u_statistic,
        {O.rnd('z')} AS z, {O.rnd('p_value')} AS p_value, {O.p_label('p_value')} AS interpretation
      FROM p"""
    q["ols_simple"] = f"""SELECT n, {O.rnd('b')} AS coefficient, {O.rnd('a')} AS intercept, {O.rnd('r2')} AS r_squared,
        {O.rnd('b / sqrt((1 - r2) * syy / (n - 2) / sxx)')} AS t
      FROM (SELECT CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n,
                   regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a,
                   regr_r2(l_extendedprice, l_quantity) AS r2, regr_sxx(l_extendedprice, l_quantity) AS sxx,
                   regr_syy(l_extendedprice, l_quantity) AS syy FROM lineitem)"""
    return q


def _models() -> dict[str, str]:
    from staysift.plans.queries import IMPUTE_FIXTURE, LINEAR_FIXTURE, PERM_FIXTURE

    q: dict[str, str] = {}
    q["exact_sample"] = """SELECT c_custkey, c_mktsegment FROM customer
        ORDER BY md5(concat_ws('|', CAST(c_custkey AS VARCHAR), '42')) LIMIT 500"""
    q["stratified_split"] = """WITH c AS (
          SELECT c_custkey, c_mktsegment, md5(concat_ws('|', CAST(c_custkey AS VARCHAR), '42')) AS h FROM customer),
        n AS (SELECT c_mktsegment, count(*) AS cnt FROM c GROUP BY 1),
        q AS (SELECT *, floor(cnt * CAST(0.2 AS DOUBLE)) AS base,
                ceil(sum(cnt) OVER () * CAST(0.2 AS DOUBLE)) - sum(floor(cnt * CAST(0.2 AS DOUBLE))) OVER () AS need,
                row_number() OVER (ORDER BY cnt * CAST(0.2 AS DOUBLE) - floor(cnt * CAST(0.2 AS DOUBLE)) DESC,
                                   c_mktsegment) - 1 AS pos FROM n),
        qq AS (SELECT c_mktsegment, base + CASE WHEN pos < need THEN 1 ELSE 0 END AS quota FROM q),
        r AS (SELECT c.*, row_number() OVER (PARTITION BY c_mktsegment ORDER BY h) - 1 AS rk FROM c)
        SELECT r.c_custkey, r.c_mktsegment, CASE WHEN r.rk < qq.quota THEN 'test' ELSE 'train' END AS split
        FROM r JOIN qq ON r.c_mktsegment = qq.c_mktsegment"""
    parts = []
    for c in ["price", "cust_mod", "constant"]:
        parts.append(f"""SELECT '{c}' AS feature, {O.rnd('m')} AS median, {O.rnd(f'avg(coalesce({c}, m))')} AS mean,
            {O.rnd(f'CASE WHEN coalesce(stddev_pop(coalesce({c}, m)), 0) = 0 THEN 1.0 ELSE stddev_pop(coalesce({c}, m)) END')} AS scale
            FROM f, (SELECT quantile_cont({c}, 0.5) AS m FROM f) GROUP BY m""")
    q["impute_scale"] = f"WITH f AS ({IMPUTE_FIXTURE})\n" + " UNION ALL ".join(parts)
    q["capped_one_hot"] = """WITH c AS (SELECT coalesce(p_brand, '__MISSING__') AS lvl, count(*) AS n FROM part GROUP BY 1),
        kept AS (SELECT lvl FROM c ORDER BY n DESC, lvl LIMIT 7)
        SELECT p_partkey, 'p_brand_' || CASE WHEN (SELECT count(*) FROM c) <= 8 THEN coalesce(p_brand, '__MISSING__')
             WHEN coalesce(p_brand, '__MISSING__') IN (SELECT lvl FROM kept) THEN coalesce(p_brand, '__MISSING__')
             ELSE 'infrequent' END AS slot
        FROM part"""
    err = "(y / 1.5 - x1)"
    q["regression_metrics"] = f"""WITH f AS ({LINEAR_FIXTURE})
        SELECT {O.rnd(f'sqrt(avg({err} * {err}))')} AS rmse, {O.rnd(f'avg(abs({err}))')} AS mae,
          {O.rnd(f'1 - sum({err} * {err}) / (var_pop(x1) * count(x1))')} AS r2,
          {O.rnd(f'avg(CASE WHEN abs({err}) <= 0.5 THEN 1.0 ELSE 0.0 END)')} AS within_0_5,
          {O.rnd(f'avg(CASE WHEN abs({err}) <= 1.0 THEN 1.0 ELSE 0.0 END)')} AS within_1_0,
          CAST(count(*) AS BIGINT) AS n FROM f"""
    q["metrics_by_bucket"] = f"""WITH f AS ({LINEAR_FIXTURE})
        SELECT l_returnflag AS bucket, {O.rnd(f'sqrt(avg({err} * {err}))')} AS rmse, {O.rnd(f'avg(abs({err}))')} AS mae,
          {O.rnd(f'avg(CASE WHEN abs({err}) <= 0.5 THEN 1.0 ELSE 0.0 END)')} AS within_0_5,
          {O.rnd(f'avg(CASE WHEN abs({err}) <= 1.0 THEN 1.0 ELSE 0.0 END)')} AS within_1_0,
          CAST(count(*) AS BIGINT) AS n FROM f GROUP BY 1"""

    def ridge_sql(alpha: str, digits: int) -> str:
        return f"""WITH f AS ({LINEAR_FIXTURE}),
          s AS (SELECT count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my,
                  var_pop(x1) * count(*) + {alpha} AS a11, var_pop(x2) * count(*) + {alpha} AS a22,
                  covar_pop(x1, x2) * count(*) AS a12, covar_pop(x1, y) * count(*) AS r1,
                  covar_pop(x2, y) * count(*) AS r2 FROM f),
          b AS (SELECT *, (r1 * a22 - a12 * r2) / (a11 * a22 - a12 * a12) AS b1,
                  (a11 * r2 - a12 * r1) / (a11 * a22 - a12 * a12) AS b2 FROM s)
          SELECT 'intercept' AS term, {O.rnd('my - b1 * m1 - b2 * m2', digits)} AS estimate FROM b
          UNION ALL SELECT 'x1', {O.rnd('b1', digits)} FROM b
          UNION ALL SELECT 'x2', {O.rnd('b2', digits)} FROM b"""

    # both coefficients stay non-zero at this penalty: the optimality conditions are the
    # normal equations with the penalty times each sign taken off the right side
    q["lasso_fit"] = f"""WITH f AS ({LINEAR_FIXTURE}),
          s AS (SELECT avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, var_pop(x1) AS a11, var_pop(x2) AS a22,
                  covar_pop(x1, x2) AS a12, covar_pop(x1, y) AS c1, covar_pop(x2, y) AS c2 FROM f),
          g AS (SELECT *, sign(c1 * a22 - a12 * c2) AS s1, sign(a11 * c2 - a12 * c1) AS s2 FROM s),
          r AS (SELECT *, c1 - 0.001 * s1 AS r1, c2 - 0.001 * s2 AS r2 FROM g),
          b AS (SELECT *, (r1 * a22 - a12 * r2) / (a11 * a22 - a12 * a12) AS b1,
                  (a11 * r2 - a12 * r1) / (a11 * a22 - a12 * a12) AS b2 FROM r)
          SELECT 'intercept' AS term, {O.rnd('my - b1 * m1 - b2 * m2', 3)} AS estimate FROM b
          UNION ALL SELECT 'x1', {O.rnd('b1', 3)} FROM b
          UNION ALL SELECT 'x2', {O.rnd('b2', 3)} FROM b"""
    # moments of each held-out fold (three of them, by md5 of the keys and the seed 42) and of its training rows
    names = "n s1 s2 sy q11 q12 q22 p1 p2 yy".split()
    folds = f"""WITH f AS ({LINEAR_FIXTURE}),
          k AS (SELECT *, CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, '42')), 1, 8) AS BIGINT) % 3 AS fold FROM f),
          m AS (SELECT CAST(fold AS INTEGER) AS fold, CAST(count(*) AS DOUBLE) AS n, sum(x1) AS s1, sum(x2) AS s2, sum(y) AS sy,
                  sum(x1 * x1) AS q11, sum(x1 * x2) AS q12, sum(x2 * x2) AS q22, sum(x1 * y) AS p1, sum(x2 * y) AS p2,
                  sum(y * y) AS yy FROM k GROUP BY ALL),
          t AS (SELECT {', '.join(f'sum({c}) AS t{c}' for c in names)} FROM m),
          h AS (SELECT fold, {', '.join(f'{c}, t{c} - {c} AS r{c}' for c in names)} FROM m, t
                UNION ALL SELECT -1, {', '.join(f'0, t{c}' for c in names)} FROM t),
          c AS (SELECT *, rq11 - rs1 * rs1 / rn AS a11, rq12 - rs1 * rs2 / rn AS a12, rq22 - rs2 * rs2 / rn AS a22,
                  rp1 - rs1 * rsy / rn AS c1, rp2 - rs2 * rsy / rn AS c2 FROM h)"""
    held_out = """e AS (SELECT *, yy - 2 * (w1 * p1 + w2 * p2 + b * sy) + w1 * w1 * q11 + 2 * w1 * w2 * q12 + w2 * w2 * q22
                  + 2 * b * (w1 * s1 + w2 * s2) + n * b * b AS sse, yy - sy * sy / n AS sst FROM i WHERE fold >= 0)"""
    q["tuned_ridge"] = folds + f""",
          al AS (SELECT pow(10.0, -3 + 0.5 * i) AS alpha FROM range(13) r(i)),
          w AS (SELECT *, (a11 + alpha) * (a22 + alpha) - a12 * a12 AS det FROM c, al),
          v AS (SELECT *, ((a22 + alpha) * c1 - a12 * c2) / det AS w1, ((a11 + alpha) * c2 - a12 * c1) / det AS w2 FROM w),
          i AS (SELECT *, (rsy - w1 * rs1 - w2 * rs2) / rn AS b FROM v),
          {held_out},
          best AS (SELECT alpha FROM e GROUP BY alpha ORDER BY avg(1 - sse / sst) DESC LIMIT 1)
          SELECT {O.rnd('e.alpha')} AS alpha, fold, {O.rnd('sqrt(sse / n)')} AS rmse, {O.rnd('1 - sse / sst')} AS r2,
            e.alpha = best.alpha AS chosen FROM e, best"""
    # the only solution that keeps the subgradient conditions, among the signs that two coefficients can have
    q["random_search"] = folds + f""",
          al AS (SELECT pow(10.0, -4 + 4 * i / 19.0) AS alpha FROM (VALUES (3), (0), (8), (7), (16), (2), (11), (1), (10), (17), (12), (6)) r(i)),
          s AS (SELECT *, a11 / rn AS d11, a12 / rn AS d12, a22 / rn AS d22, c1 / rn AS g1, c2 / rn AS g2 FROM c, al,
                  (SELECT unnest([-1, 0, 1]) AS s1_) u1, (SELECT unnest([-1, 0, 1]) AS s2_) u2),
          w AS (SELECT *,
                  CASE WHEN s1_ = 0 THEN 0.0 WHEN s2_ = 0 THEN (g1 - alpha * s1_) / d11
                       ELSE ((g1 - alpha * s1_) * d22 - d12 * (g2 - alpha * s2_)) / (d11 * d22 - d12 * d12) END AS w1,
                  CASE WHEN s2_ = 0 THEN 0.0 WHEN s1_ = 0 THEN (g2 - alpha * s2_) / d22
                       ELSE (d11 * (g2 - alpha * s2_) - d12 * (g1 - alpha * s1_)) / (d11 * d22 - d12 * d12) END AS w2 FROM s),
          v AS (SELECT * FROM w WHERE sign(w1) = s1_ AND sign(w2) = s2_
                  AND (s1_ <> 0 OR abs(g1 - d12 * w2) <= alpha) AND (s2_ <> 0 OR abs(g2 - d12 * w1) <= alpha)),
          i AS (SELECT *, (rsy - w1 * rs1 - w2 * rs2) / rn AS b FROM v),
          {held_out},
          mean AS (SELECT alpha, avg(sqrt(sse / n)) AS rmse FROM e GROUP BY alpha)
          SELECT {O.rnd('i.alpha')} AS alpha, {O.rnd('mean.rmse')} AS rmse, {O.rnd('b')} AS intercept, {O.rnd('w1')} AS x1, {O.rnd('w2')} AS x2,
            mean.rmse = (SELECT min(rmse) FROM mean) AS chosen FROM i JOIN mean USING (alpha) WHERE fold < 0"""
    q["linear_fit"] = ridge_sql("0", 4)
    q["ridge_fit"] = ridge_sql("10.0", 4)
    q["permutation_test"] = f"""WITH f AS ({PERM_FIXTURE}),
      reg AS (SELECT regr_slope(f1, f2) AS b12, regr_intercept(f1, f2) AS a12,
                     regr_slope(f2, f1) AS b21, regr_intercept(f2, f1) AS a21 FROM f),
      r AS (SELECT f.o_orderkey, f.y, f.f1 - (reg.a12 + reg.b12 * f.f2) AS r1,
                   f.f2 - (reg.a21 + reg.b21 * f.f1) AS r2 FROM f, reg),
      ss AS (SELECT sum(r1 * r1) AS s1, sum(r2 * r2) AS s2 FROM r),
      w AS (SELECT r.o_orderkey, r.y, r.r1 / ss.s1 AS w1, r.r2 / ss.s2 AS w2 FROM r, ss),
      obs AS (SELECT sum(w1 * y) AS c1, sum(w2 * y) AS c2 FROM w),
      base AS (SELECT y, row_number() OVER (ORDER BY md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), '42'))) - 1 AS k FROM w),
      num AS (SELECT w1, w2, row_number() OVER (ORDER BY md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), '42'))) - 1 AS k FROM w),
      n AS (SELECT count(*) AS n FROM w),
      pp AS (SELECT min(c) AS p FROM n, (SELECT unnest(range((SELECT count(*) FROM w), (SELECT count(*) + 2000 FROM w))) AS c)
             WHERE NOT EXISTS (SELECT 1 FROM range(2, 20000) d(d) WHERE d * d <= c AND c % d = 0)),
      co AS (SELECT perm, p, n, ('0x' || substr(md5('42|' || perm || '|a'), 1, 15))::BIGINT % (p - 1) + 1 AS a,
               ('0x' || substr(md5('42|' || perm || '|b'), 1, 15))::BIGINT % p AS b FROM pp, n, range(400) g(perm)),
      s1 AS (SELECT c.*, w1, w2, (a * k + b) % p AS x FROM num, co c),
      s2 AS (SELECT * REPLACE (CASE WHEN x < n THEN x ELSE (a * x + b) % p END AS x) FROM s1),
      s3 AS (SELECT * REPLACE (CASE WHEN x < n THEN x ELSE (a * x + b) % p END AS x) FROM s2),
      s4 AS (SELECT * REPLACE (CASE WHEN x < n THEN x ELSE (a * x + b) % p END AS x) FROM s3),
      s5 AS (SELECT * REPLACE (CASE WHEN x < n THEN x ELSE (a * x + b) % p END AS x) FROM s4),
      pr AS (SELECT perm, w1, w2, x AS k FROM s5),
      nulls AS (SELECT perm, sum(pr.w1 * base.y) AS n1, sum(pr.w2 * base.y) AS n2 FROM pr JOIN base ON pr.k = base.k
                GROUP BY perm)
      SELECT 'f1' AS feature, {O.rnd('obs.c1')} AS observed_coefficient,
        {O.rnd('(sum(CASE WHEN abs(n1) >= abs(obs.c1) THEN 1 ELSE 0 END) + 1) / CAST(count(*) + 1 AS DOUBLE)')} AS empirical_p_value_two_sided,
        {O.rnd('avg(n1)')} AS null_mean, {O.rnd('stddev_samp(n1)')} AS null_std, CAST(count(*) AS BIGINT) AS n_permutations
      FROM nulls, obs GROUP BY obs.c1
      UNION ALL
      SELECT 'f2', {O.rnd('obs.c2')},
        {O.rnd('(sum(CASE WHEN abs(n2) >= abs(obs.c2) THEN 1 ELSE 0 END) + 1) / CAST(count(*) + 1 AS DOUBLE)')},
        {O.rnd('avg(n2)')}, {O.rnd('stddev_samp(n2)')}, CAST(count(*) AS BIGINT)
      FROM nulls, obs GROUP BY obs.c2"""
    return q


def _io() -> dict[str, str]:
    from staysift.operators.schema import MISSING_TOKENS

    toks = ", ".join("'" + t.replace("'", "''") + "'" for t in MISSING_TOKENS)
    cols = ["countyCode", "countyName", "cityCode", "cityName", "HotelCode", "HotelName", "HotelRating", "Map",
            "Attractions", "HotelFacilities", "Address"]
    sel = []
    for c in cols:
        v = f"ltrim({c})"
        sel.append(f"NULLIF({v}, '') AS {c}" if c == "countyCode" else f"CASE WHEN {v} IN ({toks}) THEN NULL ELSE {v} END AS {c}")
    q: dict[str, str] = {}
    q["csv_roundtrip"] = _RAW + "SELECT " + ", ".join(sel) + " FROM listings_raw"
    q["stream_enrich"] = O.with_base(
        f"SELECT * REPLACE ({O.rnd('hotel_latitude')} AS hotel_latitude, "
        f"{O.rnd('hotel_longitude')} AS hotel_longitude) FROM joined"
    )
    q["stream_enrich_large"] = q["stream_enrich"]
    lat2, lon2 = O.lat_lon_loose("Map")
    q["expanded_features"] = _RAW + f"""SELECT HotelCode, {O.strict_star('HotelRating')} AS hotel_star_rating,
        {O.raw_tokens('HotelFacilities')} AS facility_count,
        CAST(length(coalesce(Attractions, '')) AS BIGINT) AS description_length,
        CAST(Attractions IS NOT NULL AS INTEGER) AS has_attractions,
        CASE WHEN Attractions IS NOT NULL THEN 'Has Attractions Info' ELSE 'No Attractions Info' END AS attractions_label,
        {O.rnd(lat2)} AS latitude, {O.rnd(lon2)} AS longitude
      FROM listings_raw"""
    fc = O.raw_tokens("HotelFacilities")
    parts = []
    for split, src, high in (("rating", "rated", "star >= 4"), ("attractions", "e", "info")):
        d = O.cohens_d_value(src, "v", high)
        parts.append(f"""SELECT 'cohens_d' AS test, '{split}' AS split, {O.rnd('d')} AS statistic,
            CAST(NULL AS DOUBLE) AS p_value, {O.d_label('d')} AS interpretation FROM ({d})""")
        m = O.mann_whitney_value(src, "v", high)
        parts.append(f"""SELECT 'mann_whitney', '{split}', {O.rnd('u1')}, {O.rnd('p')}, {O.p_label('p')}
            FROM (SELECT u1, {O.normal_p('m.z')} AS p FROM ({m}) m)""")
    parts.append(f"""SELECT 'ols', 'rating', {O.rnd('b')}, {O.rnd('p')}, {O.p_label('p')}
        FROM (SELECT b, {O.t_p('s.t', 's.dof')} AS p FROM (SELECT b, CAST(n AS DOUBLE) - 2 AS dof, b / sqrt((1 - r2) * syy / (n - 2) / sxx) AS t
          FROM (SELECT regr_count(star, v) AS n, regr_slope(star, v) AS b, regr_r2(star, v) AS r2,
                       regr_sxx(star, v) AS sxx, regr_syy(star, v) AS syy FROM e)) s)""")
    q["expanded_tests"] = _RAW + f""", e AS (SELECT {fc} AS v, {O.strict_star('HotelRating')} AS star,
          Attractions IS NOT NULL AS info FROM listings_raw), rated AS (SELECT * FROM e WHERE star IS NOT NULL)
        """ + " UNION ALL ".join(parts)
    parts = []
    for x, y in (("l_tax", "l_discount"), ("l_linenumber", "l_quantity")):
        parts.append(f"""SELECT '{x}' AS feature, CAST(n AS BIGINT) AS n, {O.rnd('t')} AS t, {O.rnd('p')} AS p_value,
            {O.p_label('p')} AS interpretation FROM (SELECT n, t, {O.t_p('s.t', 's.dof')} AS p
              FROM (SELECT n, CAST(n AS DOUBLE) - 2 AS dof, b / sqrt((1 - r2) * syy / (n - 2) / sxx) AS t
                FROM (SELECT regr_count({y}, {x}) AS n, regr_slope({y}, {x}) AS b, regr_r2({y}, {x}) AS r2,
                             regr_sxx({y}, {x}) AS sxx, regr_syy({y}, {x}) AS syy FROM lineitem)) s)""")
    q["ols_p_value"] = " UNION ALL ".join(parts)
    # every choice of five ranks among 25 is as likely: those at least as far out are counted
    q["mann_whitney_small"] = f"""WITH means AS (SELECT c_mktsegment AS segment, o_orderpriority, avg(o_totalprice) AS mean
            FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
          ranked AS (SELECT *, row_number() OVER (ORDER BY mean) AS r FROM means),
          u AS (SELECT segment, count(*) AS n1, sum(r) - 15 AS u FROM ranked GROUP BY segment),
          g AS (SELECT CAST(unnest(range(1, 26)) AS INTEGER) AS r),
          picks AS (SELECT a.r + b.r + c.r + d.r + e.r - 15 AS u FROM g a, g b, g c, g d, g e
                    WHERE a.r < b.r AND b.r < c.r AND c.r < d.r AND d.r < e.r)
          SELECT segment, n1 AS n_high, CAST(25 - n1 AS BIGINT) AS n_low, CAST(u AS DOUBLE) AS u_statistic,
            {O.rnd("least(1.0, 2.0 * (SELECT count(*) FROM picks WHERE picks.u <= least(u.u, 100 - u.u)) / CAST(53130 AS DOUBLE))")} AS p_value,
            TRUE AS exact FROM u"""
    q["regplot_band"] = _regplot_band_sql()
    share = "CAST(0.2 AS DOUBLE)"
    widths = " + ".join(
        f"(SELECT least(count(DISTINCT coalesce(CAST({c} AS VARCHAR), '__MISSING__')), {cap}) FROM tr)"
        for c, cap in (("countyCode", 250), ("cityCode", 120), ("cityName", 80))
    )
    q["feature_matrix"] = O.with_base(f"""
    , c AS (SELECT *, md5(concat_ws('|', HotelCode, '42')) AS h FROM joined WHERE hotel_star_rating IS NOT NULL),
      n AS (SELECT hotel_star_rating AS cls, count(*) AS cnt FROM c GROUP BY 1),
      q AS (SELECT *, floor(cnt * {share}) AS base,
              ceil(sum(cnt) OVER () * {share}) - sum(floor(cnt * {share})) OVER () AS need,
              row_number() OVER (ORDER BY cnt * {share} - floor(cnt * {share}) DESC, cls) - 1 AS pos FROM n),
      qq AS (SELECT cls, base + CASE WHEN pos < need THEN 1 ELSE 0 END AS quota FROM q),
      r AS (SELECT c.*, row_number() OVER (PARTITION BY hotel_star_rating ORDER BY h) - 1 AS rk FROM c),
      s AS (SELECT r.*, CASE WHEN r.rk < qq.quota THEN 'test' ELSE 'train' END AS split
            FROM r JOIN qq ON r.hotel_star_rating = qq.cls),
      tr AS (SELECT * FROM s WHERE split = 'train')
    SELECT split, CAST(count(*) AS BIGINT) AS rows, CAST(6 + {widths} AS BIGINT) AS width,
      {O.rnd('avg(CAST(hotel_star_rating AS DOUBLE))')} AS mean_label
    FROM s GROUP BY split""")
    return q


def _regplot_band_sql(n_boot: int = 1000, grid: int = 100, seed: int = 42, level: float = 0.95) -> str:
    """Poisson bootstrap band with the same hash-derived weights as Spark."""
    import math

    cdf, term, whens = 0.0, math.exp(-1.0), []
    for k in range(13):
        cdf += term
        term /= k + 1
        whens.append(f"WHEN u < CAST('{cdf!r}' AS DOUBLE) THEN {k}")
    poisson = "CASE " + " ".join(whens) + " ELSE 13 END"
    alpha = (1 - level) / 2
    h = f"md5(concat_ws('|', HotelCode, '{seed}'))"
    return O.with_base(f"""
    , base AS (SELECT HotelCode, CAST(facilities_count AS DOUBLE) AS x, CAST(hotel_star_rating AS DOUBLE) AS y
               FROM joined WHERE hotel_star_rating IS NOT NULL AND facilities_count IS NOT NULL),
      keyed AS (SELECT *, ('0x' || substr({h}, 1, 8))::BIGINT % 2147483647 AS a,
                 ('0x' || substr({h}, 9, 8))::BIGINT % 2147483646 + 1 AS bb FROM base),
      reps AS (SELECT k.*, r.rep, ((a + bb * r.rep) % 2147483647) / CAST(2147483647 AS DOUBLE) AS u
               FROM keyed k, range(-1, {n_boot}) r(rep)),
      w AS (SELECT rep, x, y, CASE WHEN rep < 0 THEN 1.0 ELSE CAST({poisson} AS DOUBLE) END AS w FROM reps),
      sums AS (SELECT rep, sum(w) AS sw, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx,
                 sum(w * x * y) AS sxy, min(x) AS lo, max(x) AS hi FROM w GROUP BY rep),
      fits AS (SELECT rep, lo, hi, (sw * sxy - sx * sy) / (sw * sxx - sx * sx) AS b1,
                 (sy - (sw * sxy - sx * sy) / (sw * sxx - sx * sx) * sx) / sw AS b0 FROM sums),
      preds AS (SELECT rep, g.g, lo + (hi - lo) / CAST({float(max(grid - 1, 1))!r} AS DOUBLE) * g.g AS x,
                  b0 + b1 * (lo + (hi - lo) / CAST({float(max(grid - 1, 1))!r} AS DOUBLE) * g.g) AS pred
                FROM fits, range(0, {grid}) g(g))
    SELECT g, {O.rnd('max(x)')} AS x, {O.rnd('max(CASE WHEN rep < 0 THEN pred END)')} AS fit,
      {O.rnd(f'quantile_cont(CASE WHEN rep >= 0 THEN pred END, {alpha!r})')} AS band_low,
      {O.rnd(f'quantile_cont(CASE WHEN rep >= 0 THEN pred END, {1 - alpha!r})')} AS band_high
    FROM preds GROUP BY g""".replace("\n    , base AS", ", base AS", 1))


def all_oracles() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(_cleaning())
    out.update(_explore())
    out.update(_models())
    out.update(_io())
    from staysift.plans.io_queries import oracles

    out.update(oracles())
    return out
