"""The same results in plain SQL, from the given tables, for another engine to run."""

from __future__ import annotations

_RV = """
rv AS (
  SELECT event_id,
    CASE WHEN event_id % 11 = 0 THEN '-1' ELSE CAST(user_id AS VARCHAR) END AS "gPlusPlaceId",
    CASE WHEN event_id % 89 <> 0 THEN CAST(event_id // 10 AS VARCHAR) END AS "gPlusUserId",
    CAST(CAST(floor(value) AS BIGINT) % 6 AS DOUBLE) AS rating,
    props AS "reviewText",
    CASE WHEN event_id % 13 = 0 THEN NULL
         WHEN event_id % 17 = 0 THEN CAST([] AS VARCHAR[])
         WHEN event_id % 19 = 0 THEN [event_type, '']
         WHEN event_id % 23 = 0 THEN [event_type, NULL]
         ELSE [event_type, 'batch' || CAST(event_id // 16 AS VARCHAR)] END AS categories,
    CAST(floor(epoch(ts)) AS BIGINT) AS "unixReviewTime"
  FROM events
)"""

_PL = """
pl AS (
  SELECT CAST(c_custkey AS VARCHAR) AS "gPlusPlaceId",
    c_name || again AS name,
    CASE WHEN c_custkey % 7 <> 0 THEN repeat('$', c_custkey % 5 + 1) END AS price,
    CASE WHEN c_custkey % 29 = 0 THEN NULL
         WHEN c_custkey % 31 = 0 THEN CAST([] AS VARCHAR[])
         ELSE [c_name, 'No. ' || CAST(c_custkey AS VARCHAR),
           CASE WHEN c_nationkey < 15
             THEN CASE WHEN c_nationkey < 8 THEN 'Town, CA ' ELSE 'Town, NY ' END
                  || lpad(CAST(c_custkey % 100 AS VARCHAR), 5, '0')
             ELSE 'Town ' || CAST(c_nationkey AS VARCHAR) END] END AS address
  FROM customer, (VALUES (''), (' again')) t(again)
  WHERE again = '' OR (c_nationkey >= 15 AND c_custkey % 5 = 0)
)"""

_POP = """
pop AS (
  SELECT lpad(CAST(c_custkey % 80 AS VARCHAR), 5, '0') AS zip, CAST(c_custkey AS VARCHAR) AS census
  FROM customer
),
zips AS (SELECT zip, sum(TRY_CAST(census AS DOUBLE)) AS population FROM pop GROUP BY zip)"""

_ENDING = r"string_split(address[-1], ', ')[-1]"
_US = r"'^([A-Z]{2})\s([0-9]{5})'"

_PLACES = f"""
place_parts AS (
  SELECT "gPlusPlaceId", name, CAST(length(price) AS INTEGER) AS price,
    coalesce(array_to_string(address, ','), '') AS address,
    nullif(regexp_extract({_ENDING}, {_US}, 1), '') AS state,
    nullif(regexp_extract({_ENDING}, {_US}, 2), '') AS postcode
  FROM pl
),
places AS (
  SELECT p.*, CASE WHEN state IS NOT NULL THEN 'USA' END AS country, z.population
  FROM place_parts p LEFT JOIN zips z ON p.postcode = z.zip
)"""

_REVIEWS = """
timed AS (
  SELECT event_id, "gPlusPlaceId", "gPlusUserId", rating, "reviewText", categories,
    make_timestamp("unixReviewTime" * 1000000) AS "reviewTime"
  FROM rv
),
features AS (
  SELECT *, strftime("reviewTime", '%a') AS weekday,
    CASE WHEN hour("reviewTime") < 8 OR hour("reviewTime") >= 18 THEN 'night' ELSE 'day' END AS day_night
  FROM timed
),
reviews AS (
  SELECT *, avg(rating) OVER (PARTITION BY "gPlusUserId") AS "userAvgRating" FROM features
)"""

_LAKE = """
joined AS (
  SELECT r."gPlusPlaceId", r.day_night, r."gPlusUserId", r.rating, r."reviewTime", r."reviewText",
    r."userAvgRating", r.weekday, r.categories, p.address, p.country, p.name, p.population,
    p.postcode, p.price, p.state
  FROM reviews r JOIN places p ON r."gPlusPlaceId" = p."gPlusPlaceId"
  WHERE r.categories IS NOT NULL AND p.country = 'USA'
),
exploded AS (SELECT * EXCLUDE (categories), unnest(categories) AS category FROM joined),
counted AS (SELECT *, count(*) OVER (PARTITION BY category) AS n FROM exploded),
lake AS (SELECT * EXCLUDE (n) FROM counted WHERE n > 10)"""

_STAGING = """
projected AS (
  SELECT "gPlusPlaceId", category, day_night, "gPlusUserId", rating,
    strftime("reviewTime", '%Y-%m-%dT%H:%M:%S.%gZ') AS "reviewTime", "userAvgRating", weekday,
    address, country, name, population, postcode, price, state
  FROM lake
),
staging AS (SELECT * FROM projected WHERE category LIKE '%i%' OR category IS NULL)"""

_STAR = """
star_users AS (
  SELECT DISTINCT "gPlusUserId", "userAvgRating" FROM staging
),
users AS (
  SELECT "gPlusUserId", CAST(CAST("userAvgRating" AS DECIMAL(18, 0)) AS DOUBLE) AS "avgRating"
  FROM star_users
),
star_places AS (SELECT DISTINCT "gPlusPlaceId", name, price, state, postcode FROM staging),
star_population AS (SELECT DISTINCT postcode, population FROM staging),
population AS (
  SELECT postcode, CAST(CAST(population AS DECIMAL(18, 0)) AS DOUBLE) AS population
  FROM star_population
),
fact AS (
  SELECT "gPlusPlaceId", "gPlusUserId", category,
    CAST(CAST(rating AS DECIMAL(18, 0)) AS DOUBLE) AS rating, weekday, day_night
  FROM staging
)"""

_CHAT = r"""
chat AS (
  SELECT conv_id, turn, role, text, '{u''role'': u''' || role || ''', u''text'': u"'
    || replace(replace(replace(replace(text, '\', '\\'), chr(10), '\n'), chr(13), '\r'), '"', '\"')
    || '", u''closed'': False, u''x'': None, u''e'': u''caf\xe9''}' AS value
  FROM conversations
)"""

_ALL_PLACES = (_PL, _POP, _PLACES)
_ALL_REVIEWS = (_RV, _REVIEWS)
_ALL_LAKE = (*_ALL_PLACES, *_ALL_REVIEWS, _LAKE)
_ALL_STAGING = (*_ALL_LAKE, _STAGING)
_ALL_STAR = (*_ALL_STAGING, _STAR)


def _sql(parts: tuple[str, ...], select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select.strip()


_SHOW_LIST = "array_to_string(categories, '|') AS categories"


def _check(
    check: str,
    table: str,
    column: str | None,
    expected: str,
    actual: str,
    passed: str,
    source: str,
    severity: str = "error",
) -> str:
    column = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return f"""SELECT '{check}' AS "check", '{table}' AS "table", {column} AS "column",
      '{severity}' AS severity, CAST({expected} AS BIGINT) AS expected,
      CAST({actual} AS BIGINT) AS actual, {passed} AS passed FROM {source}"""


def _non_empty(table: str, source: str, check: str = "non_empty") -> str:
    return _check(check, table, None, "1", "count(*)", "count(*) > 0", source)


def _unique(table: str, key: str, source: str, severity: str = "error") -> str:
    every, distinct = f'count("{key}")', f'count(DISTINCT "{key}")'
    passed = f"{every} = {distinct}"
    return _check("unique_key", table, key, every, distinct, passed, source, severity)


def _reference(table: str, key: str, source: str) -> str:
    orphans = f"""(SELECT f."{key}" FROM fact f WHERE f."{key}" IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM {source} d WHERE d."{key}" = f."{key}"))"""
    return _check("referential", table, key, "0", "count(*)", "count(*) = 0", orphans)


_NON_EMPTY = " UNION ALL ".join(
    [
        _non_empty("users", "users"),
        _non_empty("places", "star_places"),
        _non_empty("population", "population"),
        _non_empty("reviews", "fact"),
    ]
)
_UNIQUE = " UNION ALL ".join(
    [
        _unique("places", "gPlusPlaceId", "star_places"),
        _unique("population", "postcode", "population"),
        _unique("users", "gPlusUserId", "users"),
    ]
)
_REFERENTIAL = " UNION ALL ".join(
    [_reference("places", "gPlusPlaceId", "star_places"), _reference("users", "gPlusUserId", "users")]
)


def _star_lines() -> str:
    """Rows of all star tables as text."""
    tables = {
        "users": ("users", ('"gPlusUserId"', 'CAST("avgRating" AS BIGINT)')),
        "places": ("star_places", ('"gPlusPlaceId"', "price", "state", "postcode")),
        "population": ("population", ("postcode", "CAST(population AS BIGINT)")),
        "reviews": (
            "fact",
            ('"gPlusPlaceId"', '"gPlusUserId"', "category", "CAST(rating AS BIGINT)", "weekday", "day_night"),
        ),
    }

    def line(columns: tuple[str, ...]) -> str:
        return " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)

    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", {line(columns)} AS line FROM {source}"""
        for name, (source, columns) in tables.items()
    )


def _views() -> str:
    parts = [
        f"""SELECT '{view}' AS view_name, category, count(*) AS num_reviews,
          avg(rating) AS avg_rating
        FROM lake WHERE category LIKE '%{contains}%' OR category IS NULL GROUP BY category"""
        for view, contains in (
            ("audience_sign", "sign"),
            ("audience_batch", "batch"),
            ("audience_i", "i"),
        )
    ]
    return " UNION ALL ".join(parts)


def oracles() -> dict[str, str]:
    entry = _sql(
        _ALL_LAKE,
        """SELECT category, day_night, avg(rating) AS avg_rating, count(*) AS num_reviews
           FROM lake GROUP BY category, day_night""",
    )
    lake = _sql(_ALL_LAKE, "SELECT * FROM lake")
    # Null and '' share a folder.
    folders = _sql(_ALL_LAKE, "SELECT * REPLACE (nullif(category, '') AS category) FROM lake")
    projected = _sql(_ALL_STAGING, "SELECT * FROM projected")
    lines = _sql((_CHAT,), "SELECT value FROM chat")
    prepped = f"""SELECT "gPlusPlaceId", "gPlusUserId", rating, "reviewText", {_SHOW_LIST},
        "reviewTime", weekday, day_night, "userAvgRating" FROM reviews"""
    users = _sql(_ALL_STAR, "SELECT * FROM users")
    return {
        "src_text": lines,
        "sink_text": lines,
        # The replacements of the repair, in their order.
        "repair_python_json": _sql(
            (_CHAT,),
            r"""SELECT conv_id, turn,
                  regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
                  regexp_replace(value, 'False', 'false', 'g'), 'True', 'true', 'g'),
                  'None', 'null', 'g'), 'u''', '''', 'g'), 'u"', '"', 'g'),
                  '\\x', '\\u00', 'g') AS value
                FROM chat""",
        ),
        "src_json_dropmalformed": """SELECT role, text, false AS closed,
              CAST(NULL AS VARCHAR) AS x, 'café' AS e FROM conversations WHERE turn % 5 <> 4""",
        "json_malformed_count": """SELECT count(*) AS records,
              count(*) FILTER (WHERE turn % 5 = 4) AS dropped FROM conversations""",
        "src_json_rejects": _sql(
            (_CHAT,),
            """SELECT substr(value, 1, length(value) // 2) AS reject_line, 'not JSON' AS reject_reason
               FROM chat WHERE turn % 5 = 4
               UNION ALL SELECT CAST(count(*) AS VARCHAR), 'records' FROM chat WHERE turn % 5 <> 4""",
        ),
        "src_json_staged": _sql(_ALL_REVIEWS, prepped),
        "sink_json": _sql(_ALL_REVIEWS, prepped),
        "src_csv_header": _sql(
            (_POP,), 'SELECT zip AS "Zip Code ZCTA", census AS "2010 Census Population" FROM pop'
        ),
        "src_parquet": projected,
        "sink_parquet_projected": projected,
        "src_parquet_partitioned": folders,
        "sink_parquet_partitioned": folders,
        "drop_columns": _sql(
            _ALL_REVIEWS,
            f"""SELECT event_id, "gPlusPlaceId", "gPlusUserId", rating, "reviewText", {_SHOW_LIST},
                "reviewTime", weekday, day_night FROM features""",
        ),
        "drop_columns_places": _sql(
            _ALL_PLACES,
            """SELECT "gPlusPlaceId", name, price, address, state, postcode, country
               FROM places""",
        ),
        "derive_state_postcode": _sql(
            _ALL_PLACES, 'SELECT "gPlusPlaceId", state, postcode FROM place_parts'
        ),
        "derive_country": _sql(_ALL_PLACES, 'SELECT "gPlusPlaceId", country FROM places'),
        "address_to_string": _sql(_ALL_PLACES, 'SELECT "gPlusPlaceId", address FROM place_parts'),
        "price_level": _sql(_ALL_PLACES, 'SELECT "gPlusPlaceId", price FROM place_parts'),
        "population_by_zip": _sql((_POP,), "SELECT zip, population FROM zips"),
        "join_population": _sql(
            _ALL_PLACES, 'SELECT "gPlusPlaceId", postcode, population FROM places'
        ),
        "places_prepped": _sql(_ALL_PLACES, "SELECT * FROM places"),
        "filter_usa": _sql(_ALL_PLACES, "SELECT * FROM places WHERE country = 'USA'"),
        "epoch_to_timestamp": _sql(_ALL_REVIEWS, 'SELECT event_id, "reviewTime" FROM features'),
        "derive_weekday": _sql(_ALL_REVIEWS, "SELECT event_id, weekday FROM features"),
        "derive_day_night": _sql(_ALL_REVIEWS, "SELECT event_id, day_night FROM features"),
        "user_avg_rating": _sql(
            _ALL_REVIEWS, 'SELECT event_id, "gPlusUserId", rating, "userAvgRating" FROM reviews'
        ),
        "reviews_prepped": _sql(
            _ALL_REVIEWS, f'SELECT * EXCLUDE (categories), {_SHOW_LIST} FROM reviews'
        ),
        "filter_has_categories": _sql(
            (_RV,), f"SELECT event_id, {_SHOW_LIST} FROM rv WHERE categories IS NOT NULL"
        ),
        "join_reviews_places": _sql(
            (*_ALL_PLACES, _RV),
            f"""SELECT r.event_id, r."gPlusPlaceId", r.rating, {_SHOW_LIST}, p.name, p.price,
                  p.address, p.state, p.postcode, p.country, p.population
                FROM rv r JOIN places p ON r."gPlusPlaceId" = p."gPlusPlaceId"
                WHERE r.categories IS NOT NULL AND p.country = 'USA'""",
        ),
        "explode_categories": _sql((_RV,), "SELECT event_id, unnest(categories) AS category FROM rv"),
        "category_counts": _sql(
            _ALL_LAKE, "SELECT category, count(*) AS num_reviews FROM exploded GROUP BY category"
        ),
        "drop_rare_categories": _sql(
            (_RV, "\nx AS (SELECT event_id, unnest(categories) AS category FROM rv)"),
            """SELECT event_id, category FROM (
                 SELECT *, count(*) OVER (PARTITION BY category) AS n FROM x) WHERE n > 10""",
        ),
        "count_distinct_categories": _sql(
            _ALL_LAKE,
            "SELECT count(*) AS num_categories FROM (SELECT DISTINCT category FROM exploded)",
        ),
        "lake": lake,
        "entry": entry,
        "ext_rollup_rating": entry,
        "ext_distinct_users": _sql(
            (_RV, "\nx AS (SELECT \"gPlusUserId\" AS value, unnest(categories) AS category FROM rv)"),
            """SELECT category, count(DISTINCT value) AS num_values FROM x
               WHERE value IS NOT NULL GROUP BY category""",
        ),
        "main_run": _sql(
            _ALL_STAR,
            """SELECT 'lake' AS "table", count(*) AS num_rows, sum(rating) AS total FROM lake
               UNION ALL SELECT 'users', count(*), sum("avgRating") FROM users
               UNION ALL SELECT 'places', count(*), sum(price) FROM star_places
               UNION ALL SELECT 'population', count(*), sum(population) FROM population
               UNION ALL SELECT 'reviews', count(*), sum(rating) FROM fact
               UNION ALL SELECT 'parsed places', count(*), 0 FROM pl
               UNION ALL SELECT 'parsed reviews', count(*), 0 FROM rv""",
        ),
        "guard_join_fanout": _sql(
            _ALL_LAKE,
            _check(
                "join_fanout",
                "lake",
                "gPlusPlaceId",
                "b",
                "a",
                "a <= b",
                """(SELECT (SELECT count(*) FROM reviews WHERE categories IS NOT NULL) AS b,
                    (SELECT count(*) FROM joined) AS a)""",
            )
            + " UNION ALL "
            + _unique(
                "places",
                "gPlusPlaceId",
                "(SELECT * FROM places WHERE country = 'USA')",
                "warning",
            ),
        ),
        "guard_filter_effective": _sql(
            _ALL_LAKE,
            _check(
                "filter_effective",
                "lake",
                "category",
                "b",
                "a",
                "a < b",
                """(SELECT (SELECT count(*) FROM (SELECT DISTINCT category FROM exploded)) AS b,
                    (SELECT count(*) FROM (SELECT DISTINCT category FROM lake)) AS a)""",
                "warning",
            ),
        ),
        "guard_populated": _sql(
            _ALL_STAGING,
            _non_empty("reviews_lake", "lake", "populated")
            + " UNION ALL "
            + _non_empty("temp_lake", "projected", "populated"),
        ),
        "filter_category_like": _sql(
            _ALL_LAKE, "SELECT * FROM lake WHERE category LIKE '%i%' OR category IS NULL"
        ),
        "load_staging": _sql(_ALL_STAGING, "SELECT * FROM staging"),
        "star_users": users,
        "table_replace": users,
        "star_places": _sql(_ALL_STAR, "SELECT * FROM star_places"),
        "star_population": _sql(_ALL_STAR, "SELECT * FROM population"),
        "star_reviews": _sql(_ALL_STAR, "SELECT * FROM fact"),
        "layout_bucketed_join": _sql(
            _ALL_STAR,
            """SELECT f.*, p.name, p.price, p.state, p.postcode
               FROM fact f JOIN star_places p ON f."gPlusPlaceId" = p."gPlusPlaceId\"""",
        ),
        "dq_non_empty": _sql(_ALL_STAR, _NON_EMPTY),
        "dq_unique_key": _sql(_ALL_STAR, _UNIQUE),
        "dq_referential": _sql(_ALL_STAR, _REFERENTIAL),
        "dq_report": _sql(_ALL_STAR, f"{_NON_EMPTY} UNION ALL {_UNIQUE} UNION ALL {_REFERENTIAL}"),
        "ext_incremental_append": folders,
        "ext_star_changes": _sql(_ALL_STAR, _star_lines()),
        "ext_category_views": _sql(_ALL_LAKE, _views()),
        "ext_rating_by_daypart": _sql(
            _ALL_STAR,
            """SELECT weekday, day_night, avg(rating) AS avg_rating, count(*) AS num_reviews
               FROM fact GROUP BY weekday, day_night""",
        ),
        "ext_rating_by_price_state": _sql(
            _ALL_STAR,
            """SELECT p.price, p.state, avg(f.rating) AS avg_rating, count(*) AS num_reviews
               FROM fact f JOIN star_places p ON f."gPlusPlaceId" = p."gPlusPlaceId"
               GROUP BY p.price, p.state""",
        ),
        "ext_rating_by_population": _sql(
            _ALL_STAR,
            """SELECT CAST(floor(z.population / 1000) * 1000 AS BIGINT) AS population_from,
                 avg(f.rating) AS avg_rating, count(*) AS num_reviews
               FROM fact f JOIN star_places p ON f."gPlusPlaceId" = p."gPlusPlaceId"
               JOIN population z ON p.postcode = z.postcode
               GROUP BY 1""",
        ),
    }
