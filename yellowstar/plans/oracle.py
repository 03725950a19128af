"""DuckDB oracle SQL for every catalogue query.

The oracle is written independently of the Spark code, as plain SQL over
the driver's pre-registered views (``lineitem``, ``orders``, ``pages``).
It shares only the fixture expressions and the fixed code tables. Two
engine differences are handled explicitly: DuckDB rounds when casting a
double to an integer while Spark truncates, so every such cast goes
through ``trunc``; and null ordering is always spelled out.
"""

from __future__ import annotations

from ..schemas import FACT_COLUMNS, MONEY_COLUMNS, PAYMENT_TYPES, RATE_CODES, VENDOR_NAMES
from ..sources.fixture import TRIPS_COLUMNS, trips_select_sql
from ..sources.pages import HREF_PATTERN, ITEM_PATTERN, LIST_PATTERN, TAG_PATTERN

RAW_COLUMNS = [name.lower() for name, _ in TRIPS_COLUMNS]


def _int(c: str) -> str:
    return f"TRY_CAST(trunc({c}) AS INTEGER)"


def _case(col: str, table: dict[int, str]) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in sorted(table.items()))
    return f"CASE CAST({col} AS BIGINT) {whens} END"


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_lowered = ", ".join(f'"{name}" AS {name.lower()}' for name, _ in TRIPS_COLUMNS)
_nonneg = " AND ".join(f"{c} >= 0" for c in MONEY_COLUMNS)

CTES = f"""
trips AS ({trips_select_sql()}),
raw AS (SELECT {_lowered} FROM trips),
s_vendor AS (SELECT * REPLACE ({_int('vendorid')} AS vendorid) FROM raw),
f_vendor AS (SELECT * FROM s_vendor WHERE vendorid IN (1, 2)),
s_pass AS (SELECT * REPLACE ({_int('passenger_count')} AS passenger_count) FROM f_vendor),
f_pass_present AS (SELECT * FROM s_pass WHERE passenger_count IS NOT NULL),
f_pass AS (SELECT * FROM f_pass_present WHERE passenger_count > 0),
s_dist AS (SELECT * REPLACE (TRY_CAST(trip_distance AS FLOAT) AS trip_distance) FROM f_pass),
f_dist AS (SELECT * FROM s_dist WHERE trip_distance > 0),
s_rate AS (SELECT * REPLACE ({_int('pulocationid')} AS pulocationid, {_int('dolocationid')} AS dolocationid,
                             {_int('ratecodeid')} AS ratecodeid) FROM f_dist),
f_rate AS (SELECT * FROM s_rate WHERE ratecodeid IN (1, 2, 3, 4, 5, 6)),
clean AS (SELECT * REPLACE (lower(store_and_fwd_flag) AS store_and_fwd_flag,
                            TRY_CAST(fare_amount AS DOUBLE) AS fare_amount),
                 CASE WHEN {_nonneg} THEN 'n' ELSE 'y' END AS errordata
          FROM f_rate),
vendor_dim AS (SELECT vendorid, row_number() OVER (ORDER BY vendorid ASC NULLS LAST) - 1 AS vendor_key,
                      {_case('vendorid', VENDOR_NAMES)} AS vendor_name
               FROM (SELECT DISTINCT vendorid FROM clean)),
datetime_dim AS (SELECT "timestamp", row_number() OVER (ORDER BY "timestamp" ASC NULLS LAST) - 1 AS datetime_key
                 FROM (SELECT tpep_pickup_datetime AS "timestamp" FROM clean
                       UNION SELECT tpep_dropoff_datetime FROM clean)),
taxizone_dim AS (SELECT locationid, row_number() OVER (ORDER BY locationid ASC NULLS LAST) - 1 AS zone_key
                 FROM (SELECT pulocationid AS locationid FROM clean UNION SELECT dolocationid FROM clean)),
paymenttype_dim AS (SELECT payment_type,
                           row_number() OVER (ORDER BY payment_type ASC NULLS LAST) - 1 AS paymenttype_key,
                           {_case('payment_type', PAYMENT_TYPES)} AS description
                    FROM (SELECT DISTINCT payment_type FROM clean)),
ratecode_dim AS (SELECT ratecodeid, row_number() OVER (ORDER BY ratecodeid ASC NULLS LAST) - 1 AS ratecode_key,
                        {_case('ratecodeid', RATE_CODES)} AS description
                 FROM (SELECT DISTINCT ratecodeid FROM clean)),
fact AS (SELECT v.vendor_key, pt.datetime_key AS putime_key, dt.datetime_key AS dotime_key,
                c.passenger_count, c.trip_distance, r.ratecode_key, c.store_and_fwd_flag,
                pz.zone_key AS puzone_key, dz.zone_key AS dozone_key, p.paymenttype_key,
                {', '.join('c.' + m for m in MONEY_COLUMNS)}, c.errordata
         FROM clean c
         JOIN vendor_dim v ON c.vendorid = v.vendorid
         JOIN ratecode_dim r ON c.ratecodeid = r.ratecodeid
         JOIN taxizone_dim pz ON c.pulocationid = pz.locationid
         JOIN taxizone_dim dz ON c.dolocationid = dz.locationid
         JOIN paymenttype_dim p ON c.payment_type = p.payment_type
         JOIN datetime_dim pt ON c.tpep_pickup_datetime = pt."timestamp"
         JOIN datetime_dim dt ON c.tpep_dropoff_datetime = dt."timestamp"),
page_links AS (
  SELECT page_id, list_pos, item_pos, link, trim(string_split(link, '/')[-1]) AS filename
  FROM (
    SELECT page_id, list_pos, item_pos,
           trim(replace(replace(replace(replace(replace(
             regexp_extract(item_html, {_sql_str(HREF_PATTERN)}, 1)
             || regexp_extract(item_html, {_sql_str(HREF_PATTERN)}, 2)
             || regexp_extract(item_html, {_sql_str(HREF_PATTERN)}, 3),
             '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&')) AS link
    FROM (
      SELECT page_id, list_pos, unnest(items) AS item_html, CAST(generate_subscripts(items, 1) - 1 AS INTEGER) AS item_pos
      FROM (
        SELECT page_id, list_pos, regexp_extract_all(list_html, {_sql_str(ITEM_PATTERN)}, 1)[1:2] AS items
        FROM (
          SELECT page_id, unnest(lists) AS list_html, CAST(generate_subscripts(lists, 1) - 1 AS INTEGER) AS list_pos
          FROM (SELECT page_id, regexp_extract_all(html, {_sql_str(LIST_PATTERN)}, 1) AS lists FROM pages)))))
  WHERE contains(trim(string_split(link, '/')[-1]), 'th'))
"""


def with_ctes(select: str) -> str:
    return f"WITH {CTES.strip()}\n{select}"


def _one_join(fact_col: str, dim: str, natural: str, key: str, role_key: str) -> str:
    return with_ctes(
        f"SELECT c.* EXCLUDE ({fact_col}), d.{key} AS {role_key} "
        f"FROM clean c JOIN {dim} d ON c.{fact_col} = d.{natural}"
    )


def _stage_count(frame: str, exprs: dict[str, str]) -> str:
    cols = ", ".join(f"count(*) FILTER (WHERE {e}) AS {n}" for n, e in exprs.items())
    return with_ctes(f"SELECT {cols} FROM {frame}")


_CARD_COLS = ["vendorid", "passenger_count", "ratecodeid", "store_and_fwd_flag", "payment_type", "airport_fee"]
_cardinality = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_distinct, "
    f"bool_or({c} IS NULL) AS has_null FROM raw"
    for c in _CARD_COLS
)
_ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_TABLE_FILES = ", ".join(
    f"('{t}.parquet')"
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
)
_funnel = " UNION ALL ".join(
    f"SELECT {i} AS step, '{name}' AS stage, (SELECT count(*) FROM {frame}) AS rows"
    for i, (name, frame) in enumerate(
        [
            ("raw", "raw"),
            ("vendor", "f_vendor"),
            ("passenger_present", "f_pass_present"),
            ("passenger_positive", "f_pass"),
            ("distance", "f_dist"),
            ("ratecode", "f_rate"),
        ]
    )
)
_order_all = ", ".join(f"{c} ASC NULLS LAST" for c in RAW_COLUMNS)

ORACLE: dict[str, str] = {
    "parquet_scan_orders": "SELECT * FROM orders",
    "multi_file_union": f"SELECT {_ORDERS_COLS} FROM orders UNION ALL SELECT {_ORDERS_COLS} FROM orders",
    "conform_schema": with_ctes(
        "SELECT vendorid, tpep_pickup_datetime, tpep_dropoff_datetime, "
        "TRY_CAST(trunc(passenger_count) AS BIGINT) AS passenger_count, trip_distance, "
        "TRY_CAST(trunc(ratecodeid) AS BIGINT) AS ratecodeid, store_and_fwd_flag, "
        "TRY_CAST(pulocationid AS INTEGER) AS pulocationid, TRY_CAST(dolocationid AS INTEGER) AS dolocationid, "
        f"payment_type, {', '.join(MONEY_COLUMNS)} FROM raw"
    ),
    "when_indicator": with_ctes(
        "SELECT CASE WHEN store_and_fwd_flag = 'y' THEN 1 ELSE 0 END AS test, count(*) AS count "
        "FROM clean GROUP BY 1"
    ),
    "trips_row_count": with_ctes("SELECT count(*) AS rows FROM raw"),
    "cast_columns": with_ctes(
        f"SELECT {_int('vendorid')} AS vendorid, {_int('passenger_count')} AS passenger_count, "
        "TRY_CAST(trip_distance AS FLOAT) AS trip_distance, "
        f"{_int('pulocationid')} AS pulocationid, {_int('dolocationid')} AS dolocationid, "
        f"{_int('ratecodeid')} AS ratecodeid, TRY_CAST(fare_amount AS DOUBLE) AS fare_amount FROM raw"
    ),
    "lower_flag": with_ctes(
        "SELECT lower(store_and_fwd_flag) AS store_and_fwd_flag, count(*) AS count FROM raw GROUP BY 1"
    ),
    "fare_sign_flag": with_ctes(
        "SELECT CASE WHEN fare_amount < 0 THEN 'y' ELSE 'n' END AS fare_sign, count(*) AS count "
        "FROM clean GROUP BY 1"
    ),
    "quality_flag": with_ctes("SELECT errordata, count(*) AS count FROM clean GROUP BY 1"),
    "filter_vendor": with_ctes("SELECT * FROM f_vendor"),
    "filter_passengers": with_ctes("SELECT * FROM f_pass"),
    "filter_distance": with_ctes("SELECT * FROM f_dist"),
    "filter_ratecode": with_ctes("SELECT * FROM f_rate"),
    "count_zero_distance": _stage_count("f_pass", {"zero_distance": "trip_distance = 0"}),
    "count_bad_locations": _stage_count(
        "f_dist",
        {
            "bad_pickup": "pulocationid < 1 OR pulocationid IS NULL",
            "bad_dropoff": "dolocationid < 1 OR dolocationid IS NULL",
        },
    ),
    "count_negative_fare": _stage_count("f_rate", {"negative_fares": "fare_amount < 0"}),
    "count_nonneg_eight": _stage_count(
        "clean", {"nonneg_rows": " AND ".join(f"{c} >= 0" for c in MONEY_COLUMNS if c != "fare_amount")}
    ),
    "cleaning_funnel": with_ctes(_funnel),
    "cardinality_profile": with_ctes(_cardinality),
    "clean_trips": with_ctes("SELECT * FROM clean"),
    "code_label_vendor": with_ctes(
        f"SELECT vendorid, {_case('vendorid', VENDOR_NAMES)} AS vendor_name, count(*) AS count FROM clean GROUP BY 1"
    ),
    "code_label_payment": with_ctes(
        f"SELECT payment_type, {_case('payment_type', PAYMENT_TYPES)} AS description, count(*) AS count "
        "FROM clean GROUP BY 1"
    ),
    "code_label_ratecode": with_ctes(
        f"SELECT ratecodeid, {_case('ratecodeid', RATE_CODES)} AS description, count(*) AS count "
        "FROM clean GROUP BY 1"
    ),
    "dim_vendor": with_ctes("SELECT * FROM vendor_dim"),
    "dim_datetime": with_ctes("SELECT * FROM datetime_dim"),
    "dim_taxizone": with_ctes("SELECT * FROM taxizone_dim"),
    "dim_paymenttype": with_ctes("SELECT * FROM paymenttype_dim"),
    "dim_ratecode": with_ctes("SELECT * FROM ratecode_dim"),
    "fact_join_pickup_time": _one_join("tpep_pickup_datetime", "datetime_dim", '"timestamp"', "datetime_key", "putime_key"),
    "fact_join_dropoff_time": _one_join("tpep_dropoff_datetime", "datetime_dim", '"timestamp"', "datetime_key", "dotime_key"),
    "fact_join_vendor": _one_join("vendorid", "vendor_dim", "vendorid", "vendor_key", "vendor_key"),
    "fact_join_ratecode": _one_join("ratecodeid", "ratecode_dim", "ratecodeid", "ratecode_key", "ratecode_key"),
    "fact_join_pickup_zone": _one_join("pulocationid", "taxizone_dim", "locationid", "zone_key", "puzone_key"),
    "fact_join_dropoff_zone": _one_join("dolocationid", "taxizone_dim", "locationid", "zone_key", "dozone_key"),
    "fact_join_payment": _one_join("payment_type", "paymenttype_dim", "payment_type", "paymenttype_key", "paymenttype_key"),
    "fact_table": with_ctes(f"SELECT {', '.join(FACT_COLUMNS)} FROM fact"),
    "dim_sizes": with_ctes(
        " UNION ALL ".join(
            f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {v}"
            for t, v in [
                ("vendor_DIM", "vendor_dim"),
                ("datetime_DIM", "datetime_dim"),
                ("taxizone_DIM", "taxizone_dim"),
                ("paymenttype_DIM", "paymenttype_dim"),
                ("ratecode_DIM", "ratecode_dim"),
            ]
        )
    ),
    "limit_ordered": with_ctes(f"SELECT * FROM raw ORDER BY {_order_all} LIMIT 10000"),
    "limit_bounded_count": with_ctes("SELECT least(count(*), 100) AS rows FROM fact"),
    "parquet_roundtrip": with_ctes("SELECT * FROM taxizone_dim"),
    "page_links": with_ctes("SELECT * FROM page_links"),
    "new_files": with_ctes(
        "SELECT filename, link, page_id, list_pos, item_pos FROM ("
        "  SELECT *, row_number() OVER (PARTITION BY filename ORDER BY page_id, list_pos, item_pos) AS rn"
        "  FROM page_links) "
        f"WHERE rn = 1 AND filename NOT IN (SELECT f FROM (VALUES {_TABLE_FILES}) AS landed(f))"
    ),
    "key_integrity": with_ctes(
        """SELECT r.role, r.dimension, r.fact_column, r.unmatched_rows, d.duplicate_keys FROM (
          SELECT 'vendor_key' AS role, 'vendor_DIM' AS dimension, 'vendorid' AS fact_column,
                 count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM vendor_dim x WHERE x.vendorid = c.vendorid)) AS unmatched_rows FROM clean c
          UNION ALL SELECT 'ratecode_key', 'ratecode_DIM', 'ratecodeid',
                 count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM ratecode_dim x WHERE x.ratecodeid = c.ratecodeid)) FROM clean c
          UNION ALL SELECT 'puzone_key', 'taxizone_DIM', 'pulocationid',
                 count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM taxizone_dim x WHERE x.locationid = c.pulocationid)) FROM clean c
          UNION ALL SELECT 'dozone_key', 'taxizone_DIM', 'dolocationid',
                 count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM taxizone_dim x WHERE x.locationid = c.dolocationid)) FROM clean c
          UNION ALL SELECT 'paymenttype_key', 'paymenttype_DIM', 'payment_type',
                 count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM paymenttype_dim x WHERE x.payment_type = c.payment_type)) FROM clean c
          UNION ALL SELECT 'putime_key', 'datetime_DIM', 'tpep_pickup_datetime',
                 count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM datetime_dim x WHERE x."timestamp" = c.tpep_pickup_datetime)) FROM clean c
          UNION ALL SELECT 'dotime_key', 'datetime_DIM', 'tpep_dropoff_datetime',
                 count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM datetime_dim x WHERE x."timestamp" = c.tpep_dropoff_datetime)) FROM clean c
        ) r JOIN (
          SELECT 'vendor_DIM' AS dimension, (SELECT count(*) FROM (SELECT vendorid FROM vendor_dim GROUP BY 1 HAVING count(*) > 1)) AS duplicate_keys
          UNION ALL SELECT 'datetime_DIM', (SELECT count(*) FROM (SELECT "timestamp" FROM datetime_dim GROUP BY 1 HAVING count(*) > 1))
          UNION ALL SELECT 'taxizone_DIM', (SELECT count(*) FROM (SELECT locationid FROM taxizone_dim GROUP BY 1 HAVING count(*) > 1))
          UNION ALL SELECT 'paymenttype_DIM', (SELECT count(*) FROM (SELECT payment_type FROM paymenttype_dim GROUP BY 1 HAVING count(*) > 1))
          UNION ALL SELECT 'ratecode_DIM', (SELECT count(*) FROM (SELECT ratecodeid FROM ratecode_dim GROUP BY 1 HAVING count(*) > 1))
        ) d ON r.dimension = d.dimension"""
    ),
}

for _col in ["passenger_count", "store_and_fwd_flag", "payment_type", "extra", "mta_tax"]:
    ORACLE[f"value_counts_{_col}"] = with_ctes(f"SELECT {_col}, count(*) AS count FROM clean GROUP BY 1")

ORACLE["fact_table_shuffle_join"] = ORACLE["fact_table"]
ORACLE["dense_key_ranged"] = (
    "SELECT l_extendedprice, row_number() OVER (ORDER BY l_extendedprice ASC NULLS LAST) - 1 AS price_key "
    "FROM (SELECT DISTINCT l_extendedprice FROM lineitem)"
)
ORACLE["streaming_clean_trips"] = ORACLE["clean_trips"]
ORACLE["fact_table_hot_split"] = ORACLE["fact_table"]
ORACLE["value_counts_passenger_count_raw"] = with_ctes(
    "SELECT passenger_count, count(*) AS count FROM f_vendor GROUP BY 1"
)
ORACLE["distinct_vendor_raw"] = with_ctes("SELECT DISTINCT vendorid FROM raw")
ORACLE["value_counts_store_and_fwd_flag_raw"] = with_ctes(
    "SELECT store_and_fwd_flag, count(*) AS count FROM f_rate GROUP BY 1"
)
ORACLE["fact_table_block_lookup"] = ORACLE["fact_table"]
ORACLE["dense_key_blocks"] = (
    "SELECT l_orderkey, row_number() OVER (ORDER BY l_orderkey ASC NULLS LAST) - 1 AS order_key "
    "FROM (SELECT DISTINCT l_orderkey FROM lineitem)"
)
ORACLE["value_lists_profile"] = with_ctes(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS rows FROM raw GROUP BY 2"
        for c in [*_CARD_COLS, "pulocationid"]
    )
)

_HALF = "TIMESTAMP '1998-05-01 00:00:00'"
ORACLE["stable_keys"] = f"""
WITH a AS (SELECT DISTINCT l_extendedprice FROM lineitem WHERE l_shipdate < {_HALF}),
b AS (SELECT DISTINCT l_extendedprice FROM lineitem WHERE l_shipdate >= {_HALF} AND l_extendedprice NOT IN (FROM a))
SELECT l_extendedprice, row_number() OVER (ORDER BY l_extendedprice) - 1 AS price_key, 1 AS version FROM a
UNION ALL
SELECT l_extendedprice, (SELECT count(*) FROM a) + row_number() OVER (ORDER BY l_extendedprice) - 1, 2 FROM b"""
_not_null = " AND ".join(
    f"{c} IS NOT NULL"
    for c in ["vendorid", "ratecodeid", "pulocationid", "dolocationid", "payment_type", "tpep_pickup_datetime", "tpep_dropoff_datetime"]
)
ORACLE["monthly_rewrite"] = with_ctes(
    f"SELECT *, CASE WHEN tpep_pickup_datetime < {_HALF} THEN '2023-01' ELSE '2023-02' END AS load_month "
    f"FROM clean WHERE {_not_null}"
)
ORACLE["observed_funnel"] = ORACLE["cleaning_funnel"]
ORACLE["observed_sizes"] = ORACLE["dim_sizes"] + " UNION ALL SELECT 'fact_table', count(*) FROM fact"
ORACLE["pipeline_star"] = ORACLE["fact_table"]
ORACLE["load_trip_files"] = ORACLE["conform_schema"]
ORACLE["load_first_files"] = ORACLE["conform_schema"] + f" WHERE tpep_pickup_datetime < {_HALF}"
ORACLE["incremental_listing"] = (
    "SELECT DISTINCT 'month=' || strftime(l_shipdate, '%Y-%m') AS folder, "
    f"CAST(CASE WHEN l_shipdate < {_HALF} THEN 1 ELSE 2 END AS INTEGER) AS run FROM lineitem"
)
ORACLE["cardinality_sketches"] = with_ctes(
    "SELECT *, true AS exact FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_distinct, "
        f"bool_or({c} IS NULL) AS has_null FROM raw"
        for c in [*_CARD_COLS, "pulocationid"]
    )
    + ")"
)
ORACLE["parquet_footer_counts"] = "SELECT count(*) AS rows, " + ", ".join(
    f"count({c}) AS {c}_values, min({c}) AS {c}_min, max({c}) AS {c}_max" for c in ["l_orderkey", "l_linenumber"]
) + " FROM lineitem"
ORACLE["clean_clustered"] = ORACLE["clean_trips"]
_NESTED_ITEM = '<ul><li><a href="/sub/inner-th-1.csv">x</a></li><li><a href="/sub/other.csv">y</a></li></ul></li>'
ORACLE["nested_page_links"] = f"""
WITH tags AS (
  SELECT page_id, unnest(found) AS tag, generate_subscripts(found, 1) AS pos
  FROM (SELECT page_id, regexp_extract_all(replace(html, '</li>', {_sql_str(_NESTED_ITEM)}), {_sql_str(TAG_PATTERN)}, 0) AS found FROM pages)),
parsed AS (
  SELECT page_id, pos, regexp_extract(tag, {_sql_str(TAG_PATTERN)}, 1) = '/' AS closes,
    lower(regexp_extract(tag, {_sql_str(TAG_PATTERN)}, 2)) AS kind,
    regexp_extract(tag, {_sql_str(HREF_PATTERN)}, 1) || regexp_extract(tag, {_sql_str(HREF_PATTERN)}, 2)
      || regexp_extract(tag, {_sql_str(HREF_PATTERN)}, 3) AS href
  FROM tags),
deep AS (
  SELECT *, sum(CASE WHEN closes THEN -1 ELSE 1 END) OVER (PARTITION BY page_id, kind ORDER BY pos) + CAST(closes AS INTEGER) AS depth
  FROM parsed),
ends AS (
  SELECT * FROM (
    SELECT *, coalesce(lead(pos) OVER (PARTITION BY page_id, kind, depth ORDER BY pos), 2147483647) AS stop FROM deep)
  WHERE NOT closes),
lists AS (
  SELECT page_id, pos, stop, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS list_pos FROM ends WHERE kind = 'ul'),
items AS (
  SELECT l.page_id, list_pos, i.pos, i.stop, row_number() OVER (PARTITION BY l.page_id, list_pos ORDER BY i.pos) - 1 AS item_pos
  FROM lists l JOIN ends i ON i.page_id = l.page_id AND i.kind = 'li' AND i.pos > l.pos AND i.pos < l.stop),
links AS (
  SELECT i.page_id, list_pos, item_pos, arg_min(a.href, a.pos) AS href
  FROM items i JOIN ends a ON a.page_id = i.page_id AND a.kind = 'a' AND a.href <> '' AND a.pos > i.pos AND a.pos < i.stop
  WHERE item_pos < 2 GROUP BY ALL),
named AS (
  SELECT page_id, CAST(list_pos AS INTEGER) AS list_pos, CAST(item_pos AS INTEGER) AS item_pos,
    trim(replace(replace(replace(replace(replace(href, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&')) AS link
  FROM links)
SELECT *, trim(string_split(link, '/')[-1]) AS filename FROM named WHERE contains(trim(string_split(link, '/')[-1]), 'th')"""
