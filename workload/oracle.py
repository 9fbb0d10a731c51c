"""The results of the registered queries in SQL over the same tables.

Columns have the names and types of the Spark results; decimals are compared as
DOUBLE.
"""

from __future__ import annotations

# --- the mappings ---------------------------------------------------------------

_PLACES = """
places AS (
  SELECT n_nationkey, r_name AS region, n_name AS pays
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

_LIEUX = (
    _PLACES
    + """,
lieux AS (
  SELECT c_custkey AS id_lieu, c_name AS nom, region, pays
  FROM customer JOIN places ON c_nationkey = n_nationkey)"""
)

_DONNEES = """
ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(1000 + ascii(event_type) AS INTEGER) AS code_condition
  FROM events),
conditions AS (
  SELECT DISTINCT code_condition, event_type AS texte_condition FROM ev),
donnees AS (
  SELECT event_id AS id_observation_horaire, user_id AS id_lieu, ts AS datetime_observation,
    CAST(CAST(value AS DECIMAL(5,2)) AS DOUBLE) AS temperature_celsius,
    CAST(CAST(k / 4.0 AS DECIMAL(5,2)) AS DOUBLE) AS vent_kph,
    CAST(k * 3 AS INTEGER) AS vent_degre,
    upper(event_type) AS direction_vent,
    CAST(CAST(CAST(k AS DOUBLE) / 8 + 950 AS DECIMAL(7,2)) AS DOUBLE) AS pression_millibars,
    CAST(CAST(CAST(k AS DOUBLE) / 8 AS DECIMAL(5,2)) AS DOUBLE) AS precipitation_mm,
    CAST(minute(ts) AS INTEGER) AS humidite_pourcentage,
    CAST(hour(ts) AS INTEGER) AS nuages_pourcentage,
    CAST(day(ts) AS DOUBLE) AS visibilite_km,
    CAST(CAST(k / 10.0 AS DECIMAL(4,1)) AS DOUBLE) AS indice_uv,
    CAST(CAST(k / 2.0 AS DECIMAL(5,2)) AS DOUBLE) AS rafales_kph,
    code_condition
  FROM ev)"""

_MEASURES = """temperature_celsius, vent_kph, vent_degre, direction_vent, pression_millibars,
  precipitation_mm, humidite_pourcentage, nuages_pourcentage, visibilite_km, indice_uv,
  rafales_kph"""


def _calendar(source: str) -> str:
    return f"""
minutes AS (
  SELECT DISTINCT date_trunc('minute', ts) AS m FROM {source}),
dim_temps AS (
  SELECT row_number() OVER (ORDER BY m) AS id_dim_temps, CAST(m AS DATE) AS date,
    CAST(year(m) AS INTEGER) AS annee, CAST(month(m) AS INTEGER) AS mois,
    CAST(day(m) AS INTEGER) AS jour, CAST(hour(m) AS INTEGER) AS heure,
    CAST(minute(m) AS INTEGER) AS minute, dayname(m) AS jour_semaine, monthname(m) AS nom_mois
  FROM minutes)"""


def _dim_lieux(where: str = "TRUE") -> str:
    return f"""
dim_lieux AS (
  SELECT row_number() OVER (ORDER BY nom) AS id_dim_lieu, nom AS nom_ville, region, pays
  FROM lieux WHERE {where})"""


_DIM_CONDITIONS = """
dim_conditions AS (
  SELECT row_number() OVER (ORDER BY code_condition) AS id_dim_condition, code_condition,
    texte_condition
  FROM conditions)"""


def _keyed(where: str) -> str:
    return (
        f"{_LIEUX}, {_DONNEES}, {_calendar('events')}, {_dim_lieux(where)}, {_DIM_CONDITIONS},"
        + """
keyed AS (
  SELECT d.*, dl.id_dim_lieu AS id_dim_lieu_fk, dt.id_dim_temps AS id_dim_temps_fk,
    dc.id_dim_condition AS id_dim_condition_fk
  FROM donnees d
  LEFT JOIN lieux l ON d.id_lieu = l.id_lieu
  LEFT JOIN dim_lieux dl ON l.nom = dl.nom_ville AND l.pays = dl.pays
    AND l.region IS NOT DISTINCT FROM dl.region
  LEFT JOIN dim_conditions dc ON d.code_condition = dc.code_condition
  LEFT JOIN dim_temps dt ON CAST(d.datetime_observation AS DATE) = dt.date
    AND hour(d.datetime_observation) = dt.heure AND minute(d.datetime_observation) = dt.minute),
fait AS (
  SELECT * FROM keyed
  WHERE id_dim_lieu_fk IS NOT NULL AND id_dim_temps_fk IS NOT NULL
    AND id_dim_condition_fk IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY id_dim_lieu_fk, id_dim_temps_fk
    ORDER BY id_observation_horaire DESC) = 1)"""
    )


_OUTSIDE_AFRICA = "region <> 'AFRICA'"

_SERVED = f"""
SELECT f.id_observation_horaire, f.id_dim_lieu_fk, f.id_dim_temps_fk, f.id_dim_condition_fk,
  {_MEASURES}, l.id_dim_lieu, l.nom_ville, l.region, l.pays, t.id_dim_temps, t.date, t.annee,
  t.mois, t.jour, t.heure, t.minute, t.jour_semaine, t.nom_mois, c.id_dim_condition,
  c.code_condition, c.texte_condition
FROM fait f
JOIN dim_lieux l ON f.id_dim_lieu_fk = l.id_dim_lieu
JOIN dim_temps t ON f.id_dim_temps_fk = t.id_dim_temps
JOIN dim_conditions c ON f.id_dim_condition_fk = c.id_dim_condition"""

_NEWEST = "ORDER BY t.date DESC, t.heure DESC, t.minute DESC, f.id_observation_horaire DESC LIMIT 1000"

# --- records: what the damage by props.k leaves ---------------------------------

_RECORDS = (
    f"{_LIEUX}, {_DONNEES},"
    + """
parsed AS (
  SELECT event_id, k, nom AS name, region, pays AS country,
    strftime(ts, '%Y-%m-%d %H:%M') AS last_updated,
    CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) AS temp_c,
    event_type AS condition_text, ev.code_condition AS condition_code,
    CAST(k / 4.0 AS DOUBLE) AS wind_kph, CAST(k * 3 AS INTEGER) AS wind_degree,
    upper(event_type) AS wind_dir, CAST(k AS DOUBLE) / 8 + 950 AS pressure_mb,
    CAST(k AS DOUBLE) / 8 AS precip_mm,
    CAST(CASE WHEN k BETWEEN 20 AND 22 THEN 1 ELSE minute(ts) END AS INTEGER) AS humidity,
    CAST(CASE WHEN k BETWEEN 29 AND 30 THEN 7 WHEN k = 34 THEN 1 ELSE hour(ts) END AS INTEGER)
      AS cloud,
    CAST(day(ts) AS DOUBLE) AS vis_km, CAST(k AS DOUBLE) / 10 AS uv,
    CAST(k / 2.0 AS DOUBLE) AS gust_kph
  FROM ev JOIN lieux ON ev.user_id = lieux.id_lieu),
judged AS (
  SELECT *,
    CASE WHEN k < 5 THEN '$' WHEN k <= 9 THEN 'uv' WHEN k <= 14 THEN 'temp_c'
         WHEN k <= 22 THEN NULL WHEN k <= 25 THEN 'humidity' WHEN k <= 28 THEN 'wind_dir'
         WHEN k <= 30 THEN NULL WHEN k <= 32 THEN 'cloud' WHEN k = 33 THEN 'precip_mm'
         WHEN k = 34 THEN NULL WHEN k = 35 THEN 'condition_code' WHEN k = 36 THEN 'wind_kph'
         WHEN k = 37 THEN 'wind_dir' END AS field,
    CASE WHEN k < 5 THEN 'malformed' WHEN k <= 9 THEN 'missing' WHEN k <= 14 THEN 'uncoercible'
         WHEN k <= 22 THEN NULL WHEN k <= 28 THEN 'uncoercible' WHEN k <= 30 THEN NULL
         WHEN k <= 32 THEN 'missing' WHEN k = 33 THEN 'not_finite' WHEN k = 34 THEN NULL
         WHEN k = 35 THEN 'uncoercible' WHEN k = 36 THEN 'out_of_range' WHEN k = 37 THEN 'too_long'
    END AS reason
  FROM parsed),
good AS (SELECT * FROM judged WHERE field IS NULL),
flat AS (
  SELECT event_id, name AS nom, region, country AS pays, last_updated AS datetime_observation,
    CAST(CAST(temp_c AS DECIMAL(5,2)) AS DOUBLE) AS temperature_celsius,
    condition_text AS texte_condition, condition_code AS code_condition,
    CAST(CAST(wind_kph AS DECIMAL(5,2)) AS DOUBLE) AS vent_kph, wind_degree AS vent_degre,
    wind_dir AS direction_vent, CAST(CAST(pressure_mb AS DECIMAL(7,2)) AS DOUBLE) AS pression_millibars,
    CAST(CAST(precip_mm AS DECIMAL(5,2)) AS DOUBLE) AS precipitation_mm,
    humidity AS humidite_pourcentage, cloud AS nuages_pourcentage,
    CAST(CAST(vis_km AS DECIMAL(5,2)) AS DOUBLE) AS visibilite_km,
    CAST(CAST(uv AS DECIMAL(4,1)) AS DOUBLE) AS indice_uv,
    CAST(CAST(gust_kph AS DECIMAL(5,2)) AS DOUBLE) AS rafales_kph
  FROM good)"""
)

_TIME_TEXT = """
texts AS (
  SELECT event_id, ts, CASE WHEN event_type = 'error'
    THEN strftime(ts, '%Y-13-%d %H:%M:%S') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS text
  FROM events),
coerced AS (
  SELECT event_id, text, try_strptime(text, '%Y-%m-%d %H:%M:%S') AS ts FROM texts)"""

_LINE_ORDER = """l_orderkey{d}, l_partkey{d}, l_linenumber{d}, l_quantity{d}, l_extendedprice{d},
    l_discount{d}, l_tax{d}, l_returnflag{d}, l_linestatus{d}"""
_LINE_COLUMNS = "l_suppkey, l_shipdate, " + _LINE_ORDER.format(d="")
_FIRST = _LINE_ORDER.format(d="")
_LAST = _LINE_ORDER.format(d=" DESC")

_MOVED = (
    _PLACES
    + """,
first_batch AS (
  SELECT c_name AS nom_ville, region, pays FROM customer JOIN places ON c_nationkey = n_nationkey
  WHERE c_mktsegment <> 'AUTOMOBILE'),
second_batch AS (
  SELECT c_name AS nom_ville, region, pays FROM customer JOIN places ON n_nationkey =
    CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey
         WHEN c_nationkey = 24 THEN 0 ELSE c_nationkey + 1 END)"""
)

ORACLE = {
    "ingest_valid": f"""WITH {_RECORDS}
SELECT event_id, name, region, country, last_updated, temp_c, condition_text, condition_code,
  wind_kph, wind_degree, wind_dir, pressure_mb, precip_mm, humidity, cloud, vis_km, uv, gust_kph
FROM good""",
    "ingest_rejects": f"""WITH {_RECORDS}
SELECT event_id, field, reason FROM judged WHERE field IS NOT NULL""",
    "flatten_observations": f"WITH {_RECORDS} SELECT * FROM flat",
    "split_locations": f"WITH {_RECORDS} SELECT DISTINCT nom, region, pays FROM flat",
    "split_conditions": f"WITH {_RECORDS} SELECT DISTINCT code_condition, texte_condition FROM flat",
    "staging_observations": f"""WITH {_RECORDS},
numbered AS (
  SELECT *, row_number() OVER (ORDER BY nom, region, pays) AS id_lieu
  FROM (SELECT DISTINCT nom, region, pays FROM flat))
SELECT event_id, id_lieu, strptime(datetime_observation, '%Y-%m-%d %H:%M') AS datetime_observation,
  {_MEASURES}, code_condition
FROM flat JOIN numbered USING (nom, region, pays)
QUALIFY row_number() OVER (PARTITION BY id_lieu, datetime_observation ORDER BY event_id) = 1""",
    "measures_decimal": """
SELECT l_orderkey, l_linenumber,
  CAST(CAST(l_quantity AS DECIMAL(5,2)) AS DOUBLE) AS quantity,
  CAST(CAST(l_discount AS DECIMAL(4,1)) AS DOUBLE) AS discount,
  CAST(TRY_CAST(l_extendedprice AS DECIMAL(7,2)) AS DOUBLE) AS price,
  l_extendedprice <= 99999.99 AS price_fits
FROM lineitem""",
    "measures_clamped": """
SELECT l_orderkey, l_linenumber, least(l_extendedprice, 999.99) AS price,
  greatest(-l_extendedprice, -99999.99) AS refund,
  CAST(least(l_orderkey * 1000000, 2147483647) AS INTEGER) AS scaled_key
FROM lineitem""",
    "time_coerce_valid": f"WITH {_TIME_TEXT} SELECT event_id, ts FROM coerced WHERE ts IS NOT NULL",
    "time_coerce_stats": f"""WITH {_TIME_TEXT}
SELECT count(*) AS total, count(*) FILTER (text IS NOT NULL AND ts IS NULL) AS coerced,
  count(ts) AS kept
FROM coerced""",
    "dim_time": f"WITH {_calendar('events')} SELECT * FROM dim_temps",
    "dim_location": f"WITH {_LIEUX}, {_dim_lieux()} SELECT * FROM dim_lieux",
    "dim_condition": f"WITH {_DONNEES}, {_DIM_CONDITIONS} SELECT * FROM dim_conditions",
    "obs_with_location": f"""WITH {_LIEUX}
SELECT event_id AS id_observation_horaire, user_id AS id_lieu, nom, region, pays
FROM events LEFT JOIN (SELECT * FROM lieux WHERE {_OUTSIDE_AFRICA}) l ON user_id = l.id_lieu""",
    "resolve_location_key": f"""WITH {_LIEUX},
unnamed AS (SELECT id_lieu, nom, nullif(region, 'ASIA') AS region, pays FROM lieux),
dim AS (SELECT *, row_number() OVER (ORDER BY nom) AS id_dim_lieu FROM unnamed)
SELECT event_id AS id_observation_horaire, dim.id_dim_lieu AS id_dim_lieu_fk
FROM events LEFT JOIN unnamed l ON user_id = l.id_lieu
LEFT JOIN dim ON l.nom = dim.nom AND l.region IS NOT DISTINCT FROM dim.region
  AND l.pays = dim.pays""",
    "resolve_condition_key": f"""WITH {_DONNEES},
dim AS (
  SELECT *, row_number() OVER (ORDER BY code_condition) AS id_dim_condition
  FROM conditions WHERE texte_condition <> 'error')
SELECT id_observation_horaire, id_dim_condition AS id_dim_condition_fk
FROM donnees LEFT JOIN dim USING (code_condition)""",
    "resolve_time_key": f"""WITH {_calendar('events')}
SELECT event_id AS id_observation_horaire, id_dim_temps AS id_dim_temps_fk
FROM events LEFT JOIN dim_temps ON CAST(ts AS DATE) = date AND hour(ts) = heure
  AND minute(ts) = minute""",
    "fact_build": f"""WITH {_keyed(_OUTSIDE_AFRICA)}
SELECT id_dim_lieu_fk, id_dim_temps_fk, id_dim_condition_fk, {_MEASURES} FROM fait""",
    "fact_rejects": f"""WITH {_keyed(_OUTSIDE_AFRICA)}
SELECT id_observation_horaire, concat_ws(',',
  CASE WHEN id_dim_lieu_fk IS NULL THEN 'id_dim_lieu_fk' END,
  CASE WHEN id_dim_temps_fk IS NULL THEN 'id_dim_temps_fk' END,
  CASE WHEN id_dim_condition_fk IS NULL THEN 'id_dim_condition_fk' END) AS failed_keys
FROM keyed
WHERE id_dim_lieu_fk IS NULL OR id_dim_temps_fk IS NULL OR id_dim_condition_fk IS NULL""",
    "load_stats": f"""WITH {_keyed(_OUTSIDE_AFRICA)},
flagged AS (
  SELECT id_dim_lieu_fk IS NOT NULL AND id_dim_temps_fk IS NOT NULL
    AND id_dim_condition_fk IS NOT NULL AS complete FROM keyed)
SELECT count(*) AS read, count(*) FILTER (NOT complete) AS dropped,
  count(*) FILTER (complete) AS prepared, (SELECT count(*) FROM fait) AS facts
FROM flagged""",
    "insert_ignore_observations": f"""WITH
target AS (
  SELECT {_LINE_COLUMNS} FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'
  QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY {_FIRST}) = 1),
resent AS (SELECT {_LINE_COLUMNS} FROM (SELECT * REPLACE (l_quantity + 100 AS l_quantity) FROM lineitem)),
batch AS (
  SELECT * FROM resent
  QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY {_FIRST}) = 1)
SELECT * FROM target UNION ALL
SELECT * FROM batch b WHERE NOT EXISTS (
  SELECT 1 FROM target t WHERE t.l_suppkey = b.l_suppkey AND t.l_shipdate = b.l_shipdate)""",
    "insert_ignore_conditions": """WITH RECURSIVE
pairs AS (
  SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS code_condition,
    event_type AS texte_condition, min(event_id) AS event_id
  FROM events GROUP BY ALL),
ordered AS (SELECT *, row_number() OVER (ORDER BY event_id) AS i FROM pairs),
steps AS (
  SELECT 0::BIGINT AS i, []::INTEGER[] AS codes, []::VARCHAR[] AS texts, FALSE AS kept
  UNION ALL
  SELECT o.i,
    CASE WHEN free THEN list_append(codes, o.code_condition) ELSE codes END,
    CASE WHEN free THEN list_append(texts, o.texte_condition) ELSE texts END,
    free
  FROM (
    SELECT s.codes, s.texts, o.*, NOT list_contains(s.codes, o.code_condition)
      AND NOT list_contains(s.texts, o.texte_condition) AS free
    FROM steps s JOIN ordered o ON o.i = s.i + 1) o)
SELECT code_condition, texte_condition, event_id
FROM steps JOIN ordered USING (i) WHERE kept""",
    "upsert_dim_location": f"""WITH {_MOVED},
target AS (SELECT *, row_number() OVER (ORDER BY nom_ville) AS id_dim_lieu FROM first_batch),
fresh AS (
  SELECT *, row_number() OVER (ORDER BY nom_ville) + (SELECT max(id_dim_lieu) FROM target)
    AS id_dim_lieu
  FROM second_batch WHERE nom_ville NOT IN (SELECT nom_ville FROM target))
SELECT t.id_dim_lieu, t.nom_ville, s.region, s.pays
FROM target t JOIN second_batch s USING (nom_ville)
UNION ALL SELECT id_dim_lieu, nom_ville, region, pays FROM fresh""",
    "upsert_actions": f"""WITH {_MOVED},
compared AS (
  SELECT f.nom_ville IS NULL AS is_new, f.region = s.region AND f.pays = s.pays AS same
  FROM second_batch s LEFT JOIN first_batch f USING (nom_ville))
SELECT count(*) FILTER (is_new) AS inserted, count(*) FILTER (NOT is_new AND NOT same) AS updated,
  count(*) FILTER (NOT is_new AND same) AS unchanged,
  count(*) FILTER (is_new) + 2 * count(*) FILTER (NOT is_new AND NOT same) AS affected
FROM compared""",
    "upsert_fact": f"""WITH
loaded AS (
  SELECT {_LINE_COLUMNS} FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'
  QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY {_LAST}) = 1),
target AS (SELECT *, row_number() OVER (ORDER BY l_suppkey, l_shipdate) AS id_observation FROM loaded),
arriving AS (
  SELECT * REPLACE (CASE WHEN l_returnflag = 'R' THEN l_quantity + 1 ELSE l_quantity END
    AS l_quantity)
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01'),
batch AS (
  SELECT {_LINE_COLUMNS} FROM arriving
  QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY {_LAST}) = 1),
fresh AS (
  SELECT b.*, row_number() OVER (ORDER BY l_suppkey, l_shipdate)
    + (SELECT max(id_observation) FROM target) AS id_observation
  FROM batch b ANTI JOIN target t USING (l_suppkey, l_shipdate))
SELECT * FROM target t ANTI JOIN batch b USING (l_suppkey, l_shipdate)
UNION ALL SELECT b.*, t.id_observation FROM batch b JOIN target t USING (l_suppkey, l_shipdate)
UNION ALL SELECT * FROM fresh""",
    "upsert_all_key": "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem",
    "surrogate_keys": """WITH
known AS (
  SELECT c_name, c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_name) AS id_customer
  FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT * FROM known UNION ALL
SELECT c_name, c_custkey, c_mktsegment,
  row_number() OVER (ORDER BY c_name) + (SELECT max(id_customer) FROM known)
FROM customer WHERE c_mktsegment <> 'BUILDING'""",
    "fk_orphans": f"""WITH {_LIEUX}, {_DONNEES}
SELECT id_observation_horaire, id_lieu, code_condition FROM donnees
WHERE id_lieu NOT IN (SELECT id_lieu FROM lieux WHERE {_OUTSIDE_AFRICA})
  OR code_condition NOT IN (SELECT code_condition FROM conditions WHERE texte_condition <> 'error')""",
    "fk_audit": f"""WITH {_PLACES},
kept AS (
  SELECT s_suppkey FROM supplier JOIN places ON s_nationkey = n_nationkey
  WHERE {_OUTSIDE_AFRICA})
SELECT count(*) AS checked,
  count(*) FILTER (l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS orphans_l_orderkey,
  count(*) FILTER (l_partkey NOT IN (SELECT p_partkey FROM part)) AS orphans_l_partkey,
  count(*) FILTER (l_suppkey NOT IN (SELECT s_suppkey FROM kept)) AS orphans_l_suppkey
FROM lineitem""",
    "quality_not_null": f"""WITH {_keyed(_OUTSIDE_AFRICA)}
SELECT count(*) FILTER (id_dim_lieu_fk IS NULL) AS id_dim_lieu_fk,
  count(*) FILTER (id_dim_temps_fk IS NULL) AS id_dim_temps_fk,
  count(*) FILTER (id_dim_condition_fk IS NULL) AS id_dim_condition_fk,
  count(*) FILTER (temperature_celsius IS NULL) AS temperature_celsius
FROM keyed""",
    "quality_unique": """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "coverage_report": """WITH
seen AS (SELECT DISTINCT user_id FROM events),
expected AS (SELECT DISTINCT c_custkey AS user_id FROM customer)
SELECT count(*) AS expected, count(s.user_id) AS seen, count(*) - count(s.user_id) AS missing
FROM expected e LEFT JOIN seen s ON e.user_id = s.user_id""",
    "coverage_missing": """
SELECT DISTINCT c_custkey AS user_id FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM events)""",
    "run_status": """
SELECT CAST(user_id AS VARCHAR) AS process_name,
  CASE event_type WHEN 'purchase' THEN 'finished' WHEN 'error' THEN 'error: ' || props
    ELSE 'running' END AS state,
  ts AS start_time
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "locations_list": f"WITH {_LIEUX} SELECT DISTINCT nom AS nom_ville FROM lieux ORDER BY nom_ville",
    "latest_observations": f"WITH {_keyed('TRUE')} {_SERVED} {_NEWEST}",
    "observations_by_city_period": f"""WITH {_keyed('TRUE')} {_SERVED}
WHERE l.nom_ville = 'Customer#000000007' AND t.date >= DATE '2024-01-05'
  AND t.date < DATE '2024-01-25'""",
    "observations_by_period": f"""WITH {_keyed('TRUE')} {_SERVED}
WHERE t.date >= DATE '2024-01-05' AND t.date < DATE '2024-01-25'""",
    "ingest_clamped": f"""WITH {_RECORDS},
clamped AS (
  SELECT * REPLACE (
    CASE WHEN k = 35 THEN 2147483647 ELSE condition_code END AS condition_code,
    CASE WHEN k = 36 THEN 999.99 ELSE wind_kph END AS wind_kph,
    CASE WHEN k = 37 THEN 'north by n' ELSE wind_dir END AS wind_dir)
  FROM judged WHERE field IS NULL OR k IN (35, 36, 37))
SELECT event_id, name AS nom, region, country AS pays, last_updated AS datetime_observation,
  CAST(CAST(temp_c AS DECIMAL(5,2)) AS DOUBLE) AS temperature_celsius,
  condition_text AS texte_condition, condition_code AS code_condition,
  CAST(CAST(wind_kph AS DECIMAL(5,2)) AS DOUBLE) AS vent_kph, wind_degree AS vent_degre,
  wind_dir AS direction_vent, CAST(CAST(pressure_mb AS DECIMAL(7,2)) AS DOUBLE) AS pression_millibars,
  CAST(CAST(precip_mm AS DECIMAL(5,2)) AS DOUBLE) AS precipitation_mm,
  humidity AS humidite_pourcentage, cloud AS nuages_pourcentage,
  CAST(CAST(vis_km AS DECIMAL(5,2)) AS DOUBLE) AS visibilite_km,
  CAST(CAST(uv AS DECIMAL(4,1)) AS DOUBLE) AS indice_uv,
  CAST(CAST(gust_kph AS DECIMAL(5,2)) AS DOUBLE) AS rafales_kph
FROM clamped""",
    "insert_ignore_pairs": """WITH RECURSIVE offered AS (
  SELECT l_orderkey, l_partkey, row_number() OVER (ORDER BY l_orderkey, l_partkey) AS r
  FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)),
rounds AS (
  SELECT l_orderkey, l_partkey, r, FALSE AS won FROM offered
  UNION ALL
  SELECT l_orderkey, l_partkey, r, won FROM (
    SELECT *, bool_or(won) OVER (PARTITION BY l_orderkey) OR bool_or(won) OVER (PARTITION BY l_partkey)
      AS taken
    FROM (
      SELECT l_orderkey, l_partkey, r, r = min(r) OVER (PARTITION BY l_orderkey)
        AND r = min(r) OVER (PARTITION BY l_partkey) AS won
      FROM rounds WHERE NOT won))
  WHERE won OR NOT taken)
SELECT l_orderkey, l_partkey FROM rounds WHERE won""",
    "insert_ignore_chain": """
SELECT (event_id + 1) // 2 AS a, event_id // 2 AS b, event_id
FROM (SELECT event_id, row_number() OVER (PARTITION BY island ORDER BY event_id) AS i
  FROM (SELECT event_id, event_id - row_number() OVER (ORDER BY event_id) AS island FROM events))
WHERE i % 2 = 1""",
    "star_view": f"""WITH {_keyed('TRUE')}
SELECT f.id_observation_horaire, l.nom_ville, l.region, l.pays, t.date, t.heure, t.minute,
  t.jour_semaine, t.nom_mois, c.texte_condition, f.temperature_celsius
FROM fait f
JOIN dim_lieux l ON f.id_dim_lieu_fk = l.id_dim_lieu
JOIN dim_temps t ON f.id_dim_temps_fk = t.id_dim_temps
JOIN dim_conditions c ON f.id_dim_condition_fk = c.id_dim_condition""",
    "latest_observations_json": f"""WITH {_keyed('TRUE')},
served AS ({_SERVED} {_NEWEST})
SELECT CAST(to_json({{
  'id_dim_lieu_fk': id_dim_lieu_fk, 'id_dim_temps_fk': id_dim_temps_fk,
  'id_dim_condition_fk': id_dim_condition_fk, 'temperature_celsius': temperature_celsius,
  'vent_kph': vent_kph, 'vent_degre': vent_degre, 'direction_vent': direction_vent,
  'pression_millibars': pression_millibars, 'precipitation_mm': precipitation_mm,
  'humidite_pourcentage': humidite_pourcentage, 'nuages_pourcentage': nuages_pourcentage,
  'visibilite_km': visibilite_km, 'indice_uv': indice_uv, 'rafales_kph': rafales_kph,
  'id_observation_horaire': id_observation_horaire,
  'lieu': {{'id_dim_lieu': id_dim_lieu, 'nom_ville': nom_ville, 'region': region, 'pays': pays}},
  'temps': {{'id_dim_temps': id_dim_temps, 'date': CAST(date AS VARCHAR), 'annee': annee,
    'mois': mois, 'jour': jour, 'heure': heure, 'minute': minute, 'jour_semaine': jour_semaine,
    'nom_mois': nom_mois}},
  'condition': {{'id_dim_condition': id_dim_condition, 'code_condition': code_condition,
    'texte_condition': texte_condition}}
}}) AS VARCHAR) AS json
FROM served""",
}

# --- whole runs -------------------------------------------------------------------

_RUN = (
    _RECORDS
    + f""",
total AS (SELECT max(event_id) + 1 AS n FROM events),
landed AS (
  SELECT flat.* REPLACE (CASE WHEN event_id >= n // 4 AND nom LIKE '%7' THEN 'AAA' ELSE pays END AS pays,
      strptime(datetime_observation, '%Y-%m-%d %H:%M') AS datetime_observation),
    CASE WHEN event_id < n // 2 THEN 1 ELSE 2 END AS half
  FROM flat, total),
lieux_vus AS (
  SELECT half, nom, region, pays, max(event_id) AS last FROM landed GROUP BY ALL),
staged_lieux AS (
  SELECT *, row_number() OVER (PARTITION BY half ORDER BY last, nom, region, pays) AS id_lieu
  FROM lieux_vus),
staged AS (
  SELECT l.*, s.id_lieu FROM landed l JOIN staged_lieux s USING (half, nom, region, pays)
  QUALIFY row_number() OVER (PARTITION BY half, id_lieu, datetime_observation
    ORDER BY event_id) = 1),
last_lieux AS (
  SELECT * FROM staged_lieux QUALIFY row_number() OVER (PARTITION BY half, nom ORDER BY id_lieu DESC) = 1),
dl AS (
  SELECT *, row_number() OVER (ORDER BY first_half, nom) AS id_dim_lieu
  FROM (SELECT nom, min(half) AS first_half FROM last_lieux GROUP BY nom)),
dl_at AS (
  SELECT 1 AS half, id_dim_lieu, nom, region, pays FROM dl JOIN last_lieux USING (nom) WHERE half = 1
  UNION ALL
  SELECT 2, id_dim_lieu, nom, region, pays FROM dl JOIN last_lieux l USING (nom)
  QUALIFY row_number() OVER (PARTITION BY nom ORDER BY l.half DESC) = 1),
dt AS (
  SELECT *, row_number() OVER (ORDER BY first_half, m) AS id_dim_temps
  FROM (SELECT datetime_observation AS m, min(half) AS first_half FROM staged GROUP BY m)),
dc AS (
  SELECT *, row_number() OVER (ORDER BY first_half, code_condition) AS id_dim_condition
  FROM (SELECT code_condition, texte_condition, min(half) AS first_half
        FROM landed GROUP BY code_condition, texte_condition)),
keyed_run AS (
  SELECT s.*, d.id_dim_lieu, dt.id_dim_temps, dc.id_dim_condition
  FROM staged s LEFT JOIN dl_at d USING (half, nom, region, pays)
  JOIN dt ON dt.m = s.datetime_observation JOIN dc USING (code_condition, texte_condition)),
facts_run AS (
  SELECT *, min(half) OVER k AS first_half, max(half) OVER k AS last_half FROM keyed_run
  WHERE id_dim_lieu IS NOT NULL WINDOW k AS (PARTITION BY id_dim_lieu, id_dim_temps)),
fact_ids AS (
  SELECT *, row_number() OVER (ORDER BY first_half, id_dim_lieu, id_dim_temps) AS id_observation_horaire
  FROM facts_run WHERE half = last_half)"""
)

_PARTS = """
parted AS (
  SELECT f.*, CAST(year(datetime_observation) AS INTEGER) AS annee,
    CAST(month(datetime_observation) AS INTEGER) AS mois, CAST(day(datetime_observation) AS INTEGER) AS jour,
    CAST(id_dim_lieu % 4 AS INTEGER) AS seau
  FROM fact_ids f)"""

_PUBLISHED = f"""WITH {_RUN}
SELECT f.id_observation_horaire, f.id_dim_lieu, f.id_dim_temps, f.id_dim_condition, d.nom AS nom_ville,
  d.region, d.pays, CAST(f.datetime_observation AS DATE) AS date,
  CAST(hour(f.datetime_observation) AS INTEGER) AS heure,
  CAST(minute(f.datetime_observation) AS INTEGER) AS minute, f.texte_condition, {_MEASURES}
FROM fact_ids f JOIN dl_at d ON d.half = 2 AND d.id_dim_lieu = f.id_dim_lieu"""

ORACLE |= {
    "landing_order": f"""WITH {_RECORDS},
ends AS (
  SELECT nom, row_number() OVER (PARTITION BY nom ORDER BY event_id // 4000, event_id DESC) AS first,
    row_number() OVER (PARTITION BY nom ORDER BY event_id // 4000 DESC, event_id) AS last,
    datetime_observation, temperature_celsius
  FROM flat)
SELECT nom, f.datetime_observation AS first_datetime_observation,
  f.temperature_celsius AS first_temperature_celsius, l.datetime_observation AS last_datetime_observation,
  l.temperature_celsius AS last_temperature_celsius
FROM ends f JOIN ends l USING (nom) WHERE f.first = 1 AND l.last = 1""",
    "pipeline_parts": f"""WITH {_RUN}, {_PARTS}
SELECT annee, mois, jour, seau, max(last_half)::BIGINT AS wrote, count(*) AS facts
FROM parted GROUP BY annee, mois, jour, seau""",
    "pipeline_city_parts": f"""WITH {_RUN}, {_PARTS}
SELECT annee, mois, jour, seau, count(*) AS facts, count(*) FILTER (nom = 'Customer#000000007') AS of_city
FROM parted GROUP BY annee, mois, jour, seau HAVING of_city > 0""",
    "pipeline_day_coverage": f"""WITH {_RUN}, {_PARTS},
wanted AS (SELECT count(DISTINCT c_name) AS expected FROM customer)
SELECT annee, mois, jour, expected, count(DISTINCT id_dim_lieu) AS seen,
  expected - count(DISTINCT id_dim_lieu) AS missing
FROM parted, wanted GROUP BY annee, mois, jour, expected""",
    "guarded_log": f"""WITH {_RUN},
loads AS (SELECT half, count(id_dim_lieu) AS facts FROM keyed_run GROUP BY half),
told(log_id, process_name, status, half, error) AS (VALUES
  (1, 'run_etl', 'refused', 0, 'holds the lease'),
  (2, 'run_etl', 'running', 0, ''),
  (3, 'transfer_data_to_warehouse', 'success', 1, ''),
  (4, 'run_etl', 'success', 1, ''),
  (5, 'run_etl', 'running', 0, ''),
  (6, 'run_etl', 'skipped_empty', -1, ''),
  (7, 'run_etl', 'running', 0, ''),
  (8, 'transfer_data_to_warehouse', 'failed', 0, 'orphan id_dim_lieu_fk'),
  (9, 'run_etl', 'failed', 0, 'orphan id_dim_lieu_fk'),
  (10, 'run_etl', 'running', 0, ''),
  (11, 'transfer_data_to_warehouse', 'success', 2, ''),
  (12, 'run_etl', 'success', 2, ''))
SELECT CAST(log_id AS BIGINT) AS log_id, process_name, status,
  CASE WHEN t.half = -1 THEN 0 ELSE facts END AS rows_processed, error
FROM told t LEFT JOIN loads l ON t.half = l.half""",
    "guarded_commits": """
SELECT number, batch
FROM (VALUES (1::BIGINT, 'load'), (2, 'lost rows'), (3, 'reset'), (4, 'load')) t(number, batch)
WHERE (SELECT count(*) FROM events) > 0""",
    "reset_facts": f"""WITH {_RUN},
late AS (
  SELECT k.*, dense_rank() OVER (ORDER BY nom) AS id_l FROM last_lieux k WHERE half = 2),
late_minutes AS (SELECT m, row_number() OVER (ORDER BY m) AS id_t FROM (
  SELECT DISTINCT datetime_observation AS m FROM staged WHERE half = 2)),
late_conditions AS (SELECT code_condition, row_number() OVER (ORDER BY code_condition) AS id_c FROM (
  SELECT DISTINCT code_condition FROM landed WHERE half = 2))
SELECT row_number() OVER (ORDER BY id_l, id_t) AS id_observation_horaire, id_l AS id_dim_lieu,
  id_t AS id_dim_temps, id_c AS id_dim_condition, nom AS nom_ville, region, pays,
  CAST(datetime_observation AS DATE) AS date, CAST(hour(datetime_observation) AS INTEGER) AS heure,
  CAST(minute(datetime_observation) AS INTEGER) AS minute, texte_condition, {_MEASURES}
FROM (SELECT * FROM staged WHERE half = 2) s
JOIN (SELECT nom, region, pays, id_l FROM late) USING (nom, region, pays)
JOIN late_minutes ON m = datetime_observation JOIN late_conditions USING (code_condition)""",
    "pipeline_facts": _PUBLISHED,
    "stream_facts": _PUBLISHED,
    "pipeline_second_run": f"""WITH {_RUN}
SELECT 'DimLieux' AS dimension, id_dim_lieu AS id, concat_ws('|', nom, region, pays) AS value
FROM dl_at WHERE half = 2
UNION ALL
SELECT 'DimTemps', id_dim_temps, concat_ws('|', CAST(m AS DATE), hour(m), minute(m), dayname(m), monthname(m))
FROM dt
UNION ALL
SELECT 'DimConditionsMeteo', id_dim_condition, concat_ws('|', code_condition, texte_condition) FROM dc""",
    "pipeline_staging": f"""WITH {_RUN}
SELECT id_lieu, nom, region, pays, datetime_observation, {_MEASURES}, code_condition
FROM staged WHERE half = 2""",
    "pipeline_rejects": f"""WITH {_RUN}
SELECT 'half-' || half AS batch, CAST(half AS BIGINT) AS commit, id_lieu, datetime_observation, {_MEASURES},
  code_condition, 'id_dim_lieu_fk' AS failed_keys
FROM keyed_run WHERE id_dim_lieu IS NULL""",
    "pipeline_record_rejects": f"""WITH {_RECORDS}, total AS (SELECT max(event_id) + 1 AS n FROM events),
halves AS (SELECT *, CASE WHEN event_id < n // 2 THEN 1 ELSE 2 END AS half FROM judged, total)
SELECT 'half-' || half AS batch, CAST(half AS BIGINT) AS commit, field, reason, count(*) AS n,
  count(*) AS with_text
FROM halves WHERE field IS NOT NULL GROUP BY ALL""",
    "pipeline_coverage": f"""WITH {_RUN},
halves AS (
  SELECT CASE WHEN event_id < n // 2 THEN 1 ELSE 2 END AS half, count(*) AS records,
    count(*) FILTER (field IS NULL) AS valid
  FROM judged, total GROUP BY ALL),
loads AS (
  SELECT half, count(*) AS observations, count(*) FILTER (id_dim_lieu IS NULL) AS dropped,
    count(id_dim_lieu) AS facts
  FROM keyed_run GROUP BY half),
seen AS (SELECT half, count(DISTINCT nom) AS cities_seen FROM landed GROUP BY half),
added AS (SELECT first_half AS half, count(*) AS inserted FROM fact_ids GROUP BY first_half)
SELECT CAST(half AS BIGINT) AS number, 'half-' || half AS batch, records, valid, observations, dropped, facts,
  (SELECT count(*) FROM customer) AS cities_expected, cities_seen, inserted
FROM halves JOIN loads USING (half) JOIN seen USING (half) JOIN added USING (half)""",
    "pipeline_log": f"""WITH {_RUN},
loads AS (SELECT half, count(id_dim_lieu) AS facts FROM keyed_run GROUP BY half)
SELECT CAST(3 * (half - 1) + i AS BIGINT) AS log_id,
  CASE WHEN i = 2 THEN 'transfer_data_to_warehouse' ELSE 'run_etl' END AS process_name,
  CASE WHEN i = 1 THEN 'running' ELSE 'success' END AS status,
  CASE WHEN i > 1 THEN facts END AS rows_processed, CAST(NULL AS VARCHAR) AS error_message
FROM loads, (SELECT unnest([1, 2, 3]) AS i)""",
}
