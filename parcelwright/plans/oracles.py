"""DuckDB SQL for the registered queries, over the same views of the driver's tables."""

from __future__ import annotations

_POLYS = """polys AS (
  SELECT p_partkey AS pid, (p_partkey % 40) * CAST(30 AS DOUBLE) AS minx, (p_partkey // 40) * CAST(30 AS DOUBLE) AS miny,
    CAST(6 + p_size % 12 AS DOUBLE) AS w, CAST(6 + p_size % 15 AS DOUBLE) AS h, minx + w AS maxx, miny + h AS maxy, w * h AS area,
    CASE WHEN p_partkey % 97 = 0 THEN 'large_component' ELSE 'parcel_scale' END AS size_class
  FROM part)"""

_ROLES = """roles AS (
  SELECT c_custkey AS rid, CAST(c_nationkey AS VARCHAR) AS manzana, c_nationkey || '-' || c_custkey AS rol,
    CAST(c_custkey // 2 * 7919 % 12007 AS DOUBLE) * CAST(0.1 AS DOUBLE) AS x, CAST(c_custkey // 2 // 30 AS DOUBLE) * 60 + CAST(c_custkey // 2 * 104729 % 601 AS DOUBLE) * CAST(0.1 AS DOUBLE) AS y,
    x / 100000 AS lon, y / 100000 AS lat, c_custkey % 11 <> 0 AS valid, upper(c_mktsegment) || ' ' || c_custkey % 7 AS addr,
    CASE WHEN c_custkey % 13 = 0 THEN 'not_found' WHEN c_custkey % 17 = 0 THEN 'error' ELSE 'ok' END AS status
  FROM customer)"""

_NEAR = """near AS (
  SELECT r.rid, p.pid, x > minx AND x < maxx AND y > miny AND y < maxy AS inside,
    sqrt(power(greatest(minx - x, 0, x - maxx), 2) + power(greatest(miny - y, 0, y - maxy), 2)) AS dist
  FROM roles r JOIN polys p ON r.valid AND x BETWEEN minx - 10 AND maxx + 10 AND y BETWEEN miny - 10 AND maxy + 10),
best AS (
  SELECT rid, min(pid) FILTER (WHERE inside) AS pip, first(pid ORDER BY dist, pid) AS npid, min(dist) AS ndist FROM near WHERE dist <= 10 GROUP BY rid)"""

_CASCADE = f"""{_POLYS}, {_ROLES}, {_NEAR},
m1 AS (
  SELECT r.*, coalesce(pip, npid) AS pid, CASE WHEN pip IS NOT NULL THEN 'point_in_polygon' WHEN npid IS NOT NULL THEN 'nearest_10m' END AS method,
    CASE WHEN pip IS NOT NULL THEN 0.0 ELSE round(ndist, 2) END AS mdist, CAST(round(lat * 1000000) AS BIGINT) AS la, CAST(round(lon * 1000000) AS BIGINT) AS lo
  FROM roles r LEFT JOIN best USING (rid)),
d1 AS (SELECT la, lo, first(pid ORDER BY rid) AS g FROM m1 WHERE pid IS NOT NULL GROUP BY la, lo),
m2 AS (
  SELECT m1.* EXCLUDE (pid, method), CASE WHEN pid IS NULL AND valid THEN g ELSE pid END AS pid,
    CASE WHEN pid IS NULL AND valid AND g IS NOT NULL THEN 'coord_inheritance' ELSE method END AS method
  FROM m1 LEFT JOIN d1 USING (la, lo)),
d2 AS (SELECT manzana, addr, first(pid ORDER BY rid) AS g FROM m2 WHERE pid IS NOT NULL GROUP BY manzana, addr),
m3 AS (
  SELECT m2.* EXCLUDE (pid, method), coalesce(pid, g) AS pid, CASE WHEN pid IS NULL AND g IS NOT NULL THEN 'address_inheritance' ELSE method END AS method
  FROM m2 LEFT JOIN d2 USING (manzana, addr)),
matched AS (
  SELECT m3.*, area, size_class, CASE WHEN size_class = 'large_component' THEN 'componente_grande_revision'
    WHEN m3.pid IS NULL AND status = 'ok' AND NOT valid THEN 'vigente_sin_visualizacion_sii'
    WHEN m3.pid IS NULL AND status = 'ok' THEN 'vigente_con_coordenada_sin_geometria'
    WHEN m3.pid IS NULL AND status = 'not_found' THEN 'rol_no_encontrado_periodo_actual'
    WHEN m3.pid IS NULL AND status = 'error' THEN 'consulta_sii_error'
    WHEN method = 'point_in_polygon' THEN 'predio_con_dibujo' ELSE 'dibujo_impreciso' END AS quality
  FROM m3 LEFT JOIN polys p ON m3.pid = p.pid)"""

_OUTPUT = f"""{_CASCADE},
rest AS (SELECT pid, area, size_class FROM polys WHERE pid NOT IN (SELECT pid FROM matched WHERE pid IS NOT NULL)),
recovered AS (
  SELECT pid, size_class, CASE WHEN pid % 6 = 0 THEN '900-' || pid END AS rol,
    CASE WHEN pid % 3 <> 0 THEN 'pending' WHEN pid % 6 = 0 THEN 'ok' WHEN pid % 9 = 0 THEN 'error' ELSE 'not_found' END AS status
  FROM rest),
output AS (
  SELECT rid, rol, pid, method, mdist, status, quality, size_class FROM matched UNION ALL
  SELECT NULL, rol, pid, CASE WHEN rol IS NOT NULL THEN 'get_feature_info_orphan' ELSE 'unmatched_polygon' END, CASE WHEN rol IS NOT NULL THEN 0.0 END, status,
    CASE WHEN rol IS NOT NULL THEN 'rol_recuperado' ELSE 'poligono_sin_rol' END, size_class FROM recovered)"""

_EVENTS = """ev AS (
  SELECT CAST(user_id AS VARCHAR) || ':' || event_type AS query_key, CAST(user_id AS VARCHAR) AS commune, event_id AS seq, ts, props, value,
    CASE length(event_type) % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'not_found' ELSE 'error' END AS status FROM events)"""

_STATE = f"""{_EVENTS},
state AS (
  SELECT query_key, first(commune ORDER BY ts, seq) AS commune, last(status ORDER BY ts, seq) AS status, last(props ORDER BY ts, seq) AS response
  FROM ev GROUP BY query_key)"""

_COMMUNES = """communes AS (SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS name, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey)"""
_ADDED = f"""{_COMMUNES},
added AS (SELECT * FROM communes UNION ALL SELECT '8108', 'Trehuaco', 'Ñuble' WHERE NOT EXISTS (SELECT 1 FROM communes WHERE code = '8108'))"""
_SEED = f"""{_ADDED},
existing AS (SELECT '2026S2' AS periodo, code AS codigo_comuna, name AS comuna, region, 'completa' AS status FROM communes WHERE CAST(code AS INT) % 3 = 0),
seeded AS (
  SELECT * FROM existing UNION ALL
  SELECT '2026S2', code, name, region, 'pendiente' FROM added WHERE code NOT IN (SELECT codigo_comuna FROM existing))"""

_CELLS = """cells AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS code, x * 4 + CASE WHEN x > 5 THEN 4000 ELSE 0 END AS sc_x, y * 4 AS sc_y
  FROM nation, range(12) a(x), range(7) b(y) WHERE (x + y * n_nationkey) % 5 <> 0)"""


def _windows(axis: str) -> str:
    return f"""v_{axis} AS (SELECT DISTINCT code, {axis} AS v FROM cells),
n_{axis} AS (SELECT *, CASE WHEN v - lag(v) OVER (PARTITION BY code ORDER BY v) <> 4 THEN 1 ELSE 0 END AS new FROM v_{axis}),
r_{axis} AS (SELECT *, sum(new) OVER (PARTITION BY code ORDER BY v) AS run FROM n_{axis}),
i_{axis} AS (SELECT *, row_number() OVER (PARTITION BY code, run ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY code, run) AS n FROM r_{axis}),
w_{axis} AS (SELECT code, v AS first, v + (least(n - i, 4) - 1) * 4 AS last, row_number() OVER (PARTITION BY code ORDER BY v) - 1 AS win FROM i_{axis} WHERE i % 3 = 0)"""


_MASK = """seen AS (
  SELECT (s_suppkey // 16 - d) * 3 + c AS block_id, x, s_suppkey AS y, (x * x + 3 * s_suppkey * s_suppkey + x * s_suppkey + s_nationkey) % 7 < 4 AS fill
  FROM supplier, range(64) a(x), range(2) b(d), range(3) e(c) WHERE s_suppkey // 16 >= d AND x >= 16 * c AND x < 16 * c + 32),
px AS (SELECT block_id, x, y FROM seen WHERE fill),
isl AS (SELECT *, x - row_number() OVER (PARTITION BY block_id, y ORDER BY x) AS island FROM px),
bare AS (SELECT block_id, y AS gy, min(x) AS x0, max(x) + 1 AS x1 FROM isl GROUP BY block_id, y, island),
runs AS (SELECT *, block_id * 1099511627776 + (gy - min(gy) OVER (PARTITION BY block_id)) * 1048576 + x0 - min(x0) OVER (PARTITION BY block_id) AS run FROM bare)"""

_SHAPES = f"""{_MASK},
edge AS (
  SELECT p.run AS a, q.run AS b FROM runs p JOIN runs q ON p.block_id = q.block_id AND q.gy = p.gy + 1 AND p.x0 < q.x1 AND q.x0 < p.x1),
both_ways AS (SELECT a, b FROM edge UNION ALL SELECT b, a FROM edge),
reach(id, lab) AS (SELECT run, run FROM runs UNION SELECT e.b, r.lab FROM reach r JOIN both_ways e ON e.a = r.id),
lab AS (SELECT id, min(lab) AS polygon_id FROM reach GROUP BY id),
shapes AS (SELECT runs.*, polygon_id FROM runs JOIN lab ON id = run),
big AS (SELECT * FROM shapes WHERE polygon_id IN (SELECT polygon_id FROM shapes GROUP BY polygon_id HAVING sum(x1 - x0) >= 3)),
spx AS (SELECT polygon_id, block_id, gy AS y, unnest(range(x0, x1)) AS x FROM big),
pairs AS (
  SELECT p.polygon_id AS a, q.polygon_id AS b, count(*) AS pixels FROM spx p JOIN spx q ON p.x = q.x AND p.y = q.y AND p.block_id <> q.block_id AND p.polygon_id < q.polygon_id
  GROUP BY ALL)"""

_BASE_X = "(CAST(n_nationkey AS DOUBLE) * 400000 - 5000000)"
_PERIOD = "CASE WHEN {half} = '1' THEN 'PRIMER' WHEN {half} = '2' THEN 'SEGUNDO' END || ' SEMESTRE DE ' || year(o_orderdate)"

ORACLES = {
    "q_role_keys": """WITH h AS (SELECT DISTINCT l_linenumber AS comuna, l_orderkey, l_suppkey FROM lineitem)
SELECT comuna, CAST(l_orderkey AS VARCHAR) AS manzana, CAST(l_suppkey AS VARCHAR) AS predio, l_orderkey || '-' || l_suppkey AS rol FROM h""",
    "q_latest_status": f"""WITH {_EVENTS}
SELECT query_key, status, seq, CAST(ts AS VARCHAR) AS queried_at FROM ev QUALIFY row_number() OVER (PARTITION BY query_key ORDER BY ts DESC, seq DESC) = 1""",
    "q_upsert_state": f"WITH {_STATE} SELECT query_key, commune, status, response FROM state",
    "q_status_counts": f"WITH {_STATE} SELECT status, count(*) AS n FROM state GROUP BY status",
    "q_status_row": f"""WITH {_EVENTS},
state AS (
  SELECT query_key, first(CASE WHEN seq % 3 = 0 THEN 'point' ELSE 'role' END ORDER BY ts, seq) AS source, last(status ORDER BY ts, seq) AS status FROM ev GROUP BY query_key HAVING source = 'role')
SELECT count(*) FILTER (WHERE status = 'ok') AS ok, count(*) FILTER (WHERE status = 'not_found') AS not_found, count(*) FILTER (WHERE status = 'error') AS error FROM state""",
    "q_role_status": """SELECT event_id AS seq, CASE WHEN event_id % 4 = 0 OR event_id % 10 = 5 THEN 'ok' WHEN event_id % 3 = 0 THEN 'error' ELSE 'not_found' END AS status FROM events""",
    "q_anti_resume": f"WITH {_STATE} SELECT query_key FROM state WHERE status NOT IN ('ok', 'not_found')",
    "q_retry_pass": f"""WITH {_EVENTS}
SELECT query_key, CAST(count(*) AS INT) AS attempts, CASE WHEN count(*) % 2 = 0 THEN CAST(60 AS DOUBLE) ELSE CAST(30 AS DOUBLE) END AS total_wait FROM ev GROUP BY query_key HAVING NOT bool_or(status = 'ok')""",
    "q_props_flatten": """SELECT event_id AS seq, CAST(user_id AS INT) AS comuna, '7' AS manzana, CAST(event_id AS VARCHAR) AS predio, '7-' || event_id AS rol, json_extract_string(props, '$.k') AS api_k FROM events""",
    "q_names": r"""SELECT doc_id, md5(trim(regexp_replace(upper(regexp_replace(strip_accents(' ' || coalesce(text, '')), '[^\x00-\x7F]', '', 'g')), '[\x09-\x0D\x1C-\x20]+', ' ', 'g'))) AS name_md5 FROM documents""",
    "q_slugs": """SELECT n_nationkey, lower(n_name) || '_dnuble_--_o' AS slug, lower(n_name) || '_dñuble_ó' AS label FROM nation""",
    "q_addresses": f"WITH {_ROLES} SELECT rid, addr AS address FROM roles",
    "q_expected_period": f"""WITH o AS (SELECT *, CASE WHEN month(o_orderdate) <= 6 THEN '1' WHEN month(o_orderdate) <= 11 THEN '2' ELSE '3' END AS half FROM orders)
SELECT o_orderkey, {_PERIOD.format(half="half")} AS label FROM o""",
    "q_observed_periods": f"""WITH o AS (SELECT *, CASE WHEN month(o_orderdate) <= 6 THEN '1' ELSE '2' END AS half FROM orders), p AS (SELECT DISTINCT {_PERIOD.format(half="half")} AS periodo FROM o)
SELECT periodo, periodo <> 'SEGUNDO SEMESTRE DE 1995' AS unexpected FROM p""",
    "q_mercator": f"""WITH {_ROLES},
p AS (SELECT rid, radians(lon * 100 - 70) * 6378137 AS x, ln(tan(0.7853981633974483 + radians(lat * 100 - 33) / 2)) * 6378137 AS y FROM roles),
c AS (SELECT *, 2 * 20037508.342789244 / 4096 * 4 AS step FROM p)
SELECT rid, CAST(floor((x + 20037508.342789244) / step) * 4 AS INT) AS sc_x, CAST(floor((20037508.342789244 - y) / step) * 4 AS INT) AS sc_y,
  round(degrees(x / 6378137), 6) AS lon, round(degrees(atan(exp(y / 6378137)) * 2 - 1.5707963267948966), 6) AS lat, TRUE AS inside FROM c""",
    "q_point_windows": """WITH p AS (SELECT p_partkey, p_size * CAST(0.0001 AS DOUBLE) AS w, p_partkey * CAST(0.001 AS DOUBLE) - 70 AS lon, p_partkey * CAST(0.0005 AS DOUBLE) - 33 AS lat FROM part),
b AS (SELECT *, lon + w / 2 - greatest(lon + w - lon, CAST(0.002 AS DOUBLE)) AS x0, lon + w / 2 + greatest(lon + w - lon, CAST(0.002 AS DOUBLE)) AS x1,
  lat + w / 2 - greatest(lat + w - lat, CAST(0.002 AS DOUBLE)) AS y0, lat + w / 2 + greatest(lat + w - lat, CAST(0.002 AS DOUBLE)) AS y1 FROM p)
SELECT p_partkey, round(round((lon + w / 4 - x0) / (x1 - x0) * 800, 4), 2) AS x, round(round(600 - (lat + w / 4 - y0) / (y1 - y0) * 600, 4), 2) AS y FROM b""",
    "q_valid_coordinates": """SELECT c_custkey, c_custkey % 5 <> 0 AND c_custkey % 200 - 100 BETWEEN -90 AND 90 AND c_custkey % 400 - 200 BETWEEN -180 AND 180 AS valid FROM customer""",
    "q_catalog_rows": f"WITH {_ADDED} SELECT code, name, region FROM added",
    "q_catalog_seed": f"WITH {_SEED} SELECT periodo, codigo_comuna, comuna, region, status FROM seeded",
    "q_catalog_upsert": f"""WITH {_SEED}, ch AS (SELECT CAST(s_nationkey AS VARCHAR) AS code, count(*) AS n FROM supplier GROUP BY 1)
SELECT periodo, codigo_comuna, status, CAST(NULL AS BIGINT) AS n FROM seeded WHERE codigo_comuna NOT IN (SELECT code FROM ch) UNION ALL
SELECT '2026S2', code, 'completa_con_observaciones', n FROM ch""",
    "q_region_assets": """SELECT r_name AS region_key, count(*) AS n_communes, string_agg(CAST(n_nationkey AS VARCHAR), ',' ORDER BY CAST(n_nationkey AS VARCHAR)) AS codes,
  'asset_' || r_regionkey || '.parquet' AS file FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, r_regionkey""",
    "q_commune_lookup": f"WITH {_COMMUNES} SELECT a.* FROM communes a JOIN communes b USING (region) WHERE b.name = 'NATION_7' AND region = 'ASIA'",
    "q_axis_windows": f'WITH {_CELLS}, {_windows("sc_x")} SELECT code, win AS "window", first, last FROM w_sc_x',
    "q_blocks": f"""WITH {_CELLS}, {_windows("sc_x")}, {_windows("sc_y")},
m AS (
  SELECT c.code, a.first AS origin_x, b.first AS origin_y, sc_x, sc_y FROM cells c
  JOIN w_sc_x a ON a.code = c.code AND sc_x BETWEEN a.first AND a.last JOIN w_sc_y b ON b.code = c.code AND sc_y BETWEEN b.first AND b.last)
SELECT code, dense_rank() OVER (PARTITION BY code ORDER BY origin_y, origin_x) - 1 AS block_id, origin_x, origin_y, sc_x, sc_y FROM m""",
    "q_grid_cover": f"""WITH b AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS code, {_BASE_X} AS minx, CAST(n_nationkey AS DOUBLE) * 300000 - 4000000 AS miny, minx + 250000 + CAST(n_nationkey AS DOUBLE) * 10000 AS maxx,
    miny + (250000 + CAST(n_nationkey AS DOUBLE) * 10000) / 2 AS maxy FROM nation),
c AS (SELECT code, x AS sc_x, y AS sc_y, -20037508.342789244 + x * s AS l, 20037508.342789244 - (y + 1) * s AS t0, s, minx, miny, maxx, maxy
  FROM b, (SELECT 2 * 20037508.342789244 / 256 AS s), range(256) x(x), range(256) y(y))
SELECT code, CAST(sc_x AS INT) AS sc_x, CAST(sc_y AS INT) AS sc_y FROM c
WHERE sqrt(power(greatest(l - maxx, 0, minx - (l + s)), 2) + power(greatest(t0 - maxy, 0, miny - (t0 + s)), 2)) <= 40000""",
    "q_match_pip": f"WITH {_POLYS}, {_ROLES}, {_NEAR} SELECT rid, min(pid) AS _poly_idx FROM near WHERE inside GROUP BY rid",
    "q_match_nearest": f"WITH {_POLYS}, {_ROLES}, {_NEAR} SELECT rid, npid AS _poly_idx, round(ndist, 2) AS dist FROM best",
    "q_match_cascade": f"""WITH {_CASCADE}
SELECT rid, pid AS _poly_idx, method AS _match_method, mdist AS _match_dist_m, area AS pol_area_m2, size_class AS pol_size_class, quality AS calidad_geom FROM matched""",
    "q_match_metrics": f"""WITH {_CASCADE}
SELECT count(*) AS roles, count(*) FILTER (WHERE method = 'point_in_polygon') AS point_in_polygon, count(*) FILTER (WHERE method = 'nearest_10m') AS nearest_10m,
  count(*) FILTER (WHERE method = 'coord_inheritance') AS coord_inheritance, count(*) FILTER (WHERE method = 'address_inheritance') AS address_inheritance,
  count(*) FILTER (WHERE pid IS NULL) AS without_geometry, count(*) FILTER (WHERE quality = 'vigente_sin_visualizacion_sii') AS current_without_published_geometry,
  count(*) FILTER (WHERE quality = 'vigente_con_coordenada_sin_geometria') AS current_with_coordinates_unmatched, count(*) FILTER (WHERE quality = 'rol_no_encontrado_periodo_actual') AS not_found_current_period,
  count(*) FILTER (WHERE quality = 'consulta_sii_error') AS api_error_without_geometry, round(count(pid) / count(*) * 100, 3) AS coverage_pct FROM matched""",
    "q_orphan_polygons": f"WITH {_OUTPUT} SELECT pid AS _poly_idx FROM rest",
    "q_output_union": f"WITH {_OUTPUT} SELECT rid, rol, pid AS _poly_idx, method AS _match_method, mdist AS _match_dist_m, status AS _status, quality AS calidad_geom FROM output",
    "q_final_summary": f"""WITH {_OUTPUT},
p AS (SELECT pid, bool_or(rol IS NOT NULL) AS has FROM output WHERE pid IS NOT NULL GROUP BY pid),
r AS (SELECT rol, bool_or(pid IS NOT NULL) AS shaped FROM output WHERE rol IS NOT NULL GROUP BY rol),
t AS (
  SELECT (SELECT count(*) FROM output) AS rows_total, (SELECT count(pid) FROM output) AS rows_with_geometry, (SELECT count(*) FROM p) AS polygons_total,
    (SELECT count(*) FROM p WHERE has) AS polygons_with_role, (SELECT count(*) FROM r) AS unique_roles_total, (SELECT count(*) FROM r WHERE shaped) AS unique_roles_with_geometry)
SELECT rows_total, rows_with_geometry, polygons_total, polygons_with_role, polygons_total - polygons_with_role AS polygons_without_role,
  round(polygons_with_role / polygons_total * 100, 3) AS polygon_attribution_pct, unique_roles_total, unique_roles_with_geometry, unique_roles_total - unique_roles_with_geometry AS unique_roles_without_geometry,
  round(unique_roles_with_geometry / unique_roles_total * 100, 3) AS unique_role_geometry_coverage_pct FROM t""",
    "q_observations": f"""WITH {_OUTPUT}, {_STATE},
o AS (
  SELECT count(*) FILTER (WHERE pid IS NULL) AS roles_without_geometry, count(*) FILTER (WHERE quality = 'vigente_sin_visualizacion_sii') AS current_roles_without_published_geometry,
    count(*) FILTER (WHERE quality = 'vigente_con_coordenada_sin_geometria') AS current_roles_with_coordinates_unmatched, count(*) FILTER (WHERE quality = 'rol_no_encontrado_periodo_actual') AS roles_not_found_current_period,
    count(*) FILTER (WHERE quality = 'poligono_sin_rol') AS unmatched_polygons, count(*) FILTER (WHERE size_class = 'large_component') AS large_components FROM output),
a AS (SELECT count(*) FILTER (WHERE status = 'error') AS api_error, count(*) FILTER (WHERE status = 'not_found') AS api_not_found FROM state),
g AS (SELECT count(*) FILTER (WHERE area <= 0) AS invalid_geometries FROM output LEFT JOIN polys USING (pid)),
u AS (SELECT count(DISTINCT date_trunc('year', o_orderdate) + CASE WHEN month(o_orderdate) <= 6 THEN INTERVAL 0 MONTH ELSE INTERVAL 6 MONTH END) AS n, bool_or(year(o_orderdate) = 1995 AND month(o_orderdate) > 6) AS expected FROM orders),
p AS (SELECT n - CAST(expected AS INT) AS unexpected_api_periods FROM u)
SELECT o.*, a.*, g.*, CAST(unexpected_api_periods AS BIGINT) AS unexpected_api_periods,
  CASE WHEN roles_without_geometry + unmatched_polygons + large_components + api_error + api_not_found + invalid_geometries + unexpected_api_periods = 0 THEN 'completa' ELSE 'completa_con_observaciones' END AS status
FROM o, a, g, p""",
    "q_vectorization": f"""WITH {_POLYS}, {_MASK},
b AS (SELECT block_id, count(*) FILTER (WHERE fill) AS f, count(*) AS n FROM seen GROUP BY block_id),
p AS (SELECT count(*) AS polygons, count(*) FILTER (WHERE area > 0) AS valid_polygons, count(*) FILTER (WHERE size_class = 'large_component') AS large FROM polys)
SELECT p.*, t.* FROM p, (SELECT count(*) AS blocks, CAST(sum(f) AS BIGINT) AS fill_pixels, min(f / n) AS min_fill_ratio, max(f / n) AS max_fill_ratio FROM b) t""",
    "q_block_identities": """SELECT l_orderkey AS block_id, sha256(string_agg(l_linenumber || ',' || l_suppkey || ',' || sha256(CAST(l_partkey AS VARCHAR)), ';' ORDER BY l_linenumber, l_suppkey, sha256(CAST(l_partkey AS VARCHAR)))) AS identity FROM lineitem GROUP BY l_orderkey""",
    "q_inconsistent_blocks": "SELECT l_orderkey AS block_id FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_suppkey) <> count(*)",
    "q_error_texts": "SELECT doc_id, md5(substr(text, 1, 500)) AS error_md5 FROM documents",
    "q_rounded": """WITH e AS (SELECT l_partkey * 7 + l_linenumber AS k FROM lineitem),
t AS (SELECT k, k * 125 // 100 AS q1, k * 125 % 100 AS r1, k * 125 // 10 AS q2, k * 125 % 10 AS r2 FROM e)
SELECT k AS eighths, (q1 + CASE WHEN r1 > 50 OR r1 = 50 AND q1 % 2 = 1 THEN 1 ELSE 0 END) / 10 AS p1, (q2 + CASE WHEN r2 > 5 OR r2 = 5 AND q2 % 2 = 1 THEN 1 ELSE 0 END) / 100 AS p2 FROM t""",
    "q_historic_parquet": "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS manzana, CAST(l_suppkey AS VARCHAR) AS predio, l_orderkey || '-' || l_suppkey AS rol FROM lineitem WHERE l_linenumber = 3",
    "q_historic_csv": "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS manzana, CAST(l_suppkey AS VARCHAR) AS predio, l_orderkey || '-' || l_suppkey AS rol FROM lineitem WHERE l_linenumber = 3",
    "q_communes_json": f"WITH {_COMMUNES} SELECT code, name, region FROM communes",
    "q_boundary": """SELECT 'nation_11' AS name, CAST(11 + n AS DOUBLE) AS minx, CAST(11 AS DOUBLE) AS miny, CAST(13 + n AS DOUBLE) AS maxx, CAST(12 AS DOUBLE) AS maxy
FROM nation, range(3) t(n) WHERE n_name = 'NATION_11'""",
    "q_asset_entries": "SELECT r_name AS region, 'a' || r_regionkey || '.parquet' AS file, CAST(r_regionkey * 10 AS BIGINT) AS bytes, 'h' || r_regionkey || '.cl,b.cl' AS hosts FROM region",
    "q_stored_lines": r"""SELECT '{"query_key":"' || conv_id || ':' || turn || '","source":' || coalesce(to_json(role)::VARCHAR, 'null') || ',"response":{"text":' || coalesce(to_json(text)::VARCHAR, 'null') || '},"error":null}' AS line FROM conversations""",
    "q_stored_catalog": f"""WITH {_SEED}, ch AS (SELECT CAST(s_nationkey AS VARCHAR) AS code, CAST(count(*) AS VARCHAR) AS n FROM supplier GROUP BY 1)
SELECT periodo, codigo_comuna, status, NULL AS filas_salida, NULL AS poligonos FROM seeded WHERE codigo_comuna NOT IN (SELECT code FROM ch) UNION ALL
SELECT '2026S2', code, 'completa_con_observaciones', n, NULL FROM ch""",
    "q_replayed": f"""WITH {_EVENTS}
SELECT query_key, CAST(length(split_part(query_key, ':', 2)) AS INT) AS status_code, last(props ORDER BY seq) AS body, CAST(max(seq) AS INT) AS attempts FROM ev GROUP BY query_key""",
    "q_role_requests": """SELECT DISTINCT l_linenumber AS comuna, lpad(CAST(l_orderkey AS VARCHAR), 9, '0') AS manzana, lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS predio,
  '{"comuna":"' || l_linenumber || '","manzana":"' || l_orderkey || '","predio":"' || l_suppkey || '","layer":"layer"}' AS request FROM lineitem""",
    "q_contexts": "SELECT CAST(n_nationkey AS VARCHAR) AS commune, CASE WHEN n_nationkey % 4 <> 0 THEN 'layer_' || n_regionkey ELSE 'default' END AS layer FROM nation",
    "q_fill_mask": """WITH p AS (SELECT l_linenumber AS image, l_partkey * 7 + l_suppkey * 13 AS v, CAST(l_quantity AS BIGINT) AS q FROM lineitem),
m AS (SELECT image, abs(170 + v % 30 - 182) <= 20 AND abs(205 + (v + q) % 40 - 221) <= 22 AND abs(215 + (v * 3) % 41 - 232) <= 22 AND q * 5 + 3 >= 20 AS fill FROM p)
SELECT image, count(*) FILTER (WHERE fill) AS fill_pixels, count(*) AS pixels, avg(CAST(fill AS INT)) AS fill_ratio FROM m GROUP BY image""",
    "q_fill_mode": """WITH p AS (
  SELECT l_linenumber AS image, l_orderkey * 100000 + l_partkey AS pos, l_partkey * 7 + l_suppkey * 13 AS v, CAST(l_quantity AS BIGINT) AS q FROM lineitem),
c AS (SELECT image, pos, (170 + v % 30) // 4 * 4 AS r, (205 + (v + q) % 40) // 4 * 4 AS g, (215 + (v * 3) % 41) // 4 * 4 AS b FROM p WHERE q * 5 + 3 >= 20 AND q * 5 + 3 < 250),
i AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY pos) - 1 AS i, count(*) OVER (PARTITION BY image) AS n FROM c),
k AS (SELECT image, r, g, b, n, count(*) AS k, min(i) AS f FROM i WHERE i % greatest(1, n // 200000) = 0 GROUP BY ALL),
t AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY image ORDER BY k DESC, f) = 1),
d AS (SELECT *, n < 100 OR sqrt(power(r - 182, 2) + power(g - 221, 2) + power(b - 232, 2)) > 70 AS other FROM t)
SELECT image, CAST(CASE WHEN other THEN 182 ELSE r END AS INT) AS r, CAST(CASE WHEN other THEN 221 ELSE g END AS INT) AS g, CAST(CASE WHEN other THEN 232 ELSE b END AS INT) AS b FROM d""",
    "q_mask_runs": f"WITH {_MASK} SELECT block_id, gy, x0, x1 FROM runs",
    "q_components": f"WITH RECURSIVE {_SHAPES} SELECT block_id, polygon_id, count(*) AS n_runs, CAST(sum(x1 - x0) AS BIGINT) AS pixels FROM shapes GROUP BY block_id, polygon_id",
    "q_overlap_pairs": f"WITH RECURSIVE {_SHAPES} SELECT a, b, pixels FROM pairs",
    "q_union_area": f"""WITH RECURSIVE {_SHAPES},
link AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
far(id, lab) AS (SELECT DISTINCT polygon_id, polygon_id FROM big UNION SELECT e.b, r.lab FROM far r JOIN link e ON e.a = r.id),
root AS (SELECT id, min(lab) AS root_id FROM far GROUP BY id),
upx AS (SELECT DISTINCT root_id, y * 64 + x AS p FROM spx JOIN root ON id = polygon_id),
step AS (
  SELECT a.root_id, a.p AS a, b.p AS b FROM upx a JOIN upx b ON a.root_id = b.root_id AND (b.p = a.p + 64 OR b.p = a.p - 64 OR (b.p = a.p + 1 AND b.p % 64 > 0) OR (b.p = a.p - 1 AND a.p % 64 > 0))),
grow(root_id, p, lab) AS (SELECT root_id, p, p FROM upx UNION SELECT g.root_id, s.b, g.lab FROM grow g JOIN step s ON s.root_id = g.root_id AND s.a = g.p),
part AS (SELECT root_id, p, min(lab) AS lab FROM grow GROUP BY root_id, p)
SELECT root_id, CAST(dense_rank() OVER (PARTITION BY root_id ORDER BY lab) - 1 AS INT) AS part, count(*) AS pixels, CASE WHEN count(*) > 60 THEN 'large_component' ELSE 'parcel_scale' END AS pol_size_class
FROM part GROUP BY root_id, lab""",
    "q_holes": f"""WITH RECURSIVE {_SHAPES},
box AS (SELECT polygon_id, min(gy) AS top, max(gy) AS bottom, min(x0) AS lft, max(x1) AS rgt FROM shapes GROUP BY polygon_id),
own AS (SELECT polygon_id, gy AS y, unnest(range(x0, x1)) AS x FROM shapes),
space AS (SELECT polygon_id, y, unnest(range(lft - 1, rgt + 1)) AS x, top, bottom, lft, rgt FROM (SELECT *, unnest(range(top, bottom + 1)) AS y FROM box)),
gap AS (SELECT polygon_id, x, y, x < lft OR x >= rgt OR y = top OR y = bottom AS open FROM space ANTI JOIN own USING (polygon_id, x, y)),
flood(polygon_id, x, y) AS (
  SELECT polygon_id, x, y FROM gap WHERE open UNION
  SELECT g.polygon_id, g.x, g.y FROM flood f JOIN gap g ON g.polygon_id = f.polygon_id AND abs(g.x - f.x) <= 1 AND abs(g.y - f.y) <= 1),
hole AS (SELECT polygon_id, x, y FROM gap ANTI JOIN flood USING (polygon_id, x, y)),
one(polygon_id, x, y, lab) AS (
  SELECT polygon_id, x, y, y * 64 + x FROM hole UNION
  SELECT h.polygon_id, h.x, h.y, o.lab FROM one o JOIN hole h ON h.polygon_id = o.polygon_id AND abs(h.x - o.x) <= 1 AND abs(h.y - o.y) <= 1),
lab2 AS (SELECT polygon_id, x, y, min(lab) AS lab FROM one GROUP BY ALL),
small AS (SELECT polygon_id, lab, count(*) AS n FROM lab2 GROUP BY ALL HAVING count(*) < 4),
more AS (SELECT polygon_id, sum(n) AS n FROM small GROUP BY polygon_id)
SELECT s.polygon_id, CAST(sum(x1 - x0) + coalesce(any_value(n), 0) AS BIGINT) AS pixels FROM shapes s LEFT JOIN more USING (polygon_id) GROUP BY s.polygon_id""",
    "q_raw_lines": r"""SELECT '{"query_key":"' || conv_id || ':' || turn || '","source":' || coalesce(to_json(role)::VARCHAR, 'null') || ',"response":{"text":' || coalesce(to_json(text)::VARCHAR, 'null') || '},"error":null}' AS line FROM conversations""",
    "q_geometry_keys": f"""WITH RECURSIVE {_SHAPES}
SELECT polygon_id, substr(sha256(string_agg(gy || ',' || x0 || ',' || x1, ';' ORDER BY gy, x0)), 1, 24) AS geometry_key FROM shapes GROUP BY polygon_id""",
    "q_representative_points": f"""WITH RECURSIVE {_SHAPES},
g AS (SELECT DISTINCT polygon_id, gy FROM shapes),
o AS (SELECT *, row_number() OVER (PARTITION BY polygon_id ORDER BY gy) - 1 AS i, count(*) OVER (PARTITION BY polygon_id) AS n FROM g),
m AS (SELECT polygon_id, gy FROM o WHERE i = (n - 1) // 2)
SELECT polygon_id, (x0 + x1) / 2 AS x, gy + CAST(0.5 AS DOUBLE) AS y FROM shapes JOIN m USING (polygon_id, gy) QUALIFY row_number() OVER (PARTITION BY polygon_id ORDER BY x1 - x0 DESC, x0) = 1""",
    "q_block_metrics": f"""WITH RECURSIVE {_SHAPES},
f AS (SELECT block_id, count(*) FILTER (WHERE fill) AS fill, count(*) AS pixels FROM seen GROUP BY block_id), n AS (SELECT block_id, count(DISTINCT polygon_id) AS k FROM shapes GROUP BY block_id)
SELECT '[' || string_agg('{{"block_id":' || block_id || ',"fill_pixels":' || fill || ',"pixels":' || pixels || ',"polygons":' || coalesce(k, 0) || '}}', ',' ORDER BY block_id) || ']' AS metrics FROM f LEFT JOIN n USING (block_id)""",
    "q_traced": f"""WITH RECURSIVE {_SHAPES}
SELECT polygon_id, CAST(sum(x1 - x0) AS DOUBLE) AS area, CAST(min(x0) AS DOUBLE) AS minx, CAST(min(gy) AS DOUBLE) AS miny, CAST(max(x1) AS DOUBLE) AS maxx, CAST(max(gy) + 1 AS DOUBLE) AS maxy FROM shapes GROUP BY polygon_id""",
    "q_role_rows": f"""WITH {_STATE}
SELECT CAST(commune AS INT) AS comuna, '10' AS manzana, split_part(query_key, ':', 2) AS predio, '10-' || split_part(query_key, ':', 2) AS rol, status = 'ok' AS _ok, status AS _status, json_extract_string(response, '$.k') AS api_k
FROM state WHERE commune = '7'""",
    "q_region_positions": f"""WITH {_COMMUNES}, c AS (SELECT code, name, CAST(row_number() OVER (ORDER BY name) AS INT) AS "position" FROM communes WHERE region = 'EUROPE' AND code IN ('3', '8', '13'))
SELECT * FROM c WHERE "position" IN (1, 3)""",
    "q_request_identities": f"""WITH {_CELLS}
SELECT code, sc_x, sc_y, sha256('{{"commune_code":"' || code || '","layer":"layer","period":"2026S2","sc_x":' || sc_x || ',"sc_y":' || sc_y || ',"supercell_tiles":4,"zoom":19}}') AS identity FROM cells""",
    "q_changed_block_ids": "SELECT o_orderkey AS block_id FROM orders WHERE o_orderkey % 10 = 3 OR o_orderkey % 7 = 0",
    "q_paging": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey > 100 ORDER BY o_orderkey LIMIT 500",
    "q_status_windows": f"WITH {_EVENTS} SELECT strftime(date_trunc('day', ts), '%Y-%m-%d 00:00:00') AS start, status, count(*) AS n FROM ev GROUP BY 1, 2",
    "q_point_results": """SELECT p_partkey, CASE p_partkey % 5 WHEN 2 THEN '{"existePredio": 1, "manzana": 7}' END AS data,
  CASE WHEN p_partkey % 5 = 2 THEN 'ok' WHEN p_partkey % 10 = 4 THEN 'error' ELSE 'not_found' END AS status FROM part""",
}
