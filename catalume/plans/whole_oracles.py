"""The queries of whole_queries in DuckDB's SQL, written independently of the operators."""

from __future__ import annotations

from catalume.plans.oracles import CHECKED, COMBINED, DUE, GROUPED, LINES, NAME, ORACLES, PAGE_OK, SIGNALS, granularity, q, y0, y1

#: The columns that all rows of a source share; r is the registry's row.
SHARED = "'2001-08-12 00:00:00' AS captured_at, r.source_kind, r.protocol"
HOST = "'https://h' || CAST(r.k AS STRING) || '.example.test'"
API = f"{HOST} || CASE r.k % 5 WHEN 0 THEN '/api/3/action' ELSE '/odapi' END"
TAGS = "tags || ', ' || CASE WHEN ordinal % 2 = 0 THEN 't2' ELSE 't3' END"
SKIP = "(non_inventoriable OR r.protocol NOT IN ('ckan', 'sdmx', 'sparql'))"
REASON = "CASE WHEN non_inventoriable THEN 'Fonte non inventariabile.' WHEN r.protocol NOT IN ('ckan', 'sdmx', 'sparql') THEN 'Protocollo ' || r.protocol || ' non ancora supportato dal builder inventory.' END AS reason"
STATUS = "CASE WHEN non_inventoriable THEN 'non_inventariabile' WHEN r.protocol NOT IN ('ckan', 'sdmx', 'sparql') THEN 'protocol_not_supported'"
WATCHED = "source_kind = 'catalog' AND observation_mode = 'catalog-watch'"
CUR, PREV = "(SELECT * FROM fx_report WHERE run_id = 'cur')", "(SELECT * FROM fx_report WHERE run_id = 'prev')"
SDMX_ROOT = f"{HOST} || CASE k % 5 WHEN 0 THEN '/api/3/action/package_list' WHEN 1 THEN '/SDMXWS/rest' WHEN 2 THEN '/sparql' WHEN 3 THEN '/odapi/package_list' ELSE '/it/api' END"


def nothing(*names: str) -> str:
    return ", ".join(f"CAST(NULL AS STRING) AS {x}" for x in names)


NO_SPARQL = nothing("issued", "modified", "landing_page", "distribution_url", "format", "theme") + ", CAST(NULL AS INTEGER) AS distribution_count"
SCORE = """CAST(least(100, greatest(0, CASE granularity WHEN 'comune' THEN 40 WHEN 'provincia' THEN 30 WHEN 'regione' THEN 20 WHEN 'nazionale' THEN 10 WHEN 'europeo' THEN 5 ELSE 0 END
  + CASE WHEN year_min IS NOT NULL AND year_max IS NOT NULL THEN least(20, greatest(0, year_max - year_min)) WHEN year_min IS NOT NULL OR year_max IS NOT NULL THEN 5 ELSE 0 END
  + CASE WHEN reachable THEN 20 ELSE 0 END + CASE fmt WHEN 'CSV' THEN 20 WHEN 'JSON' THEN 20 WHEN 'XLSX' THEN 12 WHEN 'XLS' THEN 10 WHEN 'XML' THEN 8 WHEN 'SDMX' THEN 8 WHEN 'PDF' THEN 2 ELSE 0 END
  + CASE WHEN enrich_method = 'ckan_package_show' THEN 5 ELSE 0 END - CASE WHEN needs_review THEN 5 ELSE 0 END)) AS INTEGER)"""
RESULT = [
    f"rc0 AS (SELECT *, CASE WHEN {PAGE_OK} THEN {granularity(COMBINED)} END AS g0, CASE WHEN {PAGE_OK} THEN coalesce({y0('modified')}, {y0(COMBINED)}) END AS e0, CASE WHEN {PAGE_OK} THEN {y1(COMBINED)} END AS e1, concat_ws(' ', title, tags) AS fb, coalesce(landing_page, distribution_url) AS url, CASE WHEN {PAGE_OK} THEN 'ckan_package_show' ELSE 'none' END AS way FROM fx_items)",
    f"rc1 AS (SELECT source_id, item_id, item_name, ordinal, title, tags, format, url, way AS enrich_method, CASE WHEN url IS NULL THEN NULL WHEN reachable THEN 200 ELSE 404 END AS http_status, (url IS NOT NULL AND reachable) AS reachable, coalesce(nullif(g0, 'non_determinato'), {granularity('fb')}) AS granularity, coalesce(e0, {y0('fb')}) AS year_min, CASE WHEN g0 IS NULL OR g0 = 'non_determinato' OR e0 IS NULL THEN coalesce(e1, {y1('fb')}) ELSE e1 END AS year_max, upper(CASE WHEN format LIKE '%.%' AND length(format) > 6 THEN regexp_extract(format, '[^.]*$') ELSE format END) AS fmt FROM rc0)",
    "rc2 AS (SELECT *, (granularity = 'non_determinato' OR year_min IS NULL) AS needs_review FROM rc1)",
    f"rc3 AS (SELECT *, {SCORE} AS intake_score FROM rc2)",
]
NOTED = LINES + """, noted AS (SELECT source_id, k, source_kind, protocol, observation_mode, CASE WHEN k % 10 = 7 THEN 'RED' ELSE status END AS status, CASE WHEN k % 10 = 7 THEN '-' ELSE http_code END AS http_code, CASE WHEN k % 10 = 7 THEN 'Missing base_url in registry entry' ELSE note END AS note,
  CASE WHEN k % 10 = 7 THEN false ELSE ssl_fallback_used END AS fallback, CASE WHEN k % 10 <> 7 AND http_code <> '-' THEN 'content-type: text/html' END AS content_type, CASE WHEN k % 10 <> 7 AND http_code <> '-' AND status = 'YELLOW' THEN 'url finale: https://f.test/' || http_code END AS final_url FROM lined)"""
#: What the harvest of _build_responses gives: which rows of the list are enriched, and how.
BUILT = [
    f"bi AS (SELECT i.*, r.k, r.baseline_method, r.base_url, {API} AS api, CASE WHEN k = 10 AND ordinal <= 20 AND ordinal % 2 = 0 THEN 'current_package_list_with_resources' WHEN k = 18 AND ordinal % 25 = 1 AND ordinal % 50 <> 1 THEN 'package_show' END AS rich FROM fx_items i JOIN fx_registry r ON r.source_id = i.source_id)",
    "bf AS (SELECT source_id, 'package_search' AS inventory_method, 'dataset' AS item_kind, item_id, item_name, item_name AS item_slug, title, 'Autore' AS organization, tags, api || '/package_search' AS source_url, api AS api_base_url, ordinal FROM bi WHERE k IN (3, 13) "
    "UNION ALL BY NAME SELECT source_id, CASE rich WHEN 'package_show' THEN 'package_show_sample' ELSE coalesce(rich, baseline_method) END AS inventory_method, 'dataset' AS item_kind, item_name AS item_id, item_name, item_name AS item_slug, CASE WHEN rich = 'package_show' THEN 'Mostra ' || item_id WHEN rich IS NOT NULL THEN title END AS title, CASE WHEN rich LIKE 'current%' THEN 'Autore' END AS organization, CASE WHEN rich LIKE 'current%' THEN tags END AS tags, api || '/' || coalesce(rich, 'package_list') AS source_url, api AS api_base_url, ordinal FROM bi WHERE k IN (0, 10, 15, 18) "
    f"UNION ALL BY NAME SELECT source_id, baseline_method AS inventory_method, 'dataflow' AS item_kind, item_id, item_id AS item_name, title, base_url AS source_url, 'https://h1.example.test/SDMXWS/rest' AS api_base_url, CAST(row_number() OVER (ORDER BY ordinal) AS INTEGER) AS ordinal FROM bi WHERE k = 1 AND ordinal % 29 <> 0 "
    "UNION ALL BY NAME SELECT source_id, baseline_method AS inventory_method, 'dataset' AS item_kind, 'https://example.test/d/' || item_id AS item_id, item_id AS item_name, title, base_url AS source_url, distribution_url, CASE WHEN distribution_url IS NOT NULL THEN 1 END AS distribution_count, CAST(row_number() OVER (ORDER BY (ordinal - 1) % 100, item_id) AS INTEGER) AS ordinal FROM bi WHERE k = 2)",
]
#: Checks of the items that are due, by the enrichment that c10_enrich_sdmx shows.
STREAMED = [
    f"enr AS ({ORACLES['c10_enrich_sdmx']})",
    f"js0 AS (SELECT i.source_id, i.item_id, i.item_name, i.title, CASE WHEN e.enrich_method = 'ckan_package_show' THEN {TAGS} ELSE i.tags END AS tags, CASE WHEN e.enrich_method = 'ckan_package_show' THEN 'nota ' || i.item_id END AS notes, coalesce(e.resource_format, i.format) AS resource_format, coalesce(i.landing_page, i.distribution_url) AS url, i.reachable AS up, e.granularity AS g0, e.year_min AS e0, e.year_max AS e1, e.enrich_method, concat_ws(' ', i.title, i.tags) AS fb FROM fx_items i JOIN enr e ON e.source_id = i.source_id AND e.item_id = i.item_id WHERE {DUE})",
    f"js1 AS (SELECT *, CASE WHEN url IS NULL THEN NULL WHEN up THEN 200 ELSE 404 END AS http_status, (url IS NOT NULL AND up) AS reachable, coalesce(nullif(g0, 'non_determinato'), {granularity('fb')}) AS granularity, coalesce(e0, {y0('fb')}) AS year_min, CASE WHEN g0 = 'non_determinato' OR e0 IS NULL THEN coalesce(e1, {y1('fb')}) ELSE e1 END AS year_max, upper(CASE WHEN resource_format LIKE '%.%' AND length(resource_format) > 6 THEN regexp_extract(resource_format, '[^.]*$') ELSE resource_format END) AS fmt FROM js0)",
    "js2 AS (SELECT *, (granularity = 'non_determinato' OR year_min IS NULL) AS needs_review FROM js1)",
    f"js3 AS (SELECT *, {SCORE.replace("= 'ckan_package_show'", "IN ('ckan_package_show', 'sdmx_dataflow_annotations')")} AS intake_score FROM js2)",
]
HARVESTS = [
    "att AS (SELECT 'g' || CAST(n % 40 AS STRING) AS source_id, n AS position, attempt, coalesce(status_code < 400, false) AS ok, status_code, CASE attempt WHEN 1 THEN 100 WHEN 2 THEN 50 ELSE 10 END AS lim, coalesce(error_class, 'HTTP ' || CAST(status_code AS STRING)) AS failure FROM (SELECT *, CAST(substr(source_id, 2) AS INTEGER) AS n FROM fx_probe_attempts) a)",
    "pos AS (SELECT source_id, position, bool_or(ok) AS ok, max(status_code) FILTER (ok) AS n, max_by(lim, attempt) FILTER (NOT ok) AS lim, max_by(failure, attempt) FILTER (NOT ok) AS failure FROM att GROUP BY source_id, position)",
    "firsts AS (SELECT source_id, min(position) AS f, min_by(lim, position) AS lim, min_by(failure, position) AS failure FROM pos WHERE NOT ok GROUP BY 1)",
    "ends AS (SELECT p.source_id, f, e.lim, e.failure, CAST(coalesce(sum(p.n) FILTER (f IS NULL OR p.position < f), 0) AS BIGINT) AS rows_collected FROM pos p LEFT JOIN firsts e ON e.source_id = p.source_id GROUP BY p.source_id, f, e.lim, e.failure)",
    "statuses AS (SELECT *, CASE WHEN f IS NULL THEN 'ok' WHEN rows_collected > 0 THEN 'partial' ELSE 'error' END AS status FROM ends)",
]

WHOLE = {
    "a1_registry_roundtrip": q("SELECT source_id, protocol, base_url FROM fx_registry"),
    "a2_responses_roundtrip": q("SELECT source_id, CASE WHEN reachable THEN 200 ELSE 404 END AS status_code, count(*) AS n, count(coalesce(landing_page, distribution_url)) AS n_urls, CAST(0 AS BIGINT) AS n_bodies FROM fx_items GROUP BY 1, 2"),
    "a5_report_roundtrip": q("SELECT source_id, protocol, status, method, row_count, error FROM fx_report WHERE run_id = 'cur'"),
    "a6_check_versions": q("SELECT source_id, item_id, '2001-08-12 00:00:00' AS check_timestamp, intake_score FROM checked", CHECKED),
    "b1_route_reasons": q(f"SELECT source_id, {STATUS} ELSE 'inventoriable' END AS status, {REASON} FROM fx_registry r WHERE {WATCHED}"),
    "b8_list_gate": q("SELECT source_id, page * 100 AS start, CASE page % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'result is not a list' WHEN 2 THEN 'no rows' ELSE 'success is false' END AS payload FROM (SELECT DISTINCT source_id, CAST((ordinal - 1) // 100 AS BIGINT) AS page FROM fx_items) p"),
    "c1_ckan_inventory": q(f"SELECT {SHARED}, i.source_id, 'package_search' AS inventory_method, 'dataset' AS item_kind, item_id, item_name, item_name AS item_slug, title, CASE ordinal % 4 WHEN 0 THEN 'Ente ' || CAST(ordinal % 9 AS STRING) WHEN 1 THEN 'ente-n' WHEN 2 THEN 'Autore' END AS organization, {TAGS} AS tags, 'nota ' || item_id AS notes_excerpt, {API} || '/package_search' AS source_url, {API} AS api_base_url, ordinal, {NO_SPARQL} FROM fx_items i JOIN fx_registry r ON r.source_id = i.source_id AND r.protocol = 'ckan' WHERE {PAGE_OK}"),
    "c2_names_inventory": q(f"SELECT {SHARED}, i.source_id, r.baseline_method AS inventory_method, 'dataset' AS item_kind, item_name AS item_id, item_name, item_name AS item_slug, {nothing('title', 'organization', 'tags', 'notes_excerpt')}, {API} || '/package_list' AS source_url, {API} AS api_base_url, ordinal, {NO_SPARQL} FROM fx_items i JOIN fx_registry r ON r.source_id = i.source_id AND r.protocol = 'ckan'"),
    "c3b_harvest_warning": q("SELECT source_id, status, rows_collected, CASE WHEN status = 'partial' THEN 'partial_current_package_list_with_resources' END AS type, CASE WHEN status = 'partial' THEN f END AS failed_offset, CASE WHEN status = 'partial' THEN lim END AS failed_limit, CASE WHEN status = 'partial' THEN failure END AS failure FROM statuses", *HARVESTS),
    "c4_sdmx_inventory": q(f"SELECT {SHARED}, i.source_id, r.baseline_method AS inventory_method, 'dataflow' AS item_kind, item_id, item_id AS item_name, title, {nothing('item_slug', 'organization', 'tags', 'notes_excerpt')}, base_url AS source_url, {HOST} || '/SDMXWS/rest' AS api_base_url, CAST(row_number() OVER (PARTITION BY i.source_id ORDER BY ordinal) AS INTEGER) AS ordinal, {NO_SPARQL} FROM fx_items i JOIN fx_registry r ON r.source_id = i.source_id AND r.protocol = 'sdmx' WHERE ordinal % 29 <> 0"),
    "c4_sdmx_files": q("SELECT i.source_id, item_id, item_id AS item_name, title, CAST(row_number() OVER (PARTITION BY i.source_id ORDER BY ordinal) AS INTEGER) AS ordinal FROM fx_items i JOIN fx_registry r ON r.source_id = i.source_id AND r.protocol = 'sdmx' WHERE ordinal % 29 <> 0"),
    "c5b_sparql_inventory": q(f"SELECT {SHARED}, g.source_id, 'sparql_query' AS inventory_method, 'dataset' AS item_kind, g.dataset AS item_id, {NAME.replace('dataset', 'g.dataset')} AS item_name, title, {nothing('item_slug', 'organization', 'tags', 'notes_excerpt', 'api_base_url', 'issued', 'modified', 'landing_page')}, r.base_url AS source_url, CAST(row_number() OVER (PARTITION BY g.source_id ORDER BY first_pos, g.dataset) AS INTEGER) AS ordinal, u.v1 AS distribution_url, CAST(coalesce(distribution_count, u.n) AS INTEGER) AS distribution_count, replace(f.vs, ',', ', ') AS format, replace(t.vs, ',', ', ') AS theme "
        "FROM grouped g JOIN uniq u ON u.kind = 'u' AND u.dataset = g.dataset AND u.source_id = g.source_id JOIN uniq f ON f.kind = 'f' AND f.dataset = g.dataset AND f.source_id = g.source_id JOIN uniq t ON t.kind = 't' AND t.dataset = g.dataset AND t.source_id = g.source_id LEFT JOIN fx_registry r ON r.k % 5 = 2 AND g.source_id = 's' || CAST((r.k - 2) // 5 AS STRING)", GROUPED),
    "c6_enriched_texts": q(f"SELECT source_id, item_id, title AS enriched_title, {TAGS} AS enriched_tags, 'nota ' || item_id AS enriched_notes FROM fx_items WHERE {PAGE_OK}"),
    "c10_enrich_requests": q("SELECT source_id, item_id, kind, CASE kind WHEN 'ckan' THEN base || '/package_show?id=' || name WHEN 'sdmx' THEN CASE WHEN ordinal % 5 = 0 THEN 'https://api.test' ELSE base END || '/' || name WHEN 'html' THEN landing_page END AS url FROM asked",
        "asked AS (SELECT i.*, CASE WHEN ordinal % 5 = 0 THEN 'https://api.test/x' ELSE r.base_url END AS base, CASE WHEN ordinal % 4 = 0 THEN 'slug-' || item_id ELSE item_name END AS name, CASE WHEN r.protocol IN ('ckan', 'sdmx') THEN r.protocol WHEN landing_page IS NULL THEN 'none' WHEN scraping_blocked THEN 'blocked' ELSE 'html' END AS kind FROM fx_items i LEFT JOIN fx_registry r ON r.source_id = i.source_id)"),
    "c14_check_result": q(f"SELECT '2001-08-12 00:00:00' AS check_timestamp, source_id, item_id, item_name, title, CAST(NULL AS STRING) AS organization, CASE WHEN {PAGE_OK} THEN {TAGS} ELSE tags END AS tags, CASE WHEN {PAGE_OK} THEN 'nota ' || item_id END AS notes, url AS url_checked, http_status, reachable, CASE WHEN url IS NULL THEN 'url_missing_or_invalid' END AS check_notes, granularity, year_min, year_max, format AS resource_format, enrich_method, needs_review, intake_score, (intake_score >= 40 AND NOT needs_review) AS intake_candidate FROM rc3", *RESULT),
    "j1_stream_responses": q(f"SELECT '2001-08-12 00:00:00' AS check_timestamp, source_id, item_id, item_name, title, CAST(NULL AS STRING) AS organization, tags, notes, url AS url_checked, http_status, reachable, CASE WHEN url IS NULL THEN 'url_missing_or_invalid' END AS check_notes, granularity, year_min, year_max, resource_format, enrich_method, needs_review, intake_score, (intake_score >= 40 AND NOT needs_review) AS intake_candidate FROM js3 UNION ALL BY NAME SELECT strftime(check_timestamp, '%Y-%m-%d %H:%M:%S') AS check_timestamp, source_id, item_id, intake_score FROM fx_existing_checks i WHERE NOT ({DUE})", *STREAMED),
    "k2_own_enricher": q("SELECT e.source_id, e.item_id, CASE WHEN i.ordinal % 9 = 0 THEN 'https://own.test/' || i.item_id ELSE e.resource_url END AS resource_url, CASE WHEN i.ordinal % 9 = 0 THEN 'CSV' ELSE e.resource_format END AS resource_format, CASE WHEN i.ordinal % 9 = 0 THEN 'comune' ELSE e.granularity END AS granularity, CASE WHEN i.ordinal % 9 = 0 THEN 1990 ELSE e.year_min END AS year_min, CASE WHEN i.ordinal % 9 = 0 THEN 2000 ELSE e.year_max END AS year_max, CASE WHEN i.ordinal % 9 = 0 THEN 'own' ELSE e.enrich_method END AS enrich_method FROM enr e JOIN fx_items i ON i.source_id = e.source_id AND i.item_id = e.item_id", STREAMED[0]),
    "k1_inventory_build": q(f"SELECT {SHARED}, f.*, {nothing('notes_excerpt', 'issued', 'modified', 'landing_page', 'format', 'theme')} FROM bf f JOIN fx_registry r ON r.source_id = f.source_id", *BUILT),
    "d9_build_report": q(f"SELECT r.source_id, r.protocol, {STATUS} WHEN k IN (6, 7, 16, 20, 21, 22) THEN 'error' ELSE 'ok' END AS status, baseline_method AS method, CASE WHEN NOT {SKIP} AND k NOT IN (6, 7, 16, 20, 21, 22) THEN c.n END AS row_count, CASE WHEN NOT {SKIP} THEN CASE k WHEN 6 THEN 'invalid XML' WHEN 7 THEN 'invalid JSON' WHEN 16 THEN 'HTTP 500' WHEN 20 THEN 'package_list: HTTP 503' WHEN 21 THEN 'no rows' WHEN 22 THEN 'no bindings' END END AS error, {REASON}, "
        "CASE k WHEN 0 THEN 'skip_current_package_list' WHEN 18 THEN 'skip_current_package_list_with_package_show_sample' WHEN 10 THEN 'fallback_current_package_list_with_resources' WHEN 15 THEN 'fallback_package_list' END AS warning, CASE k WHEN 10 THEN 'package_search: success is false' WHEN 15 THEN 'package_search: no rows' END AS package_search_error, CASE k WHEN 15 THEN 'current_package_list_with_resources: success is false' END AS current_list_error, "
        "CASE WHEN k IN (10, 18) THEN c.rich END AS rows_enriched, CASE WHEN k IN (10, 18) THEN c.n - c.rich END AS rows_missing_metadata, CASE k WHEN 10 THEN 2 END AS failed_page, '2001-08-12 00:00:00' AS captured_at "
        f"FROM fx_registry r LEFT JOIN (SELECT source_id, count(*) AS n, count(*) FILTER (inventory_method LIKE 'current%' OR inventory_method = 'package_show_sample') AS rich FROM bf GROUP BY 1) c ON c.source_id = r.source_id WHERE {WATCHED}", *BUILT),
    "h3_plan_metrics": q("SELECT count(*) AS n_items, count(*) FILTER (ts IS NOT NULL) AS n_recent, count(*) FILTER (coalesce(m > ts, false)) AS n_reinspected, count(*) FILTER (ts IS NOT NULL AND NOT coalesce(m > ts, false)) AS n_skipped FROM (SELECT TRY_CAST(i.modified AS TIMESTAMP) AS m, r.check_timestamp AS ts FROM fx_items i LEFT JOIN fx_existing_checks r ON r.source_id = i.source_id AND r.item_id = i.item_id AND r.check_timestamp >= TIMESTAMP '2001-08-05 00:00:00') t"),
    "c16_isolated": q("SELECT source_id, item_id, CASE WHEN ordinal % 29 = 0 OR ordinal % 31 = 0 THEN 'error' ELSE 'ckan_package_show' END AS enrich_method, CASE WHEN ordinal % 29 = 0 THEN 'non-JSON response: <html>Request Rejected</html>' WHEN ordinal % 31 = 0 THEN 'success is false' END AS check_notes FROM fx_items"),
    "d2_with_registry": q("SELECT i.source_id, i.item_id, r.protocol, r.base_url, r.scraping_blocked FROM fx_items i LEFT JOIN fx_registry r ON r.source_id = i.source_id"),
    "d7_signal_details": q(f"""SELECT s.source, s.protocol, s.signal_type, s.result, s.metric_value,
  CASE WHEN c.status = 'non_inventariabile' THEN CASE WHEN p.status = 'ok' THEN 'Fonte non più inventariabile.' ELSE 'Fonte non inventariabile.' END
    WHEN c.status = 'error' THEN CASE WHEN p.status = 'error' THEN 'Errore persistente: ' || c.error || CASE WHEN p.error IS DISTINCT FROM c.error THEN ' (messaggio cambiato rispetto al run precedente)' ELSE '' END ELSE 'Errore: ' || c.error END
    WHEN p.status = 'error' THEN 'Tornato ok. ' || CAST(c.row_count AS STRING) || ' item (' || c.method || ').'
    WHEN p.status = 'ok' AND p.method <> c.method THEN 'Metodo cambiato: precedente ' || chr(39) || p.method || chr(39) || ', attuale ' || chr(39) || c.method || chr(39) || '. Delta non confrontabile con la baseline.'
    WHEN p.status = 'ok' AND p.row_count <> c.row_count THEN CAST(c.row_count AS STRING) || ' item (' || c.method || '), delta ' || CASE WHEN c.row_count > p.row_count THEN '+' ELSE '' END || CAST(c.row_count - p.row_count AS STRING) || ' rispetto al run precedente (' || CAST(p.row_count AS STRING) || ').'
    ELSE CAST(c.row_count AS STRING) || ' item (' || c.method || '), in linea con la baseline.' END AS detail,
  CASE WHEN s.signal_type = 'structural drift' THEN 'verificare causa — fonte precedentemente ok' WHEN c.status = 'error' AND p.status = 'error' THEN 'valutare declassamento a radar-only se persiste' WHEN c.status = 'error' THEN 'monitorare nei prossimi run'
    WHEN s.signal_type = 'missing_data' THEN 'verificare causa cambio metodo; non usare delta come segnale' WHEN s.signal_type = 'inventory change' THEN 'verificare se variazione attesa; avviare catalog-inventory-scout se nuovi dataset' ELSE 'nessuna' END AS suggested_action
  FROM sig s JOIN {CUR} c ON c.source_id = s.source LEFT JOIN {PREV} p ON p.source_id = s.source""", SIGNALS),
    "d8_observed_compare": q(f"SELECT source_id, CASE WHEN m IS DISTINCT FROM baseline_method OR base IS NULL OR n IS NULL THEN CASE WHEN m = baseline_method AND base IS NOT NULL THEN 'changed' ELSE 'missing_data' END WHEN n = base THEN 'stable' ELSE 'changed' END AS result, CASE WHEN m = baseline_method THEN n - base END AS delta FROM seen",
        f"seen AS (SELECT r.source_id, r.baseline_method, TRY_CAST(r.baseline_value AS BIGINT) AS base, CASE WHEN r.k % 4 < 2 THEN 'package_list' ELSE 'package_show' END AS m, CASE WHEN NOT {SKIP} THEN (SELECT count(*) FROM fx_items i WHERE i.source_id = r.source_id) END AS n FROM fx_registry r WHERE {WATCHED})"),
    "e1_full_report": q(f"SELECT r.source_id, r.protocol, {STATUS} WHEN c.status = 'error' THEN 'error' ELSE 'ok' END AS status, r.baseline_method AS method, CASE WHEN NOT {SKIP} AND c.status IS DISTINCT FROM 'error' THEN n END AS row_count, CASE WHEN NOT {SKIP} AND c.status = 'error' THEN c.error END AS error, {REASON}, CASE WHEN NOT {SKIP} AND c.status IS DISTINCT FROM 'error' AND c.row_count % 2 = 0 THEN 'retry_backoff' END AS warning "
        f"FROM fx_registry r LEFT JOIN {CUR} c ON c.source_id = r.source_id LEFT JOIN (SELECT source_id, count(*) AS n FROM fx_items GROUP BY 1) i ON i.source_id = r.source_id WHERE {WATCHED}"),
    "e2_category_counts": q("SELECT g AS group_name, c AS category, CAST(sum(n) AS BIGINT) AS n FROM (SELECT * FROM (VALUES ('status', 'GREEN', 0), ('status', 'YELLOW', 0), ('status', 'RED', 0), ('mode', 'radar-only', 0), ('mode', 'catalog-watch', 0), ('mode', 'monitor-active', 0), ('kind', 'catalog', 0), ('kind', 'portal', 0), ('kind', 'source', 0)) v(g, c, n) UNION ALL SELECT 'status', coalesce(status, 'RED'), count(*) FROM lined GROUP BY 2 UNION ALL SELECT 'mode', coalesce(observation_mode, 'radar-only'), count(*) FROM lined GROUP BY 2 UNION ALL SELECT 'kind', coalesce(source_kind, 'source'), count(*) FROM lined GROUP BY 2) u GROUP BY 1, 2", LINES),
    "e6_named_summary": q("SELECT source_id, count(*) AS n_bindings, count(DISTINCT dataset) AS n_datasets, CASE source_id WHEN 's4' THEN 'custom' ELSE 'q' || CAST(5 * CAST(substr(source_id, 2) AS INTEGER) AS STRING) END AS query_name FROM fx_bindings GROUP BY source_id"),
    "e7_sources_checked": q("SELECT '2001-08-12 00:00:00' AS captured_at, count(*) AS sources_checked FROM fx_report WHERE run_id = 'cur'"),
    "e11_sample_warning": q("SELECT source_id, 'package_show_sample_partial' AS type, count(*) AS sample_size, count(*) FILTER (error_class IS NULL) AS rows_enriched, count(error_class) AS n_errors, string_agg(error_class, '; ' ORDER BY rn) FILTER (error_class IS NOT NULL AND rn <= 10) AS messages FROM (SELECT *, row_number() OVER (PARTITION BY source_id, error_class IS NULL ORDER BY n, attempt) AS rn FROM (SELECT 'g' || CAST(CAST(substr(source_id, 2) AS INTEGER) % 7 AS STRING) AS source_id, CAST(substr(source_id, 2) AS INTEGER) AS n, attempt, error_class FROM fx_probe_attempts) a) t GROUP BY source_id HAVING count(error_class) > 0"),
    "g3_ordered_diff": ORACLES["d6_report_diff"],
    "i5_sdmx_urls": q(f"SELECT source_id, {SDMX_ROOT} AS root, {SDMX_ROOT} || '/data/F' || CAST(k AS STRING) || '?lastNObservations=1' AS data_url, {HOST} || CASE k % 5 WHEN 0 THEN '/api/3/action' WHEN 1 THEN '/SDMXWS/rest/dataflow/IT1' WHEN 2 THEN '' WHEN 3 THEN '/odapi' ELSE '/it' END || '/F' || CAST(k AS STRING) AS flow_url FROM fx_registry r"),
    "i13_quote_path": q("SELECT item_id, 'https://h.test/a%20b/' || coalesce(replace(title, ' ', '%20'), '%C3%A8') || '?q=1 2' AS url FROM fx_items"),
    "i14_run_ts": "SELECT event_id, strftime(date_trunc('second', CAST(ts AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S') AS run_ts FROM events",
    "i17_inventory_settings": q("SELECT source_id, non_inventoriable, false AS skip_package_search, skip_current_list, false AS package_show_sample, CAST(25 AS INTEGER) AS sample_size FROM fx_registry"),
    "r8_lines_with_datasets": q("SELECT source_id, coalesce(status, 'RED') AS status, coalesce(http_code, '-') AS http_code, coalesce(source_kind, 'source') AS source_kind, protocol, coalesce(observation_mode, 'radar-only') AS observation_mode, CASE k % 3 WHEN 0 THEN protocol || ', ' || source_kind ELSE '-' END AS datasets FROM noted", NOTED),
    "r9_note_details": q("SELECT source_id, status, coalesce(nullif(concat_ws(' | ', CASE WHEN http_code <> '-' THEN 'HTTP ' || http_code END, content_type, final_url, coalesce(nullif(note, ''), CASE WHEN k % 4 = 1 THEN 'nota registro' END)), ''), 'Nessuna nota') AS note FROM noted WHERE status <> 'GREEN' OR fallback", NOTED),
}
