"""The queries in DuckDB's SQL, over the same views, written independently of the operators."""

from __future__ import annotations

from catalume.fixtures import with_views

L, R = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"
_REGIONS = "piemonte|lombardia|veneto|emilia|toscana|lazio|campania|puglia|sicilia|sardegna|abruzzo|umbria|marche|molise|calabria|basilicata|friuli|trentin|liguria|valle d[''\\s]aosta"


def granularity(x: str) -> str:
    m = lambda p: f"regexp_matches(lower({x}), '{p}')"
    return f"""CASE WHEN {m(f'{L}comun[ei]{R}')} OR {m(f'{L}municip')} THEN 'comune' WHEN {m(f'{L}provinc')} THEN 'provincia'
    WHEN {m(f'{L}region[ei]{R}')} OR {m(_REGIONS)} THEN 'regione' WHEN {m(f'{L}(nazional[ei]|itali[ae]|nazione|national|regional){R}')} THEN 'nazionale'
    WHEN {m(f'{L}(europe[ao]|ue|europa|european){R}')} THEN 'europeo' ELSE 'non_determinato' END"""


def years(x: str) -> str:
    return f"list_transform(list_filter(regexp_extract_all({x}, '\\d+'), lambda y: regexp_matches(y, '^(19\\d\\d|20[012]\\d)$')), lambda y: CAST(y AS INTEGER))"


def y0(x: str) -> str:
    return f"list_min({years(x)})"


def y1(x: str) -> str:
    return f"list_max({years(x)})"


CHECKED = f"""checked0 AS (SELECT *, {granularity("coalesce(title, '')")} AS granularity, {y0('title')} AS year_min, {y1('title')} AS year_max,
  upper(CASE WHEN format LIKE '%.%' AND length(format) > 6 THEN regexp_extract(format, '[^.]*$') ELSE format END) AS fmt FROM fx_items),
checked1 AS (SELECT *, (granularity = 'non_determinato' OR year_min IS NULL) AS needs_review FROM checked0),
checked2 AS (SELECT *, CAST(least(100, greatest(0, CASE granularity WHEN 'comune' THEN 40 WHEN 'provincia' THEN 30 WHEN 'regione' THEN 20 WHEN 'nazionale' THEN 10 WHEN 'europeo' THEN 5 ELSE 0 END
  + CASE WHEN year_min IS NOT NULL AND year_max IS NOT NULL THEN least(20, greatest(0, year_max - year_min)) WHEN year_min IS NOT NULL OR year_max IS NOT NULL THEN 5 ELSE 0 END
  + CASE WHEN reachable THEN 20 ELSE 0 END + CASE fmt WHEN 'CSV' THEN 20 WHEN 'JSON' THEN 20 WHEN 'XLSX' THEN 12 WHEN 'XLS' THEN 10 WHEN 'XML' THEN 8 WHEN 'SDMX' THEN 8 WHEN 'PDF' THEN 2 ELSE 0 END
  + CASE WHEN enrich_method IN ('ckan_package_show', 'sdmx_dataflow_annotations') THEN 5 ELSE 0 END - CASE WHEN needs_review THEN 5 ELSE 0 END)) AS INTEGER) AS intake_score FROM checked1),
checked AS (SELECT *, (intake_score >= 40 AND NOT needs_review) AS intake_candidate FROM checked2)"""
RECENT = "SELECT item_id, max(check_timestamp) AS ts FROM fx_existing_checks WHERE check_timestamp >= TIMESTAMP '2001-08-05 00:00:00' GROUP BY item_id"
DUE = "i.source_id || ' ' || i.item_id NOT IN (SELECT r.source_id || ' ' || r.item_id FROM fx_existing_checks r JOIN fx_items m ON m.source_id = r.source_id AND m.item_id = r.item_id WHERE r.check_timestamp >= TIMESTAMP '2001-08-05 00:00:00' AND NOT coalesce(TRY_CAST(m.modified AS TIMESTAMP) > r.check_timestamp, false))"
NEW = f"new_checks AS (SELECT source_id, item_id, TIMESTAMP '2001-08-12 00:00:00' AS check_timestamp, intake_score FROM checked i WHERE {DUE})"
GROUPED = """grouped AS (SELECT source_id, dataset, min(pos) AS first_pos, min_by(nullif(trim(title), ''), pos) FILTER (nullif(trim(title), '') IS NOT NULL) AS title,
  min_by(distribution_count, pos) FILTER (distribution_count IS NOT NULL) AS distribution_count FROM fx_bindings WHERE dataset IS NOT NULL GROUP BY ALL),
uniq AS (SELECT source_id, dataset, kind, string_agg(v, ',' ORDER BY p) AS vs, min_by(v, p) AS v1, count(*) AS n FROM (SELECT source_id, dataset, kind, v, min(pos) AS p FROM (
  SELECT source_id, dataset, pos, 'u' AS kind, download_url AS v FROM fx_bindings UNION ALL SELECT source_id, dataset, pos, 'f', format FROM fx_bindings UNION ALL SELECT source_id, dataset, pos, 't', theme FROM fx_bindings) q
  WHERE dataset IS NOT NULL AND v IS NOT NULL GROUP BY ALL) r GROUP BY source_id, dataset, kind)"""
URI = "regexp_replace(dataset, '/+$', '')"
NAME = f"CASE WHEN {URI} LIKE '%#%' THEN regexp_extract({URI}, '[^#]*$') ELSE regexp_extract({URI}, '[^/]*$') END"
PAGE_OK = "(ordinal % 29 <> 0 AND ordinal % 31 <> 0)"
SIGNALS = """sig AS (SELECT c.source_id AS source, c.protocol,
  CASE WHEN c.status IN ('non_inventariabile', 'protocol_not_supported') THEN CASE WHEN p.status = 'ok' THEN 'structural drift' ELSE 'no signal' END
    WHEN c.status = 'error' THEN 'health' WHEN c.status = 'ok' AND p.status = 'error' THEN 'health'
    WHEN c.status = 'ok' AND p.status = 'ok' AND p.method IS NOT NULL AND p.method <> c.method THEN 'missing_data'
    WHEN c.status = 'ok' AND p.status = 'ok' AND p.row_count <> c.row_count THEN 'inventory change' ELSE 'no signal' END AS signal_type,
  CASE WHEN c.status IN ('non_inventariabile', 'protocol_not_supported') THEN CASE WHEN p.status = 'ok' THEN 'regressione' ELSE 'stabile' END
    WHEN c.status = 'error' THEN 'regressione' WHEN c.status = 'ok' AND p.status = 'error' THEN 'recovery'
    WHEN c.status = 'ok' AND p.status = 'ok' AND p.method IS NOT NULL AND p.method <> c.method THEN 'missing_data'
    WHEN c.status = 'ok' AND p.status = 'ok' AND p.row_count <> c.row_count THEN 'inventory change' ELSE 'stabile' END AS result,
  CASE WHEN c.status = 'ok' THEN c.row_count END AS metric_value,
  CASE WHEN c.status = 'error' AND p.status = 'error' THEN c.error IS DISTINCT FROM p.error END AS error_changed
  FROM (SELECT * FROM fx_report WHERE run_id = 'cur') c LEFT JOIN (SELECT * FROM fx_report WHERE run_id = 'prev') p ON c.source_id = p.source_id)"""
STATUS = "CASE WHEN status_code BETWEEN 200 AND 399 THEN 'GREEN' WHEN status_code BETWEEN 400 AND 499 THEN 'YELLOW' ELSE 'RED' END"
HEALTH_NOTE = f"""CASE WHEN url LIKE '%/api/3/action/%' AND {STATUS} = 'GREEN' THEN CASE WHEN content_type NOT LIKE '%json%' THEN 'CKAN API returned non-JSON content'
  WHEN body = '<html>' THEN 'CKAN API returned invalid JSON' WHEN body NOT LIKE '%"success"%' THEN 'CKAN API payload missing expected keys' END END"""
PROBED = f"""health AS (SELECT *, {HEALTH_NOTE} AS hnote FROM fx_probe_attempts),
probed AS (SELECT source_id, url, attempt, ssl_failed, CASE WHEN error_class IN ('timeout', 'connect_timeout') THEN 'YELLOW' WHEN error_class IS NOT NULL THEN 'RED' WHEN hnote IS NOT NULL THEN 'YELLOW' ELSE {STATUS} END AS status,
  CASE WHEN error_class IS NULL AND status_code IS NOT NULL THEN CAST(status_code AS STRING) ELSE '-' END AS http_code,
  CASE WHEN error_class IS NOT NULL THEN error_class ELSE nullif(concat_ws(' | ', CASE WHEN ssl_failed THEN 'SSL verify failed, fallback used' END, hnote), '') END AS note FROM health)"""
COLLAPSED = PROBED + """, marked AS (SELECT *, contains(url, '/rest/') OR contains(url, '/SDMXWS/') OR contains(url, '/sdmx/') AS sdmx, (status = 'GREEN' OR http_code NOT IN ('500', '502', '503', '504')) AS stop FROM probed),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY CASE WHEN stop OR NOT sdmx THEN attempt ELSE 1000 - attempt END) AS pick FROM marked),
outcome AS (SELECT source_id, status, http_code, CASE WHEN sdmx AND status <> 'GREEN' AND NOT stop THEN 'SDMX retry esaurito (3 tentativi): ' || coalesce(note, 'nessun dettaglio')
  WHEN sdmx AND status <> 'GREEN' AND attempt > 1 THEN 'Retry dopo ' || CAST(attempt - 1 AS STRING) || ' tentativi: ' || coalesce(note, 'nessun dettaglio') ELSE note END AS note,
  ssl_failed AND NOT (sdmx AND status <> 'GREEN' AND (NOT stop OR attempt > 1)) AS ssl_fallback_used FROM ranked WHERE pick = 1)"""
LINES = COLLAPSED + """, lined AS (SELECT r.*, o.status, o.http_code, o.note, o.ssl_fallback_used FROM fx_registry r LEFT JOIN outcome o ON o.source_id = 's' || CAST(r.k AS STRING))"""


def q(select: str, *ctes: str) -> str:
    """select with common table expressions, after those of the views."""
    body = f"WITH {', '.join(ctes)} {select}" if ctes else select
    views = with_views(body)
    return views if not ctes or not views.startswith("WITH fx") else views.replace(f" {body}", ", " + body.removeprefix("WITH "), 1)


CKAN_YEAR = "modified"
COMBINED = "concat_ws(' ', title, 'g' || CAST(ordinal % 3 AS STRING), tags, CASE WHEN ordinal % 2 = 0 THEN 't2' ELSE 't3' END, '  nota ' || item_id || ' ')"
HTML_BAD = "(url NOT LIKE 'http%' OR status_code >= 400 OR octet_length(encode(html)) > 200000)"
HTML_FORMAT = "CASE WHEN " + HTML_BAD + " THEN NULL " + " ".join(f"WHEN regexp_matches(html, '(?i)href=[\"'']([^\"'']*\\.{x})[\"'']') THEN '{x.upper()}'" for x in ("csv", "json", "xlsx", "xls", "xml", "zip", "pdf")) + " END"

ORACLES = {
    "a4_inventory_roundtrip": q("SELECT source_id, count(*) AS n, CAST(sum(CAST(item_id AS BIGINT)) AS BIGINT) AS sum_id, count(title) AS n_titles FROM fx_items GROUP BY source_id"),
    "b1_route": q("SELECT source_id, protocol, CASE WHEN non_inventoriable THEN 'non_inventariabile' WHEN protocol NOT IN ('ckan', 'sdmx', 'sparql') THEN 'protocol_not_supported' ELSE 'inventoriable' END AS status FROM fx_registry WHERE source_kind = 'catalog' AND observation_mode = 'catalog-watch'"),
    "b2_only_sources": q("SELECT source_id, item_id FROM fx_items WHERE source_id IN ('NATION_1', 'NATION_7', 'NATION_15')"),
    "b3_with_url": q("SELECT item_id, landing_page, distribution_url FROM fx_items WHERE landing_page IS NOT NULL OR distribution_url IS NOT NULL"),
    "b4_with_title": q("SELECT item_id, title FROM fx_items WHERE title IS NOT NULL"),
    "b8_payload_gate": q("SELECT source_id, item_id, CASE WHEN ordinal % 29 = 0 THEN 'non-JSON response: <html>Request Rejected</html>' WHEN ordinal % 31 = 0 THEN 'success is false' ELSE 'ok' END AS payload FROM fx_items"),
    "c1_ckan_items": q(f"SELECT source_id, item_id, item_name, item_name AS item_slug, title, CASE ordinal % 4 WHEN 0 THEN 'Ente ' || CAST(ordinal % 9 AS STRING) WHEN 1 THEN 'ente-n' WHEN 2 THEN 'Autore' END AS organization, tags || ', ' || CASE WHEN ordinal % 2 = 0 THEN 't2' ELSE 't3' END AS tags, 'nota ' || item_id AS notes_excerpt, ordinal FROM fx_items WHERE {PAGE_OK}"),
    "c2_ckan_names": q("SELECT source_id, item_name AS item_id, item_name, item_name AS item_slug, ordinal FROM fx_items"),
    "c3_merge_pages": q("SELECT source_id, item_name AS item_id, ordinal FROM fx_items"),
    "c3b_partial_harvest": q("SELECT source_id, CAST(coalesce(sum(n) FILTER (f IS NULL OR position < f), 0) AS BIGINT) AS rows_collected, max(f) AS failed_offset, max(steps) FILTER (position = f) AS failed_limit, CASE WHEN max(f) IS NULL THEN 'ok' WHEN coalesce(sum(n) FILTER (position < f), 0) > 0 THEN 'partial' ELSE 'error' END AS status FROM (SELECT *, min(position) FILTER (NOT ok) OVER (PARTITION BY source_id) AS f FROM per) t GROUP BY source_id",
        "per AS (SELECT 'g' || CAST(n % 40 AS STRING) AS source_id, n AS position, bool_or(coalesce(status_code < 400, false)) AS ok, max(status_code) FILTER (status_code < 400) AS n, max(attempt) AS steps FROM (SELECT *, CAST(substr(source_id, 2) AS INTEGER) AS n FROM fx_probe_attempts) a GROUP BY a.n)"),
    "c4_sdmx_items": q("SELECT source_id, item_id, item_id AS item_name, title FROM fx_items WHERE ordinal % 29 <> 0"),
    "c5_group_bindings": q("SELECT g.source_id, g.dataset, first_pos, title, distribution_count, u.vs AS urls, f.vs AS formats, t.vs AS themes FROM grouped g JOIN uniq u ON u.kind = 'u' AND u.dataset = g.dataset AND u.source_id = g.source_id JOIN uniq f ON f.kind = 'f' AND f.dataset = g.dataset AND f.source_id = g.source_id JOIN uniq t ON t.kind = 't' AND t.dataset = g.dataset AND t.source_id = g.source_id", GROUPED),
    "c5b_sparql_items": q(f"SELECT g.source_id, g.dataset AS item_id, {NAME.replace('dataset', 'g.dataset')} AS item_name, title, u.v1 AS distribution_url, CAST(coalesce(distribution_count, u.n) AS INTEGER) AS distribution_count, replace(f.vs, ',', ', ') AS format, replace(t.vs, ',', ', ') AS theme FROM grouped g JOIN uniq u ON u.kind = 'u' AND u.dataset = g.dataset AND u.source_id = g.source_id JOIN uniq f ON f.kind = 'f' AND f.dataset = g.dataset AND f.source_id = g.source_id JOIN uniq t ON t.kind = 't' AND t.dataset = g.dataset AND t.source_id = g.source_id", GROUPED),
    "c6_ckan_enrich": q(f"SELECT source_id, item_id, landing_page AS resource_url, CASE WHEN landing_page IS NOT NULL THEN format END AS resource_format, {granularity(COMBINED)} AS granularity, coalesce({y0('modified')}, {y0(COMBINED)}) AS year_min, {y1(COMBINED)} AS year_max, 'ckan_package_show' AS enrich_method FROM fx_items WHERE {PAGE_OK}"),
    "c7_sdmx_enrich": q(f"SELECT item_id, CASE WHEN title IS NULL THEN lower(tags) || ', a, b' ELSE lower(tags) || ', ' || lower(title) || ', a, b' END AS tags, raw AS notes, {granularity('raw')} AS granularity, {y0('raw')} AS year_min, {y1('raw')} AS year_max FROM (SELECT *, concat_ws('+', lower(tags), title, ' A,b ') AS raw FROM fx_items WHERE ordinal % 29 <> 0) i"),
    "c8_sdmx_years": q("SELECT item_id, least(1999, coalesce(y, 1999)) AS year_min, greatest(1999, coalesce(y, 1999)) AS year_max FROM (SELECT item_id, TRY_CAST(substr(modified, 1, 4) AS INTEGER) AS y FROM fx_items WHERE ordinal % 29 <> 0) i"),
    "c9_html_format": q(f"SELECT page_id, CASE WHEN {HTML_BAD} THEN 'html_scrape_failed' ELSE 'html_scrape' END AS enrich_method, {HTML_FORMAT} AS format FROM fx_html"),
    "c10_enrich_dispatch": q(f"SELECT i.item_id, CASE WHEN r.protocol = 'ckan' AND {PAGE_OK} THEN 'ckan_package_show' WHEN landing_page IS NULL THEN 'none' WHEN r.scraping_blocked THEN 'scraping_blocked' ELSE coalesce(h.m, 'none') END AS enrich_method, CASE WHEN r.protocol = 'ckan' AND {PAGE_OK} THEN CASE WHEN landing_page IS NOT NULL THEN i.format END WHEN landing_page IS NULL OR r.scraping_blocked THEN NULL ELSE h.f END AS resource_format FROM fx_items i LEFT JOIN fx_registry r ON r.source_id = i.source_id LEFT JOIN h ON h.item_id = i.item_id",
        f"h AS (SELECT CAST(page_id AS STRING) AS item_id, CASE WHEN {HTML_BAD} THEN 'html_scrape_failed' ELSE 'html_scrape' END AS m, {HTML_FORMAT} AS f FROM fx_html)"),
    "c10_enrich_sdmx": q(f"SELECT source_id, item_id, CASE way WHEN 'c' THEN landing_page WHEN 's' THEN meta END AS resource_url, CASE way WHEN 'c' THEN CASE WHEN landing_page IS NOT NULL THEN format END WHEN 's' THEN 'SDMX' WHEN 'h' THEN f END AS resource_format, CASE way WHEN 'c' THEN {granularity(COMBINED)} WHEN 's' THEN {granularity('raw')} ELSE 'non_determinato' END AS granularity, "
        f"CASE way WHEN 'c' THEN coalesce({y0('modified')}, {y0(COMBINED)}) WHEN 's' THEN coalesce({y0('raw')}, o0) END AS year_min, CASE way WHEN 'c' THEN {y1(COMBINED)} WHEN 's' THEN CASE WHEN {y0('raw')} IS NULL THEN o1 ELSE {y1('raw')} END END AS year_max, CASE way WHEN 'c' THEN 'ckan_package_show' WHEN 's' THEN 'sdmx_dataflow_annotations' WHEN 'b' THEN 'scraping_blocked' WHEN 'h' THEN coalesce(m, 'none') ELSE 'none' END AS enrich_method FROM chosen",
        f"h AS (SELECT CAST(page_id AS STRING) AS item_id, CASE WHEN {HTML_BAD} THEN 'html_scrape_failed' ELSE 'html_scrape' END AS m, {HTML_FORMAT} AS f FROM fx_html)",
        f"chosen AS (SELECT i.*, h.m, h.f, concat_ws('+', lower(tags), title, ' A,b ') AS raw, CASE WHEN ordinal % 2 = 0 THEN 'https://example.test/meta/' || i.item_id END AS meta, CASE WHEN ordinal % 7 <> 0 THEN least(1999, coalesce(TRY_CAST(substr(modified, 1, 4) AS INTEGER), 1999)) END AS o0, CASE WHEN ordinal % 7 <> 0 THEN greatest(1999, coalesce(TRY_CAST(substr(modified, 1, 4) AS INTEGER), 1999)) END AS o1, CASE WHEN r.protocol = 'ckan' AND {PAGE_OK} THEN 'c' WHEN r.protocol = 'sdmx' AND ordinal % 29 <> 0 AND ordinal % 23 <> 0 THEN 's' WHEN landing_page IS NULL THEN 'n' WHEN r.scraping_blocked THEN 'b' ELSE 'h' END AS way FROM fx_items i LEFT JOIN fx_registry r ON r.source_id = i.source_id LEFT JOIN h ON h.item_id = i.item_id)"),
    "c11_fallback_infer": q(f"SELECT item_id, {granularity('t')} AS granularity, {y0('t')} AS year_min, {y1('t')} AS year_max FROM (SELECT item_id, concat_ws(' ', title, tags) AS t FROM fx_items) i"),
    "c12_url_to_check": q("SELECT item_id, coalesce(landing_page, distribution_url) AS url FROM fx_items"),
    "c13_head_outcome": q("SELECT source_id, attempt, attempt <> 3 AND error_class IS NULL AND coalesce(status_code < 400, false) AS reachable, CASE WHEN attempt = 3 THEN 'url_missing_or_invalid' WHEN error_class = 'connect_timeout' THEN 'connection_error' ELSE error_class END AS check_notes FROM fx_probe_attempts"),
    "c15_intake_score": q("SELECT item_id, granularity, year_min, year_max, needs_review, intake_score, intake_candidate FROM checked", CHECKED),
    "c16_error_rows": q(f"SELECT source_id, item_id, CASE WHEN {PAGE_OK} THEN 'ckan_package_show' ELSE 'error' END AS enrich_method FROM fx_items"),
    "d1_overlay": q("SELECT i.source_id, i.item_id, CASE WHEN e.item_id IS NOT NULL THEN e.item_name ELSE i.item_name END AS item_name, CASE WHEN e.item_id IS NOT NULL THEN e.title ELSE i.title END AS title, i.ordinal, e.item_id IS NOT NULL AS matched FROM fx_items i LEFT JOIN fx_enriched e ON e.source_id = i.source_id AND e.item_id = i.item_id"),
    "d3_recheck_plan": q("SELECT i.item_id, CASE WHEN r.item_id IS NULL THEN 'not_recent' ELSE 'updated' END AS why FROM fx_items i LEFT JOIN recent r ON r.item_id = i.item_id WHERE r.item_id IS NULL OR TRY_CAST(i.modified AS TIMESTAMP) > r.ts", f"recent AS ({RECENT})"),
    "d5_upsert_latest": q("SELECT item_id, source_id, strftime(check_timestamp, '%Y-%m-%d') AS checked, intake_score FROM (SELECT * FROM new_checks UNION ALL SELECT source_id, item_id, check_timestamp, intake_score FROM fx_existing_checks WHERE item_id NOT IN (SELECT item_id FROM new_checks)) t", CHECKED, NEW),
    "j1_stream_upsert": q("SELECT source_id, item_id, strftime(check_timestamp, '%Y-%m-%d %H:%M:%S') AS check_timestamp, intake_score FROM (SELECT * FROM new_checks UNION ALL SELECT source_id, item_id, check_timestamp, intake_score FROM fx_existing_checks WHERE item_id NOT IN (SELECT item_id FROM new_checks)) t", CHECKED, NEW),
    "d5b_replace_sources": q("SELECT source_id, item_id, intake_score FROM fx_existing_checks WHERE NOT source_id < 'NATION_2' UNION ALL SELECT source_id, item_id, intake_score FROM new_checks WHERE source_id < 'NATION_2'", CHECKED, NEW),
    "d5c_carry_report": q("SELECT source_id, protocol, status, method, row_count, error FROM fx_report r WHERE run_id = 'cur' OR source_id NOT IN (SELECT source_id FROM fx_report WHERE run_id = 'cur')"),
    "d6_report_diff": q("SELECT * FROM (SELECT coalesce(c.source_id, p.source_id) AS source_id, CASE WHEN p.source_id IS NULL THEN 'added' WHEN c.source_id IS NULL THEN 'removed' WHEN p.status = 'ok' AND c.status <> 'ok' THEN 'regression' WHEN p.status <> 'ok' AND c.status = 'ok' THEN 'recovery' WHEN p.status <> 'ok' THEN 'persistent_error' WHEN p.row_count <> c.row_count THEN 'row_change' END AS change, CASE WHEN p.status = 'ok' AND c.status = 'ok' AND p.row_count <> c.row_count THEN CASE WHEN c.row_count > p.row_count THEN '+' ELSE '' END || CAST(c.row_count - p.row_count AS STRING) END AS delta, CASE WHEN p.status <> 'ok' AND c.status <> 'ok' THEN p.error IS DISTINCT FROM c.error END AS message_changed FROM (SELECT * FROM fx_report WHERE run_id = 'cur') c FULL JOIN (SELECT * FROM fx_report WHERE run_id = 'prev') p ON c.source_id = p.source_id) t WHERE change IS NOT NULL"),
    "d7_signals": q("SELECT * FROM sig", SIGNALS),
    "d8_baseline_compare": q("SELECT c.source_id, CASE WHEN c.method IS DISTINCT FROM r.baseline_method OR TRY_CAST(r.baseline_value AS BIGINT) IS NULL THEN 'missing_data' WHEN c.row_count = TRY_CAST(r.baseline_value AS BIGINT) THEN 'stable' ELSE 'changed' END AS result, CASE WHEN c.method = r.baseline_method THEN c.row_count - TRY_CAST(r.baseline_value AS BIGINT) END AS delta FROM fx_report c LEFT JOIN fx_registry r ON r.source_id = c.source_id WHERE c.run_id = 'cur'"),
    "d9_method_fallback": q("SELECT i.source_id, i.item_id, CASE WHEN r.k % 2 = 1 THEN 'package_search' WHEN r.skip_current_list THEN 'package_list' ELSE 'package_list+current_list' END AS method, CASE WHEN r.k % 2 = 0 AND NOT r.skip_current_list AND e.item_id IS NOT NULL THEN e.title ELSE i.title END AS title FROM fx_items i JOIN fx_registry r ON r.source_id = i.source_id AND r.protocol = 'ckan' LEFT JOIN fx_enriched e ON e.source_id = i.source_id AND e.item_id = i.item_id"),
    "e1_source_report": q("SELECT r.source_id, r.protocol, CASE WHEN non_inventoriable THEN 'non_inventariabile' WHEN protocol NOT IN ('ckan', 'sdmx', 'sparql') THEN 'protocol_not_supported' ELSE 'ok' END AS status, CASE WHEN NOT non_inventoriable AND protocol IN ('ckan', 'sdmx', 'sparql') THEN (SELECT count(*) FROM fx_items i WHERE i.source_id = r.source_id) END AS row_count FROM fx_registry r WHERE source_kind = 'catalog' AND observation_mode = 'catalog-watch'"),
    "e2_radar_counts": q("SELECT 'status' AS group_name, s AS category, (SELECT count(*) FROM lined WHERE coalesce(status, 'RED') = s) AS n FROM (VALUES ('GREEN'), ('YELLOW'), ('RED')) v(s) UNION ALL SELECT 'mode', coalesce(observation_mode, 'radar-only'), count(*) FROM lined GROUP BY 2 UNION ALL SELECT 'kind', coalesce(source_kind, 'source'), count(*) FROM lined GROUP BY 2", LINES),
    "e3_value_counts": q("SELECT enrich_method AS value, count(*) AS n FROM fx_items WHERE enrich_method IS NOT NULL GROUP BY 1"),
    "e4_check_summary": q("SELECT count(*) AS n, count(*) FILTER (reachable) AS n_reachable, round(100.0 * count(*) FILTER (reachable) / count(*), 1) AS pct_reachable, count(*) FILTER (needs_review) AS n_review, count(*) FILTER (intake_candidate) AS n_candidates, round(avg(intake_score), 2) AS mean_score FROM checked", CHECKED),
    "e5_overlay_counts": q("SELECT i.source_id, count(DISTINCT e.item_id) AS rows_enriched, count(*) FILTER (e.item_id IS NULL) AS rows_missing_metadata FROM fx_items i LEFT JOIN fx_enriched e ON e.source_id = i.source_id AND e.item_id = i.item_id GROUP BY i.source_id"),
    "e6_sparql_summary": q("SELECT source_id, count(*) AS n_bindings, count(DISTINCT dataset) AS n_datasets FROM fx_bindings GROUP BY source_id"),
    "e8_signal_counts": q("SELECT signal_type, result, count(*) AS n, string_agg(source, ',' ORDER BY source) AS sources FROM sig GROUP BY 1, 2", SIGNALS),
    "e10_inventory_profile": q("SELECT source_id, enrich_method, count(*) AS n_items FROM fx_items GROUP BY 1, 2"),
    "e11_error_preview": q("SELECT source_id, count(*) AS n_errors, string_agg(error_class, '; ' ORDER BY rn) FILTER (rn <= 10) AS messages FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY n, attempt) AS rn FROM (SELECT 'g' || CAST(CAST(substr(source_id, 2) AS INTEGER) % 7 AS STRING) AS source_id, CAST(substr(source_id, 2) AS INTEGER) AS n, attempt, error_class FROM fx_probe_attempts WHERE error_class IS NOT NULL) a) t GROUP BY source_id"),
    "f2_limit_per_source": q("SELECT source_id, item_id, ordinal FROM fx_items WHERE ordinal <= 5"),
    "f4_systematic_sample": q("SELECT source_id, item_id, ordinal FROM (SELECT *, count(*) OVER (PARTITION BY source_id) AS n, ordinal - 1 AS i FROM fx_items) t WHERE n <= 25 OR i = 0 OR i = n - 1 OR (i % (n // 25) = 0 AND i // (n // 25) <= 23)"),
    "g1_limit": q("SELECT source_id, item_id, ordinal FROM fx_items ORDER BY source_id, ordinal LIMIT 100"),
    "g2_top_candidates": q("SELECT source_id, item_id, title, granularity, intake_score FROM checked WHERE intake_candidate ORDER BY intake_score DESC, item_id LIMIT 5", CHECKED),
    "h1_union_sources": q("SELECT source_id, item_id, title, CAST(NULL AS STRING) AS item_name FROM fx_items UNION ALL SELECT source_id, item_id, NULL, item_name FROM fx_enriched"),
    "h3_recent_minus_updated": q("SELECT item_id FROM fx_existing_checks WHERE check_timestamp >= TIMESTAMP '2001-08-05 00:00:00' EXCEPT SELECT item_id FROM fx_items WHERE TRY_CAST(modified AS TIMESTAMP) > TIMESTAMP '2001-08-06 00:00:00'"),
    "i1_granularity": f"SELECT doc_id, {granularity("coalesce(text, '')")} AS granularity FROM documents",
    "i2_years": q(f"SELECT item_id, {y0('title')} AS year_min, {y1('title')} AS year_max FROM fx_items"),
    "i3_ckan_api_base": q("SELECT source_id, 'https://h' || CAST(k AS STRING) || '.example.test' || CASE k % 5 WHEN 0 THEN '/api/3/action' WHEN 1 THEN '/SDMXWS/rest/dataflow' WHEN 2 THEN '' WHEN 3 THEN '/odapi' ELSE '/it' END AS api_base FROM fx_registry"),
    "i4_ckan_endpoint": q("SELECT source_id, 'https://h' || CAST(k AS STRING) || '.example.test' || CASE k % 5 WHEN 0 THEN '/api/3/action/package_show' WHEN 1 THEN '/SDMXWS/rest/dataflow/IT1' WHEN 2 THEN '/sparql' WHEN 3 THEN '/odapi/package_show' ELSE '/it/api' END AS endpoint FROM fx_registry"),
    "i5_sdmx_base": q("SELECT source_id, 'https://h' || CAST(k AS STRING) || '.example.test' || CASE k % 5 WHEN 0 THEN '/api/3/action/package_list' WHEN 1 THEN '/SDMXWS/rest' WHEN 2 THEN '/sparql' WHEN 3 THEN '/odapi/package_list' ELSE '/it/api' END AS base FROM fx_registry"),
    "i6_strip_query": q("SELECT source_id, split_part(base_url, '?', 1) AS plain FROM fx_registry"),
    "i7_parse_int": q("SELECT item_id, TRY_CAST(substr(modified, 1, 4) AS INTEGER) AS year FROM fx_items"),
    "i10_uri_name": q(f"SELECT DISTINCT dataset, {NAME} AS name FROM fx_bindings WHERE dataset IS NOT NULL"),
    "i11_format": q("SELECT item_id, CASE format WHEN 'dati.finale.json' THEN 'JSON' ELSE upper(format) END AS format FROM fx_items"),
    "r1_status": q(f"SELECT source_id, attempt, {STATUS} AS status FROM fx_probe_attempts"),
    "r2_ckan_health": q("SELECT source_id, attempt, status, hnote AS note FROM (SELECT source_id, attempt, hnote, CASE WHEN hnote IS NOT NULL THEN 'YELLOW' ELSE " + STATUS + " END AS status FROM health WHERE error_class IS NULL) t", PROBED),
    "r3_is_sdmx": q("SELECT source_id, protocol = 'sdmx' AS sdmx FROM fx_registry"),
    "r4_probe_error": q("SELECT source_id, attempt, CASE WHEN error_class = 'connection_error' THEN 'RED' ELSE 'YELLOW' END AS status, CASE WHEN ssl_failed THEN 'SSL verify failed; ' || CASE WHEN error_class = 'connection_error' THEN 'fallback connection error' ELSE 'fallback timed out' END ELSE CASE WHEN error_class = 'connection_error' THEN 'Connection error' ELSE 'Timeout' END END || ' (' || error_class || ')' AS note FROM fx_probe_attempts WHERE error_class IS NOT NULL"),
    "r5_ssl_fallback": q("SELECT source_id, attempt, status, http_code, note FROM probed", PROBED),
    "r6_collapse_attempts": q("SELECT * FROM outcome", COLLAPSED),
    "r8_source_lines": q("SELECT source_id, coalesce(status, 'RED') AS status, coalesce(http_code, '-') AS http_code, coalesce(source_kind, 'source') AS source_kind, protocol, coalesce(observation_mode, 'radar-only') AS observation_mode FROM lined", LINES),
    "r9_notes": q("SELECT source_id, status, coalesce(nullif(concat_ws(' | ', CASE WHEN http_code <> '-' THEN 'HTTP ' || http_code END, note), ''), 'Nessuna nota') AS note FROM lined WHERE status <> 'GREEN' OR ssl_fallback_used", LINES),
    "r10_stamp": q("SELECT source_id, '2001-08-12' AS last_probed FROM fx_registry"),
}
