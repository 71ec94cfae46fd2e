-- fx_registry (25 sources)
SELECT n_nationkey AS k, n_name AS source_id,
  CASE WHEN n_nationkey % 12 = 11 THEN 'portal' ELSE 'catalog' END AS source_kind,
  CASE n_nationkey % 5 WHEN 0 THEN 'ckan' WHEN 1 THEN 'sdmx' WHEN 2 THEN 'sparql' WHEN 3 THEN 'ckan' ELSE 'rest' END AS protocol,
  CASE WHEN n_nationkey % 6 = 5 THEN 'radar-only' WHEN n_nationkey = 12 THEN NULL ELSE 'catalog-watch' END AS observation_mode,
  'https://h' || CAST(n_nationkey AS STRING) || '.example.test' ||
    CASE n_nationkey % 5 WHEN 0 THEN '/api/3/action/package_list?limit=1' WHEN 1 THEN '/SDMXWS/rest/dataflow/IT1'
      WHEN 2 THEN '/sparql' WHEN 3 THEN '/odapi/package_list?limit=1' ELSE '/it/api/' END AS base_url,
  (n_nationkey % 9 = 8) AS non_inventoriable,
  (n_nationkey % 4 = 0) AS scraping_blocked,
  (n_nationkey % 3 = 0) AS skip_current_list,
  CASE WHEN n_nationkey % 2 = 0 THEN 'package_list' ELSE 'package_search' END AS baseline_method,
  CASE WHEN n_nationkey % 8 = 7 THEN '2025-10-31' ELSE CAST(500 + n_nationkey * 10 AS STRING) END AS baseline_value
FROM nation
;
-- fx_items (one row per order)
SELECT n.n_name AS source_id, CAST(o.o_orderkey AS STRING) AS item_id,
  'ordine-' || CAST(o.o_orderkey AS STRING) AS item_name,
  CAST(row_number() OVER (PARTITION BY n.n_name ORDER BY o.o_orderkey) AS INT) AS ordinal,
  CASE WHEN o.o_orderkey % 13 = 12 THEN NULL ELSE 'Dati ' ||
    CASE o.o_orderkey % 7 WHEN 0 THEN 'comuni' WHEN 1 THEN 'provinciali italiani' WHEN 2 THEN 'Lombardia'
      WHEN 3 THEN 'nazionale' WHEN 4 THEN 'europea' WHEN 5 THEN 'regional statistics' ELSE 'vari' END || ' ' ||
    CASE o.o_orderkey % 5 WHEN 0 THEN 'serie 20352' WHEN 1 THEN CAST(year(o.o_orderdate) AS STRING)
      ELSE CAST(year(o.o_orderdate) - (o.o_orderkey % 23) AS STRING) || '-' || CAST(year(o.o_orderdate) AS STRING) END END AS title,
  o.o_orderpriority AS tags,
  CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE 'https://example.test/item/' || CAST(o.o_orderkey AS STRING) END AS landing_page,
  CASE WHEN o.o_orderkey % 6 = 0 THEN 'https://example.test/d/' || CAST(o.o_orderkey AS STRING) || '.csv' END AS distribution_url,
  CASE o.o_orderkey % 6 WHEN 0 THEN 'CSV' WHEN 1 THEN 'xlsx' WHEN 2 THEN 'dati.finale.json' WHEN 3 THEN NULL WHEN 4 THEN 'PDF' ELSE 'SHP' END AS format,
  CASE o.o_orderkey % 10 WHEN 0 THEN '2001-08-11' WHEN 1 THEN 'n/d' ELSE CAST(CAST(o.o_orderdate AS DATE) AS STRING) END AS modified,
  (o.o_orderkey % 4 <> 0) AS reachable,
  CASE o.o_orderkey % 8 WHEN 0 THEN 'ckan_package_show' WHEN 1 THEN 'sdmx_dataflow_annotations' WHEN 2 THEN 'html_scrape' ELSE 'none' END AS enrich_method
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
;
-- fx_report (run_id prev / cur)
SELECT 'prev' AS run_id, r.source_id, r.protocol,
  CASE WHEN r.k % 9 = 8 AND r.k % 2 = 0 THEN 'non_inventariabile' WHEN r.k % 7 IN (0, 2) THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN r.k % 6 = 1 THEN 'package_search' WHEN r.k % 6 = 4 THEN NULL ELSE 'package_list' END AS method,
  CAST(sum(CASE WHEN r.k % 3 = 0 OR i.modified < '2001' THEN 1 ELSE 0 END) AS BIGINT) AS row_count,
  CASE WHEN r.k % 7 = 0 THEN 'timeout' WHEN r.k % 7 = 2 THEN '503' END AS error
FROM fx_registry r JOIN fx_items i ON i.source_id = r.source_id
WHERE r.k % 11 <> 10 GROUP BY r.k, r.source_id, r.protocol
UNION ALL
SELECT 'cur' AS run_id, r.source_id, r.protocol,
  CASE WHEN r.k % 9 = 8 THEN 'non_inventariabile' WHEN r.k % 7 IN (0, 1) THEN 'error' ELSE 'ok' END AS status,
  'package_list' AS method, CAST(count(*) AS BIGINT) AS row_count,
  CASE WHEN r.k % 14 = 0 THEN 'timeout' WHEN r.k % 7 IN (0, 1) THEN 'connection refused' END AS error
FROM fx_registry r JOIN fx_items i ON i.source_id = r.source_id
WHERE r.k % 11 <> 9 GROUP BY r.k, r.source_id, r.protocol
;
-- fx_existing_checks (previous check results; use now = 2001-08-12, max_age 7 days)
SELECT i.source_id, i.item_id,
  CASE WHEN CAST(i.item_id AS BIGINT) % 4 = 0 THEN TIMESTAMP '2001-08-06 00:00:00' ELSE TIMESTAMP '2001-07-01 00:00:00' END AS check_timestamp,
  CAST(CAST(i.item_id AS BIGINT) % 101 AS INT) AS intake_score
FROM fx_items i WHERE CAST(i.item_id AS BIGINT) % 2 = 0
;
-- fx_probe_attempts (up to 3 attempts per source)
SELECT * FROM (
  SELECT 's' || CAST(user_id AS STRING) AS source_id,
    'https://s' || CAST(user_id AS STRING) || '.example.test' || CASE user_id % 3 WHEN 0 THEN '/rest/dataflow' WHEN 1 THEN '/api/3/action/package_list' ELSE '/catalogo' END AS url,
    CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS attempt,
    CASE WHEN user_id % 30 = 0 THEN 503 WHEN event_type = 'view' THEN 200 WHEN event_type = 'click' THEN 301 WHEN event_type = 'signup' THEN 404 WHEN event_type = 'error' THEN 503 END AS status_code,
    CASE WHEN event_type = 'purchase' AND user_id % 30 <> 0 THEN CASE event_id % 3 WHEN 0 THEN 'timeout' WHEN 1 THEN 'connection_error' ELSE 'connect_timeout' END END AS error_class,
    CASE WHEN event_id % 5 = 0 THEN 'text/html' ELSE 'application/json' END AS content_type,
    CASE event_id % 4 WHEN 0 THEN '{"success": true}' WHEN 1 THEN '{"result": []}' WHEN 2 THEN '<html>' ELSE '[1]' END AS body,
    (event_id % 6 = 0) AS ssl_failed
  FROM events) t WHERE attempt <= 3
;
-- fx_bindings (several bindings per dataset; pos orders them)
SELECT 's' || CAST(l_orderkey % 5 AS STRING) AS source_id,
  CASE WHEN l_orderkey % 17 = 0 THEN NULL WHEN l_orderkey % 2 = 0 THEN 'https://example.test/dataset/' || CAST(l_orderkey AS STRING) || '/'
    ELSE 'https://example.test/ns#' || CAST(l_orderkey AS STRING) END AS dataset,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) AS INT) AS pos,
  CASE WHEN l_linenumber % 2 = 0 THEN 'Titolo ' || CAST(l_partkey AS STRING) ELSE '' END AS title,
  CASE WHEN l_linenumber % 3 = 0 THEN CAST(l_quantity AS INT) END AS distribution_count,
  'https://example.test/f/' || CAST(l_partkey % 3 AS STRING) AS download_url,
  l_returnflag AS format, l_linestatus AS theme
FROM lineitem
;
-- fx_html (pages with a spliced download link)
SELECT page_id, CASE WHEN page_id % 20 = 19 THEN 'ftp://x' ELSE url END AS url,
  CASE WHEN page_id % 20 = 18 THEN 404 ELSE 200 END AS status_code,
  html || CASE WHEN page_id % 50 = 49 THEN repeat('x', 200001) ELSE '' END || CASE page_id % 8 WHEN 0 THEN '<a href="/d/a.CSV">' WHEN 1 THEN '<a href=''/d/b.xlsx''>' WHEN 2 THEN '<a href="/c.pdf"><a href="/c.json">'
    WHEN 3 THEN '<a href="/d.xls">' WHEN 4 THEN '<a href="/e.csv?x=1">' ELSE '' END AS html
FROM pages
;
-- fx_ckan_packages (one raw CKAN package body per item)
SELECT source_id, item_id, ordinal, 200 AS status_code,
  CASE WHEN ordinal % 29 = 0 THEN 'text/html' ELSE 'application/json' END AS content_type,
  CASE WHEN ordinal % 29 = 0 THEN '<html>Request Rejected</html>' WHEN ordinal % 31 = 0 THEN '{"success":false}' ELSE
  '{"success":true,"result":{"id":"' || item_id || '","name":"' || item_name || '","title":"' || coalesce(title, '') || '",' ||
  CASE ordinal % 4 WHEN 0 THEN '"organization":{"title":"Ente ' || CAST(ordinal % 9 AS STRING) || '"},' WHEN 1 THEN '"organization":{"title":"","name":"ente-n"},' WHEN 2 THEN '"author":"Autore",' ELSE '' END ||
  '"tags":[{"display_name":"' || tags || '"},' || CASE WHEN ordinal % 2 = 0 THEN '{"name":"t2"}' ELSE '"t3"' END || '],' ||
  '"groups":[{"display_name":"g' || CAST(ordinal % 3 AS STRING) || '"}],"notes":"  nota ' || item_id || ' ",' ||
  '"resources":[{"url":"ftp://x"},{"url":"' || coalesce(landing_page, '') || '","format":"' || coalesce(format, '') || '"}],' ||
  '"extras":[{"key":"issued","value":"' || modified || '"}]}}' END AS body
FROM fx_items
;
-- fx_enriched (sparse overlay for D1: about one item in three, title null for some)
SELECT source_id, item_id, 'pkg-' || item_id AS item_name,
  CASE WHEN ordinal % 6 = 0 THEN NULL ELSE 'Arricchito ' || item_id END AS title, 999 AS ordinal
FROM fx_items WHERE ordinal % 3 = 0
;
