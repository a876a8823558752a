"""Independent SQL (DuckDB dialect) for every registered query.

Each statement computes, from the clean driver tables, what the Spark query
must return after building raw input and running the staging operator on it.
"""

#: Orders with their month as text and number, the next month, and the table's last month.
_BY_MONTH = ("WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS m, year(o_orderdate) * 12 + month(o_orderdate) AS i, "
             "strftime(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH, '%Y-%m') AS later, CAST(o_orderkey AS VARCHAR) AS k, "
             "max(year(o_orderdate) * 12 + month(o_orderdate)) OVER () AS last FROM orders) ")

ORACLES: dict[str, str] = {
    "select_rename": "SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_totalprice AS precio_total FROM orders",
    "normalize_names": "SELECT c_custkey AS customer_id, c_name AS nombre_completo, c_acctbal AS anio_saldo, "
                       "c_mktsegment AS segmento FROM customer",
    "snake_case_values": "SELECT p_partkey, replace(p_name, ' ', '_') || '_' || lower(p_type) AS snake FROM part",
    "accent_fold": "SELECT doc_id, regexp_replace(translate(text, 'áÁàÀäÄéÉèÈëËíÍìÌïÏóÓòÒöÖúÚùÙüÜñÑ', "
                   "'aaaaaaeeeeeeiiiiiioooooouuuuuunn'), '\\bano\\b', 'anio', 'gi') AS folded FROM documents",
    "slugify": "SELECT page_id, trim(regexp_replace(regexp_replace(url, '[^0-9a-zA-Z_]', '_', 'g'), '_+', '_', 'g'), '_') "
               "AS slug FROM pages",
    "sheet_key": "SELECT c_custkey, lower(c_mktsegment) || '_' || lower(c_name) AS sheet_key FROM customer",
    "add_partition_col": "SELECT event_id, '2024-01-31' AS fecha_carga, event_type FROM events",
    "cast_by_schema": "SELECT l_orderkey, l_linenumber, CAST(trunc(l_quantity) AS INTEGER) AS qty, "
                      "l_extendedprice AS price, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem",
    "cast_int": "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 3 THEN NULL "
                "ELSE CAST(trunc(l_quantity + l_discount) AS INTEGER) END AS qty FROM lineitem",
    "cast_bigint": "SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS cust FROM orders",
    "cast_double": "SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice END "
                   "AS price FROM lineitem",
    "cast_decimal": "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM orders",
    "cast_boolean": "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS closed FROM orders",
    "cast_string": "SELECT p_partkey, CAST(p_size AS VARCHAR) AS size_text FROM part",
    "es_ampm_parse": "SELECT event_id, date_trunc('second', ts) AS ts FROM events",
    "safe_timestamp": "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS ts "
                      "FROM events",
    "safe_date": "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ts AS DATE) END AS d FROM events",
    "bogota_date": "SELECT event_id, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Bogota' AS DATE) AS local_date "
                   "FROM events",
    "calendar_day": "SELECT strftime(d, '%Y-%m-%d') AS partition_date FROM (SELECT unnest(generate_series("
                    "min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS d FROM events)",
    "calendar_month": "SELECT strftime(d, '%Y-%m') AS partition_month FROM (SELECT unnest(generate_series("
                      "date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) "
                      "AS d FROM orders)",
    "parse_period": "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start FROM orders",
    "previous_period": "SELECT o_orderkey, strftime(o_orderdate - INTERVAL 1 DAY, '%Y-%m-%d') AS prev_day, "
                       "strftime(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH, '%Y-%m') AS prev_month FROM orders",
    "incremental_window": "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE) AS win_start, "
                          "CAST(date_trunc('month', o_orderdate) - INTERVAL 1 DAY AS DATE) AS win_end FROM orders",
    "full_window": "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS win_start, "
                   "last_day(o_orderdate) AS win_end FROM orders",
    "partition_plan": "SELECT s_suppkey, unnest(['2025-01-01', '2025-01-02', '2025-01-03']) AS partition_value "
                      "FROM supplier WHERE s_nationkey < 5 "
                      "UNION ALL SELECT s_suppkey, '2025-01-14' FROM supplier WHERE s_nationkey BETWEEN 5 AND 7 "
                      "UNION ALL SELECT s_suppkey, '2024-12' FROM supplier WHERE s_nationkey BETWEEN 8 AND 9 "
                      "UNION ALL SELECT s_suppkey, '2025-01-15' FROM supplier WHERE s_nationkey BETWEEN 10 AND 14 "
                      "UNION ALL SELECT s_suppkey, unnest(['2024-11', '2024-12', '2025-01']) FROM supplier "
                      "WHERE s_nationkey BETWEEN 15 AND 19 "
                      "UNION ALL SELECT s_suppkey, 'proveedores/' || s_name || '.xlsx' FROM supplier WHERE s_nationkey >= 20",
    "partition_scan": "SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS mes FROM orders "
                      "WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'",
    "csv_scan": "SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice, o_orderdate "
                "FROM orders",
    "json_scan": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "partition_counts": "SELECT strftime(o_orderdate, '%Y-%m') AS partition_month, count(*) AS n FROM orders GROUP BY 1",
    "empty_partitions": "SELECT strftime(d, '%Y-%m-%d') AS partition_date FROM (SELECT unnest(generate_series("
                        "min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS d FROM orders) "
                        "WHERE CAST(d AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)",
    "detect_format": "SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS partition_value, 'csv' AS format FROM orders "
                     "UNION ALL SELECT DISTINCT CAST(c_nationkey AS VARCHAR), 'json' FROM customer",
    "entity_from_path": "SELECT page_id, CASE WHEN contains(string_split(trim(url, '/'), '/')[-1], '_') "
                        "THEN string_split(string_split(trim(url, '/'), '/')[-1], '_')[1] "
                        "ELSE nullif(regexp_replace(string_split(trim(url, '/'), '/')[-2], '^[^=]*=', ''), '') END "
                        "AS entity FROM pages",
    "all_null_columns": "WITH o AS (SELECT *, CAST(NULL AS VARCHAR) AS o_clerk "
                        "FROM orders) SELECT column_name FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM o) "
                        "ON COLUMNS(*) INTO NAME column_name VALUE n) WHERE n = 0",
    "required_nulls": "SELECT 'c_custkey' AS column_name, count(*) FILTER (WHERE c_custkey IS NULL) AS null_rows, "
                      "CAST(0 AS BIGINT) AS empty_rows FROM customer "
                      "UNION ALL SELECT 'c_name', CAST(0 AS BIGINT), count(*) FILTER (WHERE c_mktsegment = 'AUTOMOBILE') "
                      "FROM customer "
                      "UNION ALL SELECT 'c_mktsegment', count(*) FILTER (WHERE c_mktsegment = 'BUILDING'), CAST(0 AS BIGINT) "
                      "FROM customer",
    "validation_report": "SELECT 'missing_column' AS check_name, 'c_comment' AS column_name, count(*) AS bad_rows FROM customer "
                         "UNION ALL SELECT 'unparseable', 'c_acctbal', count(*) FILTER (WHERE c_acctbal < 0) FROM customer "
                         "UNION ALL SELECT 'required_null', 'c_mktsegment', count(*) FILTER (WHERE c_mktsegment = 'BUILDING') "
                         "FROM customer",
    "type_conformance": "SELECT 'l_linenumber' AS column_name, count(*) AS total_rows, CAST(0 AS BIGINT) AS bad_rows "
                        "FROM lineitem "
                        "UNION ALL SELECT 'l_quantity', count(*), 0 FROM lineitem "
                        "UNION ALL SELECT 'l_extendedprice', count(*), count(*) FILTER (WHERE l_returnflag = 'R') FROM lineitem "
                        "UNION ALL SELECT 'l_shipdate', count(*), 0 FROM lineitem",
    "merge_upsert": "WITH s AS (SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice FROM orders "
                    "WHERE o_orderdate >= TIMESTAMP '1997-07-01'), "
                    "t AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01') "
                    "SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT * FROM s",
    "merge_dup_keys": "SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 "
                      "HAVING count(*) > 1",
    "overwrite_partitions": "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'F' "
                            "UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders "
                            "WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1998-01-01'",
    "schema_sync": "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal "
                   "FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING') "
                   "UNION ALL SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT), c_acctbal FROM customer "
                   "WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING')",
    "run_audit": "SELECT strftime(o_orderdate, '%Y-%m') AS partition_month, count(*) AS n, "
                 "CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'P' AND o_totalprice < 10000) > 0 THEN 'FAILED' "
                 "ELSE 'SUCCEEDED' END AS status, "
                 "CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'P' AND o_totalprice < 10000) > 0 "
                 "THEN 'required_null: Prioridad' END AS error FROM orders GROUP BY 1",
    "params_json": "SELECT o_orderkey, '[{\"name\":\"fecha_inicial\",\"type\":\"date\",\"value\":\"' || "
                   "strftime(o_orderdate, '%Y-%m-01') || '\"},{\"name\":\"fecha_final\",\"type\":\"date\",\"value\":\"' || "
                   "strftime(last_day(o_orderdate), '%Y-%m-%d') || '\"},{\"name\":\"prioridad\",\"type\":\"string\",\"value\":\"' "
                   "|| o_orderpriority || '\"}]' AS params FROM orders",
    "window_selection": "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate - INTERVAL 30 DAY, '%Y-%m-%d') "
                        "ELSE strftime(o_orderdate, '%Y-%m-%d') END AS win_start, strftime(o_orderdate, '%Y-%m-%d') AS win_end "
                        "FROM orders",
    "raw_plan": "SELECT s_name AS name, 'raw/' || lower(s_name) AS path_name_input, s_name || '.json' AS file_name, "
                "'fecha' AS partition_key_raw, '[{\"name\":\"fecha_corte\",\"type\":\"date\",\"value\":\"' || "
                "strftime(last_day(DATE '2023-01-01' + to_months(s_nationkey)), '%Y-%m-%d') || '\"}]' AS params FROM supplier",
    "staging_plan": "SELECT lower(s_name) AS catalog_table, 'raw/' || lower(s_name) || '/' AS path_name_raw, "
                    "'' AS excel_sheet, '' AS file_name_excel, "
                    "strftime(DATE '2023-01-01' + to_months(s_nationkey), '%Y-%m-%d') AS start_date, "
                    "strftime(last_day(DATE '2023-01-01' + to_months(s_nationkey)), '%Y-%m-%d') AS end_date FROM supplier",
    "load_plan": "SELECT 'raw' AS layer, s_name AS name, "
                 "strftime(DATE '2023-01-01' + to_months(s_nationkey), '%Y-%m-%d') AS start_date, "
                 "strftime(last_day(DATE '2023-01-01' + to_months(s_nationkey)), '%Y-%m-%d') AS end_date FROM supplier "
                 "UNION ALL SELECT 'staging', lower(s_name), "
                 "strftime(DATE '2023-01-01' + to_months(s_nationkey), '%Y-%m-%d'), "
                 "strftime(last_day(DATE '2023-01-01' + to_months(s_nationkey)), '%Y-%m-%d') FROM supplier",
    "parse_list": "SELECT p_partkey, CASE WHEN p_size > 45 THEN NULL ELSE replace(p_name, ' ', '|') END AS items FROM part",
    "staging_load": "WITH s AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) + 1 AS price, o_orderdate FROM orders "
                    "WHERE o_orderdate >= TIMESTAMP '1997-07-01'), "
                    "t AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderdate FROM orders "
                    "WHERE o_orderdate < TIMESTAMP '1998-01-01'), "
                    "m AS (SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT * FROM s) "
                    "SELECT strftime(o_orderdate, '%Y-%m') AS anio_mes, CAST(sum(price) AS DECIMAL(38,2)) AS revenue, "
                    "count(*) AS orders FROM m GROUP BY 1",
    "xlsx_scan": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, "
                 "CAST(DATE '2020-01-01' + s_nationkey AS TIMESTAMP) AS fecha_alta, s_acctbal > 0 AS activo FROM supplier",
    # a number column holds doubles as soon as a cell is empty or has a fraction; a text column stays text
    "cell_type_inference": "WITH s AS (SELECT *, DATE '2020-01-01' + CAST(s_nationkey AS INTEGER) AS alta, "
                           "s_acctbal > 0 AS activo, CAST(NULL AS VARCHAR) AS comentario, "
                           "CASE WHEN s_nationkey >= 5 THEN s_acctbal END AS bono, "
                           "CASE WHEN s_nationkey >= 5 THEN s_nationkey END AS codigo FROM supplier) "
                           + " UNION ALL ".join(
                               f"SELECT '{name}' AS column_name, CASE WHEN count({c}) = count(*) AND "
                               f"bool_and({c} = floor({c})) THEN 'bigint' ELSE 'double' END AS spark_type FROM s"
                               for name, c in (("Proveedor ID", "s_suppkey"), ("Nación", "s_nationkey"),
                                               ("Saldo", "s_acctbal"), ("Bono", "bono"), ("Código", "codigo")))
                           + "".join(
                               f" UNION ALL SELECT '{name}', CASE any_value(typeof({c})) WHEN 'DATE' THEN 'timestamp' "
                               f"WHEN 'BOOLEAN' THEN 'boolean' ELSE 'string' END FROM s"
                               for name, c in (("Nombre", "s_name"), ("Fecha Alta", "alta"), ("Activo", "activo"),
                                               ("Comentario", "comentario"))),
    "empty_partitions_message": "SELECT 'WARNING' AS status, 'Warning: The following partitions had no data and were "
                                "skipped: ' || string_agg(strftime(d, '%Y-%m-%d'), ', ' ORDER BY d) AS message FROM ("
                                "SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), "
                                "INTERVAL 1 DAY)) AS d FROM orders) WHERE CAST(d AS DATE) NOT IN "
                                "(SELECT CAST(o_orderdate AS DATE) FROM orders) HAVING count(*) > 0",
    "staging_job": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, CASE WHEN o_orderstatus = 'P' AND o_totalprice < 10000 THEN NULL ELSE o_orderpriority END AS o_orderpriority, strftime(o_orderdate, '%Y-%m') AS mes_carga FROM orders",
    "stream_incremental": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, CASE WHEN o_orderstatus = 'P' AND o_totalprice < 10000 THEN NULL ELSE o_orderpriority END AS o_orderpriority, strftime(o_orderdate, '%Y-%m') AS mes_carga FROM orders",
    "sink_merge": "WITH o AS (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'a:b/c, d=1' WHEN 'O' THEN '100%' END AS clase FROM orders) "
                  "SELECT o_orderkey, o_custkey, o_totalprice, clase FROM o WHERE o_orderdate < TIMESTAMP '1997-07-01' UNION ALL "
                  "SELECT o_orderkey, o_custkey, o_totalprice + 1, CASE WHEN o_custkey % 5 = 0 THEN 'nueva' "
                  "WHEN o_custkey % 5 <> 1 THEN clase END FROM o WHERE o_orderdate >= TIMESTAMP '1997-07-01'",
    "sink_overwrite": "WITH o AS (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'a:b/c, d=1' WHEN 'O' THEN '100%' END AS clase FROM orders), "
                      "n AS (SELECT * FROM o WHERE (clase IS NULL OR clase <> '100%') AND o_orderdate >= TIMESTAMP '1997-01-01') "
                      "SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, clase FROM n UNION ALL "
                      "SELECT o_orderkey, o_totalprice, clase FROM o WHERE NOT EXISTS "
                      "(SELECT 1 FROM n WHERE n.clase IS NOT DISTINCT FROM o.clase)",
    "sink_schema_sync": "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, "
                        "CASE WHEN c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING') THEN c_acctbal END AS c_acctbal, c_mktsegment FROM customer",
    "staging_job_overlap": _BY_MONTH + "SELECT o_orderkey, CASE WHEN again OR i % 2 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, "
                           "o_orderstatus, CASE WHEN again THEN later ELSE m END AS mes_carga "
                           "FROM (SELECT *, i % 2 = 0 AND i < last AS again FROM o)",
    "drift_scan": _BY_MONTH + "SELECT k AS o_orderkey, o_totalprice, o_orderstatus, CAST(NULL AS VARCHAR) AS file_mes, m AS raw_month FROM o WHERE i % 3 = 0 "
                  "UNION ALL SELECT k, o_totalprice + 1, o_orderstatus, m, m FROM o WHERE i % 3 = 1 "
                  "UNION ALL SELECT k, o_totalprice + 1, o_orderstatus, m, later FROM o WHERE i % 3 = 0 AND i < last "
                  "UNION ALL SELECT k, o_totalprice, NULL, NULL, m FROM o WHERE i % 3 = 2",
    "missing_by_partition": _BY_MONTH.rstrip() + ", r AS (SELECT m, i FROM o UNION ALL SELECT later, i + 1 FROM o WHERE i % 3 = 0 AND i < last) "
                            "SELECT m AS partition_value, count(*) AS n, CASE WHEN i % 3 = 2 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status, "
                            "CASE WHEN i % 3 = 2 THEN 'missing_column: Estado' END AS error FROM r GROUP BY m, i",
    "sink_schema_growth": "WITH c AS (SELECT *, c_mktsegment IN ('AUTOMOBILE', 'BUILDING') AS early FROM customer) SELECT c_custkey, "
                          "CASE WHEN early THEN CAST(CAST(c_acctbal AS DECIMAL(9,2)) AS DOUBLE) ELSE CAST(CAST(c_acctbal + 0.0001 AS DECIMAL(15,4)) AS DOUBLE) END AS saldo, "
                          "CAST(c_nationkey AS BIGINT) AS pais, CASE WHEN early THEN c_name END AS nombre, CASE WHEN NOT early THEN c_name END AS contacto, "
                          "CASE WHEN early THEN CAST(c_nationkey AS BIGINT) ELSE 3000000000 END AS codigo, c_mktsegment FROM c",
    "stream_drift": _BY_MONTH + "SELECT o_orderkey, CASE WHEN i % 3 = 1 OR i < last THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, "
                    "o_orderstatus, CASE WHEN i % 3 = 0 AND i < last THEN later ELSE m END AS mes_carga FROM o WHERE i % 3 < 2",
    "stream_audit": _BY_MONTH.rstrip() + ", r AS (SELECT m, i FROM o UNION ALL SELECT later, i + 1 FROM o WHERE i % 3 = 0 AND i < last) "
                    "SELECT m AS partition_value, count(*) AS n, CASE WHEN i % 3 = 2 THEN 'FAILED' ELSE 'SUCCEEDED' END AS partition_status, "
                    "CASE WHEN i % 3 = 2 THEN 'missing_column: Estado' END AS partition_error, "
                    "CASE WHEN max(CASE WHEN i % 3 = 2 THEN 1 ELSE 0 END) OVER () = 1 THEN 'WARNING' ELSE 'SUCCEEDED' END AS batch_status FROM r GROUP BY m, i",
    "create_partitioned": "WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS m, min(strftime(o_orderdate, '%Y-%m')) OVER () AS f, "
                          "max(strftime(o_orderdate, '%Y-%m')) OVER () AS l FROM orders), "
                          "x AS (SELECT *, o_orderstatus = 'P' OR m = f AS late FROM o) "
                          "SELECT o_orderkey, CASE WHEN late THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, "
                          "CASE WHEN late THEN o_orderstatus END AS o_orderstatus, CASE WHEN m = f THEN l ELSE m END AS mes FROM x",
    "cast_epoch": "SELECT o_orderkey, date_trunc('second', o_orderdate) AS ts, "
                  "date_trunc('second', o_orderdate) + INTERVAL 500 MILLISECOND AS ts_half FROM orders",
    "safe_timestamp_offset": "SELECT o_orderkey, date_trunc('second', o_orderdate) + CASE WHEN o_orderstatus = 'F' "
                             "THEN INTERVAL 5 HOUR ELSE INTERVAL 0 HOUR END AS ts FROM orders",
    "xlsx_na": "SELECT s_suppkey, CASE WHEN s_nationkey >= 5 THEN s_name END AS s_name, "
               "CASE WHEN s_nationkey >= 5 THEN s_acctbal END AS s_acctbal, CAST(NULL AS VARCHAR) AS nada, "
               "'bigint,double,string' AS kinds FROM supplier",
}
