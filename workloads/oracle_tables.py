"""SQL of the dimension, check and table-job queries for DuckDB."""

from __future__ import annotations

from pulsegrid.functions.values import MODEL_PREFIXES, OTHER_MODEL
from workloads import oracle as O
from workloads import oracle_records as OR
from workloads import records as R


def dimension_sql() -> dict[str, str]:
    with_ = O._with
    counts = """SELECT '{check}' AS check_name, '{table}' AS table_name, {ds} AS check_date,
      t AS today_rows, y AS yesterday_rows,
      CASE WHEN y > 0 THEN round(CAST(t AS DOUBLE) / y, 4) END AS day_ratio, {status} AS status
      FROM (SELECT count(*) FILTER (partition_date = {ds}) AS t,
                   count(*) FILTER (partition_date = {ds} - 1) AS y FROM {source})"""
    ratio = ("CASE WHEN y > 0 AND NOT CAST(t AS DOUBLE) / y BETWEEN 0.5 AND 2.0 THEN "
             "'FAIL: day-over-day ratio out of bounds (' || round(CAST(t AS DOUBLE) / y, 2) || 'x)' "
             "ELSE 'PASS' END")
    zero = "CASE WHEN t = 0 THEN 'FAIL: zero rows for business date' ELSE {rest} END"
    nulls = """SELECT 'not_null' AS check_name, '{table}' AS table_name, '{column}' AS column_name,
      count(*) FILTER ({column} IS NULL) AS violations,
      CASE WHEN count(*) FILTER ({column} IS NULL) > 0 THEN 'FAIL' ELSE 'PASS' END AS status
      FROM {source}"""
    verdict = """SELECT '{check}' AS check_name, '{table}' AS table_name, '{column}' AS column_name,
      CAST(n AS BIGINT) AS violations, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status
      FROM ({query})"""
    device = "dwd_product_active_daily"
    prefixes = ", ".join(f"('{p}', '{maker}', '{system}')" for p, (maker, system) in MODEL_PREFIXES.items())
    return {
        "dim_date": """
          WITH last AS (SELECT max(CAST(ts AS DATE)) AS ds FROM events),
          days AS (SELECT CAST(unnest(generate_series(ds - INTERVAL 4 YEAR, ds + INTERVAL 4 YEAR,
            INTERVAL 1 DAY)) AS DATE) AS d FROM last)
          SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
            year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name,
            weekofyear(d) AS week_of_year, dayofyear(d) AS day_of_year, day(d) AS day_of_month,
            dayofweek(d) AS day_of_week, dayname(d) AS day_name,
            dayofweek(d) IN (0, 6) AS is_weekend, dayofweek(d) NOT IN (0, 6) AS is_weekday,
            year(d) AS fiscal_year, quarter(d) AS fiscal_quarter FROM days""",
        "dim_device_model": with_(O._ODS1, f"""
          prefixes(prefix, maker, system) AS (VALUES {prefixes}), models AS (
            SELECT client_os_name AS device_model_name, min(client_os_version) AS os_version_min,
              max(client_os_version) AS os_version_max, min(partition_date) AS first_seen_date,
              max(partition_date) AS last_seen_date
            FROM staging WHERE client_os_name <> '' GROUP BY client_os_name
          ), named AS (
            SELECT m.*, coalesce(arg_max(maker, length(prefix)), '{OTHER_MODEL[0]}') AS manufacturer,
              coalesce(arg_max(system, length(prefix)), '{OTHER_MODEL[1]}') AS platform
            FROM models m LEFT JOIN prefixes ON starts_with(lower(device_model_name), prefix)
            GROUP BY ALL
          )""", select="""
          SELECT *, row_number() OVER (ORDER BY platform, manufacturer, device_model_name)::INTEGER
            AS device_model_key, last_seen_date >= @last - 90 AS is_active
          FROM named"""),
        "dim_product_lifecycle": with_(O._PRODUCTS, select="""
          SELECT *, date_diff('month', launch_date, @last) AS months_since_launch,
            CASE WHEN is_active THEN 'Active' ELSE 'End of Life' END AS lifecycle_status
          FROM products"""),
        "dim_product_active": with_(O._PRODUCTS, select="SELECT * FROM products WHERE is_active"),
        "check_non_zero": with_(O._ODS1, select=counts.format(
            check="non_zero_delivery", table="events", ds=O.DS, source="staging",
            status=zero.format(rest="'PASS'"))),
        "check_day_ratio": with_(O._ODS1, select=counts.format(
            check="day_volume_ratio", table="events", ds=O.DS, source="staging", status=ratio)),
        "check_report_rows": with_(O._ODS1, O._product1(O._LO1), select=counts.format(
            check="report_rows", table=device, ds="DATE '2024-02-01'", source="product1",
            status=zero.format(rest=ratio))),
        "check_non_null": with_(O._ODS1, O._user1(O._LO1), O._product1(O._LO1), select=" UNION ALL ".join(
            [nulls.format(table=device, column=c, source="product1")
             for c in ("product_id", "product_name", "client_variant")]
            + [nulls.format(table="dwd_user_active_daily", column=c,
                            source=f"(SELECT *, partition_date AS business_date FROM user1 "
                                   f"WHERE partition_date = {O.DS})")
               for c in ("business_date", "client_id", "product_id")])),
        "check_schema_tests": with_(O._ODS1, O._PRODUCTS, select=" UNION ALL ".join([
            verdict.format(check="unique", table="staging", column="event_guid", query="""
              SELECT count(*) AS n FROM (SELECT event_guid FROM (
                SELECT event_guid FROM staging UNION ALL
                SELECT event_guid FROM staging WHERE event_id % 7 = 0)
              GROUP BY event_guid HAVING count(*) > 1)"""),
            verdict.format(check="accepted_values", table="events", column="client_name", query="""
              SELECT count(*) AS n FROM staging
              WHERE client_name NOT IN ('nova-ios', 'nova-android', 'nova-ohos')"""),
            verdict.format(check="relationship", table="events", column="product_id", query="""
              SELECT count(*) AS n FROM staging s WHERE product_id IS NOT NULL
                AND NOT EXISTS (SELECT 1 FROM products p WHERE p.product_id = s.product_id)"""),
            nulls.format(table="events", column="event_guid", source="staging"),
            nulls.format(table="events", column="client_variant", source="staging")])),
    }


def table_sql() -> dict[str, str]:
    with_ = O._with
    app = O.oracle_parts()
    curve = app["retention_curve"]
    every_cohort = curve.replace(f"BETWEEN {O._LO3} AND", f"BETWEEN {O._LO1} AND")
    settled = """
    , active AS (
      SELECT event_local_date, client_id, client_variant FROM user2
      WHERE coalesce(client_id, '') <> ''
    ), d0 AS (
      SELECT DISTINCT a.event_local_date AS cohort_date, a.client_id, a.client_variant,
        coalesce(p.product_name, 'Unknown') AS product_name
      FROM active a LEFT JOIN pair2 p
        ON a.client_id = p.client_id AND a.client_variant = p.client_variant
      WHERE a.event_local_date >= (@first - 7) AND a.event_local_date <= @last
    ), counted AS (
      SELECT c.cohort_date, c.product_name, c.client_variant, count(DISTINCT c.client_id) AS d0_users,
        count(DISTINCT c.client_id) FILTER (EXISTS (SELECT 1 FROM active x WHERE
          x.client_id = c.client_id AND x.event_local_date = c.cohort_date + 1)) AS d1,
        count(DISTINCT c.client_id) FILTER (EXISTS (SELECT 1 FROM active x WHERE
          x.client_id = c.client_id AND x.event_local_date = c.cohort_date + 2)) AS d2,
        count(DISTINCT c.client_id) FILTER (EXISTS (SELECT 1 FROM active x WHERE
          x.client_id = c.client_id AND x.event_local_date = c.cohort_date + 3)) AS d3,
        count(DISTINCT c.client_id) FILTER (EXISTS (SELECT 1 FROM active x WHERE
          x.client_id = c.client_id AND x.event_local_date = c.cohort_date + 7)) AS d7
      FROM d0 c GROUP BY ALL
    ), due AS (
      SELECT cohort_date, product_name, client_variant, d0_users,
        CASE WHEN cohort_date + 1 <= @last THEN d1 END AS d1_users,
        CASE WHEN cohort_date + 2 <= @last THEN d2 END AS d2_users,
        CASE WHEN cohort_date + 3 <= @last THEN d3 END AS d3_users,
        CASE WHEN cohort_date + 7 <= @last THEN d7 END AS d7_users
      FROM counted
    )
    SELECT *, round(CAST(d1_users AS DOUBLE) / d0_users, 4) AS d1_retention_rate,
      round(CAST(d7_users AS DOUBLE) / d0_users, 4) AS d7_retention_rate,
      @last AS partition_date
    FROM due"""
    window16 = O._EVENTS2.replace("FROM flat\n)", """FROM flat WHERE partition_date >= @first
  UNION ALL
  SELECT 'v4-' || event_id, ts, CAST(ts + INTERVAL 7 HOUR AS DATE), CAST(uid AS VARCHAR), 'nova-ios',
    'prod', '2.9.0', 'b1', 'iOS', NULL, NULL, CAST(ts AS DATE), NULL, NULL,
    coalesce(CASE WHEN k % 3 = 0 THEN NULL ELSE k % 3 = 1 END, FALSE)
  FROM base WHERE value > 100 AND event_id % 5 <> 0 AND CAST(ts AS DATE) >= @first
)""")
    ingest = OR._decoded() + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, event_name, decode_success, count(*) AS n_rows FROM decoded "
        f"WHERE {where} GROUP BY event_name, decode_success"
        for name, where in (
            ("events", "TRUE"), ("invalid", "NOT decode_success"),
            *[(k, f"decode_success AND event_name = '{k}'")
              for k in ("reboot_info", "shutdown_reason", "ota_status", "bt_connection")]))
    app_judged = OR._judged(
        R.APP_TEXT, f"{OR._envelope('nova-telemetry-record')} + {OR._client()} + {OR._payload()}")
    device_judged = OR._judged(
        R.DEVICE_TEXT, f"{OR._envelope('sentinel-telemetry-record')} + {OR._client()} + {OR._device()}")
    outcomes = app_judged + f"""
      SELECT {OR.text('nova_ctx.event_name')} AS outcome, count(*) AS n_rows
      FROM judged WHERE error_code IS NULL GROUP BY 1
      UNION ALL SELECT error_code, count(*) FROM judged WHERE error_code IS NOT NULL GROUP BY 1"""
    return {
        "app_v1_tables": every_cohort,
        "retention_day_by_day": every_cohort,
        "daily_active_table_v1": app["daily_active_users_v1"],
        "daily_active_table_v2": app["daily_active_users_v2"],
        "device_stream_retry": ingest,
        "widened_table": r"""
          WITH days AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events),
          numbered AS (
            SELECT CAST(ts AS DATE) AS day, event_type AS kind, user_id,
              CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS k,
              CAST(ts AS DATE) > lo + CAST((hi - lo) // 2 AS INTEGER) AS later
            FROM events, days),
          whole AS (SELECT *, CASE WHEN later THEN k * 10000000000 ELSE k END AS number FROM numbered)
          SELECT day, kind, CAST(sum(number % 1000003) AS BIGINT) AS checksum, max(number) AS largest,
            count(user_id) FILTER (later) AS n_users, count(*) AS n_rows
          FROM whole GROUP BY day, kind""",
        "audited_write": with_(O._EVENTS2, O._product2(O._LO1), select="""
          SELECT partition_date, count(*) AS n_rows, min(active_user_count) AS least_users,
            (SELECT count(*) FROM product2) AS refused_rows,
            (SELECT count(*) FROM product2 WHERE client_variant = 'prod') AS no_user,
            (SELECT count(*) FROM product2 WHERE partition_date < @last - 2) AS outside
          FROM product2 GROUP BY partition_date"""),
        "active_clients_sketched": with_(O._EVENTS2, O._user2(O._LO1), select="""
          SELECT d.report_date, u.client_platform, count(DISTINCT u.client_id) AS clients, TRUE AS within_bound
          FROM (SELECT DISTINCT partition_date AS report_date FROM user2) d
          JOIN user2 u ON u.partition_date BETWEEN d.report_date - 6 AND d.report_date GROUP BY ALL"""),
        "crash_table_by_uptime": app["crash_counts_daily"],
        "crash_table_by_event_time": app["crash_counts_daily"].replace(O._BY_UPTIME, O._BY_TIME),
        "app_v1_rejected": with_(O._ODS1, select="""
          SELECT partition_date, concat_ws(',', CASE WHEN event_guid IS NULL THEN 'event_guid' END,
            CASE WHEN client_name IS NULL THEN 'client_name' END,
            CASE WHEN client_id IS NULL THEN 'client_id' END) AS missing, count(*) AS n_rows
          FROM staging GROUP BY ALL"""),
        "merge_touched_files": with_(O._DEVICE, select="""
          SELECT event_local_date, odd, count(*) AS n_rows,
            count(*) FILTER (odd AND event_local_date >= final - 2) AS marked,
            count(*) FILTER (NOT odd OR event_local_date < final - 2) AS in_old_files
          FROM (SELECT *, CAST(substr(device_component_guid, 3) AS BIGINT) % 2 = 1 AS odd,
                  (SELECT max(event_local_date) FROM device_all) AS final FROM device_all)
          WHERE event_name = 'reboot_info' AND decode_success GROUP BY event_local_date, odd"""),
        "window_replace": with_(O._EVENTS2, O._user2("@first"), select="""
          SELECT * FROM user2 WHERE partition_date < (@last - 3)
            OR (partition_date = (@last - 1) AND client_platform = 'iOS')"""),
        "merge_session_counts": with_(O._DEVICE, select="""
          SELECT d.event_timestamp_ms, d.event_local_date, d.client_variant, d.device_component_guid,
            d.device_session_id, d.device_mono_time,
            CASE WHEN d.event_local_date BETWEEN (@last - 10) AND @last
              THEN CAST(c.n AS INTEGER) END AS single_session_reboot_cnt
          FROM device_all d LEFT JOIN (
            SELECT client_variant, device_component_guid, device_session_id, count(*) AS n
            FROM device_all WHERE event_name = 'reboot_info' AND decode_success
              AND event_local_date BETWEEN (@last - 10) AND @last GROUP BY ALL) c
          ON d.client_variant = c.client_variant AND d.device_component_guid = c.device_component_guid
            AND d.device_session_id = c.device_session_id
          WHERE d.event_name = 'reboot_info' AND d.decode_success"""),
        "rolling_pairing_state": app["user_product_rolling"],
        "backfill_v2": with_(window16, O._PRODUCTS, O._user2("@first"),
                             O._pair2("pair2", "@first", O.DS), select="")[:-1] + settled,
        "device_ingest": ingest,
        "report_files": with_(O._DEVICE, O._marked(O._BY_TIME), select="""
          SELECT event_local_date, product_sku, client_firmware_version,
            CAST(sum(coalesce(crash_cnt_total, 0)) AS BIGINT) AS crash_cnt,
            CAST(sum(session_cnt) AS BIGINT) AS session_cnt,
            CASE WHEN sum(session_cnt) > 0 THEN
              round(CAST(sum(coalesce(crash_cnt_total, 0)) AS DOUBLE) / sum(session_cnt), 4) END
              AS crash_rate, strftime(@last - 1, '%Y%m%d') AS report_date
          FROM crashes WHERE event_local_date = (@last - 1)
          GROUP BY event_local_date, product_sku, client_firmware_version"""),
        "export_user_active": f"""SELECT *, partition_date AS business_date FROM ({curve})
          WHERE partition_date = {O.DS} ORDER BY cohort_date, client_name, product_id""",
        "export_product_active": with_(O._ODS1, O._product1(O._LO1), select=f"""
          SELECT *, partition_date AS business_date FROM product1 WHERE partition_date = {O.DS}
          ORDER BY product_guid"""),
        "stream_records": outcomes,
        "stream_two_checkpoints": outcomes,
        "retention_rerun_moved_cohort": every_cohort,
        "stream_first_copy": "SELECT event_id, ts, event_type FROM events",
        "quarantine_files": device_judged + """
          SELECT event_id, error_code, 'device' AS stream_type,
            (SELECT m.value FROM made m WHERE m.event_id = judged.event_id) AS raw
          FROM judged WHERE error_code IS NOT NULL""",
    }
