"""DuckDB twins of the registered queries (the correctness oracle).

Each entry is plain SQL over the driver's tables (views ``events``, ``part``,
``pages`` …).  The test-table mapping is restated here independently of the
Spark code; shared pieces are CTE fragments.
"""

from __future__ import annotations

TIME_FROM, TIME_TO = "TIMESTAMP '2024-01-15 09:00:00'", "TIMESTAMP '2024-01-15 21:00:00'"

_BASE = """
ev AS (
  SELECT event_id, ts, user_id, value,
         strftime(ts, '%Y%m%d') AS data_ref,
         strftime(time_bucket(INTERVAL '5 minutes', ts), '%H:%M') AS hora_ref,
         user_id % 5 AS id_linha,
         CAST(floor(value) AS BIGINT) AS veiculos
  FROM events),
silver_raw AS (
  SELECT data_ref, hora_ref, event_id AS cod_onibus,
         CAST(1 + id_linha % 2 AS BIGINT) AS sentido_linha,
         CAST(id_linha AS VARCHAR) || '-10' AS let_cod_linha,
         'DEST ' || CAST(id_linha AS VARCHAR) AS let_destino,
         'ORIG ' || CAST(id_linha AS VARCHAR) AS let_origem,
         date_trunc('second', ts) AS timestamp_pos,
         CAST(-23.5 AS DOUBLE) - CAST(event_id % 1000 AS DOUBLE) / 1000.0 AS latitude_pos,
         CAST(-46.5 AS DOUBLE) - CAST(event_id % 997 AS DOUBLE) / 1000.0 AS longitude_pos,
         CAST(id_linha AS BIGINT) AS id_linha, veiculos
  FROM ev),
silver AS (
  SELECT data_ref, hora_ref, cod_onibus, sentido_linha, let_cod_linha, let_destino, let_origem,
         timestamp_pos, latitude_pos, longitude_pos, id_linha,
         max(veiculos) OVER (PARTITION BY data_ref, hora_ref, id_linha) AS qtde_onibus
  FROM silver_raw),
a1 AS (
  SELECT data_ref, hora_ref, substr(hora_ref, 1, 2) AS hora_id_ref, id_linha, sentido_linha,
         let_cod_linha, let_destino, let_origem, max(veiculos) AS qtde_onibus
  FROM silver_raw GROUP BY ALL),
a2 AS (
  SELECT data_ref, hora_ref, id_linha, sentido_linha, let_cod_linha, let_destino, let_origem, qtde_onibus
  FROM a1),
a3 AS (
  SELECT data_ref, hora_id_ref, id_linha, sentido_linha, let_cod_linha, let_destino, let_origem,
         CAST(ceil(avg(qtde_onibus)) AS BIGINT) AS qtde_onibus
  FROM a1 GROUP BY ALL),
a4x AS (
  SELECT data_ref, hora_id_ref, hora_ref, CAST(sum(qtde_onibus) AS BIGINT) AS qtde_onibus
  FROM a1 GROUP BY ALL),
a4 AS (SELECT data_ref, hora_ref, qtde_onibus FROM a4x),
a5 AS (
  SELECT data_ref, hora_id_ref, CAST(ceil(avg(qtde_onibus)) AS BIGINT) AS qtde_onibus
  FROM a4x GROUP BY ALL),
meta_keys AS (
  SELECT lpad(CAST(p_partkey % 24 AS VARCHAR), 2, '0') AS hora_id_ref,
         CAST(floor(p_partkey / 24) % 7 AS BIGINT) AS id_linha, p_size
  FROM part),
meta AS (
  SELECT hora_id_ref, id_linha, CAST(1 + id_linha % 2 AS BIGINT) AS sentido_linha,
         CAST(id_linha AS VARCHAR) || '-10' AS let_cod_linha,
         'DEST ' || CAST(id_linha AS VARCHAR) AS let_destino,
         'ORIG ' || CAST(id_linha AS VARCHAR) AS let_origem,
         CAST(max(p_size) AS BIGINT) AS meta_qtde_onibus
  FROM meta_keys GROUP BY hora_id_ref, id_linha),
hours AS (SELECT DISTINCT data_ref, hora_id_ref FROM a3),
checked AS (
  SELECT h.data_ref, h.hora_id_ref, m.id_linha, m.sentido_linha, m.let_cod_linha, m.let_destino,
         m.let_origem, m.meta_qtde_onibus, COALESCE(a.qtde_onibus, 0) AS avg_qtde_onibus
  FROM hours h JOIN meta m ON m.hora_id_ref = h.hora_id_ref
  LEFT JOIN a3 a ON a.data_ref = h.data_ref AND a.hora_id_ref = h.hora_id_ref AND a.id_linha = m.id_linha),
reached AS (SELECT * FROM checked WHERE avg_qtde_onibus >= meta_qtde_onibus),
below AS (SELECT * FROM checked WHERE avg_qtde_onibus < meta_qtde_onibus),
reached_total AS (SELECT data_ref, hora_id_ref, count(sentido_linha) AS qtde_linhas FROM reached GROUP BY ALL),
below_total AS (SELECT data_ref, hora_id_ref, count(sentido_linha) AS qtde_linhas FROM below GROUP BY ALL)
"""


def _q(body: str) -> str:
    return "WITH " + _BASE.strip() + "\n" + body.strip()


SILVER_COLS = ("data_ref, hora_ref, cod_onibus, sentido_linha, let_cod_linha, let_destino, let_origem, "
               "timestamp_pos, latitude_pos, longitude_pos, id_linha, qtde_onibus")

_TS_MIN = "strptime(data_ref || ' ' || hora_ref, '%Y%m%d %H:%M')"
_TS_HOUR = "strptime(data_ref || ' ' || hora_id_ref, '%Y%m%d %H')"
_TS_HOUR00 = "strptime(data_ref || ' ' || hora_id_ref || ':00', '%Y%m%d %H:%M')"


def _range(ts: str, shift: int) -> str:
    shifted = f"{ts} + INTERVAL {shift} HOUR" if shift else ts
    return f"{shifted} BETWEEN {TIME_FROM} AND {TIME_TO}"


def _shift(ts: str, shift: int) -> str:
    return f"{ts} + INTERVAL {shift} HOUR" if shift else ts


# (table CTE, column list with the measure + 1)
_UPSERT = {
    "total_onibus_por_linha": ("a2", "data_ref, hora_ref, id_linha, sentido_linha, let_cod_linha, let_destino, "
                                     "let_origem, qtde_onibus + 1 AS qtde_onibus"),
    "total_onibus_geral": ("a4", "data_ref, hora_ref, qtde_onibus + 1 AS qtde_onibus"),
    "media_onibus_por_linha": ("a3", "data_ref, hora_id_ref, id_linha, sentido_linha, let_cod_linha, let_destino, "
                                     "let_origem, qtde_onibus + 1 AS qtde_onibus"),
    "media_onibus_geral": ("a5", "data_ref, hora_id_ref, qtde_onibus + 1 AS qtde_onibus"),
    "linhas_atingida_meta": ("reached", "data_ref, hora_id_ref, id_linha, sentido_linha, let_cod_linha, "
                                        "let_destino, let_origem, meta_qtde_onibus, "
                                        "avg_qtde_onibus + 1 AS avg_qtde_onibus"),
    "total_linhas_atingida_meta": ("reached_total", "data_ref, hora_id_ref, qtde_linhas + 1 AS qtde_linhas"),
    "linhas_abaixo_meta": ("below", "data_ref, hora_id_ref, id_linha, sentido_linha, let_cod_linha, "
                                    "let_destino, let_origem, meta_qtde_onibus, "
                                    "avg_qtde_onibus + 1 AS avg_qtde_onibus"),
    "total_linhas_abaixo_meta": ("below_total", "data_ref, hora_id_ref, qtde_linhas + 1 AS qtde_linhas"),
}


def _upsert_sql(table: str) -> str:
    src, staged = _UPSERT[table]
    return _q(f"SELECT * FROM {src} WHERE data_ref < '20240115' "
              f"UNION ALL SELECT {staged} FROM {src} WHERE data_ref >= '20240115'")


def oracle_sql() -> dict[str, str]:
    sql = {
        "flatten_positions": _q(f"SELECT {SILVER_COLS} FROM silver"),
        "explode_lines": _q("SELECT data_ref, hora_ref AS hr, let_cod_linha AS c, id_linha AS cl, qtde_onibus AS qv "
                            "FROM silver GROUP BY data_ref, hora_ref, cod_onibus // 512, id_linha, let_cod_linha, "
                            "qtde_onibus"),
        "explode_vehicles": _q("SELECT data_ref, hora_ref AS hr, id_linha AS cl, cod_onibus AS p FROM silver_raw"),
        "hour_partition": _q(f"SELECT {SILVER_COLS} FROM silver WHERE data_ref = '20240115' "
                             "AND substr(hora_ref, 1, 2) BETWEEN '06' AND '17'"),
        "snapshot_total_per_line": _q("SELECT * FROM a2"),
        "hourly_mean_per_line": _q("SELECT * FROM a3"),
        "snapshot_total_network": _q("SELECT * FROM a4"),
        "hourly_mean_network": _q("SELECT * FROM a5"),
        "target_one_hour": _q("""
            SELECT '20240115' AS data_ref, m.hora_id_ref, m.id_linha, m.sentido_linha, m.let_cod_linha,
                   m.let_destino, m.let_origem, m.meta_qtde_onibus, COALESCE(a.qtde_onibus, 0) AS avg_qtde_onibus
            FROM meta m
            LEFT JOIN (SELECT * FROM a3 WHERE data_ref = '20240115' AND hora_id_ref = '10') a
              ON a.hora_id_ref = m.hora_id_ref AND a.id_linha = m.id_linha
            WHERE m.hora_id_ref = '10'"""),
        "target_check": _q("SELECT * FROM checked"),
        "lines_reached": _q("SELECT * FROM reached"),
        "lines_below": _q("SELECT * FROM below"),
        "lines_without_bus": _q("SELECT data_ref, hora_id_ref, count(*) AS qtde_linhas FROM checked "
                                "WHERE avg_qtde_onibus = 0 GROUP BY ALL"),
        "lines_reached_total": _q("SELECT * FROM reached_total"),
        "lines_below_total": _q("SELECT * FROM below_total"),
    }
    for table in _UPSERT:
        sql[f"upsert_{table}"] = _upsert_sql(table)
    src, staged = _UPSERT["total_onibus_por_linha"]
    sql.update({
        "silver_roundtrip": _q(f"SELECT {SILVER_COLS} FROM silver"),
        "silver_job_late_documents": _q(f"SELECT {SILVER_COLS} FROM silver"),
        "target_job_roundtrip": _q("SELECT * FROM below"),
        "dedup_latest_per_key": _upsert_sql("total_onibus_por_linha"),
        "panel_line_table_total": _q(f"""
            SELECT CAST(sum(qtde_onibus) AS BIGINT) AS total_onibus FROM a2 WHERE {_range(_TS_MIN, 3)}"""),
        "gold_roundtrip": _q("SELECT * FROM a2"),
        "hour_overwrite": _q("SELECT * FROM a3"),
        "jdbc_roundtrip": _q("SELECT * FROM a3"),
        "key_violations": _q(f"""
            SELECT data_ref, hora_ref, id_linha, count(*) AS n_rows
            FROM (SELECT * FROM a2 UNION ALL SELECT {staged} FROM a2 WHERE data_ref >= '20240115')
            GROUP BY ALL HAVING count(*) > 1"""),
        "null_key_violations": _q("""
            SELECT data_ref, hora_ref, CAST(NULL AS BIGINT) AS id_linha, sentido_linha, let_cod_linha, let_destino,
                   let_origem, qtde_onibus, 'id_linha' AS null_keys
            FROM a2 WHERE substr(hora_ref, 5, 1) = '5'"""),
        "payload_ok": "SELECT page_id AS payload_id, url AS name, CAST(octet_length(encode(html)) AS BIGINT) AS payload_len "
                      "FROM pages WHERE octet_length(encode(html)) > 3000",
        "payload_nok": "SELECT page_id AS payload_id, url AS name, CAST(octet_length(encode(html)) AS BIGINT) AS payload_len "
                       "FROM pages WHERE octet_length(encode(html)) <= 3000 OR html IS NULL",
        "panel_below_total": _q(f"""
            SELECT max({_TS_HOUR}) AS data_hora, arg_max(qtde_linhas, {_TS_HOUR}) AS quantidade
            FROM below_total WHERE qtde_linhas IS NOT NULL"""),
        "panel_below_top20": _q(f"""
            SELECT {_shift(_TS_HOUR, 3)} AS data_hora, let_cod_linha AS linha, meta_qtde_onibus AS alvo,
                   avg_qtde_onibus AS atingido, meta_qtde_onibus - avg_qtde_onibus AS diferenca
            FROM below ORDER BY data_hora DESC, diferenca DESC, linha, id_linha LIMIT 20"""),
        "panel_network_last": _q(f"""
            SELECT strftime({_TS_MIN}, '%d/%m/%Y %H:%M') AS data_hora, qtde_onibus AS quantidade
            FROM a4 ORDER BY data_ref DESC, hora_ref DESC LIMIT 1"""),
        "panel_network_series": _q(f"""
            SELECT {_shift(_TS_MIN, 3)} AS data_hora, qtde_onibus FROM a4
            WHERE {_range(_TS_MIN, 3)} ORDER BY data_hora DESC"""),
        "panel_line_last25": _q(f"""
            SELECT {_shift(_TS_MIN, 3)} AS time, let_cod_linha AS linha, CAST(sum(qtde_onibus) AS BIGINT) AS total_onibus
            FROM a2 WHERE {_range(_TS_MIN, 3)} GROUP BY ALL ORDER BY time DESC, linha LIMIT 25"""),
        "panel_mean_network_last": _q(f"""
            SELECT strftime({_TS_HOUR}, '%d/%m/%Y %H:%M') AS data_hora, qtde_onibus AS quantidade
            FROM a5 WHERE {_range(_TS_HOUR, 3)} ORDER BY {_TS_HOUR} DESC LIMIT 1"""),
        "panel_line_table": _q(f"""
            SELECT {_shift(_TS_MIN, 3)} AS data, let_cod_linha AS linha, let_origem AS origem,
                   let_destino AS destino, CAST(sum(qtde_onibus) AS BIGINT) AS total_onibus
            FROM a2 WHERE {_range(_TS_MIN, 3)} GROUP BY ALL ORDER BY data DESC"""),
        "panel_line_table_by_origin": _q(f"""
            SELECT {_TS_MIN} AS data, let_cod_linha AS linha, let_origem AS origem,
                   let_destino AS destino, CAST(sum(qtde_onibus) AS BIGINT) AS total_onibus
            FROM a2 WHERE {_range(_TS_MIN, 0)} GROUP BY ALL ORDER BY origem"""),
        "panel_mean_line_last25": _q(f"""
            SELECT {_shift(_TS_HOUR00, 3)} AS time, let_cod_linha AS linha, CAST(sum(qtde_onibus) AS BIGINT) AS total_onibus
            FROM a3 WHERE {_range(_TS_HOUR00, 3)} GROUP BY ALL ORDER BY time DESC, linha LIMIT 25"""),
        "panel_network_series_local": _q(f"""
            SELECT {_TS_MIN} AS data_hora, qtde_onibus FROM a4
            WHERE {_range(_TS_MIN, 0)} ORDER BY data_hora DESC"""),
        "panel_mean_network_series": _q(f"""
            SELECT strftime(CAST(strptime(data_ref, '%Y%m%d') AS TIMESTAMP) + to_hours(CAST(hora_id_ref AS INTEGER)),
                            '%d/%m/%Y %H:%M') AS data_hora, qtde_onibus AS quantidade
            FROM a5 WHERE {_range(_TS_HOUR00, 0)} ORDER BY {_TS_HOUR00} DESC"""),
        "panel_mean_line_first25": _q(f"""
            SELECT {_TS_HOUR00} AS time, let_cod_linha AS linha, CAST(sum(qtde_onibus) AS BIGINT) AS total_onibus
            FROM a3 WHERE {_range(_TS_HOUR00, 0)} GROUP BY ALL ORDER BY time ASC, linha LIMIT 25"""),
        "panel_line_last25_local": _q(f"""
            SELECT {_TS_MIN} AS time, let_cod_linha AS linha, CAST(sum(qtde_onibus) AS BIGINT) AS total_onibus
            FROM a2 WHERE {_range(_TS_MIN, 0)} GROUP BY ALL ORDER BY time DESC, linha LIMIT 25"""),
        "panel_line_totals": _q(f"""
            SELECT let_cod_linha AS linha, let_origem AS origem, let_destino AS destino,
                   CAST(sum(qtde_onibus) AS BIGINT) AS total_onibus
            FROM a2 WHERE {_range(_TS_MIN, 0)} GROUP BY ALL"""),
        "stream_hourly_recompute": _q("SELECT * FROM a3"),
        # closed = a document received at least 1 + 1 hours after the event hour (5-minute landing delay)
        "stream_pipeline": _q(f"""
            SELECT * FROM below
            WHERE {_TS_HOUR} <= date_trunc('hour', (SELECT max({_TS_MIN}) FROM a2) + INTERVAL 5 MINUTE)
                                - INTERVAL 2 HOUR"""),
        "stream_hourly_watermark": _q(f"""
            SELECT * FROM a3
            WHERE {_TS_HOUR} + INTERVAL 1 HOUR
                  <= (SELECT max({_TS_MIN}) FROM a2) - INTERVAL 10 MINUTE"""),
        # everything lands at last, three days late for some, so only the newest reception decides what is closed
        "stream_late_wave": _q(f"""
            SELECT * FROM below
            WHERE {_TS_HOUR} <= date_trunc('hour', (SELECT max({_TS_MIN} + CASE WHEN substr(hora_ref, 4, 2) = '30' THEN INTERVAL 3 DAY
                                                                       ELSE INTERVAL 0 DAY END) FROM a2) + INTERVAL 5 MINUTE)
                                - INTERVAL 2 HOUR"""),
        "ingest_documents": _q(f"""
            SELECT CASE WHEN substr(hora_ref, 4, 2) = '45' THEN 'nok' ELSE 'ok' END AS side, data_ref AS recv_date,
                   substr(hora_ref, 1, 2) AS recv_hour, count(DISTINCT (hora_ref, cod_onibus // 512)) AS documents,
                   count(*) FILTER (WHERE substr(hora_ref, 4, 2) <> '45') AS positions
            FROM silver_raw GROUP BY ALL"""),
        "bad_documents": _q(f"""
            SELECT data_ref AS recv_date, substr(hora_ref, 1, 2) AS recv_hour,
                   count(*) FILTER (WHERE substr(hora_ref, 4, 2) <> '50') AS positions,
                   count(DISTINCT cod_onibus // 512) FILTER (WHERE substr(hora_ref, 4, 2) = '50') AS bad_documents
            FROM silver_raw GROUP BY ALL"""),
        "silver_emptied_hour": _q(f"""
            SELECT {SILVER_COLS} FROM silver WHERE NOT (data_ref = '20240115' AND substr(hora_ref, 1, 2) = '10')"""),
        "commit_killed_job": _q("""
            , early AS (SELECT * FROM silver_raw WHERE timestamp_pos < TIMESTAMP '2024-01-15 12:32:00'),
            b1 AS (SELECT data_ref, hora_ref, substr(hora_ref, 1, 2) AS hora_id_ref, id_linha, max(veiculos) AS q FROM early GROUP BY ALL),
            b4 AS (SELECT data_ref, hora_ref, hora_id_ref, sum(q) AS q FROM b1 GROUP BY ALL),
            b3 AS (SELECT CAST(ceil(avg(q)) AS BIGINT) AS q FROM b1 GROUP BY data_ref, hora_id_ref, id_linha),
            b5 AS (SELECT CAST(ceil(avg(q)) AS BIGINT) AS q FROM b4 GROUP BY data_ref, hora_id_ref)
            SELECT 'total_onibus_por_linha' AS table_name, count(*) AS n_rows, CAST(sum(q) AS BIGINT) AS qtde_onibus FROM b1
            UNION ALL SELECT 'total_onibus_geral', count(*), CAST(sum(q) AS BIGINT) FROM b4
            UNION ALL SELECT 'media_onibus_por_linha', count(*), CAST(sum(q) AS BIGINT) FROM b3
            UNION ALL SELECT 'media_onibus_geral', count(*), CAST(sum(q) AS BIGINT) FROM b5"""),
        "key_violations_by_table": _q("""
            SELECT 'meta_onibus_por_linha' AS table_name, count(*) AS n_keys, 2 * count(*) AS n_rows FROM meta WHERE id_linha = 3
            UNION ALL SELECT 'linhas_atingida_meta', count(*), 2 * count(*) FROM reached WHERE id_linha = 3
            UNION ALL SELECT 'linhas_abaixo_meta', count(*), 2 * count(*) FROM below WHERE id_linha = 3
            UNION ALL SELECT unnest(['total_linhas_atingida_meta', 'total_linhas_abaixo_meta', 'total_onibus_por_linha',
                                     'total_onibus_geral', 'media_onibus_por_linha', 'media_onibus_geral']), 0, 0"""),
        "jdbc_target_job": _q("""
            SELECT h.data_ref, h.hora_id_ref, m.id_linha, m.sentido_linha, m.let_cod_linha, m.let_destino, m.let_origem,
                   m.meta_qtde_onibus, COALESCE(a.qtde_onibus, 0) AS avg_qtde_onibus
            FROM (VALUES ('20240115', '10'), ('20240115', '11'), ('20240116', '10')) h(data_ref, hora_id_ref)
            JOIN meta m ON m.hora_id_ref = h.hora_id_ref
            LEFT JOIN a3 a ON a.data_ref = h.data_ref AND a.hora_id_ref = h.hora_id_ref AND a.id_linha = m.id_linha
            WHERE COALESCE(a.qtde_onibus, 0) < m.meta_qtde_onibus"""),
    })
    return sql
