"""DuckDB SQL text for the correctness oracle (``__spark_entry__.oracle_sql``).

Each helper returns ANSI-ish SQL over the driver's pre-registered views. Float
constants are written in 17-digit ``e`` notation so DuckDB reads doubles, and
every floating-point expression keeps the operation order of the Spark code so
both engines round alike.
"""

from __future__ import annotations

# Literals of its own: nothing is imported from the package under test.
# ---- fixed values: WGS84, UTM and MGRS constants (NGA.STND.0036, NGA.STND.0037)
DEG = 0.017453292519943295
ECC = 0.08181919084262149  # first eccentricity of WGS84
K0A = 6364902.166165086  # 0.9996 times the rectifying radius of WGS84, metres
# Krueger coefficients of WGS84 (Karney 2011), to four terms
ALPHA = (8.377318206245e-04, 7.608527773572e-07, 1.197645503329e-09, 2.429170607201e-12)
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0
LAT_BANDS = "CDEFGHJKLMNPQRSTUVWXX"
COLUMN_LETTERS = ("ABCDEFGH", "JKLMNPQR", "STUVWXYZ")
ROW_LETTERS_ODD = "ABCDEFGHJKLMNPQRSTUV"
ROW_LETTERS_EVEN = "FGHJKLMNPQRSTUVABCDE"
# polar grid: metres from the pole a unit of exp(-isometric latitude), with the scale 0.994
POLAR_RADIUS = 12637318.498257403
POLAR = {  # letter -> (column letters, first easting, row letters, first northing)
    "A": ("JKLPQRSTUXYZ", 800000, "ABCDEFGHJKLMNPQRSTUVWXYZ", 800000),
    "B": ("ABCFGHJKLPQR", 2000000, "ABCDEFGHJKLMNPQRSTUVWXYZ", 800000),
    "Y": ("JKLPQRSTUXYZ", 800000, "ABCDEFGHJKLMNP", 1300000),
    "Z": ("ABCFGHJ", 2000000, "ABCDEFGHJKLMNP", 1300000),
}
# output column -> SQL over the call columns
KPI = {
    "rsrp_dbm": "avg(rsrp_dbm)",
    "rsrq_db": "avg(rsrq_db)",
    "ul_sinr_db": "avg(ul_sinr_db)",
    "qci_mean": "avg(qci_mean)",
    "sum_rlc_pdu_dl_volume_bytes": "sum(rlc_pdu_dl_bytes_count)",
    "sum_rlc_pdu_ul_volume_bytes": "sum(rlc_pdu_ul_bytes_count)",
    "rlc_dl_throughput_kbps": "avg(rlc_dl_throughput)",
    "rlc_ul_throughput_kbps": "avg(rlc_ul_throughput)",
    "sum_dl_mac_volume_bytes": "sum(dl_mac_volume_bytes)",
    "sum_ul_mac_volume_bytes": "sum(ul_mac_volume_bytes)",
    "mac_mean_ul_kbps": "avg(mac_mean_ul_kbps)",
    "mac_mean_dl_kbps": "avg(mac_mean_dl_kbps)",
    "drb_mean_pdcp_dl_kbps": "avg(drb_mean_pdcp_dl_kbps)",
    "drb_mean_pdcp_ul_kbps": "avg(drb_mean_pdcp_ul_kbps)",
    "sum_dl_pdcp_volume_bytes": "sum(dl_pdcp_volume_bytes)",
    "sum_pdcp_volume_ul_bytes": "sum(ul_pdcp_volume_bytes)",
    "sum_rlc_sdu_ul_volume_kbytes": "sum(rlc_sdu_ul_bytes_count)",
    "sum_rlc_pdu_dl_retransmitted_volume_bytes": "sum(rlc_pdu_dl__retransmitted_bytes_count)",
    "pusch_sinr_db": "avg(pusch_sinr_db)",
}
# the characters that Unicode calls white space, and the separators 1C to 1F
WHITE = ("[\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}"
         "\\x{202f}\\x{205f}\\x{3000}]")
# --------------------------------------------------------------------------------


def d(x: float) -> str:
    """A double literal DuckDB parses as DOUBLE, exactly."""
    return "%.17e" % x


CALLS = f"""
SELECT
  event_id,
  ts,
  CAST(user_id AS VARCHAR) AS subscriber_id,
  CAST(7000 + (event_id * 7 + user_id) % 23 AS VARCHAR) AS current_enodeb_id,
  CASE WHEN event_id % 11 = 0 THEN NULL
       ELSE CAST((user_id * 13 + event_id) % 19 AS VARCHAR) END AS serving_nr_cell_id,
  CASE WHEN event_type = 'click' THEN 'Indoor' WHEN event_type = 'error' THEN NULL
       ELSE 'Outdoor' END AS indoor_outdoor_indicator_name,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 101 = 0 THEN 95e0
       ELSE 21e0 + (user_id % 40) * 131e-4 + (event_id % 5) * 7e-4 END AS end_latitude,
  -1582e-1 + (user_id % 30) * 173e-4 + (event_id % 3) * 9e-4 AS end_longitude,
  -80e0 - floor(value * 4e0) / 8e0 AS rsrp_dbm,
  -5e0 - floor(value * 2e0) / 16e0 AS rsrq_db,
  25e0 - floor(value) / 4e0 AS ul_sinr_db,
  (event_id % 9) + 1e0 AS qci_mean,
  ((event_id * 37) % 1000) * 1500e0 AS rlc_pdu_dl_bytes_count,
  ((event_id * 11) % 700) * 300e0 AS rlc_pdu_ul_bytes_count,
  floor(value * 150e0) AS rlc_dl_throughput,
  floor(value * 30e0) AS rlc_ul_throughput,
  ((event_id * 13) % 900) * 1600e0 AS dl_mac_volume_bytes,
  ((event_id * 17) % 500) * 400e0 AS ul_mac_volume_bytes,
  floor(value * 25e0) AS mac_mean_ul_kbps,
  floor(value * 120e0) AS mac_mean_dl_kbps,
  floor(value * 110e0) AS drb_mean_pdcp_dl_kbps,
  floor(value * 22e0) AS drb_mean_pdcp_ul_kbps,
  ((event_id * 19) % 800) * 1400e0 AS dl_pdcp_volume_bytes,
  ((event_id * 23) % 600) * 350e0 AS ul_pdcp_volume_bytes,
  ((event_id * 29) % 400) * 250e0 AS rlc_sdu_ul_bytes_count,
  CASE WHEN event_id % 13 = 0 THEN NULL
       ELSE ((event_id * 31) % 50) * 100e0 END AS rlc_pdu_dl__retransmitted_bytes_count,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE 20e0 - floor(value) / 8e0 END AS pusch_sinr_db,
  strftime(ts, '%Y%m%d') AS UTC_date
FROM events
"""


def mgrs(lat: str, lon_in: str, p: int) -> str:
    """MGRS id SQL for double expressions ``lat`` and ``lon_in``."""
    lon = f"(CASE WHEN {lon_in} = 180e0 THEN -180e0 ELSE {lon_in} END)"
    zone = f"""CAST(CASE
      WHEN {lat} >= 56e0 AND {lat} < 64e0 AND {lon} >= 3e0 AND {lon} < 12e0 THEN 32
      WHEN {lat} >= 72e0 AND {lon} >= 0e0 AND {lon} < 9e0 THEN 31
      WHEN {lat} >= 72e0 AND {lon} >= 9e0 AND {lon} < 21e0 THEN 33
      WHEN {lat} >= 72e0 AND {lon} >= 21e0 AND {lon} < 33e0 THEN 35
      WHEN {lat} >= 72e0 AND {lon} >= 33e0 AND {lon} < 42e0 THEN 37
      ELSE CAST(floor(({lon} + 180e0) / 6e0) AS BIGINT) + 1 END AS BIGINT)"""
    sin_phi = f"sin({lat} * {d(DEG)})"
    lam = f"(({lon} - ({zone} * 6 - 183)) * {d(DEG)})"
    t = f"sinh(atanh({sin_phi}) - atanh({sin_phi} * {d(ECC)}) * {d(ECC)})"
    xi = f"atan2({t}, cos({lam}))"
    eta = f"atanh(sin({lam}) / sqrt({t} * {t} + 1e0))"
    e_sum, n_sum = eta, xi
    for j, a in enumerate(ALPHA, start=1):
        k = d(2.0 * j)
        e_sum = f"({e_sum} + cos({xi} * {k}) * sinh({eta} * {k}) * {d(a)})"
        n_sum = f"({n_sum} + sin({xi} * {k}) * cosh({eta} * {k}) * {d(a)})"
    east = f"({e_sum} * {d(K0A)} + {d(FALSE_EASTING)})"
    north = (f"({n_sum} * {d(K0A)} + CASE WHEN {lat} < 0e0 THEN {d(FALSE_NORTHING_SOUTH)} "
             f"ELSE 0e0 END)")
    band = f"substr('{LAT_BANDS}', CAST(floor(({lat} + 80e0) / 8e0) + 1 AS BIGINT), 1)"
    col_idx = f"CAST(floor({east} / 1e5) AS BIGINT)"
    col_set = (f"CASE WHEN {zone} % 3 = 1 THEN '{COLUMN_LETTERS[0]}' "
               f"WHEN {zone} % 3 = 2 THEN '{COLUMN_LETTERS[1]}' ELSE '{COLUMN_LETTERS[2]}' END")
    row_set = f"CASE WHEN {zone} % 2 = 1 THEN '{ROW_LETTERS_ODD}' ELSE '{ROW_LETTERS_EVEN}' END"
    row_idx = f"CAST(floor({north} / 1e5) AS BIGINT) % 20 + 1"

    def digits(m: str) -> str:
        return (f"lpad(CAST(CAST(floor((CAST(floor({m}) AS BIGINT) % 100000) / {10 ** (5 - p)}) "
                f"AS BIGINT) AS VARCHAR), {p}, '0')")

    parts = [f"lpad(CAST({zone} AS VARCHAR), 2, '0')", band,
             f"substr({col_set}, {col_idx}, 1)", f"substr({row_set}, {row_idx}, 1)"]
    if p:
        parts += [digits(east), digits(north)]
    valid = (f"{lat} BETWEEN -80e0 AND 84e0 AND {lon} BETWEEN -180e0 AND 180e0 "
             f"AND {col_idx} BETWEEN 1 AND 8")
    return f"(CASE WHEN {valid} THEN ({' || '.join(parts)}) END)"


#: Points of the polar areas, one for each event.
POLAR_POINTS = """
SELECT event_id,
  CASE event_id % 4 WHEN 0 THEN 84e0 + ((event_id * 37) % 6001) / 1000e0
                    WHEN 1 THEN -80e0 - ((event_id * 41) % 10001) / 1000e0
                    WHEN 2 THEN 90e0 - ((event_id * 43) % 977) / 1e5
                    ELSE -90e0 + ((event_id * 47) % 89) * 25e-2 END AS lat,
  CASE WHEN event_id % 5 = 0 THEN ((event_id // 5) % 9) * 45e0 - 180e0
       ELSE ((event_id * 7919) % 360001) / 1000e0 - 180e0 END AS lon
FROM events"""


def polar_grid_ids(precisions: dict[str, int]) -> str:
    """Ids of POLAR_POINTS; points short of the polar areas take the other grid."""
    t = (f"tan((90e0 - abs(lat)) * {d(DEG / 2)}) "
         f"* exp(atanh(sin(abs(lat) * {d(DEG)}) * {d(ECC)}) * {d(ECC)})")
    lines = " ".join(
        f"""WHEN '{k}' THEN '{k}' || substr('{cols}', CAST(floor((e - {fe}) / 1e5) AS BIGINT) + 1, 1)
            || substr('{rows}', CAST(floor((n - {fn}) / 1e5) AS BIGINT) + 1, 1)"""
        for k, (cols, fe, rows, fn) in POLAR.items())
    ids = ", ".join(
        f"CASE WHEN polar THEN sq || " + " || ".join(
            f"lpad(CAST((CAST(floor({x}) AS BIGINT) % 100000) // {10 ** (5 - p)} AS VARCHAR), {p}, '0')"
            for x in ("e", "n")) + f" ELSE {mgrs('lat', 'lon', p)} END AS {name}"
        for name, p in precisions.items())
    return f"""
WITH points AS ({POLAR_POINTS}),
r AS (SELECT *, (lat > 84e0 OR lat < -80e0) AS polar, {t} * {d(POLAR_RADIUS)} AS radius FROM points),
en AS (SELECT *,
         2e6 + radius * CASE WHEN lon IN (0e0, 180e0, -180e0) THEN 0e0 ELSE sin(lon * {d(DEG)}) END AS e,
         2e6 - radius * sign(lat) * CASE WHEN abs(lon) = 90e0 THEN 0e0 ELSE cos(lon * {d(DEG)}) END
           AS n FROM r),
q AS (SELECT *, CASE WHEN lat > 0 THEN CASE WHEN e >= 2e6 THEN 'Z' ELSE 'Y' END
                     ELSE CASE WHEN e >= 2e6 THEN 'B' ELSE 'A' END END AS zone FROM en),
s AS (SELECT *, CASE WHEN polar THEN CASE zone {lines} END END AS sq FROM q)
SELECT event_id, lat, lon, {ids} FROM s"""


def grid_cte(p: int, id_col: str, where: str = "") -> str:
    """CTE body: (id, gridid) per call row at precision ``p``."""
    return (f"SELECT {id_col} AS id, {mgrs('end_latitude', 'end_longitude', p)} AS gridid "
            f"FROM calls {where}")


def topn_others(pairs_cte: str, group: str, id_name: str, n: int = 10,
                extra_select: str = "") -> str:
    """Top-n + others over a CTE ``pairs(<group>, id, cnt)``, plain window form."""
    return f"""
WITH pairs AS ({pairs_cte}),
ranked AS (
  SELECT {group}, id, CAST(cnt AS BIGINT) AS cnt,
         row_number() OVER (PARTITION BY {group} ORDER BY cnt DESC, id ASC NULLS LAST) AS rnk,
         CAST(sum(cnt) OVER (PARTITION BY {group}) AS BIGINT) AS total
  FROM pairs),
h AS (SELECT *, (cnt * 20000 + total) // (2 * total) AS hund FROM ranked)
SELECT {extra_select} cnt, id AS {id_name}, {group}, hund / 100e0 AS pct,
       CAST(rnk AS INTEGER) AS rank, false AS is_other
FROM h WHERE rnk <= {n}
UNION ALL
SELECT {extra_select} CAST(sum(cnt) AS BIGINT) AS cnt, 'others' AS {id_name}, {group},
       sum(hund) / 100e0 AS pct, CAST(NULL AS INTEGER) AS rank, true AS is_other
FROM h WHERE rnk > {n} GROUP BY {group}
"""


def coverage(id_col: str, id_name: str, p: int, date_td: str) -> str:
    pairs = (f"SELECT gridid, id, count(*) AS cnt FROM ({grid_cte(p, id_col)}) "
             f"GROUP BY gridid, id")
    body = topn_others(pairs, "gridid", id_name, extra_select=f"'{date_td}' AS date_td,")
    return f"WITH calls AS ({CALLS}) SELECT * FROM ({body}) q"


def coverage_all(id_col: str, id_name: str, date_td: str) -> str:
    parts = [f"SELECT *, {r} AS resolution_m FROM ({coverage(id_col, id_name, p, date_td)})"
             for r, p in ((100, 3), (1000, 2), (10000, 1))]
    return " UNION ALL ".join(parts)


def grid_kpi(week: tuple[str, str], p: int = 3) -> str:
    aggs = [f"{e if e.startswith('avg') else f'CAST({e} AS DOUBLE)'} AS {out}"
            for out, e in KPI.items()]
    g = mgrs("end_latitude", "end_longitude", p)
    return f"""
WITH calls AS ({CALLS}),
t AS (SELECT *, CASE WHEN indoor_outdoor_indicator_name = 'Indoor' THEN 'Indoor'
                     ELSE 'Outdoor' END AS env_tag,
             {g} AS gridid
      FROM calls WHERE end_latitude IS NOT NULL AND end_longitude IS NOT NULL
        AND UTC_date BETWEEN '{week[0]}' AND '{week[1]}')
SELECT gridid, env_tag, {', '.join(aggs)},
       count(DISTINCT subscriber_id) AS unique_imsi_cnt, count(*) AS records_cnt,
       '{week[0]}' AS start_week, '{week[1]}' AS end_week
FROM t GROUP BY gridid, env_tag
"""


def _tokens(text: str) -> str:
    ws = WHITE
    stripped = f"regexp_replace({text}, '^{ws}+|{ws}+$', '', 'g')"
    return (f"(CASE WHEN {stripped} = '' THEN CAST([] AS VARCHAR[]) "
            f"ELSE string_split_regex({stripped}, '{ws}+') END)")


def other_queries(as_of: str, scan_days: list[str], kpi_week: tuple[str, str],
                  date_td: str) -> dict[str, str]:
    o: dict[str, str] = {}
    nation_pairs = """
SELECT n_name, CAST(c_custkey AS VARCHAR) AS id, count(*) AS cnt
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name, c_custkey"""
    o["nation_top_customers"] = topn_others(nation_pairs, "n_name", "customer")
    o["grid_kpi"] = grid_kpi(kpi_week)
    every = ("20231201", "20240229")
    o["kpi_from_day_states"] = grid_kpi(every)
    o["kpi_coarse_from_day_states"] = grid_kpi(kpi_week, 2)
    slid = grid_cte(2, "current_enodeb_id", "WHERE UTC_date IN (SELECT DISTINCT UTC_date FROM calls "
                    "ORDER BY UTC_date DESC LIMIT 10)")
    slid = topn_others(f"SELECT gridid, id, count(*) AS cnt FROM ({slid}) GROUP BY gridid, id", "gridid",
                       "enb", extra_select=f"'{date_td}' AS date_td,")
    o["enb_cover_slid"] = f"WITH calls AS ({CALLS}) SELECT * FROM ({slid}) q"
    o["subscriber_sketches"] = (f"SELECT gridid, env_tag, unique_imsi_cnt, true AS sketch_is_close "
                                f"FROM ({grid_kpi(every, 1)})")
    o["grid_of_points"] = (
        f"WITH calls AS ({CALLS}) SELECT event_id, end_latitude, end_longitude, "
        + ", ".join(f"{mgrs('end_latitude', 'end_longitude', p)} AS g{p}" for p in (5, 3, 2, 1))
        + " FROM calls")
    o["grid_coarsen"] = (
        f"WITH calls AS ({CALLS}) SELECT event_id, "
        + ", ".join(f"{mgrs('end_latitude', 'end_longitude', p)} AS g{p}" for p in (3, 2, 1))
        + " FROM calls")
    o["polar_grid_ids"] = polar_grid_ids({"g5": 5, "g3": 3, "g2": 2, "g1": 1})
    o["cast_all_except"] = """
SELECT CAST(event_id AS DOUBLE) AS event_id, ts, CAST(user_id AS DOUBLE) AS user_id, event_type,
       value, TRY_CAST(props AS DOUBLE) AS props,
       TRY_CAST(regexp_extract(props, '[0-9]+', 0) AS DOUBLE) AS k_text
FROM events"""
    o["env_tag_counts"] = f"""
WITH calls AS ({CALLS})
SELECT CASE WHEN indoor_outdoor_indicator_name = 'Indoor' THEN 'Indoor' ELSE 'Outdoor' END
         AS env_tag,
       indoor_outdoor_indicator_name, count(*) AS n
FROM calls WHERE end_latitude IS NOT NULL AND end_longitude IS NOT NULL
GROUP BY ALL"""
    o["date_range_scan"] = f"""
SELECT event_id, ts, user_id, event_type, value, props, strftime(ts, '%Y%m%d') AS UTC_date
FROM events WHERE strftime(ts, '%Y%m%d') IN ({', '.join(f"'{d}'" for d in scan_days)})"""
    a = f"DATE '{as_of}'"
    wd = f"(isodow({a}) - 1)"
    wins = []
    for name, off in (("kpi", 7), ("enb", 2), ("gnb", 1)):
        start = f"({a} - CAST({wd} + {off} AS INTEGER))"
        wins.append(f"""SELECT '{name}' AS window_name, CAST(d AS DATE) AS day
  FROM generate_series({start}, least({start} + 6, {a}), INTERVAL 1 DAY) t(d)""")
    wins.append(f"""SELECT 'trailing_9' AS window_name, CAST(d AS DATE) AS day
  FROM generate_series({a} - 8, {a}, INTERVAL 1 DAY) t(d)""")
    o["weekly_window_counts"] = f"""
WITH w AS ({' UNION ALL '.join(wins)}),
daily AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)
SELECT window_name, strftime(w.day, '%Y%m%d') AS day, coalesce(daily.n, 0) AS n_events
FROM w LEFT JOIN daily ON w.day = daily.day"""
    lead = """
WITH x AS (
  SELECT user_id, ts, event_id,
         lead(ts, 1) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ts_2,
         lead(ts, 2) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ts_3
  FROM events)"""
    o["access_burst"] = lead + """
SELECT user_id, ts, event_id FROM x WHERE ts_3 < ts + INTERVAL 1 HOUR"""
    o["burst_witnesses"] = lead + """
SELECT user_id, event_id, ts AS ts_1, ts_2, ts_3 FROM x WHERE ts_3 < ts + INTERVAL 1 HOUR"""
    o["clock_text"] = """
SELECT event_id, strftime(ts, '%H%M') AS hhmm,
       CAST(strftime(ts, '%H') AS INTEGER) * 60 + CAST(strftime(ts, '%M') AS INTEGER)
         AS minute_of_day,
       CAST(strftime(ts, '%H') AS INTEGER)
         + round(CAST(strftime(ts, '%M') AS INTEGER) / 60e0, 2) AS decimal_hours,
       date_trunc('minute', ts) AS ts_minute
FROM events"""
    o["clock_bad_text"] = """
WITH x AS (SELECT event_id, ts, CASE event_id % 7 WHEN 0 THEN '2460' WHEN 1 THEN '549'
             WHEN 2 THEN '-1-5' WHEN 3 THEN '2400' WHEN 4 THEN ' 930'
             ELSE strftime(ts, '%H%M') END AS hhmm, event_id % 7 >= 5 AS good FROM events)
SELECT event_id, hhmm,
       CASE WHEN good THEN CAST(hour(ts) * 60 + minute(ts) AS INTEGER) END AS minute_of_day,
       CASE WHEN good THEN hour(ts) + round(minute(ts) / 60e0, 2) END AS decimal_hours,
       CASE WHEN good THEN date_trunc('minute', ts) END AS ts_minute
FROM x"""
    good = "event_id % 9 > 5"
    o["grid_bad_points"] = (
        f"WITH calls AS ({CALLS}) SELECT event_id, " + ", ".join(
            f"CASE WHEN {good} THEN {mgrs('end_latitude', 'end_longitude', p)} END AS {name}"
            for name, p in (("gridid", 3), ("coarse", 1))) + " FROM calls")
    o["burst_big_keys"] = """
WITH k AS (SELECT CASE WHEN user_id % 10 = 0 THEN NULL
                       ELSE 9007199254740992 + user_id END AS big_id, ts, event_id FROM events),
x AS (SELECT *, lead(ts, 2) OVER (PARTITION BY big_id ORDER BY ts, event_id) AS ts_3 FROM k)
SELECT big_id, ts, event_id FROM x WHERE ts_3 < ts + INTERVAL 1 HOUR"""
    o["missing_day_report"] = f"""
WITH days AS (SELECT unnest([{', '.join(f"'{x}'" for x in scan_days)}]) AS day),
have AS (SELECT DISTINCT strftime(ts, '%Y%m%d') AS day FROM events)
SELECT day, day IN (SELECT day FROM have) AS present,
       (SELECT max(h.day) FROM have h JOIN days d2 ON h.day = d2.day WHERE h.day <= days.day)
         AS latest_day
FROM days"""
    o["id_reconcile"] = """
WITH c AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS id FROM customer),
     r AS (SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS id FROM orders)
SELECT id, 'left_only' AS side FROM (SELECT id FROM c EXCEPT ALL SELECT id FROM r)
UNION ALL
SELECT id, 'right_only' AS side FROM (SELECT id FROM r EXCEPT ALL SELECT id FROM c)"""
    early = """
early AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events
          WHERE user_id % 3 <> 0 OR ts < TIMESTAMP '2024-01-10')"""
    o["stale_sources"] = f"""
WITH {early},
x AS (SELECT user_id, CASE WHEN day BETWEEN DATE '2024-01-15' AND DATE '2024-01-30' THEN day END
        AS day FROM early)
SELECT user_id, DATE '2024-01-30' AS expected_day,
       coalesce(bool_or(day = DATE '2024-01-30'), false) AS expected_present,
       max(day) AS latest_day, CAST(DATE '2024-01-30' - max(day) AS INTEGER) AS lag_days
FROM x GROUP BY user_id"""
    o["gaps_in_window"] = f"""
WITH {early},
cal AS (SELECT user_id, CAST(x AS DATE) AS day FROM (SELECT DISTINCT user_id FROM early),
        generate_series(DATE '2024-01-12', DATE '2024-01-25', INTERVAL 1 DAY) t(x))
SELECT user_id, day AS missing_day FROM cal
WHERE NOT EXISTS (SELECT 1 FROM early e WHERE e.user_id = cal.user_id AND e.day = cal.day)"""
    o["freshness_gaps"] = """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
s AS (SELECT user_id, min(day) AS lo, max(day) AS hi FROM d GROUP BY user_id),
cal AS (SELECT user_id, CAST(x AS DATE) AS day
        FROM s, generate_series(lo, hi, INTERVAL 1 DAY) t(x))
SELECT user_id, day AS missing_day FROM cal
WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.user_id = cal.user_id AND d.day = cal.day)"""
    o["data_freshness"] = """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events
           WHERE CAST(ts AS DATE) BETWEEN DATE '2023-01-01' AND DATE '2024-01-30')
SELECT user_id, DATE '2024-01-30' AS expected_day,
       max(CASE WHEN day = DATE '2024-01-30' THEN 1 ELSE 0 END) = 1 AS expected_present,
       max(day) AS latest_day, CAST(DATE '2024-01-30' - max(day) AS INTEGER) AS lag_days
FROM d GROUP BY user_id"""
    o["order_day_gaps"] = """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
cal AS (SELECT CAST(x AS DATE) AS day FROM generate_series(
          (SELECT min(day) FROM d), (SELECT max(day) FROM d), INTERVAL 1 DAY) t(x))
SELECT day AS missing_day FROM cal WHERE day NOT IN (SELECT day FROM d)"""
    o["sample_md5"] = """
WITH x AS (SELECT *, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 1000 END AS group_id
           FROM events),
k AS (SELECT *, CASE WHEN group_id IS NULL
             THEN '-' || len(CAST(event_id AS VARCHAR)) || ':' || CAST(event_id AS VARCHAR)
             ELSE len(CAST(group_id AS VARCHAR)) || ':' || CAST(group_id AS VARCHAR) END AS key
      FROM x)
SELECT * EXCLUDE (key) FROM k WHERE substr(md5(key), 1, 8) < '19999999'"""
    o["sample_k_per_type"] = """
SELECT * FROM (SELECT *, CASE WHEN event_id % 9 <> 0 THEN event_type END AS kind FROM events)
QUALIFY row_number() OVER (PARTITION BY kind ORDER BY
  md5(len(CAST(user_id AS VARCHAR)) || ':' || CAST(user_id AS VARCHAR)
      || len(CAST(event_id AS VARCHAR)) || ':' || CAST(event_id AS VARCHAR)), user_id, event_id) <= 20"""
    o["cast_losses"] = """
SELECT 'event_id' AS column_name, count(*) AS n_present, CAST(0 AS BIGINT) AS n_lost FROM events
UNION ALL
SELECT 'value', count(*) FILTER (WHERE event_id % 7 = 0 OR event_id % 11 <> 0),
       count(*) FILTER (WHERE event_id % 7 = 0 OR (event_id % 11 <> 0 AND event_id % 13 = 0))
FROM events
UNION ALL
SELECT 'user_id', count(user_id), count(*) FILTER (WHERE event_id % 5 = 0) FROM events"""
    o["missing_hours"] = f"""
WITH days AS (SELECT unnest([{', '.join(f"'{x}'" for x in scan_days)}]) AS day),
kept AS (SELECT strftime(ts, '%Y%m%d') AS day, hour(ts) AS h, day(ts) % 5 = 0 AS flat FROM events
         WHERE (day(ts) + hour(ts)) % 7 <> 0),
grid AS (SELECT day, CAST(x AS INTEGER) AS h FROM (SELECT DISTINCT day FROM kept WHERE NOT flat),
         generate_series(0, 23) t(x))
SELECT day, h AS hour, 'missing' AS state, CAST(0 AS BIGINT) AS n FROM grid
WHERE NOT EXISTS (SELECT 1 FROM kept WHERE kept.day = grid.day AND kept.h = grid.h)
  AND day IN (SELECT day FROM days)
UNION ALL
SELECT day, NULL, 'no hour folders', count(*) FROM kept WHERE flat AND day IN (SELECT day FROM days)
GROUP BY day
UNION ALL
SELECT day, NULL, 'no data', 0 FROM days WHERE day NOT IN (SELECT day FROM kept)"""
    o["table_profile"] = f"""
WITH calls AS ({CALLS})
SELECT count(*) AS records,
       count(DISTINCT subscriber_id) AS distinct_subscriber_id,
       count(DISTINCT current_enodeb_id) AS distinct_current_enodeb_id,
       count(DISTINCT serving_nr_cell_id) AS distinct_serving_nr_cell_id,
       count(*) FILTER (WHERE serving_nr_cell_id IS NULL) AS nulls_serving_nr_cell_id,
       count(*) FILTER (WHERE end_latitude IS NULL) AS nulls_end_latitude,
       count(*) FILTER (WHERE indoor_outdoor_indicator_name IS NULL)
         AS nulls_indoor_outdoor_indicator_name
FROM calls"""
    toks = _tokens("text")
    o["doc_token_counts"] = f"""
SELECT doc_id, CAST(len({toks}) AS BIGINT) AS n_tokens,
       CAST(len(list_distinct({toks})) AS BIGINT) AS n_distinct_tokens
FROM documents"""
    o["corpus_token_counts"] = f"""
SELECT token, count(*) AS n FROM (SELECT unnest({toks}) AS token FROM documents)
GROUP BY token"""
    o["dedup_keys"] = """
SELECT * FROM events QUALIFY row_number() OVER (
  PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""
    cov = coverage("current_enodeb_id", "enb", 2, date_td)
    o["parquet_round_trip"] = cov
    o["csv_round_trip"] = cov
    o["csv_gzip_round_trip"] = cov
    o["grid_prefix_read"] = (f"SELECT * FROM ({coverage('current_enodeb_id', 'enb', 3, date_td)}) "
                             "WHERE gridid LIKE '04QFJ5%'")
    o["json_alerts"] = f"""
WITH calls AS ({CALLS}),
g AS (SELECT current_enodeb_id AS enodeb, CAST(ts AS DATE) AS day,
             count(*) FILTER (WHERE rsrp_dbm < -82e0) AS abnormal,
             count(*) FILTER (WHERE indoor_outdoor_indicator_name = 'Indoor') AS nrb,
             count(*) FILTER (WHERE indoor_outdoor_indicator_name IS NULL) AS w360
      FROM calls GROUP BY 1, 2)
SELECT enodeb, 'site_' || enodeb AS site,
       'region_' || CAST(CAST(enodeb AS INTEGER) % 4 AS VARCHAR) AS region,
       CAST(day + 1 AS DATE) AS alert_day, day AS event_day,
       CAST(abnormal AS INTEGER) AS abnormal_kpi_count, CAST(nrb AS INTEGER) AS nrb_ticket_counts,
       CAST(w360 AS INTEGER) AS w360_ticket_counts,
       CASE WHEN CAST(enodeb AS INTEGER) % 2 = 0 THEN 'vendor_a' ELSE 'vendor_b' END AS vendor
FROM g"""
    # a line as Spark writes it: NULL fields do not occur in these records
    day = "strftime({}, '%Y-%m-%d')"
    text = {"alert_day": day.format("alert_day"), "event_day": day.format("event_day"),
            **{c: f"CAST({c} AS VARCHAR)" for c in ("abnormal_kpi_count", "nrb_ticket_counts",
                                                    "w360_ticket_counts")}}
    names = ["enodeb", "site", "region", "alert_day", "event_day", "abnormal_kpi_count",
             "nrb_ticket_counts", "w360_ticket_counts", "vendor"]
    line = "'{' || " + " || ',' || ".join(
        f"""'"{c}":"' || {text.get(c, c)} || '"'""" for c in names) + " || '}'"
    o["json_alerts_broken"] = f"""
WITH a AS ({o["json_alerts"]}), l AS (SELECT *, {line} AS line FROM a)
SELECT {', '.join(f"CASE WHEN len(line) % 3 <> 0 THEN {c} END AS {c}" for c in names)},
       CASE WHEN len(line) % 3 = 0 THEN substr(line, 1, 40) END AS corrupt_record
FROM l"""
    o["preview_20"] = "SELECT * FROM events ORDER BY ts, event_id LIMIT 20"
    return o
