"""The same results stated in plain SQL, to check the Spark queries with another engine.

The statements are built from named common table expressions; each query lists what
it selects, and `_sql` puts the expressions it needs in front, in order.
"""

from __future__ import annotations

import re

from .queries import CITY, EPS_SPACE, EPS_TIME, MIN_PTS


def _hav(lat1, lon1, lat2, lon2) -> str:
    a = (
        f"(pow(sin((radians({lat2})-radians({lat1}))/2),2)"
        f"+cos(radians({lat1}))*cos(radians({lat2}))*pow(sin((radians({lon2})-radians({lon1}))/2),2))"
    )
    return f"(6371000e0*(2e0*atan2(sqrt({a}),sqrt(1e0-{a}))))"


def _knee(curve: str, normalize: bool = True) -> str:
    """(traj_id, v): the value at the lowest score of a curve (traj_id, v)."""
    x, y = "idx/nullif(n-1,0)", "(v-lo)/nullif(hi-lo,0)"
    score = f"coalesce({x},0)+coalesce({y},0)" if normalize else "idx+v"
    return f"""
    SELECT traj_id, arg_min(v, ROW(round({score},12), idx)) AS v FROM (
      SELECT traj_id, v::DOUBLE AS v, row_number() OVER (PARTITION BY traj_id ORDER BY v DESC)-1 AS idx,
        count(*) OVER w AS n, (min(v) OVER w)::DOUBLE AS lo, (max(v) OVER w)::DOUBLE AS hi
      FROM ({curve}) WHERE v IS NOT NULL WINDOW w AS (PARTITION BY traj_id))
    GROUP BY traj_id"""


def _quantile(values: str, *quantiles: float) -> str:
    """(traj_id, q0, q1, ...): nearest-rank elements of (traj_id, v)."""
    picks = ", ".join(
        f"max(v) FILTER (WHERE i = floor((n-1)*{q}::DOUBLE+0.5)) AS q{j}" for j, q in enumerate(quantiles)
    )
    return f"""
    SELECT traj_id, {picks} FROM (
      SELECT traj_id, v, row_number() OVER (PARTITION BY traj_id ORDER BY v)-1 AS i,
        count(*) OVER (PARTITION BY traj_id) AS n
      FROM ({values}) WHERE v IS NOT NULL) GROUP BY traj_id"""


def _density(points: str, limits: str, p: str) -> dict[str, str]:
    """Clustering of `points` with (traj_id, es, et, m) rows in `limits`, names prefixed by p."""
    near = _hav("a.latitude", "a.longitude", "b.latitude", "b.longitude")
    return {
        f"{p}nb": f"""SELECT a.traj_id, a.ord AS a, b.ord AS b, l.m FROM {points} a
          JOIN {points} b USING (traj_id) JOIN {limits} l USING (traj_id)
          WHERE {near} <= l.es AND abs(epoch_us(a.timestamp)-epoch_us(b.timestamp))//1000000 <= l.et""",
        f"{p}core": f"SELECT traj_id, a AS ord FROM {p}nb GROUP BY traj_id, a, m HAVING count(*) >= m",
        f"{p}link": f"""SELECT n.traj_id, n.a, n.b FROM {p}nb n JOIN {p}core c ON c.traj_id=n.traj_id AND c.ord=n.a
          JOIN {p}core d ON d.traj_id=n.traj_id AND d.ord=n.b""",
        f"{p}reach": f"""SELECT traj_id, ord, ord AS root FROM {p}core
          UNION SELECT l.traj_id, l.b, r.root FROM {p}reach r JOIN {p}link l ON l.traj_id=r.traj_id AND l.a=r.ord
          WHERE r.root < l.b""",
        f"{p}comp": f"""SELECT traj_id, ord, root, dense_rank() OVER (PARTITION BY traj_id ORDER BY root) AS cid
          FROM (SELECT traj_id, ord, min(root) AS root FROM {p}reach GROUP BY traj_id, ord)""",
        f"{p}border": f"""SELECT n.traj_id, n.a AS ord,
          coalesce(max(CASE WHEN n.b=c.root THEN c.cid END), min(c.cid)) AS cid
          FROM {p}nb n JOIN {p}comp c ON c.traj_id=n.traj_id AND c.ord=n.b
          WHERE NOT EXISTS (SELECT 1 FROM {p}core k WHERE k.traj_id=n.traj_id AND k.ord=n.a)
          GROUP BY n.traj_id, n.a""",
        f"{p}label": f"""SELECT q.*, coalesce(c.cid, b.cid, 0)::BIGINT AS cluster_id FROM {points} q
          JOIN {limits} USING (traj_id) LEFT JOIN {p}comp c ON c.traj_id=q.traj_id AND c.ord=q.ord
          LEFT JOIN {p}border b ON b.traj_id=q.traj_id AND b.ord=q.ord""",
    }


def _tuning(points: str, p: str) -> dict[str, str]:
    """Density parameters of `points` (dense ord), names prefixed by p."""
    away = _hav("a.latitude", "a.longitude", "b.latitude", "b.longitude")
    gap = "abs(epoch_us(a.timestamp)-epoch_us(b.timestamp))//1000000"

    def kth(distance: str) -> str:
        return f"""SELECT traj_id, ord, point_id, k, v FROM (
          SELECT a.traj_id, a.ord, a.point_id, a.k, {distance} AS v,
            row_number() OVER (PARTITION BY a.traj_id, a.ord ORDER BY {distance}) AS nth
          FROM {p}k a JOIN {p}k b USING (traj_id)) WHERE nth = k+1"""

    return {
        f"{p}n": f"""SELECT traj_id, count(*) AS n, ceil(ln(count(*)))::BIGINT AS min_pts,
          ceil(ln(count(*)))::BIGINT - 1 AS k FROM {points} GROUP BY traj_id""",
        f"{p}k": f"SELECT q.*, n.k FROM {points} q JOIN {p}n n USING (traj_id)",
        f"{p}sk": kth(away),
        f"{p}tk": kth(gap),
        f"{p}es": _knee(f"SELECT traj_id, v FROM {p}sk"),
        f"{p}et": _knee(f"SELECT traj_id, v FROM {p}tk"),
        f"{p}par": f"""SELECT n.*, es.v AS es, et.v AS et, n.min_pts AS m,
          CASE WHEN es.v IS NULL OR et.v IS NULL THEN 'too short'
               WHEN es.v <= 0 OR et.v <= 0 THEN 'eps not positive' ELSE 'usable' END AS status
          FROM {p}n n LEFT JOIN {p}es es USING (traj_id) LEFT JOIN {p}et et USING (traj_id)""",
        f"{p}use": f"SELECT traj_id, es, et, m FROM {p}par WHERE status = 'usable'",
    }


def _cleaning(points: str, p: str) -> dict[str, str]:
    step = _hav("latitude", "longitude", "lead(latitude) OVER w", "lead(longitude) OVER w")
    around = _hav("plat", "plon", "nlat", "nlon")
    return {
        f"{p}gap": f"SELECT *, {step} AS dn FROM {points} WINDOW w AS (PARTITION BY traj_id ORDER BY ord)",
        f"{p}jt": _knee(f"SELECT traj_id, dn AS v FROM {p}gap"),
        f"{p}seg": f"""SELECT * EXCLUDE (brk), (sum(brk) OVER (PARTITION BY traj_id ORDER BY ord))::BIGINT AS segment_id
          FROM (SELECT g.*, coalesce((lag(g.dn) OVER (PARTITION BY g.traj_id ORDER BY g.ord) > j.v)::INT, 0) AS brk
                FROM {p}gap g LEFT JOIN {p}jt j USING (traj_id))""",
        f"{p}mean": f"""SELECT traj_id, segment_id, avg(latitude) AS mlat, avg(longitude) AS mlon, count(*) AS cnt
          FROM {p}seg GROUP BY traj_id, segment_id""",
        f"{p}ctx": f"""SELECT *, round({around}, 6) AS pnd FROM (
          SELECT *, lag(mlat) OVER w AS plat, lag(mlon) OVER w AS plon, lead(mlat) OVER w AS nlat, lead(mlon) OVER w AS nlon
          FROM {p}mean WINDOW w AS (PARTITION BY traj_id ORDER BY segment_id))""",
        f"{p}spt": _quantile(f"SELECT traj_id, pnd AS v FROM {p}ctx WHERE cnt <= 3", 0.05),
        f"{p}kept": f"""SELECT s.* EXCLUDE (segment_id, dn) FROM {p}seg s JOIN {p}ctx c USING (traj_id, segment_id)
          LEFT JOIN {p}spt t USING (traj_id) WHERE NOT coalesce(c.cnt <= 3 AND c.pnd <= t.q0, false)""",
        f"{p}cln": f"""SELECT * REPLACE (row_number() OVER (PARTITION BY traj_id ORDER BY ord) AS ord) FROM {p}kept""",
    }


# The derived tables, by the same arithmetic as the Spark side.
_STAY = "((ord-1)//12)"
_BASE = {
    "ev": "SELECT user_id AS traj_id, event_id AS point_id, ts AS timestamp, value FROM events",
    "num": "SELECT *, row_number() OVER (PARTITION BY traj_id ORDER BY timestamp, point_id) AS ord FROM ev",
    "pos": f"""SELECT traj_id, point_id, ord, timestamp,
      37.5::DOUBLE + 0.01::DOUBLE*(traj_id%7) + 0.02::DOUBLE*{_STAY}
        + (point_id*7919%997)/997::DOUBLE*0.0008::DOUBLE
        + CASE WHEN ord%17=9 THEN 0.25::DOUBLE ELSE 0::DOUBLE END AS latitude,
      127.0::DOUBLE + 0.01::DOUBLE*(traj_id%5) + 0.015::DOUBLE*{_STAY}
        + (point_id*104729%991)/991::DOUBLE*0.0008::DOUBLE AS longitude,
      3+point_id%20 AS accuracy FROM num""",
    "vis": f"""SELECT traj_id, min(timestamp) AS start_time, max(timestamp) AS end_time,
      round(avg(latitude),7) AS latitude, round(avg(longitude),7) AS longitude,
      ['HOME','WORK','UNKNOWN'][(any_value({_STAY})%3+1)::INT] AS semantic_type,
      (min(point_id)%100)/100::DOUBLE AS probability, (min(point_id)*7%100)/100::DOUBLE AS place_probability
      FROM pos GROUP BY traj_id, {_STAY}""",
    "act": f"""SELECT traj_id, timestamp AS start_time, nt AS end_time, round(latitude,7) AS start_latitude,
      round(longitude,7) AS start_longitude, round(nlat,7) AS end_latitude, round(nlon,7) AS end_longitude,
      round({_hav("round(latitude,7)", "round(longitude,7)", "round(nlat,7)", "round(nlon,7)")},3) AS distance,
      ['WALKING','IN_VEHICLE'][({_STAY}%2+1)::INT] AS activity_type,
      (point_id%100)/100::DOUBLE AS probability, (point_id*3%100)/100::DOUBLE AS activity_probability
      FROM (SELECT *, lead(timestamp) OVER w AS nt, lead(latitude) OVER w AS nlat, lead(longitude) OVER w AS nlon
            FROM pos WINDOW w AS (PARTITION BY traj_id ORDER BY ord))
      WHERE ord%12=0 AND nt IS NOT NULL""",
    "pth": "SELECT traj_id, point_id, ord, latitude, longitude, timestamp FROM pos",
    "lay": """SELECT traj_id, 'positions' AS label, latitude, longitude, timestamp FROM pos
      UNION ALL SELECT traj_id, 'paths', latitude, longitude, timestamp FROM pth
      UNION ALL SELECT traj_id, 'visits', latitude, longitude, NULL FROM vis
      UNION ALL SELECT traj_id, 'activities', start_latitude, start_longitude, NULL FROM act""",
    "bad": """SELECT traj_id, point_id,
      CASE WHEN point_id%97=5 THEN latitude+100 WHEN point_id%101=7 THEN 'nan'::DOUBLE
           WHEN point_id%103=9 THEN NULL ELSE latitude END AS latitude,
      CASE WHEN point_id%109=3 THEN longitude+200 ELSE longitude END AS longitude,
      CASE WHEN point_id%107=11 THEN -1 ELSE accuracy END AS accuracy,
      CASE WHEN point_id%113<>1 THEN timestamp END AS timestamp FROM pos""",
    "fix": f"SELECT DISTINCT traj_id, {EPS_SPACE}::DOUBLE AS es, {EPS_TIME}::DOUBLE AS et, {MIN_PTS} AS m FROM ev",
    # The range of RANGE as UTC: Seoul is nine hours ahead.
    "inr": """SELECT * REPLACE (row_number() OVER (PARTITION BY traj_id ORDER BY timestamp, point_id) AS ord) FROM pos
      WHERE timestamp >= TIMESTAMP '2024-01-07 15:00:00' AND timestamp < TIMESTAMP '2024-01-21 15:00:00'""",
}
_CTES = {
    **_BASE,
    **_cleaning("pos", "c_"),
    **_tuning("c_cln", "t_"),
    **_density("c_cln", "t_use", "p_"),
    **_density("pos", "fix", "f_"),
    **_tuning("pos", "u_"),
    **_density("pos", "u_use", "v_"),
    **_cleaning("inr", "i_"),
    **_tuning("i_cln", "j_"),
    **_density("i_cln", "j_use", "r_"),
}
_ORDER = list(_CTES)


def _used(sql: str) -> set[str]:
    return set(re.findall(r"\b[a-z_]+\b", sql)) & set(_ORDER)


def _sql(select: str) -> str:
    needed, todo = set(), _used(select)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo |= _used(_CTES[name]) - needed
    if not needed:
        return select
    parts = ",\n".join(f"{n} AS ({_CTES[n]})" for n in _ORDER if n in needed)
    return f"WITH RECURSIVE {parts}\n{select}"


def _us(name: str, alias: str | None = None) -> str:
    return f"epoch_us({name}) AS {alias or name + '_us'}"


def _ms(name: str, alias: str | None = None) -> str:
    return f"epoch_us({name})//1000*1000 AS {alias or name + '_us'}"


def _rounded(digits: int, *names: str) -> str:
    return ", ".join(f"round({n},{digits}) AS {n}" for n in names)


_INTERVAL = "start_time < TIMESTAMP '2024-01-21 15:00:00' AND end_time > TIMESTAMP '2024-01-07 15:00:00'"
_POINT = "timestamp >= TIMESTAMP '2024-01-07 15:00:00' AND timestamp < TIMESTAMP '2024-01-21 15:00:00'"
_ENDS = """SELECT traj_id, segment_id, arg_min(latitude, ord) AS head_latitude, arg_min(longitude, ord) AS head_longitude,
  arg_min(timestamp, ord) AS head_timestamp, arg_max(latitude, ord) AS tail_latitude,
  arg_max(longitude, ord) AS tail_longitude, arg_max(timestamp, ord) AS tail_timestamp
  FROM c_seg GROUP BY traj_id, segment_id"""
_RULES = {
    "latitude: missing": "latitude IS NULL",
    "latitude: range": "isnan(latitude) OR latitude < -90 OR latitude > 90",
    "longitude: missing": "longitude IS NULL",
    "longitude: range": "longitude < -180 OR longitude > 180",
    "accuracy: missing": "accuracy IS NULL",
    "accuracy: range": "accuracy < 0",
    "timestamp: missing": "timestamp IS NULL",
}
_BROKEN = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in _RULES.items())
_DECIMALS = "printf('%.7f', latitude)", "printf('%.7f', longitude)"
_DAYS = """SELECT traj_id, CAST(CAST(timestamp + INTERVAL 9 HOUR AS DATE) AS VARCHAR) AS day, g, cluster_id FROM (
  SELECT *, {step} AS g FROM f_label WINDOW w AS (PARTITION BY traj_id ORDER BY ord))""".format(
    step=_hav("latitude", "longitude", "lead(latitude) OVER w", "lead(longitude) OVER w")
)


# Stays cut at midnight in Seoul; seconds are counted from the start of the stay.
_DWELL = """SELECT traj_id, CAST(CAST(d AS DATE) AS VARCHAR) AS day,
    sum((epoch_us(least(e, d + INTERVAL 1 DAY))-epoch_us(s))//1000000 - (epoch_us(greatest(s, d))-epoch_us(s))//1000000) AS dwell
  FROM (SELECT *, unnest(generate_series(date_trunc('day', s)::TIMESTAMP, date_trunc('day', e)::TIMESTAMP, INTERVAL 1 DAY)) AS d
    FROM (SELECT traj_id, (min(timestamp) + INTERVAL 9 HOUR)::TIMESTAMP AS s, (max(timestamp) + INTERVAL 9 HOUR)::TIMESTAMP AS e
      FROM f_label WHERE cluster_id > 0 GROUP BY traj_id, cluster_id))
  GROUP BY traj_id, d"""


def _curve_of(kind: str) -> str:
    """The curve with k = min_pts, one more than the parameters use."""
    away = _hav("a.latitude", "a.longitude", "b.latitude", "b.longitude")
    gap = "abs(epoch_us(a.timestamp)-epoch_us(b.timestamp))//1000000"
    distance = away if kind == "space" else gap
    value = "round(v,3)" if kind == "space" else "v"
    return f"""SELECT traj_id, row_number() OVER (PARTITION BY traj_id ORDER BY v DESC)-1 AS idx, {value} AS value FROM (
      SELECT a.traj_id, a.k, {distance} AS v, row_number() OVER (PARTITION BY a.traj_id, a.ord ORDER BY {distance}) AS nth
      FROM u_k a JOIN u_k b USING (traj_id)) WHERE nth = k+2"""


_SELECTS = {
    "haversine": f"SELECT point_id, round({_hav('latitude', 'longitude', *CITY)},3) AS metres FROM pos",
    "distance_to_next": "SELECT traj_id, point_id, ord, round(dn,3) AS distance_to_next FROM c_gap",
    "segment_ids": "SELECT traj_id, point_id, segment_id FROM c_seg",
    "segment_means": """SELECT traj_id, segment_id, round(mlat,6) AS mean_latitude, round(mlon,6) AS mean_longitude,
      cnt AS point_count FROM c_mean""",
    "segment_context": """SELECT traj_id, segment_id, cnt AS point_count, round(plat,6) AS prev_latitude,
      round(plon,6) AS prev_longitude, round(nlat,6) AS next_latitude, round(nlon,6) AS next_longitude,
      round(pnd,3) AS prev_next_distance FROM c_ctx""",
    "segment_head_tail": f"""SELECT traj_id, segment_id,
      {_rounded(9, "head_latitude", "head_longitude", "tail_latitude", "tail_longitude")},
      {_us("head_timestamp")}, {_us("tail_timestamp")} FROM ({_ENDS})""",
    "segment_connectors": f"""SELECT traj_id, segment_id, {_rounded(9, "tail_latitude", "tail_longitude")},
      {_us("tail_timestamp")}, round(hlat,9) AS next_head_latitude, round(hlon,9) AS next_head_longitude,
      {_us("ht", "next_head_timestamp_us")} FROM (
        SELECT *, lead(head_latitude) OVER w AS hlat, lead(head_longitude) OVER w AS hlon,
          lead(head_timestamp) OVER w AS ht FROM ({_ENDS}) WINDOW w AS (PARTITION BY traj_id ORDER BY segment_id))
      WHERE hlat IS NOT NULL""",
    "jump_threshold": "SELECT traj_id, round(v,3) AS jump_threshold FROM c_jt",
    "same_place_threshold": "SELECT traj_id, round(q0,3) AS same_place_threshold FROM c_spt",
    "same_place_threshold_all": f"""SELECT traj_id, round(q0,3) AS same_place_threshold
      FROM ({_quantile("SELECT traj_id, pnd AS v FROM c_ctx", 0.05)})""",
    "remove_jumps": "SELECT traj_id, point_id, ord FROM c_kept",
    "removed_positions": """SELECT traj_id, point_id, ord FROM pos p
      WHERE NOT EXISTS (SELECT 1 FROM c_kept k WHERE k.traj_id=p.traj_id AND k.ord=p.ord)""",
    "jump_removal_counts": """SELECT traj_id, b AS before_rows, a AS after_rows, b-a AS removed_rows FROM (
      SELECT traj_id, count(*) AS b, count(k.ord) AS a FROM pos p LEFT JOIN c_kept k USING (traj_id, ord) GROUP BY traj_id)""",
    "gap_distance_summary": f"""SELECT traj_id, count(dn) AS gap_count, round(avg(dn),3) AS mean_gap,
      round(stddev_samp(dn),3) AS std_gap, round(min(dn),3) AS min_gap, round(max(dn),3) AS max_gap,
      round(any_value(q0),3) AS q25_gap, round(any_value(q1),3) AS q50_gap, round(any_value(q2),3) AS q75_gap
      FROM c_gap JOIN ({_quantile("SELECT traj_id, dn AS v FROM c_gap", 0.25, 0.5, 0.75)}) USING (traj_id)
      GROUP BY traj_id""",
    "knee_normalized": f"SELECT traj_id, round(v,3) AS knee FROM ({_knee('SELECT traj_id, value AS v FROM ev')})",
    "knee_raw": f"SELECT traj_id, round(v,3) AS knee FROM ({_knee('SELECT traj_id, value AS v FROM ev', False)})",
    "min_pts": "SELECT traj_id, n, min_pts FROM u_n",
    "temporal_k_distance": "SELECT traj_id, point_id, k, v AS k_distance FROM u_tk",
    "spatial_k_distance": "SELECT traj_id, point_id, k, round(v,3) AS k_distance FROM u_sk",
    "k_distance_curve": _curve_of("space"),
    "temporal_k_distance_curve": _curve_of("time"),
    "stdbscan_params": """SELECT traj_id, n, min_pts, k, round(es,3) AS eps_space, round(et,3) AS eps_time, status
      FROM t_par""",
    "st_neighbors": "SELECT traj_id, a AS ord, count(*) AS neighbours FROM f_nb GROUP BY traj_id, a",
    "core_points": "SELECT traj_id, ord FROM f_core",
    "st_dbscan": "SELECT traj_id, point_id, cluster_id FROM f_label",
    "noise_points": "SELECT traj_id, point_id FROM f_label WHERE cluster_id = 0",
    "cluster_sizes": "SELECT traj_id, cluster_id, count(*) AS points FROM v_label GROUP BY traj_id, cluster_id",
    "pipeline_summary": """SELECT traj_id, n AS cleaned_rows, round(j.v,3) AS jump_threshold,
      round(s.q0,3) AS same_place_threshold, min_pts, round(es,3) AS eps_space, round(et,3) AS eps_time, status,
      clusters, noise_rows FROM t_par LEFT JOIN c_jt j USING (traj_id) LEFT JOIN c_spt s USING (traj_id) LEFT JOIN (
        SELECT traj_id, max(cluster_id) AS clusters, count(*) FILTER (WHERE cluster_id=0) AS noise_rows
        FROM p_label GROUP BY traj_id) USING (traj_id)""",
    "pipeline_range_clusters": "SELECT traj_id, point_id, cluster_id FROM r_label",
    "stays": f"""SELECT traj_id, cluster_id, {_us("min(timestamp)", "start_time_us")}, {_us("max(timestamp)", "end_time_us")},
      round(avg(latitude),6) AS latitude, round(avg(longitude),6) AS longitude, count(*) AS points,
      (epoch_us(max(timestamp))-epoch_us(min(timestamp)))//1000000 AS dwell_seconds
      FROM f_label WHERE cluster_id > 0 GROUP BY traj_id, cluster_id""",
    "daily_mobility": f"""SELECT traj_id, day, round(coalesce(metres,0),3) AS travel_metres, coalesce(points,0) AS points,
      coalesce(stays,0) AS stays, coalesce(dwell,0)::BIGINT AS dwell_seconds FROM (
        SELECT traj_id, day, sum(g) AS metres, count(*) AS points,
          count(DISTINCT cluster_id) FILTER (WHERE cluster_id > 0) AS stays FROM ({_DAYS}) GROUP BY traj_id, day)
      FULL JOIN ({_DWELL}) USING (traj_id, day)""",
    "load_raw_positions": f"SELECT traj_id, {_rounded(7, 'latitude', 'longitude')}, accuracy, {_ms('timestamp')} FROM pos",
    "load_timeline_paths": f"SELECT traj_id, {_rounded(7, 'latitude', 'longitude')}, {_ms('timestamp')} FROM pth",
    "load_visits": f"SELECT * EXCLUDE (start_time, end_time), {_ms('start_time')}, {_ms('end_time')} FROM vis",
    "load_activities": f"SELECT * EXCLUDE (start_time, end_time), {_ms('start_time')}, {_ms('end_time')} FROM act",
    "extract_counts": """SELECT 'raw_positions' AS table_name, count(*) AS row_count FROM pos
      UNION ALL SELECT 'timeline_paths', count(*) FROM pth UNION ALL SELECT 'visits', count(*) FROM vis
      UNION ALL SELECT 'activities', count(*) FROM act""",
    "rejected_documents": """SELECT traj_id, 'read' AS what, count(*) AS n FROM pos WHERE traj_id%5 NOT IN (1, 3) GROUP BY traj_id
      UNION ALL SELECT traj_id, CASE WHEN traj_id%5=1 THEN 'not a JSON document' ELSE 'a field of the wrong type' END,
      count(DISTINCT (ord-1)//12) FROM pos WHERE traj_id%5 IN (1, 3) GROUP BY traj_id""",
    "stored_clusters": f"""SELECT traj_id, {_us("timestamp")}, cluster_id FROM p_label
      UNION ALL SELECT -traj_id-1, {_us("timestamp")}, NULL FROM pos WHERE traj_id%10 = 0 AND ord <= 2""",
    "parse_latlng": """SELECT point_id, CASE WHEN point_id%4 < 3 THEN round(latitude,7) END AS latitude,
      CASE WHEN point_id%4 <> 2 THEN round(longitude,7) END AS longitude FROM pos""",
    "parse_timestamp": "SELECT point_id, CASE WHEN point_id%3=0 THEN epoch_us(timestamp)//1000*1000 END AS timestamp_us FROM ev",
    "kst_to_utc": "SELECT point_id, epoch_us(timestamp - INTERVAL 9 HOUR) AS utc_us FROM ev",
    "utc_to_kst": "SELECT point_id, epoch_us(timestamp + INTERVAL 9 HOUR) AS kst_us FROM ev",
    "validate_positions": f"""SELECT point_id, reasons FROM (
      SELECT point_id, concat_ws('; ', {_BROKEN}) AS reasons FROM bad) WHERE reasons <> ''""",
    "validation_report": " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {test}) AS bad_rows FROM bad" for name, test in _RULES.items()
    ),
    "coordinate_violations": f"""SELECT count(*) FILTER (WHERE {_RULES['latitude: range']}) AS bad_latitude,
      count(*) FILTER (WHERE {_RULES['longitude: range']}) AS bad_longitude FROM bad""",
    "roundtrip_positions": f"SELECT {_rounded(9, 'latitude', 'longitude')}, accuracy, {_us('timestamp')} FROM pos",
    "stored_ranges": f"""SELECT traj_id, 'position' AS what, {_us('timestamp', 'start_us')}, {_us('timestamp', 'end_us')}
      FROM pos WHERE {_POINT} UNION ALL SELECT traj_id, 'visit', {_us('start_time', 'start_us')}, {_us('end_time', 'end_us')}
      FROM vis WHERE {_INTERVAL}""",
    "stored_rejected": f"SELECT point_id, concat_ws('; ', {_BROKEN}) AS reasons FROM bad",
    "filter_points": f"SELECT traj_id, point_id, {_us('timestamp')} FROM pos WHERE {_POINT}",
    "filter_intervals": f"""SELECT traj_id, {_us('start_time')}, {_us('end_time')}, semantic_type FROM vis
      WHERE {_INTERVAL}""",
    "activity_start_points": "SELECT traj_id, start_latitude AS latitude, start_longitude AS longitude FROM act",
    "layer_union": f"SELECT traj_id, label, {_rounded(9, 'latitude', 'longitude')}, {_us('timestamp')} FROM lay",
    "layer_extent": """SELECT round(min(latitude),9) AS min_latitude, round(max(latitude),9) AS max_latitude,
      round(min(longitude),9) AS min_longitude, round(max(longitude),9) AS max_longitude FROM lay""",
    "animation_frames": f"SELECT DISTINCT traj_id, {_us('timestamp')} FROM lay WHERE timestamp IS NOT NULL",
    "visible_counts": f"""SELECT f.traj_id, {_us('f.timestamp', 'timestamp_us')}, n.label,
      (SELECT count(*) FROM lay l WHERE l.traj_id=f.traj_id AND l.label=n.label
        AND (l.timestamp <= f.timestamp OR l.timestamp IS NULL AND NOT EXISTS (SELECT 1 FROM lay m
          WHERE m.traj_id=l.traj_id AND m.label=l.label AND m.timestamp IS NOT NULL))) AS visible
      FROM (SELECT DISTINCT traj_id, timestamp FROM lay WHERE timestamp IS NOT NULL) f
      JOIN (SELECT DISTINCT label FROM lay) n ON true""",
    "visible_counts_by_index": """SELECT traj_id, frame, label, least(frame+1, height) AS visible FROM (
      SELECT traj_id, label, height, unnest(range(max(height) OVER (PARTITION BY traj_id))) AS frame
      FROM (SELECT traj_id, label, count(*) AS height FROM lay GROUP BY traj_id, label))""",
    "raw_vs_timeline": f"""SELECT traj_id, label, count(*) AS points, round(min(latitude),6) AS min_latitude,
      round(max(latitude),6) AS max_latitude, round(min(longitude),6) AS min_longitude,
      round(max(longitude),6) AS max_longitude FROM (
        SELECT traj_id, 'positions' AS label, latitude, longitude FROM pos WHERE {_POINT}
        UNION ALL SELECT traj_id, 'paths', latitude, longitude FROM pth WHERE {_POINT}
        UNION ALL SELECT traj_id, 'visits', latitude, longitude FROM vis WHERE {_INTERVAL}
        UNION ALL SELECT traj_id, 'activities', start_latitude, start_longitude FROM act WHERE {_INTERVAL})
      GROUP BY traj_id, label""",
}

_SELECTS["store_all_counts"] = _SELECTS["extract_counts"]
_SELECTS["stored_report"] = _SELECTS["validation_report"]

ORACLES = {name: _sql(select) for name, select in _SELECTS.items()}
