"""DuckDB oracle SQL for every catalogued query.

Each query is plain SQL over the driver tables (registered as views by the
checker).  The shared building blocks below mirror the adapters in
``hourglass.sources.driver`` and are written independently of the Spark code,
so a mismatch points at a real semantic difference.  Numeric outputs are
rounded to 6 decimals on both sides.
"""

from __future__ import annotations

# --------------------------------------------------------------------------- CTEs
CTE: dict[str, str] = {}

CTE["spans"] = """spans AS (
  SELECT user_id AS stay,
         min(ts) FILTER (WHERE event_type = 'signup') AS admit_ts,
         max(ts) FILTER (WHERE event_type = 'purchase') AS discharge_ts
  FROM events GROUP BY user_id)"""

CTE["stays"] = """stays AS (
  SELECT s.stay, c.c_nationkey AS person, s.admit_ts, s.discharge_ts,
         (epoch_us(s.discharge_ts) - epoch_us(s.admit_ts)) / 86400000000.0 AS los_days,
         CAST(floor((epoch_us(s.discharge_ts) - epoch_us(s.admit_ts)) / 60000000.0) AS BIGINT)
           AS discharge_offset,
         CASE WHEN floor((c.c_acctbal + 1000.0) / 110.0) > 89 THEN '> 89'
              WHEN floor((c.c_acctbal + 1000.0) / 110.0) < 5 THEN ''
              ELSE CAST(CAST(floor((c.c_acctbal + 1000.0) / 110.0) AS INTEGER) AS VARCHAR) END AS age,
         CASE WHEN c.c_acctbal < 500.0 THEN 'EXPIRED' ELSE 'ALIVE' END AS mortality,
         c.c_mktsegment AS discharge_location
  FROM spans s JOIN customer c ON c.c_custkey = s.stay)"""

CTE["cohort"] = """cohort AS (
  SELECT * FROM stays
  WHERE los_days > 5.0 / 24.0
    AND TRY_CAST(nullif(replace(age, '> 89', '89'), '') AS INTEGER) > 17)"""

_FEATURE = ("event_type || '_' || CAST((((TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)"
            " % 10) + 10) % 10) AS VARCHAR)")

CTE["ev"] = f"""ev AS (
  SELECT user_id AS stay, ts, {_FEATURE} AS feature,
         CASE WHEN isnan(value) THEN NULL ELSE value END AS value, 'events' AS source
  FROM events WHERE {_FEATURE} IS NOT NULL)"""

CTE["ev2"] = f"""ev2 AS (
  SELECT * FROM ev
  UNION ALL
  SELECT user_id AS stay, ts, {_FEATURE} AS feature,
         CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) AS value,
         'props' AS source
  FROM events WHERE {_FEATURE} IS NOT NULL)"""


def _win(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT * FROM (
    SELECT e.stay, e.feature, e.value, e.source,
           CAST(floor((epoch_us(e.ts) - epoch_us(c.admit_ts)) / 60000000.0) AS BIGINT) AS offset_min,
           c.discharge_offset
    FROM {src} e JOIN cohort c ON e.stay = c.stay) x
  WHERE offset_min >= -1440 AND offset_min <= discharge_offset)"""


CTE["win"] = _win("win", "ev")
CTE["win2"] = _win("win2", "ev2")


def _series(suffix: str, win: str, min_frac: float = 0.7) -> dict[str, str]:
    s = suffix
    return {
        f"src{s}": f"""src{s} AS (
  SELECT stay, CAST(ceil(offset_min / 60.0) AS BIGINT) AS time, offset_min, feature, source,
         avg(value) AS value
  FROM {win} GROUP BY stay, offset_min, feature, source)""",
        f"vocab{s}": f"""vocab{s} AS (
  SELECT feature, count(DISTINCT stay) AS n_stays FROM src{s} GROUP BY feature
  HAVING count(DISTINCT stay) > (SELECT count(DISTINCT stay) FROM cohort) * {min_frac})""",
        f"q{s}": f"""q{s} AS (
  SELECT feature, quantile_cont(value, 0.05) AS q_lo, quantile_cont(value, 0.95) AS q_hi
  FROM src{s} WHERE value IS NOT NULL AND feature IN (SELECT feature FROM vocab{s})
  GROUP BY feature)""",
        f"sc{s}": f"""sc{s} AS (
  SELECT * FROM (
    SELECT s.stay, s.time, s.offset_min, s.feature, s.source,
           CASE WHEN q.q_hi = q.q_lo THEN
                  (CASE WHEN s.value > q.q_lo THEN 4.0 WHEN s.value < q.q_lo THEN -4.0 END)
                ELSE greatest(-4.0, least(4.0, 2.0 * (s.value - q.q_lo) / (q.q_hi - q.q_lo) - 1.0))
           END AS value
    FROM src{s} s JOIN q{s} q ON s.feature = q.feature
    WHERE s.value IS NOT NULL) x
  WHERE value IS NOT NULL)""",
        f"minute{s}": f"""minute{s} AS (
  SELECT stay, time, offset_min, feature, avg(value) AS value
  FROM sc{s} GROUP BY stay, time, offset_min, feature)""",
        f"hourly{s}": f"""hourly{s} AS (
  SELECT stay, time, feature, avg(value) AS value FROM minute{s} GROUP BY stay, time, feature)""",
        f"rng{s}": f"""rng{s} AS (
  SELECT * FROM (SELECT stay, min(time) AS lo, least(max(time), 335) AS hi
                 FROM hourly{s} GROUP BY stay) x WHERE lo <= hi)""",
        f"grid{s}": f"""grid{s} AS (
  SELECT r.stay, v.feature, g.time
  FROM rng{s} r CROSS JOIN vocab{s} v, generate_series(r.lo, r.hi) AS g(time))""",
        f"filled{s}": f"""filled{s} AS (
  SELECT stay, feature, time,
         last_value(value IGNORE NULLS) OVER w AS value,
         last_value(obs_time IGNORE NULLS) OVER w AS last_obs
  FROM (SELECT g.stay, g.feature, g.time, h.value,
               CASE WHEN h.value IS NOT NULL THEN g.time END AS obs_time
        FROM grid{s} g LEFT JOIN hourly{s} h
          ON g.stay = h.stay AND g.feature = h.feature AND g.time = h.time) j
  WINDOW w AS (PARTITION BY stay, feature ORDER BY time
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
        f"encoded{s}": f"""encoded{s} AS (
  SELECT f.stay, f.time, f.feature, coalesce(f.value, 0.0) AS value,
         CASE WHEN f.last_obs IS NULL THEN 0.0 WHEN f.time = f.last_obs THEN 1.0
              ELSE 1.0 / ((f.time - f.last_obs) * (4.0 / 3.0)) END AS mask,
         CASE WHEN f.time = f.last_obs THEN 1.0 ELSE 0.0 END AS bmask,
         (((f.time + hour(c.admit_ts)) % 24 + 24) % 24) / 23.0 AS hour
  FROM filled{s} f JOIN cohort c ON f.stay = c.stay
  WHERE f.time > 0 AND f.time < 336)""",
    }


CTE.update(_series("", "win"))
CTE.update(_series("2", "win2"))


def _main_series(suffix: str, extra: str, main: str, wide: tuple[str, ...]) -> None:
    """CTEs of an encoding whose stays must have rows of the main source (``extra``: its rows)."""
    s = suffix
    CTE[f"ev{s}"] = f"""ev{s} AS (
  SELECT * FROM ev
  UNION ALL
  {extra})"""
    CTE[f"win{s}"] = _win(f"win{s}", f"ev{s}")
    CTE[f"kept{s}"] = f"""kept{s} AS (SELECT DISTINCT stay FROM win{s} WHERE source = '{main}')"""
    parts = _series(s, f"win{s}")
    names = ", ".join(f"'{w}'" for w in wide) or "''"
    CTE[f"all{s}"] = parts[f"src{s}"].replace(f"src{s} AS", f"all{s} AS", 1).replace("GROUP BY", "WHERE value IS NOT NULL GROUP BY")
    CTE[f"vocab{s}"] = f"""vocab{s} AS (
  SELECT feature, count(DISTINCT stay) AS n_stays FROM all{s} GROUP BY feature
  HAVING count(DISTINCT stay) > (SELECT count(DISTINCT stay) FROM cohort) * 0.7 OR feature IN ({names}))"""
    CTE[f"src{s}"] = f"""src{s} AS (SELECT * FROM all{s} WHERE stay IN (SELECT stay FROM kept{s}))"""
    CTE.update({k: v for k, v in parts.items() if k not in (f"src{s}", f"vocab{s}")})


_ALARM = f"""SELECT user_id AS stay, ts, {_FEATURE} AS feature,
         CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) AS value, 'alarms' AS source
  FROM events WHERE event_type = 'error' AND TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 16 = 0"""
_MONITOR = """SELECT user_id AS stay, ts, 'monitor_k' AS feature,
         CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) AS value, 'monitor' AS source
  FROM events WHERE event_type = 'error' AND TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 16 = 0
  UNION ALL
  SELECT user_id, ts, 'monitor_value', CASE WHEN isnan(value) THEN NULL ELSE value END, 'monitor'
  FROM events WHERE event_type = 'error' AND TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 16 = 0"""
_main_series("3", _ALARM, "alarms", ())
_main_series("4", _MONITOR, "monitor", ("monitor_k", "monitor_value"))

_ORDER = list(CTE)


def with_(*names: str) -> str:
    """``WITH`` clause holding the named CTEs plus their dependencies, in order."""
    need: set[str] = set()

    def visit(n: str) -> None:
        if n in need:
            return
        need.add(n)
        body = CTE[n]
        for other in _ORDER:
            if other != n and _refs(body, other):
                visit(other)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(CTE[n] for n in _ORDER if n in need) + "\n"


def _refs(body: str, name: str) -> bool:
    import re

    return re.search(rf"(FROM|JOIN)\s+{re.escape(name)}\b", body) is not None or \
        re.search(rf"IN \(SELECT [a-z_]+ FROM {re.escape(name)}\b", body) is not None


def r6(expr: str, alias: str) -> str:
    v = f"CAST({expr} AS DOUBLE)"
    x = f"(CAST(sign({v}) AS DOUBLE) * floor(abs({v}) * 1000000.0 + 0.5) / 1000000.0)"
    return f"(CASE WHEN {x} = 0 THEN CAST(0.0 AS DOUBLE) ELSE {x} END) AS {alias}"


# --------------------------------------------------------------------------- queries
ORACLE: dict[str, str] = {}

ORACLE["cohort_select"] = with_("cohort") + f"""
SELECT stay, person, {r6('los_days', 'los_days')}, discharge_offset, age, mortality,
       discharge_location
FROM cohort"""

ORACLE["time_window_join"] = with_("win") + f"""
SELECT stay, offset_min, feature, {r6('value', 'value')}, source FROM win"""

ORACLE["common_features"] = with_("vocab") + """
SELECT feature, n_stays FROM vocab"""

ORACLE["common_features_dense"] = with_("win") + f"""
, per AS (SELECT feature, stay, count(*) AS n_obs FROM win GROUP BY feature, stay)
SELECT feature, count(*) AS n_stays, {r6('avg(n_obs)', 'avg_obs')}
FROM per GROUP BY feature
HAVING count(*) > (SELECT count(DISTINCT stay) FROM cohort) * 0.6 AND avg(n_obs) > 1.3"""

ORACLE["minute_mean"] = with_("win2") + f"""
, s AS (SELECT stay, offset_min, feature, source, avg(value) AS value
        FROM win2 WHERE value IS NOT NULL GROUP BY stay, offset_min, feature, source)
SELECT stay, offset_min, feature, {r6('avg(value)', 'value')}, count(*) AS n_sources
FROM s GROUP BY stay, offset_min, feature"""

ORACLE["quantile_fit"] = with_("vocab", "q") + f"""
SELECT v.feature, v.n_stays, {r6('q.q_lo', 'q_lo')}, {r6('q.q_hi', 'q_hi')}
FROM vocab v LEFT JOIN q ON v.feature = q.feature"""

ORACLE["scale_clip"] = with_("sc") + f"""
SELECT stay, offset_min, feature, source, {r6('value', 'value')} FROM sc"""

ORACLE["hourly_mean"] = with_("hourly") + f"""
SELECT stay, time, feature, {r6('value', 'value')} FROM hourly"""

ORACLE["encode_timeseries"] = with_("encoded") + f"""
SELECT stay, time, feature, {r6('value', 'value')}, {r6('mask', 'mask')}, {r6('hour', 'hour')}
FROM encoded"""

ORACLE["encode_two_sources"] = with_("encoded2") + f"""
SELECT stay, time, feature, {r6('value', 'value')}, {r6('mask', 'mask')}, {r6('hour', 'hour')}
FROM encoded2"""

for _name, _n in (("encode_main_source", "3"), ("encode_wide_source", "4")):
    ORACLE[_name] = with_(f"encoded{_n}") + f"""
SELECT stay, time, feature, {r6('value', 'value')}, {r6('mask', 'mask')}, {r6('hour', 'hour')}
FROM encoded{_n}"""

ORACLE["forward_fill"] = with_("encoded") + f"""
SELECT stay, time, feature, {r6('value', 'value')} FROM encoded"""

ORACLE["decay_mask"] = with_("encoded") + f"""
SELECT stay, time, feature, {r6('mask', 'mask')} FROM encoded"""

ORACLE["binary_mask"] = with_("encoded") + f"""
SELECT stay, time, feature, {r6('bmask', 'mask')} FROM encoded"""

ORACLE["time_of_day"] = with_("encoded") + f"""
SELECT DISTINCT stay, time, {r6('hour', 'hour')} FROM encoded"""

ORACLE["dense_grid"] = with_("grid", "hourly") + """
SELECT g.stay, g.time, count(*) AS n_features, count(h.value) AS n_observed
FROM grid g LEFT JOIN hourly h ON g.stay = h.stay AND g.feature = h.feature AND g.time = h.time
GROUP BY g.stay, g.time"""

ORACLE["stays_with_series"] = with_("win2") + """
SELECT stay FROM win2 WHERE source = 'events'
UNION
SELECT stay FROM win2 WHERE source = 'props'"""

ORACLE["coverage_by_column"] = with_("win") + """
SELECT count(DISTINCT CASE WHEN feature LIKE 'click%' THEN stay END) AS click,
       count(DISTINCT CASE WHEN feature LIKE 'view%' THEN stay END) AS view,
       count(DISTINCT CASE WHEN feature LIKE 'purchase%' THEN stay END) AS purchase,
       count(DISTINCT CASE WHEN feature LIKE 'signup%' THEN stay END) AS signup,
       count(DISTINCT CASE WHEN feature LIKE 'error%' THEN stay END) AS error
FROM win WHERE offset_min < 1440"""


# --------------------------------------------------------------------------- static group
CTE["flat"] = """flat AS (
  SELECT st.stay,
         CASE WHEN c.c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'Male'
              WHEN c.c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'Female'
              ELSE 'Unknown' END AS gender,
         CASE WHEN r.r_name IN ('AMERICA', 'EUROPE') THEN 't' ELSE 'f' END AS teachingstatus,
         n.n_name AS nation, r.r_name AS region, c.c_mktsegment AS segment, st.age,
         CASE WHEN c.c_acctbal >= 0 THEN c.c_acctbal / 50.0 END AS height,
         CASE WHEN c.c_mktsegment <> 'AUTOMOBILE' THEN (c.c_acctbal + 1000.0) / 100.0 END AS weight,
         hour(st.admit_ts) AS hour, c.c_acctbal AS balance_after_24h
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
       JOIN region r ON n.n_regionkey = r.r_regionkey
       JOIN stays st ON c.c_custkey = st.stay)"""
CTE["sstays"] = """sstays AS (SELECT DISTINCT stay FROM win)"""
CTE["fl"] = """fl AS (SELECT * FROM flat WHERE stay IN (SELECT stay FROM sstays))"""
CTE["coll"] = """coll AS (
  SELECT stay, gender, teachingstatus, age, height, weight, hour,
         CASE WHEN nation IS NULL THEN NULL
              WHEN count(*) OVER (PARTITION BY nation) < 8 THEN 'misc' ELSE nation END AS nation,
         CASE WHEN region IS NULL THEN NULL
              WHEN count(*) OVER (PARTITION BY region) < 8 THEN 'misc' ELSE region END AS region,
         CASE WHEN segment IS NULL THEN NULL
              WHEN count(*) OVER (PARTITION BY segment) < 8 THEN 'misc' ELSE segment END AS segment
  FROM fl)"""
CTE["enc"] = """enc AS (
  SELECT stay,
         CASE gender WHEN 'Male' THEN 1.0 WHEN 'Female' THEN 0.0 ELSE 0.5 END AS gender,
         CASE teachingstatus WHEN 't' THEN 1 WHEN 'f' THEN 0 END AS teachingstatus,
         nation, region, segment,
         CASE WHEN contains(coalesce(nullif(age, ''), '63'), '> 89') THEN 1 ELSE 0 END AS over89,
         CAST(replace(coalesce(nullif(age, ''), '63'), '> ', '') AS DOUBLE) AS age,
         height, weight, CAST(hour AS DOUBLE) AS hour
  FROM coll)"""
CTE["encst"] = """encst AS (
  SELECT avg(height) AS h_mean, stddev_samp(height) AS h_std,
         quantile_cont(weight, 0.05) AS w_lo, quantile_cont(weight, 0.95) AS w_hi,
         quantile_cont(age, 0.05) AS a_lo, quantile_cont(age, 0.95) AS a_hi,
         quantile_cont(hour, 0.05) AS r_lo, quantile_cont(hour, 0.95) AS r_hi
  FROM enc)"""
_ORDER[:] = list(CTE)


def sql_scale(x: str, lo: str, hi: str, clip: float = 4.0) -> str:
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN {hi} = {lo} THEN "
            f"(CASE WHEN {x} > {lo} THEN {clip} WHEN {x} < {lo} THEN -{clip} END) "
            f"ELSE greatest(-{clip}, least({clip}, 2.0 * ({x} - {lo}) / ({hi} - {lo}) - 1.0)) END)")


def sql_zscore(x: str, mean: str, std: str, clip: float = 4.0) -> str:
    return (f"(CASE WHEN {x} IS NULL OR {std} IS NULL OR {std} = 0 THEN NULL "
            f"ELSE greatest(-{clip}, least({clip}, ({x} - {mean}) / {std})) END)")


def _one_hot_rows(src: str, col: str, key: str = "stay") -> str:
    return (f"SELECT e.{key}, '{col}_' || v.{col} AS feature, "
            f"CAST(CASE WHEN e.{col} = v.{col} THEN 1.0 ELSE 0.0 END AS DOUBLE) AS value "
            f"FROM {src} e CROSS JOIN (SELECT DISTINCT {col} FROM {src} WHERE {col} IS NOT NULL) v")


ORACLE["star_join"] = with_("flat") + f"""
SELECT DISTINCT stay, gender, teachingstatus, nation, region, segment, age, {r6('height', 'height')},
       {r6('weight', 'weight')}, hour, {r6('balance_after_24h', 'balance_after_24h')}
FROM flat"""

ORACLE["collapse_rare"] = with_("coll") + "SELECT stay, nation FROM coll"

ORACLE["value_counts"] = with_("fl") + """
SELECT segment, count(*) AS count FROM fl WHERE segment IS NOT NULL GROUP BY segment"""

ORACLE["one_hot"] = with_("fl") + f"""
SELECT stay, feature, value FROM ({_one_hot_rows('fl', 'region')}
UNION ALL {_one_hot_rows('fl', 'segment')}) x"""

ORACLE["one_hot_long"] = with_("fl") + _one_hot_rows("fl", "nation")

ORACLE["standardise"] = with_("fl") + f"""
SELECT stay, {r6(sql_zscore('height', 's.m', 's.s'), 'height')}
FROM fl CROSS JOIN (SELECT avg(height) AS m, stddev_samp(height) AS s FROM fl) s"""

ORACLE["quantile_scale"] = with_("fl") + f"""
, s AS (SELECT quantile_cont(weight, 0.05) AS w_lo, quantile_cont(weight, 0.95) AS w_hi,
               quantile_cont(CAST(hour AS DOUBLE), 0.05) AS h_lo,
               quantile_cont(CAST(hour AS DOUBLE), 0.95) AS h_hi FROM fl)
SELECT stay, {r6(sql_scale('weight', 's.w_lo', 's.w_hi'), 'weight')},
       {r6(sql_scale('CAST(hour AS DOUBLE)', 's.h_lo', 's.h_hi'), 'hour')}
FROM fl CROSS JOIN s"""

ORACLE["impute_indicator"] = with_("fl") + f"""
SELECT stay, {r6('coalesce(weight, 0.0)', 'weight')},
       CASE WHEN weight IS NULL THEN 1 ELSE 0 END AS nullweight
FROM fl"""

ORACLE["age_parse"] = with_("stays") + f"""
SELECT stay, TRY_CAST(nullif(replace(age, '> 89', '89'), '') AS INTEGER) AS age_int,
       CASE WHEN contains(coalesce(nullif(age, ''), '63'), '> 89') THEN 1 ELSE 0 END AS over89,
       {r6("TRY_CAST(replace(coalesce(nullif(age, ''), '63'), '> ', '') AS DOUBLE)", 'age_float')}
FROM stays"""

ORACLE["encode_flat"] = with_("enc", "encst") + f"""
, fin AS (
  SELECT e.stay, e.gender, CAST(e.teachingstatus AS DOUBLE) AS teachingstatus, e.nation, e.region,
         e.segment, CAST(e.over89 AS DOUBLE) AS over89,
         coalesce({sql_zscore('e.height', 's.h_mean', 's.h_std')}, 0.0) AS height,
         coalesce({sql_scale('e.weight', 's.w_lo', 's.w_hi')}, 0.0) AS weight,
         {sql_scale('e.age', 's.a_lo', 's.a_hi')} AS age,
         {sql_scale('e.hour', 's.r_lo', 's.r_hi')} AS hour,
         CASE WHEN e.weight IS NULL THEN 1.0 ELSE 0.0 END AS nullweight,
         CASE WHEN e.height IS NULL THEN 1.0 ELSE 0.0 END AS nullheight
  FROM enc e CROSS JOIN encst s)
SELECT stay, feature, {r6('value', 'value')} FROM (
  SELECT stay, 'gender' AS feature, gender AS value FROM fin
  UNION ALL SELECT stay, 'teachingstatus', teachingstatus FROM fin
  UNION ALL SELECT stay, '> 89', over89 FROM fin
  UNION ALL SELECT stay, 'height', height FROM fin
  UNION ALL SELECT stay, 'weight', weight FROM fin
  UNION ALL SELECT stay, 'age', age FROM fin
  UNION ALL SELECT stay, 'hour', hour FROM fin
  UNION ALL SELECT stay, 'nullweight', nullweight FROM fin
  UNION ALL SELECT stay, 'nullheight', nullheight FROM fin
  UNION ALL {_one_hot_rows('fin', 'nation')}
  UNION ALL {_one_hot_rows('fin', 'region')}
  UNION ALL {_one_hot_rows('fin', 'segment')}) x"""

ORACLE["encode_labels"] = with_("stays", "sstays") + f"""
, lab AS (SELECT stay, person, los_days,
                 CASE mortality WHEN 'EXPIRED' THEN 1 WHEN 'ALIVE' THEN 0 END AS mortality,
                 discharge_location, mortality AS discharge_status
          FROM stays WHERE stay IN (SELECT stay FROM sstays))
SELECT stay, feature, {r6('value', 'value')} FROM (
  SELECT stay, 'person' AS feature, CAST(person AS DOUBLE) AS value FROM lab
  UNION ALL SELECT stay, 'los_days', los_days FROM lab
  UNION ALL SELECT stay, 'mortality', CAST(mortality AS DOUBLE) FROM lab
  UNION ALL {_one_hot_rows('lab', 'discharge_location')}
  UNION ALL {_one_hot_rows('lab', 'discharge_status')}) x"""

ORACLE["describe"] = with_("cohort") + f"""
SELECT count(los_days) AS count, {r6('avg(los_days)', 'mean')}, {r6('stddev_samp(los_days)', 'std')},
       {r6('min(los_days)', 'min')}, {r6('quantile_cont(los_days, 0.25)', 'p25')},
       {r6('quantile_cont(los_days, 0.5)', 'p50')}, {r6('quantile_cont(los_days, 0.75)', 'p75')},
       {r6('max(los_days)', 'max')}
FROM cohort"""

ORACLE["describe_categorical"] = with_("fl") + """
, vc AS (SELECT segment, count(*) AS cnt FROM fl WHERE segment IS NOT NULL GROUP BY segment)
SELECT (SELECT CAST(sum(cnt) AS BIGINT) FROM vc) AS count, (SELECT count(*) FROM vc) AS unique,
       segment AS top, cnt AS freq
FROM vc ORDER BY cnt DESC, segment ASC LIMIT 1"""


def _hist_edges() -> list[float]:
    e = [i * 0.5 for i in range(10)] + [float(x) for x in range(5, 10)]
    e += [float(x) for x in range(10, 20, 2)] + [float(x) for x in range(20, 32, 4)]
    return e + [32.0, 52.0, 72.0, 92.0]


def _hist_sql() -> str:
    e = _hist_edges()
    rows = ", ".join(f"({i}, {e[i]}, {e[i + 1]})" for i in range(len(e) - 1))
    last = len(e) - 2
    return with_("cohort") + f"""
, bins(bin, lo, hi) AS (VALUES {rows})
SELECT CAST(b.bin AS INTEGER) AS bin, CAST(b.lo AS DOUBLE) AS lo, CAST(b.hi AS DOUBLE) AS hi,
       count(c.los_days) AS count
FROM bins b LEFT JOIN cohort c
  ON c.los_days >= b.lo AND (c.los_days < b.hi OR (b.bin = {last} AND c.los_days = b.hi))
GROUP BY b.bin, b.lo, b.hi"""


ORACLE["histogram"] = _hist_sql()

ORACLE["mean_median"] = with_("cohort") + f"""
SELECT {r6('avg(los_days)', 'mean')}, {r6('quantile_cont(los_days, 0.5)', 'median')} FROM cohort"""


# --------------------------------------------------------------------------- codes group
CTE["cu"] = """cu AS (
  SELECT DISTINCT stay, path FROM (
    SELECT o.o_custkey AS stay, concat_ws('|', p.p_type, p.p_brand, p.p_name) AS path,
           (l.l_linenumber - 1) * 90 AS offset_min
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
         JOIN part p ON l.l_partkey = p.p_partkey
    UNION ALL
    SELECT c.c_custkey,
           CASE WHEN c.c_acctbal < 0
                THEN 'admission diagnosis|Additional APACHE  Information|Negative balance|' || r.r_name
                ELSE 'admission diagnosis|All Diagnosis|' || c.c_mktsegment || '|' || lower(c.c_mktsegment)
                     || '|' || n.n_name END,
           0
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
         JOIN region r ON n.n_regionkey = r.r_regionkey
    UNION ALL
    SELECT c.c_custkey,
           CASE WHEN c.c_acctbal > 9000 THEN 'notes/Other/unrouted'
                WHEN c.c_acctbal > 5000
                  THEN 'notes/Progress Notes/Past History/Past History Obtain Options/Performed'
                ELSE 'notes/Progress Notes/Past History/Organ Systems/' || r.r_name || '/' || n.n_name
                     || '/' || c.c_mktsegment END,
           c.c_nationkey * 20
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
         JOIN region r ON n.n_regionkey = r.r_regionkey) x
  WHERE offset_min < 300 AND stay IN (SELECT stay FROM cohort))"""
CTE["fam"] = """fam AS (
  SELECT DISTINCT path,
         CASE WHEN starts_with(path, 'notes/Progress Notes/Past History/Organ Systems/')
                THEN 'past_history_organ'
              WHEN starts_with(path, 'notes/Progress Notes/Past History/Past History Obtain Options')
                THEN 'past_history_options'
              WHEN starts_with(path, 'admission diagnosis') THEN 'admission'
              WHEN starts_with(path, 'notes') OR starts_with(path, 'admission') THEN 'other'
              ELSE 'main' END AS family
  FROM cu)"""
CTE["sp"] = """sp AS (
  SELECT path, family,
         CASE family
           WHEN 'main' THEN string_split(path, '|')
           WHEN 'admission' THEN string_split(replace(replace(replace(path, 'admission diagnosis|', ''),
                                  'All Diagnosis|', ''), 'Additional APACHE  Information|', ''), '|')
           WHEN 'past_history_organ' THEN
             string_split(replace(path, 'notes/Progress Notes/Past History/Organ Systems/', ''), '/')
           WHEN 'past_history_options' THEN
             string_split(replace(path, 'notes/Progress Notes/Past History/Past History Obtain Options/', ''), '/')
         END AS parts
  FROM fam WHERE family <> 'other')"""
CTE["sm"] = """sm AS (
  SELECT path, d AS depth, array_to_string(parts[1:d], '|') AS code, parts[d] AS leaf,
         CASE WHEN d > 1 THEN parts[d - 1] END AS parent_leaf
  FROM sp, generate_series(1, CASE WHEN len(parts) = 6 THEN 6 ELSE least(len(parts), 5) END) AS g(d))"""
CTE["stc"] = """stc AS (SELECT DISTINCT cu.stay, sm.code FROM cu JOIN sm ON cu.path = sm.path)"""
CTE["node"] = """node AS (
  SELECT code, count(DISTINCT path) AS n_strings, any_value(leaf) AS leaf,
         any_value(parent_leaf) AS parent_leaf
  FROM sm GROUP BY code)"""
CTE["pointless"] = """pointless AS (
  SELECT code, n_strings, 'counter' AS reason FROM node WHERE n_strings = 2
  UNION ALL
  SELECT code, n_strings, 'title_equals_parent' FROM node
  WHERE parent_leaf IS NOT NULL AND lower(leaf) = lower(parent_leaf))"""
CTE["prev"] = """prev AS (SELECT code, count(DISTINCT stay) AS n_stays FROM stc GROUP BY code)"""
CTE["rare"] = """rare AS (
  SELECT p.code, p.n_stays, c.cut_off
  FROM prev p CROSS JOIN (SELECT CAST(round_even(count(DISTINCT stay) * 0.01, 0) AS BIGINT) AS cut_off
                          FROM cu) c
  WHERE p.n_stays <= c.cut_off)"""
CTE["kept"] = """kept AS (
  SELECT stay, code FROM stc
  WHERE code NOT IN (SELECT code FROM pointless) AND code NOT IN (SELECT code FROM rare)
    AND stay IN (SELECT stay FROM sstays))"""
_ORDER[:] = list(CTE)

ORACLE["code_union"] = with_("cu") + "SELECT stay, path FROM cu"
ORACLE["prefix_family"] = with_("fam") + "SELECT path, family FROM fam"
ORACLE["code_prefixes"] = with_("stc") + "SELECT stay, code FROM stc"
ORACLE["code_prevalence"] = with_("prev") + "SELECT code, n_stays FROM prev"
ORACLE["pointless_codes"] = with_("pointless") + "SELECT code, n_strings, reason FROM pointless"
ORACLE["rare_codes"] = with_("rare") + "SELECT code, n_stays, cut_off FROM rare"
ORACLE["encode_codes"] = with_("kept") + "SELECT stay, code FROM kept"
ORACLE["codes_per_stay"] = with_("kept", "sstays") + """
SELECT s.stay, count(k.code) AS n_codes FROM sstays s LEFT JOIN kept k ON s.stay = k.stay GROUP BY s.stay"""
ORACLE["collect_codes"] = with_("kept") + """
SELECT stay, array_to_string(list_sort(list(DISTINCT code)), ';') AS codes FROM kept GROUP BY stay"""
ORACLE["group_rare_category"] = with_("fl") + """
, pairs AS (SELECT DISTINCT stay, nation AS category FROM fl WHERE nation IS NOT NULL)
, prev1 AS (SELECT category, count(DISTINCT stay) AS n FROM pairs GROUP BY category)
, rg AS (SELECT DISTINCT p.stay,
                CASE WHEN v.n <= 5 THEN 'grouped_' || regexp_extract(p.category, '^[^ /,]*', 0)
                     ELSE p.category END AS category
         FROM pairs p JOIN prev1 v ON p.category = v.category)
SELECT category, stay FROM rg
WHERE category IN (SELECT category FROM rg GROUP BY category HAVING count(DISTINCT stay) > 5)"""
ORACLE["merge_rare_columns"] = with_("fl") + """
, oh AS (SELECT e.stay, 'nation_' || v.nation AS feature,
                CASE WHEN e.nation = v.nation THEN 1 ELSE 0 END AS value
         FROM fl e CROSS JOIN (SELECT DISTINCT nation FROM fl WHERE nation IS NOT NULL) v)
, m AS (SELECT 'nation_' || n.n_name AS feature, 'region_' || r.r_name AS grp
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT oh.stay, coalesce(m.grp, oh.feature) AS feature, CAST(sum(oh.value) AS BIGINT) AS value
FROM oh LEFT JOIN m ON oh.feature = m.feature
GROUP BY oh.stay, coalesce(m.grp, oh.feature)"""


# --------------------------------------------------------------------------- split / sequences
CTE["shuf"] = """shuf AS (
  SELECT stay, row_number() OVER (ORDER BY md5('9' || CAST(stay AS VARCHAR)), stay) AS "order"
  FROM (SELECT DISTINCT stay FROM cohort) x)"""
CTE["hrs"] = """hrs AS (
  SELECT stay, time, sum(value) AS value_sum, min(value) AS value_min, max(value) AS value_max,
         count(*) FILTER (WHERE mask = 1.0) AS n_observed,
         row_number() OVER (PARTITION BY stay ORDER BY time) - 1 AS pos,
         count(*) OVER (PARTITION BY stay) AS len
  FROM encoded GROUP BY stay, time)"""
CTE["lab01"] = """lab01 AS (
  SELECT stay, los_days, CASE WHEN mortality = 'EXPIRED' THEN 1 ELSE 0 END AS mortality FROM cohort)"""
CTE["batches"] = """batches AS (SELECT stay, CAST(floor(("order" - 1) / 16) AS BIGINT) AS batch FROM shuf)"""
_ORDER[:] = list(CTE)

ORACLE["split_by_entity"] = """
WITH p AS (SELECT DISTINCT o_custkey AS person FROM orders),
r AS (SELECT person, row_number() OVER (ORDER BY md5('9' || CAST(person AS VARCHAR)), person) AS rk,
             count(*) OVER () AS n FROM p),
c AS (SELECT DISTINCT n, CAST(ceil(CAST(0.15 AS DOUBLE) * n) AS BIGINT) AS n_test FROM r),
c2 AS (SELECT n, n_test,
              CAST(ceil(CAST(0.15 AS DOUBLE) / (CAST(1.0 AS DOUBLE) - CAST(0.15 AS DOUBLE))
                        * CAST(n - n_test AS DOUBLE)) AS BIGINT) AS n_val FROM c)
SELECT o.o_orderkey AS stay, o.o_custkey AS person,
       CASE WHEN r.rk <= c2.n_test THEN 'test' WHEN r.rk <= c2.n_test + c2.n_val THEN 'val'
            ELSE 'train' END AS split
FROM orders o JOIN r ON o.o_custkey = r.person CROSS JOIN c2"""

ORACLE["shuffle_stays"] = with_("shuf") + 'SELECT stay, "order" FROM shuf'

ORACLE["sample_stays"] = with_("shuf") + """
SELECT stay FROM shuf WHERE "order" <= (SELECT round_even(count(*) * 0.3, 0) FROM shuf)"""

ORACLE["sample_tables"] = with_("shuf", "fl") + """
SELECT stay, nation, segment FROM fl
WHERE stay IN (SELECT stay FROM shuf WHERE "order" <= (SELECT round_even(count(*) * 0.3, 0) FROM shuf))"""

ORACLE["seq_length"] = with_("encoded") + """
SELECT stay, count(DISTINCT time) AS length FROM encoded GROUP BY stay"""

ORACLE["skip_first_rows"] = with_("hrs") + "SELECT stay, time, pos FROM hrs WHERE pos >= 5"

ORACLE["remaining_los"] = with_("hrs", "lab01") + f"""
SELECT h.stay, h.time, {r6('greatest(l.los_days - h.time / 24.0, 1.0 / 48.0)', 'los_remaining')}
FROM hrs h JOIN lab01 l ON h.stay = l.stay WHERE h.pos >= 5"""

ORACLE["mortality_at_index"] = with_("hrs", "lab01") + """
SELECT h.stay, h.time, l.mortality FROM hrs h JOIN lab01 l ON h.stay = l.stay WHERE h.pos = 29"""

ORACLE["assemble_sequences"] = with_("encoded", "hrs") + f"""
SELECT e.stay, h.len AS length, h.pos, e.time, {r6('e.hour', 'hour')}, e.feature, {r6('e.value', 'value')}, {r6('e.mask', 'mask')}
FROM encoded e JOIN hrs h ON e.stay = h.stay AND e.time = h.time"""

ORACLE["assign_batch"] = with_("batches") + "SELECT stay, batch FROM batches"

ORACLE["pad_sequences"] = with_("batches", "encoded", "hrs", "vocab") + f"""
, len AS (SELECT DISTINCT stay, len AS length FROM hrs)
, pl AS (SELECT l.stay, b.batch, l.length, max(l.length) OVER (PARTITION BY b.batch) AS padded_length
         FROM len l JOIN batches b ON l.stay = b.stay)
SELECT p.stay, p.batch, p.length, p.padded_length, h.pos, {r6('e.time / 24.0', 'time')}, {r6('e.hour', 'hour')},
       CAST(1 AS INTEGER) AS valid, e.feature, {r6('e.value', 'value')}, {r6('e.mask', 'mask')}
FROM pl p JOIN hrs h ON p.stay = h.stay JOIN encoded e ON e.stay = h.stay AND e.time = h.time
UNION ALL
SELECT p.stay, p.batch, p.length, p.padded_length, z.pos, 0.0, 0.0, 0, v.feature, 0.0, 0.0
FROM pl p, unnest(range(p.length, p.padded_length)) AS z(pos), vocab v"""

ORACLE["training_rows"] = with_("hrs", "lab01", "encoded", "kept") + f"""
, codes AS (SELECT stay, count(*) AS n_codes, string_agg(code, ';' ORDER BY code) AS codes FROM (SELECT DISTINCT stay, code FROM kept) GROUP BY stay)
SELECT h.stay, h.time, {r6('e.hour', 'hour')}, {r6('greatest(l.los_days - h.time / 24.0, 1.0 / 48.0)', 'los_remaining')},
       l.mortality, h.len - 5 AS length_minus_skip, n.n_name AS nation, c.c_mktsegment AS segment,
       coalesce(k.n_codes, 0) AS n_codes, coalesce(k.codes, '') AS codes,
       e.feature, {r6('e.value', 'value')}, {r6('e.mask', 'mask')}
FROM hrs h JOIN lab01 l ON h.stay = l.stay JOIN encoded e ON e.stay = h.stay AND e.time = h.time
JOIN customer c ON c.c_custkey = h.stay JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN codes k ON k.stay = h.stay
WHERE h.pos >= 5"""

ORACLE["fraction_of_batches"] = with_("batches") + """
SELECT stay, batch FROM batches
WHERE batch <= floor((SELECT count(DISTINCT batch) FROM batches) / (100.0 / 50.0))"""


# --------------------------------------------------------------------------- metrics group
CTE["lp"] = """lp AS (
  SELECT o.o_orderkey AS id, o.o_custkey AS stay, q.qty / 10.0 AS y_true,
         o.o_totalprice / 40000.0 AS y_pred
  FROM orders o JOIN (SELECT l_orderkey, sum(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey) q
    ON o.o_orderkey = q.l_orderkey)"""
CTE["rp"] = """rp AS (
  SELECT l.doc_id, d.source, CAST(l.toxic AS DOUBLE) AS y_true,
         1.0 / (1.0 + exp(-(ln(d.n_chars + 1.0) - 7.0))) AS p
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""
_ORDER[:] = list(CTE)


def sql_bin(x: str) -> str:
    edges = (1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 14.0)
    parts = " ".join(f"WHEN {x} < {e} THEN {i}" for i, e in enumerate(edges))
    return f"(CASE WHEN {x} IS NULL THEN NULL {parts} ELSE {len(edges)} END)"


def sql_regression(src: str, by: str | None = None) -> str:
    """Regression report over ``src(y_true, y_pred[, by])`` as CTEs + final SELECT."""
    g = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    on = lambda a, b: f" AND {a}.{by} = {b}.{by}" if by else ""
    grp = f"GROUP BY {by}" if by else ""
    return f"""
, rb AS (SELECT {g}y_true, y_pred, {sql_bin('y_true')} AS bt, {sql_bin('y_pred')} AS bp FROM {src})
, pres AS (SELECT {g}bin, dense_rank() OVER ({part}ORDER BY bin) - 1 AS idx
           FROM (SELECT {g}bt AS bin FROM rb UNION SELECT {g}bp FROM rb) u)
, cm AS (SELECT {g}bt, bp, count(*) AS n FROM rb GROUP BY {g}bt, bp)
, cmi AS (SELECT cm.*, it.idx AS i, ip.idx AS j FROM cm
          JOIN pres it ON cm.bt = it.bin{on('cm', 'it')} JOIN pres ip ON cm.bp = ip.bin{on('cm', 'ip')})
, ko AS (SELECT {g}sum(abs(i - j) * n) AS wo, sum(n) AS total FROM cmi {grp})
, kr AS (SELECT {g}i, sum(n) AS ri FROM cmi GROUP BY {g}i)
, kc AS (SELECT {g}j, sum(n) AS cj FROM cmi GROUP BY {g}j)
, ke AS (SELECT {'kr.' + by + ', ' if by else ''}sum(abs(kr.i - kc.j) * kr.ri * kc.cj) AS we_n
         FROM kr {'JOIN kc ON kr.' + by + ' = kc.' + by if by else 'CROSS JOIN kc'} {('GROUP BY kr.' + by) if by else ''})
, kap AS (SELECT {'ko.' + by + ', ' if by else ''}
                 1.0 - CAST(ko.wo AS DOUBLE) / (CAST(ke.we_n AS DOUBLE) / ko.total) AS kappa
          FROM ko {'JOIN ke ON ko.' + by + ' = ke.' + by if by else 'CROSS JOIN ke'})
, base AS (SELECT {g}avg(abs(y_true - y_pred)) AS mad, avg((y_true - y_pred) * (y_true - y_pred)) AS mse,
                  avg(abs(y_true - y_pred) / greatest(CAST(4.0 AS DOUBLE) / 24.0, y_true)) * 100.0 AS mape,
                  avg(ln(y_true / y_pred) * ln(y_true / y_pred)) AS msle,
                  sum((y_true - y_pred) * (y_true - y_pred)) AS ss_res,
                  var_pop(y_true) * count(y_true) AS ss_tot
           FROM {src} {grp})
SELECT {'base.' + by + ', ' if by else ''}{r6('mad', 'mad')}, {r6('mse', 'mse')}, {r6('mape', 'mape')},
       {r6('msle', 'msle')},
       {r6('CASE WHEN ss_tot = 0 THEN (CASE WHEN ss_res = 0 THEN 1.0 ELSE 0.0 END) ELSE 1.0 - ss_res / ss_tot END', 'r2')},
       {r6('kappa', 'kappa')}
FROM base {'JOIN kap ON base.' + by + ' = kap.' + by if by else 'CROSS JOIN kap'}"""


ORACLE["regression_report"] = with_("lp") + sql_regression("lp")

ORACLE["binned_confusion"] = with_("lp") + f"""
SELECT {sql_bin('y_true')} AS bin_true, {sql_bin('y_pred')} AS bin_pred, count(*) AS count
FROM lp GROUP BY 1, 2"""

ORACLE["linear_kappa"] = (with_("lp") + sql_regression("lp").split("\nSELECT ")[0]
                          + f"\nSELECT {r6('kappa', 'kappa')} FROM kap")

_CONF = """
SELECT sum(CASE WHEN y_true = 0 AND p <= 0.5 THEN 1 ELSE 0 END) AS tn,
       sum(CASE WHEN y_true = 0 AND p > 0.5 THEN 1 ELSE 0 END) AS fp,
       sum(CASE WHEN y_true = 1 AND p <= 0.5 THEN 1 ELSE 0 END) AS fn,
       sum(CASE WHEN y_true = 1 AND p > 0.5 THEN 1 ELSE 0 END) AS tp
FROM rp"""
ORACLE["binary_confusion"] = "SELECT CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, " \
    "CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp FROM (" + with_("rp") + _CONF + ") x"

_CURVE = """
, st AS (SELECT p AS score, sum(CASE WHEN y_true = 1 THEN 1 ELSE 0 END) AS pos,
                sum(CASE WHEN y_true = 0 THEN 1 ELSE 0 END) AS neg
         FROM rp GROUP BY p)
, cu2 AS (SELECT score, pos, neg,
                 sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
                 sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp
          FROM st)
, tot AS (SELECT CAST(sum(pos) AS DOUBLE) AS "P", CAST(sum(neg) AS DOUBLE) AS "N" FROM st)
, curve AS (
  SELECT sum((fp - (fp - neg)) / "N" * (tp + (tp - pos)) / "P" / 2.0) AS auroc,
         sum((tp - (tp - pos)) / "P" *
             (tp / (tp + fp) + CASE WHEN (tp - pos) + (fp - neg) = 0 THEN 1.0
                                    ELSE (tp - pos) / ((tp - pos) + (fp - neg)) END) / 2.0) AS auprc
  FROM cu2 CROSS JOIN tot)"""

ORACLE["auroc_auprc"] = with_("rp") + _CURVE + f"""
SELECT {r6('auroc', 'auroc')}, {r6('auprc', 'auprc')} FROM curve"""

ORACLE["classification_report"] = with_("rp") + _CURVE + f"""
, cf AS (SELECT CAST(tn AS DOUBLE) AS tn, CAST(fp AS DOUBLE) AS fp, CAST(fn AS DOUBLE) AS fn,
                CAST(tp AS DOUBLE) AS tp FROM ({_CONF}) x)
SELECT {r6('(tn + tp) / (tn + fp + fn + tp)', 'accuracy')},
       {r6('CASE WHEN tn + fn = 0 THEN NULL ELSE tn / (tn + fn) END', 'prec0')},
       {r6('CASE WHEN tp + fp = 0 THEN NULL ELSE tp / (tp + fp) END', 'prec1')},
       {r6('CASE WHEN tn + fp = 0 THEN NULL ELSE tn / (tn + fp) END', 'rec0')},
       {r6('CASE WHEN tp + fn = 0 THEN NULL ELSE tp / (tp + fn) END', 'rec1')},
       {r6('((CASE WHEN 2 * tn + fn + fp = 0 THEN 0.0 ELSE 2 * tn / (2 * tn + fn + fp) END) + '
           '(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END)) / 2.0',
           'f1_macro')},
       {r6('auroc', 'auroc')}, {r6('auprc', 'auprc')}
FROM cf CROSS JOIN curve"""

ORACLE["sequence_msle_loss"] = with_("lp") + f"""
SELECT {r6('avg(l)', 'loss')} FROM (
  SELECT stay, sum((ln(y_pred) - ln(y_true)) * (ln(y_pred) - ln(y_true))) AS l FROM lp GROUP BY stay) x"""

ORACLE["sequence_mse_loss"] = with_("lp") + f"""
SELECT {r6('avg(l / greatest(n, 1))', 'loss')} FROM (
  SELECT stay, sum((y_pred - y_true) * (y_pred - y_true)) AS l, count(*) AS n FROM lp GROUP BY stay) x"""

_BCE = ("avg(-(y_true * coalesce(greatest(ln(p), -100.0), -100.0) + "
        "(1.0 - y_true) * coalesce(greatest(ln(1.0 - p), -100.0), -100.0)))")

ORACLE["bce_loss"] = with_("rp") + f"SELECT {r6(_BCE, 'bce')} FROM rp"

ORACLE["multitask_loss"] = with_("lp", "rp") + f"""
, a AS (SELECT avg(l) AS loss FROM (
          SELECT stay, sum((ln(y_pred) - ln(y_true)) * (ln(y_pred) - ln(y_true))) AS l
          FROM lp GROUP BY stay) x)
, b AS (SELECT {_BCE} * 100.0 AS bce FROM rp)
SELECT {r6('loss', 'loss')}, {r6('bce', 'bce')}, {r6('loss + bce', 'total')} FROM a CROSS JOIN b"""

ORACLE["mean_loss"] = with_("lp") + f"""
, o AS (SELECT stay, row_number() OVER (ORDER BY md5('9' || CAST(stay AS VARCHAR)), stay) AS rk
        FROM (SELECT DISTINCT stay FROM lp) s)
, per AS (SELECT CAST(floor((o.rk - 1) / 16) AS BIGINT) AS batch, lp.stay,
                 sum((ln(y_pred) - ln(y_true)) * (ln(y_pred) - ln(y_true))) AS l
          FROM lp JOIN o ON lp.stay = o.stay GROUP BY 1, 2)
, pb AS (SELECT batch, avg(l) AS bl FROM per GROUP BY batch)
SELECT {r6('avg(bl)', 'mean_loss')}, count(*) AS n_batches FROM pb"""

ORACLE["constant_baseline"] = with_("lp") + """
, pr AS (SELECT person, row_number() OVER (ORDER BY md5('9' || CAST(person AS VARCHAR)), person) AS rk,
                count(*) OVER () AS n FROM (SELECT DISTINCT stay AS person FROM lp) s)
, c AS (SELECT DISTINCT n, CAST(ceil(CAST(0.15 AS DOUBLE) * n) AS BIGINT) AS n_test FROM pr)
, c2 AS (SELECT n, n_test, CAST(ceil(CAST(0.15 AS DOUBLE) / (CAST(1.0 AS DOUBLE) - CAST(0.15 AS DOUBLE))
                                   * CAST(n - n_test AS DOUBLE)) AS BIGINT) AS n_val FROM c)
, sp2 AS (SELECT lp.*, CASE WHEN pr.rk <= c2.n_test THEN 'test' WHEN pr.rk <= c2.n_test + c2.n_val
                            THEN 'val' ELSE 'train' END AS split
          FROM lp JOIN pr ON lp.stay = pr.person CROSS JOIN c2)
, mm AS (SELECT avg(y_true) AS m, quantile_cont(y_true, 0.5) AS md FROM sp2 WHERE split = 'train')
, rows2 AS (SELECT 'mean' AS predictor, y_true, mm.m AS y_pred FROM sp2 CROSS JOIN mm WHERE split = 'test'
            UNION ALL
            SELECT 'median', y_true, mm.md FROM sp2 CROSS JOIN mm WHERE split = 'test')""" + \
    sql_regression("rows2", by="predictor")


# --------------------------------------------------------------------------- model-adjacent group
CTE["attr"] = """attr AS (SELECT stay, time, feature, value, value * mask AS attribution FROM encoded)"""
CTE["pstay"] = """pstay AS (
  SELECT a.stay, a.feature,
         CASE WHEN count(CASE WHEN a.value <> 0 THEN 1 END) = 0 THEN NULL
              ELSE sum(abs(a.attribution)) / count(CASE WHEN a.value <> 0 THEN 1 END) END AS mean_abs
  FROM attr a JOIN hrs h ON a.stay = h.stay AND a.time = h.time
  WHERE h.pos < 23 AND a.stay IN (SELECT stay FROM hrs WHERE pos = 23)
  GROUP BY a.stay, a.feature)"""
_ORDER[:] = list(CTE)

ORACLE["causal_lag_features"] = with_("encoded") + f"""
SELECT stay, time, feature,
       {r6('0.5 * value + 0.3 * lag(value, 2, 0.0) OVER w + 0.2 * lag(value, 4, 0.0) OVER w', 'conv')}
FROM encoded WINDOW w AS (PARTITION BY stay, feature ORDER BY time)"""

ORACLE["per_stay_attribution"] = with_("pstay") + f"""
SELECT stay, feature, {r6('mean_abs', 'mean_abs')} FROM pstay"""

ORACLE["attribution_summary"] = with_("pstay") + f"""
, cl AS (SELECT stay, feature, CASE WHEN mean_abs IS NULL THEN NULL
                                    ELSE greatest(-3.0, least(3.0, mean_abs)) END AS v FROM pstay)
, keep AS (SELECT feature FROM cl GROUP BY feature HAVING coalesce(sum(v), 0.0) <> 0)
SELECT feature, {r6('avg(abs(coalesce(v, 0.0)))', 'importance')}
FROM cl WHERE feature IN (SELECT feature FROM keep)
GROUP BY feature ORDER BY avg(abs(coalesce(v, 0.0))) DESC, feature LIMIT 25"""

ORACLE["drop_zero_total_features"] = with_("pstay") + f"""
SELECT stay, feature, {r6('mean_abs', 'mean_abs')} FROM pstay
WHERE feature IN (SELECT feature FROM pstay GROUP BY feature HAVING sum(mean_abs) <> 0)"""

ORACLE["single_stay_profile"] = with_("attr") + f"""
, top AS (SELECT stay FROM (SELECT stay, count(DISTINCT time) AS n FROM attr GROUP BY stay) x
          ORDER BY n DESC, stay LIMIT 1)
, feats AS (SELECT DISTINCT feature FROM attr ORDER BY feature LIMIT 6)
SELECT time, feature, {r6('value', 'value')}, {r6('attribution', 'attribution')}
FROM attr WHERE stay IN (SELECT stay FROM top) AND feature IN (SELECT feature FROM feats)"""

ORACLE["score_sequences"] = with_("hrs") + f"""
SELECT stay, time, {r6('greatest(1.0 / 48.0, least(100.0, exp(0.5 + 0.01 * value_sum)))', 'y_pred')}
FROM hrs WHERE pos >= 5"""


def _perm_sql(cols=("x1", "x2"), repeats=3, seed=0) -> str:
    base = """WITH pf AS (
  SELECT o.o_orderkey AS id, q.x1, o.o_totalprice AS x2, q.x1 / 10.0 AS y_true
  FROM orders o JOIN (SELECT l_orderkey, sum(l_quantity) AS x1 FROM lineitem GROUP BY l_orderkey) q
    ON o.o_orderkey = q.l_orderkey)
, pos AS (SELECT id, row_number() OVER (ORDER BY id) AS p FROM pf)
, b AS (SELECT -avg((y_true - (0.05 * x1 + x2 / 80000.0)) * (y_true - (0.05 * x1 + x2 / 80000.0))) AS base
        FROM pf)"""
    parts = []
    for c in cols:
        for r in range(repeats):
            other = "x2" if c == "x1" else "x1"
            tag = f"{seed}|{r}|{c}|"
            parts.append(f"""
  SELECT '{c}' AS feature, {r} AS rep, -avg((y_true - (0.05 * x1 + x2 / 80000.0))
                                          * (y_true - (0.05 * x1 + x2 / 80000.0))) AS score
  FROM (SELECT pf.id, pf.y_true, pf.{other}, hv.v AS {c}
        FROM pf JOIN pos ON pf.id = pos.p_id
        JOIN (SELECT {c} AS v, row_number() OVER (ORDER BY md5('{tag}' || CAST(id AS VARCHAR)), id) AS hr
              FROM pf) hv ON hv.hr = pos.p) z""")
    body = "\nUNION ALL".join(parts).replace("pos.p_id", "pos.id")
    return base + f"""
, sc AS ({body})
SELECT feature, {r6('avg(base - score)', 'importance_mean')}, {r6('stddev_pop(base - score)', 'importance_std')}
FROM sc CROSS JOIN b GROUP BY feature"""


ORACLE["permutation_importance"] = _perm_sql()


# --------------------------------------------------------------------------- remaining operators
ORACLE["drop_shadowed_features"] = with_("win", "vocab") + f"""
SELECT stay, offset_min, feature, {r6('value', 'value')} FROM win
WHERE feature NOT IN (SELECT feature FROM vocab UNION SELECT feature || ' (serum)' FROM vocab)
  AND feature NOT IN ('view_0', 'view_1')"""

ORACLE["drop_feature_list"] = with_("win") + f"""
SELECT stay, offset_min, feature, {r6('value', 'value')} FROM win
WHERE feature NOT IN ('error_0', 'error_1', 'error_2')"""

ORACLE["select_feature_subset"] = with_("encoded") + f"""
SELECT stay, time, feature, {r6('value', 'value')}, {r6('mask', 'mask')} FROM encoded
WHERE feature IN ({', '.join(f"'click_{i}'" for i in range(10))})"""

ORACLE["drop_mask_features"] = with_("encoded") + f"""
SELECT stay, time, feature, {r6('value', 'value')} FROM encoded"""

ORACLE["like_search"] = with_("win") + f"""
SELECT feature, count(DISTINCT stay) AS n_stays, {r6('avg(value)', 'mean_value')}
FROM win WHERE contains(lower(feature), 'purchase') GROUP BY feature"""

ORACLE["hour_diff_elapsed"] = with_("cohort") + """
SELECT e.event_id, e.user_id AS stay FROM events e JOIN cohort c ON e.user_id = c.stay
WHERE floor((epoch_us(e.ts) - epoch_us(c.admit_ts)) / 3600000000.0) BETWEEN -24 AND 5"""

ORACLE["hour_diff_clock"] = with_("cohort") + """
SELECT e.event_id, e.user_id AS stay FROM events e JOIN cohort c ON e.user_id = c.stay
WHERE hour(e.ts) - hour(c.admit_ts) BETWEEN -24 AND 5"""

_TYPES = ("click", "view", "purchase", "signup", "error")
ORACLE["pivot_mean"] = with_("win") + "SELECT stay, offset_min, " + ", ".join(
    r6(f"avg(CASE WHEN split_part(feature, '_', 1) = '{t}' THEN value END)", t) for t in _TYPES) + \
    "\nFROM win GROUP BY stay, offset_min"

_EXTRA = ("click_0", "view_1", "purchase_2", "signup_3", "error_4")
ORACLE["extra_vars"] = with_("win") + "SELECT stay, " + ", ".join(
    r6(f"avg(CASE WHEN feature = '{t}' THEN value END)", t) for t in _EXTRA) + \
    f"\nFROM win WHERE feature IN ({', '.join(repr(t) for t in _EXTRA)}) GROUP BY stay"

_LINE = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_LINE_LONG = "\nUNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, '{c}' AS feature, {c} AS value FROM lineitem" for c in _LINE)

ORACLE["unpivot_wide"] = f"""
SELECT l_orderkey, l_linenumber, feature, {r6('value', 'value')} FROM ({_LINE_LONG}) x"""

ORACLE["row_sum_score"] = f"""
WITH ll AS ({_LINE_LONG})
SELECT l_orderkey, l_linenumber, feature, {r6('value', 'value')} FROM ll
WHERE feature NOT IN ('l_discount', 'l_tax')
UNION ALL
SELECT l_orderkey, l_linenumber, 'charge_score',
       {r6("CASE WHEN sum(coalesce(value, 0.0)) = 0 THEN NULL ELSE sum(coalesce(value, 0.0)) END", 'value')}
FROM ll WHERE feature IN ('l_discount', 'l_tax') GROUP BY l_orderkey, l_linenumber"""

ORACLE["coerce_numeric"] = f"""
WITH t AS (
  SELECT event_id, user_id AS stay, event_type AS feature,
         CASE WHEN event_type = 'error' THEN 'n/a'
              WHEN event_type = 'click'
                THEN CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR) || '%'
              ELSE CAST(value AS VARCHAR) END AS value_text
  FROM events)
SELECT event_id, stay, feature, {r6("TRY_CAST(replace(value_text, '%', '') AS DOUBLE)", 'value')}
FROM t WHERE TRY_CAST(replace(value_text, '%', '') AS DOUBLE) IS NOT NULL"""

ORACLE["assign_chunk"] = with_("cohort") + """
SELECT stay, CAST(floor((row_number() OVER (ORDER BY stay) - 1) / 16) AS BIGINT) AS chunk
FROM (SELECT DISTINCT stay FROM cohort) x"""

ORACLE["vocab_order"] = with_("vocab") + """
SELECT feature, n_stays, row_number() OVER (ORDER BY n_stays DESC, feature) AS rank FROM vocab"""

ORACLE["lexical_order"] = with_("sm", "sp") + """
, cf AS (SELECT DISTINCT sm.code,
                CASE sp.family WHEN 'main' THEN 0 WHEN 'admission' THEN 1
                               WHEN 'past_history_organ' THEN 2 ELSE 3 END AS family_rank
         FROM sm JOIN sp ON sm.path = sp.path)
SELECT code, family_rank, row_number() OVER (ORDER BY family_rank, code) AS code_id FROM cf"""

ORACLE["remove_padding"] = with_("encoded", "hrs") + f"""
SELECT e.stay, h.pos, {r6('e.time / 24.0', 'time')}, {r6('e.hour', 'hour')}, e.feature, {r6('e.value', 'value')}, {r6('e.mask', 'mask')}
FROM encoded e JOIN hrs h ON e.stay = h.stay AND e.time = h.time"""

ORACLE["cohort_anchor_age"] = with_("stays") + f"""
SELECT stay, person, {r6('los_days', 'los_days')} FROM stays
WHERE los_days > 5.0 / 24.0 AND year(admit_ts) - (2021 + person % 7) + person + 5 > 17"""

ORACLE["union_all"] = """
SELECT c_custkey AS id, c_nationkey AS nation, c_mktsegment FROM customer
UNION ALL SELECT s_suppkey, s_nationkey, NULL FROM supplier"""

ORACLE["display_name"] = """
SELECT CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Cars' WHEN 'BUILDING' THEN 'Construction' ELSE c_mktsegment END AS segment,
       count(*) AS n FROM customer GROUP BY 1"""

ORACLE["dropped_families"] = """
SELECT count(DISTINCT CASE WHEN c_custkey % 3 = 0 THEN 'notes/Other/' ELSE 'admission other|' END || c_mktsegment) AS n_strings,
       count(*) AS n_pairs FROM customer WHERE c_custkey % 3 <> 2"""

ORACLE["encode_labels_flag"] = with_("lab01") + f"""
SELECT stay, {r6('los_days', 'los_days')}, mortality FROM lab01"""

ORACLE["outer_join_codes"] = with_("kept", "sm", "sp") + """
, cf AS (SELECT DISTINCT sm.code, sp.family FROM sm JOIN sp ON sm.path = sp.path)
, k AS (SELECT kept.stay, kept.code, cf.family FROM kept JOIN cf ON kept.code = cf.code)
, a AS (SELECT stay, count(*) AS n_main FROM k WHERE family = 'main' GROUP BY stay)
, b AS (SELECT stay, count(*) AS n_other FROM k WHERE family <> 'main' GROUP BY stay)
SELECT coalesce(a.stay, b.stay) AS stay, coalesce(a.n_main, 0) AS n_main, coalesce(b.n_other, 0) AS n_other
FROM a FULL OUTER JOIN b ON a.stay = b.stay"""

ORACLE["item_lookup"] = """
SELECT l.l_orderkey, l.l_linenumber, p.p_name AS label
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""

ORACLE["scan_head"] = """
SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 500"""

ORACLE["slice_rows"] = """
SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 1000 OFFSET 300"""


# --------------------------------------------------------------------------- offsets, scalars, wide sink
_OR = "TIMESTAMP '2024-01-02 00:00:00'"
ORACLE["time_window_offsets"] = with_("ev", "cohort") + f"""
, eo AS (SELECT stay, CAST(floor((epoch_us(ts) - epoch_us({_OR})) / 60000000.0) AS BIGINT) AS offset_min,
                feature, value FROM ev)
, so AS (SELECT stay, CAST(floor((epoch_us(discharge_ts) - epoch_us({_OR})) / 60000000.0) AS BIGINT)
                AS discharge_offset FROM cohort)
SELECT e.stay, e.offset_min, e.feature, {r6('e.value', 'value')}
FROM eo e JOIN so s ON e.stay = s.stay
WHERE e.offset_min >= -1440 AND e.offset_min <= s.discharge_offset"""

ORACLE["scalar_functions"] = with_("flat") + f"""
SELECT s.stay,
       hour(strptime(strftime(s.admit_ts, '%H:%M:%S'), '%H:%M:%S')) AS clock_hour,
       hour(s.discharge_ts) AS ts_hour, year(s.admit_ts) AS ts_year,
       {r6('((s.discharge_offset % 24 + 24) % 24) / 23.0', 'cyclic')},
       regexp_extract(f.nation, '^[^ /,]*', 0) AS first_word,
       CASE WHEN lower(f.segment) = lower('building') THEN 1 ELSE 0 END AS is_building,
       CAST(round_even(s.los_days, 0) AS BIGINT) AS los_rounded,
       {r6('least(greatest(exp(s.los_days / 10.0), 1.0 / 48.0), 100.0)', 'los_link')},
       {r6('1.0 / (1.0 + exp(-(s.los_days - 15.0)))', 'risk')},
       {r6('nullif(CAST(floor(s.los_days) AS BIGINT) % 3, 0)', 'zero_null')},
       {r6('coalesce(CASE WHEN isnan(f.height) THEN NULL ELSE f.height END, 0.0)', 'height0')},
       CASE WHEN s.person % 2 <> 0 THEN 1 ELSE 0 END AS odd_person,
       CASE WHEN f.height IS NULL THEN 1 ELSE 0 END AS no_height,
       {r6('coalesce(f.height, -1.0)', 'height_filled')},
       CASE f.segment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 ELSE 0 END AS seg_code,
       {sql_bin('s.los_days')} AS los_bin
FROM stays s JOIN flat f ON s.stay = f.stay"""

ORACLE["to_wide"] = with_("encoded") + f"""
SELECT stay, time, {r6('hour', 'hour')}, feature, {r6('value', 'value')}, {r6('mask', 'mask')} FROM encoded"""

ORACLE["stream_encode"] = ORACLE["encode_timeseries"]

ORACLE["split_by_hash"] = """
SELECT o_orderkey AS stay, o_custkey AS person,
       CASE WHEN u < 0.15 THEN 'test' WHEN u < 0.15 + 0.15 THEN 'val' ELSE 'train' END AS split
FROM (SELECT o_orderkey, o_custkey,
             CAST(CAST('0x' || substr(md5('9' || CAST(o_custkey AS VARCHAR)), 1, 8) AS BIGINT) AS DOUBLE)
               / 4294967296.0 AS u
      FROM orders) x"""

ORACLE["quantile_fit_train_split"] = with_("vocab", "src") + f"""
, pr AS (SELECT person, row_number() OVER (ORDER BY md5('9' || CAST(person AS VARCHAR)), person) AS rk,
                count(*) OVER () AS n FROM (SELECT DISTINCT person FROM cohort) p)
, c AS (SELECT DISTINCT n, CAST(ceil(CAST(0.15 AS DOUBLE) * n) AS BIGINT) AS n_test FROM pr)
, c2 AS (SELECT n, n_test, CAST(ceil(CAST(0.15 AS DOUBLE) / (CAST(1.0 AS DOUBLE) - CAST(0.15 AS DOUBLE))
                                   * CAST(n - n_test AS DOUBLE)) AS BIGINT) AS n_val FROM c)
, train AS (SELECT co.stay FROM cohort co JOIN pr ON co.person = pr.person CROSS JOIN c2
            WHERE pr.rk > c2.n_test + c2.n_val)
, qf AS (SELECT feature, quantile_cont(value, 0.05) AS q_lo, quantile_cont(value, 0.95) AS q_hi
         FROM src WHERE value IS NOT NULL AND feature IN (SELECT feature FROM vocab)
           AND stay IN (SELECT stay FROM train)
         GROUP BY feature)
SELECT v.feature, v.n_stays, {r6('qf.q_lo', 'q_lo')}, {r6('qf.q_hi', 'q_hi')}
FROM vocab v LEFT JOIN qf ON v.feature = qf.feature"""


# --------------------------------------------------------------------------- whole tables, layouts and sinks
def _describe_sql() -> str:
    parts = []
    for c in ("height", "weight", "hour", "balance_after_24h"):
        v = f"CAST({c} AS DOUBLE)"
        stats = ", ".join(r6(e, n) for e, n in (
            (f"avg({v})", "mean"), (f"stddev_samp({v})", "std"), (f"min({v})", "min"), (f"quantile_cont({v}, 0.25)", "p25"),
            (f"quantile_cont({v}, 0.5)", "p50"), (f"quantile_cont({v}, 0.75)", "p75"), (f"max({v})", "max")))
        parts.append(f"""SELECT '{c}' AS "column", count({c}) AS count, CAST(NULL AS BIGINT) AS n_unique,
  CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, {stats} FROM fl""")
    nulls = ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in ("mean", "std", "min", "p25", "p50", "p75", "max"))
    for c in ("gender", "teachingstatus", "nation", "region", "segment", "age"):
        parts.append(f"""SELECT '{c}', count({c}), count(DISTINCT {c}),
  (SELECT {c} FROM fl WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1),
  (SELECT count(*) FROM fl WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1), {nulls} FROM fl""")
    return with_("fl") + "\nUNION ALL ".join(parts)


ORACLE["describe_all"] = _describe_sql()


def _split_sql(src: str, person: str) -> str:
    return f"""pr AS (SELECT person, row_number() OVER (ORDER BY md5('9' || CAST(person AS VARCHAR)), person) AS rk,
                count(*) OVER () AS n FROM (SELECT DISTINCT {person} AS person FROM {src}) s)
, c1 AS (SELECT DISTINCT n, CAST(ceil(CAST(0.15 AS DOUBLE) * n) AS BIGINT) AS n_test FROM pr)
, c2 AS (SELECT n, n_test, CAST(ceil(CAST(0.15 AS DOUBLE) / (CAST(1.0 AS DOUBLE) - CAST(0.15 AS DOUBLE))
                                   * CAST(n - n_test AS DOUBLE)) AS BIGINT) AS n_val FROM c1)
, spl AS (SELECT x.*, CASE WHEN pr.rk <= c2.n_test THEN 'test' WHEN pr.rk <= c2.n_test + c2.n_val
                      THEN 'val' ELSE 'train' END AS split FROM {src} x JOIN pr ON x.{person} = pr.person CROSS JOIN c2)"""


ORACLE["sample_per_split"] = with_("cohort", "flat") + f"""
, {_split_sql('cohort', 'person')}
, o AS (SELECT stay, split, row_number() OVER (PARTITION BY split ORDER BY md5('9' || CAST(stay AS VARCHAR)), stay) AS rk,
               count(*) OVER (PARTITION BY split) AS n FROM spl)
SELECT o.stay, f.nation, f.segment, o.split FROM o JOIN flat f ON f.stay = o.stay WHERE o.rk <= round_even(0.3 * o.n, 0)"""

_SHUFFLED = """
, pl AS (SELECT stay, "order", CAST(floor(("order" - 1) * 4 / (SELECT count(*) FROM shuf)) AS INTEGER) AS file FROM shuf)
, tabs AS (SELECT 'labels' AS name, stay, CAST(NULL AS BIGINT) AS time FROM lab01
           UNION ALL SELECT DISTINCT 'hours', stay, time FROM encoded)"""
ORACLE["shuffled_tables"] = with_("shuf", "lab01", "encoded") + _SHUFFLED + """
SELECT t.name, t.stay, t.time, pl.file,
       row_number() OVER (PARTITION BY t.name, pl.file ORDER BY pl."order", t.time) - 1 AS row
FROM tabs t JOIN pl ON t.stay = pl.stay"""
ORACLE["shuffle_manifest"] = with_("shuf", "lab01", "encoded") + _SHUFFLED + """
, sz AS (SELECT name, stay, count(*) AS n_rows FROM tabs GROUP BY name, stay)
SELECT s.name, s.stay, pl."order", pl.file, s.n_rows,
       CAST(coalesce(sum(s.n_rows) OVER (PARTITION BY s.name, pl.file ORDER BY pl."order"
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_row
FROM sz s JOIN pl ON s.stay = pl.stay"""


def _perm_batch_sql(repeats: int = 3, seed: int = 0) -> str:
    loss = "(y_true - (0.05 * {x1} + {x2} / 80000.0)) * (y_true - (0.05 * {x1} + {x2} / 80000.0))"
    parts = []
    for r in range(repeats):
        order = f"md5('{seed}|{r}|' || CAST(id AS VARCHAR)), id"
        parts.append(f"""SELECT * FROM (SELECT {r} AS rep, y_true, x1, x2,
          coalesce(lead(x1) OVER (ORDER BY {order}), first_value(x1) OVER (ORDER BY {order})) AS n1,
          coalesce(lead(x2) OVER (ORDER BY {order}), first_value(x2) OVER (ORDER BY {order})) AS n2 FROM pf) z""")
    return f"""WITH pf AS (
  SELECT o.o_orderkey AS id, q.x1, o.o_totalprice AS x2, q.x1 / 10.0 AS y_true
  FROM orders o JOIN (SELECT l_orderkey, sum(l_quantity) AS x1 FROM lineitem GROUP BY l_orderkey) q
    ON o.o_orderkey = q.l_orderkey)
, moved AS ({chr(10).join(parts[:1])} {' '.join('UNION ALL ' + p for p in parts[1:])})
, m AS (SELECT 'x1' AS feature, rep, avg({loss.format(x1='n1', x2='x2')}) AS l FROM moved GROUP BY rep
        UNION ALL SELECT 'x2', rep, avg({loss.format(x1='x1', x2='n2')}) FROM moved GROUP BY rep)
, b AS (SELECT avg({loss.format(x1='x1', x2='x2')}) AS base FROM pf)
SELECT feature, {r6('avg(l - base)', 'importance_mean')}, {r6('stddev_pop(l - base)', 'importance_std')}
FROM m CROSS JOIN b GROUP BY feature"""


ORACLE["permutation_importance_batch"] = _perm_batch_sql()

ORACLE["sparse_codes"] = with_("kept", "sstays") + """
, ci AS (SELECT code, row_number() OVER (ORDER BY code) - 1 AS code_id FROM (SELECT DISTINCT code FROM kept) x)
, rw AS (SELECT k.stay, string_agg(CAST(ci.code_id AS VARCHAR), ',' ORDER BY ci.code_id) AS indices, count(*) AS n_codes
         FROM kept k JOIN ci ON k.code = ci.code GROUP BY k.stay)
SELECT s.stay, coalesce(rw.indices, '') AS indices, coalesce(rw.n_codes, 0) AS n_codes FROM sstays s LEFT JOIN rw ON s.stay = rw.stay"""
ORACLE["sparse_codes_back"] = ORACLE["encode_codes"]
ORACLE["csv_round_trip"] = f"SELECT p_partkey, p_name, {r6('p_retailprice', 'p_retailprice')} FROM part"
ORACLE["append_round_trip"] = f"SELECT o_orderkey, {r6('o_totalprice', 'o_totalprice')} FROM orders"
_OSPLIT = "WITH os AS (SELECT o_orderkey AS stay, o_custkey AS person FROM orders)\n, " + _split_sql("os", "person")
ORACLE["splits_round_trip"] = _OSPLIT + "\nSELECT stay, person, split FROM spl WHERE split <> 'test'"
ORACLE["union_splits"] = _OSPLIT + "\nSELECT stay, person, split FROM spl"
ORACLE["ids_round_trip"] = "SELECT DISTINCT o_custkey AS stay FROM orders"
ORACLE["named_result"] = "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1"
ORACLE["predictions_round_trip"] = with_("lp") + f"""
SELECT id, {r6('y_true', 'y_true')}, {r6('y_pred', 'y_pred')},
       {r6('(SELECT avg((y_true - y_pred) * (y_true - y_pred)) FROM lp)', 'mse')} FROM lp"""
ORACLE["feature_names"] = with_("encoded", "vocab") + """
SELECT feature, count(*) FILTER (WHERE value <> 0) AS n_nonzero, CAST((SELECT count(*) FROM vocab) AS INTEGER) AS n_features
FROM encoded GROUP BY feature"""
