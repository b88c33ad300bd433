"""The same queries in plain SQL, for an independent engine.

The SQL takes its own route where there is one: the grid is a cross join, coordinates come from the
cell numbers, percentiles from the engine's own function.
"""

from __future__ import annotations

import math

from tilecast.functions.geo import ALPHABET

# Steps every query may build on; each starts from the ones it names.
_EVENTS = """
ev AS (
  SELECT 25 + 40 * ((384 + user_id // 10485760) % 818) + (user_id // 10 // 2) % 16
           + 20 * (user_id // 10 % 2) AS la,
         (24635 + user_id // 10 // 32 % 32768 + 60 * (user_id // 10 % 2)) % 32768 AS lo,
         date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS day,
         hour(ts) AS hour, 15 * (minute(ts) // 15) AS minute, value
  FROM events)"""


def _geohash_sql() -> str:
    characters = []
    for i in range(6):
        bits = []
        for j in range(5):
            b = 5 * i + j
            cell = "lo" if b % 2 == 0 else "la"
            bits.append(f"(({cell} >> {14 - b // 2}) & 1) * {2 ** (4 - j)}")
        characters.append(f"substr('{ALPHABET}', CAST({' + '.join(bits)} + 1 AS INT), 1)")
    return " || ".join(characters)


def _calendar_sql(source: str) -> str:
    return f"""
  SELECT *, (greatest(day, 0) - 5) % 7 = 0 OR (greatest(day, 0) - 6) % 7 = 0 AS is_weekend,
         ((greatest(day, 0) - 6) % 7 + 7) % 7 AS dow, (hour + 8) % 24 AS hour_p8,
         (hour + 8) % 24 BETWEEN 9 AND 18 AND ((greatest(day, 0) - 6) % 7 + 7) % 7 <= 5
           AS is_working_hour
  FROM {source}"""


_STEPS = {
    "dem": f"""
dem0 AS (
  SELECT {_geohash_sql()} AS geohash6, day, hour, minute, hour || ':' || minute AS timestamp,
         round(sum(value), 2) AS demand, -90 + (la + 0.5) * 180 / 32768 AS lat,
         -180 + (lo + 0.5) * 360 / 32768 AS long
  FROM ev GROUP BY la, lo, day, hour, minute),
dem AS ({_calendar_sql('dem0')})""",
    "comp": f"""
grid AS (
  SELECT p.*, d.day, h.hour, m.minute
  FROM (SELECT DISTINCT geohash6, lat, long FROM dem0) p, (SELECT DISTINCT day FROM dem0) d,
       (SELECT unnest(range(24)) AS hour) h, (SELECT unnest(range(0, 60, 15)) AS minute) m),
comp0 AS (
  SELECT g.geohash6, g.day, g.hour, g.minute, g.hour || ':' || g.minute AS timestamp,
         coalesce(d.demand, 0) AS demand, g.lat, g.long
  FROM grid g LEFT JOIN dem0 d USING (geohash6, day, hour, minute)),
comp AS ({_calendar_sql('comp0')})""",
    "train": """
train AS (SELECT * FROM comp WHERE day BETWEEN 1 AND 15)""",
    "lagged": """
lagged AS (
  SELECT *, lag(demand, 1) OVER t AS demand_tmin1, lag(demand, 4) OVER t AS demand_tmin4,
         lag(demand, 672) OVER t AS demand_tmin672,
         CASE WHEN row_number() OVER t >= 4 THEN
           avg(demand) OVER (PARTITION BY geohash6 ORDER BY day, hour, minute
                             ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) END AS demand_rolling_4
  FROM comp WINDOW t AS (PARTITION BY geohash6 ORDER BY day, hour, minute))""",
    "diffs": """
quant AS (
  SELECT geohash6, dow, avg(demand) AS mean_demand_per_gdow,
         median(demand) AS median_demand_per_gdow,
         quantile_cont(demand, 0.95) AS demand_gdow_q95,
         quantile_cont(demand, 0.1) AS demand_gdow_q10
  FROM comp GROUP BY geohash6, dow),
diffs0 AS (
  SELECT lagged.*, quant.* EXCLUDE (geohash6, dow),
         demand - demand_gdow_q95 AS demand_diff_wt_gdow_q95,
         demand - demand_gdow_q10 AS demand_diff_wt_gdow_q10
  FROM lagged JOIN quant USING (geohash6, dow)),
diffs AS (
  SELECT *, avg(demand_diff_wt_gdow_q95) OVER g AS mean_demand_diff_wt_gdow_q95,
         avg(demand_diff_wt_gdow_q10) OVER g AS mean_demand_diff_wt_gdow_q10
  FROM diffs0 WINDOW g AS (PARTITION BY geohash6, dow))""",
    "fut": f"""
fut0 AS (
  SELECT geohash6, lat, long, 1 + total // 1440 AS day, total % 1440 // 60 AS hour,
         total % 60 AS minute
  FROM (SELECT geohash6, lat, long, last + 15 * step AS total
        FROM (SELECT geohash6, any_value(lat) AS lat, any_value(long) AS long,
                     max((day - 1) * 1440 + hour * 60 + minute) AS last
              FROM {{last_of}} GROUP BY geohash6),
             (SELECT unnest(range(1, {{n}} + 1)) AS step))),
fut AS ({_calendar_sql('fut0')})""",
    "base": """
base AS (
  SELECT geohash6, dow, hour, minute, avg(demand) AS y_true, median(demand) AS y_median
  FROM train GROUP BY geohash6, dow, hour, minute)""",
    "fc": """
fc AS (SELECT fut.*, y_true AS y_hat FROM fut LEFT JOIN base USING (geohash6, dow, hour, minute))""",
    "judged": """
judged AS (
  SELECT fc.*, comp.demand, y_hat - comp.demand AS err, abs(y_hat - comp.demand) AS abs_err
  FROM fc JOIN comp USING (geohash6, day, hour, minute) WHERE comp.day > 15)""",
    "place_err": """
place_err0 AS (
  SELECT geohash6, lat, long, avg((demand - y_hat) * (demand - y_hat)) AS mse,
         avg(demand) AS y_true
  FROM judged GROUP BY geohash6, lat, long),
place_err AS (
  SELECT *, sqrt(mse) AS rmse, ((mse + 1) / (y_true + 1) - 1) * 100 AS MAPE FROM place_err0)""",
    "at_median": """
at_median AS (
  SELECT * FROM (SELECT *, median(demand) OVER (PARTITION BY geohash6) AS demand_median FROM dem)
  WHERE demand = demand_median)""",
    "daily": """
daily AS (
  SELECT day, avg(m) AS demand
  FROM (SELECT geohash6, day, avg(demand) AS m FROM dem GROUP BY geohash6, day) GROUP BY day)""",
}

_NEEDS = {
    "dem": [],
    "comp": ["dem"],
    "train": ["comp"],
    "lagged": ["comp"],
    "diffs": ["lagged"],
    "base": ["train"],
    "fut": [],
    "fc": ["base", "fut"],
    "judged": ["fc"],
    "place_err": ["judged"],
    "at_median": ["dem"],
    "daily": ["dem"],
}


def _steps_for(names: list[str]) -> list[str]:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in _NEEDS[name]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def _column(spec: str) -> str:
    """``name:type``: i is BIGINT, f a double rounded to 6 (or the given) digits, s and b as is."""
    name, kind = spec.split(":")
    if kind == "i":
        return f"CAST({name} AS BIGINT) AS {name}"
    if kind.startswith("f"):
        return f"round(CAST({name} AS DOUBLE) + 1e-9, {kind[1:] or 6}) + 0.0 AS {name}"
    return f"{name} AS {name}"


def _sql(columns: str, body: str, *steps: str, last_of: str = "train", n: int = 96) -> str:
    """The steps, then ``body``, with its columns typed and rounded like the Spark side."""
    texts = [_STEPS[s] for s in _steps_for(list(steps))]
    texts = [t.replace("{last_of}", last_of).replace("{n}", str(n)) for t in texts]
    head = ",".join([_EVENTS, *texts, f"\nout AS ({body})"])
    return f"WITH {head}\nSELECT {', '.join(map(_column, columns.split()))} FROM out"


_KEY = "geohash6:s day:i hour:i minute:i"
_CALENDAR = f"{_KEY} is_weekend:b dow:i lat:f long:f hour_p8:i is_working_hour:b"
_RAW = "geohash6:s day:i timestamp:s demand:f"
_ERRORS = "mse:f4 y_true:f rmse:f MAPE:f4"
_HOURS = " ".join(f"h{h}:f" for h in range(24))
_CENTRES = """
centres AS (
  SELECT long > 91 AS east, avg(lat) AS cluster_geo_mid_lat, avg(long) AS cluster_geo_mid_long
  FROM (SELECT DISTINCT geohash6, lat, long FROM dem) GROUP BY long > 91)"""
_DISTANCE = """2 * 6371 * asin(sqrt(
    pow(sin(radians(cluster_geo_mid_lat - lat) / 2), 2) + cos(radians(lat))
    * cos(radians(cluster_geo_mid_lat))
    * pow(sin(radians(cluster_geo_mid_long - long) / 2), 2)))"""
_ONE_CLUSTER_EACH = f"""
  SELECT r.*, CAST(east AS INT) AS cluster_geo, cluster_geo_mid_lat, cluster_geo_mid_long,
         {_DISTANCE} AS dist_to_center_km
  FROM {{rows}} r JOIN centres ON (long > 91) = east"""


def _mixture(source: str, columns: list[str], k: int, steps: int) -> str:
    """Steps ``points`` to ``shares{k}``: rows of ``source`` with a log weighted density per component.

    Densities go through the Cholesky factor, covariances through a second pass with the new means.
    """
    d, floor = len(columns), 1e-6
    xs, js = range(d), range(k)
    half = [(i, m) for i in xs for m in range(i + 1)]

    def cov(j: int, i: int, m: int) -> str:
        return f"c{j}_{max(i, m)}{min(i, m)}"

    at = ", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(columns))
    steps_sql = [f"points{k} AS MATERIALIZED (SELECT *, {at} FROM {source})"]
    start = [f"1.0 / {k} AS w{j}" for j in js]
    start += [f"min(x{i}) + {(j + 0.5) / k!r} * (max(x{i}) - min(x{i})) AS m{j}_{i}" for j in js for i in xs]
    start += [f"covar_pop(x{i}, x{m}) + {floor if i == m else 0.0!r} AS {cov(j, i, m)}" for j in js for i, m in half]
    steps_sql.append(f"p{k}_0 AS MATERIALIZED (SELECT {', '.join(start)} FROM points{k})")
    for t in range(steps + 1):
        factor = []
        for j in js:
            for i, m in half:
                rest = "".join(f" - l{j}_{i}{q} * l{j}_{m}{q}" for q in range(m))
                inner = f"{cov(j, i, m)}{rest}"
                factor.append(f"{f'sqrt({inner})' if i == m else f'({inner}) / l{j}_{m}{m}'} AS l{j}_{i}{m}")
        density = []
        for j in js:
            for i in xs:
                rest = "".join(f" - l{j}_{i}{q} * y{j}_{q}" for q in range(i))
                density.append(f"(x{i} - m{j}_{i}{rest}) / l{j}_{i}{i} AS y{j}_{i}")
            logs = " + ".join(f"ln(l{j}_{i}{i})" for i in xs)
            squares = " + ".join(f"y{j}_{i} * y{j}_{i}" for i in xs)
            density.append(f"ln(w{j}) - {d} / 2.0 * ln(2 * pi()) - ({logs}) - 0.5 * ({squares}) AS lp{j}")
        top = f"greatest({', '.join(f'lp{j}' for j in js)})"
        total = " + ".join(f"exp(lp{j} - {top})" for j in js)
        steps_sql.append(f"""f{k}_{t} AS MATERIALIZED (SELECT *, {', '.join(factor)} FROM p{k}_{t}),
e{k}_{t} AS MATERIALIZED (SELECT *, {top} + ln({total}) AS lse
  FROM (SELECT points{k}.*, {', '.join(density)} FROM points{k}, f{k}_{t}))""")
        if t < steps:
            share = [f"exp(lp{j} - lse)" for j in js]
            mean = [f"sum({share[j]}) / count(*) AS w{j}" for j in js]
            mean += [f"sum({share[j]} * x{i}) / sum({share[j]}) AS m{j}_{i}" for j in js for i in xs]
            spread = [
                f"sum({share[j]} * (x{i} - m{j}_{i}) * (x{m} - m{j}_{m})) / sum({share[j]}) + {floor if i == m else 0.0!r} AS {cov(j, i, m)}"
                for j in js
                for i, m in half
            ]
            names = ", ".join([f"any_value(w{j}) AS w{j}" for j in js] + [f"any_value(m{j}_{i}) AS m{j}_{i}" for j in js for i in xs])
            steps_sql.append(f"""n{k}_{t} AS MATERIALIZED (SELECT {', '.join(mean)} FROM e{k}_{t}),
p{k}_{t + 1} AS MATERIALIZED (SELECT {names}, {', '.join(spread)}
  FROM e{k}_{t}, n{k}_{t})""")
    last = f"e{k}_{steps}"
    rank = [f"(SELECT count(*) FROM (SELECT unnest([{', '.join(f'm{q}_0' for q in js)}]) AS v FROM p{k}_{steps}) WHERE v < (SELECT m{j}_0 FROM p{k}_{steps}))" for j in js]
    best = " ".join(f"WHEN lp{j} = greatest({', '.join(f'lp{q}' for q in js)}) THEN {rank[j]}" for j in js)
    steps_sql.append(f"shares{k} AS MATERIALIZED (SELECT *, CASE {best} END AS cluster, exp(greatest({', '.join(f'lp{j}' for j in js)}) - lse) AS cluster_prob FROM {last})")
    return ",\n".join(steps_sql)


def _with_mixtures(columns: str, body: str, source: str, over: list[str], ks: list[int]) -> str:
    """Like ``_sql`` over ``dem``, with mixtures of ``source``'s rows as further steps."""
    steps = ",\n".join(_mixture(source, over, k, 5) for k in ks)
    return _sql(columns, body, "dem").replace("\nout AS (", f"\n{steps},\nout AS (", 1)


def _auto_histogram(source: str, most: int = 50) -> str:
    return f"""
  WITH ends AS (
    SELECT count(*) AS n, min(demand) AS low, max(demand) AS high,
           quantile_cont(demand, 0.75) - quantile_cont(demand, 0.25) AS iqr FROM {source}),
  plan AS (
    SELECT low, high, greatest(1, least({most}, CASE WHEN iqr > 0
             THEN ceil((high - low) / (2 * iqr / pow(n, 1.0 / 3))) ELSE floor(sqrt(n)) END)) AS bins FROM ends)
  SELECT bin, low + (bin - 1) * (high - low) / bins AS low, low + bin * (high - low) / bins AS high,
         (SELECT count(*) FROM {source} WHERE least(floor(bins * (demand - low) / (high - low)) + 1, bins) = bin) AS n
  FROM (SELECT *, unnest(range(1, CAST(bins AS INT) + 1)) AS bin FROM plan)"""


#: The two-dimensional kernel at once, in place of one axis after the other.
_DENSITY = """
  WITH places AS (SELECT DISTINCT geohash6, lat, long FROM dem),
  width AS (
    SELECT count(*) AS n, stddev_samp(lat) * pow(count(*), -1.0 / 6) / 4 AS a,
           stddev_samp(long) * pow(count(*), -1.0 / 6) / 4 AS b FROM places),
  kernel AS (SELECT o, exp(-0.5 * o * o / 16.0) / sum(exp(-0.5 * o * o / 16.0)) OVER () AS w
             FROM (SELECT unnest(range(-12, 13)) AS o))
  SELECT floor(lat / a) + p.o AS lat_cell, floor(long / b) + q.o AS long_cell,
         (floor(lat / a) + p.o + 0.5) * any_value(a) AS lat, (floor(long / b) + q.o + 0.5) * any_value(b) AS long,
         sum(p.w * q.w) / any_value(n) AS mass, sum(p.w * q.w) / any_value(n) / any_value(a * b) AS density
  FROM places, width, kernel p, kernel q GROUP BY floor(lat / a) + p.o, floor(long / b) + q.o"""


def _bands(replicates: int) -> str:
    digits = "substr(md5(concat_ws('|', geohash6, day, hour, minute, '1-' || (r // 4))), CAST(8 * (r % 4) + 1 AS INT), 8)"
    poisson = " + ".join(f"(u >= {sum(math.exp(-1) / math.factorial(i) for i in range(k + 1))!r})::INT" for k in range(12))
    return f"""
  WITH lots AS (
    SELECT is_weekend, (hour + 7) % 24 AS hour_p7, demand, r, CAST('0x' || {digits} AS BIGINT) / 4294967296.0 AS u
    FROM dem, (SELECT unnest(range({replicates})) AS r)),
  means AS (
    SELECT is_weekend, hour_p7, r, sum(w * demand) / sum(w) AS m
    FROM (SELECT *, {poisson} AS w FROM lots) GROUP BY ALL HAVING sum(w) > 0)
  SELECT is_weekend, hour_p7, mean, low, high, n
  FROM (SELECT is_weekend, (hour + 7) % 24 AS hour_p7, avg(demand) AS mean, count(*) AS n FROM dem GROUP BY ALL)
  LEFT JOIN (SELECT is_weekend, hour_p7, quantile_cont(m, 0.025) AS low, quantile_cont(m, 0.975) AS high
             FROM means GROUP BY ALL) USING (is_weekend, hour_p7)"""


def _encoded(source: str) -> str:
    digits = "substr(md5(concat_ws('|', geohash6, day, hour, minute, '1')), 1, 15)"
    return f"""SELECT *, (coalesce(sum(demand) OVER w, 0) + (SELECT avg(demand) FROM {source})) / (count(*) OVER w + 1) AS enc
               FROM {source} WINDOW w AS (PARTITION BY geohash6 ORDER BY CAST('0x' || {digits} AS BIGINT)
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def _exact_order(share: float) -> str:
    digits = "substr(md5(concat_ws('|', geohash6, day, hour, minute, '1')), 1, 15)"
    return f"""SELECT *, row_number() OVER (ORDER BY CAST('0x' || {digits} AS BIGINT)) <= floor({share} * count(*) OVER ()) AS first
               FROM dem"""


def _pivot(by: str, source: str, value: str = "demand") -> str:
    hours = ", ".join(
        f"coalesce(sum({value}) FILTER (WHERE hour = {h}), 0) AS h{h}" for h in range(24)
    )
    return f"SELECT {by}, {hours} FROM ({source}) GROUP BY {by}"


def _day_hour(aggregate: str, where: str = "true") -> str:
    return f"""SELECT day, (hour + 8) % 24 AS hour, {aggregate} AS demand
               FROM dem WHERE {where} GROUP BY day, dem.hour"""


def _describe(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean,
                   stddev_samp({c}) AS std, min({c}) AS min, quantile_cont({c}, 0.25) AS q25,
                   quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75,
                   max({c}) AS max FROM {source}"""
        for c in columns
    )


def _summary_columns(digits: int) -> str:
    doubles = " ".join(f"{c}:f{digits}" for c in "mean std min q25 q50 q75 max".split())
    return f'"column":s count:i {doubles}'


def _histogram(source: str, bins: int, by: str = "") -> str:
    return f"""
  SELECT {by} least(floor({bins} * (demand - low) / (high - low)) + 1, {bins}) AS bin,
         count(*) AS n
  FROM {source}, (SELECT min(demand) AS low, max(demand) AS high FROM {source}) GROUP BY ALL"""


def _per_level(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c} AS level, count(demand) AS n FROM dem GROUP BY {c}"""
        for c in columns
    )


def _levels(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS levels FROM dem""" for c in columns
    )


def _rolling(windows: list[int]) -> str:
    return " UNION ALL ".join(
        f"""SELECT day, {n} AS "window", CASE WHEN row_number() OVER (ORDER BY day) >= {n} THEN
              avg(demand) OVER (ORDER BY day ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)
              END AS demand FROM daily"""
        for n in windows
    )


_DAY_HOUR_SUMS = f"""(
  SELECT *, (greatest(day, 0) - 5) % 7 = 0 OR (greatest(day, 0) - 6) % 7 = 0 AS is_weekend
  FROM ({_day_hour('sum(demand)')}))"""

_FEATURES = f"""
  SELECT diffs.*, cluster_geo, cluster_geo_mid_lat, cluster_geo_mid_long, dist_to_center_km,
         avg(demand) OVER p AS mean_demand_per_geo, median(demand) OVER p AS median_demand_per_geo,
         avg(demand) OVER h AS mean_demand_per_gdowh,
         median(demand) OVER h AS median_demand_per_gdowh,
         avg(demand_tmin1) OVER h AS mean_enc_demand_tmin1,
         avg(demand_tmin4) OVER h AS mean_enc_demand_tmin4,
         avg(demand_tmin672) OVER h AS mean_enc_demand_tmin672
  FROM diffs JOIN (SELECT geohash6, cluster_geo, cluster_geo_mid_lat, cluster_geo_mid_long,
                          dist_to_center_km
                   FROM ({_ONE_CLUSTER_EACH.replace('{rows}', 'places')})) USING (geohash6)
  WINDOW p AS (PARTITION BY geohash6), h AS (PARTITION BY geohash6, dow, hour)"""
_PLACES = ", places AS (SELECT DISTINCT geohash6, lat, long FROM dem)"
_FEATURE_COLUMNS = " ".join(
    f"{c}:f"
    for c in """demand demand_tmin1 demand_tmin4 demand_tmin672 demand_rolling_4
    mean_enc_demand_tmin1 mean_enc_demand_tmin4 mean_enc_demand_tmin672 mean_demand_per_gdowh
    median_demand_per_gdowh mean_demand_per_gdow mean_demand_per_geo median_demand_per_geo
    median_demand_per_gdow demand_gdow_q95 demand_gdow_q10 demand_diff_wt_gdow_q95
    mean_demand_diff_wt_gdow_q95 demand_diff_wt_gdow_q10 mean_demand_diff_wt_gdow_q10
    cluster_geo_mid_lat cluster_geo_mid_long dist_to_center_km""".split()
)


def _with_centres(columns: str, body: str, *steps: str) -> str:
    """Like ``_sql``, with the two area centres as a further step."""
    sql = _sql(columns, body, *steps)
    return sql.replace("\nout AS (", f"{_CENTRES}{_PLACES},\nout AS (", 1)


_SHARE = """CAST('0x' || substr(md5(concat_ws('|', geohash6, day, hour, minute, '1')), 1, 8)
  AS BIGINT) / 4294967296.0"""
_STUMP = "SELECT is_weekend, avg(demand) AS lv1_yhat FROM train GROUP BY is_weekend"


def oracle() -> dict[str, str]:
    from_dem = "SELECT * FROM dem"
    return {
        "demand_table": _sql(_RAW, from_dem, "dem"),
        "complete_ticks": _sql(f"{_RAW} hour:i minute:i", "SELECT * FROM comp", "comp"),
        "calendar_geo": _sql(f"{_CALENDAR} timestamp:s demand:f", from_dem, "dem"),
        "train_window": _sql(_RAW, f"{from_dem} WHERE day >= 1 AND day <= 15", "dem"),
        "train_quantile_days": _sql(
            _RAW,
            f"""{from_dem} WHERE day >= 1 AND day <= (
                  SELECT quantile_cont(day, 0.3) FROM (SELECT DISTINCT day FROM dem))""",
            "dem",
        ),
        "holdout": _sql(f"{_RAW} hour:i minute:i", f"{from_dem} WHERE day > 15", "dem"),
        "hash_sample": _sql(
            f"{_CALENDAR} timestamp:s demand:f", f"{from_dem} WHERE {_SHARE} < 0.2", "dem"
        ),
        "train_test_split": _sql(
            f"{_CALENDAR} timestamp:s demand:f part:s",
            f"SELECT *, CASE WHEN {_SHARE} < 0.3 THEN 'test' ELSE 'train' END AS part FROM dem",
            "dem",
        ),
        "exact_sample": _sql(f"{_CALENDAR} timestamp:s demand:f", f"SELECT * FROM ({_exact_order(0.2)}) WHERE first", "dem"),
        "exact_split": _sql(
            f"{_CALENDAR} timestamp:s demand:f part:s",
            f"SELECT *, CASE WHEN first THEN 'test' ELSE 'train' END AS part FROM ({_exact_order(0.3)})",
            "dem",
        ),
        "demand_auto_histogram": _sql("bin:i low:f high:f n:i", _auto_histogram("dem"), "dem"),
        "place_density": _sql("lat_cell:i long_cell:i lat:f long:f mass:f density:f4", _DENSITY, "dem"),
        "demand_bands": _sql("is_weekend:b hour_p7:i mean:f low:f high:f n:i", _bands(40), "dem"),
        "mixture_places": _with_mixtures(
            "geohash6:s lat:f long:f cluster:i cluster_prob:f",
            "SELECT * FROM shares2",
            "(SELECT DISTINCT geohash6, lat, long FROM dem)",
            ["lat", "long"],
            [2],
        ),
        "mixture_rows": _with_mixtures(
            f"{_KEY} lat:f long:f demand:f cluster:i cluster_prob:f", "SELECT * FROM shares3", "dem", ["lat", "long", "demand"], [3]
        ),
        "mixture_medians": _with_mixtures(
            "lat:f long:f cluster:i demand:f n:i",
            "SELECT lat, long, cluster, median(demand) AS demand, count(*) AS n FROM shares3 GROUP BY lat, long, cluster",
            "dem",
            ["lat", "long", "demand"],
            [3],
        ),
        "mixture_scores": _with_mixtures(
            "k:i aic:f3 bic:f3",
            " UNION ALL ".join(
                f"SELECT {k} AS k, {2 * (6 * k - 1)} - 2 * sum(lse) AS aic, {6 * k - 1} * ln(count(*)) - 2 * sum(lse) AS bic FROM shares{k}"
                for k in (1, 2, 3)
            ),
            "dem",
            ["long", "demand"],
            [1, 2, 3],
        ),
        "at_place": _sql(_RAW, f"{from_dem} WHERE geohash6 = (SELECT min(geohash6) FROM dem)", "dem"),
        "on_days": _sql(_RAW, f"{from_dem} WHERE day IN (2, 3, 29, 77)", "dem"),
        "distinct_hours": _sql("hour:i", "SELECT DISTINCT hour FROM dem", "dem"),
        "source_csv": _sql(_RAW, from_dem, "dem"),
        "source_gzip": _sql(_RAW, from_dem, "dem"),
        "source_parquet": _sql(_RAW, from_dem, "dem"),
        "source_zip": _sql(_RAW, from_dem, "dem"),
        "series_in_blocks": _sql(
            f"{_KEY} demand_tmin1:f demand_tmin4:f demand_tmin672:f demand_rolling_4:f", "SELECT * FROM lagged", "lagged"
        ),
        "grid_in_blocks": _sql(f"{_RAW} hour:i minute:i", "SELECT * FROM comp", "comp"),
        "target_encoding": _sql(f"{_KEY} enc:f", _encoded("dem"), "dem"),
        "day_labels": _sql(
            "geohash6:s day_timestamp:s timestamp:s demand:f", "SELECT *, day || ':' || timestamp AS day_timestamp FROM dem", "dem"
        ),
        "demand_preview": _sql(
            f"{_KEY} demand:f n_rows:i n_columns:i",
            """SELECT *, (SELECT count(*) FROM dem) AS n_rows, 5 AS n_columns FROM dem
               ORDER BY geohash6, day, hour, minute LIMIT 5""",
            "dem",
        ),
        "suffixed_join": _sql(
            f"{_KEY} demand:f demand_r:f", "SELECT *, avg(demand) OVER (PARTITION BY geohash6, day) AS demand_r FROM dem", "dem"
        ),
        "place_scatter": _sql(
            "lat:f long:f demand_median:f cluster_geo:i",
            """SELECT any_value(lat) AS lat, any_value(long) AS long, median(demand) AS demand_median,
                      CAST(any_value(long) > 91 AS INT) AS cluster_geo FROM dem GROUP BY geohash6""",
            "dem",
        ),
        "forecast_category": _sql(
            f"{_CALENDAR} y_hat:f",
            """WITH shifts AS (SELECT *, CASE WHEN hour_p8 >= 8 THEN CAST(is_working_hour AS INT) END AS shift FROM train),
                 filled AS (SELECT *, coalesce(shift, (SELECT avg(shift) FROM shifts)) AS f FROM shifts),
                 line AS (SELECT regr_slope(demand, f) AS slope, regr_intercept(demand, f) AS level FROM filled),
                 lookup AS (SELECT geohash6, dow, hour, avg(shift) AS shift FROM shifts GROUP BY ALL)
               SELECT fut.*, level + slope * coalesce(shift, (SELECT avg(shift) FROM shifts)) AS y_hat
               FROM fut LEFT JOIN lookup USING (geohash6, dow, hour), line""",
            "train",
            "fut",
            n=5,
        ),
        "forecast_one_hot": _sql(
            f"{_CALENDAR} y_hat:f4",
            "SELECT fut.*, y_hat FROM fut JOIN (SELECT dow, avg(demand) AS y_hat FROM train GROUP BY dow) USING (dow)",
            "train",
            "fut",
            n=5,
        ),
        "forecast_category_stump": _sql(
            f"{_CALENDAR} y_hat:f",
            """WITH levels AS (SELECT dow, count(*) AS n, sum(demand) AS s FROM train GROUP BY dow),
                 cuts AS (SELECT dow, s / n AS m, sum(n) OVER w AS n_left, sum(s) OVER w AS s_left,
                                 sum(n) OVER () AS n_all, sum(s) OVER () AS s_all
                          FROM levels WINDOW w AS (ORDER BY s / n)),
                 best AS (SELECT * FROM cuts WHERE n_left < n_all
                          ORDER BY s_left * s_left / n_left + (s_all - s_left) * (s_all - s_left) / (n_all - n_left) DESC LIMIT 1)
               SELECT fut.*, CASE WHEN cuts.m <= best.m THEN best.s_left / best.n_left
                                  ELSE (best.s_all - best.s_left) / (best.n_all - best.n_left) END AS y_hat
               FROM fut JOIN cuts USING (dow), best""",
            "train",
            "fut",
            n=5,
        ),
        "forecast_shrunk_line": _sql(
            f"{_CALENDAR} y_hat:f3",
            """SELECT fut.*, y0 + slope * (m - x0) AS y_hat
               FROM fut JOIN (SELECT geohash6, dow, hour, avg(demand) AS m FROM train
                              GROUP BY geohash6, dow, hour) USING (geohash6, dow, hour), (
                 SELECT avg(m) AS x0, avg(demand) AS y0,
                        greatest(covar_pop(demand, m) - 0.25, 0) / (var_pop(m) + 0.25 / stddev_pop(demand)) AS slope
                 FROM (SELECT demand, avg(demand) OVER (PARTITION BY geohash6, dow, hour) AS m FROM train))""",
            "train",
            "fut",
            n=5,
        ),
        "forecast_encoded": _sql(
            f"{_CALENDAR} y_hat:f",
            f"""WITH line AS (SELECT regr_slope(demand, enc) AS slope, regr_intercept(demand, enc) AS level FROM ({_encoded('train')})),
                 means AS (SELECT geohash6, (sum(demand) + any_value(a)) / (count(*) + 1) AS m
                           FROM train, (SELECT avg(demand) AS a FROM train) GROUP BY geohash6)
               SELECT fut.*, level + slope * m AS y_hat FROM fut JOIN means USING (geohash6), line""",
            "train",
            "fut",
            n=5,
        ),
        "two_level_scores": _sql(
            f"{_KEY} y_true:f y_hat:f lv2_y_hat:f ensemble_y_hat:f",
            f"""WITH first AS (SELECT train.*, lv1_yhat FROM train JOIN ({_STUMP}) USING (is_weekend)),
                 second AS (SELECT is_working_hour, avg(demand - lv1_yhat) AS lv2_y_hat FROM first GROUP BY is_working_hour)
               SELECT first.*, demand AS y_true, lv1_yhat AS y_hat, lv2_y_hat, lv1_yhat + lv2_y_hat AS ensemble_y_hat
               FROM first JOIN second USING (is_working_hour)""",
            "train",
        ),
        "mean_job": _sql(f"{_CALENDAR} y_hat:f", "SELECT * FROM fc", "fc", n=5),
        "gmm_score_one": _sql(
            "k:i aic:f3 bic:f3",
            """SELECT 1 AS k, 4 - 2 * ll AS aic, 2 * ln(n) - 2 * ll AS bic FROM (
                 SELECT count(*) AS n, -count(*) / 2 * (ln(2 * pi() * var_pop(m)) + 1) AS ll FROM (
                   SELECT median(demand) AS m FROM comp GROUP BY geohash6, dow, hour))""",
            "comp",
        ),
        "forecast_stump": _sql(
            f"{_CALENDAR} y_hat:f",
            """SELECT fut.*, y_hat FROM fut JOIN (
                 SELECT is_weekend, avg(demand) AS y_hat FROM train GROUP BY is_weekend)
               USING (is_weekend)""",
            "train",
            "fut",
            n=5,
        ),
        "forecast_linear": _sql(
            f"{_CALENDAR} y_hat:f",
            """SELECT fut.*, slope * m + level AS y_hat
               FROM fut JOIN (SELECT geohash6, dow, hour, avg(demand) AS m FROM train
                              GROUP BY geohash6, dow, hour) USING (geohash6, dow, hour), (
                 SELECT regr_slope(demand, m) AS slope, regr_intercept(demand, m) AS level
                 FROM (SELECT demand, avg(demand) OVER (PARTITION BY geohash6, dow, hour) AS m
                       FROM train))""",
            "train",
            "fut",
            n=5,
        ),
        "two_level_stump": _sql(
            f"{_CALENDAR} lv1_yhat:f lv2_yhat:f y_hat:f",
            f"""SELECT fut.*, lv1_yhat, lv2_yhat, lv1_yhat + lv2_yhat AS y_hat
                FROM fut JOIN ({_STUMP}) USING (is_weekend) JOIN (
                  SELECT is_working_hour, avg(demand - lv1_yhat) AS lv2_yhat
                  FROM train JOIN ({_STUMP}) USING (is_weekend) GROUP BY is_working_hour)
                USING (is_working_hour)""",
            "train",
            "fut",
            n=5,
        ),
        "stump_scores": _sql(
            f"{_KEY} demand:f y_hat:f",
            f"SELECT train.*, lv1_yhat AS y_hat FROM train JOIN ({_STUMP}) USING (is_weekend)",
            "train",
        ),
        "stump_importance": """SELECT 'is_weekend' AS feature, CAST(1 AS DOUBLE) AS importances""",
        "geo_stats": _sql(
            "geohash6:s mean_demand_per_geo:f median_demand_per_geo:f",
            """SELECT geohash6, avg(demand) AS mean_demand_per_geo,
                      median(demand) AS median_demand_per_geo FROM comp GROUP BY geohash6""",
            "comp",
        ),
        "gdow_stats": _sql(
            """geohash6:s dow:i mean_demand_per_gdow:f median_demand_per_gdow:f demand_gdow_q95:f
               demand_gdow_q10:f mean_demand_diff_wt_gdow_q95:f mean_demand_diff_wt_gdow_q10:f""",
            """SELECT DISTINCT geohash6, dow, mean_demand_per_gdow, median_demand_per_gdow,
                      demand_gdow_q95, demand_gdow_q10,
                      round(mean_demand_diff_wt_gdow_q95, 9) AS mean_demand_diff_wt_gdow_q95,
                      round(mean_demand_diff_wt_gdow_q10, 9) AS mean_demand_diff_wt_gdow_q10
               FROM diffs""",
            "diffs",
        ),
        "gdowh_stats": _sql(
            "geohash6:s dow:i hour:i mean_demand_per_gdowh:f median_demand_per_gdowh:f",
            """SELECT geohash6, dow, hour, avg(demand) AS mean_demand_per_gdowh,
                      median(demand) AS median_demand_per_gdowh
               FROM comp GROUP BY geohash6, dow, hour""",
            "comp",
        ),
        "place_points": _sql(
            "geohash6:s lat:f long:f", "SELECT DISTINCT geohash6, lat, long FROM dem", "dem"
        ),
        "level_counts": _sql(
            '"column":s levels:i',
            _levels(["geohash6", "is_weekend", "dow", "hour", "minute"]),
            "dem",
        ),
        "row_counts": _sql(
            '"column":s level:i n:i', _per_level(["day", "hour", "minute"]), "dem"
        ),
        "lag_features": _sql(
            f"{_KEY} demand_tmin1:f demand_tmin4:f demand_tmin672:f",
            "SELECT * FROM lagged",
            "lagged",
        ),
        "lag_mean_encoding": _sql(
            """geohash6:s dow:i hour:i mean_enc_demand_tmin1:f mean_enc_demand_tmin4:f
               mean_enc_demand_tmin672:f""",
            """SELECT geohash6, dow, hour, avg(demand_tmin1) AS mean_enc_demand_tmin1,
                      avg(demand_tmin4) AS mean_enc_demand_tmin4,
                      avg(demand_tmin672) AS mean_enc_demand_tmin672
               FROM lagged GROUP BY geohash6, dow, hour""",
            "lagged",
        ),
        "rolling_mean_4": _sql(
            f"{_KEY} demand_rolling_4:f", "SELECT * FROM lagged", "lagged"
        ),
        "quantile_diffs": _sql(
            f"""{_KEY} demand_gdow_q95:f demand_gdow_q10:f demand_diff_wt_gdow_q95:f
                demand_diff_wt_gdow_q10:f mean_demand_diff_wt_gdow_q95:f
                mean_demand_diff_wt_gdow_q10:f""",
            "SELECT * FROM diffs",
            "diffs",
        ),
        "feature_lookup": _sql(
            """geohash6:s dow:i hour:i is_weekend:f is_working_hour:f minute:f demand_rolling_4:f
               demand_gdow_q95:f""",
            """SELECT geohash6, dow, hour, avg(is_weekend::INT) AS is_weekend,
                      avg(is_working_hour::INT) AS is_working_hour, avg(minute) AS minute,
                      avg(demand_rolling_4) AS demand_rolling_4, avg(q) AS demand_gdow_q95
               FROM lagged JOIN (SELECT geohash6, dow, quantile_cont(demand, 0.95) AS q FROM train
                                 GROUP BY geohash6, dow) USING (geohash6, dow)
               WHERE day BETWEEN 1 AND 15 GROUP BY geohash6, dow, hour""",
            "lagged",
            "train",
        ),
        "baseline_model": _sql(
            "geohash6:s dow:i hour:i minute:i y_true:f", "SELECT * FROM base", "base"
        ),
        "baseline_median_model": _sql(
            "geohash6:s dow:i hour:i minute:i y_true:f",
            "SELECT * EXCLUDE (y_true, y_median), y_median AS y_true FROM base",
            "base",
        ),
        "future_ticks": _sql(
            _CALENDAR, "SELECT * FROM fut", "dem", "fut", last_of="dem", n=5
        ),
        "baseline_forecast": _sql(f"{_CALENDAR} y_hat:f", "SELECT * FROM fc", "fc", n=5),
        "error_per_place": _sql(
            f"geohash6:s {_ERRORS}", "SELECT * FROM place_err", "place_err"
        ),
        "error_per_point": _sql(
            f"lat:f long:f {_ERRORS}", "SELECT * FROM place_err", "place_err"
        ),
        "global_metrics": _sql(
            "mape:f4 mape1:f4 rmse:f mae:f r2:f explained_variance:f",
            """SELECT avg(abs_err / nullif(demand, 0)) * 100 AS mape,
                      avg((abs_err + 1) / (demand + 1)) * 100 AS mape1,
                      sqrt(avg(err * err)) AS rmse, avg(abs_err) AS mae,
                      1 - sum(err * err) / (count(*) * var_pop(demand)) AS r2,
                      1 - var_pop(err) / var_pop(demand) AS explained_variance
               FROM judged WHERE y_hat IS NOT NULL""",
            "judged",
        ),
        "error_summary": _sql(
            _summary_columns(3), _describe("place_err", ["mse", "y_true", "rmse", "MAPE"]),
            "place_err",
        ),
        "forecast_summary": _sql(
            _summary_columns(6),
            _describe(
                "(SELECT * FROM judged WHERE abs_err > 0.2)",
                ["demand", "y_hat", "err", "abs_err"],
            ),
            "judged",
        ),
        "mean_place_error": _sql(
            "rmse:f MAPE:f4", "SELECT avg(rmse) AS rmse, avg(MAPE) AS MAPE FROM place_err",
            "place_err",
        ),
        "two_stage_error": _sql(
            "err:f abs_err:f",
            """SELECT avg(err) AS err, avg(abs_err) AS abs_err
               FROM (SELECT avg(err) AS err, avg(abs_err) AS abs_err FROM judged
                     GROUP BY geohash6)""",
            "judged",
        ),
        "worst_places": _sql(
            "geohash6:s err:f demand:f",
            """SELECT geohash6, avg(err) AS err, avg(demand) AS demand FROM judged
               WHERE err > 0.2 GROUP BY geohash6 ORDER BY avg(err) DESC, geohash6 LIMIT 10""",
            "judged",
        ),
        "top_rmse": _sql(
            f"geohash6:s {_ERRORS}",
            "SELECT * FROM place_err ORDER BY rmse DESC, geohash6 LIMIT 5",
            "place_err",
        ),
        "place_profile": _sql(
            "geohash6:s "
            + " ".join(
                f"{c}_sum:{kind} {c}_mean:f {c}_median:f"
                for c, kind in (("day", "i"), ("demand", "f"), ("hour", "i"))
            ),
            "SELECT geohash6, "
            + ", ".join(
                f"sum({c}) AS {c}_sum, avg({c}) AS {c}_mean, median({c}) AS {c}_median"
                for c in ("day", "demand", "hour")
            )
            + " FROM dem GROUP BY geohash6",
            "dem",
        ),
        "top30_median": _sql(
            "geohash6:s demand_sum:f demand_mean:f demand_median:f",
            """SELECT geohash6, sum(demand) AS demand_sum, avg(demand) AS demand_mean,
                      median(demand) AS demand_median
               FROM dem GROUP BY geohash6 ORDER BY demand_median DESC, geohash6 LIMIT 30""",
            "dem",
        ),
        "daily_mean_of_means": _sql("day:i demand:f", "SELECT * FROM daily", "daily"),
        "daily_rolling": _sql('day:i "window":i demand:f', _rolling([7, 14, 30]), "daily"),
        "rows_at_median": _sql(
            f"{_KEY} demand:f demand_median:f", "SELECT * FROM at_median", "at_median"
        ),
        "count_by_hour": _sql(
            "hour:i n:i",
            "SELECT hour, count(demand) AS n FROM at_median GROUP BY hour",
            "at_median",
        ),
        "pivot_day_hour": _sql(
            f"day:i {_HOURS}", _pivot("day", _day_hour("sum(demand)")), "dem"
        ),
        "pivot_day_hour_east": _sql(
            f"day:i {_HOURS}", _pivot("day", _day_hour("sum(demand)", "long > 90.73")), "dem"
        ),
        "pivot_day_hour_median": _sql(
            f"day:i {_HOURS}", _pivot("day", _day_hour("median(demand)")), "dem"
        ),
        "pivot_dow_hour": _sql(
            f"dow:i {_HOURS}",
            _pivot(
                "dow",
                "SELECT *, ((greatest(day, 0) - 6) % 7 + 7) % 7 AS dow FROM "
                f"({_day_hour('sum(demand)', 'long < 90.73')})",
            ),
            "dem",
        ),
        "demand_histogram": _sql("bin:i n:i", _histogram("dem", 20), "dem"),
        "weekend_histogram": _sql(
            "is_weekend:b bin:i n:i", _histogram(_DAY_HOUR_SUMS, 10, "is_weekend,"), "dem"
        ),
        "box_by_hour": _sql(
            "hour:i q25:f q50:f q75:f whisker_low:f whisker_high:f",
            """SELECT hour, q25, q50, q75,
                      min(demand) FILTER (WHERE inside) AS whisker_low,
                      max(demand) FILTER (WHERE inside) AS whisker_high
               FROM (SELECT dem.hour, demand, q25, q50, q75,
                            demand BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)
                              AS inside
                     FROM dem JOIN (
                       SELECT hour, quantile_cont(demand, 0.25) AS q25,
                              quantile_cont(demand, 0.5) AS q50,
                              quantile_cont(demand, 0.75) AS q75
                       FROM dem GROUP BY hour) q USING (hour))
               GROUP BY hour, q25, q50, q75""",
            "dem",
        ),
        "line_by_day": _sql(
            "day:i mean:f stderr:f n:i",
            """SELECT day, avg(demand) AS mean,
                      stddev_samp(demand) / sqrt(count(demand)) AS stderr, count(demand) AS n
               FROM dem GROUP BY day""",
            "dem",
        ),
        "line_by_hour": _sql(
            "geohash6:s is_weekend:b hour_p7:i mean:f stderr:f n:i",
            """SELECT geohash6, is_weekend, (hour + 7) % 24 AS hour_p7, avg(demand) AS mean,
                      stddev_samp(demand) / sqrt(count(demand)) AS stderr, count(demand) AS n
               FROM dem GROUP BY geohash6, is_weekend, (hour + 7) % 24""",
            "dem",
        ),
        "geo_density": _sql(
            "lat_cell:i long_cell:i n:i",
            """SELECT floor(lat / 0.05) AS lat_cell, floor(long / 0.05) AS long_cell,
                      count(*) AS n
               FROM (SELECT DISTINCT geohash6, lat, long FROM dem) GROUP BY ALL""",
            "dem",
        ),
        "place_series": _sql(
            "geohash6:s x:i demand:f y_hat:f",
            """SELECT *, row_number() OVER (PARTITION BY geohash6 ORDER BY day, hour, minute) - 1
                         AS x FROM judged""",
            "judged",
        ),
        "geo_clusters": _with_centres(
            """geohash6:s lat:f long:f cluster_geo:i cluster_geo_mid_lat:f cluster_geo_mid_long:f
               dist_to_center_km:f""",
            _ONE_CLUSTER_EACH.replace("{rows}", "places"),
            "dem",
        ),
        "full_features": _with_centres(
            f"{_CALENDAR} timestamp:s cluster_geo:i {_FEATURE_COLUMNS}", _FEATURES, "diffs"
        ),
        "scaled_target": _sql(
            f"{_KEY} scaled:f restored:f",
            """SELECT *, (demand - m) / s AS scaled, demand AS restored
               FROM comp, (SELECT avg(demand) AS m, stddev_pop(demand) AS s FROM comp)""",
            "comp",
        ).replace("comp AS (", "comp AS MATERIALIZED (", 1),
        "robust_scaled_target": _sql(
            f"{_KEY} scaled:f restored:f",
            """SELECT *, (demand - m) / s AS scaled, demand AS restored
               FROM dem, (SELECT median(demand) AS m,
                            quantile_cont(demand, 0.75) - quantile_cont(demand, 0.25) AS s
                          FROM dem)""",
            "dem",
        ),
    }
