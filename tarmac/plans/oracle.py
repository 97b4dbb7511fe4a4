"""Oracle SQL (DuckDB dialect) for the correctness check.

Each text derives the flight view from the supplied tables.  All metrics
come from one definition: ``hist`` counts equal (carrier, origin, month,
flown, delays) rows with delays as whole minutes, ``facts`` holds integer
sums, counts and bounds of it per carrier, origin and month (and the minutes
of the five causes), and every report rolls ``facts`` up.  Means, rates and differences are integers too:
hundredths, rounded half-up once by integer division.  So nothing here
averages or rounds floating numbers, as the Spark plans do.
"""

from __future__ import annotations

from tarmac.schema import CAUSES

FLIGHT_VIEW = """
fv_join AS (
  SELECT l.l_shipdate, p.p_brand, sn.n_name AS origin, cn.n_name AS dest,
         CAST(l.l_orderkey AS BIGINT) * 7 + CAST(l.l_partkey AS BIGINT) * 13
           + CAST(l.l_suppkey AS BIGINT) * 17 + CAST(l.l_linenumber AS BIGINT) * 31 AS h,
         (CAST(l.l_orderkey AS BIGINT) * 17 + CAST(l.l_partkey AS BIGINT) * 31
           + CAST(l.l_linenumber AS BIGINT) * 7) % 220 - 40 AS d
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
),
fv_k AS (
  SELECT *, CASE WHEN h % 97 = 0 THEN d + 1500 ELSE d END AS dd, (h % 23 = 0) AS canc
  FROM fv_join
),
fv_k2 AS (
  SELECT *, (NOT canc AND h % 41 = 0) AS dvt FROM fv_k
),
fv_k3 AS (
  SELECT *,
         CASE WHEN canc OR dvt OR h % 59 = 0 THEN NULL
              ELSE CAST(dd + h % 31 - 15 AS DOUBLE) END AS arr
  FROM fv_k2
),
flights_raw AS (
  SELECT CAST(2024 AS BIGINT) AS year,
         CAST(month(l_shipdate) AS BIGINT) AS month,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS fl_date,
         p_brand AS op_unique_carrier,
         CASE WHEN h % 211 = 0 THEN NULL ELSE CAST(h % 9000 AS DOUBLE) END AS op_carrier_fl_num,
         origin, dest,
         CASE WHEN canc OR h % 53 = 0 THEN NULL ELSE CAST(dd AS DOUBLE) END AS dep_delay,
         arr AS arr_delay,
         CAST(CASE WHEN canc THEN 1 ELSE 0 END AS BIGINT) AS cancelled,
         CAST(CASE WHEN dvt THEN 1 ELSE 0 END AS BIGINT) AS diverted,
         CASE WHEN canc THEN CASE h % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C'
                                        ELSE 'D' END END AS cancellation_code,
         CASE WHEN arr >= 15 THEN h % 61 END AS carrier_delay,
         CASE WHEN arr >= 15 THEN h % 29 END AS weather_delay,
         CASE WHEN arr >= 15 THEN h % 37 END AS nas_delay,
         CASE WHEN arr >= 15 THEN h % 5 END AS security_delay,
         CASE WHEN arr >= 15 THEN h % 71 END AS late_aircraft_delay
  FROM fv_k3
),
raw_ok AS (
  SELECT * FROM flights_raw
  WHERE NOT coalesce(cancelled = 0 AND diverted = 0
                     AND (arr_delay IS NULL OR dep_delay IS NULL), false)
),
flights AS (
  SELECT month, CAST(fl_date AS TIMESTAMP) AS fl_date, op_unique_carrier, op_carrier_fl_num,
         origin, dest, dep_delay, arr_delay, cancelled, cancellation_code,
         CAST(coalesce(TRY_CAST(carrier_delay AS DOUBLE), 0) AS BIGINT) AS carrier_delay,
         CAST(coalesce(TRY_CAST(weather_delay AS DOUBLE), 0) AS BIGINT) AS weather_delay,
         CAST(coalesce(TRY_CAST(nas_delay AS DOUBLE), 0) AS BIGINT) AS nas_delay,
         CAST(coalesce(TRY_CAST(security_delay AS DOUBLE), 0) AS BIGINT) AS security_delay,
         CAST(coalesce(TRY_CAST(late_aircraft_delay AS DOUBLE), 0) AS BIGINT)
           AS late_aircraft_delay
  FROM raw_ok
  WHERE NOT coalesce(dep_delay < -30 OR dep_delay > 1440, false)
    AND NOT coalesce(arr_delay < -30 OR arr_delay > 1440, false)
)"""


def half_up(num: str, den: str, scale: int = 2) -> str:
    """``num / den`` in units of 10**-scale, rounded half away from zero; null for den = 0."""
    unit = 10 ** scale
    return (f"(CASE WHEN ({den}) > 0 THEN sign({num}) * "
            f"((2 * {unit} * abs({num}) + ({den})) // (2 * ({den}))) END)")


def as_number(units: str, scale: int = 2) -> str:
    return f"(CAST({units} AS DOUBLE) / {10 ** scale})"


def mean(kind: str, scale: int = 2) -> str:
    """Rolled-up mean delay of flown flights (``dep``, ``arr``) as a number."""
    return as_number(half_up(f"sum({kind}_sum)", f"sum({kind}_n)", scale), scale)


def rate(scale: int = 2) -> str:
    return as_number(half_up("100 * sum(gone)", "sum(voli)", scale), scale)


LATE_MEAN = as_number(half_up("sum(late_sum)", "sum(voli)"))

FACTS = f"""
hist AS (
  SELECT op_unique_carrier AS carrier, origin, month, cancelled = 0 AS flown,
         CAST(dep_delay AS BIGINT) AS dep, CAST(arr_delay AS BIGINT) AS arr, count(*) AS n,
         [sum(carrier_delay), sum(weather_delay), sum(nas_delay), sum(security_delay),
          sum(late_aircraft_delay)] AS minutes
  FROM flights GROUP BY ALL
),
facts AS (
  SELECT carrier, origin, month, CAST(sum(n) AS BIGINT) AS voli,
         coalesce(sum(n) FILTER (NOT flown), 0) AS gone,
         coalesce(sum(dep * n) FILTER (flown), 0) AS dep_sum,
         coalesce(sum(n) FILTER (flown AND dep IS NOT NULL), 0) AS dep_n,
         coalesce(sum(arr * n) FILTER (flown), 0) AS arr_sum,
         coalesce(sum(n) FILTER (flown AND arr IS NOT NULL), 0) AS arr_n,
         coalesce(sum(arr * n) FILTER (arr > 0), 0) AS late_sum,
         min(arr) FILTER (flown AND arr > 0) AS first_late, max(arr) FILTER (flown) AS last_arr,
         coalesce(sum(n) FILTER (flown AND dep <= 14), 0) AS basso,
         coalesce(sum(n) FILTER (flown AND dep > 14 AND dep <= 60), 0) AS medio,
         coalesce(sum(n) FILTER (flown AND dep > 60), 0) AS alto,
         {", ".join(f"coalesce(sum(minutes[{i}]) FILTER (flown), 0) AS m{i}" for i in range(1, 6))}
  FROM hist GROUP BY ALL
)"""


def with_flights(body: str, ctes: str = "") -> str:
    extra = f",\n{ctes}" if ctes else ""
    return f"WITH {FLIGHT_VIEW.strip()},{FACTS}{extra}\n{body}"


LATE_BOUNDS = """CAST(coalesce(min(first_late), 0) AS DOUBLE) AS ritardo_minimo,
       CAST(coalesce(max(last_arr), 0) AS DOUBLE) AS ritardo_massimo"""


def q1(rate_scale: int = 2) -> str:
    return f"""
SELECT carrier AS codice, origin AS aeroporto_partenza, month AS mese,
       CAST(sum(voli) AS BIGINT) AS numero_voli, {LATE_BOUNDS},
       {LATE_MEAN} AS ritardo_medio, {rate(rate_scale)} AS tasso_cancellazione
FROM facts GROUP BY ALL
"""


Q1 = q1()

BANDS = """
SELECT origin, month, CAST(sum(basso) AS BIGINT) AS numero_ritardi_basso,
       CAST(sum(medio) AS BIGINT) AS numero_ritardi_medio, CAST(sum(alto) AS BIGINT) AS numero_ritardi_alto
FROM facts GROUP BY ALL
"""

MEANS = f"""{mean("dep")} AS ritardo_medio_partenza, {mean("arr")} AS ritardo_medio_arrivo"""

# Causes: the minutes of a month as pairs (minus minutes, cause), so that sorted pairs are ranked causes.
_PAIRS = ", ".join(f"{{'m': -CAST(sum(m{i}) AS BIGINT), 'c': '{name}'}}" for i, name in enumerate(CAUSES.values(), 1))
_LABEL = "p.c || ' (' || abs(p.m) || ' min)'"

CAUSE_UNION = f"""
cause_list AS (
  SELECT origin, month, list_sort([{_PAIRS}]) AS pairs
  FROM facts GROUP BY origin, month HAVING sum(voli) > sum(gone)
),
cause_ranked AS (
  SELECT origin, month, p.c AS causa, -p.m AS minuti_totali, ranking, {_LABEL} AS cause_desc
  FROM (SELECT origin, month, unnest(pairs) AS p, generate_subscripts(pairs, 1) AS ranking FROM cause_list)
),
cause_sums AS (SELECT origin, month, causa, minuti_totali FROM cause_ranked),
cause_top AS (
  SELECT origin, month,
         CAST(list_transform(pairs[1:3], lambda p: {_LABEL}) AS VARCHAR) AS cause_maggiori
  FROM cause_list
),
bands AS ({BANDS})"""

# Without flown flights there is no list: the left side of the join stands alone.
Q2 = """
SELECT b.origin AS aeroporto_partenza, b.month AS mese,
       b.numero_ritardi_basso, b.numero_ritardi_medio, b.numero_ritardi_alto,
       ifnull(t.cause_maggiori, '[]') AS cause_maggiori
FROM bands b LEFT JOIN cause_top t ON b.origin = t.origin AND b.month = t.month
"""

# Q3: pairs and airports are two roll-ups of the facts; their means stay integer hundredths.
Q3_CTES = f"""
airport_stat AS (
  SELECT origin, {half_up("sum(dep_sum)", "sum(dep_n)")} AS units FROM facts GROUP BY ALL
),
pair_stat AS (
  SELECT origin, carrier, CAST(sum(voli) AS BIGINT) AS numero_voli,
         {half_up("sum(dep_sum)", "sum(dep_n)")} AS dep_units, {half_up("sum(arr_sum)", "sum(arr_n)")} AS arr_units,
         {rate()} AS tasso_cancellazione
  FROM facts GROUP BY ALL
),
q3 AS (
  SELECT p.origin AS aeroporto_partenza, p.carrier AS compagnia, p.numero_voli,
         {as_number("p.dep_units")} AS ritardo_medio_partenza,
         {as_number("p.arr_units")} AS ritardo_medio_arrivo, p.tasso_cancellazione,
         {as_number("p.dep_units - a.units")} AS differenza,
         1 + (SELECT count(*) FROM pair_stat o WHERE o.origin = p.origin
              AND coalesce(o.dep_units, -1e18) < coalesce(p.dep_units, -1e18)) AS classifica
  FROM pair_stat p JOIN airport_stat a USING (origin)
)"""
