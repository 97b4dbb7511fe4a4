-- Q3: each carrier at an airport against the airport's mean departure delay.
-- One aggregate per (airport, carrier); the airport mean is a window over
-- its unrounded sums, so it stays flight-weighted.  Sums are exact:
-- millionths of a minute as whole numbers; means are rounded half up once.
-- Parameters: :flights (table name), :rate_scale (decimals of the rate).
WITH pairs AS (
  SELECT origin, op_unique_carrier,
         count(*) AS numero_voli,
         sum(CAST(rint(dep_delay * 1000000) AS DECIMAL(18, 0))) FILTER (WHERE cancelled = 0) AS dep_sum,
         count(dep_delay) FILTER (WHERE cancelled = 0) AS dep_n,
         sum(CAST(rint(arr_delay * 1000000) AS DECIMAL(18, 0))) FILTER (WHERE cancelled = 0) AS arr_sum,
         count(arr_delay) FILTER (WHERE cancelled = 0) AS arr_n,
         round(count_if(cancelled = 1) * 100.0D / count(*), :rate_scale) AS tasso_cancellazione
  FROM IDENTIFIER(:flights)
  GROUP BY origin, op_unique_carrier
),
with_airport AS (
  SELECT *, sum(dep_sum) OVER (PARTITION BY origin) AS all_sum, sum(dep_n) OVER (PARTITION BY origin) AS all_n
  FROM pairs
),
means AS (
  SELECT origin, op_unique_carrier, numero_voli, tasso_cancellazione,
         if(dep_n > 0, sign(dep_sum) * ((200 * abs(dep_sum) + dep_n * 1000000) DIV (dep_n * 2000000)) / 100.0D, NULL)
           AS ritardo_medio_partenza,
         if(arr_n > 0, sign(arr_sum) * ((200 * abs(arr_sum) + arr_n * 1000000) DIV (arr_n * 2000000)) / 100.0D, NULL)
           AS ritardo_medio_arrivo,
         if(all_n > 0, sign(all_sum) * ((200 * abs(all_sum) + all_n * 1000000) DIV (all_n * 2000000)) / 100.0D, NULL)
           AS media_aeroporto
  FROM with_airport
)
SELECT origin AS aeroporto_partenza,
       op_unique_carrier AS compagnia,
       numero_voli, ritardo_medio_partenza, ritardo_medio_arrivo, tasso_cancellazione,
       round(ritardo_medio_partenza - media_aeroporto, 2) AS differenza,
       CAST(rank() OVER (PARTITION BY origin ORDER BY ritardo_medio_partenza ASC NULLS FIRST)
            AS BIGINT) AS classifica
FROM means
ORDER BY aeroporto_partenza, compagnia, classifica
