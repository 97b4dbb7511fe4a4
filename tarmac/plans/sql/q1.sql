-- Q1: statistics per carrier, origin airport and month.
-- Delay sums are exact: millionths of a minute as whole numbers, rounded half up once.
-- Parameters: :flights (table name), :rate_scale (decimals of the rate).
SELECT op_unique_carrier AS codice,
       origin AS aeroporto_partenza,
       count(*) AS numero_voli,
       coalesce(min(arr_delay) FILTER (WHERE cancelled = 0 AND arr_delay >= 1.0), 0.0)
         AS ritardo_minimo,
       coalesce(max(arr_delay) FILTER (WHERE cancelled = 0), 0.0) AS ritardo_massimo,
       -- late minutes averaged over ALL flights: early, cancelled, diverted count 0
       ((200 * sum(CAST(rint(greatest(0.0D, coalesce(arr_delay, 0.0D)) * 1000000) AS DECIMAL(18, 0)))
         + count(*) * 1000000) DIV (count(*) * 2000000)) / 100.0D AS ritardo_medio,
       round(count_if(cancelled = 1) * 100.0D / count(*), :rate_scale) AS tasso_cancellazione,
       month AS mese
FROM IDENTIFIER(:flights)
GROUP BY op_unique_carrier, origin, month
ORDER BY codice, aeroporto_partenza, mese
