-- Q2: departure-delay bands and the top-3 causes per origin airport and month.
-- One aggregate for bands and cause sums; causes exploded with the bands, ranked, regrouped.
-- Parameters: :flights (table name), :k (causes listed).
WITH per_month AS (
  SELECT origin, month,
         count_if(cancelled = 0 AND dep_delay < 15.0) AS numero_ritardi_basso,
         count_if(cancelled = 0 AND dep_delay BETWEEN 15.0 AND 60.0) AS numero_ritardi_medio,
         count_if(cancelled = 0 AND dep_delay > 60.0) AS numero_ritardi_alto,
         count_if(cancelled = 0) AS flown,
         sum(carrier_delay) FILTER (WHERE cancelled = 0) AS c_carrier,
         sum(weather_delay) FILTER (WHERE cancelled = 0) AS c_weather,
         sum(nas_delay) FILTER (WHERE cancelled = 0) AS c_nas,
         sum(security_delay) FILTER (WHERE cancelled = 0) AS c_security,
         sum(late_aircraft_delay) FILTER (WHERE cancelled = 0) AS c_late
  FROM IDENTIFIER(:flights)
  GROUP BY origin, month
),
causes AS (
  -- months without flown flights keep one row without a cause, so the bands need no second read
  SELECT origin, month, numero_ritardi_basso, numero_ritardi_medio, numero_ritardi_alto,
         c.causa, c.minuti
  FROM per_month
  LATERAL VIEW OUTER explode(if(flown > 0, array(
      named_struct('causa', 'Carrier', 'minuti', c_carrier),
      named_struct('causa', 'Weather', 'minuti', c_weather),
      named_struct('causa', 'NAS', 'minuti', c_nas),
      named_struct('causa', 'Security', 'minuti', c_security),
      named_struct('causa', 'Late Aircraft', 'minuti', c_late)), NULL)) x AS c
),
ranked AS (
  SELECT *,
         row_number() OVER (PARTITION BY origin, month
                            ORDER BY minuti DESC NULLS LAST, causa) AS ranking
  FROM causes
)
SELECT origin AS aeroporto_partenza, month AS mese,
       numero_ritardi_basso, numero_ritardi_medio, numero_ritardi_alto,
       -- a cause without minutes has no text; concat leaves it null and the list drops it
       CASE WHEN count(causa || minuti) = 0 THEN '[]' ELSE concat('[\'',
         array_join(transform(array_sort(collect_list(named_struct(
             'r', ranking, 'l', concat(causa, ' (', CAST(minuti AS STRING), ' min)')))),
             e -> e.l), '\', \''), '\']') END AS cause_maggiori
FROM ranked
WHERE ranking <= :k
GROUP BY origin, month, numero_ritardi_basso, numero_ritardi_medio, numero_ritardi_alto
ORDER BY aeroporto_partenza, mese
