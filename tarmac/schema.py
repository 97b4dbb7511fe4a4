"""Schemas, column roles and the fixed values of the flight reports."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the original analyses for equal results.
# ---------------------------------------------------------------------------
# Target columns of the clean table, in order.
TARGET_COLUMNS = [
    "month", "fl_date",
    "op_unique_carrier", "op_carrier_fl_num",
    "origin", "dest",
    "dep_delay", "arr_delay",
    "cancelled", "cancellation_code",
    "carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay",
]
# Delay-cause columns and their display names, in this order.
CAUSES = {
    "carrier_delay": "Carrier",
    "weather_delay": "Weather",
    "nas_delay": "NAS",
    "security_delay": "Security",
    "late_aircraft_delay": "Late Aircraft",
}
# Plausible delay range in minutes; rows outside it are outliers (bounds kept).
OUTLIER_LOW = -30.0
OUTLIER_HIGH = 60.0 * 24
# Departure-delay bands: low < 15, medium 15..60 (both ends), high > 60.
BAND_LOW_BELOW = 15.0
BAND_HIGH_ABOVE = 60.0
# Volumes of the benchmark, percent of the clean table, and the sampling seed.
VOLUME_PERCENTS = [10, 25, 50, 75, 100, 150]
SAMPLE_SEED = 42
# Number of causes listed per airport and month.
TOP_CAUSES = 3
# Constant year of the raw extract (dropped by cleaning).
RAW_YEAR = 2024
# Output column names of the three reports.
Q1_COLUMNS = ["codice", "aeroporto_partenza", "numero_voli", "ritardo_minimo",
              "ritardo_massimo", "ritardo_medio", "tasso_cancellazione", "mese"]
Q2_COLUMNS = ["aeroporto_partenza", "mese", "numero_ritardi_basso",
              "numero_ritardi_medio", "numero_ritardi_alto", "cause_maggiori"]
Q3_COLUMNS = ["aeroporto_partenza", "compagnia", "numero_voli", "ritardo_medio_partenza",
              "ritardo_medio_arrivo", "tasso_cancellazione", "differenza", "classifica"]
# Benchmark run-log columns.
RUNLOG_COLUMNS = ["percentuale", "motore", "analisi", "tempo_secondi", "status"]
# ---------------------------------------------------------------------------

CAUSE_COLUMNS = list(CAUSES)

_TYPES = {T.StringType(): ["fl_date", "op_unique_carrier", "origin", "dest", "cancellation_code"],
          T.DoubleType(): ["op_carrier_fl_num", "dep_delay", "arr_delay"]}
_TYPE_OF = {c: kind for kind, columns in _TYPES.items() for c in columns}


def _schema(columns: list[str], **other: T.DataType) -> T.StructType:
    """Columns with their types: whole numbers where nothing else is said."""
    return T.StructType([T.StructField(c, other.get(c, _TYPE_OF.get(c, T.LongType()))) for c in columns])


# The raw extract has two more columns, which cleaning uses or drops.
_AFTER_CANCELLED = TARGET_COLUMNS.index("cancelled") + 1
RAW_SCHEMA = _schema(["year", *TARGET_COLUMNS[:_AFTER_CANCELLED], "diverted", *TARGET_COLUMNS[_AFTER_CANCELLED:]])
CLEAN_SCHEMA = _schema(TARGET_COLUMNS, fl_date=T.TimestampNTZType())

# Column list of a table DDL.
CLEAN_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CLEAN_SCHEMA)

RUNLOG_SCHEMA = T.StructType([
    T.StructField("percentuale", T.IntegerType()),
    T.StructField("motore", T.StringType()),
    T.StructField("analisi", T.StringType()),
    T.StructField("tempo_secondi", T.IntegerType()),
    T.StructField("status", T.IntegerType()),
])
