"""Benchmark: the three reports at $BENCH_SF_DIR on local[$BENCH_CPUS].

As in the original benchmark, the reports run over the prepared (clean)
Parquet table; the preparation itself (flight view + cleaning + Parquet
write) is timed separately as ``prep_clean``.  Each report runs
$BENCH_REPS times in a warm session with a no-op sink (full execution, no
driver collect); the median is reported.  ``prep_clean`` is the median of
three writes, its first one is ``prep_clean_first``.

``cold`` holds whole-process times as the original benchmark measured them:
``python -m tarmac report qN VOLUME OUT`` with start, read and CSV output,
for the volumes (percent) in $BENCH_COLD (default 10,100,150; empty: none).
Prints ONE JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import re
import statistics
import subprocess
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "7"))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None

    t0 = time.perf_counter()
    from tarmac.operators.volumes import build_volumes
    from tarmac.plans import catalog as C
    from tarmac.plans import reports as R
    from tarmac.session import checkpoint_dir, get_session
    from tarmac.sources.catalog import register_table, run_sql_file

    event_dir = tempfile.mkdtemp(prefix="tarmac-bench-events-")
    spark = get_session(f"local[{cpus}]", app="tarmac-bench", shuffle_partitions=int(cpus),
                        conf={"spark.driver.memory": "16g", "spark.eventLog.enabled": "true",
                              "spark.eventLog.dir": event_dir,
                              "spark.eventLog.rolling.enabled": "false",
                              "spark.eventLog.compress": "false"})
    startup = time.perf_counter() - t0

    def run(df, label: str = "other") -> float:
        spark.sparkContext.setJobDescription(label)
        t = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    clean_path = f"{checkpoint_dir(spark).rstrip('/')}/tarmac_bench_clean_{uuid.uuid4().hex}"
    # untimed warm-up of the JVM and of the generated code on the smallest data
    small = sf_dir.rsplit("/", 1)[0] + "/sf0.001"
    if os.path.isdir(small):
        run(C.flights(spark, small).repartition(int(cpus)), "warm")
        run(C.q1_carrier_stats(spark, small), "warm")
    # The supplied lineitem is a single Parquet row group, so the derived
    # table comes out of one task; it is written as BENCH_CPUS files, the
    # way a table written by a cluster job is spread over many files.
    preps = []
    for _ in range(3):
        t = time.perf_counter()
        spark.sparkContext.setJobDescription("prep_clean#0")
        C.flights(spark, sf_dir).repartition(int(cpus)).write.mode("overwrite").parquet(clean_path)
        preps.append(time.perf_counter() - t)
    prep = statistics.median(preps)

    flights = spark.read.parquet(clean_path)
    register_table(spark, "bench_flights", df=flights)
    plans = {
        "q1_carrier_stats": lambda: R.carrier_stats(flights),
        "q2_report": lambda: R.airport_month_report(flights),
        "q3_anomaly_rank": lambda: R.carrier_vs_airport(flights),
        "sql_q1": lambda: run_sql_file(spark, "q1", {"flights": "bench_flights", "rate_scale": 2}),
        "sql_q2": lambda: run_sql_file(spark, "q2", {"flights": "bench_flights", "k": 3}),
        "sql_q3": lambda: run_sql_file(spark, "q3", {"flights": "bench_flights", "rate_scale": 2}),
        "q2_from_tables": lambda: C.q2_report(spark, sf_dir),
    }
    for name, build in plans.items():  # one untimed round: JIT, file listing cache
        run(build(), f"{name}#warm")
    times, best = {}, {}
    for name, build in plans.items():
        runs = [run(build(), f"{name}#{i}") for i in range(reps)]
        times[name] = round(statistics.median(runs), 3)
        best[name] = round(min(runs), 3)
    times["prep_clean"] = round(prep, 3)
    times["prep_clean_first"] = round(preps[0], 3)
    cold_at = [int(p) for p in os.environ.get("BENCH_COLD", "10,100,150").split(",") if p]
    volumes = build_volumes(flights, f"{checkpoint_dir(spark).rstrip('/')}/bench_volumes", cold_at) if cold_at else {}
    headline = ["q1_carrier_stats", "q2_report", "q3_anomaly_rank"]
    out = {
        "metric": "q1_q2_q3_wall_total",
        "value": round(sum(times[k] for k in headline), 3),
        "unit": "sec",
        "queries": times,
        "queries_best": best,
        "sf": sf,
        "rows_clean": flights.count(),
        "startup_sec": round(startup, 3),
        "cpus": int(cpus),
        "reps": reps,
    }
    spark.stop()
    out["cold"] = {f"{q}_{p}": cold(q, path, cpus) for p, path in volumes.items() for q in ("q1", "q2", "q3")}
    out["plan_stats"] = stage_stats(event_dir, headline)
    print(json.dumps(out))


def cold(report: str, volume: str, cpus: str) -> float:
    """Seconds of one report as a process of its own, from start to written CSV."""
    here = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tarmac-bench-cold-"), report)
    command = [sys.executable, "-m", "tarmac", "--conf", f"spark.master=local[{cpus}]", "--conf",
               f"spark.sql.shuffle.partitions={cpus}", "report", report, volume, out]
    t = time.perf_counter()
    subprocess.run(command, cwd=here, check=True, capture_output=True, timeout=600)
    return round(time.perf_counter() - t, 3)


def stage_stats(event_dir: str, names: list[str]) -> dict:
    """Per query (first repetition), from Spark's event log: stages run,
    rows read from files and bytes written to shuffle files."""
    jobs, stages = {}, {}
    for path in glob.glob(os.path.join(event_dir, "**", "*"), recursive=True):
        if not os.path.isfile(path):
            continue
        with open(path, errors="replace") as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description", "")
                    jobs.setdefault(desc, []).extend(ev.get("Stage IDs", []))
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                    stages[info["Stage ID"]] = acc
    out = {}
    for name in names:
        ids = [i for i in jobs.get(f"{name}#0", []) if i in stages]
        total = lambda key: int(sum(float(stages[i].get(key, 0) or 0) for i in ids))
        out[name] = {"stages": len(ids),
                     "input_rows": total("internal.metrics.input.recordsRead"),
                     "shuffle_write_bytes": total("internal.metrics.shuffle.write.bytesWritten"),
                     "shuffle_records": total("internal.metrics.shuffle.write.recordsWritten")}
    return out


if __name__ == "__main__":
    main()
