"""Hot-key experiment: task balance of the grouping operators when one key holds a third of the rows.

Usage: python tools/skew_experiment.py SCRATCH_DIR [rows]
Runs nest_children, dedup_on_key, first_n_per_key and assemble_pages on
generated rows (the supplied tables have no hot key), with Spark's event log
written below SCRATCH_DIR, then prints per reduce stage the task-time and
shuffle-records max / median.  A measurement tool — not a registered query.
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def stage_stats(event_dir: str) -> list:
    import zstandard

    stages, desc = {}, {}
    for path in sorted(glob.glob(f"{event_dir}/eventlog_v2_*/events_*")):
        with open(path, "rb") as fh:
            stream = zstandard.ZstdDecompressor().stream_reader(fh) if path.endswith(".zstd") else fh
            for line in io.TextIOWrapper(stream, encoding="utf-8"):
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    for s in e.get("Stage IDs", []):
                        desc[s] = e.get("Properties", {}).get("spark.job.description")
                elif e["Event"] == "SparkListenerTaskEnd":
                    ti, m = e["Task Info"], e.get("Task Metrics", {}) or {}
                    rec = (m.get("Shuffle Read Metrics", {}) or {}).get("Total Records Read", 0)
                    stages.setdefault(e["Stage ID"], []).append(((ti["Finish Time"] - ti["Launch Time"]) / 1000, rec))
    out = []
    for s, ds in sorted(stages.items()):
        t, r = [d for d, _ in ds], [x for _, x in ds]
        if max(r) > 0:
            out.append((desc.get(s), len(ds), max(t), statistics.median(t), max(r), statistics.median(r)))
    return out


def main() -> None:
    scratch = sys.argv[1]
    n = int(sys.argv[2]) if len(sys.argv) > 2 else 9_000_000
    hot = n // 3
    os.makedirs(f"{scratch}/events", exist_ok=True)
    from pyspark.sql import functions as F

    from reviewflow.operators import assemble as AS
    from reviewflow.operators import clean as C
    from reviewflow.operators import flatten as FL
    from reviewflow.session import get_session

    spark = get_session("local[8]", shuffle_partitions=64, extra={
        "spark.ui.showConsoleProgress": "false", "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": f"file://{os.path.abspath(scratch)}/events"})
    spark.sparkContext.setLogLevel("ERROR")
    base = spark.range(n, numPartitions=64).select(
        F.when(F.col("id") < hot, F.lit(0)).otherwise(F.col("id") % 100_000 + 1).alias("k"), F.col("id").alias("v"),
        F.when(F.col("id") < hot, F.col("id")).otherwise(F.col("id") / 100_000).cast("long").alias("pos"))
    pages = spark.range(1, hot + 1, numPartitions=64).select(
        F.lit("hot").alias("request_id"), F.col("id").cast("int").alias("page_no"), F.lit("OK").alias("status"),
        F.lit("t").alias("next_page_token"), F.array(F.col("id").cast("string")).alias("results"))
    runs = {
        "nest_children": FL.nest_children(base, ["k"], "pos", ["v"], array_name="c", chunk_size=10_000),
        "dedup_on_key": C.dedup_on_key(base, ["k"], [F.col("v").desc()]),
        "first_n_per_key": C.first_n_per_key(base, ["k"], ["v"], 5),
        "assemble_pages": AS.assemble_pages(pages),
    }
    for name, df in runs.items():
        spark.sparkContext.setJobDescription(name)
        t0 = time.time()
        df.write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.time() - t0:.2f} s")
    spark.stop()
    for name, tasks, tmax, tmed, rmax, rmed in stage_stats(f"{scratch}/events"):
        print(f"{name}: {tasks} reduce tasks, time max/median {tmax:.2f}/{tmed:.2f} s, "
              f"records max/median {rmax}/{int(rmed)}")


if __name__ == "__main__":
    main()
