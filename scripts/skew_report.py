"""Per-task shuffle records of the group sequence number, plain window vs
skew-safe, read from Spark's event log (written to a fresh scratch folder).

    python scripts/skew_report.py [sf_dir]

The orders stand-in is given a hot group: every sentinel-account row gets the
same status, so one (account, status) key holds about a fifth of the rows.
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from txlake.operators.explore import sequence_number  # noqa: E402
from txlake.plans.standins import orders_as_transactions  # noqa: E402
from txlake.sources.files import read_table  # noqa: E402


def _events(folder: str):
    for f in sorted(glob.glob(f"{folder}/**/events_*", recursive=True)):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="txlake-evlog-")
    spark = (SparkSession.builder.master("local[8]").appName("skew-report")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.adaptive.enabled", "true")
             # raw partition sizes: coalescing would merge the small ones and
             # hide how the rows were distributed
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", f"file://{logdir}")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    tx = orders_as_transactions(read_table(spark, sf, "orders"))
    tx = tx.withColumn("status", F.when(F.col("account_number_from") == -1, "queued")
                       .otherwise(F.col("status")))
    keys, order = ["account_number_from", "status"], ["transaction_dt", "operation_id"]
    for label, skew_safe in (("window", False), ("skew_safe", True)):
        spark.sparkContext.setJobGroup(label, label)
        sequence_number(tx, keys, order, skew_safe=skew_safe) \
            .write.format("noop").mode("overwrite").save()
    spark.stop()
    group, recs = {}, {}
    for e in _events(logdir):
        if e["Event"] == "SparkListenerJobStart":
            for s in e["Stage IDs"]:
                group[s] = e.get("Properties", {}).get("spark.jobGroup.id")
        elif e["Event"] == "SparkListenerTaskEnd":
            n = ((e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}) \
                .get("Total Records Read", 0)
            if n:
                recs.setdefault(e["Stage ID"], []).append(n)
    for s, v in sorted(recs.items()):
        print(f"{group.get(s)} stage {s}: tasks {len(v)}, max {max(v)}, "
              f"median {int(statistics.median(v))}, total {sum(v)}")


if __name__ == "__main__":
    main()
