"""Skew probe: rank visits when one venue holds a third of them.

Builds the sf visits from the star tables, sends every third visit to one
venue, and ranks per (client, venue) twice: a plain window and
``distributed_row_number``. Spark's event log (written to a scratch folder)
gives the largest number of shuffle records one task read in each run.

Usage: python scripts/skew_probe.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from visitlens.operators import scoring  # noqa: E402
from visitlens.operators.ranking import distributed_row_number, top_n_per_group  # noqa: E402
from visitlens.session import get_spark  # noqa: E402
from visitlens.sources import fixtures as fx  # noqa: E402


def max_task_records(log_dir: str, job_group: str) -> tuple[int, int]:
    """(largest shuffle records read by one task, total) for jobs in a group."""
    stages, best, total = set(), 0, 0
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or "appstatus" in os.path.basename(path) or "eventlog" not in path:
            continue
        if path.endswith(".zstd"):
            import zstandard
            with open(path, "rb") as raw:
                text = zstandard.ZstdDecompressor().stream_reader(raw).read().decode()
        else:
            with open(path) as fh:
                text = fh.read()
        if True:
            for line in text.splitlines():
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    if props.get("spark.jobGroup.id") == job_group:
                        stages.update(ev.get("Stage IDs", []))
                elif kind == "SparkListenerTaskEnd" and ev.get("Stage ID") in stages:
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    n = m.get("Total Records Read", 0)
                    best, total = max(best, n), total + n
    return best, total


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-skew-")  # scratch: event log + skewed input
    # coalescing is off so task sizes show the split itself (at scale AQE only
    # merges partitions below its advisory size, which a hot slice is not)
    spark = get_spark("local[8]", 16, extra={"spark.eventLog.enabled": "true",
                                              "spark.sql.adaptive.coalescePartitions.enabled": "false",
                                              "spark.eventLog.dir": log_dir})
    wide = fx.section_scores_wide(spark, sf_dir)
    visits = scoring.visit_scores(scoring.wide_scores(wide), keep_raw_assessor=True)
    is_hot = F.col("respondent_id").cast("long") % 3 == 0
    hot = visits.withColumns({
        "client_name": F.when(is_hot, F.lit("client_hot")).otherwise(F.col("client_name")),
        "venue_name": F.when(is_hot, F.lit("HOT")).otherwise(F.col("venue_name"))})
    order = [F.col("visit_date").desc_nulls_last(), F.col("respondent_id").desc_nulls_first(),
             F.col("venue_name_original"), F.col("assessor_id_raw")]
    # materialise the skewed visits so the measured shuffles are the ranking's own
    sc0 = spark.sparkContext
    sc0.setJobGroup("prepare", "prepare")
    path = os.path.join(log_dir, "visits")
    hot.write.parquet(path)
    hot = spark.read.parquet(path)
    n_hot = hot.where(F.col("venue_name") == "HOT").count()
    n_all = hot.count()

    sc = spark.sparkContext
    sc.setJobGroup("plain", "plain window")
    plain = hot.withColumn("rn", F.row_number().over(Window.partitionBy("client_name", "venue_name").orderBy(*order)))
    plain.write.format("noop").mode("overwrite").save()
    sc.setJobGroup("distributed", "distributed row number")
    dist = distributed_row_number(hot, ["client_name", "venue_name"], order, "rn")
    dist.write.format("noop").mode("overwrite").save()
    sc.setJobGroup("top11", "ranks 1..11 per venue")
    top_n_per_group(hot, ["client_name", "venue_name"], order, 11, "rn").write.format("noop").mode("overwrite").save()
    # copies: every third visit appears eleven times; the visit total groups
    # on the raw keys and combines the copies map-side before its shuffle
    sc.setJobGroup("prepare", "prepare")
    wide_path = os.path.join(log_dir, "wide")
    scoring.wide_scores(wide).write.parquet(wide_path)
    w = spark.read.parquet(wide_path)
    times = F.when(F.col("respondent_id") % 3 == 0, F.sequence(F.lit(1), F.lit(11))).otherwise(F.array(F.lit(1)))
    copies = w.withColumn("_copy", F.explode(times)).drop("_copy")
    n_copies = copies.count()
    sc.setJobGroup("copies", "visit totals over copied rows")
    scoring.visit_scores(copies).write.format("noop").mode("overwrite").save()
    sc.setJobGroup("check", "check")
    same = plain.select("visit_id", "venue_name_original", "rn").exceptAll(
        dist.select("visit_id", "venue_name_original", "rn")).count() == 0
    spark.stop()
    out = {"rows": n_all, "hot_group_rows": n_hot, "same_ranks": same}
    for g in ("plain", "distributed"):
        best, total = max_task_records(log_dir, g)
        out[g] = {"max_shuffle_records_one_task": best, "shuffle_records_total": total}
    best, total = max_task_records(log_dir, "top11")
    out["top11"] = {"max_shuffle_records_one_task": best, "shuffle_records_total": total}
    best, total = max_task_records(log_dir, "copies")
    out["copies"] = {"input_rows": n_copies, "shuffle_records_total": total,
                     "max_shuffle_records_one_task": best}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
