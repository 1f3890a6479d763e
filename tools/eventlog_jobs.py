"""Per-job wall time from a Spark event log (no UI needed).

Usage: BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py
       python tools/eventlog_jobs.py $BENCH_EVENT_LOG_DIR

Prints, for each job: duration, the idle gap before it (driver-side planning
and commits), stage count, the job description and the call site.
"""

from __future__ import annotations

import glob
import io
import json
import sys


def _events(path: str):
    raw = open(path, "rb").read()
    if path.endswith(".zstd"):
        import zstandard

        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    for line in raw.decode("utf-8", "replace").splitlines():
        yield json.loads(line)


def main(folder: str) -> None:
    jobs: dict[int, list] = {}
    for path in sorted(glob.glob(f"{folder}/*/events_*") + glob.glob(f"{folder}/*.zstd")):
        for e in _events(path):
            if e["Event"] == "SparkListenerJobStart":
                props = e.get("Properties", {})
                jobs[e["Job ID"]] = [
                    e["Submission Time"], None, props.get("spark.job.description", ""),
                    props.get("callSite.short", ""), len(e.get("Stage Infos", [])),
                ]
            elif e["Event"] == "SparkListenerJobEnd" and e["Job ID"] in jobs:
                jobs[e["Job ID"]][1] = e["Completion Time"]
    prev = None
    for job, (start, end, desc, site, stages) in sorted(jobs.items()):
        gap = start - prev if prev else 0
        took = (end or start) - start
        print(f"job {job:4d} {took:7d} ms  gap {gap:6d} ms  stages {stages}  {desc[:20]:20s} {site[:70]}")
        prev = end or start


if __name__ == "__main__":
    main(sys.argv[1])
