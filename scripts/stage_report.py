"""Summarise a Spark event log per job description (bench.py sets one per query).

usage: python scripts/stage_report.py <event log file or folder>

For each description: jobs, stages, tasks, summed stage wall time and summed
task run time, and the stage with the longest wall time. Reads only the log
file Spark wrote; no UI or REST endpoint is involved.
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _lines(f: str):
    if f.endswith(".zstd"):
        import io

        import zstandard
        with open(f, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(f) as fh:
            yield from fh


def main(path: str) -> int:
    # Spark 4 writes rolling logs: <dir>/eventlog_v2_<app>/events_<n>_<app>[.codec]
    files = ([os.path.join(r, f) for r, _, fs in sorted(os.walk(path)) for f in sorted(fs)
              if f.startswith("events_") or f.startswith("local-") or f.startswith("app-")]
             if os.path.isdir(path) else [path])
    stage_desc, stats = {}, defaultdict(lambda: {"jobs": 0, "stages": 0, "tasks": 0, "stage_ms": 0,
                                                  "task_ms": 0, "longest": (0, None)})
    task_ms = defaultdict(int)
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerJobStart":
                desc = (e.get("Properties") or {}).get("spark.job.description", "-")
                stats[desc]["jobs"] += 1
                for sid in e.get("Stage IDs", []):
                    stage_desc[sid] = desc
            elif kind == "SparkListenerTaskEnd":
                info = e.get("Task Info", {})
                task_ms[e.get("Stage ID")] += info.get("Finish Time", 0) - info.get("Launch Time", 0)
            elif kind == "SparkListenerStageCompleted":
                st = e["Stage Info"]
                sid = st["Stage ID"]
                desc = stage_desc.get(sid, "-")
                wall = st.get("Completion Time", 0) - st.get("Submission Time", 0)
                s = stats[desc]
                s["stages"] += 1
                s["tasks"] += st.get("Number of Tasks", 0)
                s["stage_ms"] += wall
                s["task_ms"] += task_ms.get(sid, 0)
                if wall > s["longest"][0]:
                    s["longest"] = (wall, st.get("Stage Name", "")[:60])
    print(f"{'query':28} {'jobs':>5} {'stages':>6} {'tasks':>6} {'stage_s':>8} {'task_s':>7}  longest stage")
    for desc, s in sorted(stats.items(), key=lambda kv: -kv[1]["stage_ms"]):
        print(f"{desc[:28]:28} {s['jobs']:5d} {s['stages']:6d} {s['tasks']:6d} {s['stage_ms'] / 1000:8.2f} "
              f"{s['task_ms'] / 1000:7.2f}  {s['longest'][0] / 1000:.2f}s {s['longest'][1]}")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1]))
