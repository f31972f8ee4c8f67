"""Summarize a Spark event log: wall time, stages, tasks and task time per job group.

Usage: python tests/stage_times.py <event-log folder or file> [top_n]
(bench.py names each query's jobs with the query key as job group.)
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _files(path: str):
    if os.path.isfile(path):
        yield path
        return
    for root, _, names in os.walk(path):
        for n in sorted(names):
            if not n.startswith(".") and not n.startswith("appstatus"):
                yield os.path.join(root, n)


def _lines(f: str):
    if f.endswith(".zstd"):
        import io

        import zstandard

        with open(f, "rb") as raw:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
    else:
        with open(f) as fh:
            yield from fh


def events(path: str):
    """Events of a log file or folder (Spark 4 writes rolling, zstd-compressed logs)."""
    for f in _files(path):
        for line in _lines(f):
            if line.strip():
                yield json.loads(line)


def summarize(path: str) -> dict:
    job_group, job_time, stage_job = {}, {}, {}
    per = defaultdict(lambda: {"jobs": 0, "stages": 0, "tasks": 0, "task_ms": 0, "job_ms": 0,
                               "shuffle_read_mb": 0.0, "shuffle_write_mb": 0.0})
    for e in events(path):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            g = props.get("spark.jobGroup.id", "-")
            job_group[e["Job ID"]] = g
            job_time[e["Job ID"]] = e["Submission Time"]
            for sid in e.get("Stage IDs", []):
                stage_job[sid] = e["Job ID"]
            per[g]["jobs"] += 1
        elif kind == "SparkListenerJobEnd":
            g = job_group.get(e["Job ID"], "-")
            per[g]["job_ms"] += e["Completion Time"] - job_time.get(e["Job ID"], e["Completion Time"])
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            g = job_group.get(stage_job.get(info["Stage ID"]), "-")
            per[g]["stages"] += 1
            per[g]["tasks"] += info.get("Number of Tasks", 0)
        elif kind == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            g = job_group.get(stage_job.get(e["Stage ID"]), "-")
            per[g]["task_ms"] += m.get("Executor Run Time", 0)
            per[g]["shuffle_read_mb"] += (m.get("Shuffle Read Metrics", {}).get("Remote Bytes Read", 0)
                                          + m.get("Shuffle Read Metrics", {}).get("Local Bytes Read", 0)) / 2**20
            per[g]["shuffle_write_mb"] += m.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0) / 2**20
    return per


def main(argv):
    per = summarize(argv[1])
    top = int(argv[2]) if len(argv) > 2 else 20
    print(f"{'job group':32} {'jobs':>5} {'stages':>6} {'tasks':>6} {'job s':>7} {'task s':>7} {'shufR MB':>9} {'shufW MB':>9}")
    for g, v in sorted(per.items(), key=lambda kv: -kv[1]["job_ms"])[:top]:
        print(f"{g[:32]:32} {v['jobs']:5} {v['stages']:6} {v['tasks']:6} {v['job_ms'] / 1000:7.2f} "
              f"{v['task_ms'] / 1000:7.2f} {v['shuffle_read_mb']:9.1f} {v['shuffle_write_mb']:9.1f}")


if __name__ == "__main__":
    main(sys.argv)
