"""Summarise a Spark event log: per job group (query) the wall time of each
stage, its task count and the longest vs median task (a skew signal).

    python tools/stage_times.py <event log file or folder> [--top N] [--by-group]

``--by-group`` sums stage time per job group (bench queries are named
``{query}#{attempt}``; a stream's micro-batches run under its run id).
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
from collections import defaultdict


def _files(path: str) -> list[str]:
    if os.path.isfile(path):
        return [path]
    parts = sorted(glob.glob(os.path.join(path, "events_*")), key=lambda p: int(p.rsplit("_", 2)[-2]) if p.rsplit("_", 2)[-2].isdigit() else 0)
    if parts:  # a rolling event log folder
        return parts
    latest = sorted(glob.glob(os.path.join(path, "*")), key=os.path.getmtime)[-1]
    return _files(latest)


def _lines(f: str):
    if f.endswith(".zstd"):
        import io

        import zstandard

        with open(f, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(f, encoding="utf-8") as fh:
            yield from fh


def load(path: str):
    for f in _files(path):
        for line in _lines(f):
            if line.strip():
                yield json.loads(line)


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[sys.argv.index("--top") + 1]) if "--top" in sys.argv else 15
    stage_group: dict[int, str] = {}
    stage_info: dict[int, dict] = {}
    tasks: dict[int, list[float]] = defaultdict(list)
    for ev in load(path):
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "-")
            for sid in ev.get("Stage IDs", []):
                stage_group[sid] = group
        elif kind == "SparkListenerTaskEnd":
            info = ev["Task Info"]
            tasks[ev["Stage ID"]].append((info["Finish Time"] - info["Launch Time"]) / 1000.0)
        elif kind == "SparkListenerStageCompleted":
            si = ev["Stage Info"]
            if "Submission Time" in si and "Completion Time" in si:
                stage_info[si["Stage ID"]] = {
                    "name": si["Stage Name"][:60],
                    "secs": (si["Completion Time"] - si["Submission Time"]) / 1000.0,
                    "tasks": si["Number of Tasks"],
                }
    rows = []
    for sid, info in stage_info.items():
        t = tasks.get(sid) or [0.0]
        rows.append((info["secs"], stage_group.get(sid, "-"), sid, info["tasks"], max(t), statistics.median(t), info["name"]))
    rows.sort(reverse=True)
    if "--by-group" in sys.argv:
        totals: dict[str, list[float]] = defaultdict(lambda: [0.0, 0])
        for secs, group, *_ in rows:
            totals[group][0] += secs
            totals[group][1] += 1
        print(f"{'secs':>7} {'stages':>6}  group")
        for group, (secs, n) in sorted(totals.items(), key=lambda kv: -kv[1][0])[:top]:
            print(f"{secs:7.2f} {n:6d}  {group}")
        return
    print(f"{'secs':>6} {'group':24} {'stage':>5} {'tasks':>5} {'max_task':>8} {'median':>7}  name")
    for secs, group, sid, n, mx, med, name in rows[:top]:
        print(f"{secs:6.2f} {group[:24]:24} {sid:5d} {n:5d} {mx:8.2f} {med:7.2f}  {name}")


if __name__ == "__main__":
    main()
