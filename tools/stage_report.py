"""Stage times per query from a Spark event log (no UI, no REST server).

Usage:
    BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tools/stage_report.py <that dir> [top_n]

bench.py runs each query in its own job group (``bench-<query>``); this prints,
per query, the number of stages, the summed stage time and the slowest stages
with their task counts.  Reads plain or zstd-compressed event logs, rolling
(directory) or single-file.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for f in files:
        with open(f, "rb") as fh:
            if f.endswith(".zstd"):
                import zstandard
                stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            else:
                stream = io.TextIOWrapper(fh, encoding="utf-8")
            yield from stream


def stage_times(log: str) -> dict[str, list[tuple[float, int, int, str]]]:
    group_of, stages = {}, defaultdict(list)
    for line in _lines(log):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            group = ev.get("Properties", {}).get("spark.jobGroup.id")
            for sid in ev.get("Stage IDs", []):
                group_of[sid] = group
        elif kind == "SparkListenerStageCompleted":
            si = ev["Stage Info"]
            sec = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
            stages[group_of.get(si["Stage ID"])].append((sec, si["Stage ID"], si["Number of Tasks"],
                                                         si["Stage Name"][:60]))
    return stages


def main(argv) -> None:
    root = argv[1]
    top = int(argv[2]) if len(argv) > 2 else 3
    logs = [p for p in glob.glob(os.path.join(root, "*")) if not os.path.basename(p).startswith(".")]
    for log in logs:
        for group, rows in sorted(stage_times(log).items(), key=lambda kv: -sum(r[0] for r in kv[1])):
            print(f"{group or '(no group)'}: {len(rows)} stages, {sum(r[0] for r in rows):.2f} s of stage time")
            for sec, sid, tasks, name in sorted(rows, reverse=True)[:top]:
                print(f"    {sec:7.2f} s  stage {sid:<5d} tasks={tasks:<4d} {name}")


if __name__ == "__main__":
    main(sys.argv)
