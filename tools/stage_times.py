"""Stage and task times from a Spark event log (no web UI involved).

Usage: python tools/stage_times.py <event-log file or folder> [top N]

Per bench query: stages, tasks, summed stage wall time, shuffle bytes
written and read, input bytes.  Stages are placed in a query by their
submission time, using the ``windows.json`` that ``bench.py`` writes next to
the log (``BENCH_EVENT_LOG``); without it everything is listed under ``-``.
Then the N longest stages with their names.
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _lines(f: str):
    if f.endswith(".zstd"):  # Spark 4 compresses event logs with zstd by default
        import io

        import zstandard

        with open(f, "rb") as raw:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True), encoding="utf-8")
    else:
        with open(f) as fh:
            yield from fh


def _events(path: str):
    """Events of a log file, or of every ``events_*`` / plain log file below
    a folder (Spark 4 writes one folder per application)."""
    if os.path.isdir(path):
        files = sorted(
            os.path.join(d, f)
            for d, _, names in os.walk(path)
            for f in names
            if not f.startswith((".", "appstatus")) and f != "windows.json"
        )
    else:
        files = [path]
    for f in files:
        for line in _lines(f):
            if line.strip():
                yield json.loads(line)


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    windows = []
    wfile = os.path.join(path, "windows.json") if os.path.isdir(path) else ""
    if wfile and os.path.exists(wfile):
        with open(wfile) as fh:
            windows = json.load(fh)

    def query_at(ms: int) -> str:
        return next((n for n, a, b in windows if a <= ms <= b), "-")

    stage_group: dict[int, str] = {}
    stages: dict[int, dict] = {}
    task_sums: dict[int, dict] = defaultdict(lambda: defaultdict(int))
    for e in _events(path):
        kind = e.get("Event")
        if kind == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            t = task_sums[e["Stage ID"]]
            t["tasks"] += 1
            t["shuffle_write"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
            r = m.get("Shuffle Read Metrics") or {}
            t["shuffle_read"] += r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)
            t["input"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            if "Completion Time" in info and "Submission Time" in info:
                stages[info["Stage ID"]] = {"name": info.get("Stage Name", ""), "ms": info["Completion Time"] - info["Submission Time"]}
                stage_group[info["Stage ID"]] = query_at(info["Submission Time"])

    groups: dict[str, dict] = defaultdict(lambda: defaultdict(int))
    for sid, st in stages.items():
        g = groups[stage_group.get(sid, "-")]
        g["stages"] += 1
        g["stage_ms"] += st["ms"]
        for k, v in task_sums[sid].items():
            g[k] += v
    print(f"{'query':24} {'stages':>6} {'tasks':>6} {'stage_ms':>9} {'shuf_w_MB':>9} {'shuf_r_MB':>9} {'input_MB':>9}")
    for name, g in sorted(groups.items()):
        print(
            f"{name[:24]:24} {g['stages']:6d} {g['tasks']:6d} {g['stage_ms']:9d} "
            f"{g['shuffle_write'] / 1e6:9.1f} {g['shuffle_read'] / 1e6:9.1f} {g['input'] / 1e6:9.1f}"
        )
    print(f"\nlongest {top} stages")
    for sid, st in sorted(stages.items(), key=lambda kv: -kv[1]["ms"])[:top]:
        t = task_sums[sid]
        print(f"  stage {sid:5d} {st['ms']:7d} ms  tasks {t['tasks']:4d}  [{stage_group.get(sid, '-')}] {st['name'][:70]}")


if __name__ == "__main__":
    main()
