"""Slowest stages from a Spark event log (no UI needed).

usage: python tools/stage_times.py <event-log-file-or-folder> [top]
Write the log with BENCH_EVENT_LOG=<folder> python bench.py.
"""

from __future__ import annotations

import io
import json
import os
import sys


def _lines(path: str):
    """Lines of a plain or zstd-compressed event log file (Spark 4 rolls logs)."""
    if path.endswith((".zstd", ".zst")):
        import zstandard

        with open(path, "rb") as raw:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def _files(path: str):
    if not os.path.isdir(path):
        yield path
        return
    for name in sorted(os.listdir(path)):
        full = os.path.join(path, name)
        if os.path.isdir(full):
            yield from _files(full)
        elif not (name.startswith((".", "appstatus")) or name.endswith(".crc")):
            yield full


def stages(path: str):
    """(seconds, stage id, tasks, name) for every completed stage."""
    for f in _files(path):
        for line in _lines(f):
            if not line.strip():
                continue
            ev = json.loads(line)
            if ev.get("Event") != "SparkListenerStageCompleted":
                continue
            info = ev["Stage Info"]
            start, end = info.get("Submission Time"), info.get("Completion Time")
            if start and end:
                yield (end - start) / 1000.0, info["Stage ID"], info["Number of Tasks"], info["Stage Name"]


def main() -> None:
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    rows = sorted(stages(sys.argv[1]), reverse=True)
    print(f"{len(rows)} stages, {sum(r[0] for r in rows):.1f} s in total")
    for secs, sid, tasks, name in rows[:top]:
        print(f"{secs:7.2f}s  stage {sid:5d}  tasks {tasks:4d}  {name[:90]}")


if __name__ == "__main__":
    main()
