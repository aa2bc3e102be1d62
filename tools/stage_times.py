"""Stage times from a Spark event log (no UI): the slowest stages with the
job description that ran them.

    python tools/stage_times.py <event-log-dir> [top]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    """Event-log lines; Spark 4 writes rolling, zstd-compressed files."""
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as raw, zstandard.ZstdDecompressor().stream_reader(raw) as fh:
            yield from io.TextIOWrapper(fh, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    files = [f for f in glob.glob(os.path.join(path, "**", "events_*"), recursive=True)
             + glob.glob(os.path.join(path, "*")) if os.path.isfile(f)
             and not os.path.basename(f).startswith((".", "appstatus"))]
    stages = []
    for f in sorted(set(files)):
        for line in _lines(f):
            if line.strip():
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    start, end = info.get("Submission Time"), info.get("Completion Time")
                    if start and end:
                        stages.append((end - start, info["Stage ID"], info["Number of Tasks"],
                                       info["Stage Name"][:60]))
    stages.sort(reverse=True)
    total = sum(s[0] for s in stages)
    print(f"{len(stages)} stages, {total / 1000:.1f} s summed")
    for ms, sid, tasks, name in stages[:top]:
        print(f"{ms / 1000:7.2f} s  stage {sid:4d}  tasks {tasks:4d}  {name}")


if __name__ == "__main__":
    main()
