"""Slowest stages of a Spark event log: ``python tools/stage_times.py EVENT_LOG_DIR [N]``.

Reads the JSON-lines event log Spark writes with ``spark.eventLog.enabled``
(``bench.py`` writes one when ``BENCH_EVENT_LOG_DIR`` is set) and prints the
N longest stages with their task count, input and shuffle bytes.
"""

from __future__ import annotations

import json
import os
import sys


def _lines(f: str):
    if f.endswith(".zstd"):  # Spark compresses event logs with zstd by default
        import io

        import zstandard

        with open(f, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(f, encoding="utf-8") as fh:
            yield from fh


def events(path: str):
    files = []
    for root, _, names in os.walk(path):
        files += [os.path.join(root, n) for n in names if not n.startswith(".")]
    for f in sorted(files):
        for line in _lines(f):
            try:
                yield json.loads(line)
            except ValueError:
                continue


def main() -> None:
    path, top = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    for e in events(path):
        if e.get("Event") != "SparkListenerStageCompleted":
            continue
        info = e["Stage Info"]
        start, end = info.get("Submission Time"), info.get("Completion Time")
        if start is None or end is None:
            continue
        acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
        stages.append((end - start, info["Stage ID"], info["Number of Tasks"], info["Stage Name"][:60],
                       acc.get("internal.metrics.input.bytesRead", 0),
                       acc.get("internal.metrics.shuffle.write.bytesWritten", 0)))
    stages.sort(reverse=True)
    print(f"{len(stages)} stages, {sum(s[0] for s in stages) / 1000:.1f} s in total")
    print(f"{'ms':>7} {'stage':>6} {'tasks':>6} {'input':>12} {'shuffle_w':>12}  name")
    for ms, sid, tasks, name, inp, shw in stages[:top]:
        print(f"{ms:7d} {sid:6d} {tasks:6d} {int(inp or 0):12d} {int(shw or 0):12d}  {name}")


if __name__ == "__main__":
    main()
