"""Per-key totals from a Spark event log written by ``BENCH_EVENT_LOG=<dir> python bench.py``.

usage: python tools/eventlog_summary.py <event log file or rolling event log folder>

For every job description (the bench sets it to the query key) it sums the
jobs, stages, tasks, input bytes, shuffle bytes written and read, spill, and
the executor run time of the cold run.
"""

from __future__ import annotations

import io
import json
import os
import re
import sys
from collections import defaultdict


def _lines(path: str):
    """Lines of an event log: a plain or zstd file, or a rolling log folder."""
    if os.path.isdir(path):
        parts = [f for f in os.listdir(path) if f.startswith("events_")]
        parts.sort(key=lambda f: int(re.match(r"events_(\d+)_", f).group(1)))
        for f in parts:
            yield from _lines(os.path.join(path, f))
        return
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
        return
    with open(path, encoding="utf-8") as fh:
        yield from fh


def summarise(path: str) -> dict[str, dict[str, float]]:
    job_key: dict[int, str] = {}
    stage_key: dict[int, str] = {}
    out: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    if True:
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                key = (ev.get("Properties") or {}).get("spark.job.description")
                if not key:
                    continue
                job_key[ev["Job ID"]] = key
                for sid in ev.get("Stage IDs", []):
                    stage_key[sid] = key
                out[key]["jobs"] += 1
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                key = stage_key.get(info["Stage ID"])
                if key is None:
                    continue
                out[key]["stages"] += 1
                out[key]["tasks"] += info.get("Number of Tasks", 0)
                for acc in info.get("Accumulables", []):
                    name, value = acc.get("Name", ""), acc.get("Value")
                    try:
                        value = float(value)
                    except (TypeError, ValueError):
                        continue
                    for label, field in (("internal.metrics.input.bytesRead", "input_bytes"),
                                         ("internal.metrics.shuffle.write.bytesWritten",
                                          "shuffle_write_bytes"),
                                         ("internal.metrics.shuffle.read.remoteBytesRead",
                                          "shuffle_read_bytes"),
                                         ("internal.metrics.shuffle.read.localBytesRead",
                                          "shuffle_read_bytes"),
                                         ("internal.metrics.memoryBytesSpilled", "spill_bytes"),
                                         ("internal.metrics.executorRunTime", "run_ms")):
                        if name == label:
                            out[key][field] += value
    return {k: dict(v) for k, v in out.items()}


if __name__ == "__main__":
    stats = summarise(sys.argv[1])
    cols = ["jobs", "stages", "tasks", "input_bytes", "shuffle_write_bytes",
            "shuffle_read_bytes", "spill_bytes", "run_ms"]
    print("| key | " + " | ".join(cols) + " |")
    print("|---" * (len(cols) + 1) + "|")
    for key in sorted(stats):
        print(f"| {key} | " + " | ".join(f"{stats[key].get(c, 0):.0f}" for c in cols) + " |")
