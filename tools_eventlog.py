"""Summarize a Spark event log written by ``BENCH_EVENT_LOG=<dir> python bench.py``.

Prints job count, job time (submission to completion) against executor run
time, and the slowest stages, so driver-side overhead and task work can be
told apart without the Spark UI.

    python tools_eventlog.py <dir>
"""

import glob
import io
import json
import os
import sys

import zstandard


def events(folder):
    for path in sorted(glob.glob(os.path.join(folder, "**", "events_*"), recursive=True)):
        with open(path, "rb") as fh:
            raw = fh.read()
        if path.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
        for line in raw.decode("utf-8", "ignore").splitlines():
            try:
                yield json.loads(line)
            except ValueError:
                continue


def main(folder):
    jobs, stages, run, deser, tasks = {}, {}, 0, 0, 0
    for e in events(folder):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], None]
        elif kind == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            if info.get("Completion Time") and info.get("Submission Time"):
                stages[(info["Stage ID"], info["Stage Name"])] = info["Completion Time"] - info["Submission Time"]
        elif kind == "SparkListenerTaskEnd":
            metrics = e.get("Task Metrics") or {}
            run += metrics.get("Executor Run Time", 0)
            deser += metrics.get("Executor Deserialize Time", 0)
            tasks += 1
    spans = sorted(b - a for a, b in jobs.values() if b)
    print(f"jobs {len(spans)}  median {spans[len(spans) // 2] if spans else 0} ms  total {sum(spans) / 1000:.1f} s")
    print(f"tasks {tasks}  executor run {run / 1000:.1f} s  deserialize {deser / 1000:.1f} s")
    for (sid, name), ms in sorted(stages.items(), key=lambda kv: -kv[1])[:10]:
        print(f"  stage {sid:5d} {ms:7d} ms  {name[:80]}")


if __name__ == "__main__":
    main(sys.argv[1])
