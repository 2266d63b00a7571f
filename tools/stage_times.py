"""Summarise a Spark event log: job count, total job time and the slowest
stages (name, tasks, milliseconds). The Spark UI stays off; write the log to
a scratch folder instead:

    EV=$(mktemp -d /tmp/run-XXXXXX)
    BENCH_EVENT_LOG=$EV BENCH_QUERIES=price_prediction python bench.py
    python tools/stage_times.py $EV
"""

from __future__ import annotations

import glob
import io
import json
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard
        raw = open(path, "rb")
        yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw),
                                    encoding="utf-8")
    else:
        yield from open(path, encoding="utf-8")


def main(folder: str, top: int = 15) -> None:
    jobs, stages = {}, {}
    for path in sorted(glob.glob(f"{folder}/**/events*", recursive=True)):
        for line in _lines(path):
            e = json.loads(line)
            kind = e["Event"]
            if kind == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], None]
            elif kind == "SparkListenerJobEnd":
                jobs[e["Job ID"]][1] = e["Completion Time"]
            elif kind == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Stage Name"], si["Number of Tasks"],
                                          si.get("Completion Time", 0) - si.get("Submission Time", 0))
    total = sum((end or start) - start for start, end in jobs.values())
    print(f"jobs {len(jobs)}, job time {total} ms, stages {len(stages)}")
    for sid, (name, tasks, ms) in sorted(stages.items(), key=lambda kv: -kv[1][2])[:top]:
        print(f"stage {sid:5d} {ms:7d} ms {tasks:6d} tasks  {name[:90]}")


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15)
