"""Summarise a Spark event log: per SQL execution, wall time, stages, tasks
and summed executor run time. Usage: python tools/stage_times.py <event log dir or file>"""

import json
import os
import sys
from collections import defaultdict


def files(path):
    if os.path.isfile(path):
        return [path]
    out = []
    for root, _, names in os.walk(path):
        out += [os.path.join(root, n) for n in sorted(names) if not n.startswith(".")]
    return out


def lines(f):
    if f.endswith(".zstd"):
        import io

        import zstandard

        with open(f, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        yield from open(f, encoding="utf-8")


def main(path):
    execs, stage_exec, job_stages = {}, {}, {}
    tasks, run_ms = defaultdict(int), defaultdict(int)
    for f in files(path):
        for line in lines(f):
            e = json.loads(line)
            ev = e.get("Event", "")
            if ev.endswith("SparkListenerSQLExecutionStart"):
                execs[e["executionId"]] = {"desc": e.get("description", "")[:60], "start": e["time"], "end": None}
            elif ev.endswith("SparkListenerSQLExecutionEnd"):
                if e["executionId"] in execs:
                    execs[e["executionId"]]["end"] = e["time"]
            elif ev == "SparkListenerJobStart":
                xid = (e.get("Properties") or {}).get("spark.sql.execution.id")
                for s in e.get("Stage IDs", []):
                    stage_exec[s] = int(xid) if xid is not None else None
            elif ev == "SparkListenerTaskEnd":
                x = stage_exec.get(e["Stage ID"])
                tasks[x] += 1
                run_ms[x] += (e.get("Task Metrics") or {}).get("Executor Run Time", 0)
    print(f"{'id':>4} {'wall_ms':>8} {'tasks':>6} {'run_ms':>8}  description")
    for x, v in sorted(execs.items()):
        wall = (v["end"] or v["start"]) - v["start"]
        print(f"{x:>4} {wall:>8} {tasks[x]:>6} {run_ms[x]:>8}  {v['desc']}")


if __name__ == "__main__":
    main(sys.argv[1])
