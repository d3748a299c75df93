"""Summarise job and stage durations from a Spark event log (no UI needed).

Usage: python tools/stage_times.py <event-log dir or file> [--top N]

Reads plain or zstd-compressed event logs (``spark.eventLog.dir``) and prints
jobs with their stages, longest first, with task counts.
"""

from __future__ import annotations

import argparse
import glob
import io
import json
import os


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard

        raw = zstandard.ZstdDecompressor().stream_reader(open(path, "rb"))
    else:
        raw = open(path, "rb")
    yield from io.TextIOWrapper(raw, encoding="utf-8")


def summarise(path: str, top: int) -> None:
    files = [path] if os.path.isfile(path) else sorted(
        glob.glob(os.path.join(path, "**", "events_*"), recursive=True)
        + glob.glob(os.path.join(path, "**", "local-*"), recursive=True)
    )
    jobs, stage_job, stages, desc = {}, {}, {}, {}
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                jid = e["Job ID"]
                props = e.get("Properties", {})
                desc[jid] = props.get("spark.job.description") or props.get("callSite.short", "")
                jobs[jid] = [e["Submission Time"], None]
                for s in e["Stage IDs"]:
                    stage_job[s] = jid
            elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
                jobs[e["Job ID"]][1] = e["Completion Time"]
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                if "Submission Time" in si and "Completion Time" in si:
                    stages[si["Stage ID"]] = (
                        si["Completion Time"] - si["Submission Time"], si["Number of Tasks"], si["Stage Name"][:70]
                    )
    done = [(t - s, jid) for jid, (s, t) in jobs.items() if t is not None]
    for dur, jid in sorted(done, reverse=True)[:top]:
        print(f"job {jid:4d} {dur:7d} ms  {desc.get(jid, '')[:80]}")
        for sid in sorted(s for s, j in stage_job.items() if j == jid and s in stages):
            d, n, name = stages[sid]
            print(f"       stage {sid:4d} {d:7d} ms  tasks={n:4d}  {name}")


if __name__ == "__main__":
    ap = argparse.ArgumentParser()
    ap.add_argument("path")
    ap.add_argument("--top", type=int, default=20)
    a = ap.parse_args()
    summarise(a.path, a.top)
