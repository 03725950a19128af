"""Summarise job and stage times from a Spark event log folder (zstd or plain).

Usage: python tools/eventlog.py <eventlog dir> [job group]
"""

from __future__ import annotations

import glob
import io
import json
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    folder = sys.argv[1]
    group = sys.argv[2] if len(sys.argv) > 2 else None
    jobs, stages = {}, {}
    for path in sorted(glob.glob(f"{folder}/**/events_*", recursive=True)):
        for line in _lines(path):
            try:
                e = json.loads(line)
            except ValueError:
                continue
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                props = e.get("Properties", {})
                jobs[e["Job ID"]] = [e["Submission Time"], None, e["Stage IDs"], props.get("spark.jobGroup.id"),
                                     props.get("callSite.short", "")]
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]][1] = e["Completion Time"]
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Stage Name"][:40], si["Number of Tasks"],
                                          si.get("Completion Time", 0) - si.get("Submission Time", 0))
    for jid, (start, end, stage_ids, grp, site) in sorted(jobs.items()):
        if group and grp != group:
            continue
        ran = [(s, *stages[s]) for s in stage_ids if s in stages]
        print(f"job {jid}: {(end or start) - start} ms  {site}  stages={ran}")


if __name__ == "__main__":
    main()
