"""Summarise a Spark event log by job group: jobs, stages, tasks, task time.

Usage: python tools/stage_times.py <event log folder or file>
"""

from __future__ import annotations

import json
import sys
from collections import defaultdict
from pathlib import Path


def _lines(f: Path):
    if f.suffix == ".zstd":
        import io

        import zstandard

        with open(f, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(f) as fh:
            yield from fh


def _events(path: Path):
    files = ([p for p in sorted(path.rglob("events_*")) if p.is_file()]
             if path.is_dir() else [path])
    for f in files:
        for line in _lines(f):
            if line.strip():
                yield json.loads(line)


def table_scans(path: Path) -> dict:
    """Per job group: how many Parquet scans of each table its SQL
    executions planned (one count per scan node)."""
    plans: dict[int, str] = {}
    exec_group: dict[int, str] = {}
    for ev in _events(path):
        kind = ev.get("Event", "")
        if kind.endswith("SparkListenerSQLExecutionStart"):
            plans[ev["executionId"]] = ev.get("physicalPlanDescription", "")
        elif kind == "SparkListenerJobStart":
            props = ev.get("Properties", {})
            eid = props.get("spark.sql.execution.id")
            if eid is not None:
                exec_group.setdefault(int(eid), props.get("spark.jobGroup.id", "(none)"))
    out: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    for eid, group in exec_group.items():
        plan = plans.get(eid, "")
        for line in plan.splitlines():
            if line.startswith("Location: InMemoryFileIndex"):
                table = line.rsplit("/", 1)[-1].rstrip("]").replace(".parquet", "")
                out[group][table] += 1
    return {g: dict(t) for g, t in out.items()}


def summarise(path: Path) -> dict:
    job_group: dict[int, str] = {}
    stage_job: dict[int, int] = {}
    out = defaultdict(lambda: {"jobs": 0, "stages": 0, "tasks": 0, "task_ms": 0,
                               "shuffle_write_mb": 0.0, "slowest_stage_ms": 0})
    for ev in _events(path):
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            props = ev.get("Properties", {})
            group = props.get("spark.jobGroup.id", "(none)")
            job_group[ev["Job ID"]] = group
            out[group]["jobs"] += 1
            for sid in ev.get("Stage IDs", []):
                stage_job[sid] = ev["Job ID"]
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            group = job_group.get(stage_job.get(info["Stage ID"]), "(none)")
            rec = out[group]
            rec["stages"] += 1
            rec["tasks"] += info.get("Number of Tasks", 0)
            took = (info.get("Completion Time", 0) or 0) - (info.get("Submission Time", 0) or 0)
            rec["slowest_stage_ms"] = max(rec["slowest_stage_ms"], took)
        elif kind == "SparkListenerTaskEnd":
            group = job_group.get(stage_job.get(ev.get("Stage ID")), "(none)")
            metrics = ev.get("Task Metrics") or {}
            out[group]["task_ms"] += metrics.get("Executor Run Time", 0)
            sw = metrics.get("Shuffle Write Metrics") or {}
            out[group]["shuffle_write_mb"] += sw.get("Shuffle Bytes Written", 0) / 1e6
    return dict(out)


if __name__ == "__main__":
    res = summarise(Path(sys.argv[1]))
    scans = table_scans(Path(sys.argv[1]))
    for group, rec in sorted(res.items(), key=lambda kv: -kv[1]["task_ms"]):
        rec["shuffle_write_mb"] = round(rec["shuffle_write_mb"], 2)
        rec["table_scans"] = scans.get(group, {})
        print(group, json.dumps(rec))
