"""What runs plans: steps with skip and abort, retries, timings, and an in-memory registry of jobs."""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable, Iterable
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, datetime
from typing import Any


class Abort(Exception):
    """Ends a pipeline's run for a date without being an error."""


def retry(call: Callable[[], Any], *, attempts: int = 3, delay: float = 1.0, factor: float = 2.0, jitter: float = 0.2, errors: tuple[type[BaseException], ...] = (Exception,), sleep: Callable[[float], None] = time.sleep) -> Any:
    """call(), again after growing pauses with jitter; the last error is raised."""
    for k in range(attempts):
        try:
            return call()
        except errors:
            if k + 1 == attempts:
                raise
            sleep(delay * factor**k * (1 + random.uniform(-jitter, jitter)))


@dataclass
class Timeline:
    """Seconds of each step, in order."""

    seconds: dict[str, float] = field(default_factory=dict)

    @contextmanager
    def step(self, name: str):
        began = time.perf_counter()
        try:
            yield
        finally:
            self.seconds[name] = self.seconds.get(name, 0.0) + time.perf_counter() - began

    def lines(self) -> list[str]:
        total = sum(self.seconds.values()) or 1.0
        return [f"{n}: {s:.3f} s ({100 * s / total:.0f} %)" for n, s in self.seconds.items()]


@dataclass
class Pipeline:
    """(name, step) pairs; a step takes and returns the context."""

    steps: Iterable[tuple[str, Callable[[dict], dict | None]]]
    on_abort: Callable[[dict], None] = lambda context: None

    def run(self, context: dict) -> dict:
        timeline = context.setdefault("timeline", Timeline())
        try:
            for name, step in self.steps:
                with timeline.step(name):
                    context = step(context) or context
        except Abort:
            self.on_abort(context)
            context["aborted"] = True
        return context


@dataclass
class Job:
    kind: str
    arguments: dict
    id: str = field(default_factory=lambda: uuid.uuid4().hex)
    status: str = "pending"
    created_at: str = field(default_factory=lambda: datetime.now(UTC).isoformat())


class Jobs:
    """Jobs of this process."""

    STATUSES = ("pending", "running", "done", "failed", "killed")

    def __init__(self):
        self.jobs: dict[str, Job] = {}

    def create(self, kind: str, **arguments: Any) -> Job:
        job = Job(kind, arguments)
        self.jobs[job.id] = job
        return job

    def get(self, job_id: str) -> Job:
        return self.jobs[job_id]

    def set_status(self, job_id: str, status: str) -> Job:
        if status not in self.STATUSES:
            raise ValueError(f"unknown status {status!r}")
        self.jobs[job_id].status = status
        return self.jobs[job_id]

    def kill(self, job_id: str) -> Job:
        job = self.get(job_id)
        return self.set_status(job_id, "killed") if job.status in ("pending", "running") else job

    def list(self, status: str | None = None, kind: str | None = None) -> list[Job]:
        """Newest first; ValueError for an unknown status."""
        if status is not None and status not in self.STATUSES:
            raise ValueError(f"unknown status {status!r}")
        found = [j for j in self.jobs.values() if status in (None, j.status) and kind in (None, j.kind)]
        return sorted(found, key=lambda j: j.created_at, reverse=True)
