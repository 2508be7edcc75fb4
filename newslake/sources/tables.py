"""Keeping all cores busy: running independent jobs together."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

Result = TypeVar("Result")
_JOBS_AT_ONCE = 6


def run_together(jobs: Iterable[Callable[[], Result]]) -> list[Result]:
    """Start independent Spark actions from threads; results in the order given.

    The first failure is raised once all have ended.
    """
    with ThreadPoolExecutor(_JOBS_AT_ONCE) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]
