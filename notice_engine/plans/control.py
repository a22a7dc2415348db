"""Driver-side control: retries, rate limits, a circuit breaker, error counts, logging."""

from __future__ import annotations

import asyncio
import functools
import logging
import os
import time
from collections.abc import Awaitable, Callable
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any, TypeVar

from notice_engine.operators.crawl_log import retry_delays

T = TypeVar("T")


class BreakerOpen(RuntimeError):
    """The call was not let through."""


@dataclass
class ErrorCounts:
    """Failures since the last success, and the last error, by operation. A success sets a count that is there to 0."""

    counts: dict[str, int] = field(default_factory=dict)
    last: dict[str, str] = field(default_factory=dict)

    def failed(self, operation: str, problem: BaseException | str = "") -> None:
        self.counts[operation] = self.counts.get(operation, 0) + 1
        self.last[operation] = str(problem)

    def succeeded(self, operation: str) -> None:
        if operation in self.counts:
            self.counts[operation] = 0

    def reset(self, operation: str | None = None) -> None:
        for known in (self.counts, self.last):
            if operation is None:
                known.clear()
            else:
                known.pop(operation, None)

    def stats(self) -> dict[str, Any]:
        return {"error_counts": dict(self.counts), "last_errors": dict(self.last), "total_functions_with_errors": len(self.counts), "total_errors": sum(self.counts.values())}


def retry(most: int = 3, delay: float = 1.0, factor: float = 1.5, counts: ErrorCounts | None = None, wait: Callable[[float], None] = time.sleep, errors: tuple[type[BaseException], ...] = (Exception,)):
    """``most`` retries after the first attempt, with growing waits; the last error surfaces. Only ``errors`` are tried again and counted."""

    def wrap(f: Callable[..., T]) -> Callable[..., T]:
        @functools.wraps(f)
        def call(*args, **kwargs):
            waits = iter(retry_delays(most, delay, factor))
            while True:
                try:
                    out = f(*args, **kwargs)
                except errors as problem:
                    if counts is not None:
                        counts.failed(f.__name__, problem)
                    pause = next(waits, None)
                    if pause is None:
                        raise
                    wait(pause)
                else:
                    if counts is not None:
                        counts.succeeded(f.__name__)
                    return out

        return call

    return wrap


def retry_async(most: int = 3, delay: float = 1.0, factor: float = 1.5, counts: ErrorCounts | None = None, wait: Callable[[float], Awaitable[None]] = asyncio.sleep, errors: tuple[type[BaseException], ...] = (Exception,)):
    """:func:`retry` for coroutines."""

    def wrap(f: Callable[..., Awaitable[T]]) -> Callable[..., Awaitable[T]]:
        @functools.wraps(f)
        async def call(*args, **kwargs):
            waits = iter(retry_delays(most, delay, factor))
            while True:
                try:
                    out = await f(*args, **kwargs)
                except errors as problem:
                    if counts is not None:
                        counts.failed(f.__name__, problem)
                    pause = next(waits, None)
                    if pause is None:
                        raise
                    await wait(pause)
                else:
                    if counts is not None:
                        counts.succeeded(f.__name__)
                    return out

        return call

    return wrap


@dataclass
class CircuitBreaker:
    """Opens after ``failures`` failures, lets one call through after ``rest`` seconds, closes when that succeeds. A success while closed leaves the count."""

    failures: int = 5
    rest: float = 60.0
    clock: Callable[[], float] = time.monotonic
    state: str = "closed"
    count: int = 0
    since: float = 0.0

    def call(self, f: Callable[..., T], *args, **kwargs) -> T:
        now = self.clock()  # of the start of the call, which is also the time of its failure
        if self.state == "open":
            if now - self.since < self.rest:
                raise BreakerOpen(getattr(f, "__name__", "call"))
            self.state = "half_open"
        try:
            out = f(*args, **kwargs)
        except Exception:
            self.count += 1
            self.since = now
            if self.count >= self.failures:
                self.state = "open"
            raise
        if self.state == "half_open":
            self.state, self.count = "closed", 0
        return out


@dataclass
class RateLimiter:
    """At least ``interval`` seconds between calls."""

    interval: float
    clock: Callable[[], float] = time.monotonic
    wait: Callable[[float], None] = time.sleep
    last: float | None = None

    def acquire(self) -> None:
        if self.last is not None and (left := self.last + self.interval - self.clock()) > 0:
            self.wait(left)
        self.last = self.clock()


def safe_call(f: Callable[..., T], *args, default: T | None = None, **kwargs) -> T | None:
    """The result, or ``default`` after an error, which is logged."""
    try:
        return f(*args, **kwargs)
    except Exception:
        logging.getLogger("notice_engine").exception("%s failed", getattr(f, "__name__", "call"))
        return default


def logger(name: str = "notice_engine", folder: str | None = None, level: int = logging.INFO) -> logging.Logger:
    """A logger on the console and, with a folder, in a file of the day. Asking again adds no handlers."""
    out = logging.getLogger(name)
    if not out.handlers:
        out.setLevel(level)
        line = logging.Formatter("%(asctime)s - %(name)s - %(levelname)s - %(message)s")
        handlers: list[logging.Handler] = [logging.StreamHandler()]
        if folder:
            os.makedirs(folder, exist_ok=True)
            handlers.append(logging.FileHandler(os.path.join(folder, f"{name}_{datetime.now():%Y%m%d}.log"), encoding="utf-8"))
        for h in handlers:
            h.setFormatter(line)
            out.addHandler(h)
    return out
