"""Retry of one table's load.

The reference retries only transient "not currently available" errors, at
most 6 attempts, 20 s apart.  Those are the defaults here; the predicate,
the delay, the growth of the delay and the sleep function are parameters.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import TypeVar

T = TypeVar("T")

log = logging.getLogger("strata")

# ---- fixed values (reference defaults) ----
TRANSIENT_MESSAGE = "not currently available"
MAX_ATTEMPTS = 6
DELAY_SECONDS = 20.0


def message_contains(*needles: str) -> Callable[[BaseException], bool]:
    """Predicate: the lower-cased error text contains one of ``needles``."""
    low = tuple(n.lower() for n in needles)
    return lambda exc: any(n in str(exc).lower() for n in low)


@dataclass(frozen=True)
class RetryPolicy:
    attempts: int = MAX_ATTEMPTS
    delay_seconds: float = DELAY_SECONDS
    backoff: float = 1.0                    # 1.0 = fixed delay, 2.0 = doubling
    max_delay_seconds: float | None = None
    is_transient: Callable[[BaseException], bool] = message_contains(TRANSIENT_MESSAGE)
    sleep: Callable[[float], None] = time.sleep

    def delay(self, attempt: int) -> float:
        """Wait after failed attempt number ``attempt`` (1-based)."""
        d = self.delay_seconds * (self.backoff ** (attempt - 1))
        return min(d, self.max_delay_seconds) if self.max_delay_seconds is not None else d


def with_retry(action: Callable[[], T], policy: RetryPolicy) -> tuple[T, int]:
    """Run ``action`` until it succeeds; returns ``(result, attempts)``.

    A non-transient error, or a transient one on the last attempt, is
    raised at once."""
    if policy.attempts < 1:
        raise ValueError("attempts must be >= 1")
    attempt = 1
    while True:
        try:
            return action(), attempt
        except Exception as exc:  # classify, then re-raise or wait
            if attempt >= policy.attempts or not policy.is_transient(exc):
                raise
            log.warning("transient failure (attempt %d/%d), retrying in %.0f s: %s",
                        attempt, policy.attempts, policy.delay(attempt), str(exc)[:200])
            policy.sleep(policy.delay(attempt))
            attempt += 1
