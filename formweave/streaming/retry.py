"""Retrying an append."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

log = logging.getLogger(__name__)


def with_retries(attempt: Callable[[], None], waits: tuple[float, ...],
                 sleep: Callable[[float], None] = time.sleep) -> bool:
    """Try once per entry of `waits`, waiting that long after each failure. True once an attempt succeeds."""
    for wait in waits:
        try:
            attempt()
            return True
        except Exception as failure:  # noqa: BLE001 - whatever fails is retried, then dead-lettered
            log.warning("append failed (%s), next attempt in %s s", type(failure).__name__, wait)
            sleep(wait)
    return False


def with_backoff(attempt: Callable[[], None], initial: float, most: float, total: float, factor: float = 2.0,
                 sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic) -> int:
    """Try until an attempt succeeds, waiting ``initial`` seconds after the first failure, ``factor`` times longer after
    each further one, at most ``most``; returns the number of tries. The last failure is raised once the next wait would
    end after ``total`` seconds."""
    started, wait, tries = clock(), initial, 0
    while True:
        tries += 1
        try:
            attempt()
            return tries
        except Exception as failure:  # noqa: BLE001 - whatever fails is retried until time is up
            if clock() - started + wait > total:
                raise
            log.warning("publish failed (%s), next attempt in %s s", type(failure).__name__, wait)
            sleep(wait)
            wait = min(wait * factor, most)
