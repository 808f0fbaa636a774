"""The one step that needs Python: markup trees. An Arrow-batched function over string columns with a deadline for each text."""

import signal
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

from .wikitext import OutOfSteps, extract


def skipped(seconds: int) -> str:
    return f"[Article skipped: parsing timeout after {seconds} seconds]"


class _Late(BaseException):
    pass


def _late(*_):
    raise _Late


def guarded(text: str, work: Callable[[str], str], seconds: int) -> str:
    """work(text); a placeholder if it fails or takes longer than `seconds`. With 0 there is no deadline and errors go on."""
    if not seconds:
        return work(text)
    try:
        signal.setitimer(signal.ITIMER_REAL, seconds)
        try:
            return work(text)
        finally:
            signal.setitimer(signal.ITIMER_REAL, 0)
    except (_Late, Exception):
        return skipped(seconds)


def extract_udf(skip_lists: bool = False, timeout: int = 30, work: Callable[[str], str] | None = None, steps: int | None = None) -> Callable[[Column], Column]:
    """A column function: markup to text; null for null. `work` stands in for the parser in tests.

    With `steps` the clock isn't asked: a text that takes more steps gets the placeholder, which still names `timeout`, so
    results are the same on every machine and in every attempt.
    """
    if timeout < 0 or steps is not None and steps < 0:
        raise ValueError("timeout and steps must not be negative")

    def budgeted(text: str) -> str:
        try:
            return extract(text, skip_lists, steps)
        except OutOfSteps:
            return skipped(timeout)
        except Exception:
            if not timeout:
                raise
            return skipped(timeout)

    def texts(column: pd.Series) -> pd.Series:
        if steps is not None:
            return pd.Series([None if t is None else budgeted(t) for t in column], dtype=object)
        run = work or (lambda t: extract(t, skip_lists))
        before = signal.signal(signal.SIGALRM, _late) if timeout else None
        try:
            return pd.Series([None if t is None else guarded(t, run, timeout) for t in column], dtype=object)
        finally:
            if timeout:
                signal.signal(signal.SIGALRM, before)

    return pandas_udf(texts, "string")
