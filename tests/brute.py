"""The verdicts worked out one record at a time in plain Python."""

from __future__ import annotations

import math
import re
from datetime import datetime, timezone

from eventguard.operators import rules

_STAMP = re.compile(r"\d{4}-\d\d-\d\d[Tt]\d\d:\d\d:\d\dZ")


def event_seconds(text):
    if text is None or not _STAMP.fullmatch(text):
        return None
    try:
        parsed = datetime.strptime(text.upper(), "%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return None
    return int(parsed.replace(tzinfo=timezone.utc).timestamp())


def blank(text):
    return text is None or text.strip(" ") == ""


def verdicts(records):
    """records: (arrival, batch, user, amount, timestamp, source, as_of seconds), in the
    order of arrival. Returns {arrival: reason or None}."""
    in_batch, accepted, reasons = set(), set(), {}
    for arrival, batch, user, amount, stamp, source, as_of in records:
        event = event_seconds(stamp)
        repeat = (batch, user, stamp) in in_batch
        in_batch.add((batch, user, stamp))
        if blank(user):
            reason = rules.USER_MISSING
        elif amount is None:
            reason = rules.AMOUNT_MISSING
        elif blank(stamp):
            reason = rules.TIMESTAMP_MISSING
        elif blank(source):
            reason = rules.SOURCE_MISSING
        elif event is None:
            reason = rules.TIMESTAMP_TYPE
        elif math.isnan(amount):
            reason = rules.AMOUNT_NAN
        elif not 1.0 <= amount <= 10_000_000.0:
            reason = rules.AMOUNT_RANGE
        elif source not in ("mobile", "web", "pos"):
            reason = rules.SOURCE_UNKNOWN
        elif repeat:
            reason = rules.REPEAT_IN_BATCH
        elif as_of is not None and as_of - event > 180:
            reason = rules.LATE
        elif (user, stamp) in accepted:
            reason = rules.REPEAT_ACROSS
        else:
            accepted.add((user, stamp))
            reason = None
        reasons[arrival] = reason
    return reasons
