"""The ordered rule chain: the first rule that fails gives a record its one reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, functions as F

from eventguard.config import PipelineConfig

# Reason texts that consumers of the rejected records rely on.
USER_MISSING = "Missing mandatory field: user_id"
AMOUNT_MISSING = "Missing mandatory field: amount"
TIMESTAMP_MISSING = "Missing mandatory field: timestamp"
SOURCE_MISSING = "Missing mandatory field: source"
TIMESTAMP_TYPE = "Type validation failed: invalid/unparseable timestamp"
AMOUNT_NAN = "Type validation failed: amount is NaN"
AMOUNT_RANGE = "Range validation failed: amount must be between 1 and 10,000,000"
SOURCE_UNKNOWN = "Source validation failed: source must be mobile, web, or pos"
REPEAT_IN_BATCH = "Duplicate transaction: same user_id and timestamp within batch"
LATE = "Watermark violation: event timestamp is > 3 minutes late"
# Own reason, only in use where max_future_skew is set.
AHEAD = "Watermark violation: event timestamp is ahead of the processing time"
REPEAT_ACROSS = "Duplicate transaction: duplicate user_id and timestamp (cross-batch)"


@dataclass(frozen=True)
class Rule:
    reason: str
    group: str
    fails: Column
    # False for rules that look at other records too.
    per_record: bool = True


def missing(name: str) -> Column:
    text = F.col(name)
    return text.isNull() | (F.trim(text) == "")


def lag_seconds() -> Column:
    """Age of the event at processing time; both sides floored to whole seconds."""
    return F.col("as_of").cast("long") - F.col("event_time").cast("long")


def default_rules(cfg: PipelineConfig) -> list[Rule]:
    """All rules; their order is their precedence.

    Reason texts name the default limits and are fixed values, so they do not follow a
    configuration with other limits.
    """
    amount = F.col("amount")
    ahead = [] if cfg.max_future_skew is None else [
        Rule(AHEAD, "lateness", lag_seconds() < -cfg.max_future_skew)
    ]
    return [
        Rule(USER_MISSING, "mandatory", missing("user_id")),
        Rule(AMOUNT_MISSING, "mandatory", amount.isNull()),
        Rule(TIMESTAMP_MISSING, "mandatory", missing("timestamp")),
        Rule(SOURCE_MISSING, "mandatory", missing("source")),
        Rule(TIMESTAMP_TYPE, "type", F.col("event_time").isNull()),
        Rule(AMOUNT_NAN, "type", F.isnan(amount)),
        Rule(AMOUNT_RANGE, "range", (amount < cfg.amount_min) | (amount > cfg.amount_max)),
        Rule(SOURCE_UNKNOWN, "source", ~F.col("source").isin(*cfg.sources)),
        Rule(REPEAT_IN_BATCH, "repeat", F.col("repeat_in_batch"), per_record=False),
        Rule(LATE, "lateness", lag_seconds() > cfg.lateness_seconds),
        *ahead,
        Rule(REPEAT_ACROSS, "repeat", F.col("accepted_before"), per_record=False),
    ]


def first_reason(rules: Sequence[Rule]) -> Column:
    """One CASE over the rules, NULL when none fails."""
    head, *rest = rules
    chain = reduce(
        lambda case, rule: case.when(rule.fails, F.lit(rule.reason)),
        rest,
        F.when(head.fails, F.lit(head.reason)),
    )
    return chain.otherwise(F.lit(None).cast("string"))


def rules_of(cfg: PipelineConfig, group: str) -> list[Rule]:
    return [rule for rule in default_rules(cfg) if rule.group == group]
