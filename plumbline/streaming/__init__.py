"""Frozen, row-local rules on a streaming DataFrame.

Rules are fitted on a batch table; applying them needs no state, so the same
call works on a stream. Deduplication, profiles and every other aggregate
belong to the batch side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from plumbline.operators.rules import Rule, apply_rules


def clean_stream(stream: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    if not stream.isStreaming:
        raise ValueError("clean_stream expects a streaming DataFrame; use apply_rules on a batch table")
    return apply_rules(stream, rules)
