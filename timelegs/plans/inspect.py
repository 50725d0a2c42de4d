"""What Spark decided to do with a query."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan as ``explain`` prints it."""
    captured = io.StringIO()
    with contextlib.redirect_stdout(captured):
        df.explain(mode=mode)
    return captured.getvalue()


def uses_broadcast_join(df: DataFrame) -> bool:
    return "BroadcastHashJoin" in plan_text(df, "simple")


def exchanges(df: DataFrame) -> int:
    """Shuffles in the physical plan, reused ones not counted."""
    lines = plan_text(df, "simple").splitlines()
    return sum(
        "Exchange" in line and "BroadcastExchange" not in line and "ReusedExchange" not in line
        for line in lines
    )
