"""Physical-plan inspection used by the plan tests (shuffle counts, Python nodes)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame, mode: str = "formatted") -> str:
    """The plan text that ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def count_nodes(df: DataFrame, pattern: str) -> int:
    """Number of physical operators whose line matches ``pattern`` (``simple`` mode:
    one line per operator; ``formatted`` lists each operator twice)."""
    return sum(1 for line in physical_plan(df, "simple").splitlines() if re.search(pattern, line))


def exchanges(df: DataFrame) -> dict[str, int]:
    """Counts of shuffle (hash/range/single), broadcast exchanges and Python
    evaluation nodes in the physical plan (before AQE re-planning)."""
    text = physical_plan(df, "simple")
    return {
        "hash": len(re.findall(r"Exchange hashpartitioning", text)),
        "range": len(re.findall(r"Exchange rangepartitioning", text)),
        "single": len(re.findall(r"Exchange SinglePartition", text)),
        "broadcast": len(re.findall(r"BroadcastExchange", text)),
        "reused": len(re.findall(r"ReusedExchange", text)),
        "python": len(re.findall(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)", text)),
    }
