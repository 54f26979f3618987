"""Plan inspection: the text of ``explain`` and a few facts read from it,
for plan tests and for reviewing what Catalyst chose."""

from __future__ import annotations

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def physical_section(df: DataFrame) -> str:
    text = plan_text(df, "extended")
    return text.split("== Physical Plan ==", 1)[-1]


def exchanges(df: DataFrame) -> list[str]:
    """Shuffle exchanges in the physical plan (one line each)."""
    return [ln.strip() for ln in physical_section(df).splitlines() if re.search(r"\bExchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)", ln)]


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_text(df))


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\n]*)\]", plan_text(df))


def partition_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PartitionFilters: \[([^\n]*)\]", plan_text(df))


def uses_python(df: DataFrame) -> bool:
    text = physical_section(df)
    return any(node in text for node in PYTHON_NODES)
