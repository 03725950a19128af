"""Plan inspection through the public ``explain`` API (used by tests)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints, as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def python_nodes(df: DataFrame) -> list[str]:
    """Names of Python-evaluation operators in the plan (should be empty)."""
    text = plan_text(df)
    return [n for n in PYTHON_NODES if n in text]


def codegen_subtrees(df: DataFrame) -> int:
    """Number of whole-stage-codegen subtrees Spark compiles for the plan.

    Adaptive execution plans stages only at run time, so the count is taken
    on the static plan with adaptive execution switched off for the call.
    """
    conf = df.sparkSession.conf
    before = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # a new Dataset gets a new, not yet planned, query execution
        text = plan_text(df.select("*"), "codegen")
    finally:
        conf.set("spark.sql.adaptive.enabled", before)
    m = re.search(r"Found (\d+) WholeStageCodegen subtrees", text)
    return int(m.group(1)) if m else 0


def count_nodes(df: DataFrame, name: str) -> int:
    """Occurrences of an operator name in the formatted plan's tree."""
    tree = plan_text(df).split("\n\n\n")[0]
    return tree.count(name)
