"""Read what an executed plan did: records and bytes each shuffle wrote.

For measurement and tests; call after an action on the same DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

_STAGE_WRAPPERS = ("ShuffleQueryStage", "ResultQueryStage", "TableCacheQueryStage")


def _metric(node, key: str) -> int | None:
    opt = node.metrics().get(key)
    return int(opt.get().value()) if opt.isDefined() else None


def shuffle_writes(df: DataFrame) -> list[dict[str, int | None]]:
    """One entry per shuffle exchange in the executed plan of ``df``."""
    out = []
    stack = [df._jdf.queryExecution().executedPlan()]  # noqa: SLF001
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if name in _STAGE_WRAPPERS:
            stack.append(node.plan())
            continue
        if name == "Exchange":
            out.append(
                {
                    "partitioning": node.outputPartitioning().toString().split("(")[0],
                    "records": _metric(node, "shuffleRecordsWritten"),
                    "bytes": _metric(node, "shuffleBytesWritten"),
                }
            )
        children = node.children()
        for i in range(children.size()):
            stack.append(children.apply(i))
    return out
