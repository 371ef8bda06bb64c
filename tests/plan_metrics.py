"""What Spark itself counted: files opened by a plan, bytes read and written by a piece of work."""

from __future__ import annotations

from contextlib import contextmanager


def _scans(node):
    name = node.getClass().getSimpleName()
    if name == "FileSourceScanExec":
        yield node
    if name == "AdaptiveSparkPlanExec":
        yield from _scans(node.executedPlan())
    elif name.endswith("QueryStageExec"):
        yield from _scans(node.plan())
    elif name != "ReusedExchangeExec":
        children = node.children()
        for i in range(children.size()):
            yield from _scans(children.apply(i))


def files_read(df) -> int:
    """Files that the scans of `df` opened when it ran."""
    return sum(s.metrics().apply("numFiles").value() for s in _scans(df._jdf.queryExecution().executedPlan()))


@contextmanager
def bytes_moved(spark):
    """Collects `read` and `written` of all stages that run in the block."""
    out = {"read": 0, "written": 0}
    store = spark.sparkContext._jsc.sc().statusStore()

    def totals():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = store.stageList(None, False, False, getattr(store, "stageList$default$4")(), None)
        found = [stages.apply(i) for i in range(stages.size())]
        return sum(s.inputBytes() for s in found), sum(s.outputBytes() for s in found)

    before = totals()
    yield out
    after = totals()
    out.update(read=after[0] - before[0], written=after[1] - before[1])
