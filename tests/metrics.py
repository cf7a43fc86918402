"""What a finished plan's scans and operators really handled."""


def _nodes(plan):
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from _nodes(plan.executedPlan())
        return
    yield plan
    if name.endswith("QueryStageExec"):
        yield from _nodes(plan.plan())
        return
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def rows_of(df, operator):
    """Output rows of each node of the kind, after ``df`` was run."""
    found = []
    for node in _nodes(df._jdf.queryExecution().executedPlan()):
        if node.nodeName().startswith(operator):
            metric = node.metrics().get("numOutputRows")
            found.append(metric.get().value() if metric.isDefined() else None)
    return found
