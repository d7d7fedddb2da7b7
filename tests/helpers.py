from __future__ import annotations


def bag(rows):
    """Rows as a sorted list of tuples; nulls and mixed types compare by their text."""
    return sorted((tuple(r) for r in rows), key=repr)


def rows(df, *cols):
    return bag((df.select(*cols) if cols else df).collect())


def executed_plan(df):
    """The plan that adaptive execution arrived at; ``df`` must have been collected."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0]


def shuffled_rows(df):
    """Rows that the exchanges of a collected frame wrote."""

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        children = node.children()
        below = sum(walk(children.apply(i)) for i in range(children.size()))
        if kind != "ShuffleExchangeExec":
            return below
        return below + node.metrics().apply("shuffleRecordsWritten").value()

    return walk(df._jdf.queryExecution().executedPlan())
