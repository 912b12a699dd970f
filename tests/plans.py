"""What a plan that has run tells of itself."""


def _steps(plan):
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from _steps(plan.executedPlan())
    elif kind.endswith("QueryStageExec"):
        yield from _steps(plan.plan())
    else:
        yield plan
        children = plan.children()
        for i in range(children.size()):
            yield from _steps(children.apply(i))


def steps(df, kind):
    """Steps of a kind in the final plan of a DataFrame whose rows were collected."""
    return [s for s in _steps(df._jdf.queryExecution().executedPlan()) if s.getClass().getSimpleName() == kind]


def metric(step, name):
    return step.metrics().apply(name).value()


def shuffled_rows(df):
    """Rows that each shuffle of a collected DataFrame wrote."""
    return [metric(s, "shuffleRecordsWritten") for s in steps(df, "ShuffleExchangeExec")]
