"""What the shuffles of a plan carry."""


def exchanged(df) -> list[set[str]]:
    """The columns of every shuffle of the initial plan, broadcasts left out."""
    plan, out = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if node.nodeName() == "Exchange":
            out.append({node.output().apply(i).name() for i in range(node.output().size())})
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan.initialPlan() if "Adaptive" in plan.nodeName() else plan)
    return out
