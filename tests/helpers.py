from __future__ import annotations

import contextlib
import io


def rows(df):
    """Rows of ``df`` as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@contextlib.contextmanager
def settings(spark, **conf):
    """Set ``spark.sql.*`` options for a block; underscores stand for dots."""
    names = {f"spark.sql.{k.replace('__', '.')}": v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_nodes(df):
    """Nodes of the plan that ran, through its stages; call it after an action on this very ``df``."""
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        found.append(node)
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def metric(df, node_name, name):
    """The values of a metric of all nodes of one kind."""
    nodes = [n for n in plan_nodes(df) if n.nodeName().startswith(node_name)]
    return [n.metrics().apply(name).value() for n in nodes if n.metrics().contains(name)]


@contextlib.contextmanager
def jobs_of(spark):
    """A list that afterwards holds the ids of the jobs that ran in the block."""
    group, ran = f"group-{id(object())}", []
    spark.sparkContext.setJobGroup(group, group)
    try:
        yield ran
    finally:
        ran += spark.sparkContext.statusTracker().getJobIdsForGroup(group)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
