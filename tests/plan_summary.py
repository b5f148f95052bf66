"""Markdown table of physical-plan features per registered query.

    python -m tests.plan_summary [/root/testdata/sf0.01]

Counts come from the initial adaptive plan (before runtime re-planning), so a
join may still become a broadcast at run time. Plans of cached inputs are left
out: they run once, when first materialised.
"""

from __future__ import annotations

import contextlib
import io
import sys


def plan_nodes(df) -> list[tuple[str, str]]:
    """(node name, one-line description) of every operator of the initial
    physical plan. A cached input is one ``InMemoryTableScan`` node: its stored
    plan is not a child, so work done once at materialisation is not counted."""
    root = df._jdf.queryExecution().executedPlan()
    if root.nodeName() == "AdaptiveSparkPlan":
        root = root.initialPlan()
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append((node.nodeName(), node.simpleString(25)))
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    return out


def features(df, text: str) -> dict:
    nodes = plan_nodes(df)
    names = [n for n, _ in nodes]
    return {
        "exchanges": names.count("Exchange"),
        "smj": names.count("SortMergeJoin"),
        "bhj": names.count("BroadcastHashJoin"),
        "python": sum(names.count(n) for n in ("MapInPandas", "FlatMapGroupsInPandas",
                                               "ArrowEvalPython", "BatchEvalPython")),
        "partial_limit": any(n == "WindowGroupLimit" and "Partial" in s for n, s in nodes),
        "top_k": "TakeOrderedAndProject" in names,
        "pushed": "EqualTo(" in text,
        "cartesian": "CartesianProduct" in names or "BroadcastNestedLoopJoin" in names,
    }


def main(argv: list[str]) -> None:
    sys.path.insert(0, ".")
    from __spark_entry__ import queries

    from tastemap.session import get_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    print("| query | shuffles | sort-merge joins | broadcast joins | Python stages | partial top-k | TakeOrdered | pushed equality filters | cartesian |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name, fn in queries().items():
        df = fn(spark, sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(mode="simple")
        f = features(df, buf.getvalue())
        yn = {True: "yes", False: "—"}
        print(f"| `{name}` | {f['exchanges']} | {f['smj']} | {f['bhj']} | {f['python']} | "
              f"{yn[f['partial_limit']]} | {yn[f['top_k']]} | {yn[f['pushed']]} | {yn[f['cartesian']]} |")


if __name__ == "__main__":
    main(sys.argv[1:])
