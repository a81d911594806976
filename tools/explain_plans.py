"""Summarise the physical plan of every stage and registered query.

Usage: python tools/explain_plans.py [sf_dir] [--at-scale] [--dump DIR] [--markdown FILE]

``--at-scale`` turns off Spark's automatic size-based broadcast, so only the
tables that pass the pull's own size check are broadcast, as on warehouse
tables too large for the automatic threshold.  ``--dump`` writes each
``explain("formatted")`` to DIR; ``--markdown`` writes the plan trees of the
main stages to one markdown file (docs/plans.md).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KINDS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition", "BroadcastExchange",
         "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "Window", "BroadcastNestedLoopJoin",
         "CartesianProduct", "TakeOrderedAndProject"]


def summary(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = {k: plan.count(k) for k in KINDS if plan.count(k)}
    pushed = sorted({m for m in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if m and "EqualTo" in m or "Not(" in m})
    if pushed:
        out["pushed"] = [p[:80] for p in pushed]
    return out


def plan_tree(df) -> str:
    """The operator tree of ``explain("formatted")`` (without the node details)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n\n")[0] if "\n\n\n" in text else text.split("\n(1)")[0]
    return tree.strip()


def write_markdown(path: str, stages: dict, extra: dict, sf_dir: str) -> None:
    parts = ["# Physical plans at scale\n",
             f"Generated by `python tools/explain_plans.py {sf_dir} --at-scale --markdown {path}`: Spark's "
             "automatic size-based broadcast is off, so only size-checked tables are broadcast, as on 100 TB "
             "tables. Operator trees of `explain(\"formatted\")` before AQE re-planning.\n"]
    for name, df in list(stages.items()) + list(extra.items()):
        parts.append(f"## {name}\n\n```\n{plan_tree(df)}\n```\n")
    with open(path, "w") as fh:
        fh.write("\n".join(parts))


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    dump = sys.argv[sys.argv.index("--dump") + 1] if "--dump" in sys.argv else None
    from canvass.plans.registry import QUERIES, pull_for
    from canvass.session import local_session

    spark = local_session(8, shuffle_partitions=16)
    if "--at-scale" in sys.argv:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    p = pull_for(spark, sf_dir)
    from canvass.operators.referrals import referral_counts
    from canvass.operators.suppression import suppression_list
    stages = {"ah_inforce": p.ah_inforce_plan(), "inforce_quarterly": p._inforce_quarterly(),
              "claim_rollups": p.claim_rollups_plan(),
              "referrals": referral_counts(p.t["vouchers_issued"], p.t["dw_policy_header"]),
              "nps_scrubber": suppression_list(p.t["nps_scrubber0"], p.t["nps_scrubber_policy"], p.t["nps_scrubber_dnc"],
                                               p.t["dw_policy_header"], p.t["dw_dim_insured"],
                                               max_broadcast_bytes=p.config.broadcast_max_bytes),
              "nps_f2": p.nps_f2_plan(), "nps_f2a": p.nps_f2a, "nps_f3": p.nps_f3, "nps_f4": p.nps_f4_plan()}
    from canvass.operators.household import household_profile
    stages["nps_f1"] = household_profile(p.inforce_quarterly, p.claim_rollups, p.dim("dw_dim_zipcode"),
                                         p.dim("dw_dim_group"), stats=p.households,
                                         hot_key_rows=p.config.hot_key_rows)
    from canvass.plans.cube import report_cube
    from canvass.plans.registry import clustered_rollups
    stages["nps_f2_by_filter"] = p.nps_f2_plan(max_list_bytes=0)
    stages["claim_rollups_in_buckets"] = clustered_rollups(p)
    stages["report_cube"] = report_cube(p.populations)
    if "--markdown" in sys.argv:
        write_markdown(sys.argv[sys.argv.index("--markdown") + 1], stages,
                       {"q24_top_states_pif": QUERIES["q24_top_states_pif"](spark, sf_dir)}, sf_dir)
    for name, df in list(stages.items()) + [(k, fn(spark, sf_dir)) for k, fn in QUERIES.items()]:
        print(f"{name:26s} {summary(df)}")
        if dump:
            os.makedirs(dump, exist_ok=True)
            with open(os.path.join(dump, f"{name}.txt"), "w") as fh, contextlib.redirect_stdout(fh):
                df.explain("formatted")


if __name__ == "__main__":
    main()
