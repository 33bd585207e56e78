"""Print the condensed physical plans (operator lines only) of the
scale-relevant stages and queries, as Markdown.

usage: python tools/show_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from contrail.operators.events import detect_flight_events  # noqa: E402
from contrail.operators.match import match_airports  # noqa: E402
from contrail.operators.near import near_pairs  # noqa: E402
from contrail.plans import queries as Q  # noqa: E402
from contrail.plans.pipeline import pipeline_from_dir  # noqa: E402
from contrail.session import cut_lineage, local_session, session_conf  # noqa: E402

KEEP = re.compile(r"(Exchange|Aggregate|Join|Window|WindowGroupLimit|Generate|Scan|TakeOrdered|Union|"
                  r"Sort |Expand|Cartesian|BroadcastNestedLoop)")


def condensed(df) -> list[str]:
    text = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in text.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r", \[plan_id=\d+\]", "", line)
            out.append(line[:170])
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, shuffle_partitions=16)
    p = pipeline_from_dir(spark, sf_dir)
    clean = cut_lineage(p.clean, "plans-clean")
    events = cut_lineage(p.events, "plans-events", columnar=False)
    stages = {
        "clean (dedup U-2, map-side WindowGroupLimit)": p.clean,
        "events (split lag W-1/W-2 over a materialized clean)": detect_flight_events(clean, "b"),
        "airport match (J-1, row-local)": match_airports(events, p.airports),
        "near pairs (J-2 grid equi-join + pair grain)": near_pairs(clean),
        "Q3 proximity hubs": Q.q3_proximity_hubs(p.graph),
        "Q5 country interactions": Q.q5_country_interactions(p.graph),
        "Q9 top routes (counted, no pair listing)": Q.q9_top_routes(p.graph),
        "Q10 net traffic": Q.q10_net_traffic(p.graph),
    }
    # the same stages when nothing is small enough to broadcast (large inputs)
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1",
                              "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        at_scale = {
            "near pairs, no broadcast (the plan at scale)": condensed(near_pairs(clean)),
            "airport match, no broadcast": condensed(match_airports(events, p.airports)),
            "Q5 country interactions, no broadcast": condensed(Q.q5_country_interactions(p.graph)),
        }
    print(f"# Physical plans ({os.path.basename(sf_dir)}, local[8], AQE on)\n")
    print("Condensed `executedPlan` operator lines (before AQE re-planning) of the\n"
          "scale-relevant stages; produced by `python tools/show_plans.py`.\n")
    for title, df in stages.items():
        print(f"## {title}\n\n```")
        print("\n".join(condensed(df)))
        print("```\n")
    for title, lines in at_scale.items():
        print(f"## {title}\n\n```")
        print("\n".join(lines))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
