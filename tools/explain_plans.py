"""Print the formatted physical plans of the key operators.

    python tools/explain_plans.py [sf_dir] > docs/plans_sf0.01.txt

Plans are taken before execution (AQE may still re-plan joins at runtime).  Scratch
paths in file-scan nodes are shortened.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierline import queries as Q  # noqa: E402
from tierline.operators import funnel  # noqa: E402
from tierline.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    silver = Q.silver_testbed(spark, sf_dir)
    plans = {
        "campaign rollup (leaf-first funnel)": funnel.campaign_rollup(silver),
        "advertiser revenue climb": funnel.revenue_by_advertiser(silver),
        "dedup_lineitem (partial WindowGroupLimit)": Q.q_dedup_lineitem(spark, sf_dir),
        "fk_flag_events_supplier (NULL keys dealt by row hash)": Q.q_fk_flag_events_supplier(spark, sf_dir),
        "rank_in_channel (distinct values in sampled ranges)": Q.q_rank_in_channel(spark, sf_dir),
        "industry_share (group totals joined back)": Q.q_industry_share(spark, sf_dir),
        "testbed as-of links (blocked running max)": Q.tb.events_with_links(spark, sf_dir),
        "event_window (pushdown)": Q.q_event_window(spark, sf_dir),
    }
    for title, df in plans.items():
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        text = re.sub(r"file:/\S*/tierline-([a-z_]+)-[0-9a-f]+", r"<scratch>/\1", text)
        print(f"==== {title} ====\n{text}\n")
    spark.stop()


if __name__ == "__main__":
    main()
