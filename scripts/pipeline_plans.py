"""Physical plans of the three jobs as they run on large tables.

Builds the hand-made fixture tables under a scratch folder, then plans
P1, P2 and P3 with the decisions a large deployment makes: no lookup
broadcast (submart.broadcast.maxRows=0), no estimate-based broadcast, and a
hot-key threshold low enough that the skew-safe as-of plan is used.
"""

from __future__ import annotations

import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]
os.environ["TZ"] = "UTC"

from pyspark.sql import SparkSession  # noqa: E402

import fixtures as fx  # noqa: E402
from submart.plans.pipelines import (Layout, enrichment_result, enrichment_specs,  # noqa: E402
                                     profile_result, profile_specs, usage_result,
                                     usage_specs)
from submart.session import RECOMMENDED_CONF, ensure_checkpoint_dir  # noqa: E402
from submart.sources.sinks import _spread, conform  # noqa: E402
from submart.specs import RunContext  # noqa: E402


def tree(df) -> str:
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return text.split("\n\n")[0]


def main():
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    b = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8"))
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("submart.broadcast.maxRows", "0")
    spark.conf.set("submart.skew.hotKeyRows", "1")
    lay = Layout(root=scratch + "/mart")
    for name, make in (("vw_usge", fx.usage), ("vw_subs_hist", fx.subs_hist),
                       ("vw_subs_stts_hist", fx.stts_hist), ("vw_cust_type_hist", fx.cust_type_hist),
                       ("vw_acct_hist", fx.acct_hist), ("vw_cust_hist", fx.cust_hist)):
        make(spark).write.parquet(lay.where(name))
        if name.endswith("_hist"):
            make(spark).write.parquet(lay.where(name[:-5] + "_active"))
    ctx = RunContext(fx.RUN_DATE, fx.CURRENT_DATE)

    src, tgt = usage_specs(spark, lay)
    p1 = _spread(conform(usage_result(spark, src, ctx), tgt), tgt)
    print("== P1 usage (as written to usge_dly_aggr)\n" + tree(p1))
    p1.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
      .partitionBy("evnt_strt").parquet(tgt.location)

    sources, tgt = enrichment_specs(lay)
    p2 = enrichment_result(spark, sources, ctx)
    print("\n== P2 enrichment\n" + tree(p2))
    conform(p2, tgt).write.partitionBy("run_date").parquet(tgt.location)

    sources, _ = profile_specs(lay)
    print("\n== P3 profile, as written\n" + tree(profile_result(spark, sources, ctx)))
    spark.stop()


if __name__ == "__main__":
    main()
