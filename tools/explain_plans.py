"""Write the physical plans of the main operators to docs/PLANS.md.

The clean table is written to Parquet first (as a cluster job would keep it),
so the plans show what the operators do over a stored table.

    python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from epitrend import operators as op
    from epitrend.plans import params as P
    from epitrend.plans import queries as Q
    from epitrend.session import local_session, scratch_path
    from epitrend.sources import fixtures as fx
    from epitrend.sources.parquet import read_clean, write_clean
    from pyspark.sql import functions as F

    spark = local_session(8)
    clean = read_clean(spark, write_clean(fx.reports(spark, sf_dir), scratch_path(spark, "plans")))
    feats = op.feature_table(clean, P.NATION_BANDS)
    cases = [
        ("daily_rollup (raw rows -> clean)", op.daily_rollup(fx.report_rows(spark, sf_dir))),
        ("detect_dates (per-report format)", Q._dated(spark, sf_dir)),
        ("qualify_entities", op.qualify_entities(clean, **P.QUALIFY)),
        ("latest_snapshot", op.latest_snapshot(clean)),
        ("top_bottom", op.top_bottom(op.latest_snapshot(clean), "Confirmed")),
        ("feature_table", feats),
        ("baseline_diff", op.baseline_diff(feats, "NATION_0")),
        ("similar_entities", op.similar_entities(op.baseline_diff(feats, "NATION_0"), "abs")),
        ("transpose_features", op.transpose_features(feats)),
        ("value_as_of", op.value_as_of(clean, P.AS_OF)),
        ("band_states of months, finished", op.finish_band_states(
            op.band_states(clean.withColumn("span", F.trunc("Date", "month")), P.NATION_BANDS), P.NATION_BANDS)),
        ("merge_falls of months", op.merge_falls(op.fall_states(
            clean.withColumn("span", F.trunc("Date", "month")), "Active", span="span"))),
        ("match_names", op.match_names(fx.spelled_reports(spark, sf_dir, P.COUNTRY_NAMES), op.iso_aliases(spark))),
    ]
    out = ["# Physical plans", "",
           f"Generated by `tools/explain_plans.py` on `{os.path.basename(sf_dir)}` with the clean",
           "table stored as Parquet. Plans are before execution (AQE may still switch a",
           "join or coalesce partitions at run time).", ""]
    for title, df in cases:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        text = buf.getvalue().replace(scratch_path(spark, "x").rsplit("/epitrend/", 1)[0], "<ckpt>")
        out += [f"## {title}", "", "```", text.strip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs",
                        "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main(sys.argv)
