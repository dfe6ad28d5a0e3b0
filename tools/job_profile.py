"""Jobs, stages and tasks launched by each registered query (local run).

    python tools/job_profile.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    only = set(argv[2:])
    from epitrend.plans.queries import QUERIES
    from epitrend.session import local_session

    spark = local_session(8, shuffle_partitions=8)
    sc = spark.sparkContext
    st = sc.statusTracker()
    QUERIES["feature_table"](spark, "/root/testdata/sf0.001").write.format("noop").mode(
        "overwrite").save()
    for name, q in QUERIES.items():
        if only and name not in only:
            continue
        sc.setJobGroup(name, name)
        t0 = time.perf_counter()
        q(spark, sf_dir).write.format("noop").mode("overwrite").save()
        dt = time.perf_counter() - t0
        jobs = st.getJobIdsForGroup(name)
        stages = [s for j in jobs for s in (st.getJobInfo(j).stageIds if st.getJobInfo(j) else [])]
        tasks = sum(st.getStageInfo(s).numTasks for s in stages if st.getStageInfo(s))
        print(f"{name:24s} {dt:6.2f}s jobs={len(jobs):3d} stages={len(stages):3d} "
              f"tasks={tasks:4d}", flush=True)


if __name__ == "__main__":
    main(sys.argv)
