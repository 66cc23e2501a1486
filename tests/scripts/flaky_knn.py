"""Run the exact kNN with an injected task failure; print OK if the retried
result equals the clean one.  Runs in its own process (needs a master that
allows task retries: local[N, maxFailures])."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession  # noqa: E402

from itemrank.operators import similarity, knn  # noqa: E402
from itemrank.plans.tables import Tables  # noqa: E402
from itemrank.session import configure  # noqa: E402

spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
configure(spark)
t = Tables(spark, "/root/testdata/sf0.001")
vec = similarity.cf_vectors(t.latest).checkpoint(eager=True)
cols = ["item_id", "rank", "neighbor_id", "score"]
clean = sorted(map(tuple, knn.top_k_neighbors(vec, 5, "l2", 6, n_blocks=3).select(cols).collect()))

orig = knn._pair_task


def flaky(k, metric, decimals, nb):
    run = orig(k, metric, decimals, nb)

    def wrapped(pdf):
        from pyspark import TaskContext

        tc = TaskContext.get()
        if tc.attemptNumber() == 0 and tc.partitionId() == 0:
            raise RuntimeError("injected loss of the task's executor")
        return run(pdf)
    return wrapped


knn._pair_task = flaky
retried = sorted(map(tuple, knn.top_k_neighbors(vec, 5, "l2", 6, n_blocks=3).select(cols).collect()))
print("OK" if retried == clean and clean else "MISMATCH")
spark.stop()
