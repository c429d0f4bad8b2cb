"""Step counts come with the job that writes a flow's result."""

from pyspark.sql import functions as F

from paceframe.session import materialise
from paceframe.sources.tables import StepCounts


def test_counts_of_one_job(spark):
    steps = StepCounts()
    raw = steps.watch("raw", spark.range(100).repartition(3))
    even = steps.watch("even", raw.where("id % 2 = 0"))
    out = steps.watch("wide", even.withColumn("x", F.lit(1)).where("id > 1000"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("steps", "steps")
    materialise(out)
    spark.sparkContext.setJobGroup("report", "report")
    assert [tuple(r) for r in steps.report(spark).collect()] == [("raw", 100, 1), ("even", 50, 1), ("wide", 0, 2)]
    assert len(tracker.getJobIdsForGroup("steps")) <= 2  # the shuffle's stage and the write, under adaptive execution
