"""The stored code dictionary."""

from quayline.checks.derived import DerivedTables


def test_the_code_dictionary_is_not_made_in_one_task(spark, folder):
    """Every aggregate of a task holds its memory until the task ends."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    context = spark.sparkContext
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        context.setJobGroup("codes", "codes")
        codes = DerivedTables(spark, folder)("tbl_codes")
        tracker = context.statusTracker()
        tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("codes")
                 for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)]
        assert max(tasks) >= 5 * 40
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(codes.inputFiles()) == 1
    assert codes.groupBy("id", "type", "code").count().where("count > 1").isEmpty()
