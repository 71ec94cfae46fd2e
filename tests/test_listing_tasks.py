"""Folders of listings are listed by as many tasks as there are cores, however many folders there are."""

import os

from catalume.sources import flows


def test_folders_share_tasks(spark, tmp_path):
    for k in range(60):
        os.makedirs(folder := f"{tmp_path}/in/source_id=a/start={k}")
        with open(f"{folder}/x.xml", "w") as out:
            out.write(f"<s><Dataflow id='f{k}'></Dataflow></s>")
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, context = spark.conf.get(name), spark.sparkContext
    context.setJobGroup("listing", "listing")
    try:
        rows = flows.read_flows(spark, f"{tmp_path}/in")
        tracker = context.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert stages and max(s.numTasks for s in stages) <= context.defaultParallelism
    assert rows.count() == 60 and spark.conf.get(name) == before
