"""Listings of many folders: few tasks, and one listing for all that needs the files."""

from datetime import date

from pyspark.sql import functions as F

from lavra.operators.periods import month_spine
from lavra.plans import admissions
from lavra.sources import dbf, landing, ranges
from tests.helpers import dbf_bytes, rows

LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def tasks_of(spark, label, run):
    """The tasks of all jobs that ``run`` starts, and what it gives."""
    spark.sparkContext.setJobGroup(label, label)
    try:
        found = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup(label) for s in tracker.getJobInfo(job).stageIds}
    return sum(info.numTasks for info in map(tracker.getStageInfo, stages) if info), found


def landed(root, blocks):
    for block in range(blocks):
        folder = root / "ano=2023" / "arquivo=RDSP2301.dbf" / f"bloco={block}"
        folder.mkdir(parents=True)
        (folder / "part-0").write_bytes(dbf_bytes([("A", "C", 4)], [(" ", [f"{block:04}"])]))
    return str(root)


def test_a_listing_does_not_take_a_task_for_each_folder(spark, tmp_path):
    path, cores, before = landed(tmp_path, 100), spark.sparkContext.defaultParallelism, spark.conf.get(LISTING)
    tasks, files = tasks_of(spark, "list-files", lambda: ranges.list_files(spark, path))
    assert tasks <= cores
    assert files.count() == 100
    tasks, found = tasks_of(spark, "landed-files", lambda: landing.landed_files(spark, path))
    assert tasks <= cores
    assert found.filter(F.col("arquivo").contains("bloco=")).count() == 100
    assert spark.conf.get(LISTING) == before


def test_the_rows_of_a_listing_are_in_few_partitions(spark, tmp_path):
    path, cores, largest = landed(tmp_path, 200), spark.sparkContext.defaultParallelism, "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(largest)
    spark.conf.set(largest, "1m")
    try:
        files = ranges.list_files(spark, path)
        assert files.rdd.getNumPartitions() <= 4 * cores
        assert sorted(r["_arquivo"].split("bloco=")[1] for r in files.collect()) == sorted(f"{i}/part-0" for i in range(200))
    finally:
        spark.conf.set(largest, before)


def test_months_are_read_from_one_listing(spark, tmp_path):
    path = landed(tmp_path / "in", 40)
    files = ranges.list_files(spark, path)
    tasks, again = tasks_of(spark, "again", lambda: ranges.list_files(spark, files))
    assert (tasks, again) == (0, files)
    fields = dbf.describe(spark, files)
    assert fields == dbf.describe(spark, path) == [dbf.Field("A", "C", 0)]
    found, unreadable = admissions.stage_months(spark, files, fields)
    assert rows(found) == [(f"{block:04}", 2023, 1) for block in range(40)]
    assert unreadable.count() == 0
    months = month_spine(spark, date(2023, 1, 1), date(2023, 2, 1))
    assert rows(months.join(found, ["ano", "mes"], "left_anti").select("mes")) == [(2,)]
