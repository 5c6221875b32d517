"""Shared scratch folder and job labels."""

from fareline.session import job_description, scratch_path, shared_dir


def test_shared_dir_uses_the_configured_checkpoint_folder(spark):
    # the session's spark.checkpoint.dir wins; else the SparkContext's checkpoint dir
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert configured
    assert shared_dir(spark) == configured.rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared_dir(spark) + "/fareline/x-")


def test_job_description_labels_and_clears(spark):
    sc = spark.sparkContext
    with job_description(spark, "fareline test: label"):
        assert sc.getLocalProperty("spark.job.description") == "fareline test: label"
    assert sc.getLocalProperty("spark.job.description") is None
