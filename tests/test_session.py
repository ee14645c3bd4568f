from strata.session import scratch_path, shared_dir


def test_shared_dir_is_stable_and_comes_from_the_session(spark):
    d = shared_dir(spark)
    assert d == shared_dir(spark)                       # one folder per session
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert d == (named or spark.sparkContext.getCheckpointDir()).rstrip("/")
    assert scratch_path(spark, "a", "b") == f"{d}/a/b"


def test_session_is_utc_with_aqe(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
