from streamcharts.session import RUNTIME_CONF, checkpoint_root, ensure_conf, scratch_path


def test_ensure_conf_pins_utc_and_aqe(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ensure_conf(spark)
        for k, v in RUNTIME_CONF.items():
            assert spark.conf.get(k) == v
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_checkpoint_root_is_stable_and_scratch_paths_are_fresh(spark):
    root = checkpoint_root(spark)
    assert root and checkpoint_root(spark) == root
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)
