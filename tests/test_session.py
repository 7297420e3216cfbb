"""Session helpers: scoped confs are restored; the shared folder comes from the session."""

from registry_analytics.session import scoped_conf, shared_dir


def test_scoped_conf_restores(spark):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    with scoped_conf(spark, spark__sql__maxConcurrentOutputFileWriters=3):
        assert spark.conf.get(key) == "3"
    assert spark.conf.get(key, None) == before


def test_shared_dir_comes_from_the_session(spark):
    d = shared_dir(spark)
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    assert d == conf.rstrip("/") if conf else d
