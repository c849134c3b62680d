"""Session helpers: the shared folder comes from spark.checkpoint.dir."""

from lakeward import session


def test_checkpoint_dir_is_read_from_the_session(spark):
    configured = spark.sparkContext.getCheckpointDir()
    assert configured and session.ensure_checkpoint_dir(spark) == configured


def test_shared_dir_lives_under_the_checkpoint_dir(spark):
    base = session.ensure_checkpoint_dir(spark).replace("file:", "")
    a = session.shared_dir(spark, "staging", "t", unique=True)
    b = session.shared_dir(spark, "staging", "t", unique=True)
    assert a.startswith(base) and b.startswith(base) and a != b


def test_ship_library_once_per_application(spark):
    session.ship_library(spark)
    session.ship_library(spark)
    assert spark.sparkContext.applicationId in session._SHIPPED
    # workers import the package
    out = spark.range(2).mapInPandas(
        lambda it: (pdf.assign(v=__import__("lakeward").__version__) for pdf in it), "id long, v string"
    ).collect()
    assert {r.v for r in out} == {__import__("lakeward").__version__}
