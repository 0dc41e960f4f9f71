"""What `prepare` sets, on sessions of its own."""

from orderloom.session import prepare

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_prepare_keeps_generated_methods_compilable(spark):
    session = spark.newSession()
    session.conf.unset(LIMIT)
    assert prepare(session).conf.get(LIMIT) == "8000"


def test_prepare_keeps_the_clusters_own_limit(spark):
    session = spark.newSession()
    session.conf.set(LIMIT, "65535")
    assert prepare(session).conf.get(LIMIT) == "65535"
