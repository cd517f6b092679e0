"""Settings applied to a session created elsewhere must never fail."""

from policylens.session import checkpoint_dir, fast_builds


def test_fast_builds_on_running_session(spark):
    # The call-site capture setting is static on a running session; setting
    # it through the session would raise, so it must be handled client-side.
    fast_builds(spark)
    fast_builds(spark)
    import pyspark.errors.utils as u
    assert u.is_debugging_enabled() is False
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    assert checkpoint_dir(spark)
