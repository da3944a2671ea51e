"""Shared folder: taken from the session, fresh scratch paths below it."""

from stockyard.session import broadcast_max_rows, scratch_path, scratch_root, session_key, shared_dir


def test_shared_dir_comes_from_the_session(spark):
    configured = spark.sparkContext.getCheckpointDir()
    assert configured and shared_dir(spark) == configured


def test_scratch_paths_are_fresh_and_below_the_shared_dir(spark):
    a, b = scratch_path(spark, "warehouse"), scratch_path(spark, "warehouse")
    assert a != b and a.startswith(f"{scratch_root(spark)}/warehouse/") and scratch_root(spark).startswith(shared_dir(spark).rstrip("/"))


def test_settings(spark):
    assert broadcast_max_rows(spark) == 1_000_000
    spark.conf.set("stockyard.broadcast.maxRows", "7")
    try:
        assert broadcast_max_rows(spark) == 7
    finally:
        spark.conf.unset("stockyard.broadcast.maxRows")
    assert session_key(spark) == spark.sparkContext.applicationId


def test_drop_scratch_deletes_only_this_applications_tables(spark, tmp_path, monkeypatch):
    import stockyard.session as S

    monkeypatch.setattr(S, "shared_dir", lambda _: f"file://{tmp_path}")
    other = tmp_path / "stockyard" / "other-application"
    other.mkdir(parents=True)
    path = S.scratch_path(spark, "t")
    spark.range(3).write.parquet(path)
    S.drop_scratch(spark)
    assert other.exists() and not (tmp_path / "stockyard" / session_key(spark)).exists()
