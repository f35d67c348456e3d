"""Scratch folders: one per run, removed at its end."""

from pathlib import Path

import pytest

from mentions import session
from mentions.operators.corpus import tf_idf
from mentions.session import clear_scratch, scratch_dir, scratch_run


def test_a_run_removes_its_scratch(spark, concepts):
    kept = scratch_dir(spark, "kept")
    spark.range(3).write.parquet(kept)
    with scratch_run(spark) as folder:
        rows = tf_idf(concepts).collect()
        assert rows and list(Path(folder).iterdir())
        with scratch_run(spark) as inner:
            spark.range(2).write.parquet(scratch_dir(spark, "inner"))
            assert list(Path(inner).iterdir())
        assert not Path(inner).exists() and scratch_dir(spark).startswith(folder)
    assert not Path(folder).exists()
    assert spark.read.parquet(kept).count() == 3
    assert not scratch_dir(spark).startswith(folder)


def test_a_failed_run_removes_its_scratch(spark):
    with pytest.raises(RuntimeError), scratch_run(spark) as folder:
        spark.range(2).write.parquet(scratch_dir(spark, "lost"))
        raise RuntimeError("stop")
    assert not Path(folder).exists()


def test_clear_scratch_removes_the_applications_folders_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "ensure_checkpoint_dir", lambda spark: str(tmp_path))
    spark.range(2).write.parquet(scratch_dir(spark, "x"))
    (tmp_path / "mentions-another").mkdir()
    clear_scratch(spark)
    assert [p.name for p in tmp_path.iterdir()] == ["mentions-another"]


def test_local_session_without_checkpoint_folder(spark, monkeypatch):
    monkeypatch.setattr(session, "CHECKPOINT_KEY", "mentions.none")
    other = spark.newSession()
    first = session.ensure_checkpoint_dir(other)
    assert Path(first).is_dir() and session.ensure_checkpoint_dir(other) == first
