import os

from orrery.sources import storage


def test_clear_deletes_what_was_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "_root", lambda spark, base: str(tmp_path / "own"))
    kept = storage.written(spark.range(3), "t")
    assert kept.count() == 3 and len(os.listdir(tmp_path / "own")) == 1
    storage.clear(spark)
    assert not (tmp_path / "own").exists()
