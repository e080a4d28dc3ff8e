from pathlib import Path

from stepforge.plans import media_queries as Q


def test_a_half_is_written_by_more_than_two_tasks(spark, monkeypatch):
    folders, made = [], Q.new_folder
    monkeypatch.setattr(Q, "new_folder", lambda *a: folders.append(made(*a)) or folders[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        row = Q.growing_folder(spark, "/root/testdata/sf0.001").first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert 0 < row.kept <= row.scored
    assert len(list(Path(folders[0], "in").rglob("*.txt"))) > 4
