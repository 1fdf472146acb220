import pytest

from linkscore.llm import store


def test_tables_go_to_the_sessions_folder(spark):
    scratch = store.Scratch(spark)
    assert scratch.folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    table = scratch.put(spark.range(5).selectExpr("id", "id % 2 AS part"), "part")
    assert sorted(r["id"] for r in table.filter("part = 1").collect()) == [1, 3]
    scratch.drop(table, "part=0")
    assert table.filter("part = 1").count() == 2
    scratch.drop(table)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{scratch.folder}/1")


def test_a_local_session_may_leave_it_unset(spark, monkeypatch):
    monkeypatch.setattr(store, "SETTING", "spark.linkscore.unset")
    own = store.shared_folder(spark)
    assert own.startswith("file:/") and own == store.shared_folder(spark)
    assert store.Scratch(spark).put(spark.range(3)).count() == 3
