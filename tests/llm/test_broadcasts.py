"""Exploded tables stay off the driver: the planner sizes them as they were before."""

import pytest

from tests.conftest import spark  # noqa: F401
from tillsight.llm import simhash, spelling


def exploded_broadcasts(df):
    """Broadcast exchanges of the plan, as first planned, above an explode."""
    plan = df._jdf.queryExecution().executedPlan()
    todo, held = [plan.initialPlan()], []
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName().startswith("BroadcastExchange") and "Generate" in node.toString():
            held.append(node.toString())
    return held


@pytest.fixture
def classes(spark, tmp_path):  # noqa: F811
    rows = [(i * 0x9E3779B97F4A7C1 % (1 << 62),) for i in range(40)]
    rows += [(x ^ 5,) for x, in rows[:10]]
    spark.createDataFrame(rows, "fp long").write.parquet(f"{tmp_path}/fp")
    return spark.read.parquet(f"{tmp_path}/fp")


def test_simhash_keys_are_not_broadcast(classes):
    found = simhash.links(classes, 50, 4)
    assert exploded_broadcasts(found) == []
    assert found.count() == 10


def test_midpoints_are_not_broadcast(classes):
    assert exploded_broadcasts(simhash.by_midpoints(classes, 4)) == []


def test_spelling_signatures_are_not_broadcast(spark, tmp_path, monkeypatch):  # noqa: F811
    words = [("".join("abcd"[i >> 2 * k & 3] for k in range(5)), i) for i in range(64)]
    spark.createDataFrame(words, "word string, n long").write.parquet(f"{tmp_path}/words")
    held, store = [], spelling.stored
    monkeypatch.setattr(spelling, "stored", lambda df, name: (
        held.extend(exploded_broadcasts(df)), store(df, name))[1])
    found = spelling.near_words(spark.read.parquet(f"{tmp_path}/words"))
    assert held + exploded_broadcasts(found) == []
    assert found.count() == 64 * 9
