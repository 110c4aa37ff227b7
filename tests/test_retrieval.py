"""Bounded top-n retrieval beside all pairs."""

import numpy as np
import pytest

from stationlab.functions import retrieval
from stationlab.operators import recommend


def all_pairs(users, items, n):
    out = []
    for u, x in users.items():
        scored = sorted((-float(np.dot(x.astype(float), y.astype(float))), i) for i, y in items.items())
        out += [(u, i, -s) for s, i in scored[:n]]
    return sorted(out)


@pytest.mark.parametrize(("block", "n"), [(65_536, 10), (7, 3), (7, 50), (1, 1)])
def test_same_rows_as_all_pairs(spark, monkeypatch, block, n):
    monkeypatch.setattr(retrieval, "ITEM_BLOCK", block)
    rng = np.random.default_rng(n)
    count = 12 if block == 1 else 40
    items = {i: (rng.normal(size=4) * rng.choice([0.1, 1, 5])).astype(np.float32) for i in range(count)}
    items[count], items[count + 1] = items[3], np.zeros(4, np.float32)  # a tie, and an item without direction
    users = {u: rng.normal(size=4).astype(np.float32) for u in range(25)} | {99: np.zeros(4, np.float32), 100: -items[3]}
    frame = lambda d: spark.createDataFrame([(k, v.tolist()) for k, v in d.items()], "id int, features array<float>")
    got = sorted(tuple(r) for r in retrieval.top_items(frame(users), frame(items), n).collect())
    want = all_pairs(users, items, n)
    assert [r[:2] for r in got] == [r[:2] for r in want] and np.allclose([r[2] for r in got], [r[2] for r in want])


def test_far_blocks_are_not_read(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "ITEM_BLOCK", 5)
    rounds = []
    plain = retrieval._with_block
    monkeypatch.setattr(retrieval, "_with_block", lambda *a: rounds.append(1) or plain(*a))
    items = spark.createDataFrame([(i, [10.0 if i < 5 else 0.01, 0.0]) for i in range(40)], "id int, features array<float>")
    users = spark.createDataFrame([(u, [1.0 + u, 0.5]) for u in range(10)], "id int, features array<float>")
    assert retrieval.top_items(users, items, 3).count() == 30 and len(rounds) == 1
    assert retrieval.top_items(users, items.limit(0), 3).count() == 0 and retrieval.top_items(users.limit(0), items, 3).count() == 0


def test_recommendations_equal_the_models(spark):
    rng = np.random.default_rng(2)
    rows = [(f"u{u}", f"i{i}", float(rng.integers(1, 6))) for u in range(15) for i in range(12) if rng.random() < 0.6]
    r = recommend.prepare_ratings(spark.createDataFrame(rows, "user string, item string, stars double"), "user", "item", "stars")
    result = recommend.als_train(r, rank=4, max_iter=2)
    theirs = result.model.recommendForAllUsers(4).select("_user", recommend.F.inline("recommendations")).join(r.users, "_user").join(r.items, "_item")
    want = {(x.user, x.item): x.rating for x in theirs.collect()}
    got = {(x.user, x.item): x.predicted_rating for x in recommend.recommend_top_n(result, r, 4).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-5 for k in want)
    some = spark.createDataFrame([("u1",), ("u2",), ("nobody",), ("u1",)], "user string")
    few = recommend.recommend_top_n(result, r, 4, some).collect()
    assert {(x.user, x.item) for x in few} == {k for k in want if k[0] in ("u1", "u2")} and len(few) == len({x.user for x in few}) * 4
