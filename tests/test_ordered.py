"""Ordered operators against brute force, with a group that holds most rows, nulls, ties and empty tables."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import chunks as K
from tessera.operators import corpus as C
from tessera.operators import ordered as O


@pytest.fixture(scope="module")
def data():
    deal = random.Random(5)
    keys = ["hot"] * 9 + ["a", "b", None]
    return [(i, deal.choice(keys), deal.choice([None, *range(40)])) for i in range(1500)]


@pytest.fixture(scope="module")
def rows(spark, data):
    return spark.createDataFrame(data, "id long, k string, v long").repartition(5)


def by_key(data):
    groups = {}
    for i, k, v in sorted(data):
        groups.setdefault(k, []).append((i, v))
    return groups


def test_running_carried_following(rows, data):
    running, carried, following = {}, {}, {}
    for group in by_key(data).values():
        total, last = 0, None
        for n, (i, v) in enumerate(group):
            total, last = total + (v or 0), last if v is None else v
            running[i], carried[i] = total, last
            following[i] = (group[n + 1][1],) if n + 1 < len(group) else None
    assert {r["id"]: r["s"] for r in O.running(rows, ["k"], ["id"], "v", "s").collect()} == running
    assert {r["id"]: r["s"] for r in O.carried(rows, ["k"], ["id"], "v", "s").collect()} == carried
    assert {r["id"]: r["s"] and tuple(r["s"]) for r in O.following(rows, ["k"], ["id"], "v", "s").collect()} == following


def test_hot_group_lies_in_many_ranges_and_few_rows_are_handed_on(spark, rows):
    dealt = O.deal(rows, ["k"], ["id"])
    assert dealt.where("k = 'hot'").select(O.RANGE).distinct().count() >= 3
    given = O._handed_on(dealt, ["k"], F.sum("v"), lambda x, w: F.sum(x).over(O._before(w)))
    assert 0 < given.count() < int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("share", [0.0, 0.5, 0.97, 1.0])
def test_percentile(rows, data, share):
    import numpy as np

    found = {r["k"]: r["level"] for r in O.percentile(rows, ["k"], "v", share).collect()}
    assert found == {k: pytest.approx(np.quantile([v for _, v in g if v is not None], share)) for k, g in by_key(data).items()}


def test_asof(spark):
    deal = random.Random(6)
    left = [(i, deal.choice(["hot", "hot", "a", None]), deal.choice([None, *range(50)])) for i in range(300)]
    right = [(i, deal.choice(["hot", "hot", "a", "c", None]), deal.choice([None, *range(50)])) for i in range(200)]
    frame = [spark.createDataFrame(x, "id long, k string, t long") for x in (left, right)]
    found = {r["id"]: r["last"] for r in O.asof(*frame, ["k"], "t", "id", ["id"], "last").collect()}
    best = lambda k, t: max(((u, i) for i, c, u in right if k is not None and c == k and u is not None and t is not None and u <= t), default=(None, None))[1]
    assert found == {i: best(k, t) for i, k, t in left}
    empty = frame[1].where("false")
    assert {r["last"] for r in O.asof(frame[0], empty, ["k"], "t", "id", ["id"], "last").collect()} == {None}
    assert O.asof(empty, frame[1], ["k"], "t", "id", ["id"], "last").count() == 0


def test_between(spark):
    deal = random.Random(7)
    asked = [(i, deal.choice(["hot", "hot", "a", None]), low, deal.choice([None, low + deal.randint(-3, 30)])) for i in range(200) for low in [deal.randint(-20, 50)]]
    points = [(i, deal.choice(["hot", "a", None]), deal.choice([None, *range(-10, 60)])) for i in range(200)]
    a = spark.createDataFrame(asked, "id long, k string, low long, high long")
    p = spark.createDataFrame(points, "pid long, k string, t long")
    pairs = {(i, j) for i, k, low, high in asked for j, c, t in points if None not in (k, high, t) and c == k and low <= t <= high}
    counts = {r["id"]: r["n"] for r in O.count_between(a, p, ["k"], "id", "low", "high", "t", "n").collect()}
    assert counts == {i: sum(x == i for x, _ in pairs) for i, *_ in asked}
    found = [(r["id"], r["pid"]) for r in O.pairs_between(a, p, ["k"], "low", "high", "t", 7).collect()]
    assert len(found) == len(set(found)) and set(found) == pairs


def test_distances_of_a_group_without_rows_behind(spark):
    one = spark.createDataFrame([("g", 1, [1.0, 0.0]), ("h", 1, [1.0, 0.0]), ("h", 2, [0.0, 1.0])], "g string, i long, v array<double>")
    assert [tuple(r) for r in K.distances(one, "g", "i", "v").collect()] == [("h", 1, 1.0)]
    texts = one.select("g", "i", F.concat("g", "i").alias("t"))
    cuts = K.breaks(K.distances(one, "g", "i", "v"), "g", 0).where("is_break")
    assert sorted(tuple(r) for r in K.chunks(texts, cuts, "g", "i", "t").collect()) == [("g", 0, "g1", 1), ("h", 0, "h1 h2", 2)]


def test_crosslink(spark):
    names = ["red widget", "Red", "widget", "re", "d", "", None, "blue red widgets", "wid get", "ÄRGER im Amt", "ärger", "xyz"]
    left = [(d, n) for d in (1, 2, None) for n in names]
    right = [(d, n) for d in (1, None) for n in reversed(names)] + [(2, "red")]
    found = C.name_crosslink(spark.createDataFrame(left, "department int, left_name string"), spark.createDataFrame(right, "department int, right_name string"))
    want = {(d, a, b) for d, a in left for e, b in right if None not in (d, a, b) and d == e and (a.lower() in b.lower() or b.lower() in a.lower())}
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
