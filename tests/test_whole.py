"""Queries over whole tables against brute force."""

from collections import defaultdict

import pytest

from tessera.queries import all_queries

QUERIES, SQL = all_queries()


def rows_of(spark, sf, name):
    return sorted(map(tuple, QUERIES[name](spark, sf).collect()), key=repr)


def test_topics_of_all_orders(spark, sf, duck):
    lines = duck.execute("SELECT l_orderkey, l_linenumber, l_suppkey, s_name, p_name FROM lineitem, supplier, part WHERE l_suppkey = s_suppkey AND l_partkey = p_partkey").fetchall()
    kinds, classes = ("Private Organisation", "Government Organisation", "Person"), ("Supplier", "Government Departments", "Person")
    parsed, entities, ends = set(), set(), set()
    for order, number, supplier, s, p in lines:
        topic = f"order {order}"
        parsed |= {(order, topic, "topic", topic, None, None), (order, topic, "proposition", "goods were supplied", None, None), (order, topic, "entity", p, "Product", None), (order, topic, "relation", s, "SUPPLIES", p)}
        entities.add((order, p, "Product"))
        ends |= {(order, s), (order, p)}
        if number % 5:
            parsed.add((order, topic, "entity", s, kinds[supplier % 3], None))
            entities.add((order, s, classes[supplier % 3]))
    assert len({x[0] for x in lines if x[0] % 20}) > 0
    assert rows_of(spark, sf, "parse_topics") == sorted(parsed, key=repr)
    assert rows_of(spark, sf, "validate_entities") == sorted(entities, key=repr)
    assert rows_of(spark, sf, "dangling_refs") == sorted(ends - {x[:2] for x in entities}, key=repr)


@pytest.mark.parametrize("name,column,is_anchor", [("supplier_network", "s_id", lambda i: i in (3, 5, 8)), ("programme_network", "o_id", lambda i: i % 100 == 7)])
def test_networks_of_all_statements(name, column, is_anchor, spark, sf, duck):
    key = {"s_id": "l_suppkey", "o_id": "1000000000 + l_partkey"}[column]
    chunks = defaultdict(list)
    for chunk, i, value in duck.execute(f"SELECT l_orderkey, {key}, l_quantity FROM lineitem").fetchall():
        chunks[chunk].append((i, value))
    pairs = {(a, b) for rows in chunks.values() for a, _ in rows if is_anchor(a) for b, value in rows if b != a and value is not None}
    assert rows_of(spark, sf, name) == sorted(sorted(pairs)[:150], key=repr)


@pytest.mark.parametrize("name,rows", [("freshness", "lineitem"), ("passthru_window_rank", "orders"), ("passthru_window_frame", "events"), ("passthru_window_lag_lead", "events"), ("passthru_window_first_last", "events")])
def test_a_row_for_each(name, rows, spark, sf, duck):
    assert QUERIES[name](spark, sf).count() == duck.execute(f"SELECT count(*) FROM {rows}").fetchone()[0]


def test_asof_of_all_users(spark, sf, duck):
    seen = {p for p, in duck.execute("SELECT DISTINCT p.event_id FROM events p JOIN events v ON p.user_id = v.user_id AND v.ts <= p.ts AND v.event_type = 'view' WHERE p.event_type = 'purchase'").fetchall()}
    assert {r["event_id"] for r in QUERIES["passthru_asof"](spark, sf).collect()} == seen


def test_crosslinks_of_all_parts(spark, sf, duck):
    parts = [(k % 25, name, name.split(" ")[0]) for k, name in duck.execute("SELECT p_partkey, p_name FROM part").fetchall()]
    links = {(d, name, first) for d, name, _ in parts for e, _, first in parts if d == e and (first.lower() in name.lower() or name.lower() in first.lower())}
    assert rows_of(spark, sf, "name_crosslink") == sorted(links, key=repr)
