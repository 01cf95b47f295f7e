"""Listings and the keyed sink as data sources."""

from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tessera.sources import objects as O


@pytest.fixture()
def store(spark, tmp_path):
    O.register(spark)
    for key in ("top.pdf", "src1/a.PDF", "src1/b.docx", "src1/deep/er/c.pdf", "src2/d.pdf", "src2/e.csv", "_hidden/x.pdf", "src2/.y.pdf"):
        path = tmp_path / "s" / key
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(key)
    return f"file://{tmp_path}/s", tmp_path / "s"


def _keys(df):
    return sorted(r.key for r in df.select("key").collect())


def test_listing(spark, store):
    uri, _ = store
    listed = spark.read.format("tessera_objects").option("path", uri).load()
    assert _keys(listed) == ["src1/a.PDF", "src1/b.docx", "src1/deep/er/c.pdf", "src2/d.pdf", "src2/e.csv", "top.pdf"]
    assert listed.rdd.getNumPartitions() == 3  # own files of the root, src1, src2
    assert {r.size for r in listed.where("key = 'src2/d.pdf'").collect()} == {10}
    pdf = spark.read.format("tessera_objects").option("path", uri).option("suffixes", ".pdf, .docx").load()
    assert _keys(pdf) == ["src1/a.PDF", "src1/b.docx", "src1/deep/er/c.pdf", "src2/d.pdf", "top.pdf"]
    assert _keys(spark.read.format("tessera_objects").option("path", uri + "/none").load()) == []


@pytest.mark.parametrize("prefix", ["src1/", "src", "src1/deep/er/c", "src1/d", "t", "x", "src2/e.csv"])
def test_prefix_is_pushed(spark, store, prefix):
    uri, root = store
    every = _keys(spark.read.format("tessera_objects").option("path", uri).load())
    pushed = spark.read.format("tessera_objects").option("path", uri).load().where(F.col("key").startswith(prefix))
    assert _keys(pushed) == [k for k in every if k.startswith(prefix)]
    assert all(k.startswith(prefix) for part in O._Store(uri).plan(prefix) for k, _ in O._Store(uri).files(part.path, True) if part.deep) or prefix == "src1/d"


def test_versions_follow_contents(spark, store):
    uri, root = store
    version = lambda: {r.key: r.version for r in spark.read.format("tessera_objects").option("path", uri).load().collect()}
    before = version()
    (root / "top.pdf").write_text("other content")
    after = version()
    assert [k for k in before if before[k] != after[k]] == ["top.pdf"]


def test_stream_lists_new_objects_once(spark, store, tmp_path):
    uri, root = store

    def run():
        listed = spark.readStream.format("tessera_objects").option("path", uri).option("settle", "0").load()
        out = listed.select("key").writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/check")
        out.trigger(once=True).start().awaitTermination()
        return _keys(spark.read.schema("key string").parquet(f"file://{tmp_path}/out"))

    assert len(run()) == 6
    time.sleep(0.05)
    (root / "src2" / "new.pdf").write_text("n")
    found = run()
    assert len(found) == 7 and "src2/new.pdf" in found


def _files(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if not f.endswith(".crc"))


def test_keyed_sink(spark, tmp_path):
    rows = spark.createDataFrame([(f"s{i % 3}/{i}.json", json.dumps({"n": i, "t": "é"})) for i in range(50)] + [("s0/0.json", '{"a": 0}')], "key string, payload string").repartition(4)
    O.write_objects(rows, f"file://{tmp_path}/out", indent=2)
    assert _files(tmp_path / "out") == sorted(f"s{i % 3}/{i}.json" for i in range(50))
    text = (tmp_path / "out" / "s1" / "1.json").read_text()
    assert json.loads(text) == {"n": 1, "t": "é"} and "é" in text and "\n" in text
    assert not (tmp_path / "out" / "_staging").exists() or not _files(tmp_path / "out" / "_staging")


@pytest.mark.parametrize("bad", [("k", "{not json"), ("a/../b", "{}"), (None, "{}"), ("a//b", "{}"), ("_x", "{}")])
def test_failed_write_leaves_nothing(spark, tmp_path, bad):
    rows = spark.createDataFrame([(f"s/{i}.json", "{}") for i in range(20)] + [bad], "key string, payload string").repartition(4)
    with pytest.raises(Exception):
        O.write_objects(rows, f"file://{tmp_path}/out")
    assert not (tmp_path / "out").exists() or _files(tmp_path / "out") == []
