"""Bounded graph retrieval over edge lists: expansion, facts, statements, neighbourhoods.

Limits come before the joins that they bound, always with a total order; hops are deduplicated in between. Ids are
whole numbers; supplier and part ids are told apart by sign in ``entity_edges``.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def touching(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Distinct (node, other) of the edges that have one of the nodes (id) at either end; other edges aren't deduplicated."""
    ids = nodes.select("id").distinct()
    out = edges.join(ids, edges.a == ids.id).select(F.col("a").alias("node"), F.col("b").alias("other"))
    back = edges.join(ids, edges.b == ids.id).select(F.col("b").alias("node"), F.col("a").alias("other"))
    return out.union(back).distinct()


def around(edges: DataFrame, ids: list[int]) -> DataFrame:
    """As ``touching`` for given ids, as conditions on the scan."""
    out = edges.where(F.col("a").isin(ids)).select(F.col("a").alias("node"), F.col("b").alias("other"))
    return out.union(edges.where(F.col("b").isin(ids)).select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct()


def _on_paths(start: int, first: DataFrame, second: DataFrame, ends: list[int] | None, cap: int | None) -> DataFrame:
    """The nodes of the paths over ``first`` (m) and ``second`` (m, e), the smallest ``cap`` of them."""
    one = first if ends is None else first.where(F.col("m").isin(ends))
    paths = one.select(F.array(F.lit(start).cast("bigint"), "m").alias("path")).union(second.select(F.array(F.lit(start).cast("bigint"), "m", "e").alias("path")))
    nodes = paths.select(F.explode("path").alias("id")).distinct()
    return nodes if cap is None else nodes.orderBy("id").limit(cap)


def expand(edges: DataFrame, start: int, ends: list[int] | None = None, cap: int | None = 50) -> DataFrame:
    """All nodes on paths of one or two undirected edges from ``start`` to any of ``ends`` (to any node if None).

    At most ``cap`` of them, in order of their ids. With ends, both sides are expanded by one edge and meet in the middle.
    """
    first = around(edges, [start]).select(F.col("other").alias("m"))
    if ends is None:
        second = touching(edges, first.select(F.col("m").alias("id"))).select(F.col("node").alias("m"), F.col("other").alias("e"))
    else:
        second = around(edges, ends).select(F.col("other").alias("m"), F.col("node").alias("e")).join(first, "m", "left_semi")
    return _on_paths(start, first, second.where(F.col("e") != start), ends, cap)


class Adjacency:
    """Neighbour lists as a table: folders by a hash of the node, in them files by ranges of node and neighbour.

    Reading given nodes opens their folders, and in these the row groups that hold them. The list of a hub lies in many
    files, none of which grows with it. A second table has the degrees.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64) -> None:
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    @classmethod
    def build(cls, edges: DataFrame, path: str, buckets: int = 64) -> Adjacency:
        """From (a, b), in any direction and any number of times; edges with a null end are left out."""
        made = cls(edges.sparkSession, path, buckets)
        pairs = edges.where("a IS NOT NULL AND b IS NOT NULL").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().toDF("node", "other")
        placed = both.withColumn("bucket", made._bucket(F.col("node")))
        placed.repartitionByRange("bucket", "node", "other").sortWithinPartitions("bucket", "node", "other").write.partitionBy("bucket").parquet(f"{made.path}/lists")
        made.lists().groupBy("node").agg(F.count("*").alias("degree")).write.parquet(f"{made.path}/degrees")
        return made

    def _bucket(self, node: Column) -> Column:
        return F.pmod(F.crc32(node.cast("string")), F.lit(self.buckets)).cast("int")

    def lists(self) -> DataFrame:
        return self.spark.read.schema("node long, other long, bucket int").parquet(f"{self.path}/lists")

    def degrees(self) -> DataFrame:
        return self.spark.read.schema("node long, degree long").parquet(f"{self.path}/degrees")

    def around(self, ids: list[int]) -> DataFrame:
        """(node, other) of the given nodes."""
        buckets = sorted({zlib.crc32(str(i).encode()) % self.buckets for i in ids})
        return self.lists().where(F.col("bucket").isin(buckets) & F.col("node").isin(ids)).select("node", "other")

    def touching(self, nodes: DataFrame, cap: int | None = None) -> DataFrame:
        """(node, other) of the nodes (id); with a cap the smallest ``cap`` of each, chosen in each task before rows are moved."""
        asked = nodes.select(F.col("id").cast("long").alias("id")).distinct()
        asked = asked.withColumn("__bucket", self._bucket(F.col("id")))
        found = self.lists().join(asked, (F.col("bucket") == F.col("__bucket")) & (F.col("node") == F.col("id"))).select("node", "other")
        if cap is None:
            return found
        return found.withColumn("__k", F.row_number().over(Window.partitionBy("node").orderBy("other"))).where(F.col("__k") <= cap).drop("__k")

    def expand(self, start: int, ends: list[int] | None = None, cap: int | None = 50) -> DataFrame:
        """As the function ``expand``. Of each node in the middle no more than ``cap`` neighbours are looked at."""
        first = self.around([start]).select(F.col("other").alias("m"))
        if ends is None:
            second = self.touching(first.select(F.col("m").alias("id")), None if cap is None else cap + 1).select(F.col("node").alias("m"), F.col("other").alias("e"))
        else:
            second = self.around(ends).select(F.col("other").alias("m"), F.col("node").alias("e")).join(first, "m", "left_semi")
        return _on_paths(start, first, second.where(F.col("e") != start), ends, cap)


def facts_among(facts: DataFrame, entities: DataFrame, limit: int | None = None) -> DataFrame:
    """Facts (fact, s, o) whose subject and object are both among the entities."""
    ids = entities.select("id").distinct()
    out = facts.join(ids.select(F.col("id").alias("s")), "s", "left_semi").join(ids.select(F.col("id").alias("o")), "o", "left_semi").select("fact", "s", "o").distinct()
    return out if limit is None else out.orderBy("fact").limit(limit)


def statements_of(facts: DataFrame, previous: DataFrame, limit: int | None = None) -> DataFrame:
    """Statements that support the facts, with those right before and after them in their source. ``previous``: id, prev."""
    supported = facts.select(F.col("fact").alias("id")).distinct()
    links = previous.where(F.col("prev").isNotNull())
    before = links.join(supported, "id").select(F.col("prev").alias("id"))
    after = links.join(supported.select(F.col("id").alias("prev")), "prev").select("id")
    out = supported.union(before).union(after).distinct()
    return out if limit is None else out.orderBy("id").limit(limit)


def neighbourhood(edges: DataFrame, starts: DataFrame, limit: int | None = 100) -> DataFrame:
    """(p, n1, n2): neighbours of the starting nodes and, where there are any, neighbours of these that aren't p."""
    first = touching(edges, starts).toDF("p", "n1")
    hop = touching(edges, first.select(F.col("n1").alias("id"))).toDF("x", "n2")
    out = first.join(hop, (F.col("n1") == F.col("x")) & (F.col("n2") != F.col("p")), "left").select("p", "n1", "n2")
    return out if limit is None else out.orderBy("p", "n1", F.col("n2").asc_nulls_last()).limit(limit)


def cross_source(mentions: DataFrame) -> DataFrame:
    """Entities mentioned in more than one kind of source, by connections. ``mentions``: id, kind."""
    out = mentions.groupBy("id").agg(F.array_join(F.sort_array(F.collect_set("kind")), ",").alias("kinds"), F.countDistinct("kind").alias("n_kinds"), F.count("*").alias("connections"))
    return out.where("n_kinds > 1")


def network(chunks: DataFrame, names: DataFrame, limit: int | None = 150) -> DataFrame:
    """(anchor, other) of one chunk, the anchor among the names and the other not itself. ``chunks``: chunk, id, value."""
    anchors = chunks.join(names.select("id"), "id", "left_semi").select("chunk", F.col("id").alias("anchor"))
    out = anchors.join(chunks.where("value IS NOT NULL").select("chunk", F.col("id").alias("other")), "chunk").where("anchor <> other").select("anchor", "other").distinct()
    return out if limit is None else out.orderBy("anchor", "other").limit(limit)
