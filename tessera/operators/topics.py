"""Topic texts: a line grammar of topics, entities, propositions and relations, read by a table function.

``topic: x``; ``entities:`` lines ``name|class``; ``proposition: x``; ``entity-entity relationships:`` lines ``a|rel|b``;
``entity-attributes:`` lines ``a|attribute|value``. Blank lines don't matter, other lines are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "doc_id long, topic string, kind string, a string, b string, c string"
PRIVATE, GOVERNMENT = "Private Organisation", "Government Organisation"
REMAPPED = {PRIVATE: "Supplier", GOVERNMENT: "Government Departments"}


def parse(text: str) -> list[tuple[str | None, str, str, str | None, str | None]]:
    """(topic, kind, a, b, c) for each line of meaning."""
    out, topic, section = [], None, None
    for raw in (text or "").splitlines():
        line = raw.strip()
        low = line.lower()
        if not line:
            continue
        if low.startswith("topic:"):
            topic, section = line[6:].strip(), None
            out.append((topic, "topic", topic, None, None))
        elif low.startswith("proposition:"):
            section = None
            out.append((topic, "proposition", line[12:].strip(), None, None))
        elif low == "entities:":
            section = "entity"
        elif low.startswith("entity-") and low.endswith("s:"):
            section = "attribute" if low.startswith("entity-attribute") else "relation"
        elif section:
            parts = [p.strip() for p in line.split("|")]
            wanted = 2 if section == "entity" else 3
            if len(parts) == wanted and all(parts):
                out.append((topic, section, parts[0], parts[1], parts[2] if wanted == 3 else None))
    return out


def _parser(batches):
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    for batch in batches:
        rows = [(d, *r) for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for r in parse(text)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64() if i == 0 else pa.string()) for i in range(6)], names=names)


def parse_topics(docs: DataFrame) -> DataFrame:
    """``docs``: doc_id, text."""
    from ..workers import ship

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_parser, SCHEMA)


def remap_classes(parsed: DataFrame) -> DataFrame:
    """Entities with classes that aren't allowed replaced."""
    mapped = F.coalesce(*[F.when(F.col("b") == k, F.lit(v)) for k, v in REMAPPED.items()], F.col("b"))
    return parsed.where("kind = 'entity'").withColumn("b", mapped)


def dangling(parsed: DataFrame) -> DataFrame:
    """Ends of relations that aren't among the entities of their topic, in one pass over the parsed rows."""
    is_end = F.col("kind") == "relation"
    # what has no document, topic or name equals nothing, as in a join
    rows = parsed.where("kind = 'relation' OR kind = 'entity' AND doc_id IS NOT NULL AND topic IS NOT NULL AND a IS NOT NULL")
    named = rows.select("doc_id", "topic", is_end.alias("is_end"), F.explode(F.when(is_end, F.array("a", "c")).otherwise(F.array("a"))).alias("name"))
    return named.groupBy("doc_id", "topic", "name").agg(F.bool_and("is_end").alias("all_ends")).where("all_ends").select("doc_id", "topic", "name")


def _dangler(batches):
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parsed = parse(text)
            entities = {(topic, a) for topic, kind, a, _, _ in parsed if kind == "entity" and topic is not None and doc is not None}
            ends = dict.fromkeys((topic, end) for topic, kind, a, _, c in parsed if kind == "relation" for end in (a, c))
            rows += [(doc, *end) for end in ends if end not in entities]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64() if i == 0 else pa.string()) for i in range(3)], names=["doc_id", "topic", "name"])


def dangling_in(docs: DataFrame) -> DataFrame:
    """``dangling`` read off the texts, without a shuffle; ``docs``: doc_id, text, one row a document."""
    from ..workers import ship

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_dangler, "doc_id long, topic string, name string")
