"""Retrieval modes as data, throttle presets, and exact vector search with metadata filters."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Preset:
    """What bounds a retrieval."""

    limit: int = 24
    workers: int | None = None
    top_k: int = 10
    contexts: int | None = None
    vectors_only: bool = False


#: Queries that are broadcast at once.
DEFAULT = Preset()
THROTTLED = Preset(limit=8, workers=1, top_k=3, contexts=1)
SUPER_THROTTLED = Preset(top_k=5, vectors_only=True)

#: Mode name to its filter: the document type (held within the field) and the field that the entity fills.
MODES: dict[str, tuple[str | None, tuple[str, ...]]] = {
    "metadata_filtered_business_case_department": ("business_case", ("department",)),
    "metadata_filtered_business_case_alb": ("business_case", ("alb",)),
    "metadata_filtered_sr_bids_department": ("sr_bids_2025", ("department_name",)),
    "metadata_filtered_sr_bids_alb": ("sr_bids_2025", ("alb",)),
    "metadata_filtered_contract_finder_department": ("contract_finder", ("department_name",)),
    "search_by_project": ("contract_finder", ("contract_name",)),
    "department_all_sources": (None, ("department", "department_name")),
    "business_case_all": ("business_case", ()),
    "sr_bids_all": ("sr_bids_2025", ()),
    "contract_finder_all": ("contract_finder", ()),
}
_HELD = {"document_type", "contract_name"}


def _matches(field: str, value: str) -> Column:
    return F.contains(F.col(field), F.lit(value)) if field in _HELD else F.col(field) == value


def mode_filter(mode: str | None, entity: str | None = None) -> tuple[Column | None, Preset]:
    """The filter and the preset of a mode. Case and outer blanks don't matter; unknown modes are the default, without a filter."""
    name, entity = (mode or "default").lower().strip(), (entity or "").strip()
    preset = DEFAULT
    for suffix, found in (("_super_throttled", SUPER_THROTTLED), ("_throttled", THROTTLED)):
        if name.endswith(suffix):
            name, preset = name.removesuffix(suffix), found
            break
    if name not in MODES:
        return None, preset
    kind, fields = MODES[name]
    if fields and not entity:
        raise ValueError(f"{name} needs an entity")
    out = None if kind is None else _matches("document_type", kind)
    if fields:
        by_entity = _matches(fields[0], entity)
        for field in fields[1:]:
            by_entity = by_entity | _matches(field, entity)
        out = by_entity if out is None else out & by_entity
    return out, preset


def apply_mode(passages: DataFrame, mode: str | None, entity: str | None = None) -> tuple[DataFrame, Preset]:
    keep, preset = mode_filter(mode, entity)
    return (passages if keep is None else passages.where(keep)), preset


def _doubles(x: Column) -> Column:
    return F.transform(x, lambda v: v.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in double precision; NULL where a vector has no length."""
    x, y = _doubles(a), _doubles(b)
    norms = F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))
    return F.when(norms > 0, dot(x, y) / norms)


def vector_topk(vectors: DataFrame, query: list[float], k: int = 10, where: Column | None = None) -> DataFrame:
    """The k passages nearest to a query vector: vec_id and score. Filters apply before ranking."""
    kept = vectors if where is None else vectors.where(where)
    asked = F.array(*[F.lit(float(x)) for x in query])
    scored = kept.select("vec_id", F.round(cosine(F.col("embedding"), asked), 6).alias("score"))
    return scored.where(F.col("score").isNotNull()).orderBy(F.desc("score"), "vec_id").limit(k)


def preset_for(mode: str, **changes) -> Preset:
    return replace(mode_filter(mode, "-")[1], **changes)


def ranked(rows: DataFrame, order: list[str], limit: int) -> DataFrame:
    """The first ``limit`` rows in a total order, with their rank from 1. Only these reach one task."""
    first = rows.orderBy(*order).limit(limit)
    return first.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))


def fused(branches: dict[str, DataFrame], limit: int, k: int = 60) -> DataFrame:
    """Reciprocal rank fusion: id, score, sources, of what several retrievers found (id, rank).

    A retriever that names an id more than once counts with its best rank. ``score`` is the sum of 1 / (``k`` + rank);
    ``sources`` names the retrievers that found it, sorted. The ``limit`` best, ties by id; null ids are left out.
    """
    each = [found.where("id IS NOT NULL").groupBy("id").agg(F.min("rank").alias("rank")).withColumn("source", F.lit(name)) for name, found in branches.items()]
    every = reduce(DataFrame.unionByName, each)
    # ranks are added in the order of their sources, so that the sum doesn't depend on the order of rows
    parts = F.sort_array(F.collect_list(F.struct("source", "rank")))
    out = every.groupBy("id").agg(parts.alias("p"))  # at most one entry a retriever
    score = F.aggregate("p", F.lit(0.0), lambda s, x: s + 1 / (F.lit(float(k)) + x["rank"]))
    return out.select("id", F.round(score, 9).alias("score"), F.array_join(F.transform("p", lambda x: x["source"]), ",").alias("sources")).orderBy(F.desc("score"), "id").limit(limit)


def composite(hits: DataFrame, statements: DataFrame, limit: int, each: int) -> DataFrame:
    """What three retrievers find for ranked hits, fused: statements of the hits' chunks, of the entities that the hits
    name, and of the context of these: other entities' statements about what the entities' own are about.

    ``hits``: chunk, entity, rank. ``statements``: id, chunk, s, o. At most ``each`` statements a retriever, in order of
    the hits' ranks (the context: of ids).
    """
    entities = hits.groupBy(F.col("entity").alias("s")).agg(F.min("rank").alias("hit"))
    chunks = hits.groupBy("chunk").agg(F.min("rank").alias("hit"))
    of_chunks = ranked(statements.join(chunks, "chunk").select("id", "hit"), ["hit", "id"], each)
    of_entities = ranked(statements.join(entities, "s").select("id", "o", "hit"), ["hit", "id"], each)
    about = of_entities.select("o").distinct()
    context = statements.join(about, "o", "left_semi").join(entities, "s", "left_anti").select("id").distinct()
    return fused({"chunk": of_chunks.select("id", "rank"), "entity": of_entities.select("id", "rank"), "context": ranked(context, ["id"], each)}, limit)
