"""How documents are cut into chunks, as settings with checked ranges: by meaning, by size, or not at all."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks as K
from . import embedding as E


def _within(name: str, value, least: int, most: int | None = None) -> None:
    if not isinstance(value, int) or isinstance(value, bool) or value < least or (most is not None and value > most):
        raise ValueError(f"{name} must be a whole number from {least}" + (f" to {most}" if most is not None else "") + f", not {value!r}")


@dataclass(frozen=True)
class ByMeaning:
    """Cuts where neighbouring windows of sentences differ most; chunks over ``max_tokens`` words are cut again."""

    max_tokens: int = 512
    buffer_size: int = 1
    breakpoint_percentile_threshold: int = 91

    def __post_init__(self) -> None:
        _within("max_tokens", self.max_tokens, 1)
        _within("buffer_size", self.buffer_size, 0, 1)
        _within("breakpoint_percentile_threshold", self.breakpoint_percentile_threshold, 50, 99)

    def apply(self, docs: DataFrame) -> DataFrame:
        bare = docs.select("doc_id", "text", F.create_map().cast("map<string,string>").alias("metadata"), F.lit(None).cast("string").alias("source_id"))
        nodes = E.semantic_nodes(bare, buffer=self.buffer_size, percentile=self.breakpoint_percentile_threshold)
        cut = K.fixed_chunks(nodes.select(F.struct("doc_id", "chunk").alias("doc_id"), "text"), self.max_tokens, 0.0)
        return cut.select(F.col("doc_id.doc_id").alias("doc_id"), F.col("doc_id.chunk").alias("chunk"), F.col("chunk").cast("long").alias("part"), "text")


@dataclass(frozen=True)
class BySize:
    """Windows of ``max_tokens`` words, of which ``overlap_percentage`` are the last of the window before."""

    max_tokens: int = 300
    overlap_percentage: int = 20

    def __post_init__(self) -> None:
        _within("max_tokens", self.max_tokens, 1)
        _within("overlap_percentage", self.overlap_percentage, 1, 99)

    def apply(self, docs: DataFrame) -> DataFrame:
        cut = K.fixed_chunks(docs.select("doc_id", "text"), self.max_tokens, self.overlap_percentage / 100)
        return cut.select("doc_id", F.col("chunk").cast("long").alias("chunk"), F.lit(0).cast("long").alias("part"), "text")


@dataclass(frozen=True)
class Whole:
    """A document is one chunk; one without text has none."""

    def apply(self, docs: DataFrame) -> DataFrame:
        zero = F.lit(0).cast("long")
        return docs.where("text <> ''").select("doc_id", zero.alias("chunk"), zero.alias("part"), "text")


#: The names of the strategies.
STRATEGIES = {"SEMANTIC": ByMeaning, "FIXED_SIZE": BySize, "NONE": Whole}


def preset(settings: dict) -> ByMeaning | BySize | Whole:
    """The strategy that ``settings`` name, with its other entries as settings; unknown names and entries are errors."""
    kind = STRATEGIES.get(settings.get("strategy"))
    if kind is None:
        raise ValueError(f"no such strategy: {settings.get('strategy')!r}")
    given = {k: v for k, v in settings.items() if k != "strategy"}
    if unknown := set(given) - {f.name for f in fields(kind)}:
        raise ValueError(f"no settings of {settings['strategy']}: {', '.join(sorted(unknown))}")
    return kind(**given)


def cut_documents(docs: DataFrame, settings: dict) -> DataFrame:
    """(doc_id, chunk, part, text) of documents (doc_id, text) by a strategy."""
    return preset(settings).apply(docs)
