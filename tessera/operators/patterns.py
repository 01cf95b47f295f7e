"""Many LIKE patterns against many texts in one pass: an automaton of the patterns' longest fixed parts.

An automaton finds which fixed parts a text holds in time that depends on the text, not on the number of patterns; only
these patterns are then checked in full. Patterns come in blocks of bounded bytes, a broadcast and a pass each.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..store import stored
from .ordered import running

BLOCK_BYTES = 4_000_000
HELD_HITS = 100_000
TASK_ROWS = 1_000_000


def fixed_parts(pattern: str) -> list[str]:
    """What a text must hold, in order, to be LIKE the pattern; a backslash makes the next sign a plain one."""
    parts, open_ = [], ""
    signs = iter(pattern)
    for sign in signs:
        if sign in "%_":
            parts.append(open_)
            open_ = ""
        else:
            open_ += next(signs, sign) if sign == "\\" else sign
    return [p for p in [*parts, open_] if p]


def as_regex(pattern: str) -> re.Pattern:
    out, signs = "", iter(pattern)
    for sign in signs:
        out += {"%": ".*", "_": "."}.get(sign) or re.escape(next(signs, sign) if sign == "\\" else sign)
    return re.compile(out, re.DOTALL)


def _matcher(block):
    """Per text each name (its number) once that has a pattern the text is like. ``block``: (pattern, numbers of its names)."""

    def match(batches):
        import ahocorasick

        needles: dict[str, list[int]] = {}
        checks, always = {}, []
        owners = [names for _, names in block.value]
        for number, (pattern, _) in enumerate(block.value):
            parts = fixed_parts(pattern)
            longest = max(parts, key=len, default="")
            if longest:
                needles.setdefault(longest, []).append(number)
            else:
                always.append(number)
            if pattern != f"%{longest}%" or not longest:
                checks[number] = as_regex(pattern)
        automaton = ahocorasick.Automaton()
        for needle, numbers in needles.items():
            automaton.add_word(needle, numbers)
        if needles:
            automaton.make_automaton()

        def hits(keys, rows, found):
            return pa.RecordBatch.from_arrays([keys.take(pa.array(rows, pa.int64())), pa.array(found, pa.int64())], names=["key", "name_no"])

        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                if text is None:
                    continue
                seen = set(always)
                if needles:
                    for _, numbers in automaton.iter(text):
                        seen.update(numbers)
                mine: set[int] = set()
                for n in seen:
                    if not mine.issuperset(owners[n]) and (n not in checks or checks[n].fullmatch(text)):
                        mine.update(owners[n])
                rows += [i] * len(mine)
                found += mine
                if len(found) >= HELD_HITS:
                    yield hits(batch.column(0), rows, found)
                    rows, found = [], []
            yield hits(batch.column(0), rows, found)

    return match


def like_any(rows: DataFrame, key: str, text: str, patterns: DataFrame, name: str, pattern: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Distinct (``key``, ``name``) where the text is LIKE one of the name's patterns, as SQL's LIKE, case included.

    Null texts and patterns match nothing. A block holds ``block_bytes`` of pairs of name and pattern and one pair more; the
    texts are read once a block. Rows of equal keys count as one. A text's names are made distinct where they are found, so
    rows are those of the result, once for each block and row of the key; they go to tasks by key, ``TASK_ROWS`` a task on
    average, however many there are.
    """
    from ..workers import ship

    spark = rows.sparkSession
    ship(spark)
    pairs = patterns.where(F.col(pattern).isNotNull()).select(F.col(name).alias("name"), F.col(pattern).alias("pattern")).distinct()
    pairs, _ = stored(pairs.withColumn("name_no", F.xxhash64("name")), "pairs")
    sized = pairs.select("pattern", "name_no", (F.octet_length("pattern") + 16).cast("long").alias("bytes"), F.lit(0).alias("all"))
    numbered = running(sized, ["all"], ["pattern", "name_no"], "bytes", "upto").withColumn("block", F.floor((F.col("upto") - F.col("bytes")) / block_bytes))
    numbered, _ = stored(numbered.select("pattern", "block", "name_no"), "patterns")
    kind = rows.schema[key].dataType.simpleString()
    asked = rows.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text IS NOT NULL")
    hits = spark.createDataFrame([], f"key {kind}, name_no long")
    for (number,) in numbered.select("block").distinct().orderBy("block").collect():
        block = numbered.where(F.col("block") == number).groupBy("pattern").agg(F.collect_set("name_no").alias("names")).collect()
        sent = spark.sparkContext.broadcast([(r.pattern, r.names) for r in block])
        hits = hits.union(stored(asked.mapInArrow(_matcher(sent), f"key {kind}, name_no long"), "hits")[0])
        sent.unpersist()
    names = pairs.select("name", "name_no").distinct()
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-hits.count() // TASK_ROWS))
    # without the exchange first, each split of the small files would hold all that it unpacks to
    found = hits.repartition(width, "key", "name_no").dropDuplicates(["key", "name_no"])
    return found.join(names, "name_no").select(F.col("key").alias(key), F.col("name").alias(name))
