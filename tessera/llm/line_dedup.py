"""Line dedup: suffix ranks over line-ID sequences by distributed prefix doubling, in DataFrame operations only.

A document is the sequence of its lines that aren't blank, trimmed of blanks. Lines that occur once in the whole
table can't be in a repeated run and drop out before anything else; the others get an ID by rank of their hash.

Doubling: the rank of a suffix's first ``2 ** (k + 1)`` lines is the rank of the pair (rank of its first ``2 ** k``,
rank of the ``2 ** k`` after them). Distinct pairs, counted before they shuffle, are range-sorted and numbered.
With all suffixes kept, the last level's ranks are the suffix array (``suffix_array``). For deletion, suffixes whose
prefix occurs once are resolved and leave, so a level holds only what repeats at that length, and the number of
levels is the logarithm of the longest repeated run.

Suffixes of equal rank are an interval of the suffix array with that common prefix; the interval of a common prefix
of any ``n`` lines is named by the ranks of its first and its last ``2 ** k`` lines. At each place the shortest runs that
count (``MIN_LINES`` lines, or fewer with ``MIN_WORDS`` words) from it and up to it name intervals, whose earliest
suffix (documents by id, then lines) is the first copy. Where the line before doesn't go on from the line before that copy, a maximal
repeated run begins; its length is the longest common prefix with the first copy, found by going down the levels
and comparing ranks. The lines of these runs are deleted; the first copy stays.

Scale: a row is a repeated line, not a text. Joins are by (document, line), whose keys are unique, or by rank, whose
hot values meet a written table with one row a rank, so that adaptive execution can split them. Minima and counts
combine before they shuffle. Windows run over the repeated lines of one document. Every level is written to the
shared folder.

Edge cases: a null text has no lines and stays null; blank lines always stay and don't separate a run. Rows equal in id and text
are one document. A row with a null id takes part like others and comes before them all (its id counts as the smallest long). Overlapping copies within a document keep the first. An empty table gives an empty result.
Columns other than doc_id and text pass through ``dedup_lines`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_path, stored, table

MIN_LINES = 3
MIN_WORDS = 8
MAX_LEVELS = 40


def _joined(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join by shuffle, whatever the files' size: rows of whole numbers pack so well that a few MB of Parquet, which Spark
    would collect in the driver and broadcast, unpack to a large part of its memory. Merges still split hot keys."""
    return left.join(right.hint("merge"), on, how)


def _unique(docs: DataFrame) -> DataFrame:
    """Without rows equal in id and text; those are only looked for by key."""
    keys = docs.select("doc_id", F.xxhash64("text").alias("h"))
    repeated = keys.groupBy("doc_id", "h").count().where("count > 1").limit(1).count()
    return docs.dropDuplicates(["doc_id", "text"]) if repeated else docs


def _id() -> Column:
    """The id; a null one is the smallest there is, so that its row takes part in the joins."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long"))


def _key() -> list[Column]:
    return [_id().alias("d"), F.xxhash64("text").alias("h")]


def repeated_lines(docs: DataFrame) -> DataFrame:
    """The lines that occur twice or more: document (d, h), place i among its lines, p with blank ones, words w, ID r."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x, p: F.struct(p.alias("p"), F.trim(x).alias("line"))), lambda x: x["line"] != "")
    rows = docs.where(F.col("text").isNotNull()).select(*_key(), F.posexplode(lines).alias("i", "x")).select("d", "h", "i", "x.p", "x.line")
    rows = rows.select("d", "h", "i", "p", F.xxhash64("line").alias("a"), F.hash("line").alias("b"), F.regexp_count("line", F.lit("[^ \t]+")).alias("w"))
    rows, path = stored(rows, "lines")
    ids, ids_path = stored(rows.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").orderBy("a", "b").select("a", "b", (F.monotonically_increasing_id() + 1).alias("r")), "line-ids")
    out, _ = stored(_joined(rows, ids, ["a", "b"]).select("d", "h", "i", "p", "w", "r"), "repeated")
    drop_path(docs.sparkSession, path)
    drop_path(docs.sparkSession, ids_path)
    return out


def levels(lines: DataFrame, drop_resolved: bool = True) -> list[DataFrame]:
    """Ranks of each level: level k has (d, h, i, r) for suffixes whose first ``2 ** k`` lines occur twice or more.

    Without ``drop_resolved`` all suffixes stay at every level, so that ranks compare all of them; a line that occurs
    once ends a suffix like the end of its document.
    """
    active = lines.select("d", "h", "i", "r")
    kept = [active]
    for k in range(MAX_LEVELS):
        step = 1 << k
        after = active.select("d", "h", (F.col("i") - step).alias("i"), F.col("r").alias("r2"))
        pairs = _joined(active, after, ["d", "h", "i"], "left").select("d", "h", "i", "r", F.coalesce("r2", F.lit(0).cast("long")).alias("r2"))
        pairs, pairs_path = stored(pairs, "pairs")
        ranks, ranks_path = stored(pairs.groupBy("r", "r2").agg(F.count("*").alias("n")).orderBy("r", "r2").select("r", "r2", "n", (F.monotonically_increasing_id() + 1).alias("rank")), "ranks")
        go_on = (F.col("n") > 1) & (F.col("r2") > 0)
        ranked, _ = stored(_joined(pairs, ranks, ["r", "r2"]).select("d", "h", "i", F.col("rank").alias("r"), go_on.alias("repeats")), "level")
        drop_path(lines.sparkSession, pairs_path)
        drop_path(lines.sparkSession, ranks_path)
        active = ranked.where("repeats").drop("repeats")
        if active.isEmpty() and drop_resolved:
            break
        kept.append(active if drop_resolved else ranked.drop("repeats"))
        if active.isEmpty():
            break
        active = kept[-1]
    return kept


def suffix_array(docs: DataFrame) -> DataFrame:
    """The suffixes that begin with a repeated line, in order: d, h, i and ``rank`` (equal suffixes share one)."""
    last = levels(repeated_lines(_unique(docs)), drop_resolved=False)[-1]
    return last.withColumnRenamed("r", "rank").orderBy("rank", "d", "h", "i")


def copies(lines: DataFrame, kept: list[DataFrame], min_lines: int, min_words: int) -> DataFrame:
    """Places (d, h, i) where a run that counts begins and occurs before, with its first copy ``q`` (d, h, i).

    Of each place the shortest runs that begin and that end there are looked up: every line of a longer run that
    counts is in one of these inside it. Of two that begin at a place the longer is kept.
    """
    by_doc = Window.partitionBy("d", "h").orderBy("i")
    begins = ends = F.lit(None).cast("int")
    for n in range(min_lines, 0, -1):
        for forward in (True, False):
            whole = (F.lead("i", n - 1).over(by_doc) == F.col("i") + n - 1) if forward else (F.lag("i", n - 1).over(by_doc) == F.col("i") - n + 1)
            words = F.sum("w").over(by_doc.rowsBetween(0, n - 1) if forward else by_doc.rowsBetween(1 - n, 0))
            counts = whole if n == min_lines else whole & (words >= min_words)
            if forward:
                begins = F.when(counts, n).otherwise(begins)
            else:
                ends = F.when(counts, n).otherwise(ends)
    shortest = lines.select("d", "h", "i", begins.alias("begins"), ends.alias("ends"))
    both = F.array(F.struct("i", F.col("begins").alias("n")), F.struct((F.col("i") - F.col("ends") + 1).alias("i"), F.col("ends").alias("n")))
    needs, needs_path = stored(shortest.select("d", "h", F.explode(both).alias("x")).select("d", "h", "x.i", "x.n").where(F.col("n").isNotNull()).distinct(), "needs")
    named = None
    for n in range(1, min_lines + 1):
        k = n.bit_length() - 1
        if k >= len(kept):
            break
        level = kept[k].select("d", "h", "i", "r")
        part = _joined(needs.where(F.col("n") == n), level, ["d", "h", "i"])
        if n == 1 << k:
            part = part.withColumn("r2", F.lit(0).cast("long"))
        else:
            part = _joined(part, level.select("d", "h", (F.col("i") - (n - (1 << k))).alias("i"), F.col("r").alias("r2")), ["d", "h", "i"])
        part = part.select("d", "h", "i", "n", "r", "r2")
        named = part if named is None else named.union(part)
    named, named_path = stored(named, "named")
    first, first_path = stored(named.groupBy("n", "r", "r2").agg(F.min(F.struct("d", "h", "i")).alias("q"), F.count("*").alias("c")).where("c > 1").drop("c"), "first")
    later = _joined(named, first, ["n", "r", "r2"]).where(F.struct("d", "h", "i") != F.col("q"))
    out, _ = stored(later.groupBy("d", "h", "i").agg(F.max(F.struct("n", "q")).alias("x")).select("d", "h", "i", "x.q"), "copies")
    for path in (needs_path, named_path, first_path):
        drop_path(lines.sparkSession, path)
    return out


def maximal_runs(lines: DataFrame, *, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """The maximal repeated runs that occur before: (d, h, i), the first copy q, and ``run`` lines."""
    kept = levels(lines)
    by_doc = Window.partitionBy("d", "h").orderBy("i")
    found = copies(lines, kept, min_lines, min_words)
    goes_on = (F.lag("i").over(by_doc) == F.col("i") - 1) & (F.lag("q").over(by_doc) == F.struct(F.col("q.d"), F.col("q.h"), F.col("q.i") - 1))
    starts = found.withColumn("goes_on", F.coalesce(goes_on, F.lit(False))).where("NOT goes_on").select("d", "h", "i", "q.d", "q.h", "q.i").toDF("d", "h", "i", "qd", "qh", "qi")
    run, path = stored(starts.withColumn("run", F.lit(0)), "runs")
    for k in reversed(range(len(kept))):
        mine = kept[k].select("d", "h", F.col("i").alias("at"), F.col("r").alias("mine"))
        theirs = kept[k].select(F.col("d").alias("qd"), F.col("h").alias("qh"), F.col("i").alias("q_at"), F.col("r").alias("theirs"))
        both = _joined(run.withColumn("at", F.col("i") + F.col("run")).withColumn("q_at", F.col("qi") + F.col("run")), mine, ["d", "h", "at"], "left")
        both = _joined(both, theirs, ["qd", "qh", "q_at"], "left")
        new, new_path = stored(both.select("d", "h", "i", "qd", "qh", "qi", (F.col("run") + F.when(F.col("mine") == F.col("theirs"), 1 << k).otherwise(0)).alias("run")), "runs")
        drop_path(lines.sparkSession, path)
        run, path = new, new_path
    return run


def deleted_places(docs: DataFrame, *, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """Per document (d, h) with deletions: ``places``, the positions of its deleted lines, blank ones counted."""
    lines = repeated_lines(docs)
    runs = maximal_runs(lines, min_lines=min_lines, min_words=min_words)
    places = runs.select("d", "h", F.explode(F.sequence(F.col("i"), F.col("i") + F.col("run") - 1)).alias("i"))
    # every line of a run is repeated, so its position is among these
    return _joined(places, lines.select("d", "h", "i", "p"), ["d", "h", "i"]).groupBy("d", "h").agg(F.collect_set("p").alias("places"))


def dedup_lines(docs: DataFrame, *, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the lines of later copies, and columns __lines and __deleted: how many there were and went."""
    docs = _unique(docs)
    found, _ = stored(deleted_places(docs, min_lines=min_lines, min_words=min_words), "places")
    found = found.toDF("__pd", "__ph", "__places")
    keyed = docs.withColumn("__d", _id()).withColumn("__h", F.xxhash64("text"))
    joined = _joined(keyed, found, (F.col("__d") == F.col("__pd")) & (F.col("__h") == F.col("__ph")), "left")
    lines = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__places"))
    # the lines are bound once, as the one element of an array; inside the inner function they are a value
    kept = F.transform(F.array(lines), lambda all_lines: F.array_join(F.transform(left, lambda p: F.get(all_lines, p)), "\n"))[0]
    total = F.size(F.filter(lines, lambda x: F.trim(x) != ""))
    return joined.select(
        *[F.when(F.col("__places").isNull(), F.col("text")).otherwise(kept).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.when(F.col("text").isNull(), 0).otherwise(total).cast("long").alias("__lines"),
        F.when(F.col("__places").isNull(), 0).otherwise(F.size("__places")).cast("long").alias("__deleted"),
    )


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.col("__lines").alias("n_lines"), F.col("__deleted").alias("n_deleted"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("kept_md5"))


OP2_SQL = f"""
WITH l AS (
  SELECT doc_id, p, trim(line) AS line FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS p
    FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL))
),
n AS (
  SELECT doc_id, p, line, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS i, len(regexp_extract_all(line, '[^ \t]+')) AS w
  FROM l WHERE line <> ''
),
x AS (
  SELECT *, lead(line, 1) OVER d AS line2, lead(line, 2) OVER d AS line3, w + lead(w, 1) OVER d AS w2
  FROM n WINDOW d AS (PARTITION BY doc_id ORDER BY i)
),
hits AS (
  SELECT doc_id, i AS a, i AS b FROM (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) AS k FROM x) WHERE k > 1 AND w >= {MIN_WORDS}
  UNION ALL
  SELECT doc_id, i, i + 1 FROM (SELECT *, row_number() OVER (PARTITION BY line, line2 ORDER BY doc_id, i) AS k FROM x WHERE line2 IS NOT NULL) WHERE k > 1 AND w2 >= {MIN_WORDS}
  UNION ALL
  SELECT doc_id, i, i + 2 FROM (SELECT *, row_number() OVER (PARTITION BY line, line2, line3 ORDER BY doc_id, i) AS k FROM x WHERE line3 IS NOT NULL) WHERE k > 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM hits),
original AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS p FROM documents WHERE text IS NOT NULL
),
kept AS (
  SELECT o.doc_id, md5(string_agg(o.line, chr(10) ORDER BY o.p)) AS m
  FROM original o LEFT JOIN n USING (doc_id, p) LEFT JOIN gone g ON g.doc_id = o.doc_id AND g.i = n.i
  WHERE g.i IS NULL GROUP BY o.doc_id
)
SELECT d.doc_id, coalesce(c.n_lines, 0) AS n_lines, coalesce(g.n_deleted, 0) AS n_deleted, coalesce(k.m, md5('')) AS kept_md5
FROM documents d
LEFT JOIN (SELECT doc_id, count(*) AS n_lines FROM n GROUP BY doc_id) c USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n_deleted FROM gone GROUP BY doc_id) g USING (doc_id)
LEFT JOIN kept k USING (doc_id)
"""
