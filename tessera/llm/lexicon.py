"""I-Match fingerprints: hashes of a document's terms within randomised lexicons, in DataFrame functions only.

The lexicon holds the terms whose document frequency lies in a band, ``LOW`` to ``HIGH`` of all documents: what is in nearly
every text says nothing of it, what is in nearly none is often a typing error. ``SUBSETS`` randomised lexicons are drawn
from it by seeded hashes of the terms. Each is nested: its half keeps every second term at random, its quarter every
fourth, and so on. From each a document takes the smallest of these subsets that still holds one of its terms, sorts its
distinct terms in it and hashes them; so a subset is as fine as the document is long, and an edit changes the hashes
of the subsets that it touches only. The fingerprint is these hashes in hexadecimal digits; likeness is the share of
equal ones.

Terms are runs of letters, marks and digits in lower case; signs of scripts without blanks are terms each. A document with
fewer than ``LEAST_TERMS`` terms in the band takes all its terms, one without terms its text as one.

Plan: documents are counted by term with map-side sums. A band that begins at a share of the documents holds at most
(terms a document) / ``LOW`` terms, however large the corpus; their hashes make a bitmap of 2 ** ``BITS`` bits, 128 kB,
which all tasks hold (another term passes for one of the lexicon where it hits a bit, alike in every document). No pair
of document and term is shuffled. ``edited`` gives each document the next one's beginning: order and lengths
are found on ids and hashes alone, and texts shuffle once, and their beginnings once.

Edge cases: a null text is an empty one; an empty text has the empty fingerprint, which is like an empty one (1) and
unlike any other (0). Rows equal in doc_id and text are one document in the order, and give a row each. Rows that
repeat a doc_id with other texts follow each other by a hash of the text; a null doc_id comes last. A document that is alone
is followed by itself. Other columns aren't read. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_path, numbered, stored, table

LOW = 0.002
HIGH = 0.05
SUBSETS = 24
LEAST_TERMS = 4
BITS = 20
#: Thai to Lao, Burmese, Khmer, kana, Han: scripts without blanks.
_SCRIPTS = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
TERM = rf"[\p{{L}}\p{{M}}\p{{N}}&&[^{_SCRIPTS}]]+|[{_SCRIPTS}]"


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def terms_of(text: Column) -> Column:
    """Hashes of the distinct terms; the text's own if it has none, nothing for an empty text."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)), lambda t: F.xxhash64(t)))
    own = F.when(text != "", F.array(F.xxhash64(text))).otherwise(F.array().cast("array<bigint>"))
    return _let(found, lambda terms: F.when(F.size(terms) > 0, terms).otherwise(own))


def lexicon(docs: DataFrame, *, low: float = LOW, high: float = HIGH) -> DataFrame:
    """term, df: the terms (hashes) of the texts of ``docs`` whose document frequency is in the band."""
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counted = texts.select(F.explode(terms_of(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    n = docs.count()
    return counted.where((F.col("df") >= low * n) & (F.col("df") <= high * n))


def bitmap(terms: DataFrame) -> DataFrame:
    """One row, ``bits``: an array of 2 ** BITS bits in which those of the terms are set."""
    words = terms.select((F.col("term").bitwiseAND((1 << BITS) - 1)).alias("bit")).groupBy(F.shiftright("bit", 6).alias("i")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit").bitwiseAND(63).cast("int"))).alias("word"))
    every = terms.sparkSession.range(1 << (BITS - 6)).select(F.col("id").alias("i"))
    full = every.join(words, "i", "left").select(F.struct("i", F.coalesce("word", F.lit(0).cast("bigint")).alias("word")).alias("w"))
    return full.agg(F.transform(F.array_sort(F.collect_list("w")), lambda w: w["word"]).alias("bits"))


def signatures(terms: Column, bits: Column, subsets: int = SUBSETS) -> Column:
    """An array of a 32-bit hash for each randomised lexicon; empty for no terms."""
    in_band = lambda all_: F.filter(all_, lambda t: F.call_function("getbit", F.get(bits, F.shiftright(t.bitwiseAND((1 << BITS) - 1), 6).cast("int")), t.bitwiseAND(63).cast("int")) == 1)
    # the bits at and below a number's highest: the smallest nested subset in which it is
    filled = lambda x: F.aggregate(F.array(*[F.lit(1 << i) for i in range(6)]), x, lambda y, s: y.bitwiseOR(F.call_function("shiftrightunsigned", y, s)))
    places = lambda chosen, seed: F.transform(chosen, lambda t: F.shiftrightunsigned(F.xxhash64(t, seed), 1))
    smallest = lambda hashes, edge: F.array_sort(F.filter(hashes, lambda h: h <= edge))
    one = lambda chosen, seed: _let(places(chosen, seed), lambda hashes: _let(filled(F.array_min(hashes)), lambda edge: F.xxhash64(smallest(hashes, edge)).bitwiseAND(0xFFFFFFFF)))
    every = lambda chosen: F.transform(F.sequence(F.lit(0), F.lit(subsets - 1)), lambda seed: one(chosen, seed))
    chosen = lambda all_: _let(in_band(all_), lambda band: F.when(F.size(band) >= LEAST_TERMS, band).otherwise(all_))
    return _let(terms, lambda all_: F.when(F.size(all_) > 0, _let(chosen(all_), every)).otherwise(F.array().cast("array<bigint>")))


def written(found: Column) -> Column:
    """The fingerprint as hexadecimal digits, eight a lexicon."""
    return F.concat_ws("", F.transform(found, lambda s: F.lpad(F.hex(s), 8, "0")))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal hashes; two empty fingerprints are alike."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda s: s)) / F.greatest(F.size(a), F.size(b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(F.coalesce(same, F.lit(0.0))).cast("double")


def with_fingerprints(rows: DataFrame, names: dict[str, str], bits: DataFrame, subsets: int = SUBSETS) -> DataFrame:
    """``rows`` with a column of hashes for each text column of ``names`` (text column to new column)."""
    for text, name in names.items():
        # a scalar subquery, which the optimiser puts where it is used: one value of a task, not a column that rows carry
        rows = rows.withColumn("__bits", bits.scalar()).withColumn(name, signatures(terms_of(F.col(text)), F.col("__bits"), subsets)).drop("__bits")
    return rows


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and ``h``, a hash of both."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(F.col("doc_id").cast("long"), text).alias("h"))


def sequence(rows: DataFrame) -> DataFrame:
    """Per distinct document its key, how many rows it has, the key of the next in descending order, and the key and length of the one before."""
    distinct = rows.select("doc_id", "h", F.length("text").alias("n_chars")).groupBy("doc_id", "h").agg(F.first("n_chars").alias("n_chars"), F.count("*").alias("copies"))
    placed, path = stored(numbered(distinct, [F.col("doc_id").desc_nulls_last(), F.col("h")]), "order")
    n = placed.count()
    near = lambda step, name: placed.select(F.pmod(F.col("place") + step, F.lit(max(n, 1))).alias("place"), F.struct("doc_id", "h", "n_chars").alias(name))
    out, _ = stored(placed.join(near(-1, "next"), "place").join(near(1, "before"), "place"), "sequence")
    drop_path(rows.sparkSession, path)
    return out.select("doc_id", "h", "copies", F.col("next.doc_id").alias("next_id"), F.col("next.h").alias("next_h"), F.col("before.doc_id").alias("before_id"), F.col("before.h").alias("before_h"), F.expr("before.n_chars DIV 3").alias("before_cut"))


def _one_of_each(rows: DataFrame, *key: str) -> DataFrame:
    """Of documents with several equal rows one; the others, nearly all, don't shuffle for it."""
    return rows.where("copies = 1").union(rows.where("copies > 1").dropDuplicates(list(key)))


def _on(a: str, b: str, c: str, d: str) -> Column:
    return (F.col(a) == F.col(b)) & F.col(c).eqNullSafe(F.col(d))


def edited(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) with ``edited``: the last third of the text replaced by as much of the next document's beginning.

    Also h, copies, and the next document's key, next_id and next_h.
    """
    rows = keyed(docs)
    order = sequence(rows).select(F.col("doc_id").alias("o_id"), F.col("h").alias("o_h"), "copies", "next_id", "next_h", "before_id", "before_h", "before_cut")
    placed = rows.join(order, _on("h", "o_h", "doc_id", "o_id"))
    heads = _one_of_each(placed.select("copies", "before_id", "before_h", F.substring(F.col("text"), F.lit(1), F.col("before_cut").cast("int")).alias("head")), "before_id", "before_h")
    kept = F.substring(F.col("text"), F.lit(1), F.length("text") - F.expr("CAST(length(text) DIV 3 AS INT)"))
    both = placed.drop("before_id", "before_h", "before_cut", "o_id", "o_h").join(heads.drop("copies"), _on("h", "before_h", "doc_id", "before_id"))
    return both.select("doc_id", "h", "copies", "next_id", "next_h", "text", F.concat(kept, F.col("head")).alias("edited"))


def fingerprints(docs: DataFrame, *, low: float = LOW, high: float = HIGH, subsets: int = SUBSETS) -> DataFrame:
    """doc_id, fingerprint of each row's text."""
    bits, _ = stored(bitmap(lexicon(docs, low=low, high=high)), "lexicon")
    return with_fingerprints(keyed(docs), {"text": "found"}, bits, subsets).select("doc_id", written(F.col("found")).alias("fingerprint"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    bits, _ = stored(bitmap(lexicon(docs)), "lexicon")
    found = with_fingerprints(edited(docs), {"text": "mine", "edited": "changed"}, bits)
    found = found.select("doc_id", "h", "copies", "next_id", "next_h", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "mine", "changed")
    found, _ = stored(found, "fingerprints")
    following = _one_of_each(found.select("copies", F.col("doc_id").alias("f_id"), F.col("h").alias("f_h"), F.col("mine").alias("theirs")), "f_id", "f_h").drop("copies")
    out = found.join(following, _on("next_h", "f_h", "next_id", "f_id"))
    return out.select("doc_id", "n_chars", "edited_sha256", written(F.col("mine")).alias("fingerprint"), written(F.col("changed")).alias("edited_fingerprint"), likeness(F.col("mine"), F.col("changed")).alias("near_edited"), likeness(F.col("mine"), F.col("theirs")).alias("near_next"))
