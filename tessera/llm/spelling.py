"""Spelling variants: words one edit apart, found by a rare-first q-gram prefix filter, and the form that each stands for.

All bigrams of all words are ordered by how many words have them, rarest first. One edit touches at most two bigrams of
a word, so of the three rarest of each of two words that are one edit apart at least one is common to both, at the
same place or one further in the longer word. Only these three are joined. The join's key also holds the word's length and one
half of its letters: what is one edit apart agrees before the edit or behind it, so on one of two halves. Candidates are
verified by edit distance. Both conditions hold for every pair that is asked for, so no pair is lost.

Plan: words are counted with map-side sums, texts don't shuffle. What follows is as large as the list of words: bigrams
are counted (as many rows as the alphabet's square), the three rarest of each word taken, and their keys, some 24 a word,
meet in a sort-merge join on a hash; hot keys are split by adaptive execution. A word has at most as many near words as
its length times twice the alphabet, so no group grows with the corpus. Forms are followed to the last by pointer
doubling; each step to a form multiplies the count by ``DOMINANCE``, so there are few.

Edge cases: a null or empty text has no words; a null doc_id is written as nothing before the colon of the hashed key.
Rows that repeat count again. Texts and words of any length are taken whole. Of near words with equal counts the smallest
in code-point order is the form. Other columns aren't read. Empty tables, or no word twice, give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_path, stored, table

RUN = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH = 7
MIN_COUNT = 2
DOMINANCE = 10
PREFIX = 3  # two bigrams for one edit, and one
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def runs(docs: DataFrame, *, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id and each run of letters in lower case (A-Z only), as often as it stands; shorter runs don't count."""
    found = F.regexp_extract_all(F.translate(F.col("text"), _UPPER, _UPPER.lower()), F.lit(RUN), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("run")).where(F.length("run") >= min_length)


def with_typos(words: DataFrame, *, every: int = 31) -> DataFrame:
    """``word``: the runs, of which one in ``every``, chosen by the crc32 of ``<doc_id>:<run>``, has lost a letter."""
    hashed = words.withColumn("h", F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary")))
    cut = F.expr("CAST(h % length(run) AS INT)")
    short = F.concat(F.substring("run", F.lit(1), cut), F.substring(F.col("run"), cut + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % every == 0, short).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, *, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: the distinct words that are long and frequent enough."""
    return words.where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def rarest(vocab: DataFrame, size: int = PREFIX) -> DataFrame:
    """word, n, letters, gram, p: each word's ``size`` rarest bigrams with their places, by (words that have it, bigram, place)."""
    letters = vocab.where(F.length("word") > 1).withColumn("letters", F.filter(F.split("word", ""), lambda c: c != ""))
    pairs = F.transform(F.slice("letters", F.lit(1), F.size("letters") - 1), lambda c, i: F.concat(c, F.get("letters", i + 1)))
    grams = letters.select("word", "n", F.posexplode(pairs).alias("p", "gram"))
    counts = grams.groupBy("gram").agg(F.count("*").alias("f"))
    least = grams.join(counts, "gram").groupBy("word", "n").agg(F.slice(F.array_sort(F.collect_list(F.struct("f", "gram", "p"))), 1, size).alias("least"))
    return least.select("word", "n", F.explode("least").alias("x")).select("word", "n", F.length("word").alias("size"), "x.gram", "x.p")


def _keys(entries: DataFrame, size: Column, skip: int, longer: bool) -> DataFrame:
    """key, word, n: entries under both halves of their word; without the letter in the middle if ``skip``.

    ``longer``: for a partner with one letter more, whose bigram stands at the same place, or one further behind the edit.
    """
    half = F.expr(f"CAST((length(word) - {skip}) DIV 2 AS INT)")
    left, right = F.substring(F.col("word"), F.lit(1), half), F.substring(F.col("word"), half + 1 + skip, F.length("word"))
    same, next_, both = F.array("p"), F.array(F.col("p") + 1), F.array(F.col("p"), F.col("p") + 1)
    # an edit behind the left half leaves its bigrams in place, one before the right half moves that half's
    before = F.when(F.col("p") + 1 < half, same).otherwise(both) if longer else same
    behind = F.when(F.col("p") >= half, next_).otherwise(both) if longer else same
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), left.alias("half"), before.alias("at")), F.struct(F.lit(1).alias("side"), right.alias("half"), behind.alias("at")))).alias("s")
    rows = entries.select("word", "n", "gram", size.alias("size"), sides).select("word", "n", "gram", "size", "s.side", "s.half", F.explode("s.at").alias("p"))
    return rows.select(F.xxhash64("gram", "p", "size", "side", "half").alias("key"), "word", "n")


def near_pairs(vocab: DataFrame) -> DataFrame:
    """u, u_n, w, w_n: every pair of words one edit apart, once."""
    entries, _ = stored(rarest(vocab), "bigrams")
    size = F.col("size")
    alike = _keys(entries, size, 0, False)
    named = lambda rows, name: rows.select("key", F.col("word").alias(name), F.col("n").alias(f"{name}_n"))
    one = F.levenshtein("u", "w", 1) == 1
    replaced = named(alike, "u").join(named(alike, "w"), "key").where((F.col("u") < F.col("w")) & one)
    inserted = named(_keys(entries, size + 1, 0, True), "u").join(named(_keys(entries, size, 1, False), "w"), "key").where(one)
    return replaced.union(inserted).groupBy("u", "w").agg(F.first("u_n").alias("u_n"), F.first("w_n").alias("w_n"))


def forms(vocab: DataFrame, *, dominance: int = DOMINANCE) -> DataFrame:
    """word, n, n_near, form, form_n: the most frequent near word, if ``dominance`` times as frequent."""
    pairs, _ = stored(near_pairs(vocab), "pairs")
    both = pairs.select(F.col("u").alias("word"), F.col("w").alias("near"), F.col("w_n").alias("near_n")).union(pairs.select("w", "u", "u_n"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("best"))
    rows = vocab.join(best, "word", "left")
    is_form = -F.col("best.k") >= dominance * F.col("n")
    return rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.k")).cast("long").alias("form_n"))


def roots(linked: DataFrame) -> DataFrame:
    """word, root for the words that have a form: the last of its forms."""
    found, path = stored(linked.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        on = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer, longer_path = stored(found.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        drop_path(linked.sparkSession, path)
        found, path = longer.select("word", "root"), longer_path
        if longer.where("moved").isEmpty():
            return found


def variants(vocab: DataFrame, *, dominance: int = DOMINANCE) -> DataFrame:
    """word, form, root, n, n_near, form_n of a list of words (word, n)."""
    linked, _ = stored(forms(vocab, dominance=dominance), "forms")
    return linked.join(roots(linked), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab, _ = stored(vocabulary(with_typos(runs(table(spark, sf_dir, "documents")))), "words")
    return variants(vocab)
