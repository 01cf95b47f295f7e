"""Language identification with bit-sliced Bloom filters of character n-grams.

Each language's frequent n-grams go into a Bloom filter. The filters of all languages are one array of ``ROWS`` rows
with one bit a language, so one look-up of an n-gram (two rows, joined by AND) returns the set of all languages that
have it. A text's count for a language is the popcount of its bit over the text's n-grams; with ``f`` the share of
filled rows of that language, squared, as the rate of false positives, ``(count - n * f) / (1 - f)`` corrects it.
The largest corrected count decides; a tie goes to the most frequent language, then by name. The score is ``best / (best + second)``, so 0.5 is a tie.

Fitting: the n-grams of at most ``max_rows`` rows a language, chosen by a hash of their id over the whole table
(the documented bound of the labelled sample), are counted by executors, whole texts, and summed by Spark; the
``max_grams`` most frequent of each language that occur at least twice reach the driver, which builds the filter of
fixed size. Prediction is one map over the documents: no shuffle, one text in memory at a time.

An n-gram is four characters of the lower-cased text with runs of other characters than letters as one blank.

Edge cases: a null text or one without a letter is ``und`` with score 0. With letters but no known n-gram the most
frequent language of the sample is given with score 0. Without any labelled row everything is ``und``. Rows with a
null language don't teach. Repeated rows each get a row. Only doc_id, text and (to learn) lang are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import crc32_of_id, table

GRAM = 4
ROWS = 1 << 20
MAX_ROWS = 3000
MAX_GRAMS = 20_000
UNDETERMINED = "und"
_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def grams_of(text: str) -> np.ndarray:
    """A 64-bit code of each n-gram; empty if there is no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letter_table()[codes]
    if not letter.any():
        return np.zeros(0, np.uint64)
    codes = np.where(letter, codes, 32)
    keep = np.ones(len(codes), bool)
    keep[1:] = letter[1:] | letter[:-1]
    codes = np.concatenate(([32], codes[keep][0 if letter[0] else 1 :], [32] if letter[-1] else [])).astype(np.uint64)
    while len(codes) < GRAM:
        codes = np.append(codes, np.uint64(32))
    out = np.zeros(len(codes) - GRAM + 1, np.uint64)
    for i in range(GRAM):
        out = out << np.uint64(16) ^ codes[i : i + len(out)]
    out = (out ^ out >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    return out ^ out >> np.uint64(29)


def _rows(grams: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    one = (grams >> np.uint64(32)).astype(np.int64) % rows
    two = (grams & np.uint64(0xFFFFFFFF)).astype(np.int64) % rows
    return one, two


class LanguageFilter:
    """The bit-sliced filters: row by row, a bit for each language."""

    def __init__(self, grams: dict[str, np.ndarray], rows: int = ROWS, default: str = UNDETERMINED) -> None:
        self.languages = sorted(grams)
        self.default, self.rows = default, rows
        width = max(1, -(-len(self.languages) // 64))
        self.bits = np.zeros((width, rows), np.uint64)
        for i, language in enumerate(self.languages):
            for row in _rows(grams[language], rows):
                self.bits[i // 64, row] |= np.uint64(1) << np.uint64(i % 64)
        self.false_rate = np.array([(float(((self.bits[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean())) ** 2 for i in range(len(self.languages))])

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """The language, the score, and the share of n-grams that the language has."""
        grams = grams_of(text) if text else ()
        if not len(grams) or not self.languages:
            return UNDETERMINED, 0.0, 0.0
        one, two = _rows(grams, self.rows)
        counts = np.zeros(len(self.languages))
        for w in range(len(self.bits)):
            masks = self.bits[w][one] & self.bits[w][two]
            for i in range(64 * w, min(64 * w + 64, len(self.languages))):
                counts[i] = np.count_nonzero(masks & (np.uint64(1) << np.uint64(i % 64)))
        counts = np.maximum(0, (counts - len(grams) * self.false_rate) / np.maximum(1e-9, 1 - self.false_rate))
        best = int(np.argmax(counts))
        if self.default in self.languages and counts[self.languages.index(self.default)] == counts[best]:
            best = self.languages.index(self.default)
        if counts[best] <= 0:
            return self.default, 0.0, 0.0
        second = float(np.partition(counts, -2)[-2]) if len(counts) > 1 else 0.0
        return self.languages[best], float(counts[best] / (counts[best] + second)), min(1.0, float(counts[best] / len(grams)))


def _counter(batches):
    for batch in batches:
        found: dict[str, list[np.ndarray]] = {}
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found.setdefault(lang, []).append(grams_of(text))
        for lang, grams in found.items():
            values, counts = np.unique(np.concatenate(grams), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(values), pa.string()), pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], names=["lang", "gram", "n"])


def fit(rows: DataFrame, *, max_rows: int = MAX_ROWS, max_grams: int = MAX_GRAMS) -> LanguageFilter:
    """A filter from (doc_id, text, lang); at most about ``max_rows`` rows a language, chosen by hash."""
    labelled = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return LanguageFilter({})
    share = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, max_rows / n)))])
    draw = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = labelled.where(draw < F.element_at(share, F.col("lang")))
    counted = sample.select("text", "lang").mapInArrow(_counter, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).where("n > 1")
    top = counted.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("k") <= max_grams)
    grams: dict[str, list[int]] = {}
    for row in top.select("lang", "gram").collect():
        grams.setdefault(row["lang"], []).append(row["gram"])
    default = min(sizes, key=lambda x: (-sizes[x], x))
    return LanguageFilter({lang: np.array(grams.get(lang, []), np.int64).view(np.uint64) for lang in sizes}, default=default)


def _judge(shared):
    def judge(batches):
        model = shared.value
        for batch in batches:
            rows = [model.judge(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score", "coverage"],
            )

    return judge


def identify(docs: DataFrame, model: LanguageFilter, held_out=None) -> DataFrame:
    """Per document row: doc_id, held_out, lang_pred, score, coverage."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.lit(False) if held_out is None else held_out).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_judge(shared), "doc_id long, held_out boolean, lang_pred string, score double, coverage double")


def keep_identified(docs: DataFrame, model: LanguageFilter, *, least_coverage: float = 0.2) -> DataFrame:
    """``docs`` without the rows that are ``und`` or have under ``least_coverage`` of n-grams in any learned language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        filters = shared.value
        for batch in batches:
            found = [filters.judge(text) for text in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            yield batch.filter(pa.array([lang != UNDETERMINED and share >= least_coverage for lang, _, share in found], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def fold() -> tuple:
    """Whether a row is held out, and whether it may teach."""
    part = F.pmod(crc32_of_id(), F.lit(3))
    return F.coalesce(part == 1, F.lit(False)), F.coalesce(part != 1, F.lit(False))


def fitted(docs: DataFrame) -> LanguageFilter:
    return fit(docs.where(fold()[1]).select("doc_id", "text", "lang"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fitted(docs), fold()[0])
