"""Secret scan: candidates from whole texts, and a random forest that removes false positives. DataFrame only.

A candidate is a run of at least ``MIN_LENGTH`` characters ``[A-Za-z0-9+/_=-]`` in a blank-delimited word that has a
digit, changes from lower to upper case inside, or has eight capitals in a row (shorter secrets aren't looked for: the
length is a parameter of the method). Every such run of a word is a candidate with a number of its own, as
minified JSON has many in one word. The word is then cut after each run and the signs that follow it, so that each run
has its own surrounding text, and the runs beside it are its neighbours. The run is the value; it is described by its length,
its shares of character kinds, its character transitions (kind to kind, and the mean log-odds of its pairs of
characters), its distinct characters, how much of it words of a small dictionary cover, signs of a path or address
around it, and the neighbouring words (the two before, the one after, and the rest of its own): their log-odds, words
that announce secrets or harmless numbers, assignment signs and quotes.

Both kinds of log-odds are learned from the labelled findings: of each pair of characters (letters by themselves,
capitals, digits and signs as one each: a table of 29 by 29), and of the ``NEIGHBOURS`` words that stand around most findings.

The forest (Spark ML, JVM) is trained from labelled findings: rows of (before2, before, word, after, label).
``example_findings`` makes a labelled set of fixed size from hashes of row numbers: tokens, keys and passwords in
contexts that announce them, against commit ids, checksums, UUIDs, card numbers, paths, identifiers and placeholders.
Its ``EXAMPLES`` rows are the documented bound of the fit, whatever the table's size.

Only texts with a digit, a change of case inside a word or eight capitals, and a long enough run, are cut into words at all; cutting and
describing stay in the row, and only candidates leave it. There is no shuffle, so no hot key.

Edge cases: null and empty texts have no candidate. Repeated rows and repeated candidates each give a row. A labelled
finding without a value is described by the longest run of its word, the first of equals. An empty table gives an empty
result. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

MIN_LENGTH = 16
EXAMPLES = 6000
TREES = 40
DEPTH = 8
SEED = 17
THRESHOLD = 0.5
_SIGN = "[A-Za-z0-9+/_=-]"
RUN = f"{_SIGN}{{{MIN_LENGTH},}}"
#: A whole run that has a digit, changes from lower to upper case or has eight capitals in a row; tried only where a run starts, so in linear time.
FOUND = f"(?<!{_SIGN})(?={_SIGN}*?(?:[0-9]|[a-z][A-Z]|[A-Z]{{8}})){RUN}"
NEIGHBOURS = 200
_KINDS = "abcdefghijklmnopqrstuvwxyzA0-"
DICTIONARY = "account address admin application backup build button cache change client cloud color column commit config connection container content controller count customer data database date default delete description document download element email enable error event example export factory field file filter folder format function global group handler header image import index input instance internal invalid item key label language layout length level library line list load local location log manager message method model module name network node number object option order output page parameter parent password path placeholder plugin point print process profile project property public query reader record register release remote report request response result return sample schema script search section secret select server service session setting source start state status storage store string style system table target template test text thread time title token type update upload user utils value variable version view width window worker write".split()
ANNOUNCE = "key|token|secret|passw|pwd|credential|auth|bearer|apikey|private|access|signature"
HARMLESS = "commit|sha|md5|checksum|digest|hash|etag|uuid|guid|isbn|card|serial|version|build|rev|revision|blob|tree|phone|invoice|order"
PLACEHOLDER = "x{6}|example|changeme|your|dummy|placeholder|0{8}|sample|redacted|1234567"
FEATURES = ("length", "digits", "upper", "lower", "signs", "changes", "vowel_changes", "distinct", "hex", "dictionary", "path", "address", "announced", "announced_far", "harmless", "assigned", "quoted", "placeholder", "groups", "only_digits", "pairs", "neighbours")


def candidates(docs: DataFrame) -> DataFrame:
    """Per candidate: doc_id, place (the word's number), run (its number in the word), before2, before, word, after, value."""
    text = F.col("text")
    likely = docs.where(text.rlike("[0-9]|[a-z][A-Z]|[A-Z]{8}") & text.rlike(RUN)).select(F.col("doc_id").cast("long").alias("doc_id"), F.split(text, r"\s+").alias("words"))
    near = lambda i: F.coalesce(F.get(F.col("words"), i), F.lit(""))
    one = lambda w, i: F.when((F.length(w) >= MIN_LENGTH) & w.rlike(FOUND), F.struct(i.cast("long").alias("place"), near(i - 2).alias("before2"), near(i - 1).alias("before"), w.alias("word"), near(i + 1).alias("after")))
    found = likely.select("doc_id", F.explode(F.filter(F.transform("words", one), lambda x: x.isNotNull())).alias("x")).select("doc_id", "x.*")
    # bound once per word: its runs, and the text around them
    cut = F.array(F.struct(F.regexp_extract_all("word", F.lit(FOUND), F.lit(0)).alias("runs"), F.split("word", FOUND, -1).alias("rest")))

    def piece(runs: Column, rest: Column, run: Column, k: Column) -> Column:
        behind = F.get(rest, k + 1)
        return F.struct(
            k.cast("long").alias("run"),
            F.when(k == 0, F.col("before2")).otherwise(F.col("before")).alias("before2"),
            F.when(k == 0, F.col("before")).otherwise(F.get(runs, k - 1)).alias("before"),
            F.concat(F.get(rest, k), run, F.when(k + 1 == F.size(runs), behind).otherwise(F.regexp_extract(behind, "^[^A-Za-z0-9]*", 0))).alias("word"),
            F.coalesce(F.get(runs, k + 1), F.col("after")).alias("after"),
            run.alias("value"),
        )

    pieces = F.flatten(F.transform(cut, lambda c: F.transform(c["runs"], lambda run, k: piece(c["runs"], c["rest"], run, k))))
    return found.select("doc_id", "place", F.explode(pieces).alias("x")).select("doc_id", "place", "x.*")


def value_of(word: Column) -> Column:
    """The longest run of a word, the first of equals."""
    runs = F.regexp_extract_all(word, F.lit(RUN), F.lit(0))
    return F.reduce(runs, F.lit(""), lambda best, x: F.when(F.length(x) > F.length(best), x).otherwise(best))


def _pairs(value: Column) -> Column:
    """The pairs of characters of a run as numbers from 1 to 29 * 29."""
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[A-Z]", "A"), "[0-9]", "0"), "[^A-Za-z0-9]", "-")
    codes = F.transform(F.filter(F.split(kinds, ""), lambda c: c != ""), lambda c: F.instr(F.lit(_KINDS), c))
    return F.transform(F.array(codes), lambda x: F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1), lambda a, b: (a - 1) * len(_KINDS) + b))[0]


def _neighbours() -> Column:
    """The distinct words around a value, in lower case."""
    around = F.concat_ws(" ", "before2", "before", F.replace(F.col("word"), F.col("value"), F.lit(" ")), "after")
    return F.array_distinct(F.filter(F.split(F.lower(around), "[^a-z]+"), lambda w: F.length(w) > 1))


@dataclass
class Odds:
    """Log-odds of a secret: by pair of characters, and by neighbouring word."""

    pairs: list[float]
    words: dict[str, float]


def learn_odds(findings: DataFrame, *, neighbours: int = NEIGHBOURS) -> Odds:
    """From labelled findings; at most 841 counts of pairs and ``neighbours`` of words reach the driver."""
    rows = findings.select("*") if "value" in findings.columns else findings.withColumn("value", value_of(F.col("word")))
    is_secret = F.col("label") == 1

    def counted(keys: Column) -> DataFrame:
        return rows.select(F.explode(keys).alias("key"), is_secret.alias("s")).groupBy("key").agg(F.count_if("s").alias("yes"), F.count_if(~F.col("s")).alias("no"))

    n = rows.agg(F.count_if(is_secret).alias("yes"), F.count_if(~is_secret).alias("no")).first()
    found = counted(_pairs(F.col("value"))).collect()
    yes, no = (sum(r[k] for r in found) + len(_KINDS) ** 2 for k in ("yes", "no"))
    pairs = [0.0] * len(_KINDS) ** 2
    for r in found:
        pairs[r["key"] - 1] = math.log((r["yes"] + 1) / yes) - math.log((r["no"] + 1) / no)
    top = counted(_neighbours()).orderBy(F.desc(F.col("yes") + F.col("no")), "key").limit(neighbours).collect()
    return Odds(pairs, {r["key"]: math.log((r["yes"] + 1) / (n["yes"] + 2)) - math.log((r["no"] + 1) / (n["no"] + 2)) for r in top})


def described(rows: DataFrame, odds: Odds) -> DataFrame:
    """The candidates with their value and features."""
    if "value" not in rows.columns:
        rows = rows.withColumn("value", value_of(F.col("word")))
    of_pair, of_word = F.array(*map(F.lit, odds.pairs)), [F.when(F.array_contains("__words", w), F.lit(x)).otherwise(0.0) for w, x in odds.words.items()]
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + x)
    rows = rows.withColumns({"__pairs": _pairs(F.col("value")), "__words": _neighbours()})
    value, n = F.col("value"), F.length("value")
    count = lambda pattern: F.regexp_count(value, F.lit(pattern))
    share = lambda pattern: count(pattern) / n
    near = F.lower(F.concat_ws(" ", "before", "word"))
    without = reduce(lambda x, w: F.replace(x, F.lit(w), F.lit("")), sorted(DICTIONARY, key=lambda w: (-len(w), w)), F.lower(value))
    flag = lambda c: c.cast("double")
    features = {
        "length": F.least(n, F.lit(200)).cast("double"),
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "lower": share("[a-z]"),
        "signs": share("[^A-Za-z0-9]"),
        "changes": (count("[0-9](?=[A-Za-z])") + count("[A-Za-z](?=[0-9])") + count("[a-z](?=[A-Z])") + count("[A-Z](?=[a-z])")) / n,
        "vowel_changes": (count("(?i)[aeiou](?=[b-df-hj-np-tv-z])") + count("(?i)[b-df-hj-np-tv-z](?=[aeiou])")) / n,
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / n,
        "hex": flag(value.rlike("^[0-9a-f]+$") | value.rlike("^[0-9A-F]+$")),
        "dictionary": 1 - F.length(without) / n,
        "path": F.regexp_count(F.col("word"), F.lit("[/\\\\]")) / F.length("word"),
        "address": flag(F.col("word").rlike("(?i)://|www\\.|@|\\.(com|org|net|html?|png|jpe?g|py|js|java|txt)\\b")),
        "announced": flag(near.rlike(ANNOUNCE)),
        "announced_far": flag(F.lower("before2").rlike(ANNOUNCE)),
        "harmless": flag(F.lower(F.concat_ws(" ", "before2", "before", F.regexp_extract("word", "^[^=:]*[=:]", 0))).rlike(HARMLESS)),
        "assigned": flag(F.col("before").rlike("[=:]$") | F.col("word").rlike("^[A-Za-z_.-]+[=:]")),
        "quoted": flag(F.col("word").rlike("[\"'`]")),
        "placeholder": flag(F.lower(value).rlike(PLACEHOLDER)),
        "groups": flag(value.rlike("^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-")),
        "only_digits": flag(value.rlike("^[0-9-]+$")),
        "pairs": total(F.transform("__pairs", lambda p: F.element_at(of_pair, p))) / F.greatest(F.size("__pairs"), F.lit(1)),
        "neighbours": total(F.array(F.lit(0.0), *of_word)),
    }
    return rows.withColumns({f"f_{k}": F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in features.items()}).drop("__pairs", "__words")


def example_findings(spark: SparkSession, rows: int = EXAMPLES) -> DataFrame:
    """Labelled findings from hashes of row numbers: before2, before, word, after, label."""
    n = F.col("id")
    pick = lambda salt, options: F.element_at(F.array(*[F.lit(o) if isinstance(o, str) else o for o in options]), (F.pmod(F.xxhash64(F.lit(salt), n), F.lit(len(options))) + 1).cast("int"))
    hexes = lambda salt, k: F.substring(F.sha2(F.concat_ws("-", F.lit(salt), n), 512), 1, k)
    mixed = lambda salt, k: F.substring(F.regexp_replace(F.base64(F.unhex(F.sha2(F.concat_ws("-", F.lit(salt), n), 512))), "[+/=\\s]", ""), 1, k)
    number = lambda salt, k: F.substring(F.concat(F.abs(F.xxhash64(F.lit(salt), n)).cast("string"), F.abs(F.xxhash64(F.lit(salt + "b"), n)).cast("string")), 1, k)
    words = lambda salt, k, sep: F.concat_ws(sep, *[pick(f"{salt}{i}", DICTIONARY) for i in range(k)])
    camel = lambda salt, k: F.concat(*[F.initcap(pick(f"{salt}{i}", DICTIONARY)) for i in range(k)])
    noise = pick("noise", ["the", "of", "and", "then", "value", "is", "with", "use", "for", ""])
    secret = pick("kind", [hexes("s", 40), hexes("s", 32), hexes("s", 64), mixed("s", 40), mixed("s", 32), F.concat(F.lit("AKIA"), F.upper(F.substring(mixed("k", 60), 1, 16))), F.concat(F.lit("ghp_"), mixed("g", 36)), F.concat(F.lit("sk-"), mixed("o", 48)), F.concat(F.lit("xoxb-"), number("x", 11), F.lit("-"), mixed("x", 24)), mixed("p", 20)])
    name = pick("name", ["token", "api_key", "apikey", "secret", "password", "access_key", "auth", "client_secret", "private_key", "passwd"])
    shape = F.pmod(F.xxhash64(F.lit("shape"), n), F.lit(4))
    quote = pick("quote", ['"', "'", "", '"'])
    quoted = F.concat(quote, secret, quote, pick("tail", ["", "", ",", ";", "."]))
    positive = F.when(shape == 0, F.struct(name.alias("before2"), F.lit("=").alias("before"), quoted.alias("word"))).when(shape == 1, F.struct(noise.alias("before2"), F.concat(name, F.lit(":")).alias("before"), quoted.alias("word"))).when(
        shape == 2, F.struct(noise.alias("before2"), noise.alias("before"), F.concat(name, F.lit("="), quoted).alias("word"))
    ).otherwise(F.struct(F.lit("Authorization:").alias("before2"), F.lit("Bearer").alias("before"), secret.alias("word")))
    uuid = F.concat_ws("-", hexes("u", 8), hexes("v", 4), hexes("w", 4), hexes("x", 4), hexes("y", 12))
    harmless = [
        (noise, F.lit("commit"), hexes("c", 40)), (F.lit("sha256"), F.lit(":"), hexes("d", 64)), (noise, F.lit("checksum"), hexes("e", 32)), (noise, F.lit("md5:"), hexes("m", 32)),
        (noise, pick("id", ["uuid", "id", "guid", "request"]), uuid), (noise, noise, number("n", 16)), (F.lit("card"), F.lit("number"), number("n", 16)), (noise, noise, F.concat(F.lit("/"), words("p", 4, "/"), F.lit("2"))),
        (noise, noise, F.concat(F.lit("https://www.example.org/"), words("q", 3, "-"), F.lit("-"), number("i", 3))), (noise, noise, F.concat(camel("i", 3), F.lit("2"))), (noise, noise, words("z", 4, "_")), (F.lit("token"), F.lit("="), F.lit('"xxxxxxxxxxxxxxxxxxxxxxxx0"')),
        (F.lit("password"), F.lit("="), F.concat(F.lit('"your_'), words("y", 2, "_"), F.lit('_here1"'))), (F.lit("key"), F.lit("="), words("k", 3, "_")), (noise, noise, F.concat(F.lit("v2024."), number("r", 14))), (noise, noise, number("l", 19)), (noise, F.lit("etag"), F.concat(F.lit('"'), hexes("t", 32), F.lit('"'))),
        (F.lit("api_key"), F.lit("="), F.lit('"EXAMPLEKEY1234567890"')),
    ]
    which = F.pmod(F.xxhash64(F.lit("which"), n), F.lit(len(harmless)))
    negative = F.element_at(F.array(*[F.struct(a.alias("before2"), b.alias("before"), c.alias("word")) for a, b, c in harmless]), (which + 1).cast("int"))
    made = spark.range(rows).withColumn("label", F.pmod(F.xxhash64(F.lit("label"), n), F.lit(2)).cast("double")).withColumn("x", F.when(F.col("label") == 1, positive).otherwise(negative))
    return made.select("x.before2", "x.before", "x.word", noise.alias("after"), "label").where(F.col("word").rlike(RUN))


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="features")


@dataclass
class SecretModel:
    forest: RandomForestClassificationModel
    odds: Odds

    def judge(self, rows: DataFrame) -> DataFrame:
        """Candidates or findings with what the forest says of them."""
        return self.forest.transform(_assembler().transform(described(rows, self.odds)))


def train(findings: DataFrame, *, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> SecretModel:
    """Log-odds and a forest from labelled findings."""
    odds = learn_odds(findings)
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed)
    return SecretModel(forest.fit(_assembler().transform(described(findings, odds)).select("features", "label")), odds)


def scan(docs: DataFrame, model: SecretModel, *, threshold: float = THRESHOLD) -> DataFrame:
    """Per candidate: doc_id, place, run, word (its part of it), value, score (0 to 1) and is_secret."""
    judged = model.judge(candidates(docs))
    score = vector_to_array("probability")[1]
    return judged.select("doc_id", "place", "run", "word", "value", score.alias("score"), (score >= threshold).alias("is_secret"))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), train(example_findings(spark)))
    return found.select("doc_id", "place", "run", F.length("value").cast("long").alias("length"), F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), F.round("score", 6).alias("score"), "is_secret")
