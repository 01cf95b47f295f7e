"""The scalar library: Column functions for cleaning names, dates, money, keys and lists. No Python UDF here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Content types by extension, and where others go.
CONTENT_TYPES = {
    "pdf": "application/pdf",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "html": "text/html",
    "txt": "text/plain",
    "json": "application/json",
    "csv": "text/csv",
}
OTHER_TYPE = "application/octet-stream"
EXTENSIONS = (".pdf", ".docx")
SIDECAR_SUFFIX = ".metadata.json"


def stripped(x: Column) -> Column:
    """Without white space at either end, tabs, line ends and no-break spaces included."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def clean_text(x: Column) -> Column:
    """Stripped text; NULL if nothing is left, or ``nan`` in any case."""
    out = stripped(x)
    return F.when((out != "") & (F.lower(out) != "nan"), out)


def first_text(*columns: Column) -> Column:
    """The first of the columns that has text."""
    return F.coalesce(*[clean_text(c) for c in columns])


def first_truthy(*columns: Column) -> Column:
    """The first column that isn't empty as it stands, cleaned: blanks do stop the search."""
    return clean_text(F.coalesce(*[F.nullif(c, F.lit("")) for c in columns]))


def name_key(x: Column) -> Column:
    """What names are compared by: lower case, single blanks, ``&`` as ``and``, without a leading ``the``."""
    spaced = F.lower(F.trim(F.regexp_replace(F.replace(x, F.lit("&"), F.lit(" and ")), r"(?U)\s+", " ")))
    return F.regexp_replace(spaced, "^the ", "")


def is_test_name(x: Column) -> Column:
    """Whether a submitter's name ends in the word test or testing."""
    return F.coalesce(stripped(x).rlike("(?i)(?:^|[^a-z])test(?:ing)?$"), F.lit(False))


def has_extension(key: Column, extensions: tuple[str, ...] = EXTENSIONS) -> Column:
    out = F.lit(False)
    for e in extensions:
        out = out | F.lower(key).endswith(e)
    return out


def content_type(key: Column) -> Column:
    extension = F.lower(F.regexp_extract(key, r"\.([^./]+)$", 1))
    out = F.lit(None).cast("string")
    for e, kind in CONTENT_TYPES.items():
        out = F.when(extension == e, F.lit(kind)).otherwise(out)
    return F.coalesce(out, F.lit(OTHER_TYPE))


def sidecar_key(key: Column) -> Column:
    """The key of a document's label; NULL for an empty key or a key that is a label already."""
    return F.when((key != "") & ~is_sidecar(key), F.concat(key, F.lit(SIDECAR_SUFFIX)))


def is_sidecar(key: Column) -> Column:
    return key.endswith(SIDECAR_SUFFIX)


def is_document_key(key: Column) -> Column:
    return ~is_sidecar(key) & ~F.lower(key).endswith(".json")


def output_key(source: Column, key: Column) -> Column:
    return F.concat(source, F.lit("/"), key, F.lit(".json"))


def ledger_key(stage: Column, source: Column, key: Column, version: Column) -> Column:
    """The composite key of the ledger; NULL parts count as empty, so that no two keys run together."""
    return F.concat_ws("#", *[F.coalesce(c, F.lit("")) for c in (stage, source, key, version)])


def slug(x: Column) -> Column:
    """Lower case with single hyphens; ``cross-government`` if nothing is left."""
    out = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(out != "", out).otherwise(F.lit("cross-government"))


def partial_date(x: Column) -> Column:
    """YYYY, YYYYMM, YYYYMMDD, YYYY-MM or YYYY-MM-DD to a date; missing parts count 1; NULL if it isn't one."""
    t = stripped(x)
    digits = F.replace(t, F.lit("-"), F.lit(""))
    whole = F.when(t.rlike(r"^\d{4}$"), F.concat(digits, F.lit("0101"))).when(t.rlike(r"^\d{4}-?\d{2}$"), F.concat(digits, F.lit("01"))).when(t.rlike(r"^\d{4}(-?)\d{2}\1\d{2}$"), digits)
    return F.when(whole >= "1000", F.try_to_date(whole, "yyyyMMdd"))


def export_date(x: Column) -> Column:
    """A date of an export: ISO with a time, ``1 April 2025`` or ``30-Mar-26``; NULL before 1990 or if unreadable."""
    t = stripped(x)
    head = F.regexp_extract(t, "^[^T ]*", 0)
    long_form = F.when(t.rlike(r"^\d{1,2} [A-Za-z]+ \d{4}$"), F.try_to_date(F.initcap(t), "d MMMM yyyy"))
    year = F.regexp_extract(t, r"(\d{2})$", 1)
    # two-digit years from 69 are of the last century
    full = F.concat(F.initcap(F.regexp_extract(t, r"^(\d{1,2})-([A-Za-z]{3})-\d{2}$", 2)), F.lit(" "), F.regexp_extract(t, r"^(\d{1,2})-", 1), F.lit(" "), F.when(year >= "69", "19").otherwise("20"), year)
    short_form = F.when(t.rlike(r"^\d{1,2}-[A-Za-z]{3}-\d{2}$"), F.try_to_date(full, "MMM d yyyy"))
    out = F.coalesce(partial_date(head), long_form, short_form)
    return F.when(out >= F.lit("1990-01-01").cast("date"), out)


def named_date(name: Column) -> Column:
    """The date that a file's name states: eight digits at its start, or a month and a year (MMYYYY) after its last ``_``."""
    stem = F.regexp_replace(stripped(name), r"\.[A-Za-z0-9]{1,5}$", "")
    month = F.regexp_replace(F.regexp_extract(stem, r"_(\d{6})$", 1), r"^(\d{2})(\d{4})$", "$2$1")
    return F.coalesce(partial_date(F.regexp_extract(stem, r"^(\d{8})(?:\D|$)", 1)), partial_date(F.nullif(month, F.lit(""))))


def date_number(x: Column) -> Column:
    """A date as the whole number YYYYMMDD."""
    return F.date_format(x, "yyyyMMdd").cast("int")


def number_date(x: Column) -> Column:
    """A whole number YYYYMMDD as a date; NULL if it isn't one."""
    return F.when(x.between(10000101, 99991231), F.try_to_date(x.cast("string"), "yyyyMMdd"))


def file_names(cell: Column) -> Column:
    """The names in a comma list: pieces without an extension join the next until one has it; ordered, without repeats."""
    pieces = F.split(cell, ",")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"))

    def step(state, piece):
        joined = F.when(state["open"].isNull(), piece).otherwise(F.concat(state["open"], F.lit(","), piece))
        ends = stripped(piece).rlike(r"\.[A-Za-z0-9]{1,5}$")
        return F.struct(F.when(ends, F.concat(state["done"], F.array(joined))).otherwise(state["done"]).alias("done"), F.when(~ends, joined).alias("open"))

    merged = F.aggregate(pieces, start, step, lambda s: F.when(s["open"].isNull(), s["done"]).otherwise(F.concat(s["done"], F.array(s["open"]))))
    names = F.array_distinct(F.filter(F.transform(merged, stripped), lambda x: x != ""))
    return F.when(clean_text(cell).isNull(), F.array().cast("array<string>")).otherwise(names)


def plain_names(cell: Column) -> Column:
    """The pieces of a comma list, stripped, without empty ones; repeats stay."""
    return F.filter(F.transform(F.split(F.coalesce(cell, F.lit("")), ","), stripped), lambda x: x != "")


def parse_money(x: Column) -> Column:
    """Money text as whole pounds; NULL if it isn't a whole number."""
    return F.regexp_replace(x, '[£,"]', "").try_cast("bigint")


def format_money(x: Column) -> Column:
    return F.concat(F.lit("£"), F.format_number(F.floor(x), 0))


def iso_to_millis(x: Column) -> Column:
    """An ISO time as milliseconds; -1 if unreadable, and whole numbers as they are."""
    return F.coalesce(x.try_cast("bigint"), F.unix_millis(F.try_to_timestamp(x)), F.lit(-1).cast("bigint"))


def pipe_row(cells: Column) -> Column:
    """A table row in pipes; NULL if every cell is empty."""
    texts = F.transform(cells, lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "\n", " ")))
    return F.when(F.exists(texts, lambda c: c != ""), F.concat(F.lit("| "), F.array_join(texts, " | "), F.lit(" |")))


def started_by(arn: Column, prefix: str = "cli/", most: int = 128) -> Column:
    """Who started a task: the role's name up to its first hyphen if that has a dot, else whole; other signs become hyphens."""
    role = F.regexp_extract(arn, ":assumed-role/([^/]*)", 1)
    name = F.regexp_extract(F.when(F.contains(arn, F.lit(":assumed-role/")), role).otherwise(arn), "([^/]*)$", 1)
    first = F.regexp_extract(name, "^[^-]*", 0)
    who = F.when(F.contains(first, F.lit(".")), first).otherwise(name)
    return F.substring(F.concat(F.lit(prefix), F.regexp_replace(who, "[^A-Za-z0-9_-]", "-")), 1, most)


def clamp_wait(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(5)), F.lit(60))


def escaped_length(x: Column) -> Column:
    """Bytes of the text in JSON that escapes everything beyond ASCII: 6 a character, 12 beyond the basic plane."""
    wide = F.regexp_count(x, F.lit(r"[\x{10000}-\x{10FFFF}]"))
    other = F.regexp_count(x, F.lit(r"[\x{80}-\x{FFFF}]"))
    return F.char_length(x) - wide - other + 6 * other + 12 * wide
