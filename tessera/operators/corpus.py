"""Corpus operators: listing, enrichment, the ledger, merges with the last row winning, and the reconciliation plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..store import numbered, stored


# -- listing and latest files ------------------------------------------------


def list_documents(keys: DataFrame, prefix: str = "", extensions: tuple[str, ...] = S.EXTENSIONS) -> DataFrame:
    """The references under a prefix with a wanted extension: key, content_type, version."""
    wanted = keys.where(F.col("key").startswith(prefix) & S.has_extension(F.col("key"), extensions))
    return wanted.select("key", S.content_type(F.col("key")).alias("content_type"), F.coalesce("version", F.lit("")).alias("version"))


def latest_file(files: DataFrame, prefix: str, extension: str | None = ".csv") -> DataFrame:
    """The newest file under a prefix, the last key among equals; one row, or an error where there is none."""
    under = files.where(F.col("key").startswith(prefix))
    if extension:
        under = under.where(F.lower("key").endswith(extension))
    newest = under.agg(F.max_by("key", F.struct("modified", "key")).alias("key"))
    return newest.select(F.coalesce("key", F.raise_error(F.lit(f"no file under {prefix}")).cast("string")).alias("key"))


# -- enrichment and filters --------------------------------------------------


def enrich(refs: DataFrame, metadata: DataFrame) -> DataFrame:
    """Each reference with its metadata map, empty where there is none. ``metadata``: key, metadata."""
    return refs.join(metadata, "key", "left").withColumn("metadata", F.coalesce("metadata", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))))


def filter_departments(refs: DataFrame, metadata: DataFrame, departments: list[str]) -> DataFrame:
    """References whose metadata names one of the departments exactly; none for an empty list."""
    return refs.join(metadata.where(F.col("department").isin(departments)).select("key"), "key", "left_semi")


def ledger_pending(refs: DataFrame, ledger: DataFrame, stage: str, source: str) -> DataFrame:
    """References that the ledger doesn't hold in this version, stage and source."""
    keyed = refs.withColumn("document_key", S.ledger_key(F.lit(stage), F.lit(source), F.col("key"), F.col("version")))
    return keyed.join(ledger.select("document_key"), "document_key", "left_anti")


def ledger_upsert(ledger: DataFrame, new: DataFrame) -> DataFrame:
    """The ledger after marking: one row a key, a new row in place of an old one."""
    both = ledger.withColumn("new", F.lit(0)).unionByName(new.withColumn("new", F.lit(1)))
    rows = F.struct("new", "processed_at", *[c for c in ledger.columns if c not in ("document_key", "processed_at")])
    last = both.groupBy("document_key").agg(F.max(rows).alias("r"))
    return last.select(*[F.col("document_key") if c == "document_key" else F.col(f"r.{c}").alias(c) for c in ledger.columns])


def merge_metadata(historic: DataFrame, export: DataFrame, order: str = "ord") -> DataFrame:
    """Whole records by key: an export record beats a historic one, and within each the last row wins."""
    columns = [c for c in historic.columns if c not in ("key", order)]
    both = historic.withColumn("rank", F.lit(0)).unionByName(export.withColumn("rank", F.lit(1)))
    last = both.groupBy("key").agg(F.max_by(F.struct(*columns), F.struct("rank", order)).alias("r"))
    return last.select("key", "r.*")


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key: the values of its last row, at the position of its first."""
    values = [c for c in rows.columns if c not in (key, order)]
    out = rows.groupBy(key).agg(F.max_by(F.struct(*values), order).alias("r"), F.min(order).alias(order))
    return out.select(key, "r.*", order)


def batches(rows: DataFrame, size: int, order: list[str]) -> DataFrame:
    """Rows with their batch of ``size``, from 1, in order."""
    return numbered(rows, order, "__place").withColumn("batch", (F.floor(F.col("__place") / size) + 1).cast("long")).drop("__place")


def is_latest(rows: DataFrame, group: str, date: str, tie: str) -> DataFrame:
    """Whether a row is the newest of its group."""
    newest = rows.groupBy(group).agg(F.max(F.struct(date, tie)).alias("newest"))
    marked = rows.join(newest, rows[group].eqNullSafe(newest[group])).drop(newest[group])
    return marked.withColumn("is_latest", F.struct(date, tie).eqNullSafe(F.col("newest"))).drop("newest")


#: How the names of letters and of reports begin, and the kinds of document that they are.
LETTER, REPORT = "Letter to ", "llm_dbr_report_"
LETTER_KIND, REPORT_KIND = "dbr_readout", "dbr_report"


def named_documents(keys: DataFrame, key: str) -> DataFrame:
    """``keys`` with what their file names state: department, date, document_type, and is_latest in department and type.

    ``20260901 Letter to X - ...`` and ``llm_dbr_report_x_062026``. Other names state nothing and are never the latest; nor
    are names without a date. Of several of one date the greatest key is the latest. Departments compare by name key.
    """
    name = F.regexp_extract(key, r"([^/]*)$", 1)
    stem = F.regexp_replace(name, r"\.[A-Za-z0-9]{1,5}$", "")
    to = F.nullif(S.stripped(F.regexp_extract(stem, f"^\\d{{8}} {LETTER}(.+?) - ", 1)), F.lit(""))
    of = F.nullif(S.stripped(F.replace(F.regexp_extract(stem, f"^{REPORT}(.+)_[^_]*$", 1), F.lit("_"), F.lit(" "))), F.lit(""))
    kind = F.when(to.isNotNull(), LETTER_KIND).when(of.isNotNull(), REPORT_KIND)
    rows = keys.withColumns({"department": F.coalesce(to, of), "date": S.named_date(name), "document_type": kind})
    rows = rows.withColumn("__group", F.concat_ws("#", "document_type", S.name_key(F.col("department"))))
    dated = F.col("date").isNotNull() & F.col("document_type").isNotNull()
    marked = is_latest(rows.withColumn("__date", F.when(dated, F.col("date"))), "__group", "__date", key)
    return marked.withColumn("is_latest", F.col("is_latest") & dated).drop("__group", "__date")


# -- organisations -----------------------------------------------------------


def resolve_org(rows: DataFrame, bodies: DataFrame, departments: DataFrame, raw: str) -> DataFrame:
    """``department`` and ``alb`` of a submitter by name key: a known body has both, a department itself, others stand raw.

    ``bodies``: alb, parent. ``departments``: department. Both have one row a name key.
    """
    bodies = bodies.select(S.name_key(F.col("alb")).alias("__ka"), F.col("alb").alias("__alb"), F.col("parent").alias("__parent"))
    departments = departments.select(S.name_key(F.col("department")).alias("__kd"), F.col("department").alias("__dept"))
    text = S.clean_text(F.col(raw))
    keyed = rows.withColumn("__k", S.name_key(text))
    joined = keyed.join(bodies, F.col("__k") == F.col("__ka"), "left").join(departments, F.col("__k") == F.col("__kd"), "left")
    known = F.col("__ka").isNotNull() | F.col("__kd").isNotNull()
    return joined.select(
        *rows.columns,
        F.coalesce("__parent", "__dept", text).alias("department"),
        F.col("__alb").alias("alb"),
        F.when(text.isNotNull() & ~known, text).alias("unrecognised"),
    )


def unmatched(names: DataFrame, known: DataFrame, name: str = "name", order: str = "ord") -> DataFrame:
    """Requested names that no known name matches by key, as they were written."""
    keys = known.select(S.name_key(F.col(name)).alias("__k"))
    return names.withColumn("__k", S.name_key(F.col(name))).join(keys, "__k", "left_anti").drop("__k")


# -- the reconciliation plan -------------------------------------------------


def read_rows(export: DataFrame, bodies: DataFrame, departments: DataFrame) -> DataFrame:
    """Export rows with names, date, department and the flags that the plan counts.

    ``export``: row_no, spend_id, submitter, date1, date2, files, case_name.
    """
    raw_date = S.first_text(F.col("date1"), F.col("date2"))
    rows = resolve_org(export, bodies, departments, "submitter")
    rows = rows.withColumns({"names": S.file_names(F.col("files")), "raw_date": raw_date, "is_test": S.is_test_name(F.col("submitter"))})
    rows = rows.withColumn("date", S.export_date(F.col("raw_date")))
    return rows.withColumn("unreadable_date", F.when(F.col("raw_date").isNotNull() & F.col("date").isNull(), F.col("raw_date")))


def row_to_sidecars(rows: DataFrame) -> DataFrame:
    """A row for each file of each row, in order: name, place (row, file) and its label's fields."""
    return rows.where("NOT is_test").select("row_no", F.posexplode("names").alias("file_no", "name"), S.clean_text(F.col("spend_id")).alias("spend_id"), "department", "alb", "date", S.clean_text(F.col("case_name")).alias("project_name"))


def listed(rows: DataFrame) -> DataFrame:
    """One row a file name: the last label, at the place of the first."""
    placed = row_to_sidecars(rows).select("name", F.struct("row_no", "file_no").alias("ord"), "spend_id", "department", "alb", "date", "project_name")
    return last_wins(placed, "name", "ord")


def choose_documents(files: DataFrame, limit: int | None = None, departments: list[str] | None = None) -> DataFrame:
    """The files to label: those of the departments (all if None), newest first, dateless last, then by spend id and place."""
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1")
    out = files
    if departments is not None:
        keys = [S.name_key(F.lit(d)) for d in departments]
        out = out.where(F.coalesce(S.name_key(F.col("department")).isin(*keys), F.lit(False)) if keys else F.lit(False))
    if limit is None:
        return out
    return out.orderBy(F.col("date").isNull(), F.col("date").desc(), F.coalesce("spend_id", F.lit("")), "ord").limit(limit)


def label_plan(chosen: DataFrame, keys: DataFrame, prefix: str = "files/") -> DataFrame:
    """Each chosen file with what is to be done: ``missing`` from the bucket, ``replace`` its label, or ``new``."""
    documents = keys.where(S.is_document_key(F.col("key"))).select(F.col("key").alias("document"))
    labels = keys.where(S.is_sidecar(F.col("key"))).select(F.col("key").alias("label"))
    keyed = chosen.withColumn("document_key", F.concat(F.lit(prefix), F.col("name"))).withColumn("label_key", F.concat(F.col("document_key"), F.lit(S.SIDECAR_SUFFIX)))
    joined = keyed.join(documents, F.col("document_key") == F.col("document"), "left").join(labels, F.col("label_key") == F.col("label"), "left")
    action = F.when(F.col("document").isNull(), "missing").when(F.col("label").isNotNull(), "replace").otherwise("new")
    return joined.withColumn("action", action).drop("document", "label")


def bucket_not_listed(keys: DataFrame, files: DataFrame, prefix: str = "files/") -> DataFrame:
    """Documents of the bucket that no row lists, chosen or not."""
    documents = keys.where(S.is_document_key(F.col("key")) & F.col("key").startswith(prefix))
    return documents.select("key").join(files.select(F.concat(F.lit(prefix), F.col("name")).alias("key")), "key", "left_anti")


def plan_summary(export: DataFrame, keys: DataFrame, bodies: DataFrame, departments: DataFrame, *, limit: int | None = None, only: list[str] | None = None) -> DataFrame:
    """The dry run as one row of counts. Test rows are counted and then left out of everything else."""
    rows = read_rows(export, bodies, departments)
    real = ~F.col("is_test")
    has_files = F.size("names") > 0
    counts = rows.agg(
        F.count("*").alias("rows_read"),
        F.count_if(F.col("is_test")).alias("test_rows"),
        F.count_if(real & ~has_files).alias("rows_without_files"),
        F.count_if(real & has_files & F.col("unreadable_date").isNotNull()).alias("unreadable_dates"),
        F.count_if(real & F.col("unrecognised").isNotNull()).alias("unrecognised_rows"),
    )
    files = listed(rows)
    of_files = files.agg(F.count("*").alias("listed"), F.count_if(F.col("date").isNull()).alias("listed_without_date"))
    planned = label_plan(choose_documents(files, limit, only), keys)
    of_plan = planned.agg(*[F.count_if(F.col("action") == a).alias(f"to_{a}") for a in ("missing", "replace", "new")], F.count("*").alias("chosen"))
    rest = bucket_not_listed(keys, files).agg(F.count("*").alias("bucket_not_listed"))
    # four one-row frames side by side
    one = F.lit(1).alias("__one")
    out = counts.select("*", one)
    for part in (of_files, of_plan, rest):
        out = out.join(part.select("*", one), "__one")
    return out.drop("__one")


def top_values(rows: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """The most frequent values, by count, then name."""
    out = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)
    return out if n is None else out.limit(n)


# -- extraction --------------------------------------------------------------


def extraction_summary(status: DataFrame) -> DataFrame:
    """total, filtered_out, skipped, processed and failed; the first is the sum of the others. ``failed_keys`` has the keys."""
    one = lambda s: F.count_if(F.col("status") == s).alias(s)
    return status.agg(F.count("*").alias("total"), *[one(s) for s in ("filtered_out", "skipped", "processed", "failed")])


def failed_keys(status: DataFrame, key: str = "key") -> DataFrame:
    """The keys that failed, one a row, as their number is bound by nothing."""
    return status.where("status = 'failed'").select(key)


#: What a document's metadata says of its way through the pipeline, which models don't see.
BOOKKEEPING = ("key", "source_name", "content_type", "version", "extracted_at", "code_version")


def to_documents(outputs: DataFrame) -> DataFrame:
    """Stage outputs as documents: doc_id, text, metadata (theirs under the bookkeeping), and what models see of it."""
    books = F.map_from_arrays(F.array(*map(F.lit, BOOKKEEPING)), F.array(*[F.col(c).cast("string") for c in BOOKKEEPING]))
    kept = F.map_filter(F.coalesce("metadata", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))), lambda k, _: ~k.isin(*BOOKKEEPING))
    return outputs.select(F.col("key").alias("doc_id"), "text", F.map_concat(kept, books).alias("metadata"), kept.alias("visible"))


def filtered(refs: DataFrame, *filters) -> DataFrame:
    """References through filters in order, each a function of references; none leaves them as they are."""
    for one in filters:
        refs = refs.transform(one)
    return refs


def folder_metadata(keys: DataFrame, bodies: DataFrame, prefix: str) -> DataFrame:
    """key, department, alb and project by the folder below ``prefix``. ``bodies``: alb, parent."""
    parts = F.split(F.when(F.col("key").startswith(prefix), F.substring("key", len(prefix) + 1, 1 << 30)).otherwise(F.col("key")), "/")
    rows = keys.select("key", parts.alias("parts")).where(F.size("parts") >= 2)
    rows = rows.select("key", F.nullif(F.col("parts")[0], F.lit("")).alias("folder"), F.nullif(F.regexp_replace(F.element_at("parts", -1), r"\.[^.]*$", ""), F.lit("")).alias("project"))
    joined = rows.join(bodies, F.col("folder") == F.col("alb"), "left")
    return joined.select("key", F.coalesce("parent", "folder").alias("department"), "alb", "project")


def load_metadata(strategy: str | None, *, historic: DataFrame | None = None, export: DataFrame | None = None, keys: DataFrame | None = None, bodies: DataFrame | None = None, prefix: str = "") -> DataFrame | None:
    """The metadata of a source by its strategy, None for a source that has none.

    ``export``: an export over historic records; ``historic``: these alone, the last row of a key winning; ``folder``: by
    the folders of the documents' keys, which must be given.
    """
    if strategy == "export":
        return merge_metadata(historic, export)
    if strategy == "historic":
        return merge_metadata(historic, historic.limit(0))
    if strategy == "folder":
        if keys is None:
            raise ValueError("the folder strategy needs the documents' keys")
        return folder_metadata(keys, bodies, prefix)
    return None


def visible_metadata(metadata: Column, bookkeeping: Column, hidden: list[str]) -> Column:
    """Domain metadata overlaid by bookkeeping, as a model sees it: without the bookkeeping keys."""
    kept = F.map_filter(metadata, lambda k, _: ~F.array_contains(F.map_keys(bookkeeping), k))
    return F.map_filter(F.map_concat(kept, bookkeeping), lambda k, _: ~k.isin(hidden))


GRAM = 3


def _grams(name: Column, size: int) -> Column:
    """The distinct pieces of ``size`` code points of a name; none of a shorter one."""
    starts = F.when(F.length(name) >= size, F.sequence(F.lit(1), F.length(name) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(name, i, F.lit(size))))


def _held(holders: DataFrame, held: DataFrame) -> DataFrame:
    """(department, holder, piece) of names, lower-cased, where ``holder`` holds ``piece``. Both: department, name, distinct.

    A name can lie only in names that have all its grams, so it is looked up by the one that fewest names of its
    department have; names shorter than a gram by themselves, among the pieces of their length.
    """
    sizes = range(1, GRAM + 1)
    own = F.when(F.length("name") >= GRAM, _grams(F.col("name"), GRAM)).otherwise(F.array("name"))
    index = holders.select("department", F.col("name").alias("holder"), F.explode(F.flatten(F.array(*[_grams(F.col("name"), n) for n in sizes]))).alias("gram"))
    often = index.groupBy("department", "gram").agg(F.count("*").alias("n"))
    rarest = held.where(F.length("name") > 0).select("department", F.col("name").alias("piece"), F.explode(own).alias("gram")).join(often, ["department", "gram"]).groupBy("department", "piece").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    met = rarest.join(index, ["department", "gram"]).where(F.contains("holder", F.col("piece"))).select("department", "holder", "piece")
    everywhere = held.where(F.length("name") == 0).select("department", F.col("name").alias("piece")).join(holders.withColumnRenamed("name", "holder"), "department")
    return met.unionByName(everywhere)


def name_crosslink(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (left_name, right_name) of one department where one name holds the other, any case.

    A gram that the shorter name shares with few others is its filter, so that names aren't compared with all of their
    department; containment is checked last. An empty name lies in every name; null names and departments link to none.
    """
    sides = [x.select("department", c, F.lower(c).alias("name")).where(f"department IS NOT NULL AND {c} IS NOT NULL").distinct() for x, c in ((left, "left_name"), (right, "right_name"))]
    names = [x.select("department", "name").distinct() for x in sides]
    pairs = _held(names[0], names[1]).select("department", F.col("holder").alias("__a"), F.col("piece").alias("__b"))
    pairs = pairs.union(_held(names[1], names[0]).select("department", "piece", "holder")).distinct()
    a, b = (x.select("department", c, F.col("name").alias(k)) for x, c, k in ((sides[0], "left_name", "__a"), (sides[1], "right_name", "__b")))
    return pairs.join(a, ["department", "__a"]).join(b, ["department", "__b"]).select("department", "left_name", "right_name")
