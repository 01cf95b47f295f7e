"""Read-only SQL: catalog look-ups, the guard against anything but queries, and execution with bound values."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

FORBIDDEN = ("DROP", "DELETE", "INSERT", "UPDATE", "ALTER", "CREATE", "GRANT", "REVOKE", "MERGE", "TRUNCATE")
#: Plan nodes that aren't queries; subclasses of Spark's ``Command`` are found by their Java type.
_NOT_QUERIES = ("InsertIntoStatement", "Call", "CompoundBody", "DeleteFromTable", "UpdateTable", "MergeIntoTable")
DISPLAY_ROWS = 50


class NotAQuery(ValueError):
    """The text isn't one read-only query."""


def check(spark: SparkSession, text: str) -> None:
    """Raise ``NotAQuery`` unless the text parses to one query without any command inside.

    The whole parsed tree is walked, CTEs and subqueries included; forbidden words outside quotes are refused as well,
    so that a text is refused even where the parser would accept it in a new meaning.
    """
    bare = re.sub(r"'(?:[^'\\]|\\.|'')*'|`[^`]*`|\"[^\"]*\"|--[^\n]*|/\*.*?\*/", " ", text, flags=re.S)
    for word in FORBIDDEN:
        if re.search(rf"(?<![A-Za-z0-9_]){word}(?![A-Za-z0-9_])", bare, re.I):
            raise NotAQuery(f"{word} is not allowed")
    jvm = spark._jvm
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except Exception as error:
        raise NotAQuery(f"does not parse: {str(error).splitlines()[0][:200]}") from None
    command = jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.plans.logical.Command")

    def walk(node) -> None:
        name = node.getClass().getSimpleName()
        if name in _NOT_QUERIES or command.isInstance(node):
            raise NotAQuery(f"{name} is not allowed")
        for part in (node.children(), node.innerChildren(), node.subqueries()):
            for i in range(part.size()):
                child = part.apply(i)
                if hasattr(child, "children") and hasattr(child, "subqueries"):
                    walk(child)

    walk(plan)


def execute(spark: SparkSession, text: str, args: dict | None = None) -> DataFrame:
    """Run one read-only query; values come as named parameters."""
    check(spark, text)
    return spark.sql(text, args=args)


def aggregates(found: DataFrame) -> bool:
    """Whether a query's rows are groups: an aggregate under nothing but projections, filters, orders and limits."""
    plan = found._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in ("Project", "Filter", "Sort", "GlobalLimit", "LocalLimit", "SubqueryAlias", "WithCTE"):
        plan = plan.children().apply(0)
    return plan.getClass().getSimpleName() in ("Aggregate", "Distinct")


def answer(spark: SparkSession, text: str, args: dict | None = None, rows: int = DISPLAY_ROWS, most: int = 10_000) -> str:
    """The result as text for a reader: errors and empty results are messages.

    At most ``rows`` rows are shown, or ``most`` if the query aggregates; where rows are left out, a last line says so.
    """
    try:
        found = execute(spark, text, args)
        rows = most if aggregates(found) else rows
        shown = found.limit(rows + 1).collect()
    except Exception as error:
        return f"Error: {str(error).splitlines()[0]}"
    if not shown:
        return "The query ran and returned no rows."
    lines = [" | ".join(found.columns), *(" | ".join("" if v is None else str(v) for v in row) for row in shown[:rows])]
    return "\n".join(lines + [f"... only the first {rows} rows are shown"] * (len(shown) > rows))


def list_tables(spark: SparkSession, databases: list[str]) -> dict[str, list[str]]:
    """Sorted table names of each database; a database that can't be read gives its error and doesn't stop the others."""
    out = {}
    for name in databases:
        try:
            if not spark.catalog.databaseExists(name):
                raise LookupError(f"no database {name}")
            out[name] = sorted(t.name for t in spark.catalog.listTables(name))
        except Exception as error:
            out[name] = [f"Error: {error}"]
    return out


def table_schema(spark: SparkSession, database: str | None, name: str) -> dict[str, str] | str:
    """Column to type; the name may come in quotes or with blanks. An unknown table gives the error as text."""
    bare = name.strip().strip("\"'`").strip()
    try:
        return dict(spark.table(f"`{database}`.`{bare}`" if database else f"`{bare}`").dtypes)
    except Exception as error:
        return f"Error: {str(error).splitlines()[0]}"
