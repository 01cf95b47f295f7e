"""The few places where the two SQL dialects differ: Spark's, and that of the engine that checks results."""

from __future__ import annotations


class Dialect:
    def __init__(self, spark: bool) -> None:
        self.spark = spark
        self.string = "STRING" if spark else "VARCHAR"

    def name(self, text: str) -> str:
        return f"`{text}`" if self.spark else f'"{text}"'

    def thousands(self, x: str) -> str:
        """A number cut to whole, with thousands separators."""
        return f"format_number(CAST(floor({x}) AS BIGINT), 0)" if self.spark else f"format('{{:,}}', CAST(floor({x}) AS BIGINT))"

    def pounds(self, x: str) -> str:
        return f"concat('£', {self.thousands(x)})"

    def money(self, x: str) -> str:
        """Money text to whole pounds; NULL if it isn't a whole number once £, commas and quotes are gone."""
        if self.spark:
            return f"try_cast(regexp_replace({x}, '[£,\"]', '') AS BIGINT)"
        clean = f"regexp_replace({x}, '[£,\"]', '', 'g')"
        return f"CASE WHEN regexp_full_match({clean}, '\\s*-?\\d+\\s*') THEN TRY_CAST({clean} AS BIGINT) END"

    def number(self, x: str) -> str:
        return f"{'try_cast' if self.spark else 'TRY_CAST'}({x} AS DOUBLE)"

    def total(self, x: str) -> str:
        return f"CAST(sum({x}) AS BIGINT)"

    def json_int(self, column: str, key: str) -> str:
        return f"CAST(get_json_object({column}, '$.{key}') AS INT)" if self.spark else f"CAST(json_extract_string({column}, '$.{key}') AS INTEGER)"

    def collect(self, x: str) -> str:
        """The distinct values, sorted, as one text."""
        return f"array_join(sort_array(collect_set({x})), '; ')" if self.spark else f"array_to_string(list_sort(list(DISTINCT {x})), '; ')"

    def unnest(self, columns: list[str], alias: str) -> str:
        """A lateral column with one row for each of the columns."""
        return f"LATERAL VIEW explode(array({', '.join(columns)})) t AS {alias}" if self.spark else f", LATERAL (SELECT unnest([{', '.join(columns)}]) AS {alias}) t"

    def days(self, later: str, earlier: str) -> str:
        return f"datediff({later}, {earlier})" if self.spark else f"CAST(date_diff('day', {earlier}, {later}) AS INTEGER)"


SPARK, DUCKDB = Dialect(True), Dialect(False)
