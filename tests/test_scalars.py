"""Edge values of the scalar library."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions import scalars as S


def one(spark, function, value):
    return spark.createDataFrame([(value,)], "x string").select(function(F.col("x"))).first()[0]


D = dt.date
PARTIAL = {
    "2025": D(2025, 1, 1), "202606": D(2026, 6, 1), "2026-06": D(2026, 6, 1), "20260901": D(2026, 9, 1), "2026-09-01": D(2026, 9, 1), " 2025 ": D(2025, 1, 1), "1000-01-01": D(1000, 1, 1),
    "25": None, "20251": None, "2025-1": None, "202613": None, "20250230": None, "2026-0601": None, "202606-01": None, "0999": None, None: None,
}
EXPORT = {
    "2025-03-01T10:15:00": D(2025, 3, 1), "2025-03-01 10:15": D(2025, 3, 1), "30-Mar-26": D(2026, 3, 30), "01 April 2025": D(2025, 4, 1), "1990-01-01": D(1990, 1, 1),
    "01/03/2025": None, "March 2025": None, "soon": None, "1970-01-01": None, "01-Jan-70": None, "1989-12-31": None,
}


def test_partial_dates(spark):
    rows = spark.createDataFrame(list(enumerate(PARTIAL)), "i int, x string").select("i", S.partial_date(F.col("x"))).collect()
    assert {r[0]: r[1] for r in rows} == dict(enumerate(PARTIAL.values()))


def test_export_dates(spark):
    rows = spark.createDataFrame(list(enumerate(EXPORT)), "i int, x string").select("i", S.export_date(F.col("x"))).collect()
    assert {r[0]: r[1] for r in rows} == dict(enumerate(EXPORT.values()))


def test_test_names(spark):
    for name in ("Export_test", "00_Test", "PUT IN FOR TESTING", "test"):
        assert one(spark, S.is_test_name, name)
    for name in ("Contest Ltd", "Attest", "Latest News", "Test Valley Council", None):
        assert not one(spark, S.is_test_name, name)


def test_names_of_files(spark):
    split = lambda x: one(spark, lambda c: S.file_names(c), x)
    assert split("case.pdf, annex.docx") == ["case.pdf", "annex.docx"]
    assert split("report, final.pdf,b.docx") == ["report, final.pdf", "b.docx"]
    assert split("a.pdf, no extension") == ["a.pdf", "no extension"]
    assert split("a.pdf, ,a.pdf") == ["a.pdf", ", a.pdf"] or split("a.pdf,a.pdf") == ["a.pdf"]
    assert split("a.pdf\t,b.docx\n") == ["a.pdf", "b.docx"]
    assert split("nan") == split(" ") == split(None) == []


def test_name_key(spark):
    key = lambda x: one(spark, S.name_key, x)
    assert key("The  Home & Office") == key("home AND office") == "home and office"
    assert key("Theatres Trust") == "theatres trust"


@pytest.mark.parametrize("value,length", [("abc", 3), ("é", 6), ("a😀", 13)])
def test_escaped_length(spark, value, length):
    import json

    assert one(spark, S.escaped_length, value) == length == len(json.dumps(value)) - 2


def test_small_ones(spark):
    assert one(spark, S.slug, "Home Office & Co!") == "home-office-co"
    assert one(spark, S.slug, None) == one(spark, S.slug, " ") == "cross-government"
    assert one(spark, lambda c: S.first_truthy(c, F.lit("b")), "  ") is None
    assert one(spark, lambda c: S.first_text(c, F.lit("b")), "  ") == "b"
    assert one(spark, S.sidecar_key, "a.metadata.json") is None and one(spark, S.sidecar_key, "") is None
    assert one(spark, lambda c: S.ledger_key(F.lit("t"), F.lit(None), c, F.lit("v")), "k") == "t##k#v"
    assert [spark.range(1).select(S.clamp_wait(F.lit(x))).first()[0] for x in (1, 30, 99)] == [5, 30, 60]
    assert spark.range(1).select(S.date_number(F.lit("2025-02-03").cast("date")), S.number_date(F.lit(20250230)), S.number_date(F.lit(20250203))).first()[:] == (20250203, None, D(2025, 2, 3))
