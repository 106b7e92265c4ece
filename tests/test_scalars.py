from __future__ import annotations

import math
from bisect import bisect_right
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from replaystats.functions import rating, scalars


def evaluate(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_clean_skill(spark):
    written = ["[16.67]", "#16.67#", "~(16.67)", " [ 16.67 ] ", "", "[]", None, "-3.5"]
    got = evaluate(spark, written, "string", scalars.clean_skill)
    assert [None if g is None else round(g, 4) for g in got] == [16.67] * 4 + [None] * 3 + [-3.5]


def test_nullif_cast(spark):
    assert evaluate(spark, ["12", "", None], "string", lambda c: scalars.nullif_cast(c, "int")) == [12, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        evaluate(spark, ["x1"], "string", lambda c: scalars.nullif_cast(c, "int"))


def test_pg_bool(spark):
    assert evaluate(spark, ["t", " ON ", "1", "yes", "tru"], "string", scalars.pg_bool) == [True] * 5
    assert evaluate(spark, ["f", "Off", "of", "0", "N", "fals\t"], "string", scalars.pg_bool) == [False] * 6
    assert evaluate(spark, [None], "string", scalars.pg_bool) == [None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        evaluate(spark, ["o"], "string", scalars.pg_bool)


def test_json_text_and_array_length(spark):
    got = evaluate(spark, ['{"a": {"b": 1}}', '{"a": null}', "{}"], "string", lambda c: scalars.json_text(c, "a.b"))
    assert got == ["1", None, None]
    assert evaluate(spark, [[1, 2], [], None], "array<int>", scalars.array_length) == [2, 0, None]


@pytest.mark.parametrize(
    ("players", "teams", "category"),
    [
        (2, 2, "1v1"),
        (2, 3, "1v1"),
        (3, 2, None),
        (3, 3, "FFA"),
        (4, 2, "SmallTeam"),
        (10, 2, "SmallTeam"),
        (11, 2, "LargeTeam"),
        (16, 2, "LargeTeam"),
        (17, 2, None),
        (17, 3, "FFA"),
        (None, None, None),
    ],
)
def test_match_category(spark, players, teams, category):
    df = spark.createDataFrame([(players, teams)], "p long, t long")
    assert df.select(scalars.match_category("p", "t")).first()[0] == category


def test_result_label_counts_unknown_as_loss(spark):
    assert evaluate(spark, [True, False, None], "boolean", scalars.result_label) == ["Win", "Loss", "Loss"]


def test_pg_round_goes_through_the_decimal_text(spark):
    single = evaluate(spark, [16.05, 16.049999, 1234.565, -0.25, None, 0.0], "float", lambda c: scalars.pg_round(c, 1, single=True))
    # 16.049999 has the 6-digit text 16.0500 and so rounds up.
    assert single == [Decimal(s) for s in ("16.1", "16.1", "1234.6", "-0.3")] + [None, Decimal("0.0")]
    double = evaluate(spark, [16.049999999999997, 2.675, 1e-7], "double", lambda c: scalars.pg_round(c, 2))
    assert double == [Decimal("16.05"), Decimal("2.68"), Decimal("0.00")]


def test_iso_timestamp_and_windows(spark):
    df = spark.createDataFrame(
        [("2025-01-01T00:00:00.000Z",), ("2025-01-02T00:00:00Z",), ("2025-01-03T00:00:00+00:00",)], "s string"
    ).select(scalars.iso_timestamp("s").alias("t"))

    def days(condition):
        return [r.t.day for r in df.filter(condition).select(F.col("t")).orderBy("t").collect()]

    assert df.filter(scalars.in_window("t", "2025-01-01", "2025-01-02")).count() == 2
    assert df.filter(scalars.in_window("t", "2025-01-01", "2025-01-02", "left")).count() == 1
    assert df.filter(scalars.in_window("t", "2025-01-01", "2025-01-02", "day")).count() == 2
    assert df.filter(scalars.in_window("t", "2025-01-02")).count() == 2
    assert df.filter(scalars.older_than("t", "2025-01-03", 24)).count() == 1  # exactly 24 h old stays
    with pytest.raises(ValueError, match="closed"):
        scalars.in_window("t", "2025-01-01", "2025-01-02", "open")


def test_aware_clock_is_read_as_utc():
    assert scalars.as_datetime("2025-01-01T02:00:00+02:00").isoformat() == "2025-01-01T00:00:00"


def test_bucket_index_matches_bisect(spark):
    edges = list(range(0, 59, 2))
    values = [-5.0, -0.001, 0.0, 0.5, 1.999, 2.0, 27.99, 28.0, 57.9, 58.0, 61.0, 200.0]
    got = evaluate(spark, [*values, None], "double", lambda c: scalars.bucket_index(c, edges))
    assert got == [bisect_right(edges, v) - 1 for v in values] + [None]
    uneven = [1, 5, 6, 20]
    got = evaluate(spark, values, "double", lambda c: scalars.bucket_index(c, uneven))
    assert got == [bisect_right(uneven, v) - 1 for v in values]


def test_safe_rate(spark):
    df = spark.createDataFrame([(1, 3), (1, 8), (0, 0), (2, 3)], "n long, d long")
    got = [r[0] for r in df.select(rating.safe_rate(F.col("n"), F.col("d"), 2)).collect()]
    assert got == [Decimal("0.33"), Decimal("0.13"), Decimal("0.00"), Decimal("0.67")]
    got = [r[0] for r in df.select(rating.safe_rate(F.col("n"), F.col("d"), 1, pct=True)).collect()]
    assert got == [Decimal("33.3"), Decimal("12.5"), Decimal("0.0"), Decimal("66.7")]


def test_adjusted_rating(spark):
    cases = [
        # skill, hard wins, hard games, easy wins, easy games, games, expected
        (20.0, 0, 0, 0, 0, 0, 20.0),
        (20.0, 3, 3, 7, 7, 10, 15.0),  # exactly 30 % hard games count as too few
        (20.0, 4, 4, 0, 6, 10, 20.0 - 1.0 + 2.5),
        (None, 2, 4, 4, 4, 8, 2.5),
        (20.0, 1, 4, 3, 4, 10, 20.0 - 1.0),  # two games without a lobby skill count in the total only
    ]
    df = spark.createDataFrame(cases, "s double, wa long, ga long, wb long, gb long, n long, want double")
    got = df.select("want", rating.adjusted_rating(*[F.col(c) for c in ("s", "wa", "ga", "wb", "gb", "n")]).alias("got"))
    for row in got.collect():
        assert math.isclose(row["want"], row["got"], abs_tol=1e-9)
