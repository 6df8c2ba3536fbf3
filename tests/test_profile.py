"""Profiles of columns: merged parts, and shifts that a comparison finds."""

from pyspark.sql import functions as F

from layertables.operators.profile import Limits, compare_profiles, merge_profiles, profile


def _by(df):
    return {r["column_name"]: r for r in df.collect()}


def _table(spark, n=4000, shift=0.0):
    return spark.range(n).selectExpr(
        "id",
        f"cast((id * 7919) % 1000 + {shift} as double) as x",
        "date_add(date'2024-01-01', cast(id % 100 as int)) as day",
        "cast(id % 13 as string) as name",
        "array(id) as nested",
        "cast(null as double) as none",
    )


def test_merged_parts_equal_the_whole(spark):
    df = _table(spark)
    parts = [profile(df.filter(F.col("id") % 3 == k)) for k in range(3)]
    merged = merge_profiles(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    got = _by(compare_profiles(profile(df), merged))
    assert set(got) == set(df.columns)
    for r in got.values():
        assert (r["n_rows_before"], r["n_null_before"]) == (r["n_rows_after"], r["n_null_after"]) and not r["shifted"]
        if r["distinct_before"] is not None:
            assert abs(r["distinct_before"] - r["distinct_after"]) <= 0.03 * r["distinct_before"]
    assert got["none"]["n_null_after"] == 4000 and got["nested"]["distance"] is None
    assert got["name"]["distinct_after"] == 13 and got["x"]["distance"] < 0.02


def test_shifts_are_found_and_named(spark):
    before = profile(_table(spark))
    after = _table(spark, 3000, 150.0)
    after = after.withColumns({"name": F.concat("name", F.lit("-"), (F.col("id") % 5).cast("string")), "day": F.when(F.col("id") % 4 != 0, F.col("day"))})
    got = _by(compare_profiles(before, profile(after)))
    assert {c: r["reasons"] for c, r in got.items() if r["shifted"]} == {"x": "distribution", "name": "distinct", "day": "nulls", "id": "distribution"}
    assert abs(got["x"]["distance"] - 0.15) < 0.03
    loose = _by(compare_profiles(before, profile(after), Limits(null_share=0.5, distinct=10, distance=0.5)))
    assert not any(r["shifted"] for r in loose.values())


def test_empty_loads(spark):
    df = _table(spark)
    got = _by(compare_profiles(profile(df), profile(df.limit(0))))
    assert got["x"]["n_rows_after"] == 0 and got["x"]["distance"] is None and got["x"]["reasons"] == "distinct"
