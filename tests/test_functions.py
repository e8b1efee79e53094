import hashlib
from urllib.parse import unquote

from pyspark.sql import functions as F

from tests.conftest import rows, ts
from tidemark import functions as fn


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def test_instant_unit_follows_digit_count(spark):
    values = ["1700000000123456", "1700000000123", "1700000000", "2023-11-14T22:13:20Z", "soon", None]
    found = rows(column(spark, values).select("i", fn.to_instant(F.col("v"))), "i")
    assert [r[1] for r in found] == [
        ts("2023-11-14 22:13:20.123456"), ts("2023-11-14 22:13:20.123"), ts("2023-11-14 22:13:20"),
        ts("2023-11-14 22:13:20"), None, None,
    ]


def test_cdc_millis_by_type(spark):
    texts = column(spark, ["1700000000123", "2023-11-14 22:13:20", "x", None])
    assert [r[0] for r in rows(texts.select(fn.cdc_millis(texts, "v"), "i"), "i")] == [1700000000123, 1700000000000, None, None]
    numbers = column(spark, [5, None], "bigint")
    assert [r[0] for r in rows(numbers.select(fn.cdc_millis(numbers, "v"), "i"), "i")] == [5, None]


def test_surrogate_key(spark):
    found = column(spark, ["a", None]).select(fn.surrogate_key("i", "v")).collect()
    expected = [hashlib.md5(t.encode()).hexdigest() for t in ("c0:0||c1:a", "c0:1||c1:__null__")]
    assert [r[0] for r in found] == expected
    unknown = spark.range(1).select(fn.unknown_key()).first()[0]
    assert unknown == hashlib.md5(b"c0:-1").hexdigest()


def test_uri_parts(spark):
    cases = {
        None: ("unknown", None), "": ("unknown", None), "/": ("home", None), "/product/42": ("product", 42),
        "/product/x": ("product", None), "/cancel/item/7": ("post_purchase", None), "return/1": ("post_purchase", None),
        "/department/Men/category/Jeans%20%26%20Co": ("department", None), "a+b": ("a+b", None),
        "/a%20b/c": ("a b", None), "//product//7/": ("product", 7), "/bad%zz": ("bad%zz", None),
    }
    frame = column(spark, list(cases))
    found = rows(frame.select("i", fn.page_type(F.col("v")), fn.uri_product_id(F.col("v"))), "i")
    assert [r[1:] for r in found] == list(cases.values())
    assert unquote("a+b") == "a+b"


def test_dates_and_differences(spark):
    frame = spark.createDataFrame([(ts("2024-03-09 23:00:00"), ts("2024-03-11 22:59:59"))], "a timestamp, b timestamp")
    found = frame.select(
        fn.date_key(F.col("a")), fn.whole_days(F.col("a"), F.col("b")), fn.whole_days(F.col("b"), F.col("a")),
        fn.whole_seconds(F.col("a"), F.col("b")), fn.iso_text(F.col("a")),
        fn.floor_to_bucket(F.col("b"), 300),
    ).first()
    assert tuple(found) == (20240309, 1, -1, 172799, "2024-03-09T23:00:00+00:00", ts("2024-03-11 22:55:00"))
    assert spark.range(1).select(fn.date_key(F.lit(None).cast("timestamp"))).first()[0] is None


def test_filters(spark):
    frame = spark.createDataFrame(
        [(1, ts("2024-01-01 00:00:00")), (2, ts("2024-01-02 23:59:59.999999")), (3, ts("2024-01-03 00:00:00"))],
        "i int, at timestamp",
    )
    assert [r.i for r in frame.where(fn.between_dates("at", "2024-01-01", "2024-01-02")).collect()] == [1, 2]
    assert frame.where(fn.in_list("i", None)).count() == 3
    assert frame.where(fn.in_list("i", [2])).count() == 1


def test_band_edges_and_ratio(spark):
    label, rank = fn.band(F.col("v"), ((30, "a"), (60, "b")), "c")
    found = rows(column(spark, [29, 30, 60, None], "int").select("i", label, rank), "i")
    assert [r[1:] for r in found] == [("a", 1), ("b", 2), ("c", 3), ("c", 3)]
    assert spark.range(1).select(fn.safe_divide(F.lit(1), F.lit(0))).first()[0] is None
