import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom import functions as fn


def one(spark, column, **values):
    literals = [F.lit(v).alias(k) for k, v in values.items()]
    return spark.range(1).select(*literals, F.lit(1).alias("__")).select(column).first()[0]


def many(spark, column, values, kind):
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    return [r[0] for r in df.select(column).collect()]


def test_trim_keeps_tabs_and_drops_blank(spark):
    values = ["  a ", "", "   ", None, "\t"]
    assert many(spark, fn.blank_to_null("c"), values, "string") == ["a", None, None, None, "\t"]
    assert many(spark, fn.trimmed_or("c", "N/A"), values, "string") == ["a", "N/A", "N/A", "N/A", "\t"]
    assert many(spark, fn.is_blank("c"), values, "string") == [False, True, False, True, False]


def test_surrogate_key_text(spark):
    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    token = "_dbt_utils_surrogate_key_null_"
    assert many(spark, fn.surrogate_key("c"), [7, None], "long") == [md5("7"), md5(token)]
    both = spark.createDataFrame([(7, "x"), (7, None)], "a long, b string")
    assert [r[0] for r in both.select(fn.surrogate_key("a", "b")).collect()] == [md5("7-x"), md5(f"7-{token}")]


def test_decades_and_labels(spark):
    years = [1999, 2000, 2009, 2010, 2019, 2020, 2030, None]
    expected = ["before_2000", "2000s", "2000s", "2010s", "2010s", "2020s", "2020s", "2020s"]
    assert many(spark, fn.decade_group("c"), years, "long") == expected
    assert many(spark, fn.year_label("c"), [2005, None], "long") == ["2005", None]
    assert one(spark, fn.year_range(F.lit(2000), F.lit(2020))) == "2000–2020"


def test_code_prefix(spark):
    assert many(spark, fn.code_prefix("c"), ["AIR_1", "A_B_C", "NCD", "_x", "", None], "string") == [
        "AIR",
        "A",
        "NCD",
        "",
        "",
        None,
    ]


def test_sex_code(spark):
    values = ["SEX_MLE", "MLE", "SEX_BTSX", "YEARS05-09", "", None, "SEX_SEX_FMLE", "XSEX_MLE"]
    expected = ["MLE", "MLE", "BTSX", None, None, None, "FMLE", None]
    assert many(spark, fn.sex_code("c"), values, "string") == expected


def test_pct_diff_never_divides_by_zero(spark):
    assert one(spark, fn.pct_diff(F.lit(0), F.lit(0))) == 0.0
    assert one(spark, fn.pct_diff(F.lit(0), F.lit(3))) == 100.0
    assert one(spark, fn.pct_diff(F.lit(200), F.lit(199))) == 0.5


def test_formats(spark):
    ts = F.to_timestamp(F.lit("2024-02-03 04:05:06"))
    assert one(spark, fn.landing_stamp(ts)) == "20240203_040506"
    assert one(spark, fn.iso_utc(ts)) == "2024-02-03T04:05:06+00:00"
    assert one(spark, fn.size_mb(F.lit(1572864))) == 1.5
    assert one(spark, fn.type_token(F.lit("DOUBLE PRECISION"))) == "double"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="AB_ \t", max_size=6), min_size=1, max_size=20))
def test_prefix_and_trim_agree_with_python(spark, values):
    assert many(spark, fn.code_prefix("c"), values, "string") == [v.split("_")[0] for v in values]
    assert many(spark, fn.trimmed_or("c", "N/A"), values, "string") == [v.strip(" ") or "N/A" for v in values]
