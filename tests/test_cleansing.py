"""Cleansing expressions on the spellings found in real sources."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hazardmart.functions import cleansing


def clean(spark, expression, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    result = rows.select("i", expression(F.col("v")).alias("clean")).orderBy("i").collect()
    return [row["clean"] for row in result]


def check(spark, expression, expected):
    assert dict(zip(expected, clean(spark, expression, list(expected)))) == expected


def test_clean_text(spark):
    check(
        spark,
        cleansing.clean_text,
        {
            " X\t\n": "X",
            "michoacán": "MICHOACÁN",
            "\xa0\u2003a  b\u3000\x1f": "A  B",
            "": "",
            None: None,
        },
    )


def test_whitespace_is_what_python_strips(spark):
    padded = [f"{char}x{char}" for char in cleansing.WHITESPACE]
    assert len(padded) == 29
    assert set(clean(spark, cleansing.strip, padded)) == {"x"}


def test_clean_number(spark):
    check(
        spark,
        cleansing.clean_number,
        {
            "423,094 \n": Decimal("423094.00"),
            "126,014,024": Decimal("126014024.00"),
            "\xa07": Decimal("7.00"),
            "5.": Decimal("5.00"),
            ".5": Decimal("0.50"),
            ",5": Decimal("5.00"),
            "+5": Decimal("5.00"),
            "-5.25": Decimal("-5.25"),
            "1e3": Decimal("1000.00"),
            "1.5E+2": Decimal("150.00"),
            "0.285": Decimal("0.29"),
            "0": Decimal("0.00"),
            **dict.fromkeys(
                ["211, 801", "SD", "sin dato", "", " ", "1d", "5f", "nan", "inf", "1_000", "0x10"]
            ),
            **dict.fromkeys(["1e400", "-", ".", "5-", "--5", "1.2.3", "$5", "e5", None]),
        },
    )


def test_clean_money(spark):
    check(
        spark,
        cleansing.clean_money,
        {
            "$1,234.50": Decimal("1234.50"),
            " $ 1,234.5 ": Decimal("1234.50"),
            "-$5": Decimal("-5.00"),
            "5$": Decimal("5.00"),
            "14339434.0": Decimal("14339434.00"),
            **dict.fromkeys(["-", "$-", "$", "", "SD", "$ - ", None]),
        },
    )


def test_coerce_year(spark):
    check(
        spark,
        cleansing.coerce_year,
        {
            "2021.0": 2021,
            "2021": 2021,
            " 2021\n": 2021,
            "2.021e3": 2021,
            **dict.fromkeys(["1,024", "SD", "", "$2021", "99999999999", None]),
        },
    )


def test_coerce_count(spark):
    check(
        spark,
        cleansing.coerce_count,
        {"3": 3, "3.0": 3, " 12 ": 12, "SD": 0, "1,024": 0, "": 0, None: 0},
    )


@pytest.mark.parametrize(
    "text",
    [
        "INCENDIOS FORESTALES",
        "GEOLOGICO (SISMO)-QUIMICO",
        "ÁRBOL/ÑANDU 2DA FASE",
        "O'HIGGINS",
        "\xa0 x\t\n",
        "lluvia  extrema",
        "3er.sismo",
        "",
    ],
)
def test_title_words_equals_str_title(spark, text):
    assert clean(spark, cleansing.title_words, [text]) == [text.title()]


def test_exponents_cost_no_more_than_plain_numbers(spark):
    import time

    from pyspark.sql import functions as F

    from hazardmart.functions.cleansing import clean_money, clean_number, coerce_count, coerce_year

    rows = spark.createDataFrame([("1e-100000000",), ("1e999999999",), ("1e-400",), ("1e400",), ("1.5e2",)], "t string")
    start = time.perf_counter()
    found = rows.select(*(f(F.col("t")).cast("string") for f in (clean_number, clean_money, coerce_count, coerce_year))).collect()
    assert time.perf_counter() - start < 20
    assert [row[0] for row in found] == ["0.00", None, "0.00", None, "150.00"]


def test_fractional_year_is_no_year(spark):
    from pyspark.sql import functions as F

    from hazardmart.functions.cleansing import coerce_year

    rows = spark.createDataFrame([("2025.9",), ("2021.0",), ("2021",)], "t string")
    assert [row[0] for row in rows.select(coerce_year(F.col("t"))).collect()] == [None, 2021, 2021]
