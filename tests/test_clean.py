import unicodedata
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesloom.functions import clean


def apply(spark, cleaner, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string").coalesce(1)
    result = df.select("i", cleaner(F.col("v")).alias("out")).orderBy("i").collect()
    return [row["out"] for row in result]


def check(spark, cleaner, cases):
    got = apply(spark, cleaner, [value for value, _ in cases])
    assert got == [expected for _, expected in cases]


def test_parse_date_multi(spark):
    day = [
        "07/02/2024", "2024-02-07", "07-02-2024", "2024/02/07", "7/2/2024", " 07/02/2024 ",
    ]
    none = [
        "31/02/2024", "fev/24", "07/02/24", "2024-13-01", "", None, "07/02-2024", "2024",
        "2024-02-07 10:00:00",
    ]
    got = apply(spark, clean.parse_date_multi, day + none)
    assert [str(d) for d in got[: len(day)]] == ["2024-02-07"] * len(day)
    assert got[len(day) :] == [None] * len(none)


def test_parse_money(spark):
    check(
        spark,
        clean.parse_money,
        [
            ("R$ 1.234,56", Decimal("1234.56")),
            ("1234,5", Decimal("1234.5")),
            ("R$ -50,00", Decimal("-50")),
            ("R$ 1.000", Decimal("1000")),
            ("USD 9", Decimal("9")),
            ("1234.56", Decimal("123456")),
            ("a consultar", None),
            ("1,2,3", None),
            ("", None),
            (None, None),
        ],
    )


def test_percents(spark):
    check(
        spark,
        clean.parse_percent,
        [
            ("15%", Decimal("0.15")),
            ("12.5%", Decimal("0.125")),
            ("15", Decimal("0.15")),
            ("12,5%", None),
            ("%", None),
            (None, None),
        ],
    )
    check(
        spark,
        clean.percent_digits,
        [
            ("5,0%", Decimal("0.05")),
            ("5%", Decimal("0.005")),
            ("12,5%", Decimal("0.125")),
            ("12.345%", Decimal("1.234")),
            ("100,0%", Decimal("1")),
            ("n/a", None),
            (None, None),
        ],
    )


def test_digits_key(spark):
    check(
        spark,
        clean.digits_key,
        [("deal_1001", 1001), ("activity-77x8", 77), ("none", None), ("", None), (None, None)],
    )


def test_canonical_label(spark):
    check(
        spark,
        clean.canonical_label,
        [
            ("gogle ads", "Google Ads"),
            ("GOGLE", "Google Ads"),
            ("google ads", "google ads"),
            ("Facebook", "Facebook Ads"),
            ("meta FACE", "Facebook Ads"),
            ("linkedin", "LinkedIn Ads"),
            ("linkedin gogle", "Google Ads"),
            ("Eventos", "Eventos"),
            (None, None),
        ],
    )


def test_safe_casts(spark):
    check(
        spark,
        clean.safe_numeric,
        [("1500.25", Decimal("1500.25")), ("R$ 1.500,00", None), ("x", None), (None, None)],
    )
    check(spark, clean.safe_int, [("12", 12), (" 7 ", 7), ("12.5", None), ("", None)])
    dates = apply(spark, clean.safe_date, ["2024-02-07", "2024", "2024-02-30", "2024-02-07T10:00"])
    assert [d and str(d) for d in dates] == ["2024-02-07", None, None, None]


def test_strip_accents(spark):
    composed = "José Conceição"
    check(
        spark,
        clean.strip_accents,
        [
            (composed, "Jose Conceicao"),
            (unicodedata.normalize("NFD", composed), "Jose Conceicao"),
            ("Ñandú", "Nandu"),
            ("Łukasz Straße", "Łukasz Straße"),
            ("ﬁm", "ﬁm"),
            ("한", unicodedata.normalize("NFD", "한")),
            (None, None),
        ],
    )


def test_title_case(spark):
    check(
        spark,
        clean.title_case,
        [
            ("JOAO DA SILVA", "Joao Da Silva"),
            ("ana-maria o.neil", "Ana-Maria O.Neil"),
            ("d'avila x_y", "D'avila X_Y"),
            ("éric [x]\\y", "Éric [X]\\Y"),
            ("  two  blanks ", "  Two  Blanks "),
            ("a\tb\nc", "A\tB\nC"),
            ("3a b3", "3a B3"),
            ("", ""),
            (None, None),
        ],
    )


def test_snake_case_and_tokens(spark):
    check(
        spark,
        clean.snake_case,
        [
            ("Metas 2024 (v2)", "metas_2024_v2"),
            ("_Ação  Única_", "acao_unica"),
            ("a--b", "a_b"),
            ("ﬁm ½", "fim_12"),
        ],
    )
    check(
        spark,
        clean.missing_to_null,
        [("nan", None), ("None", None), ("<NA>", None), ("", ""), ("x", "x"), (None, None)],
    )


LETTERS = st.text(st.characters(min_codepoint=1, max_codepoint=0x24F), max_size=12)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(LETTERS | st.sampled_from(["한국어 x", "ﬁﬀ½㎏", "é́̃"]), min_size=20, max_size=60))
def test_folding_equals_unicode(spark, values):
    got = apply(spark, clean.strip_accents, values)
    ascii_got = apply(spark, clean.to_ascii, values)
    for value, stripped, plain in zip(values, got, ascii_got):
        parts = unicodedata.normalize("NFD", value)
        assert stripped == "".join(p for p in parts if unicodedata.category(p)[0] != "M")
        assert plain == unicodedata.normalize("NFKD", value).encode("ascii", "ignore").decode()


@pytest.mark.parametrize("rules", [(), (("A", "x"), ("ab", "y"))])
def test_label_rules_are_ordered(spark, rules):
    got = apply(spark, lambda c: clean.canonical_label(c, rules), ["ab", "b"])
    assert got == (["x", "b"] if rules else ["ab", "b"])
