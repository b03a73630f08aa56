import unicodedata

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from addrspark.functions import text


def run(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


def test_every_python_blank_is_stripped(spark):
    blanks = [chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF and not chr(c).strip()]
    assert len(blanks) == 29
    values = [b + "a b" + b for b in blanks]
    assert run(spark, values, text.strip) == ["a b"] * 29
    assert run(spark, blanks, text.not_blank) == [False] * 29


def test_null_is_not_blank(spark):
    assert run(spark, [None, "", " x "], text.not_blank) == [True, False, True]


def test_name_is_null_when_a_side_is(spark):
    df = spark.createDataFrame([("AV", "A"), (None, "A"), ("AV", None)], "a string, b string")
    assert [r[0] for r in df.select(text.joined_name(F.col("a"), F.col("b"))).collect()] == ["AV A", None, None]


@pytest.mark.parametrize(
    "value, expected",
    [
        (" -77.5\xa0", -77.5), ("-7\xa07.5", -77.5), ("+.5", 0.5), ("5.", 5.0), ("1e2", 100.0), ("1.0d", None),
        ("1_000", None), ("", None), ("abc", None), ("inf", None), ("nan", None), ("1e999", None), (None, None),
        (" -12.25\n", -12.25), ("1 2", None),
    ],
)
def test_coordinates(spark, value, expected):
    assert run(spark, [value], text.parse_coordinate) == [expected]


def test_accents_match_decomposition(spark):
    pairs = [
        ("Ñuñoa", "Nunoa"), ("áéíóúü", "aeiouu"), ("ﬁn", "fin"), ("½", "1⁄2"), ("plain", "plain"), ("", ""), (None, None),
        ("Å", "A"), ("한", "\u1112\u1161\u11ab"), ("가", "\u1100\u1161"), ("e\u0301", "e"), ("\u0301", ""), ("ª", "a"),
        ("㎏", "kg"), ("Ǆ", "DZ"), ("ŉ", "ʼn"), ("Ωμέγα", "Ωμεγα"), ("Ἀθῆναι", "Αθηναι"), ("日本", "日本"),
        ("ｆｕｌｌ", "full"), ("𝐁old", "Bold"), ("a…b", "a...b"), ("x™", "xTM"),
    ]
    assert run(spark, [w for w, _ in pairs], text.remove_accents) == [plain for _, plain in pairs]


def test_nothing_is_left_to_decompose(spark):
    chars = [chr(c) for c in range(0x80, 0x20000) if not 0xD800 <= c <= 0xDFFF]
    lines = ["".join(chars[i : i + 7]) for i in range(0, len(chars), 7)]
    plain = "".join(run(spark, lines, text.remove_accents))
    assert not any(unicodedata.combining(c) or unicodedata.decomposition(c) for c in plain)
    assert all(unicodedata.normalize("NFKD", c) == c for c in plain)
    kept = [c for c in chars if not unicodedata.decomposition(c) and not unicodedata.combining(c) and not 0xAC00 <= ord(c) < 0xD7A4]
    assert run(spark, ["".join(kept)], text.remove_accents) == ["".join(kept)]


def test_digit_ids(spark):
    assert run(spark, ["12", "007", "X1", "-3", "", None, "٣٤", "1.0"], text.digits_id) == [
        12, 7, None, None, None, None, 34, None,
    ]
    assert run(spark, [5, -5, None], text.digits_id, "bigint") == [5, None, None]


def test_whole_numbers(spark):
    values = ["12", " 13 ", "7.9", "-7.9", "x", "", None, "1e2", "99999999999999999999", "+4"]
    assert run(spark, values, text.whole_number) == [12, 13, 7, -7, None, None, None, 100, None, 4]


def test_number_text(spark):
    df = spark.createDataFrame([(12345678.0,), (1.5,), (None,)], "n double")
    assert [r[0] for r in df.select(text.number_text(df, "n")).collect()] == ["12345678", "1.5", None]


def test_keyword_limit(spark):
    assert run(spark, ["a" * 256, "a" * 257, None], text.keyword) == ["a" * 256, None, None]


def test_list_text(spark):
    df = spark.createDataFrame([(["a", "b"],)], T.StructType.fromDDL("v array<string>"))
    assert df.select(text.list_text(F.col("v"))).first()[0] == str(["a", "b"])
