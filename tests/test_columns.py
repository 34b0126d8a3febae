"""Cleaning columns against expected values, every trap with its own row."""

import math

import pytest
from pyspark.sql import functions as F

from cadastre.functions import casts, numeric, text


def apply(spark, function, values, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in frame.select(function(F.col("v")).alias("r"), "i").orderBy("i")
            .select("r").collect()]


def test_trim_strips_every_white_space(spark):
    assert apply(spark, text.trim_ws, ["\t a \n", " b　", "c d", "", None]) == [
        "a", "b", "c d", "", None]


def test_blank(spark):
    assert apply(spark, text.is_blank, ["", "  ", "\t\n", None, "x"]) == [True] * 4 + [False]


@pytest.mark.parametrize("spelling, name", text.CITY_NAMES.items())
def test_known_city_spellings(spark, spelling, name):
    assert apply(spark, text.canonical_city, [spelling]) == [name]


def test_unknown_city_is_trimmed_and_title_cased(spark):
    assert apply(spark, text.canonical_city, [" SANTA MARTA ", "valledupar", None, " Cali "]) == [
        "Santa Marta", "Valledupar", None, "Cali"]


def test_untrimmed_known_spelling_is_not_looked_up_unless_asked(spark):
    values = [" B/quilla ", " MEDELLÍN"]
    assert apply(spark, text.canonical_city, values) == ["B/Quilla", "Medellín"]
    assert apply(spark, lambda c: text.canonical_city(c, trim_first=True),
                 [" B/quilla ", "Bogotá "]) == ["Barranquilla", "Bogota"]


def test_title_words_breaks_at_punctuation(spark):
    assert apply(spark, text.title_words, ["san andres-isla", "o'neill STREET", "a.b_c 1x", ""]) == [
        "San Andres-Isla", "O'neill Street", "A.B_C 1x", ""]


def test_title_letters_breaks_at_every_non_letter(spark):
    assert apply(spark, text.title_letters, ["o'neill 3rd", "santa marta"]) == [
        "O'Neill 3Rd", "Santa Marta"]


def test_fold_drops_case_and_accents(spark):
    assert apply(spark, text.fold, [" Bogotá ", "ÁREA Ñandú", "é", None]) == [
        "bogota", "area nandu", "e", None]


def test_display_name(spark):
    assert apply(spark, text.display_name, ["random_forest", "xgboost"]) == [
        "Random Forest", "Xgboost"]


def test_double(spark):
    got = apply(spark, casts.to_double,
                [" 72.5 ", "\t1e3\n", "10d", "1f", "abc", "", None, "-.5", "5.", "NaN", "0x1A"])
    assert got[:9] == [72.5, 1000.0, None, None, None, None, None, -0.5, 5.0]
    assert math.isnan(got[9]) and got[10] is None


def test_integer_rejects_decimals(spark):
    assert apply(spark, casts.to_integer, [" 2 ", "3.0", "", "-4", "9223372036854775808", "x"]) == [
        2, None, None, -4, None, None]


def test_amount_rounds_halves_away_from_zero(spark):
    assert apply(spark, casts.to_whole_amount,
                 ["250000000.0", "2.5", "-2.5", "n/a", "NaN", "1e30", "  "]) == [
        250000000, 3, -3, None, None, None, None]


def test_date_accepts_plain_days_only(spark):
    got = apply(spark, casts.to_date, ["2024-03-05", "2024", "05/03/2024", "2024-03-05 10:00:00",
                                       "2024-3-5", "2024-13-01", None])
    assert [str(d) if d else None for d in got] == [
        "2024-03-05", None, None, None, "2024-03-05", None, None]


def test_century_repair(spark):
    got = apply(spark, casts.repair_century,
                ["0023-05-06T00:00:00.000", "0009-01-31", "bad", "0023-02-30", None])
    assert [str(d) if d else None for d in got] == ["2023-05-06", "2009-01-31", None, None, None]


def test_ratio_is_null_on_zero(spark):
    frame = spark.createDataFrame([(1, 2), (1, 0), (None, 2)], "a int, b int")
    assert [r[0] for r in frame.select(numeric.safe_ratio(F.col("a"), F.col("b"))).collect()] == [
        0.5, None, None]


def test_weekday_counts_from_sunday(spark):
    parts = numeric.calendar_parts(F.to_date(F.lit("2024-03-03")))  # a Sunday
    row = spark.range(1).select(*[c.alias(n) for n, c in parts.items()]).first()
    assert row.asDict() == {"anio": 2024, "mes": 3, "trimestre": 1, "dia_semana": 1}


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_split_ignores_order_and_partitions(spark, method):
    ids = spark.range(2000).select(F.concat(F.lit("p-"), "id").alias("id"))

    def labels(frame):
        return {r["id"]: r["s"] for r in frame.select(
            "id", numeric.split_label(F.col("id"), 80, method).alias("s")).collect()}

    first = labels(ids.repartition(1))
    assert first == labels(ids.repartition(7).orderBy(F.desc("id")))
    assert 0.75 < sum(v == "train" for v in first.values()) / 2000 < 0.85


def test_null_key_is_test(spark):
    assert apply(spark, numeric.split_label, [None]) == ["test"]
    assert apply(spark, lambda c: numeric.split_label(c, 80, "xxhash64"), [None]) == ["test"]


def test_unknown_hash_is_refused():
    with pytest.raises(ValueError):
        numeric.hash_bucket(F.lit("x"), 10, method="crc")


def test_century_repair_reads_the_whole_text(spark):
    got = apply(spark, casts.repair_century,
                ["0024-03-05garbage", "0024-03-05 10:11:12", "0024-03-05 25:00", "0024-03-05T10:11"])
    assert [str(d) if d else None for d in got] == [None, "2024-03-05", None, "2024-03-05"]


def test_backslash_ends_a_word(spark):
    from cadastre.functions import text
    assert apply(spark, text.title_words, ["a\\b c"]) == ["A\\B C"]
