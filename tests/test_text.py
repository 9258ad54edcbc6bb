import pytest
from pyspark.sql import functions as F

from rapproche.functions import text as T


def apply(spark, function, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.select(function(F.col("v")), "i").orderBy("i").select(F.col("*")).collect()]


@pytest.mark.parametrize(
    "function, given, expected",
    [
        (T.standardise, "L'Hôpital-de-la-Croix", "hopital croix"),
        (T.standardise, "À l’Étoile", "a l'etoile"),
        (T.standardise, "", ""),
        (T.standardise, None, ""),
        (T.standardise, "  Œuvre «ß»\t½ ", "oeuvre <<ss>> 1/2"),
        (T.standardise, "été ETE", "ete ete"),
        (T.clean_field, ' \t" Rue "\r\n', " Rue "),
        (T.drop_single_letters, "a rue b  hugo", "rue hugo"),
        (T.collapse, " a \t b c ", "a b c"),
        (T.fold_to_ascii, "ñ plain", "n plain"),
        (lambda c: T.collapse(T.remove_digits(c)), "paris 7 75007", "paris 500"),
        (lambda c: T.collapse(T.remove_digits(c, True)), "paris 7 75007", "paris"),
        (lambda c: T.remove_leading_pattern(c, r"\d+"), "12 rue 12", "  rue  "),
        (lambda c: T.remove_leading_pattern(c, r"\d+"), "rue 12", "rue 12"),
    ],
)
def test_golden(spark, function, given, expected):
    assert apply(spark, function, [given]) == [expected]


def test_standardise_is_the_composition_of_its_steps(spark):
    values = ["Été à l'Île", "  RUE d’Aix ", "a b\x1cc", "№ 5", "x" * 3000 + " é", "Straße—ŒUVRE"]

    def composed(c):
        folded = T.fold_to_ascii(T.punctuation_to_space(T.lower_strip(T.null_to_empty(c))))
        return T.collapse(T.remove_stop_words(folded))

    assert apply(spark, T.standardise, values) == apply(spark, composed, values)


def test_token_text_round_trip(spark):
    row = spark.createDataFrame([(["▁rue", "x"],)], "t array<string>")
    joined = row.select(T.join_tokens(F.col("t")).alias("j"))
    assert joined.first()["j"] == "▁rue##x"
    assert joined.select(T.split_tokens(F.col("j")).alias("t")).first()["t"] == ["▁rue", "x"]
