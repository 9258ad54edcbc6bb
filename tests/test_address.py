from pyspark.sql import functions as F

from rapproche.config import Parity
from rapproche.functions.address import split_address, stored_postal_code

GOLDEN = [
    ("12 rue Victor Hugo, 75011 Paris", " Paris", "75011", "12", "rue Victo rue Hugo"),
    ("14 avenue Foch 69006 LYON", "LYON", "60096", "14", "avenue Foch 69006"),
    ("12 RUE VICTOR HUGO", "RUE VICTOR HUGO", "", "", "12"),
    ("5 av Jean Jaurès, Paris", "Paris", "", "5", "avenue Jean Jaurès"),
    ("1 rue du 11 novembre, 38000 Grenoble", " Grenoble", "38000", "1", "rue du  novembre"),
    ("avenue 1954, Nice", "Nice", "", "", "avenue 1954"),
    ("Bat A,12 rue X, Paris", "Paris", "", "", "Bat A12 rue X"),
    ("12 rue X,", "", "", "12", "rue X"),
    ("8 che des Prés 01000 BOURG EN BRESSE", "BOURG EN BRESSE", "00010", "8", "chem des Prés 01000"),
    ("Perche", "", "", "", "Perche"),
    ("br foo, Nice", "Nice", "", "", "rue foo"),
    ("", "", "", "", ""),
]


def split(spark, addresses, parity=Parity()):
    rows = spark.createDataFrame(list(enumerate(addresses)), "i int, source string")
    parts = split_address(rows, "source", parity).orderBy("i")
    return [tuple(r) for r in parts.select("city", "postal_code", "street_number", "address").collect()]


def test_golden_rows(spark):
    assert split(spark, [g[0] for g in GOLDEN]) == [g[1:] for g in GOLDEN]


def test_intended_reading(spark):
    rows = ["14 avenue Foch 69006 LYON", "12 rue Victor Hugo, 75011 Paris", "3 r Foch (BP), Nice"]
    assert split(spark, rows, Parity.intended()) == [
        ("LYON", "69006", "14", "avenue Foch"),
        (" Paris", "75011", "12", "rue Victor Hugo"),
        ("Nice", "", "3", "rue Foch"),
    ]


def test_postal_codes(spark):
    codes = ["75011", "01000", "000", "75 011", "2a004", "", "1e5", "9" * 25]
    rows = spark.createDataFrame(list(enumerate(codes)), "i int, c string").orderBy("i")
    stored = [r[0] for r in rows.select(stored_postal_code(F.col("c"))).collect()]
    assert stored == ["75011", "1000", "0", "75 011", "2a004", "", "100000", "9" * 25]
    assert [r[0] for r in rows.select(stored_postal_code(F.col("c"), True)).collect()] == codes
