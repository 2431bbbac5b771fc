"""Golden values for decoding, bands and text rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wrenchlake.functions import bands, text, vehicle
from wrenchlake.operators.decode import DECODED, decode_vehicle

CODE = "ME3{platform}{size}000{ninth}{year}{eleventh}000001"


def chassis(platform="U", size="3", ninth="0", year="K", eleventh="A"):
    return CODE.format(platform=platform, size=size, ninth=ninth, year=year, eleventh=eleventh)


DECODE_CASES = [
    # chassis, product, model, type, name, plant, month, year, country
    (chassis(), "classic 350", "CLASSIC", "UCE", "CLASSIC 350", "TVT", 1, 2019, "Domestic"),
    (chassis("D", "4", "1", "L", "N"), "Himalayan,BS6", "HIMALAYAN", "HIMALAYAN", "HIMALAYAN 410", "ORG", 12, 2020, "Domestic"),
    (chassis("P", "7", "K", "O", "2"), "Continental-GT", "CONTINENTAL", "TWINS", "CONTINENTAL 650", "VLM", 9, 2023, "Domestic"),
    (chassis("J", "3", "B", "N", "0"), "CL 350", "CLASSIC", "METEOR", "CLASSIC 350", "TVT", 2, 2022, "Domestic"),
    (chassis("J", "3", "B", "N", "0"), "Signals classic", "NEW CLASSIC", "NEW CLASSIC", "NEW CLASSIC 350", "TVT", 2, 2022, "Domestic"),
    (chassis("X", "8", "0", "Z", "J"), "GT650", "GT", "NA", "NA", "NA", 1, 1900, "International"),
    (chassis("U", "3", "9", "I", "I"), "350 x", "", "UCE", " 350", "NA", 1, 1900, "Domestic"),
    (chassis().lower(), "  gt x", "GT", "UCE", "GT 350", "TVT", 1, 2019, "Domestic"),
    (chassis()[:16], "Gt", "GT", "NA", "GT 350", "TVT", 1, 2019, "Domestic"),
    (chassis() + "9", "Gt", "GT", "NA", "GT 350", "TVT", 1, 2019, "Domestic"),
    (chassis("J")[:16], "classic", "CLASSIC", "NA", "CLASSIC 350", "NA", 1, 2019, "Domestic"),
    (chassis(), None, "", "NA", " 350", "TVT", 1, 2019, "Domestic"),
    (chassis(), "", "", "NA", " 350", "TVT", 1, 2019, "Domestic"),
    (None, "Gt", "GT", "NA", "NA", "NA", 1, 1900, "International"),
]


def test_decode_vehicle(spark):
    data = [(i, c[0], c[1]) for i, c in enumerate(DECODE_CASES)]
    df = spark.createDataFrame(data, "id int, VehicleChassisNumber string, Product string")
    decoded = decode_vehicle(df).orderBy("id").select(*DECODED).collect()
    for case, row in zip(DECODE_CASES, decoded):
        _, _, model, kind, name, plant, month, year, country = case
        assert tuple(row) == (model, kind, name, plant, month, year, dt.date(year, month, 1), country), case


def test_model_word(spark):
    cases = {"continental gt": "CONTINENTAL", "CL x": "CLASSIC", "xHimalayan": "HIMALAYAN", "Interceptor650": "INTERCEPTOR",
             "42 abc9": "ABC", "650 007": None, "": None, None: "NA"}
    df = spark.createDataFrame([(k,) for k in cases], "p string").select("p", vehicle.model_word(F.col("p")).alias("m"))
    assert {r.p: r.m for r in df.collect()} == cases


@pytest.mark.parametrize(
    "kms, label",
    [(None, "NA"), (-1, "NA"), (0, "(A) 0 - 500"), (500, "(A) 0 - 500"), (501, "(B) 500 - 3000"),
     (30000, "(H) 25000 - 30000"), (30001, "(I) 30000 & Above")],
)
def test_kms_group(spark, kms, label):
    df = spark.createDataFrame([(kms,)], "k bigint")
    assert df.select(bands.kms_group(F.col("k"))).first()[0] == label


@pytest.mark.parametrize(
    "kms, days, name, label",
    [
        (700, 1000, "CLASSIC 350", "Before Service-1"),
        (900, 75, "CLASSIC 350", "Before Service-1"),
        (900, 76, "CLASSIC 350", "Between Service-1 & Service-2"),
        (5501, None, "CLASSIC 350", "Between Service-2 & Service-3"),
        (5501, None, "continental 650", "Between Service-1 & Service-2"),
        (30701, None, "INTERCEPTOR 650", "After Service-4"),
        (-1, None, "CLASSIC 350", "NA"),
        (None, None, "CLASSIC 350", "NA"),
        (-1, -1, "CLASSIC 350", "NA"),
        (-1, 591, "NA", "After Service-4"),
        (100, 10, None, None),
    ],
)
def test_service_schedule(spark, kms, days, name, label):
    df = spark.createDataFrame([(kms, days, name)], "k bigint, d bigint, m string")
    assert df.select(bands.service_schedule(F.col("k"), F.col("d"), F.col("m"))).first()[0] == label


def test_vehicle_age_is_total(spark):
    df = spark.range(-5, 1200).select(bands.vehicle_age(F.col("id")).alias("a"))
    assert df.filter("a IS NULL").count() == 0
    counts = {r.a: r["count"] for r in df.groupBy("a").count().collect()}
    assert counts == {"NA": 5, "(A) 0 - 3 Months": 91, "(B) 3 - 12 Months": 275, "(C) 12 - 24 Months": 365,
                      "(D) 24 - 36 Months": 365, "(E) 36 Months & Above": 104}


def test_text_rules(spark):
    df = spark.createDataFrame([("naïve ügly", "pump RJC 12", "a\nb\r", "two-way tow")], "a string, b string, c string, d string")
    row = df.select(
        text.ascii_only(F.col("a")), text.before_marker(F.col("b"), "RJC"), text.before_marker(F.col("a"), "RJC"),
        text.one_line(F.col("c")), text.relabel_if_contains(F.col("d"), "TOW", "TOWING"),
        text.relabel_if_contains(F.col("a"), "TOW", "TOWING"),
    ).first()
    assert tuple(row) == ("nave gly", "pump ", "naïve ügly", "a b", "TOWING", "NAÏVE ÜGLY")


def test_parse_literal(spark):
    cases = [
        "[{'Part No': 'P1', 'Part Description': 'x'}, {'Part No': 'P2', 'Part Description': None}]",
        "[{'Part No': 'P1',\n 'Part Description': \"rider's None\"}]",
        "[]",
    ]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    parsed = [r[0] for r in df.select(text.parse_literal(F.col("t"), text.PART_LIST)).collect()]
    assert [[tuple(p) for p in items] for items in parsed] == [[("P1", "x"), ("P2", None)], [("P1", "rider's None")], []]
    joined = df.select(text.joined_field(text.parse_literal(F.col("t"), text.PART_LIST), "Part No")).first()[0]
    assert joined == "P1,P2"


def test_parse_literal_spellings(spark):
    """What Python reads as a list is read alike; anything else fails or is NULL, as asked."""
    import ast

    import pytest

    lists = [
        "['a',         None          , 'b']", "['x, None, y', None]", "['a', 'b', ]", "[\"it's\", 'say \"None\"', None,]", "[ None ]", "[]",
        "['a\\\\b', 'None']", "['" + "long " * 5000 + "']",
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, v string")
    got = {r.i: r.x for r in df.select("i", text.parse_literal(F.col("v"), text.TEXT_LIST).alias("x")).collect()}
    assert got == {i: ast.literal_eval(v) for i, v in enumerate(lists)}
    odd = spark.createDataFrame([("['a'",), ("nothing",), (None,), ("  ",)], "v string")
    assert [r.x for r in odd.select(text.parse_literal(F.col("v"), text.TEXT_LIST, strict=False).alias("x")).collect()] == [None] * 4
    with pytest.raises(Exception, match="not a list"):
        odd.select(text.parse_literal(F.col("v"), text.TEXT_LIST)).collect()
