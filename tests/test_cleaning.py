import datetime

import pytest
from pyspark.sql import functions as F

from lotwise.functions import cleaning as c
from lotwise.functions import fixed


def evaluate(spark, pairs, build, schema="text string"):
    """Inputs and outputs of a column function, in order."""
    rows = [(i, value) for i, (value, _) in enumerate(pairs)]
    df = spark.createDataFrame(rows, f"i int, {schema}")
    got = df.orderBy("i").select(build(F.col("text")).alias("out")).collect()
    return [r.out for r in got], [want for _, want in pairs]


COUNTY = [
    ("Mountain View, Lissaleen, Kilconly, Co. Galway", "Galway", None),
    ("7 Henrietta Street, Dublin 1", "Dublin 1", None),
    ("x, Dublin 6W", "Dublin", None),
    ("x,   West Cork", "Cork", None),
    ("x, County Dublin", "Dublin", None),
    ("x,Co.Galway", "Galway", None),
    ("x, Galway.", "Galway.", None),
    ("x, Co Meath A82ET73", "Meath", None),
    ("x, West Cork. P81P732", "Cork.", None),
    ("x, Mayor Street", "Mayor", None),
    ("The Downs, Delgany", None, "Downs"),
    ("6 Ballyvareen, Kildimo, Co. Limerick, V94xap0", None, "Limerick"),
    ("x, Cork 2", "Cork 2", None),
    ("x, DUBLIN 7", "Dublin 7", None),
    ("x, dublin 7 ", "Dublin 7", None),
    ("x,Co.", "", None),
    ("x,Co.Nowhere", "Nowhere", None),
    ("x,P72 T959", None, None),
    ("Portnashangan", None, None),
    ("x,", None, None),
    ("", None, None),
    (None, None, None),
]


@pytest.mark.parametrize("position", [-1, -2])
def test_county_positions(spark, position):
    pairs = [(a, (last, before)[-position - 1]) for a, last, before in COUNTY]
    got, want = evaluate(spark, pairs, lambda t: c.county_from_address(t, position))
    assert got == want


def test_county_either_prefers_the_last_part(spark):
    pairs = [("a, Cork, Dublin 4", "Dublin 4"), ("a, Cork, T12", "Cork"), ("a, b", None)]
    got, want = evaluate(spark, pairs, c.county_either)
    assert got == want


def test_every_valid_county_has_a_province(spark):
    pairs = [(f"1 Street, Co. {county}", county) for county in fixed.COUNTIES]
    got, want = evaluate(spark, pairs, c.county_from_address)
    assert got == want
    valid, _ = evaluate(spark, pairs, lambda t: c.county_valid(c.county_from_address(t)))
    assert all(valid)


def test_county_valid(spark):
    pairs = [("Dublin 8", True), ("Cork", True), ("Cork 2", False), ("Mayor", False), (None, None)]
    got, want = evaluate(spark, pairs, c.county_valid)
    assert got == want


def test_strip_county_mark(spark):
    pairs = [("Galway.", "Galway"), ("Cork-", "Cork"), ("Cork..", "Cork."), ("Mayo", "Mayo"), (None, None)]
    got, want = evaluate(spark, pairs, c.strip_county_mark)
    assert got == want


def test_floor_area(spark):
    pairs = [
        ("1424ft 2", 132.29),
        ("119.8ft 2", 11.13),
        ("3207ft 2", 297.94),
        ("1,424ft 2", 132.29),
        ("128 - 133m 2", 128.0),
        ("108 - 116m 2", 108.0),
        ("112 - 243m 2", 112.0),
        ("139 - 13m 2", 139.0),
        ("100 - 120m 2", 100.0),
        ("100 - 118m 2", 118.0),
        ("1000 - 1100ft 2", 102.19),
        ("240m 2", 240.0),
        ("12yd 2", None),
        ("m 2", None),
        ("", None),
        (None, None),
    ]
    got, want = evaluate(spark, pairs, c.floor_area_m2)
    assert got == want


def test_area_gate(spark):
    pairs = [("240m 2", True), ("9ft 2", True), ("240m 2 ", False), ("3 ac", False), (None, None)]
    got, want = evaluate(spark, pairs, c.is_area_text)
    assert got == want


def test_price_to_int(spark):
    pairs = [
        ("550000", 550000), (" 550000 ", 550000), ("-5", -5), ("4.5", None), ("3e5", None),
        ("1_000", None), ("PoA", None), ("", None), ("99999999999999999999", None), (None, None),
    ]
    got, want = evaluate(spark, pairs, c.price_to_int)
    assert got == want


PRICE_TEXTS = [
    ("€550,000", 550000, "550000", "parsed"),
    ("AMV: €250,000", 250000, "250000", "parsed"),
    ("€1,200,000 ", 1200000, "1200000", "parsed"),
    ("€ 5", 5, "5", "parsed"),
    ("Price on Application", None, "PoA", "on_application"),
    ("\n POA\t", None, "PoA", "on_application"),
    (" AMV: Price on Application", None, "PoA", "on_application"),
    ("From €300,000 to €350,000", None, "From €300,000 to €350,000", "other"),
    (" Sold ", None, "Sold", "other"),
    (None, None, None, None),
]


def test_price_texts(spark):
    known, label = fixed.PORTAL_B_ON_APPLICATION, fixed.PORTAL_B_SENTINEL
    for n, build in [
        (1, c.price_from_text),
        (2, lambda t: c.price_or_sentinel(t, known, label)),
        (3, lambda t: c.price_status(t, known)),
    ]:
        got, want = evaluate(spark, [(row[0], row[n]) for row in PRICE_TEXTS], build)
        assert got == want


def test_acres(spark):
    got, _ = evaluate(spark, [(2.5, None)], c.acres_to_m2, "text double")
    assert got == [10116.951964712072]


def test_dates(spark):
    day = datetime.date(2022, 12, 9)
    pairs = [
        ("2022-12-09", day), (" 12/09/2022 ", day), ("9 Dec 2022", day), ("9 December 2022", day),
        ("Dec 9, 2022", day), ("31/12/2022", datetime.date(2022, 12, 31)), ("soon", None), (None, None),
    ]
    got, want = evaluate(spark, pairs, c.date_from_text)
    assert got == want


def test_percent_and_sign(spark):
    pairs = [("(-3.88%)", -3.88), ("(+9.41%)", 9.41), ("(12.0%)", 12.0), ("", None), (None, None)]
    got, want = evaluate(spark, pairs, c.percent_from_text)
    assert got == want
    signed, _ = evaluate(
        spark, [(-3.88, None), (3.88, None), (0.0, None)],
        lambda p: c.signed_change(F.lit(20000), p), "text double",
    )
    assert signed == [-20000, 20000, 20000]


def test_prefix_and_lookup_key(spark):
    pairs = [("Dublin 8", "Dublin"), ("Dubliner", "Dublin"), ("Cork", "Cork"), (None, None)]
    got, want = evaluate(spark, pairs, lambda t: c.collapse_prefix(t, "Dublin"))
    assert got == want
    pairs = [("Dublin 8", "Dublin"), ("Dubliner", "Dubliner"), ("Cork 2", "Cork 2"), (None, None)]
    got, want = evaluate(spark, pairs, c.lookup_key)
    assert got == want


def test_dates_in_all_spellings(spark):
    same = ["December 9, 2022", "9th December 2022", "Fri 9 Dec 2022", "9-Dec-2022", "2022/12/09", "2022-12-09 00:00:00",
            "12/9/22", "12-09-2022", "Dec 9, 2022", "9 Dec 2022"]
    df = spark.createDataFrame([(t,) for t in [*same, "soon", None]], "t string")
    got = df.select(c.date_from_text(F.col("t")), c.date_status(F.col("t"))).collect()
    assert [str(r[0]) for r in got[:-2]] == ["2022-12-09"] * len(same)
    assert [r[1] for r in got[-3:]] == ["parsed", "other", None] and got[-2][0] is None


def test_blanks_of_any_kind(spark):
    df = spark.createDataFrame([("€250,000\u00a0",), ("€\u00a0250,000",), ("€\u2009250,000",)], "t string")
    assert [r[0] for r in df.select(c.price_from_text(F.col("t"))).collect()] == [250000] * 3
