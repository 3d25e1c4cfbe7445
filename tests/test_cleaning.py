import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from hearth.functions import cleaning as fc
from hearth.functions import dates as fd
from hearth.functions import predicates as fp


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {typ}")


def test_clean_price_edge_rows(spark):
    df = one_col(spark, ["€350,000.00", "", "N/A", None, "�1,234.5"])
    got = [r[0] for r in df.select(fc.clean_price("c")).collect()]
    assert got == [Decimal("350000.00"), None, None, None, Decimal("1234.50")]


def test_parse_date_invalid_is_null(spark):
    df = one_col(spark, ["05/01/2020", "31/02/2020", None])
    got = [r[0] for r in df.select(fc.parse_date("c")).collect()]
    assert got == [dt.date(2020, 1, 5), None, None]


def test_parse_iso_timestamp(spark):
    df = one_col(spark, ["2024-06-30T10:11:12.000Z", "not a time"])
    got = [r[0] for r in df.select(fc.parse_iso_timestamp("c").isNotNull()).collect()]
    assert got == [True, False]


def test_flags(spark):
    df = one_col(spark, ["Yes", "No", None, "Maybe"])
    inv = [r[0] for r in df.select(fc.invert_flag("c")).collect()]
    assert inv == ["No", "Yes", "No", "No"]
    st = [r[0] for r in df.select(fc.sale_type("c")).collect()]
    assert st == ["VAT Exclusive", "VAT Inclusive", "VAT Inclusive", "VAT Inclusive"]


def test_property_type_first_marker_wins(spark):
    df = one_col(spark, ["Second-Hand Dwelling house /Apartment", "Teach Atháimhe",
                         "Teach Nua", "Nua agus Ath", None])
    got = [r[0] for r in df.select(fc.normalise_property_type("c")).collect()]
    assert got == [fc.SECOND_HAND_LABEL, fc.SECOND_HAND_LABEL, fc.NEW_DWELLING_LABEL,
                   fc.SECOND_HAND_LABEL, None]


def test_tri_state(spark):
    df = one_col(spark, [True, False, None], "boolean")
    assert [r[0] for r in df.select(fc.tri_state_label("c")).collect()] == \
        ["Yes", "No", "Not recorded"]
    assert [r[0] for r in df.select(fc.tri_state_flag("c")).collect()] == [1, 0, None]


def test_null_helpers(spark):
    df = one_col(spark, ["  x ", None])
    assert [r[0] for r in df.select(fc.null_to_label("c")).collect()] == ["x", "Not recorded"]
    k = one_col(spark, [5, None], "int")
    assert [r[0] for r in k.select(fc.null_to_unknown_key("c")).collect()] == [5, 0]


def test_decision_outcome_order(spark):
    texts = ["Grant Permission", "Refuse", "REFUSED CONDITIONAL", "INVALID GRANT",
             "Withdrawn by applicant", "split decision", "Exempt", "conditional",
             "Approved", "Further Information requested", "req ai", "Not recorded",
             "N/A", None, "Declared void"]
    df = one_col(spark, texts)
    got = [r[0] for r in df.select(fc.decision_outcome("c")).collect()]
    assert got == ["Granted", "Refused", "Refused", "Invalid", "Withdrawn", "Split decision",
                   "Exempt", "Granted", "Granted", "Further information",
                   "Further information", "No decision recorded", "No decision recorded",
                   "No decision recorded", "Other"]
    rec = df.select(fc.decision_recorded(fc.decision_outcome("c"))).collect()
    assert [r[0] for r in rec][-4:] == [0, 0, 0, 1]


def test_local_authority_to_county(spark):
    names = list(fc.AUTHORITY_COUNTY) + ["Mayo County Council", "Unknown Body", None]
    df = one_col(spark, names)
    got = [r[0] for r in df.select(fc.local_authority_to_county("c")).collect()]
    assert got[:10] == list(fc.AUTHORITY_COUNTY.values())
    assert got[10:] == ["Mayo", "Unknown Body", None]


def test_map_county_frame(spark):
    df = spark.createDataFrame([("A",), ("B County Council",)], "LocalAuthority string")
    m = spark.createDataFrame([("A", "Alpha")], "a string, c string")
    got = sorted(r.County for r in fc.map_county_frame(df, "LocalAuthority", m).collect())
    assert got == ["Alpha", "B"]


def test_quarter_attributes(spark):
    df = one_col(spark, ["2024Q3", "2024Q5", "bad", None])
    got = df.select(fd.quarter_year("c"), fd.quarter_number("c"), fd.quarter_start("c")).collect()
    assert tuple(got[0]) == (2024, 3, dt.date(2024, 7, 1))
    assert tuple(got[1]) == (2024, None, None)
    assert tuple(got[2]) == (None, None, None)


def test_date_key_and_seconds(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31),)], "d date")
    assert df.select(fd.date_key("d")).first()[0] == 20240131
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0, 900000),
                                 dt.datetime(2024, 1, 1, 0, 0, 1, 100000))],
                               "a timestamp_ntz, b timestamp_ntz")
    # boundary count like DATEDIFF(SECOND): 00.9 → 01.1 is 1 second
    assert ts.select(fd.seconds_between("a", "b")).first()[0] == 1


def test_invalid_coordinates_borders(spark):
    df = spark.createDataFrame(
        [(51.0, -11.0), (56.0, -5.0), (None, -6.0), (50.99, -6.0), (52.0, -4.9)],
        "Latitude double, Longitude double")
    got = [r[0] for r in df.select(fp.invalid_coordinates()).collect()]
    assert got == [False, False, True, True, True]


def test_truncate_and_audit(spark):
    df = one_col(spark, ["x" * 5000])
    assert df.select(F.length(fc.truncate_text("c", 4000))).first()[0] == 4000
    a = fc.add_audit_columns(df, "PPR", "2024-06-30 00:00:00", date_col="LoadDate")
    r = a.select("SourceSystem", "LoadDate").first()
    assert r.SourceSystem == "PPR" and r.LoadDate == dt.date(2024, 6, 30)
