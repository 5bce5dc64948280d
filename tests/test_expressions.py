from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from kpiloom import contracts
from kpiloom.functions import codes, dates, measures, text

C = F.col


def one(rows, values, column, kind="string"):
    return [r[0] for r in rows(f"x {kind}", [(v,) for v in values], column)]


def test_form_decode_keeps_going_on_malformed_text(rows):
    assert one(rows, ["a+b%20c", "%E3%81%82", "%ZZ", "", None], text.form_decode(C("x"))) == ["a b c", "あ", None, "", None]


def test_number_suffix_and_base_name(rows):
    names = ["TEIKA_1", "ORDER_D_FREE_ITEM31_12", "FREE_ITEM1", "_5", "A_", "A_01", "", None]
    assert one(rows, names, text.seq_suffix(C("x"))) == ["1", "12", None, "5", None, "01", None, None]
    assert one(rows, names, text.base_name(C("x"))) == ["TEIKA", "ORDER_D_FREE_ITEM31", None, None, None, "A", None, None]


def test_order_prefix(rows):
    assert one(rows, ["ORDER12", "e12", "12e", "ORDERe1", None], text.strip_order_prefix(C("x"))) == ["12", "12", "12e", "e1", None]


def test_lead_code(rows):
    assert one(rows, ["1-x", "x1", "", None, " 1"], text.lead_code(C("x"))) == [1, None, None, None, None]


def test_blank_null_and_sentinel(rows):
    values = ["", None, "(NULL)", "a"]
    assert one(rows, values, text.blank_to_null(C("x"))) == [None, None, "(NULL)", "a"]
    assert one(rows, values, text.null_text(C("x"))) == ["", "NULL", "(NULL)", "a"]
    assert one(rows, values, text.sentinel_text(C("x"))) == ["", "NULL", "NULL", "a"]
    assert one(rows, values, text.is_blank(C("x"))) == [True, True, False, False]


def test_two_decimal_text(rows):
    values = [1.0, 1.005, 0.125, -2.5, None, 1e7]
    assert one(rows, values, text.fmt2(C("x")), "double") == ["1.00", "1.01", "0.13", "-2.50", None, "10000000.00"]
    assert one(rows, [3, None], text.fmt2(C("x")), "int") == ["3.00", None]
    assert one(rows, ["1.5", "1.555", "n/a", "", None], text.dec2_text(C("x"))) == ["1.50", "1.56", None, None, None]


def test_casts_give_null_on_malformed_text(rows):
    values = ["1.5", "n/a", "", None, " 2 "]
    assert one(rows, values, text.to_double(C("x"))) == [1.5, None, None, None, 2.0]
    assert one(rows, ["7", "7.9x", ""], text.to_int(C("x"))) == [7, None, None]


@pytest.mark.parametrize(
    ("pattern", "value", "expected"),
    [
        (dates.FEED_DATE, "2024/05/01", "2024-05-01 00:00:00"),
        (dates.FEED_DATE, "2024/5/1", None),
        (dates.FLAT_SALES_TIME, "2024/05/01 9:5:3", "2024-05-01 09:05:03"),
        (dates.FLAT_CANCEL_TIME, "5/1/2024 9:05", "2024-05-01 09:05:00"),
        (dates.FLAT_CANCEL_DATE, "12/31/2024", "2024-12-31 00:00:00"),
        (dates.CONFORMED_TIME, "2024/05/01 09:05", "2024-05-01 09:05:00"),
        (dates.CONFORMED_TIME, "2024/5/1 9:5", "2024-05-01 09:05:00"),
        (dates.CONFORMED_TIME, "", None),
        (dates.FEED_DATE, "2024/02/30", None),
    ],
)
def test_time_layouts(rows, pattern, value, expected):
    assert one(rows, [value], dates.norm_ts(C("x"), pattern)) == [expected]


def test_iso_time_has_no_zone_shift(rows):
    values = ["2024-05-01T10:00:00", "2024-05-01 10:00:00.9", "2024-05-01", "n/a", "", None]
    first = "2024-05-01 10:00:00"
    assert one(rows, values, dates.norm_iso(C("x"))) == [first, first, "2024-05-01 00:00:00", None, None, None]


def test_file_date(rows):
    paths = ["s3://b/CN-20240501-Sales-1.json", "file:/x-20230101-y/HK-20240502-Cancel-12.json", "plain.json", None]
    assert one(rows, paths, dates.file_date(C("x"))) == [date(2024, 5, 1), date(2024, 5, 2), None, None]


def test_request_window_defaults():
    now = datetime(2024, 5, 2, 1, 0, tzinfo=timezone.utc)  # 09:00 at UTC+8
    assert dates.request_window(now=now) == (datetime(2024, 5, 1), datetime(2024, 5, 2))
    assert dates.request_window("2024-04-01 06:00:00", "nonsense", now) == (datetime(2024, 4, 1, 6), datetime(2024, 5, 2))
    assert dates.request_window("", "2024-04-03 12:00:00", now) == (datetime(2024, 4, 2, 12), datetime(2024, 4, 3, 12))
    late = datetime(2024, 5, 1, 17, 0, tzinfo=timezone.utc)  # already the next day at UTC+8
    assert dates.request_window(now=late)[1] == datetime(2024, 5, 2)


def test_labels(rows):
    codes_in = [1, 2, 3, 4, 5, 0, None]
    two = codes.device_label(C("x"), contracts.DEVICE_LABELS_2, default=C("x"))
    assert one(rows, codes_in, two, "int") == ["Desktop", "Mobile Phone", "3", "4", "5", "0", None]
    four = codes.device_label(C("x"))
    assert one(rows, codes_in, four, "int") == ["DESKTOP", "MOBILE", "MOBILE PHONE", "TABLET", "OTHER", "OTHER", "OTHER"]
    assert one(rows, ["C", "L", "", "c", None], codes.store_from_type(C("x"))) == ["57037", "56001", "57036", "57036", "57036"]
    assert one(rows, ["07301", "07308", "07399", None], codes.country_from_store(C("x"))) == ["CN", "HK", None, None]


def test_flags_and_amounts(rows):
    values = ["", None, "a", "5"]
    assert one(rows, values, codes.coupon_flag(C("x"))) == ["N", "N", "Y", "Y"]
    assert one(rows, values, codes.gift_flag(C("x"))) == [0, 1, 1, 1]
    assert one(rows, values, measures.amount_or_zero(C("x"))) == [0.0, None, None, 5.0]
    assert one(rows, values, measures.amount_or_zero(C("x"), null_is_zero=True)) == [0.0, 0.0, None, 5.0]
    assert one(rows, values, codes.tender_label(C("x"), "other")) == ["", "OTHER", "a", "5"]
    with pytest.raises(ValueError):
        codes.tender_label(C("x"), "none")


RAW = (
    "SEIKYU string, TAX string, DAIBIKI string, SORYO string, COUPON_WARIBIKI string, FREE_ITEM11 string, "
    "SHIRE_SUM string, TEIKA_SUM string, TEIKA_SUM_TAX string, FREE_ITEM33 string, T string"
)
FULL = ("1100", "100", "30", "20", "10", "5", "900", "800", "80", "7", "C")


def measure(rows, column, **changes):
    names = [part.split()[0] for part in RAW.split(", ")]
    record = tuple(changes.get(name, value) for name, value in zip(names, FULL, strict=True))
    return rows(RAW, [record], column)[0][0]


def test_order_measures(rows):
    assert measure(rows, measures.demand_gross()) == 880.0
    assert measure(rows, measures.demand_net_normal()) == 935.0
    assert measure(rows, measures.demand_net_normal(), SORYO=None) is None
    assert measure(rows, measures.demand_net_normal(), SORYO="x") is None
    assert measure(rows, measures.demand_net_recovery()) == 1000.0
    assert measure(rows, measures.demand_net_recovery(), DAIBIKI="") is None
    assert measure(rows, measures.header_discount(C("T"), "FREE_ITEM33")) == 107.0
    assert measure(rows, measures.header_discount(C("T"), "FREE_ITEM33"), T="L") == 100.0
    assert measure(rows, measures.header_discount(C("T"), "FREE_ITEM33"), T=None, FREE_ITEM33=None) == 100.0
    assert measure(rows, measures.header_cancel_discount(C("T"))) == 107.0
    assert measure(rows, measures.header_cancel_discount(C("T")), T="L") == 907.0
    assert measure(rows, measures.line_cancel_discount(C("T"))) == 107.0
    assert measure(rows, measures.line_cancel_total(F.lit(3))) == 2640.0
    assert measure(rows, measures.gift_tax(F.lit(50.0))) == 5.0


def test_line_measures(rows):
    discount = measures.line_discount(C("t"), C("list"), C("price"), C("q"), C("extra"))
    data = [("C", 10.0, 8.0, 2.0, 1.0), ("L", 10.0, 8.0, 2.0, 1.0), ("L", 10.0, 8.0, 2.0, None), ("C", 10.0, 8.0, 2.0, None)]
    assert [r[0] for r in rows("t string, list double, price double, q double, extra double", data, discount)] == [6.0, 4.0, 4.0, None]
    net = rows("TEIKA string, QUANTITY string", [("5", "3"), ("5", "")], measures.line_net_normal())
    assert [r[0] for r in net] == [15.0, None]
    assert rows("ORDER_D_SHIRE_PRICE string", [("10",)], measures.line_net_recovery())[0][0] == pytest.approx(11.0)
