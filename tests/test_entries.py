import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kpiloom.operators import entries

HEADER = ["ORDER_DISP_NO", "A_1", "A", "X"]
ITEM = ["A", "B_C", "TEIKA"]

CASES = [
    "ORDER_DISP_NO=ORDER1&A=1&TEIKA_1=5&TEIKA_2=6&B_C_2=x&A_1=9",
    "TEIKA_10=1&TEIKA_2=2&TEIKA_1=3&TEIKA_2=again",
    "X=a%26b%3Dc&A=p=q&ORDER_DISP_NO",
    "X=%ZZ&A=+%2B",
    "A%5F1=first&A_1=second&TEIKA%5F3=7",
    "%ZZ=1&A_01=1&A_1=2",
    "FREE_ITEM1=no line&_5=odd",
    "&&A=1&",
    "",
]


def both_routes(spark, texts, decode_first):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "record_id string, value string")
    rows = entries.record_entries(df, decode_first=decode_first)
    fields = entries.with_fields(df, decode_first=decode_first, items=True)
    pivoted = entries.pivot_header(rows, HEADER).select("record_id", *HEADER)
    in_place = fields.select("record_id", *[entries.field(n, decode_first).alias(n) for n in HEADER])
    lines = entries.pivot_lines(rows, ITEM).select("record_id", "sequence", *ITEM)
    conditional = entries.pivot_lines_conditional(rows, ITEM).select("record_id", "sequence", *ITEM)
    items = entries.explode_items(fields, ["record_id"]).select(
        "record_id", "sequence", *[entries.item_field(n, decode_first).alias(n) for n in ITEM]
    )
    return [sorted(map(tuple, f.collect()), key=str) for f in (pivoted, in_place, lines, conditional, items)]


@pytest.mark.parametrize("decode_first", [False, True])
def test_routes_agree(spark, decode_first):
    pivoted, in_place, lines, conditional, items = both_routes(spark, CASES, decode_first)
    assert pivoted == in_place
    assert lines == conditional == items


def test_values(spark):
    _, header, _, _, items = both_routes(spark, CASES, False)
    assert header[0] == ("0", "ORDER1", "9", "1", None)
    assert header[2] == ("2", "", None, "p=q", "a&b=c")
    assert header[3] == ("3", None, None, " +", None)
    assert header[4] == ("4", None, "first", None, None)
    assert [r for r in items if r[0] == "1"] == [("1", "1", None, None, "3"), ("1", "10", None, None, "1"), ("1", "2", None, None, "2")]
    assert [r for r in items if r[0] == "6"] == [("6", "5", None, None, None)]


def test_decoding_first_cuts_values(spark):
    _, header, _, _, _ = both_routes(spark, CASES, True)
    # The encoded & and = act as separators, and a value ends at a further =.
    assert header[2] == ("2", "", None, "p", "a")


NAMES = st.sampled_from(["A", "A_1", "A_2", "TEIKA_1", "TEIKA_22", "B_C_2", "ORDER_DISP_NO", "A%5F1", "_3", "", "X"])
PAIRS = st.tuples(NAMES, st.sampled_from(["", "1", "a=b", "%26", "+", "%ZZ", "x y"]), st.booleans())


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(PAIRS, max_size=12), min_size=20, max_size=40))
def test_routes_agree_on_any_record(spark, records):
    texts = ["&".join(f"{n}={v}" if eq else n for n, v, eq in record) for record in records]
    pivoted, in_place, lines, conditional, items = both_routes(spark, texts, False)
    assert pivoted == in_place
    assert lines == conditional == items


def test_one_huge_record(spark):
    """An order with many items is split in time that grows with its length."""

    def seconds(n):
        value = "&".join(f"TEIKA_{i}={i}&QUANTITY_{i}=2" for i in range(n))
        fields = entries.with_fields(spark.createDataFrame([(value,)], "value string"), items=True)
        start = time.perf_counter()
        total = entries.explode_items(fields, []).agg(
            F.count(F.lit(1)), F.sum(entries.item_field("TEIKA").try_cast("long"))
        )
        assert tuple(total.first()) == (n, n * (n - 1) // 2)
        return time.perf_counter() - start

    seconds(100)
    assert seconds(40_000) < 20


def test_record_ids(spark, monkeypatch):
    texts = ["same"] * 23 + ["other", "third", "third"]
    df = spark.createDataFrame([(t,) for t in texts], "value string").repartition(3)

    def ids():
        return sorted(tuple(r) for r in entries.with_record_id(df).select("record_id", "value").collect())

    plain = ids()
    assert len(plain) == len({r[0] for r in plain}) == len(texts)
    assert sorted(r[1] for r in plain) == sorted(texts)
    monkeypatch.setattr(entries, "COPIES_PER_TASK", 5)
    assert ids() == plain
