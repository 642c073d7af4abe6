"""Edge cases with rows written by hand."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tenderline.catalog import ATTRIBUTES
from tenderline.functions.json_fields import explode_elements, latest_price, number_at, text_at
from tenderline.functions.scalar import as_of_year, day_before, epoch_seconds
from tenderline.operators.demand import demand_summary, yearly_demand
from tenderline.operators.filters import changed_since, high_water_mark, known_by
from tenderline.operators.negotiation import (
    compare_with_all,
    negotiation_history,
    next_status,
    numbered_history,
    resend_matches,
)
from tenderline.operators.pivot import attribute_pivot
from tenderline.operators.timeline import repeat_rows
from tenderline.operators.users import user_dimension
from tenderline.sources import rates

FIELDS = [(4, "unit_price"), (13, "manufacturer_name"), (16, "internal_note")]
AS_OF = "2001-06-30"


def day(text):
    return None if text is None else datetime.fromisoformat(text)


def pivot(spark, products, values, pricebooks=((1, 7),)):
    product_rows = [
        (i, 1, "S", True, False, reason, day("2001-01-01"), product, False)
        for i, reason, product in products
    ]
    return attribute_pivot(
        spark.createDataFrame(
            product_rows,
            "id long, pricebook_id long, status string, is_new boolean, cam_approved boolean, "
            "disable_reason string, updated_at timestamp_ntz, product_id long, "
            "is_new_for_contract_owner boolean",
        ),
        spark.createDataFrame(
            values, "pb_product_id long, pb_required_field_id int, field_value string"
        ),
        spark.createDataFrame(FIELDS, "id int, field_name string"),
        spark.createDataFrame(
            [(i, c, "d", "EUR", "r") for i, c in pricebooks],
            "id long, contract_id long, description string, currency string, "
            "customer_reference_number string",
        ),
    )


def test_pivot_takes_the_greatest_text(spark):
    (row,) = pivot(spark, [(1, None, 10)], [(10, 4, "9"), (10, 4, "10")]).collect()
    assert row["unit_price"] == "9"


def test_pivot_keeps_a_product_with_other_fields_only(spark):
    (row,) = pivot(spark, [(1, None, 10)], [(10, 16, "note")]).collect()
    assert [row[c] for c in ATTRIBUTES.values()] == [None] * 15


def test_pivot_drops_products_without_known_values(spark):
    assert pivot(spark, [(1, None, 10), (2, None, 11)], [(11, 99, "x")]).count() == 0


def test_pivot_keeps_rows_with_equal_nulls_apart(spark):
    rows = pivot(spark, [(1, None, 10), (2, None, 11)], [(10, 4, "1"), (11, 4, "2")]).collect()
    assert sorted((r["id"], r["unit_price"]) for r in rows) == [(1, "1"), (2, "2")]


def test_pivot_shares_values_between_rows_of_one_product(spark):
    rows = pivot(spark, [(1, None, 10), (2, "X", 10)], [(10, 4, "1")]).collect()
    assert sorted((r["id"], r["unit_price"]) for r in rows) == [(1, "1"), (2, "1")]


def test_pivot_groups_copies(spark):
    rows = pivot(
        spark, [(1, None, 10)] * 3, [(10, 4, "1")] * 2, pricebooks=[(1, 7), (1, 7)]
    ).collect()
    assert len(rows) == 1


def test_pivot_needs_a_pricebook(spark):
    assert pivot(spark, [(1, None, 10)], [(10, 4, "1")], pricebooks=[(2, 7)]).count() == 0


def elements(spark, text, lenient=False):
    frame = spark.createDataFrame([(text,)], "t string")
    return frame.select(latest_price("t", lenient).alias("p")).first()["p"]


def test_latest_element(spark):
    assert elements(
        spark,
        '[{"id":"1","unit_price":"5"},{"unit_price":"7.5"},{"id":"2","unit_price":"6"}]',
    ) == Decimal("7.50")
    assert elements(
        spark, '[{"id":"9","unit_price":"1"},{"id":10,"unit_price":2}]'
    ) == Decimal("2.00")
    assert elements(spark, "[]") is None
    assert elements(spark, None) is None
    assert elements(spark, '[{"id":"3","unit_price":null}]') is None


def test_json_null_and_missing_path(spark):
    frame = spark.createDataFrame([('{"n":null}',), ("{}",), ('{"n":"x"}',)], "t string")
    assert [r[0] for r in frame.select(text_at("t", "$.n")).collect()] == [None, None, "x"]


def test_malformed_number(spark):
    frame = spark.createDataFrame([('{"n":"abc"}',)], "t string")
    assert frame.select(number_at("t", "$.n", lenient=True)).first()[0] is None
    with pytest.raises(PySparkException):
        frame.select(number_at("t", "$.n")).collect()


def test_explode_elements(spark):
    frame = spark.createDataFrame(
        [(1, '[{"id":"2","unit_price":"5"},{"unit_price":"6"}]'), (2, "[]"), (3, None)],
        "k int, t string",
    )
    rows = explode_elements(frame, "t", ["k"]).collect()
    assert sorted((r["k"], r["element_id"] or 0, str(r["unit_price"])) for r in rows) == [
        (1, 0, "6.00"), (1, 2, "5.00"),
    ]


def test_epoch_ignores_the_session_zone(spark):
    frame = spark.sql("SELECT TIMESTAMP_NTZ '1970-01-02 00:00:01.5' AS t")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert frame.select(epoch_seconds("t")).first()[0] == Decimal("86401.500000")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def history(spark, rows):
    return spark.createDataFrame(
        [(i, i, p, u, day(d)) for i, p, u, d in rows],
        "id long, request_product_id long, draft_value double, history_user_id long, "
        "history_date timestamp_ntz",
    )


def events(spark, rows):
    return spark.createDataFrame(
        [(i, s, day(d)) for i, s, d in rows], "id long, status string, history_date timestamp_ntz"
    )


def negotiated(spark, values, resends=(), products=None, **options):
    products = products or [(1, 5, 9, "COMMERCIAL", "APPROVED", "2000-01-15")]
    return negotiation_history(
        spark.createDataFrame(
            [(i, r, p, t, s, day(d)) for i, r, p, t, s, d in products],
            "id long, request_id long, pricebook_product_id long, type string, status string, "
            "history_date timestamp_ntz",
        ),
        spark.createDataFrame(
            [(i, i, 4) for i in sorted({v[0] for v in values})],
            "id long, request_product_id long, pricebook_value_id int",
        ),
        history(spark, values),
        events(spark, list(resends)),
        spark.createDataFrame(FIELDS, "id int, field_name string"),
        AS_OF,
        **options,
    )


def labels(frame):
    return sorted((str(r["history_date"].date()), r["status_label"]) for r in frame.collect())


def test_compare_with_an_unknown_date(spark):
    rows = compare_with_all(
        history(spark, [(1, 1.0, 1, "2000-01-01"), (1, 2.0, 1, None), (2, 3.0, 1, "2000-01-01")])
    ).collect()
    assert {(r["draft_value"], r["is_latest"]) for r in rows} == {
        (1.0, False), (2.0, False), (3.0, True),
    }


def test_label_order_prefers_the_first_branch(spark):
    assert labels(negotiated(spark, [(1, 1.0, 1, "2000-01-10")])) == [
        ("2000-01-10", "previous_approved")
    ]


def test_numbering_counts_all_rows(spark):
    rows = [(1, 1.0, 1, "2000-01-01"), (1, 1.0, 1, "2000-01-02"), (1, 1.0, 1, "2000-02-01"),
            (1, 1.0, 1, "2000-03-01")]
    assert labels(negotiated(spark, rows)) == [
        ("2000-01-01", "previous_approved"), ("2000-01-02", "previous_approved"),
        ("2000-02-01", "PENDING_3"), ("2000-03-01", "approved"),
    ]


def test_a_later_row_beyond_the_time_limit_still_counts_as_latest(spark):
    rows = [(1, 1.0, 1, "2000-02-01"), (1, 1.0, 1, "2002-01-01")]
    assert labels(negotiated(spark, rows)) == [("2000-02-01", "PENDING_1")]


def test_resends_multiply_rows(spark):
    values = [(1, 1.0, 1, "2000-02-01"), (1, 1.0, 1, "2000-04-01")]
    resends = [(1, "s", "2000-02-01"), (1, "s", "2000-03-01"), (1, "s", "2000-03-05"),
               (2, "s", "2000-09-01")]
    assert labels(negotiated(spark, values, resends)) == [
        ("2000-02-01", "PENDING_1"), ("2000-02-01", "PENDING_2"), ("2000-04-01", "approved"),
    ]
    assert labels(negotiated(spark, values, resends, fan_out=False)) == [
        ("2000-02-01", "PENDING_1"), ("2000-04-01", "approved"),
    ]


def test_other_kinds_and_other_fields_are_left_out(spark):
    technical = [(1, 5, 9, "TECHNICAL", "APPROVED", "2000-01-15")]
    assert negotiated(spark, [(1, 1.0, 1, "2000-02-01")], products=technical).count() == 0


def test_resend_matches(spark):
    (row,) = resend_matches(
        history(spark, [(1, 1.0, 1, "2000-02-01")] * 2),
        events(spark, [(1, "a", "2000-03-01"), (1, "b", "2000-03-01"), (1, "c", None)]),
    ).collect()
    assert (row["matched_rows"], row["joined_rows"]) == (4, 4)


def test_resend_matches_keeps_unknown_products_and_dates(spark):
    rows = resend_matches(
        history(spark, [(None, 1.0, 1, "2000-02-01"), (1, 2.0, 1, None), (1, 2.0, 1, None)]),
        events(spark, [(None, "a", "2000-03-01"), (1, "b", "2000-03-01")]),
    ).collect()
    assert sorted((r["draft_value"], r["matched_rows"], r["joined_rows"]) for r in rows) == [(1.0, 0, 1), (2.0, 0, 2)]


def test_high_water_mark_compares_values(spark):
    assert high_water_mark(spark.createDataFrame([(9,), (10,)], "n int"), "n", "2001-01-01") == "10"


@pytest.mark.parametrize("text", ['[{"id": 1', "no json", '{"id": 1, "unit_price": "2"}'])
def test_text_that_is_no_array(spark, text):
    frame = spark.createDataFrame([(1, text), (2, None), (3, "[]")], "k int, t string")
    with pytest.raises(Exception, match="not an array|MALFORMED|FAILFAST"):
        explode_elements(frame, "t", ["k"]).collect()
    with pytest.raises(Exception, match="not an array|MALFORMED|FAILFAST"):
        frame.select(latest_price("t")).collect()
    kept = explode_elements(frame, "t", ["k"], lenient=True).collect()
    assert [(r["k"], r["malformed"], r["unit_price"]) for r in kept] == [(1, text, None)]
    assert [r[0] for r in frame.select(latest_price("t", True)).collect()] == [None] * 3


def test_malformed_and_failed_responses(spark, tmp_path):
    (tmp_path / "lines").write_text('{"success": true, "rates": {"EUR": 1.0}}\nnot json\n')
    payloads = rates.read_payloads(spark, str(tmp_path / "lines"))
    assert [r[0] for r in rates.malformed(payloads).collect()] == ["not json"]
    (tmp_path / "symbols").write_text('{"success": false}\n{"success": true, "symbols": {"EUR": "Euro"}}\n')
    assert rates.read_symbols(spark, str(tmp_path / "symbols"), False).count() == 1
    with pytest.raises(Exception, match="symbols response failed"):
        rates.read_symbols(spark, str(tmp_path / "symbols"), False, strict=True).collect()


def test_next_status_with_copies_and_unknown_dates(spark):
    rows = next_status(
        events(spark, [(1, "a", "2000-01-01")] * 2 + [(1, "b", "2000-01-02"), (1, "c", None)])
    ).collect()
    assert sorted((r["status"], str(r["next_status"])) for r in rows) == [
        ("a", "a"), ("a", "b"), ("b", "c"), ("c", "None"),
    ]


def test_numbered_history(spark):
    rows = numbered_history(
        history(spark, [(1, 2.0, 1, "2000-01-01")] * 2 + [(1, 1.0, 1, "2000-01-01")])
    ).collect()
    assert sorted((r["draft_value"], r["sequence_label"]) for r in rows) == [
        (1.0, "PENDING_1"), (2.0, "PENDING_2"), (2.0, "PENDING_3"),
    ]


def test_repeat_rows_beyond_one_chunk(spark):
    frame = spark.createDataFrame([("a", 65_537), ("b", 1)], "k string, n long")
    rows = repeat_rows(frame, "n", "i").groupBy("k").agg(
        F.count("i"), F.countDistinct("i"), F.min("i"), F.max("i")
    ).collect()
    assert {tuple(r) for r in rows} == {("a", 65_537, 65_537, 1, 65_537), ("b", 1, 1, 1, 1)}


def materials(spark, rows):
    return spark.createDataFrame(
        [(n, "p", "d", long, Decimal(q), day(f"{y}-05-01").date()) for n, long, y, q in rows],
        "manufacturer_name string, manufacturer_part_no string, description string, "
        "customer_long_description string, po_item_quantity decimal(18,2), "
        "po_item_first_release_date date",
    )


def test_yearly_demand_is_multiplied_unless_corrected(spark):
    bought = materials(spark, [("m", "d", 1999, 5), ("m", "d", 2000, 7)])
    as_defined = {(r["order_year"], int(r["total_quantity"])) for r in yearly_demand(bought).collect()}
    corrected = {
        (r["order_year"], int(r["total_quantity"]))
        for r in yearly_demand(bought, corrected=True).collect()
    }
    assert as_defined == {(1999, 10), (2000, 14)}
    assert corrected == {(1999, 5), (2000, 7)}


def test_yearly_demand_needs_a_partner(spark):
    assert yearly_demand(materials(spark, [("m", "other", 1999, 5)])).count() == 0
    assert yearly_demand(materials(spark, [(None, "d", 1999, 5)])).count() == 0


def test_demand_summary(spark):
    bought = materials(
        spark,
        [("m", "d", 1997, 99), ("m", "d", 1998, 4), ("m", "d", 2000, 8), ("m", "d", 2001, 99)],
    )
    products = spark.createDataFrame(
        [(1, "m", "p", "d"), (2, "x", "p", "d"), (3, None, "p", "d")],
        "id long, manufacturer_name string, manufacturer_part_no string, "
        "customer_long_description string",
    )
    rows = demand_summary(products, yearly_demand(bought, corrected=True), 2001).collect()
    found = {r["contract_product_id"]: (r["last_year_demand"], r["average_demand"]) for r in rows}
    assert found == {1: (Decimal(8), Decimal(6)), 2: (None, None), 3: (None, None)}


def test_user_roles(spark, low_limit):
    for floor in ("1000000", "1"):
        spark.conf.set("spark.tenderline.hotKeyRows", floor)
        rows = user_dimension(
            spark.createDataFrame(
                [(1, "a", "x", 7), (2, "b", "y", None), (3, "c", "z", 8)],
                "id long, first_name string, last_name string, company_id long",
            ),
            spark.createDataFrame([(7, "co")], "id long, name string"),
            spark.createDataFrame(
                [(1, 1), (1, 2), (1, 2), (3, 9)], "user_id long, role_id long"
            ),
            spark.createDataFrame([(1, "r1"), (2, "r2")], "id long, name string"),
        ).collect()
        assert sorted((r["id"], str(r["company_id"]), str(r["user_type"])) for r in rows) == [
            (1, "7", "r1"), (1, "7", "r2"), (1, "7", "r2"), (2, "None", "None"), (3, "None", "None"),
        ]


def test_time_filters(spark):
    rows = history(spark, [(1, 1.0, 1, "2001-06-30"), (2, 1.0, 1, "2001-07-01"), (3, 1.0, 1, None)])
    assert [r["id"] for r in known_by(rows, "history_date", AS_OF).collect()] == [1]
    assert str(high_water_mark(rows, "history_date", AS_OF)) == "2001-07-01 00:00:00"
    empty = rows.where("id > 9")
    assert high_water_mark(empty, "history_date", AS_OF) == datetime(2001, 6, 29)
    assert [r["id"] for r in changed_since(rows, "history_date", "2001-06-30").collect()] == [2]
    assert day_before("2001-07-01 10:00:00") == datetime(2001, 6, 30, 10)
    assert as_of_year(datetime(2001, 7, 1)) == 2001


def payloads(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "success boolean, message string, base string, date string, rates map<string,double>",
    )


def test_rates(spark):
    good = (True, None, "EUR", "2001-06-30", {"USD": 1.5, "GBP": 0.5})
    bad = (False, "quota", None, None, None)
    silent = (None, None, None, None, None)
    mixed = payloads(spark, good, bad, silent)
    assert rates.to_rates(rates.accepted(mixed)).count() == 2
    assert [r["message"] for r in rates.rejected(mixed).collect()] == ["quota", "Unknown error"]
    (row,) = rates.of_currencies(rates.to_rates(rates.all_accepted(payloads(spark, good)))).collect()
    assert tuple(row) == ("USD", 1.5, "EUR", "2001-06-30")
    with pytest.raises(PySparkException, match="quota"):
        rates.to_rates(rates.all_accepted(payloads(spark, bad, good))).collect()


def test_landed_files_with_one_document_each(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"success": true,\n "base": "EUR", "date": "2001-06-30",\n "rates": {"USD": 2}}'
    )
    rows = rates.to_rates(rates.read_payloads(spark, str(tmp_path), whole_files=True)).collect()
    assert [tuple(r) for r in rows] == [("USD", 2.0, "EUR", "2001-06-30")]
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.json").write_text('{"success": true,\n "symbols": {"AED": "Dirham"}}')
    assert [tuple(r) for r in rates.read_symbols(spark, str(tmp_path / "s")).collect()] == [
        ("AED", "Dirham")
    ]
