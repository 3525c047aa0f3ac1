"""Source profile: fields, medians, lines by year."""
from orderlens.contracts import SOURCE_COLUMNS, string_schema
from orderlens.operators import profile

COLS = SOURCE_COLUMNS["order_items"]


def items(spark, *rows):
    return spark.createDataFrame([tuple(r.get(c) for c in COLS) for r in rows], string_schema(COLS))


def line(**kw):
    return {"order_id": "1", "creation_time_utc": "2023-05-01T10:00:00Z", "is_loyalty": "FALSE", "currency": "USD",
            "item_price": "8.00", "item_quantity": "1"} | kw


def test_profile_fields(spark):
    raw = items(spark, line(user_id="u", printed_card_number="C", is_loyalty="TRUE"), line(user_id=" ", item_price="2.50", item_quantity="3"),
                line(order_id="2", item_price="bad"), line(order_id="3", user_id="v", item_price="-1", item_quantity="0", currency="EUR"))
    r = profile.source_profile(raw).first()
    assert (r.rows, r.distinct_orders, r.distinct_users, r.distinct_currencies, r.guest_lines) == (4, 3, 2, 2, 2)
    assert (r.null_cards, r.null_card_share, r.loyalty_true_lines, r.loyalty_false_lines) == (3, 0.75, 1, 3)
    assert (r.price_min, r.price_median, r.price_max, r.qty_median, r.gross_revenue) == (-1.0, 2.5, 8.0, 1, 15.5)
    assert (r.zero_qty_lines, r.negative_price_lines, r.unparsed_price_lines) == (1, 1, 1)


def test_profile_of_no_rows(spark):
    r = profile.source_profile(items(spark)).first()
    assert (r.rows, r.price_median, r.gross_revenue, r.guest_share) == (0, None, None, None)
    assert profile.lines_by_year(items(spark)).collect() == []


def test_lines_by_year(spark):
    raw = items(spark, line(), line(), line(creation_time_utc="2022-01-01T00:00:00.123Z"), line(creation_time_utc="soon"))
    assert {r.year: (r.lines, r.calendar_share) for r in profile.lines_by_year(raw).collect()} == {2023: (2, 0.5), 2022: (1, 0.25), None: (1, None)}
