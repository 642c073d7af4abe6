"""One key with a third of all rows, and a third of all rows being copies."""

import pytest
from pyspark.sql import functions as F

from tenderline.operators import balance, negotiation
from tenderline.operators.balance import HOT_ROWS_CONF, hot_codes, join_to_unique, lookup_join
from tenderline.operators.timeline import sort_rows, with_slot
from tenderline.operators.users import user_dimension
from tests.compare import of_duckdb, of_spark

import duckdb

ROWS = 3000


def crowded(spark):
    """A third under key 1 at different times, a third copies of one row, a third spread."""
    n = F.col("n")
    key = F.when(n % 3 == 0, 1).when(n % 3 == 1, 2).otherwise(n % 211 + 10)
    moment = F.when(n % 3 == 1, F.lit("2000-05-05 00:00:00").cast("timestamp_ntz")).otherwise(
        F.expr("TIMESTAMP_NTZ '2000-01-01 00:00:00' + make_dt_interval(0, CAST(n * 7 % 4000 AS INT))")
    )
    return spark.range(ROWS).withColumnRenamed("id", "n").select(
        key.cast("long").alias("id"),
        key.cast("long").alias("request_product_id"),
        F.when(n % 3 == 1, 5.0).otherwise((n % 17).cast("double")).alias("draft_value"),
        F.when(n % 3 == 1, 5).otherwise(n % 5).cast("long").alias("history_user_id"),
        F.when(n % 3 == 1, "same").otherwise(F.concat(F.lit("s"), n % 4)).alias("status"),
        F.when(n % 97 == 0, None).otherwise(moment).alias("history_date"),
    )


@pytest.fixture(scope="module")
def rows(spark):
    frame = crowded(spark)
    con = duckdb.connect()
    con.register("history", frame.toPandas())
    return frame, con


@pytest.fixture(autouse=True)
def floor(spark):
    """The number of rows from which a key is hot; set for each test, as some change it."""
    spark.conf.set(HOT_ROWS_CONF, "500")
    yield
    spark.conf.unset(HOT_ROWS_CONF)


def test_hot_keys_are_found(spark, rows):
    frame, _ = rows
    codes = hot_codes(frame, ["id"])
    expected = [r[0] for r in spark.sql("SELECT xxhash64(1L) UNION ALL SELECT xxhash64(2L)").collect()]
    assert codes == sorted(expected)


def test_hot_keys_are_found_from_a_part_of_the_rows(spark):
    spark.conf.set(HOT_ROWS_CONF, "20000")
    frame = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    assert len(hot_codes(frame, ["k"])) == 1


def test_comparison_with_all(rows):
    frame, con = rows
    assert of_spark(negotiation.compare_with_all(frame)) == of_duckdb(con, """
        SELECT request_product_id, draft_value, history_user_id, history_date,
               coalesce(history_date >= ALL (SELECT o.history_date FROM history o
                   WHERE o.request_product_id = h.request_product_id), FALSE) AS is_latest
        FROM history h""")


def test_next_status(rows):
    frame, con = rows
    assert of_spark(negotiation.next_status(frame)) == of_duckdb(con, """
        SELECT id, status, history_date, LEAD(status) OVER (
            PARTITION BY id ORDER BY history_date NULLS LAST, status) AS next_status
        FROM history""")


def test_numbering(rows):
    frame, con = rows
    assert of_spark(negotiation.numbered_history(frame)) == of_duckdb(con, """
        SELECT request_product_id, draft_value, history_user_id, history_date,
               'PENDING_' || row_number() OVER (PARTITION BY request_product_id
                   ORDER BY history_date NULLS LAST, draft_value, history_user_id) AS sequence_label
        FROM history""")


def test_an_unknown_key_can_be_hot_too(rows):
    frame, con = rows
    blank = frame.withColumns(
        {c: F.when(F.col(c) != 1, F.col(c)) for c in ("id", "request_product_id")}
    )
    assert of_spark(negotiation.next_status(blank)) == of_duckdb(con, """
        SELECT id, status, history_date, LEAD(status) OVER (
            PARTITION BY id ORDER BY history_date NULLS LAST, status) AS next_status
        FROM (SELECT * REPLACE (nullif(id, 1) AS id) FROM history)""")
    assert of_spark(negotiation.numbered_history(blank)) == of_duckdb(con, """
        SELECT nullif(request_product_id, 1) AS request_product_id, draft_value, history_user_id,
               history_date, 'PENDING_' || row_number() OVER (PARTITION BY request_product_id
                   ORDER BY history_date NULLS LAST, draft_value, history_user_id) AS sequence_label
        FROM history""")


def test_sorting(rows):
    frame, con = rows
    order = ["id", "history_date", "draft_value", "history_user_id", "status"]
    found = [tuple(r) for r in sort_rows(frame.select(*order), order).collect()]
    wanted = con.execute(
        f"SELECT {', '.join(order)} FROM history ORDER BY " + ", ".join(f"{c} NULLS LAST" for c in order)
    ).fetchall()
    assert found == wanted


def test_later_resends(rows):
    frame, con = rows
    assert of_spark(negotiation.resend_matches(frame, frame)) == of_duckdb(con, """
        SELECT h.request_product_id, h.draft_value, h.history_user_id, h.history_date,
               count(e.id) AS matched_rows, count(*) AS joined_rows
        FROM history h LEFT JOIN history e
          ON e.id = h.request_product_id AND h.history_date < e.history_date
        GROUP BY ALL""")


def in_one_hour(spark, dated: bool):
    """Distinct rows of one key, all within one clock hour or all without a date, and some of another."""
    n = F.col("id")
    moment = F.expr("TIMESTAMP_NTZ '2000-01-01 10:00:00' + make_dt_interval(0, 0, 0, id % 1800)")
    key = F.when(n % 4 == 0, n % 50 + 10).otherwise(1).cast("long")
    return spark.range(ROWS).select(
        key.alias("request_product_id"),
        F.when(n % 7 == 0, -0.0).otherwise((n % 400).cast("double")).alias("draft_value"),
        (n % 900).alias("history_user_id"),
        (moment if dated else F.lit(None).cast("timestamp_ntz")).alias("history_date"),
        key.alias("id"), F.concat(F.lit("s"), n).alias("status"),
    )


@pytest.mark.parametrize("dated", [True, False])
def test_one_hour_of_one_key_is_cut_into_several_slots(spark, dated):
    frame = in_one_hour(spark, dated)
    codes = hot_codes(frame, ["id"])
    assert len(codes) == 1
    order = ["history_date", "status"]
    slots = with_slot(frame, "id", order, codes)
    hot = [r["rows"] for r in slots.where("id = 1").groupBy("slot").agg(F.count("*").alias("rows")).collect()]
    assert len(hot) == 8 and max(hot) < 3 * sum(hot) / len(hot)
    assert slots.where("id <> 1 AND slot IS NOT NULL").isEmpty()
    events = frame.select("id", "status", "history_date")
    results = []
    for floor in ("500", "5000000"):
        spark.conf.set(HOT_ROWS_CONF, floor)
        out = [
            negotiation.next_status(events), negotiation.numbered_history(frame),
            negotiation.resend_matches(frame, events.limit(600)),
        ]
        results.append([sorted(repr(tuple(r)) for r in df.collect()) for df in out])
    assert results[0] == results[1]


def test_hot_and_cold_results_have_the_same_bits(spark):
    zero = [(1, v, u, d) for v in (-0.0, 0.0, float("nan"), None) for u in (1, 1, 2) for d in ("2000-01-01 05:10:00", None)]
    frame = spark.createDataFrame(
        zero + [(None, -0.0, 1, "2000-01-01 05:10:00"), (None, 0.0, 1, None)],
        "request_product_id long, draft_value double, history_user_id long, at string",
    ).selectExpr("* except (at)", "CAST(at AS TIMESTAMP_NTZ) AS history_date")
    events = spark.sql("SELECT id, 'a' AS status, TIMESTAMP_NTZ '2000-01-02 00:00:00' AS history_date FROM VALUES (1), (NULL) AS t(id)")
    results = []
    for floor in ("1", "5000000"):
        spark.conf.set(HOT_ROWS_CONF, floor)
        out = [negotiation.numbered_history(frame), negotiation.resend_matches(frame, events), sort_rows(frame, ["history_date", "draft_value"], True)]
        results.append([sorted(repr(tuple(r)) for r in df.collect()) for df in out])
    assert results[0] == results[1]
    assert sum("-0.0" in r for r in results[0][0]) == 7


def test_negotiation_history(spark, rows):
    frame, con = rows
    products = spark.sql("""
        SELECT id, id * 2 AS request_id, id * 3 AS pricebook_product_id, 'COMMERCIAL' AS type,
               CASE WHEN id % 2 = 0 THEN 'PENDING' ELSE 'APPROVED' END AS status,
               TIMESTAMP_NTZ '2000-02-01 00:00:00' AS history_date
        FROM (SELECT DISTINCT id FROM {f})""", f=frame)
    values = frame.select("id", "request_product_id", F.lit(4).alias("pricebook_value_id")).distinct()
    fields = spark.createDataFrame([(4, "unit_price")], "id int, field_name string")
    resends = frame.where("history_user_id < 2")
    con.register("products", products.toPandas())
    found = negotiation.negotiation_history(
        products, values, frame, resends, fields, "2000-05-01"
    )
    assert of_spark(found) == of_duckdb(con, """
        SELECT p.pricebook_product_id AS product_id, p.request_id, p.status,
               h.draft_value AS unit_price, h.history_user_id, h.history_date,
               CASE WHEN h.history_date <= p.history_date THEN 'previous_approved'
                    WHEN p.status = 'APPROVED' AND NOT EXISTS (
                        SELECT 1 FROM history o WHERE o.request_product_id = p.id
                          AND coalesce(o.history_date > h.history_date, TRUE))
                    THEN 'approved'
                    ELSE 'PENDING_' || row_number() OVER (PARTITION BY p.id
                        ORDER BY h.history_date, h.draft_value, h.history_user_id) END AS status_label
        FROM products p JOIN history h ON h.id = p.id
        LEFT JOIN (SELECT * FROM history WHERE history_user_id < 2) e
          ON e.id = p.id AND h.history_date < e.history_date
        WHERE h.history_date <= TIMESTAMP '2000-05-01'""")


def test_join_to_unique_with_a_hot_and_a_null_key(spark, rows):
    left = spark.range(ROWS).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 4).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("c"))
    for how in ("left", "inner"):
        assert of_spark(join_to_unique(left, right, ["k"], how)) == of_spark(
            left.join(right, ["k"], how)
        )
    plan = join_to_unique(left, right, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "broadcast" in plan


def test_one_user_with_most_memberships(spark, rows):
    users = spark.range(50).select(
        "id", F.lit("f").alias("first_name"), F.lit("l").alias("last_name"),
        F.when(F.col("id") % 4 > 0, 1).cast("long").alias("company_id"),
    )
    members = spark.range(ROWS).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40 + 20).alias("user_id"),
        F.col("id").alias("role_id"),
    )
    roles = spark.range(0, ROWS, 2).select("id", F.concat(F.lit("r"), "id").alias("name"))
    companies = spark.createDataFrame([(1, "co")], "id long, name string")
    con = duckdb.connect()
    for name, frame in (("u", users), ("m", members), ("r", roles)):
        con.register(name, frame.toPandas())
    assert of_spark(user_dimension(users, companies, members, roles)) == of_duckdb(con, """
        SELECT u.id, first_name, last_name, CASE WHEN u.id % 4 > 0 THEN 1 END AS company_id,
               CASE WHEN u.id % 4 > 0 THEN 'co' END AS company_name, r.name AS user_type
        FROM u LEFT JOIN m ON m.user_id = u.id LEFT JOIN r ON r.id = m.role_id""")


@pytest.fixture
def no_estimates(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    yield lambda limit: spark.conf.set(name, limit)
    spark.conf.unset(name)


def test_lookups_beyond_the_bound_are_not_broadcast(spark, monkeypatch, no_estimates):
    left = spark.range(100).withColumnRenamed("id", "k")
    lookup = spark.range(50).select(F.col("id").alias("k"), F.lit("name").alias("name"))

    def plan(frame):
        return frame._jdf.queryExecution().optimizedPlan().toString()

    expected = of_spark(left.join(lookup, "k"))
    # Spark knows these sizes, so it is left to Spark until it stops broadcasting.
    assert "broadcast" not in plan(lookup_join(left, lookup, ["k"]))
    no_estimates("-1")
    assert "broadcast" in plan(lookup_join(left, lookup, ["k"]))
    assert of_spark(lookup_join(left, lookup, ["k"])) == expected
    monkeypatch.setattr(balance, "LOOKUP_MAX_ROWS", 10)
    assert "broadcast" not in plan(lookup_join(left, lookup, ["k"]))
    assert of_spark(lookup_join(left, lookup, ["k"])) == expected
    monkeypatch.setattr(balance, "LOOKUP_MAX_ROWS", 1000)
    monkeypatch.setattr(balance, "LOOKUP_MAX_BYTES", 100)
    assert "broadcast" not in plan(lookup_join(left, lookup, ["k"]))


def _wide(spark, products):
    from tenderline.operators.pivot import wide_values

    fields = spark.createDataFrame([(1, "one"), (2, "two")], "id int, field_name string")
    many = spark.range(products * 40, numPartitions=1)
    values = many.selectExpr(f"id % {products} AS pb_product_id", "cast(id div 7 % 2 + 1 AS int) AS pb_required_field_id", "cast(id AS string) AS field_value")
    return wide_values(values, fields, {"one": "a", "two": "b"}), values


def test_values_are_placed_before_they_are_sorted(spark):
    text = _wide(spark, 50)[0]._jdf.queryExecution().executedPlan().toString()
    text = text[: text.find("== Initial Plan ==")]
    assert text.rindex("SortAggregate") < text.index("Exchange hashpartitioning(pb_product_id")


@pytest.mark.parametrize("products", [1, 50])
def test_values_of_hot_products_are_dealt_to_several_tasks(spark, low_limit, products):
    wide, values = _wide(spark, products)
    text = wide._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in text and "Exchange hashpartitioning(pb_product_id#" in text
    expected = {}
    for p, f, v in values.collect():
        cell = expected.setdefault(p, {})
        cell[f] = max(cell.get(f, ""), v)
    assert {r[0]: (r[1], r[2]) for r in wide.collect()} == {p: (c.get(1), c.get(2)) for p, c in expected.items()}


def test_shares_grow_with_the_rows(spark):
    from tenderline.operators.balance import ROWS_PER_TASK, placed

    rows = spark.range(10).selectExpr("id", "id AS other")
    assert placed(rows, "id", ["other"], 30 * ROWS_PER_TASK, []).rdd.getNumPartitions() == 30


def test_shares_of_values_are_not_merged(spark, monkeypatch):
    """Adaptive execution would merge small shares to about as many as cores, so that each grows with the input."""
    from tenderline.operators import balance

    monkeypatch.setattr(balance, "ROWS_PER_TASK", 100)
    wide, values = _wide(spark, 50)
    assert values.count() == 2000
    assert wide.rdd.getNumPartitions() == 20
    assert {r[0]: (r[1], r[2]) for r in wide.collect()} == {
        p: tuple(max(r[2] for r in values.collect() if r[0] == p and r[1] == f) for f in (1, 2)) for p in range(50)
    }
