"""Negotiation history: priced values of requested products, labelled by stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenderline.catalog import (
    APPROVED,
    COMMERCIAL,
    LABEL_APPROVED,
    LABEL_PENDING,
    LABEL_PREVIOUS,
    NEGOTIATION_HISTORY,
    UNIT_PRICE_FIELD,
)
from tenderline.functions.scalar import AsOf
from tenderline.operators.balance import hot_codes, is_hot, join_to_unique, lookup_join
from tenderline.operators.filters import known_by
from tenderline.operators.timeline import (
    SLOT,
    collapsed,
    in_order,
    join_slots,
    repeat_rows,
    slot_sums,
    total_before,
    unroll,
    whole,
    with_copies,
    with_slot,
)

KEY = "request_product_id"
HISTORY = [KEY, "draft_value", "history_user_id", "history_date"]
HISTORY_ORDER = ["history_date", "draft_value", "history_user_id"]
# -0.0 and 0.0 tie in an order; their texts decide.
TIE = "draft_text"


def of_field(
    request_values: DataFrame,
    fields: DataFrame,
    field_name: str = UNIT_PRICE_FIELD,
    column: str = "pricebook_value_id",
) -> DataFrame:
    """Request values whose ``column`` names the wanted field."""
    wanted = fields.where(F.col("field_name") == field_name).select(F.col("id").alias(column))
    return lookup_join(request_values, wanted, [column], "left_semi")


def latest_per_product(value_history: DataFrame) -> DataFrame:
    """Latest date per request product, and how many of its rows have none."""
    return value_history.groupBy(KEY).agg(
        F.max("history_date").alias("latest"),
        (F.count(F.lit(1)) - F.count("history_date")).alias("undated"),
    )


def at_least_all(dated: str = "history_date") -> Column:
    """``dated >= ALL (dates of the group)`` over the columns of latest_per_product.

    True for a missing group, never true for one with an unknown date.
    """
    return F.col("latest").isNull() & F.col("undated").isNull() | (
        F.coalesce(F.col("undated") == 0, F.lit(False))
        & F.coalesce(F.col(dated) >= F.col("latest"), F.lit(False))
    )


def compare_with_all(value_history: DataFrame) -> DataFrame:
    """History rows, each marked if no row of its product is dated later."""
    rows = value_history.select(*HISTORY)
    met = join_to_unique(rows, latest_per_product(value_history), [KEY], "left")
    return met.select(*HISTORY, at_least_all().alias("is_latest"))


def next_status(request_history: DataFrame) -> DataFrame:
    """Request history with the status that follows each row."""
    codes = hot_codes(request_history, ["id"])
    rows = with_slot(
        with_copies(request_history, ["id", "status", "history_date"], codes),
        "id",
        ["history_date", "status"],
        codes,
    )
    ordered = in_order("id", ["history_date", "status"])
    following = rows.withColumn("has_next", F.lead(F.lit(1)).over(ordered)).withColumn(
        "next_status", F.lead("status").over(ordered)
    )
    if codes:
        heads = (
            rows.where(is_hot(["id"], codes))
            .groupBy("id", SLOT)
            .agg(
                F.min_by(
                    "status",
                    F.struct(
                        F.col("history_date").isNull(), F.col("history_date"),
                        F.col("status").isNull(), F.col("status"),
                    ),
                ).alias("head")
            )
            .select(
                "id", SLOT, F.lead("head").over(Window.partitionBy("id").orderBy(SLOT)).alias("head")
            )
        )
        following = join_slots(following, heads, "id").withColumn(
            "next_status", F.when(F.col("has_next").isNull(), F.col("head")).otherwise(F.col("next_status"))
        )
    # Copies of a row follow each other; only the last one sees the next row.
    return unroll(following, codes).select(
        "id",
        "status",
        "history_date",
        F.when(F.col("copy") < F.col("copies"), F.col("status"))
        .otherwise(F.col("next_status"))
        .alias("next_status"),
    )


def _resend_counts(request_history: DataFrame) -> DataFrame:
    dated = request_history.where(F.col("history_date").isNotNull() & F.col("id").isNotNull())
    return dated.groupBy(F.col("id").alias(KEY), "history_date").agg(
        F.count(F.lit(1)).alias("resends")
    )


def count_later_resends(
    rows: DataFrame, request_history: DataFrame, order: list[str], codes: list[int]
) -> DataFrame:
    """Add ``later_resends``: request events of the product dated after the row.

    Replaces the join of every row with each later event by a running count over
    both, in one shuffle and one sort that the numbering afterwards goes on using.
    Rows need a date; ``order`` starts with it.
    """
    events = _resend_counts(request_history)
    # Events sort before rows of the same date, so "so far" includes that date.
    both = rows.withColumn("is_row", F.lit(1)).unionByName(
        events.withColumn("is_row", F.lit(0)), allowMissingColumns=True
    )
    placed = [order[0], "is_row", *order[1:]]
    both = with_slot(both, KEY, placed, codes)
    along = in_order(KEY, placed)
    so_far = F.sum("resends").over(
        along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    of_slot = F.sum("resends").over(whole(along))
    counted = both.withColumn(
        "later_resends", F.coalesce(of_slot, F.lit(0)) - F.coalesce(so_far, F.lit(0))
    )
    if codes:
        offsets = slot_sums(both, KEY, F.col("resends"), codes).drop("earlier")
        counted = (
            join_slots(counted, offsets, KEY)
            .withColumn("later_resends", F.col("later_resends") + F.coalesce("later", F.lit(0)))
            .drop("later")
        )
    return counted.where(F.col("is_row") == 1).drop("resends")


def resend_matches(value_history: DataFrame, request_history: DataFrame) -> DataFrame:
    """Distinct history rows with the outcome of joining them to later events.

    ``matched_rows`` is the number of (row, later event) matches, ``joined_rows``
    the number of rows a left join gives: at least one per copy. Rows without a product
    or a date match nothing and stay.
    """
    known = F.col("history_date").isNotNull() & F.col(KEY).isNotNull()
    dated = value_history.where(known)
    codes = _crowded(value_history.select(KEY), request_history.select(F.col("id").alias(KEY)))
    counted = count_later_resends(
        collapsed(dated, HISTORY, KEY, codes), request_history, HISTORY_ORDER, codes
    )
    # Grouped by all columns in the map tasks: unknown products do not meet in one task.
    alone = collapsed(value_history.where(~known), HISTORY, KEY, codes, spread=True)
    return counted.select(
        *HISTORY,
        (F.col("copies") * F.col("later_resends")).alias("matched_rows"),
        (F.col("copies") * F.greatest("later_resends", F.lit(1))).alias("joined_rows"),
    ).unionByName(
        alone.select(*HISTORY, F.lit(0).cast("long").alias("matched_rows"), F.col("copies").alias("joined_rows"))
    )


def numbered_history(value_history: DataFrame) -> DataFrame:
    """Value history with a running label per request product."""
    codes = hot_codes(value_history, [KEY])
    rows = with_copies(value_history, HISTORY, codes).withColumn(TIE, F.col("draft_value").cast("string"))
    order = [*HISTORY_ORDER, TIE]
    rows = with_slot(rows, KEY, order, codes)
    placed = total_before(rows, KEY, order, "copies", "ahead", codes)
    return unroll(placed, codes).select(
        *HISTORY, _pending(F.col("ahead") + F.col("copy")).alias("sequence_label")
    )


def _pending(number: Column) -> Column:
    return F.concat_ws("", F.lit(LABEL_PENDING), number.cast("string"))


def _crowded(*keys: DataFrame) -> list[int]:
    """Keys that are hot over all inputs together, found in one pass."""
    together = keys[0]
    for more in keys[1:]:
        together = together.unionByName(more)
    return hot_codes(together, [KEY])


#: A run: the rows of the history that differ in their number alone.
RUN = ["product_id", "request_id", "status", "unit_price", "history_user_id", "history_date"]


def _placed(
    products: DataFrame,
    request_values: DataFrame,
    value_history: DataFrame,
    request_history: DataFrame,
    fields: DataFrame,
    as_of: AsOf,
    fan_out: bool,
    field_column: str,
) -> tuple[DataFrame, list[str], list[int]]:
    """Rows of the history, each with how often it is there (``copies``) and how many come
    before it (``ahead``); the columns that put them in order; and the hot keys."""
    commercial = products.where(F.col("type") == COMMERCIAL).select(
        F.col("id").alias(KEY),
        F.col("pricebook_product_id").alias("product_id"),
        "request_id",
        "status",
        F.col("history_date").alias("request_created_at"),
    )
    events = [request_history.select(F.col("id").alias(KEY))] if fan_out else []
    codes = _crowded(
        value_history.select(KEY),
        value_history.select(F.col("id").alias(KEY)),
        request_values.select(KEY),
        commercial.select(KEY),
        *events,
    )
    asked = join_to_unique(
        with_copies(commercial, commercial.columns, codes, "product_copies"),
        latest_per_product(value_history),
        [KEY],
        "left",
        codes,
    )
    priced = with_copies(
        of_field(request_values, fields, column=field_column), ["id", KEY], codes, "value_copies"
    )
    known = with_copies(
        known_by(value_history, "history_date", as_of),
        ["id", "draft_value", "history_user_id", "history_date"],
        codes,
    )
    rows = (
        asked.join(priced, KEY)
        .join(known, "id")
        .select(
            KEY, "product_id", "request_id", "status", "request_created_at", "draft_value",
            "history_user_id", "history_date", at_least_all().alias("is_latest"),
            (F.col("product_copies") * F.col("value_copies") * F.col("copies")).alias("copies"),
        )
    )
    order = [
        *HISTORY_ORDER, TIE, "product_id", "request_id", "status", "request_created_at", "is_latest",
    ]
    rows = rows.withColumn(TIE, F.col("draft_value").cast("string"))
    along = order
    if fan_out:
        rows = count_later_resends(rows, request_history, order, codes).withColumn(
            "copies", F.col("copies") * F.greatest("later_resends", F.lit(1))
        )
        along = [order[0], "is_row", *order[1:]]
    else:
        rows = with_slot(rows, KEY, order, codes)
    return total_before(rows, KEY, along, "copies", "ahead", codes), order, codes


def _fixed_label() -> Column:
    """The label of rows that have no number in it, else NULL."""
    return F.when(F.col("history_date") <= F.col("request_created_at"), LABEL_PREVIOUS).when(
        (F.col("status") == APPROVED) & F.col("is_latest"), LABEL_APPROVED
    )


def negotiation_history(
    products: DataFrame,
    request_values: DataFrame,
    value_history: DataFrame,
    request_history: DataFrame,
    fields: DataFrame,
    as_of: AsOf,
    fan_out: bool = True,
    field_column: str = "pricebook_value_id",
) -> DataFrame:
    """Price history of commercial request products with a label per row.

    With ``fan_out`` a row appears once per later request event, as the history is
    defined; without it every row appears once. The multiplicity is carried as a
    number through joins and numbering and unrolled at the very end.
    """
    placed, _, codes = _placed(
        products, request_values, value_history, request_history, fields, as_of, fan_out, field_column
    )
    if fan_out:
        placed = repeat_rows(placed, "copies", "copy", spread=bool(codes))
    else:
        placed = unroll(placed, codes)
    label = F.coalesce(_fixed_label(), _pending(F.col("ahead") + F.col("copy")))
    return (
        placed.withColumn("status_label", label)
        .withColumn("unit_price", F.col("draft_value"))
        .select(*NEGOTIATION_HISTORY)
    )


def negotiation_runs(
    products: DataFrame,
    request_values: DataFrame,
    value_history: DataFrame,
    request_history: DataFrame,
    fields: DataFrame,
    as_of: AsOf,
    fan_out: bool = True,
    field_column: str = "pricebook_value_id",
) -> DataFrame:
    """The same history in runs: rows that differ in their number alone, as one row.

    ``copies`` says how many rows a run stands for, ``first_number`` the number of the
    first; ``fixed_label`` is NULL where labels carry numbers. There are at most as many runs as
    priced history rows, however many later events each of them has: a history that is
    quadratic in the events of a product is stored in linear size. ``expand_runs`` gives the rows.
    Equal rows follow each other, so their numbers are without gaps. Runs are grouped on the
    placing that the numbering already has, without another shuffle.
    """
    placed, order, _ = _placed(
        products, request_values, value_history, request_history, fields, as_of, fan_out, field_column
    )
    # The text of the price stands for it: grouping takes -0.0 for 0.0.
    alike = [c for c in order if c != "draft_value"]
    return (
        placed.groupBy(KEY, SLOT, *alike)
        .agg(
            F.first("draft_value").alias("unit_price"),
            F.sum("copies").alias("copies"),
            (F.min("ahead") + 1).alias("first_number"),
        )
        .select(*RUN, _fixed_label().alias("fixed_label"), "first_number", "copies")
    )


def expand_runs(runs: DataFrame, spread: bool = False) -> DataFrame:
    """The history that stored runs stand for; with ``spread`` long runs are dealt to many tasks."""
    rows = repeat_rows(runs, "copies", "copy", spread)
    number = _pending(F.col("first_number") + F.col("copy") - 1)
    return rows.withColumn("status_label", F.coalesce("fixed_label", number)).select(*NEGOTIATION_HISTORY)
