"""Reading JSON text columns with built-in expressions, one row at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tenderline.functions.scalar import number

ELEMENTS = "array<struct<id:string,unit_price:string>>"
MONEY = "decimal(18,2)"


def text_at(column: str, path: str) -> Column:
    """Text under a JSON path; a missing path or a JSON null is NULL."""
    return F.get_json_object(column, path)


def number_at(column: str, path: str, dtype: str = MONEY, lenient: bool = False) -> Column:
    return number(text_at(column, path), dtype, lenient)


def elements(column: str, lenient: bool = False) -> Column:
    """The array in a text. Malformed text, or text that is no array, raises; with ``lenient`` it is NULL."""
    text = F.trim(F.col(column))
    if lenient:
        return F.when(text.startswith("["), F.from_json(column, ELEMENTS))
    wrong = F.raise_error(F.concat(F.lit(f"{column} is not an array: "), F.substring(text, 1, 60)))
    read = F.from_json(column, ELEMENTS, {"mode": "FAILFAST"})
    return F.when(text.isNull() | text.startswith("["), read).otherwise(wrong.cast(ELEMENTS))


def latest_price(column: str, lenient: bool = False) -> Column:
    """Price of the array element with the greatest id; one without id wins.

    Compares inside the row, so there is nothing to shuffle. Between equal ids
    the higher price is taken. Empty and NULL arrays give NULL.
    """
    return F.array_max(_ranked(elements(column, lenient), lenient))["price"]


def explode_elements(df: DataFrame, column: str, keep: list[str], lenient: bool = False) -> DataFrame:
    """One row per element of the array, with its id and price as numbers.

    With ``lenient`` a text that cannot be read gives a row without numbers and with the
    text itself as ``malformed``.
    """
    found = elements(column, lenient)
    bad = F.col(column).isNotNull() & found.isNull() if lenient else F.lit(False)
    none = F.array(F.lit(None).cast("struct<id:string,unit_price:string>"))
    raw = [F.when(bad, F.col(column)).alias("malformed")] if lenient else []
    rows = df.select(*keep, *raw, F.explode(F.when(bad, none).otherwise(found)).alias("element"))
    return rows.select(
        *keep,
        *(["malformed"] if lenient else []),
        number(F.col("element.id"), "int", lenient).alias("element_id"),
        number(F.col("element.unit_price"), MONEY, lenient).alias("unit_price"),
    )


# Documents parsed once


def document(column: str, lenient: bool = False) -> Column:
    """The text as a VARIANT, parsed once for any number of paths. Malformed text raises; with ``lenient`` it is NULL."""
    return (F.try_parse_json if lenient else F.parse_json)(F.col(column))


def text_in(doc: str, path: str) -> Column:
    """Text under a path of a parsed document; a missing path or a JSON null is NULL."""
    return F.try_variant_get(doc, path, "string")


def number_in(doc: str, path: str, dtype: str = MONEY, lenient: bool = False) -> Column:
    return number(text_in(doc, path), dtype, lenient)


def latest_price_in(doc: str, lenient: bool = False) -> Column:
    """``latest_price`` of a parsed array; a document that is no array raises, or is NULL with ``lenient``."""
    wrong = F.raise_error(F.concat(F.lit(f"{doc} is not an array: "), F.substring(F.to_json(doc), 1, 60)))
    # Told by a path, which a scan can look up in its columns; the schema of a document is spelled out for each row.
    listed = F.try_variant_get(doc, "$", "array<variant>").isNotNull()
    if lenient:
        items = F.when(listed, F.try_variant_get(doc, "$", ELEMENTS))
        return F.array_max(_ranked(items, lenient))["price"]
    items = F.when(listed, F.variant_get(doc, "$", ELEMENTS)).when(F.col(doc).isNotNull(), wrong.cast(ELEMENTS))
    # Cast as one array, in compiled code, where a lambda would cast element by element.
    typed = items.cast(f"array<struct<id:int,price:{MONEY}>>")
    return F.array_max(F.transform(typed, lambda e: F.struct(e["id"].isNull().alias("without_id"), e["id"], e["price"])))["price"]


def _ranked(items: Column, lenient: bool) -> Column:
    return F.transform(
        items,
        lambda e: F.struct(
            e["id"].isNull().alias("without_id"),
            number(e["id"], "int", lenient).alias("id"),
            number(e["unit_price"], MONEY, lenient).alias("price"),
        ),
    )
