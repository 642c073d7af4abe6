"""Users with their company and roles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenderline.catalog import USER_INFO
from tenderline.operators.balance import hot_codes, lookup_join


def with_company(users: DataFrame, companies: DataFrame) -> DataFrame:
    """Every row of the users, with the company if it is known."""
    named = companies.select(
        F.col("id").alias("company_id"),
        F.col("id").alias("company_key"),
        F.col("name").alias("company_name"),
    )
    others = [c for c in users.columns if c != "company_id"]
    return lookup_join(users, named, ["company_id"], "left").select(
        *others, F.col("company_key").alias("company_id"), "company_name"
    )


def user_dimension(
    users: DataFrame, companies: DataFrame, memberships: DataFrame, roles: DataFrame
) -> DataFrame:
    """One row per user and role, one row with NULL for a user without roles.

    A left join can only be split on its left side. Where a single user owns very
    many memberships, matched users come from an inner join instead, which can be
    split on either side, and the others are added from an anti join.
    """
    people = users.select("id", "first_name", "last_name", "company_id")
    names = roles.select(F.col("id").alias("role_id"), F.col("name").alias("user_type"))
    owned = memberships.select(F.col("user_id").alias("id"), "role_id")
    typed = lookup_join(owned, names, ["role_id"], "left").select("id", "user_type")
    if not hot_codes(owned, ["id"]):
        return with_company(people.join(typed, "id", "left"), companies).select(*USER_INFO)
    others = people.join(owned.select("id").distinct(), "id", "left_anti").withColumn(
        "user_type", F.lit(None).cast("string")
    )
    matched = people.join(typed, "id").unionByName(others)
    return with_company(matched, companies).select(*USER_INFO)
