"""The seven reports over a film-rental database.

Each takes the tables as a mapping of DataFrames by name (``film``, ``film_category``,
``category``, ``inventory``, ``rental``, ``payment``, ``film_actor``, ``actor``,
``customer``, ``address``, ``city``), read from wherever the caller keeps them, and
returns a DataFrame.  ``nulls`` and ``null_as_empty`` switch to Postgres' rules for NULLs
in descending order and in names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.functions import bucket_label, contains_text, full_name, starts_with_any_case
from daymark.operators import (
    Hop,
    carry_totals,
    chain,
    count_distinct_by,
    count_distinct_through,
    grouped_for_join,
)
from daymark.plans import report_shapes as shapes

Tables = Mapping[str, DataFrame]

# The category of the actor report, and the labels of the city groups.
CATEGORY = "Children"
STARTS_WITH_A, HAS_HYPHEN, OTHER_CITY = "start_w_A", "contains_-", "T_T"


def _names(t: Tables, null_as_empty: bool) -> DataFrame:
    name = full_name("first_name", "last_name", null_as_empty)
    return t["actor"].select("actor_id", name.alias("full_name"))


def films_per_category(t: Tables, nulls: str = "last") -> DataFrame:
    """``cat``, ``f_cnt``: films per category, most first."""
    return shapes.items_per_label(
        t["film"],
        t["film_category"],
        [Hop(t["category"], "category_id", "name")],
        item="film_id",
        label_as="cat",
        count_as="f_cnt",
        nulls=nulls,
    )


def most_rented_actors(
    t: Tables, n: int = 10, nulls: str = "last", null_as_empty: bool = False
) -> DataFrame:
    """``full_name``, ``rent_cnt``: the ten actors with most distinct rentals of their films."""
    copies = chain(t["inventory"].select("inventory_id", "film_id"), (t["film"].select("film_id"), "film_id"))
    rentals = t["rental"].select("rental_id", "inventory_id").join(copies, "inventory_id")
    cast = t["film_actor"].select("film_id", "actor_id").join(_names(t, null_as_empty), "actor_id")
    counts = count_distinct_through(rentals, cast, "film_id", "rental_id", "full_name", "rent_cnt")
    return shapes.busiest_people(counts, "full_name", "rent_cnt", n, nulls)


def top_revenue_category(t: Tables, nulls: str = "last") -> DataFrame:
    """``name``, ``revenue``: the category with the highest payments."""
    return shapes.highest_total_label(
        t["payment"].select("rental_id", "amount"),
        "amount",
        [
            Hop(t["rental"], "rental_id", "inventory_id"),
            Hop(t["inventory"], "inventory_id", "film_id"),
            Hop(t["film"], "film_id", "film_id"),
            Hop(t["film_category"], "film_id", "category_id", repeats=True),
            Hop(t["category"], "category_id", "name"),
        ],
        label_as="name",
        total_as="revenue",
        nulls=nulls,
    )


def films_not_in_inventory(t: Tables) -> DataFrame:
    """``title``: films of which there is no copy."""
    return shapes.titles_without_stock(t["film"], t["inventory"], "film_id", "title")


def top_actors_in_category(
    t: Tables,
    category: str = CATEGORY,
    k: int = 3,
    nulls: str = "last",
    null_as_empty: bool = False,
) -> DataFrame:
    """``full_name``, ``f_cnt``: actors in the top ``k`` ranks by titles in one category."""
    chosen = t["category"].filter(F.col("name") == category).select("category_id")
    titles = chain(
        t["film_category"].select("film_id", "category_id"),
        (chosen, "category_id"),
        (t["film"].select("film_id", "title"), "film_id"),
    )
    # Titles are counted distinct, so a film needs to be here once only.
    listed = grouped_for_join(titles.select("film_id", "title"), ["film_id", "title"])
    titles_of_actors = chain(
        t["film_actor"].select("film_id", "actor_id"),
        (listed, "film_id"),
        (_names(t, null_as_empty), "actor_id"),
    )
    counts = count_distinct_by(titles_of_actors, "full_name", "title", "f_cnt")
    return shapes.people_in_top_ranks(counts, "full_name", "f_cnt", k, nulls)


def customers_per_city(t: Tables, nulls: str = "last") -> DataFrame:
    """``city``, ``cnt_active``, ``cnt_inactive`` per city name, most inactive first."""
    return shapes.conditional_counts_per_label(
        t["customer"].select("customer_id", "active", "address_id"),
        "customer_id",
        {"cnt_active": F.col("active") == 1, "cnt_inactive": F.col("active") == 0},
        [Hop(t["address"], "address_id", "city_id"), Hop(t["city"], "city_id", "city")],
        label_as="city",
        order_by="cnt_inactive",
        nulls=nulls,
    )


def busiest_category_per_city_group(t: Tables, nulls: str = "last") -> DataFrame:
    """``city_group``, ``Category``, ``rent_hours``: per group of cities, the category rented longest.

    Groups: cities that start with A or a; other cities with a hyphen.
    """
    in_a, hyphen = starts_with_any_case("city", "a"), contains_text("city", "-")
    label = bucket_label([(in_a, STARTS_WITH_A), (hyphen, HAS_HYPHEN)], OTHER_CITY)
    groups = (
        t["city"]
        .filter(in_a | hyphen)
        .select("city_id", label.alias("city_group"))
    )
    grouped_customers = chain(
        t["customer"].select("customer_id", "address_id"),
        (t["address"].select("address_id", "city_id"), "address_id"),
        (groups, "city_id"),
    ).select("customer_id", "city_group")
    rented = t["rental"].select("customer_id", "inventory_id", "rental_date", "return_date")
    spans = shapes.hours_of(
        rented.join(grouped_customers, "customer_id"), "return_date", "rental_date", "rent_hours"
    )
    hours = carry_totals(
        spans.select("inventory_id", "city_group", "rent_hours"),
        "rent_hours",
        [
            Hop(t["inventory"], "inventory_id", "film_id"),
            Hop(t["film"], "film_id", "film_id"),
            Hop(t["film_category"], "film_id", "category_id", repeats=True),
            Hop(t["category"], "category_id", "name"),
        ],
        keep=["city_group"],
    )
    best = shapes.busiest_label_per_bucket(hours, "city_group", "name", "rent_hours", nulls)
    return best.select("city_group", F.col("name").alias("Category"), "rent_hours")
