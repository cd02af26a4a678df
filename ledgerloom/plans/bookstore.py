"""Bookstore: clean catalog, author, customer and order extracts and load sales facts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import case_bucket
from ..functions.dates import date_key, parse_iso_date
from ..functions.numbers import clean_numeric
from ..functions.text import array_to_text, clean_email, clean_phone, clean_text, list_length
from ..operators.cleaning import append_sources, handle_missing, keep_expected_columns, remove_duplicates
from ..operators.dimensions import scd1_upsert
from ..operators.facts import FactLoad, load_facts
from ..operators.keys import first_per_key

BOOK_COLUMNS = ("book_key", "isbn", "title", "genre", "series", "recommended")
AUTHOR_COLUMNS = ("author_key", "name", "email", "phone", "genres")
CUSTOMER_COLUMNS = ("customer_id", "name", "email", "phone", "genre_preferences")


def _existing(df: DataFrame, columns: dict[str, Column]) -> dict[str, Column]:
    return {name: expression for name, expression in columns.items() if name in df.columns}


def _complete(df: DataFrame, required: Sequence[str]) -> DataFrame:
    return handle_missing(df, "drop", columns=[c for c in required if c in df.columns])


def with_normalized_series(books: DataFrame) -> DataFrame:
    """Copy of the series, NULL when the column does not exist."""
    series = F.col("series") if "series" in books.columns else F.lit(None).cast("string")
    return books.withColumn("series_normalized", series)


def _with_length(df: DataFrame, column: str, name: str) -> DataFrame:
    is_list = column in df.columns and df.schema[column].dataType.typeName() == "array"
    return df.withColumn(name, list_length(column) if is_list else F.lit(0))


def with_collab_count(authors: DataFrame) -> DataFrame:
    return _with_length(authors, "collaborations", "collab_count")


def with_reading_count(customers: DataFrame) -> DataFrame:
    return _with_length(customers, "reading_history", "reading_count")


def with_num_genres(customers: DataFrame) -> DataFrame:
    return _with_length(customers, "genre_preferences", "num_genres")


def with_recommended_score(books: DataFrame, score: float = 1.0) -> DataFrame:
    """Placeholder score, the same for every book."""
    return books.withColumn("recommended_score", F.lit(score))


def _list_text(df: DataFrame, column: str) -> Column:
    is_list = column in df.columns and df.schema[column].dataType.typeName() == "array"
    return array_to_text(column) if is_list else F.coalesce(F.col(column), F.lit(""))


def transform_books(books: DataFrame, required: Sequence[str] = ("isbn", "title", "genre")) -> DataFrame:
    """Clean text columns, recommendation as Yes, No or blank; drop books without a required value."""
    answer = F.lower(F.trim("recommended"))
    cleaned = books.withColumns(
        _existing(
            books,
            {c: clean_text(c) for c in ("title", "genre", "series", "isbn")}
            | {"recommended": case_bucket([(answer == "yes", "Yes"), (answer == "no", "No")], "")},
        )
    )
    kept = _complete(with_normalized_series(cleaned), required)
    if "recommended" in kept.columns:
        kept = kept.fillna("", subset=["recommended"])
    return keep_expected_columns(kept, BOOK_COLUMNS)


def transform_authors(authors: DataFrame, required: Sequence[str] = ("name", "email", "phone")) -> DataFrame:
    """Clean authors, genres as text, complete rows only, one row per e-mail."""
    cleaned = authors.withColumns(
        _existing(
            authors,
            {
                "name": clean_text("name"),
                "email": clean_email("email"),
                "phone": clean_phone("phone"),
                "genres": _list_text(authors, "genres"),
            },
        )
    )
    complete = keep_expected_columns(_complete(cleaned, required), AUTHOR_COLUMNS)
    others = [c for c in complete.columns if c != "email"]
    return remove_duplicates(complete, ["email"], others) if "email" in complete.columns else complete


def transform_customers(customers: DataFrame, required: Sequence[str] = ("name", "email", "phone")) -> DataFrame:
    """Clean customers, preferences as text, complete rows only."""
    cleaned = customers.withColumns(
        _existing(
            customers,
            {
                "name": clean_text("name"),
                "email": clean_email("email"),
                "phone": clean_phone("phone"),
                "genre_preferences": _list_text(customers, "genre_preferences"),
            },
        )
    )
    return keep_expected_columns(_complete(cleaned, required), CUSTOMER_COLUMNS)


def transform_orders(orders: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Numeric quantity and price, 0 when missing or negative, one row per order id."""

    def amount(c: str, data_type: str) -> Column:
        value = clean_numeric(c)
        return F.coalesce(F.when(value >= 0, value), F.lit(0.0)).cast(data_type)

    cleaned = orders.withColumns(
        _existing(
            orders, {"quantity": amount("quantity", "bigint"), "price": amount("price", "decimal(10,2)")}
        )
    )
    tie_breaks = order or [c for c in cleaned.columns if c != "order_id"]
    return remove_duplicates(cleaned, ["order_id"], tie_breaks)


def load_dimension(dimension: DataFrame, key: str, surrogate: str, *sources: DataFrame) -> DataFrame:
    """Overwrite load of one or more cleaned sources; the first source wins on a shared key."""
    ranked = [source.withColumn("_source", F.lit(i)) for i, source in enumerate(sources)]
    rows = append_sources(*ranked)
    others = [c for c in rows.columns if c not in (key, "_source")]
    incoming = first_per_key(rows, [key], ["_source", *others]).drop("_source")
    missing = [c for c in dimension.columns if c not in incoming.columns and c != surrogate]
    incoming = incoming.withColumns({c: F.lit(None).cast(dimension.schema[c].dataType) for c in missing})
    return scd1_upsert(dimension, incoming, key, surrogate)


def book_sales_load(
    orders: DataFrame,
    catalog: DataFrame,
    books: DataFrame,
    authors: DataFrame,
    customers: DataFrame,
    loaded: DataFrame | None = None,
) -> FactLoad:
    """Sales facts with rejects and counters: every order is loaded, or rejected with its first reason.

    ``catalog`` links ``isbn`` to ``author`` name, one row per book; the dimensions are keyed by isbn, name and customer_id.
    Rejected are orders loaded before (``loaded`` holds their ``order_id``), without a valid day, quantity or price, of an unknown
    book, of a book without a known author, or of an unknown customer. An order id is loaded once; NULL counts as one id.
    """
    names = catalog.select("isbn", "author")
    writers = authors.select(F.col("name").alias("author"), "author_key")
    # One row per book: orders meet its keys in one join.
    links = (
        books.select("isbn", "book_key")
        .join(names, "isbn", "left")
        .join(writers, "author", "left")
        .select(F.col("isbn").alias("book_isbn"), "book_key", "author_key")
    )
    dated = orders.withColumn("date_key", date_key(parse_iso_date("order_date")))
    valid = [
        (F.col("date_key") > 0, "invalid order_date"),
        (F.col("quantity").isNotNull(), "missing quantity"),
        (F.col("price").isNotNull(), "missing price"),
        (F.col("book_key").isNotNull(), "unknown book_isbn"),
        (F.col("author_key").isNotNull(), "unknown author"),
    ]
    order = ["date_key", "book_isbn", "customer_id", "quantity", "price"]
    load = load_facts(
        dated.join(links, "book_isbn", "left"), "order_id", {"customer_id": (customers, "customer_key")}, valid, order, loaded
    )
    facts = load.facts.select("book_key", "author_key", "customer_key", "date_key", "quantity", "price")
    return replace(load, facts=facts)


def load_book_sales(
    orders: DataFrame, catalog: DataFrame, books: DataFrame, authors: DataFrame, customers: DataFrame
) -> DataFrame:
    """The facts of ``book_sales_load``."""
    return book_sales_load(orders, catalog, books, authors, customers).facts
