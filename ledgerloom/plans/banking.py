"""Banking warehouse: staging clean-up, holder history, transaction facts, checks, analytics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import (
    between_inclusive,
    case_bucket,
    code_pattern,
    in_list,
    map_synonyms,
    not_blank,
)
from ..functions.dates import date_key
from ..functions.text import metro_city, proper_case, squeeze_spaces
from ..operators import ordered
from ..operators.daystates import DayPartitions, DayStates
from ..operators.dimensions import insert_only, scd2_apply, scd2_detect
from ..operators.facts import FactLoad, load_facts
from ..operators.membership import KeyFilter
from ..operators.keys import first_per_key
from ..operators.quality import TableRule, check_key_sets, check_row_counts, check_rows, check_unique, combine
from ..session import stage_table

# Tier spellings, metro cities, account prefixes and amount limits.
TIERS = {
    "Premium": ("PREM", "PREMIUM"),
    "Preferred": ("PREF", "PREFERRED"),
    "Standard": ("STD", "STANDARD"),
    "Basic": ("BASIC",),
}
METRO_CITIES = ("New York", "Los Angeles", "Chicago")
ACCOUNT_PREFIXES = ("CC", "MTG", "SAV", "INV", "SVC", "LON", "AUTO", "CHK")
AMOUNT_LIMITS = (-50_000, 50_000)

HOLDER_KEY = "account_holder_id"
HOLDER_SURROGATE = "account_holder_key"
TRACKED = ("account_holder_name", "address", "relationship_tier")


def loadable(staging: DataFrame, limits: tuple[float, float] = AMOUNT_LIMITS) -> DataFrame:
    """Rows with a holder id, a holder name and an amount within the limits."""
    return staging.where(
        F.col(HOLDER_KEY).isNotNull()
        & not_blank("account_holder_name")
        & between_inclusive("transaction_amount", *limits)
    )


def clean_holders(staging: DataFrame) -> DataFrame:
    """Distinct holders with standard name, address and tier."""
    return (
        loadable(staging)
        .select(
            HOLDER_KEY,
            proper_case("account_holder_name").alias("account_holder_name"),
            squeeze_spaces("address").alias("address"),
            map_synonyms("relationship_tier", TIERS, "Standard").alias("relationship_tier"),
        )
        .distinct()
    )


def apply_business_rules(holders: DataFrame, metro: Sequence[str] = METRO_CITIES) -> DataFrame:
    """Split the Premium tier by metro city and derive the risk profile."""
    tier = F.col("relationship_tier")
    premium = tier == "Premium"
    return holders.withColumns(
        {
            "relationship_tier": case_bucket(
                [(premium & in_list(metro_city("address"), metro), "Premium Metro"), (premium, "Premium Standard")], tier
            ),
            "risk_profile": case_bucket(
                [
                    (tier.isin("Premium", "Preferred"), "Low Risk"),
                    (tier == "Standard", "Medium Risk"),
                    (tier == "Basic", "High Risk"),
                ]
            ),
        }
    )


def stage_holders(staging: DataFrame) -> DataFrame:
    """One cleaned row per holder; of several variants the first by name, address and tier."""
    return first_per_key(apply_business_rules(clean_holders(staging)), [HOLDER_KEY], list(TRACKED))


def detect_holder_changes(holders: DataFrame, staging: DataFrame) -> DataFrame:
    return scd2_detect(holders, stage_holders(staging), HOLDER_KEY, HOLDER_SURROGATE, TRACKED)


def load_holders(holders: DataFrame, staging: DataFrame, as_of: date) -> DataFrame:
    """The holder dimension after the load."""
    staged = stage_holders(staging).select(HOLDER_KEY, *TRACKED)
    return scd2_apply(holders, staged, HOLDER_KEY, HOLDER_SURROGATE, TRACKED, as_of)


def new_products(products: DataFrame, staging: DataFrame) -> DataFrame:
    """Products not in the dimension yet, numbered after its keys."""
    offered = staging.where("banking_product_id is not null and product_name is not null").select(
        "banking_product_id", "product_name", "product_category", F.lit(True).alias("is_active")
    )
    return insert_only(
        products, offered, "banking_product_id", "banking_product_key", ["product_name", "product_category"]
    )


def transaction_load(
    staging: DataFrame,
    holders: DataFrame,
    products: DataFrame,
    dates: DataFrame,
    loaded: DataFrame | None = None,
    limits: tuple[float, float] = AMOUNT_LIMITS,
    loaded_filter: KeyFilter | None = None,
) -> FactLoad:
    """Facts with surrogate keys (current holder version, known product, known day), and every other row as a reject.

    A transaction id is loaded once: of several rows with one id in a batch the first by account,
    product and amount is loaded, the others are rejected as duplicates.
    """
    keyed = staging.withColumn("date_key", date_key(F.col("transaction_date").cast("date")))
    columns = [HOLDER_KEY, "account_holder_name", "banking_product_id", "date_key", "transaction_id", "account_number"]
    load = load_facts(
        keyed.select(*columns, "transaction_amount", "transaction_type"),
        business_key="transaction_id",
        lookups={
            HOLDER_KEY: (holders.where("is_current"), HOLDER_SURROGATE),
            "banking_product_id": (products, "banking_product_key"),
            "date_key": (dates.select("date_key", F.col("date_key").alias("known_date_key")), "known_date_key"),
        },
        valid=[
            (F.col("transaction_id").isNotNull(), "no transaction id"),
            (F.col(HOLDER_KEY).isNotNull() & not_blank("account_holder_name"), "no holder"),
            (between_inclusive("transaction_amount", *limits), "invalid amount"),
        ],
        order=["account_number", HOLDER_SURROGATE, "banking_product_key", "date_key", "transaction_amount", "transaction_type"],
        already_loaded=loaded,
        loaded_filter=loaded_filter,
    )
    facts = load.facts.select(
        HOLDER_SURROGATE,
        "banking_product_key",
        "date_key",
        "transaction_id",
        "account_number",
        "transaction_amount",
        "transaction_type",
    )
    return replace(load, facts=facts)


def load_transactions(
    staging: DataFrame, holders: DataFrame, products: DataFrame, dates: DataFrame, loaded: DataFrame | None = None
) -> DataFrame:
    """The facts of ``transaction_load``."""
    return transaction_load(staging, holders, products, dates, loaded).facts


# Rule names and messages of the validation report.
RULE_TEXT = {
    "holder": (
        "Account Holder Foreign Key Check",
        "All Account Holders references are valid",
        "Found orphaned fact records with invalid Account Holder references",
    ),
    "product": (
        "Bank Product Foreign Key Check",
        "All bank products references are valid",
        "Found orphaned fact records with invalid bank product references",
    ),
    "date": (
        "Date Foreign Key Check",
        "All date references are valid",
        "Found orphaned fact records with invalid date references",
    ),
    "amount": (
        "transactions amount Range Check",
        "All Transactions within valid range",
        "Found Transactions outside valid range ({low}-{high})",
    ),
    "future": ("Future Date Check", "No future-dated transactions found", "Found transactions with future dates"),
    "account": (
        "Account Holder number Check",
        "All Account Holder numbers are valid",
        "Found Account Holder Number not following the format CC|MTG|SAV|INV|SVC|LON|AUTO|CHK + [0-9]*6",
    ),
    "sequence": (
        "SCD Date Sequence Check",
        "All SCD date sequences are valid",
        "Found SCD records with effective_date > expiration_date",
    ),
    "current": (
        "SCD Current Record Logic Check",
        "All current records have null expiration dates",
        "Found current records with non-null expiration dates",
    ),
    "one_current": (
        "SCD Account Holder Uniqueness Check",
        "Each Account Holder has exactly one current record",
        "Found Account Holder with multiple current records",
    ),
    "unique": (
        "SCD Transaction Uniqueness Check",
        "Each Transaction has exactly one current record",
        "Found Transaction with multiple current records",
    ),
}


def _rule(name: str, failed=None, **values) -> TableRule:
    title, passed, broken = RULE_TEXT[name]
    return TableRule(title, F.lit(False) if failed is None else failed, passed, broken.format(**values) if values else broken)


def validation_suite(
    facts: DataFrame,
    holders: DataFrame,
    products: DataFrame,
    dates: DataFrame,
    as_of: date,
    limits: tuple[float, float] = AMOUNT_LIMITS,
    check_date: date | None = None,
) -> DataFrame:
    """Ten checks, one result row each, with ``check_date`` if one is given.

    Facts are read three times: for their key sets, for the rules on rows, for unique ids. The date of a fact is
    compared through its key, which orders like the date, so no rule joins single facts.
    """
    references, of_known, row_rules = _fact_rules(holders, products, dates, as_of, limits)
    results = combine(
        [
            check_key_sets(facts, references, FACT_TABLE, of_known),
            check_rows(facts, FACT_TABLE, row_rules),
            check_unique(facts, "transaction_id", FACT_TABLE, _rule("unique")),
            _check_holders(holders),
        ]
    )
    return results if check_date is None else results.withColumn("check_date", F.lit(check_date))


FACT_TABLE, HOLDER_TABLE = "fact_transactions", "dim_account_holder"


def _row_rules(limits: tuple[float, float]) -> list[TableRule]:
    return [
        _rule("amount", ~between_inclusive("transaction_amount", *limits), low=limits[0], high=limits[1]),
        _rule("account", ~F.coalesce(code_pattern("account_number", ACCOUNT_PREFIXES, 6), F.lit(False))),
    ]


def _fact_rules(holders: DataFrame, products: DataFrame, dates: DataFrame, as_of: date, limits: tuple[float, float]):
    """What facts are checked for: key columns with dimension and rule, rules on known keys, rules on rows."""
    references = {
        HOLDER_SURROGATE: (holders, _rule("holder")),
        "banking_product_key": (products, _rule("product")),
        "date_key": (dates, _rule("date")),
    }
    future = _rule("future", F.col("date_key") > int(as_of.strftime("%Y%m%d")))
    return references, {"date_key": [future]}, _row_rules(limits)


def _check_holders(holders: DataFrame) -> DataFrame:
    history_rules = [
        _rule("sequence", F.col("effective_date") > F.col("expiration_date")),
        _rule("current", F.col("is_current") & F.col("expiration_date").isNotNull()),
    ]
    return combine(
        [
            check_rows(holders, HOLDER_TABLE, history_rules),
            check_unique(holders, HOLDER_KEY, HOLDER_TABLE, _rule("one_current"), F.col("is_current")),
        ]
    )


def refresh_check_states(facts: DayPartitions, store: str, limits: tuple[float, float] = AMOUNT_LIMITS) -> list[str]:
    """Bring the check states of the facts' days up to date; returns the days that were read. See ``DayStates``."""
    return _check_states(limits).refresh(facts, store)


def _check_states(limits: tuple[float, float]) -> DayStates:
    failed = [F.count_if(rule.failed).cast("bigint").alias(f"failed_{i}") for i, rule in enumerate(_row_rules(limits))]
    count = F.count("*").alias("row_count")
    return DayStates(
        {
            "keys": lambda rows: rows.groupBy("date_key", HOLDER_SURROGATE, "banking_product_key").agg(count),
            "rows": lambda rows: rows.groupBy("date_key").agg(count, *failed),
            "ids": lambda rows: rows.groupBy("date_key", "transaction_id").agg(count),
        },
        version=f"limits {limits}",
    )


def validation_from_states(
    store: str,
    holders: DataFrame,
    products: DataFrame,
    dates: DataFrame,
    as_of: date,
    limits: tuple[float, float] = AMOUNT_LIMITS,
) -> DataFrame:
    """``validation_suite`` from the days' stored check states. The facts are not read: keys were counted per day, rows were
    judged, and ids are one narrow column, which alone still meets by value, as a copy may lie in another day."""
    references, of_known, row_rules = _fact_rules(holders, products, dates, as_of, limits)
    states = _check_states(limits).read(holders.sparkSession, store)
    return combine(
        [
            check_key_sets(states["keys"], references, FACT_TABLE, of_known, "row_count"),
            check_row_counts(states["rows"], FACT_TABLE, row_rules),
            check_unique(states["ids"], "transaction_id", FACT_TABLE, _rule("unique"), weight="row_count"),
            _check_holders(holders),
        ]
    )


def _dated(df: DataFrame) -> DataFrame:
    """The day of a date key, which is the day written as a number."""
    return df.withColumn("transaction_date", F.to_date(F.col("date_key").cast("string"), "yyyyMMdd"))


def _holder_columns(holders: DataFrame, *columns: str) -> DataFrame:
    return holders.where("is_current").select(HOLDER_SURROGATE, "account_holder_name", "relationship_tier", *columns)


_ORDERED = (HOLDER_SURROGATE, "date_key", "transaction_id", "transaction_amount")


def _amounts(facts: DataFrame, dates: DataFrame) -> DataFrame:
    """What the ordered calculations need, of the facts with a known day."""
    return facts.select(*_ORDERED).join(dates.select("date_key"), "date_key", "left_semi")


def moving_average_3(facts: DataFrame, holders: DataFrame, dates: DataFrame) -> DataFrame:
    """Average over the last three transactions, for holders with at least three (of known days)."""
    averaged = ordered.moving_average(_amounts(facts, dates), *_ORDERED, "moving_3_transaction_avg")
    frequent = averaged.groupBy(HOLDER_SURROGATE).count().where("count >= 3").select(HOLDER_SURROGATE)
    shown = _holder_columns(holders).join(frequent, HOLDER_SURROGATE, "left_semi")
    return _dated(averaged).join(shown, HOLDER_SURROGATE).drop("date_key")


def running_balance(facts: DataFrame, holders: DataFrame, dates: DataFrame) -> DataFrame:
    """Balance after each transaction."""
    summed = ordered.running_sum(_amounts(facts, dates), *_ORDERED, "account_running_balance")
    return _dated(summed).join(_holder_columns(holders, "address"), HOLDER_SURROGATE).drop("date_key")


def transaction_dense_rank(
    facts: DataFrame, holders: DataFrame, products: DataFrame, dates: DataFrame
) -> DataFrame:
    """Rank of each transaction among its holder's amounts, the highest first. Only transactions
    with a known product and day count."""
    offered = products.select("banking_product_key", "product_name", "product_category")
    known = facts.select(*_ORDERED, "banking_product_key").join(dates.select("date_key"), "date_key", "left_semi")
    known = stage_table(known.join(offered, "banking_product_key"), "ranked-transactions")
    ranked = ordered.dense_rank_desc(known, HOLDER_SURROGATE, "transaction_amount", "account_holder_transaction_rank")
    return (
        _dated(ranked)
        .join(_holder_columns(holders), HOLDER_SURROGATE)
        .select(
            HOLDER_SURROGATE,
            "account_holder_name",
            "relationship_tier",
            "transaction_date",
            "transaction_id",
            "transaction_amount",
            "product_name",
            "product_category",
            "account_holder_transaction_rank",
        )
    )
