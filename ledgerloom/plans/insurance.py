"""Insurance star schema: raw customers, policies and claims to dimensions and claim facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import at_least, below, case_bucket, map_synonyms
from ..functions.dates import age_in_years, date_key, parse_iso_date
from ..functions.numbers import safe_double
from ..functions.text import clean_text, email_key, standardize_phone, strip
from ..operators.dimensions import needed_date_keys, scd1_upsert
from ..operators.facts import FactLoad, load_facts, safe_fraction
from ..operators.keys import first_per_key
from ..operators.quality import orphan_report
from ..session import stage_table

# Tier bounds, policy types and agent regions.
PREMIUM_TIERS = [(2000, "Premium"), (1000, "Standard")]
POLICY_TYPES = ("Auto", "Home", "Life")
AGENT_REGIONS = [(6, "North"), (11, "South")]
CLAIM_STATUSES = {"Open": ("OPEN", "O"), "Closed": ("CLOSED", "C"), "Pending": ("PENDING", "P"), "Denied": ("DENIED", "D")}


def customer_warnings() -> list[tuple[Column, str]]:
    email = F.col("email")
    return [((email != "") & ~email.contains("@"), "invalid email format")]


def policy_warnings(types: Sequence[str] = POLICY_TYPES) -> list[tuple[Column, str]]:
    return [
        (F.col("customer_id") == "", "missing customer_id"),
        (~F.col("policy_type").isin(list(types)), "invalid policy_type"),
        (F.col("coverage_amount") <= 0, "invalid coverage_amount"),
        (F.col("annual_premium") <= 0, "invalid annual_premium"),
    ]


def claim_warnings() -> list[tuple[Column, str]]:
    return [
        (F.col("policy_id") == "", "missing policy_id"),
        (F.col("customer_id") == "", "missing customer_id"),
        (
            (F.col("claim_amount") > F.col("coverage_amount")) & (F.col("coverage_amount") > 0),
            "claim amount exceeds coverage",
        ),
    ]


def risk_tier(score: Column, age: Column, young: int = 25, high: float = 3.0, low: float = 2.0) -> Column:
    return case_bucket([((age < young) | (score >= high), "High"), (score < low, "Low")], "Medium")


def premium_tier(premium: Column, tiers: Sequence[tuple[float, str]] = PREMIUM_TIERS) -> Column:
    return at_least(premium, tiers, "Economy")


def valid_claim_amount(claim: Column, coverage: Column) -> Column:
    return (claim > 0) & (claim <= coverage)


def prepare_customers(customers: DataFrame, as_of: date) -> DataFrame:
    """Clean names, phone and e-mail; add age and risk tier. One row per input row."""
    first, last = clean_text("first_name"), clean_text("last_name")
    birth = parse_iso_date("birth_date")
    age, score = age_in_years(birth, as_of), safe_double("risk_score")
    return customers.select(
        "customer_id",
        first.alias("first_name"),
        last.alias("last_name"),
        F.trim(F.concat_ws(" ", first, last)).alias("full_name"),
        F.lower(strip("email")).alias("email"),
        standardize_phone("phone").alias("phone"),
        birth.alias("birth_date"),
        age.alias("age"),
        strip("city").alias("city"),
        strip("state").alias("state"),
        score.alias("risk_score"),
        risk_tier(score, age).alias("risk_tier"),
        parse_iso_date("customer_since").alias("customer_since"),
    )


def prepare_policies(policies: DataFrame) -> DataFrame:
    """Standard policy type, safe amounts, premium tier, status Active when not given."""
    premium = safe_double("annual_premium")
    return policies.select(
        "policy_id",
        "customer_id",
        clean_text("policy_type").alias("policy_type"),
        safe_double("coverage_amount").alias("coverage_amount"),
        premium.alias("annual_premium"),
        premium_tier(premium).alias("premium_tier"),
        safe_double("deductible").alias("deductible"),
        parse_iso_date("effective_date").alias("effective_date"),
        parse_iso_date("expiration_date").alias("expiration_date"),
        F.coalesce(F.nullif(strip("status"), F.lit("")), F.lit("Active")).alias("status"),
    )


def prepare_claims(claims: DataFrame, statuses: Mapping[str, Sequence[str]] = CLAIM_STATUSES) -> DataFrame:
    """Date keys (0 when missing), days from filing to closing, standard status.

    Claims stay in the frame whatever their amount; the fact load rejects invalid ones.
    """
    filed, closed = parse_iso_date("filed_date"), parse_iso_date("closed_date")
    return claims.select(
        "claim_id",
        "policy_id",
        "customer_id",
        "agent_id",
        date_key(filed).alias("filed_date_key"),
        date_key(closed).alias("closed_date_key"),
        safe_double("claim_amount").alias("claim_amount"),
        safe_double("coverage_amount").alias("coverage_amount"),
        safe_double("deductible_amount").alias("deductible_amount"),
        safe_double("payout_amount").alias("payout_amount"),
        F.datediff(closed, filed).alias("processing_days"),
        map_synonyms("claim_status", statuses, "Unknown").alias("claim_status"),
    )


def derive_agents(claims: DataFrame, prefix: str = "AGT", max_experience: int = 15) -> DataFrame:
    """One row per agent id found in the claims. Years of experience are estimated from the id."""
    agents = claims.where("agent_id <> ''").select("agent_id").distinct()
    agent = F.col("agent_id")
    numbered = agent.startswith(prefix)
    rest = F.regexp_replace(agent, f"^{prefix}", "")
    number = F.when(numbered, F.coalesce(rest.try_cast("int"), F.lit(0))).otherwise(0)
    return agents.select(
        "agent_id",
        F.when(numbered, "Agent").otherwise(agent).alias("first_name"),
        F.when(numbered & (rest != ""), rest).otherwise(agent).alias("last_name"),
        F.concat(F.lit("Agent "), agent).alias("full_name"),
        below(number, AGENT_REGIONS, "Central").alias("region"),
        (email_key(agent, max_experience) + 1).alias("experience_years"),
        F.lit(None).cast("date").alias("hire_date"),
    )


def claim_date_keys(claims: DataFrame) -> DataFrame:
    return needed_date_keys(claims, ["filed_date_key", "closed_date_key"])


def load_claims(
    claims: DataFrame,
    customers: DataFrame,
    policies: DataFrame,
    agents: DataFrame,
    loaded: DataFrame | None = None,
    store: bool = True,
) -> FactLoad:
    """Claim facts with surrogate keys, rejects by reason, and counters. ``store`` as in ``load_facts``."""
    amount_ok = valid_claim_amount(F.col("claim_amount"), F.col("coverage_amount"))
    load = load_facts(
        claims,
        "claim_id",
        {
            "customer_id": (customers, "customer_key"),
            "policy_id": (policies, "policy_key"),
            "agent_id": (agents, "agent_key"),
        },
        [(amount_ok, "invalid amount"), (F.col("filed_date_key") > 0, "invalid filed date")],
        ["claim_amount", "agent_id", "filed_date_key", "closed_date_key", "payout_amount"],
        loaded,
        store=store,
        first=["policy_id", "agent_id"],
    )
    facts = load.facts.select(
        "claim_id",
        "customer_key",
        "policy_key",
        "agent_key",
        "filed_date_key",
        F.nullif(F.col("closed_date_key"), F.lit(0)).alias("closed_date_key"),
        "claim_amount",
        "coverage_amount",
        "deductible_amount",
        "payout_amount",
        "processing_days",
        "claim_status",
        safe_fraction(F.col("claim_amount"), F.col("coverage_amount")).alias("claim_to_coverage_ratio"),
    )
    return FactLoad(facts, load.rejects, load.counters)


def claim_orphans(
    facts: DataFrame, customers: DataFrame, policies: DataFrame, agents: DataFrame, dates: DataFrame
) -> DataFrame:
    return orphan_report(
        facts,
        {
            "customers": ("customer_key", customers),
            "policies": ("policy_key", policies),
            "agents": ("agent_key", agents),
            "filed_dates": ("filed_date_key", dates.withColumnRenamed("date_key", "filed_date_key")),
        },
    )


def load_star(
    raw: Mapping[str, DataFrame], dimensions: Mapping[str, DataFrame], loaded: DataFrame | None, as_of: date
) -> tuple[dict[str, DataFrame], FactLoad]:
    """Dimensions after an overwrite load of ``raw`` and the claims resolved against them.

    ``raw`` has customers, policies and claims; ``dimensions`` the current dim_customer,
    dim_policy and dim_agent. The new dimensions are stored before the claims look their keys up.
    """
    prepared = {
        "dim_customer": (prepare_customers(raw["customers"], as_of), "customer_id", "customer_key"),
        "dim_policy": (prepare_policies(raw["policies"]), "policy_id", "policy_key"),
        "dim_agent": (derive_agents(raw["claims"]), "agent_id", "agent_key"),
    }
    new = {}
    for name, (rows, key, surrogate) in prepared.items():
        one_each = first_per_key(rows, [key], [c for c in rows.columns if c != key])
        new[name] = stage_table(scd1_upsert(dimensions[name], one_each, key, surrogate), name)
    claims = prepare_claims(raw["claims"])
    return new, load_claims(claims, new["dim_customer"], new["dim_policy"], new["dim_agent"], loaded)
