"""Users: dump rows to the 12-column processed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.text import normalize_text
from threadloom.operators import classify
from threadloom.operators.places import country_and_continent, location_text
from threadloom.operators.validate import reject_reason, rejected, typed
from threadloom.plans.load import replay, run_dump
from threadloom.schemas import USERS, USERS_PROCESSED


def user_reject_reason() -> Column:
    return reject_reason(USERS)


def users_processed(raw: DataFrame, places=None, degrees=None, academic=None, practical=None) -> DataFrame:
    """Normalised bio, user type, degree, country and continent of the valid rows."""
    # Both texts through one expression: its entity tables are in the plan once.
    texts = F.transform(F.array(F.col("AboutMe"), location_text(F.col("Location"))), normalize_text)
    normalized = raw.where(user_reject_reason().isNull()).select("*", texts.alias("_texts")).select(
        "*", F.col("_texts")[0].alias("_bio"), F.col("_texts")[1].alias("_location"))
    placed = normalized.select(
        "*", F.inline(F.array(country_and_continent(F.col("_location"), places))))
    values = {c: typed(USERS, c) for c in USERS if c != "WebsiteUrl"} | {
        "Location": F.coalesce("Location", F.lit("")),
        "AboutMe": F.col("_bio"),
        "UserType": classify.user_type(F.col("_bio"), F.col("WebsiteUrl"), academic, practical),
        "Degree": classify.degree(F.col("_bio"), degrees),
        "Country": F.col("country"),
        "Continent": F.col("continent"),
    }
    return placed.select(*[values[f.name].alias(f.name) for f in USERS_PROCESSED])


def users_rejected(raw: DataFrame) -> DataFrame:
    return rejected(raw, user_reject_reason())


def run_users(spark: SparkSession, src, dst: str, rejects: str | None = None, reader: str = "text", run: str | None = None,
              **options) -> dict:
    """Dump to processed table, appended, read and parsed once; rejected rows as JSON in ``rejects``, by default beside
    the table. ``reader``: "text" for a row per line, "xml" for other layouts. Both are published when all is written;
    a dump that was loaded already adds nothing, unless it is named as another ``run``. Returns the run counters
    with the elapsed seconds."""
    return run_dump(spark, src, reader, run, USERS, **_plan(dst, rejects, options))


def replay_users(spark: SparkSession, corrected: DataFrame, dst: str, rejects: str | None = None, run: str | None = None, **options) -> dict:
    """Corrected rejects (see ``read_rejects``) to the same tables; their old entries are resolved."""
    return replay(spark, corrected, USERS, run=run, **_plan(dst, rejects, options))


def _plan(dst: str, rejects: str | None, options: dict) -> dict:
    return {"reason": user_reject_reason(), "transform": lambda good: users_processed(good, **options), "schema": USERS_PROCESSED,
            "dst": dst, "rejects": rejects or f"{dst}-rejected"}
