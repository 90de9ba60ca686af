"""Cleaning of the three raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tillroll.operators import quality
from tillroll.sources import schemas

TRANSACTION_CORE = [*schemas.TRANSACTIONS.fieldNames(), "year", "month", "day_of_week"]
CUSTOMER_CORE = ["customer_id", "postal_code"]


def cast_transactions(raw: DataFrame) -> DataFrame:
    return quality.date_features(quality.conform(raw, schemas.TRANSACTIONS), "t_dat")


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Typed, with date features, complete rows only. Equal rows are separate purchases and stay."""
    extra = [c for c in raw.columns if c not in TRANSACTION_CORE]
    typed = cast_transactions(raw)
    if extra:  # the declared columns are all protected, so only further ones can be constant
        typed = quality.drop_constant_columns(typed, keep=TRANSACTION_CORE)
    return quality.drop_null_rows(typed)


def cast_articles(raw: DataFrame) -> DataFrame:
    names = [c for c in schemas.columns_of(schemas.ARTICLES, "text") if c != "article_id"]
    return quality.normalise_text(quality.conform(raw, schemas.ARTICLES), names)


def clean_articles(raw: DataFrame) -> DataFrame:
    """Typed, lower-cased text, required columns present, one row per article."""
    usable = quality.require_columns(cast_articles(raw), schemas.REQUIRED_ARTICLE_COLUMNS)
    return quality.dedupe_by_key(usable, "article_id") if "article_id" in usable.columns else usable


def cast_customers(raw: DataFrame) -> DataFrame:
    return quality.cast_numbers(quality.cast_numbers(raw, ["age"], "int"), ["FN", "Active"], "double")


def clean_customers(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed, without constant columns, complete rows only; equal rows stay.

    Which columns are constant depends on the data, so this runs one aggregation.
    Name in ``keep`` the columns that later questions need whatever they hold.
    """
    typed = quality.drop_constant_columns(cast_customers(raw), keep=[*CUSTOMER_CORE, *keep])
    return quality.drop_null_rows(typed)
