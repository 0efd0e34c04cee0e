"""Status normalisation and payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

#: States that keep their name.
STATES = ("success", "failure", "pending", "error")


def normalize_result(result: Column) -> Column:
    value = F.lower(strip(F.coalesce(result, F.lit(""))))
    return F.when(value.isin(*STATES), value).otherwise("error")


def payload(context: Column, result: Column, repository: Column, run_id: Column) -> Column:
    """struct(state, context, description of at most 140 characters, target_url)."""
    state = normalize_result(result)
    url = F.concat(F.lit("https://github.com/"), repository, F.lit("/actions/runs/"), run_id)
    return F.struct(state.alias("state"), context.alias("context"), F.left(F.concat(context, F.lit(": "), state), F.lit(140)).alias("description"), url.alias("target_url"))


def precondition(context: Column, repository: Column, sha: Column, run_id: Column, token: Column) -> Column:
    """The first unmet precondition of publishing, or null."""
    trimmed = lambda c: strip(F.coalesce(c, F.lit("")))
    size = F.length(trimmed(context))
    return (
        F.when((size == 0) | (size > 100), "context must be 1..100 characters")
        .when(~F.contains(trimmed(repository), F.lit("/")), "repository is required")
        .when(F.length(trimmed(sha)) != 40, "sha must have 40 characters")
        .when(~trimmed(run_id).rlike(r"\A\p{Nd}+\z"), "run id is required")
        .when(trimmed(token) == "", "token is required")
    )


def latest(statuses: DataFrame, by: list[str], order: str) -> DataFrame:
    """The last status of each key: one partial aggregate."""
    rest = [c for c in statuses.columns if c not in by]
    return statuses.groupBy(*by).agg(F.max(F.struct(order, *(c for c in rest if c != order))).alias("_last")).select(*by, "_last.*")
