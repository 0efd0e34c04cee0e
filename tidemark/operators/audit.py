"""Inventory audits: required and forbidden files, terms, needles and tool pins. All failures accumulate.

Rule tables (paths, terms, needles, pins) are what a person writes down; they are broadcast only
while they hold at most RULES_BROADCAST rows, and are joined by shuffle on the path otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.folding import fold
from .terms import scan_terms

RULES_BROADCAST = 10_000


def small(rules: DataFrame) -> DataFrame:
    """`rules` with a broadcast hint if a count shows that they are few."""
    return F.broadcast(rules) if rules.limit(RULES_BROADCAST + 1).count() <= RULES_BROADCAST else rules


def missing_files(files: DataFrame, required: DataFrame) -> DataFrame:
    """Required paths without a file."""
    return required.select("path").distinct().join(files.select("path"), "path", "left_anti").select(F.concat(F.lit("missing required file: "), "path").alias("failure"))


def forbidden_files(files: DataFrame, forbidden: DataFrame) -> DataFrame:
    """Forbidden paths that have a file."""
    return forbidden.select("path").distinct().join(files.select("path"), "path", "left_semi").select(F.concat(F.lit("obsolete file still present: "), "path").alias("failure"))


def term_hits(files: DataFrame, terms: DataFrame, what: str = "obsolete runtime term") -> DataFrame:
    """(path, term) rules whose file holds the term in any case. An equi-join on the path, then a contains filter."""
    hits = files.select("path", "text").join(small(terms.select("path", "term")), "path").where(F.contains(fold(F.col("text")), fold(F.col("term"))))
    return hits.select(F.concat(F.lit(f"{what} '"), "term", F.lit("' remains in "), "path").alias("failure"))


def any_term_hits(files: DataFrame, terms: DataFrame, what: str = "obsolete runtime term") -> DataFrame:
    """The same where every term is looked for in every file: each text is read once for all terms (see `scan_terms`)."""
    hits = scan_terms(files.select("path", "text"), terms)
    return hits.select(F.concat(F.lit(f"{what} '"), "term", F.lit("' remains in "), "path").alias("failure"))


def missing_needles(files: DataFrame, needles: DataFrame) -> DataFrame:
    """Messages of (path, needle, message) rules whose file exists but lacks the needle."""
    return files.select("path", "text").join(small(needles.select("path", "needle", "message")), "path").where(~F.contains("text", F.col("needle"))).select(F.col("message").alias("failure"))


def contract_failures(contracts: DataFrame, scalars: dict[str, str], banned: list[str], pins: dict[str, tuple[str, str]], value_col: str = "value") -> DataFrame:
    """Failures (with the other columns) of a JSON contract: scalars to equal, keys it must not have, and the exact set of tools with version and digest."""
    fields = F.from_json(value_col, "map<string,variant>")
    get = lambda key: F.try_variant_get(F.get(F.map_values(F.map_filter(fields, lambda k, _: k == key)), F.lit(0)), "$", "string")
    tools = F.from_json(value_col, "tools array<struct<id:string,version:string,sha256:string>>")["tools"]
    tools = F.coalesce(tools, F.array().cast("array<struct<id:string,version:string,sha256:string>>"))
    ids = F.array_sort(F.array_distinct(F.transform(tools, lambda t: t["id"])))
    leaked = F.array_sort(F.array_intersect(F.map_keys(fields), F.array(*map(F.lit, banned)) if banned else F.array().cast("array<string>")))
    wanted = F.array(*map(F.lit, sorted(pins))) if pins else F.array().cast("array<string>")
    own = F.size(F.array_except(ids, wanted)) + F.size(F.array_except(wanted, ids)) > 0
    checks = [F.when(~get(k).eqNullSafe(v), f"{k} must be {v}") for k, v in scalars.items()]
    checks.append(F.when(F.size(leaked) > 0, F.concat(F.lit("project truth keys in contract: "), F.array_join(leaked, ", "))))
    checks.append(F.when(own, F.concat(F.lit("unexpected tool set: "), F.array_join(ids, ", "))))

    def pinned(name: str, version: str, digest: str) -> Column:
        tool = F.try_element_at(F.filter(tools, lambda t: t["id"] == name), F.lit(-1))
        return F.when(~own & ~(tool["version"].eqNullSafe(version) & tool["sha256"].eqNullSafe(digest)), f"{name} version/hash pin mismatch")

    checks += [pinned(name, *pin) for name, pin in pins.items()]
    found = F.filter(F.array(*checks), lambda c: c.isNotNull())
    return contracts.select(*[c for c in contracts.columns if c != value_col], F.explode(found).alias("failure"))


def tool_versions(contracts: DataFrame, value_col: str = "value") -> DataFrame:
    """`contracts` with a map `versions` from tool id to version; of equal ids the last counts."""
    tools = F.from_json(value_col, "tools array<struct<id:string,version:string>>")["tools"]
    ids = F.array_distinct(F.transform(tools, lambda t: t["id"]))
    last = F.transform(ids, lambda i: F.struct(i.alias("key"), F.try_element_at(F.filter(tools, lambda t: t["id"] == i), F.lit(-1))["version"].alias("value")))
    return contracts.withColumn("versions", F.map_from_entries(last))


def audit(*checks: DataFrame) -> DataFrame:
    """All failures of several checks."""
    return reduce(DataFrame.unionByName, checks)


def summary(failures: DataFrame) -> DataFrame:
    """ok and the number of failures."""
    return failures.agg(F.count("*").alias("failures")).select((F.col("failures") == 0).alias("ok"), "failures")
