"""The severity gate over nested scan reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the severity from which a finding counts.
THRESHOLD = 7.0
SCHEMA = """runs array<struct<
    tool:struct<driver:struct<rules:array<struct<id:string,properties:map<string,string>>>>>,
    results:array<struct<ruleId:string,ruleIndex:bigint,message:struct<text:string,markdown:string>,
        locations:array<struct<physicalLocation:struct<artifactLocation:struct<uri:string>,region:struct<startLine:bigint>>>>>>>>"""


def high_findings(reports: DataFrame, value_col: str = "value", threshold: float = THRESHOLD) -> DataFrame:
    """Findings (the other columns, rule_id, security_severity, location, message) whose rule is `threshold` or above.

    A result's rule is found by index, else by id, of equal ids the last. Results without a rule or
    without a numeric severity are no findings. The look-up stays inside the row: no shuffle.
    """
    others = [c for c in reports.columns if c != value_col]
    runs = reports.select(*others, F.explode(F.from_json(value_col, SCHEMA)["runs"]).alias("run"))
    rows = runs.select(*others, F.coalesce("run.tool.driver.rules", F.array().cast("array<struct<id:string,properties:map<string,string>>>")).alias("rules"), F.explode("run.results").alias("r"))
    index = F.col("r.ruleIndex")
    by_index = F.when((index >= 0) & (index < F.size("rules")), F.get("rules", index.cast("int")))
    by_id = F.try_element_at(F.filter("rules", lambda x: (x["id"] == F.col("r.ruleId")) & (x["id"] != "")), F.lit(-1))
    rows = rows.withColumn("rule", F.coalesce(by_index, by_id))
    severity = F.expr("try_cast(try_element_at(rule.properties, 'security-severity') as double)")
    place = F.get("r.locations", F.lit(0))["physicalLocation"]
    line = place["region"]["startLine"]
    location = F.concat(F.coalesce(place["artifactLocation"]["uri"], F.lit("")), F.when(line != 0, F.concat(F.lit(":"), line.cast("string"))).otherwise(""))
    filled = lambda c: F.nullif(c, F.lit(""))
    found = rows.withColumn("security_severity", severity).where(~(F.col("security_severity") < threshold))
    return found.select(
        *others,
        F.coalesce(filled(F.col("r.ruleId")), F.col("rule.id")).alias("rule_id"),
        "security_severity",
        F.coalesce(location, F.lit("")).alias("location"),
        F.coalesce(filled(F.col("r.message.text")), F.col("r.message.markdown"), F.lit("")).alias("message"),
    )
