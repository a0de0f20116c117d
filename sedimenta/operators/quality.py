"""Checks, contracts, expectations and gates.

All row-level rules of a table are evaluated in one scan and one aggregation. Rules that need a
grouping (uniqueness, references) combine equal keys before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The names a contract may use for column types.
CONTRACT_TYPES = {
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType, T.DecimalType),
    "string": (T.StringType,),
    "email": (T.StringType,),
}


class GateClosed(RuntimeError):
    """Raised before a publish when a check failed."""


@dataclass(frozen=True)
class Rule:
    """One expectation on a column; ``args`` depend on the kind."""

    name: str
    kind: str
    column: str | None = None
    args: tuple = ()


@dataclass(frozen=True)
class Contract:
    """What a producer promises about a table."""

    name: str
    required: tuple[str, ...] = ()
    types: dict[str, str] = field(default_factory=dict)
    rules: tuple[Rule, ...] = ()

    @staticmethod
    def from_spec(name: str, spec: dict) -> "Contract":
        """From the parsed form of a contract file."""
        rules = []
        for check in spec.get("checks", []):
            arg = check.get("pattern", check.get("value"))
            rules.append(Rule(check["name"], check["rule"], check["column"], () if arg is None else (arg,)))
        return Contract(name, tuple(spec.get("required_columns", ())), dict(spec.get("column_types", {})), tuple(rules))


def violated(rule: Rule) -> Column:
    """Row predicate that is true where the rule is broken. Except for not_null and all_present, NULL passes.

    The rules over several columns name them in ``args``: ``all_present`` the columns, ``none_where`` a condition that
    no row may fulfil.
    """
    c = F.col(rule.column) if rule.column else None
    broken = {
        "not_null": lambda: c.isNull(),
        "not_empty": lambda: c.isNull() | (c.cast("string") == ""),
        "regex": lambda: ~c.rlike(rule.args[0]),
        "contains": lambda: ~c.contains(rule.args[0]),
        "min": lambda: c < rule.args[0],
        "gt": lambda: c <= rule.args[0],
        "between": lambda: ~c.between(*rule.args),
        "all_present": lambda: reduce(Column.__or__, [F.col(a).isNull() for a in rule.args]),
        "none_where": lambda: F.expr(rule.args[0]),
        "length": lambda: ~F.length(c).between(*rule.args),
    }[rule.kind]()
    return F.coalesce(broken, F.lit(False))


def _is_row_rule(rule: Rule) -> bool:
    return rule.kind not in ("unique", "row_count_between")


def failed_rules(rules: list[Rule] | tuple[Rule, ...]) -> Column:
    """Names of the row rules a row breaks."""
    names = F.array(*[F.when(violated(r), F.lit(r.name)) for r in rules if _is_row_rule(r)])
    return F.array_compact(names)


def evaluate(df: DataFrame, rules: list[Rule] | tuple[Rule, ...]) -> DataFrame:
    """One row per rule: name, type, failed count and status."""
    row_rules = [r for r in rules if r.kind != "unique"]
    counts = [_count(r).alias(f"c{i}") for i, r in enumerate(row_rules)]
    results = []
    if row_rules:
        entries = [F.struct(F.lit(r.name).alias("check_name"), F.lit(r.kind).alias("check_type"),
                            F.col(f"c{i}").alias("failed_count")) for i, r in enumerate(row_rules)]
        results.append(df.agg(*counts).select(F.explode(F.array(*entries)).alias("r")).select("r.*"))
    for rule in rules:
        if rule.kind == "unique":
            results.append(_surplus(df, rule))
    return reduce(DataFrame.unionByName, results).withColumn(
        "status", F.when(F.col("failed_count") == 0, "PASSED").otherwise("FAILED")
    )


def as_results(results: DataFrame, run_id: str, pipeline_id: str, check_ts: str) -> DataFrame:
    """Check outcomes as rows of the quality log."""
    return results.select(
        F.lit(run_id).alias("run_id"), F.lit(pipeline_id).alias("pipeline_id"),
        "check_name", "check_type", "status", "failed_count",
        F.lit(check_ts).cast("timestamp_ntz").alias("check_timestamp"),
    )


def _count(rule: Rule) -> Column:
    if rule.kind == "row_count_between":
        low, high = rule.args
        n = F.count(F.lit(1))
        short = n < low
        return F.when(short if high is None else short | (n > high), 1).otherwise(0).cast("bigint")
    return F.count(F.when(violated(rule), 1))


def _surplus(df: DataFrame, rule: Rule) -> DataFrame:
    return df.groupBy(rule.column).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("failed_count")
    ).select(F.lit(rule.name).alias("check_name"), F.lit("unique").alias("check_type"), "failed_count")


def structure(df: DataFrame, contract: Contract) -> DataFrame:
    """Missing columns and wrong types, from the schema alone."""
    fields = {f.name: f.dataType for f in df.schema}
    rows = [(f"has_{c}", "schema", 0 if c in fields else 1) for c in contract.required]
    for column, wanted in contract.types.items():
        ok = isinstance(fields.get(column), CONTRACT_TYPES[wanted])
        rows.append((f"{column}_is_{wanted}", "schema", 0 if ok else 1))
    frame = df.sparkSession.createDataFrame(rows, "check_name string, check_type string, failed_count bigint")
    return frame.withColumn("status", F.when(F.col("failed_count") == 0, "PASSED").otherwise("FAILED"))


def check_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Structural and value checks of a contract; ``email`` columns must contain an ``@``."""
    present = set(df.columns)
    rules = [r for r in contract.rules if r.column in present]
    rules += [Rule(f"{c}_contains_at", "contains", c, ("@",))
              for c, t in contract.types.items() if t == "email" and c in present]
    return structure(df, contract).unionByName(evaluate(df, rules))


def gate(results: DataFrame) -> DataFrame:
    """One verdict row: PUBLISH, HALT_PUBLISH, or HALT_RUN when the structure is wrong."""
    failed = F.col("status") == "FAILED"
    counts = results.agg(
        F.count("*").alias("checks"),
        F.count(F.when(failed, 1)).alias("failed_checks"),
        F.count(F.when(failed & (F.col("check_type") == "schema"), 1)).alias("failed_schema_checks"),
    )
    return counts.withColumn(
        "verdict",
        F.when(F.col("failed_schema_checks") > 0, "HALT_RUN")
        .when(F.col("failed_checks") > 0, "HALT_PUBLISH")
        .otherwise("PUBLISH"),
    )


def require_pass(results: DataFrame) -> None:
    """Raise ``GateClosed`` unless every check passed; call it right before the publish."""
    verdict = gate(results).first()
    if verdict["verdict"] != "PUBLISH":
        raise GateClosed(f"{verdict['verdict']}: {verdict['failed_checks']} of {verdict['checks']} checks failed")


def surplus_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows minus distinct keys; NULL keys count as violations."""
    return df.groupBy(key).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n")).otherwise(F.col("n") - 1)), F.lit(0))
        .cast("bigint").alias("violation_count")
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def orphan_count(facts: DataFrame, key: str, dim: DataFrame, name: str) -> DataFrame:
    """Facts without their dimension row. Facts are counted per key first, so hot keys shrink."""
    per_key = facts.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.join(dim.select(key), key, "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphan_count")
    ).select(F.lit(name).alias("check_name"), "orphan_count")


def pii_columns(df: DataFrame, forbidden: tuple[str, ...]) -> list[str]:
    """Forbidden column names present in a frame."""
    return [c for c in df.columns if c in forbidden]


def pii_value_counts(df: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Per string column and pattern: in how many rows the value shows up."""
    columns = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    cells = [(c, label, pattern) for c in columns for label, pattern in patterns.items()]
    counts = df.agg(*[F.count(F.when(F.col(c).rlike(p), 1)).alias(f"c{i}") for i, (c, _, p) in enumerate(cells)])
    entries = [F.struct(F.lit(c).alias("column_name"), F.lit(label).alias("pattern"),
                        F.col(f"c{i}").alias("row_count")) for i, (c, label, _) in enumerate(cells)]
    return counts.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def schema_drift(payloads: DataFrame, key: str, payload: str, expected: dict[str, str]) -> DataFrame:
    """Unexpected fields, missing fields and values of the wrong type in JSON payloads.

    Payloads are read as string maps, so unknown fields survive and one bad record spoils no other. A payload
    that is null or no JSON object lacks every field.
    """
    fields = F.from_json(payload, "map<string,string>")
    names = F.array(*[F.lit(n) for n in expected])
    parsed = payloads.select(key, payload, fields.alias("_m"))
    wrong = F.array_compact(F.array(*[
        F.when(F.col("_m")[n].isNotNull() & F.col("_m")[n].try_cast(t).isNull(), F.lit(n))
        for n, t in expected.items()
    ]))
    return parsed.select(
        key,
        payload,
        F.concat_ws(",", F.array_sort(F.array_except(F.map_keys("_m"), names))).alias("unexpected_fields"),
        F.concat_ws(",", F.array_sort(F.array_except(names, F.coalesce(F.map_keys("_m"), F.array().cast("array<string>"))))).alias("missing_fields"),
        F.concat_ws(",", wrong).alias("mistyped_fields"),
    ).where((F.col("unexpected_fields") != "") | (F.col("missing_fields") != "") | (F.col("mistyped_fields") != ""))
