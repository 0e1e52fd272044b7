"""Data quality: quarantine, rules, rule tables, count checks, contracts."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.functions.columns import clean_strings, drop_all_null
from tarnwork.operators.keys import join_null_safe
from tarnwork.operators.windows import dense_number


def quarantine(duplicates: DataFrame, run_id: str, when: datetime, drop: list[str] | None = None, status: str = "Quarantined") -> DataFrame:
    """Rows ready for the quarantine table: stamped with time, run and status, without the dropped columns."""
    return duplicates.drop(*(drop or [])).withColumns({
        "quarantined_date_time": F.lit(when), "etl_id": F.lit(run_id), "log_status": F.lit(status),
    })


def quarantine_log(
    duplicates: DataFrame, product: str, feed: str, source_system: str, dataset: str, run_id: str, keys: list[str], when: datetime,
    kind: str = "Duplicate", level: str = "Standard",
) -> DataFrame:
    """One log row for a batch of quarantined rows."""
    return duplicates.agg(F.count(F.lit(1)).cast("int").alias("total_rows")).select(
        F.lit(product).alias("product_name"), F.lit(feed).alias("feed_name"), F.lit(source_system).alias("source_system"),
        F.lit(dataset).alias("dataset_name"), F.lit(run_id).alias("etl_id"), "total_rows",
        F.lit(kind).alias("quarantine_type"), F.lit(level).alias("quarantine_level"), F.lit("~".join(keys)).alias("primary_key_list"),
        F.to_date(F.lit(when)).alias("log_date"), F.lit(when).alias("log_datetime"),
        F.lit(False).alias("is_notification_enabled"), F.lit(None).cast("timestamp").alias("notification_datetime"),
    )


def duplicate_alert(log: DataFrame, run_id: str) -> DataFrame:
    """Duplicates per table, type and level of one run, where there are any."""
    hit = log.filter((F.col("etl_id") == run_id) & (F.col("total_rows") > 0))
    return hit.groupBy("dataset_name", "quarantine_type", "quarantine_level", "etl_id").agg(
        F.sum("total_rows").cast("long").alias("duplicate_rows")
    )


@dataclass(frozen=True)
class Rule:
    """One expectation: ``{type, kwargs, meta}`` under a name."""

    name: str
    type: str
    kwargs: dict = field(default_factory=dict)
    meta: dict = field(default_factory=dict)


RULE_KWARGS = {
    "expect_column_values_to_not_be_null": {"column"},
    "expect_column_values_to_be_in_set": {"column", "value_set"},
    "expect_column_values_to_be_between": {"column", "min_value", "max_value"},
    "expect_column_values_to_match_regex": {"column", "regex"},
    "expect_column_value_lengths_to_be_between": {"column", "min_value", "max_value"},
    "expect_column_values_to_be_unique": {"column"},
    "expect_compound_columns_to_be_unique": {"column_list"},
    "expect_table_row_count_to_be_between": {"min_value", "max_value"},
}


def check_rule(rule: Rule) -> None:
    """Refuse an unknown rule type and options the rule would not follow. Row rules also take ``mostly``."""
    if rule.type not in RULE_KWARGS:
        raise ValueError(f"unknown rule type {rule.type!r}")
    known = RULE_KWARGS[rule.type] | (set() if rule.type in TABLE_RULES else {"mostly"})
    if unknown := sorted(set(rule.kwargs) - known):
        raise ValueError(f"rule {rule.name!r} has unknown options {unknown}")
    if not 0 <= rule.kwargs.get("mostly", 1) <= 1:
        raise ValueError(f"rule {rule.name!r}: mostly lies outside 0 to 1")


def row_condition(rule: Rule) -> Column:
    """Pass condition of a row rule. Null values pass every rule but not-null."""
    check_rule(rule)
    k = rule.kwargs
    c = F.col(k["column"])
    if rule.type == "expect_column_values_to_not_be_null":
        return c.isNotNull()
    if rule.type == "expect_column_values_to_be_in_set":
        ok = c.isin(k["value_set"])
    elif rule.type == "expect_column_values_to_be_between":
        ok = _between(c, k.get("min_value"), k.get("max_value"))
    elif rule.type == "expect_column_values_to_match_regex":
        ok = c.rlike(k["regex"])
    elif rule.type == "expect_column_value_lengths_to_be_between":
        ok = _between(F.length(c), k.get("min_value"), k.get("max_value"))
    else:
        raise ValueError(f"unknown rule type {rule.type!r}")
    return F.coalesce(ok, F.lit(True))


UNIQUE_RULES = {"expect_column_values_to_be_unique", "expect_compound_columns_to_be_unique"}
TABLE_RULES = {"expect_table_row_count_to_be_between"}


def _between(value: Column, low, high) -> Column:
    ok = F.lit(True)
    if low is not None:
        ok = ok & (value >= F.lit(low))
    if high is not None:
        ok = ok & (value <= F.lit(high))
    return ok


def with_rule_flags(df: DataFrame, rules: list[Rule], among: Column | None = None) -> DataFrame:
    """A boolean ``dq_<name>`` per row-level rule. Row rules are plain column conditions; a uniqueness rule joins the
    repeated keys only, found by a combined count. ``among`` limits the rows that count as repeating a key."""
    out = df
    for rule in rules:
        check_rule(rule)
        if rule.type in UNIQUE_RULES:
            cols = rule.kwargs.get("column_list") or [rule.kwargs["column"]]
            known = df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols], F.lit(True) if among is None else among))
            twice = known.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*cols, F.lit(True).alias("_twice"))
            out = join_null_safe(out, twice, cols, "left").withColumn(f"dq_{rule.name}", F.col("_twice").isNull()).drop("_twice")
        elif rule.type not in TABLE_RULES:
            out = out.withColumn(f"dq_{rule.name}", row_condition(rule))
    return out


def apply_rules(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean, failed, metrics) of rows that have no flags yet, see ``judge``."""
    return judge(with_rule_flags(df, rules), rules, df.columns)


def judge(flagged: DataFrame, rules: list[Rule], columns: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean, failed, metrics) of rows with the flags of ``with_rule_flags``.

    ``clean`` has the given columns; ``failed`` adds ``failed_rules`` (comma-separated); ``metrics`` has one row per
    rule: evaluated, failed, success. All row rules share one pass. A rule with ``mostly`` succeeds when at least that
    share of the rows passes; the rows that fail it are failed rows all the same.
    """
    names = [r.name for r in rules if r.type not in TABLE_RULES]
    ok = reduce(lambda a, b: a & b, [F.col(f"dq_{n}") for n in names], F.lit(True))
    clean = flagged.filter(ok).select(*columns)
    broken = F.concat_ws(",", *[F.when(~F.col(f"dq_{n}"), F.lit(n)) for n in names]) if names else F.lit("")
    failed = flagged.filter(~ok).select(*columns, broken.alias("failed_rules"))

    sums = flagged.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.when(~F.col(f"dq_{n}"), 1)).alias(f"_f_{n}") for n in names]
    )
    entries = []
    for r in rules:
        if r.type in TABLE_RULES:
            bad = (~_between(F.col("_rows"), r.kwargs.get("min_value"), r.kwargs.get("max_value"))).cast("long")
        else:
            bad = F.col(f"_f_{r.name}")
        good = (bad == 0) if r.type in TABLE_RULES else (F.col("_rows") - bad >= F.col("_rows") * F.lit(float(r.kwargs.get("mostly", 1))))
        entries.append(F.struct(
            F.lit(r.name).alias("rule_name"), F.lit(r.type).alias("rule_type"), F.col("_rows").alias("evaluated_rows"),
            bad.alias("failed_rows"), good.alias("success"),
        ))
    none = F.array().cast("array<struct<rule_name:string,rule_type:string,evaluated_rows:bigint,failed_rows:bigint,success:boolean>>")
    metrics = sums.select(F.explode(F.array(*entries) if entries else none).alias("m")).select("m.*")
    return clean, failed, metrics


def rules_succeeded(metrics: DataFrame) -> bool:
    return bool(metrics.agg(F.coalesce(F.bool_and("success"), F.lit(True))).first()[0])


def drop_rule_flags(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("dq_")])


def check_constraint(df: DataFrame, col: str, out: str = "is_valid") -> DataFrame:
    """1 when the text is a JSON object with a text ``type`` and an object ``kwargs``; ``meta`` may be absent or an
    object, not null. The kinds are those of the top-level fields; a document that names a field twice is not valid."""
    parsed = F.try_parse_json(F.col(col))

    def kind(path: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))

    ok = (kind("$.type") == "STRING") & kind("$.kwargs").startswith("OBJECT") & F.coalesce(kind("$.meta").startswith("OBJECT"), F.lit(True))
    return df.withColumn(out, F.coalesce(ok, F.lit(False)).cast("int"))


# The columns of a rule table.
RULE_COLUMNS = [
    "dq_rule_id", "data_product_name", "sub_domain_name", "dq_rule_description", "dq_rule_constraint", "dq_rule_dimension",
    "dq_screen_type", "dq_rule_applicable_lakehouse", "dq_rule_applicable_schema", "dq_rule_applicable_object",
    "dq_rule_applicable_attribute", "dq_rule_failure_action", "dq_rule_severity_score",
]


def build_rule_table(
    sheet: DataFrame, effective: datetime, expires: datetime = datetime(2099, 12, 31, 23, 59, 59), group: str | None = None,
    constraint: str = "dq_rule_constraint", order: list[str] | None = None,
) -> DataFrame:
    """Typed rule table from raw sheet rows: cleaned, rows without a constraint (and, with ``group``, those marked 'not
    active') left out, numbered in ``order``."""
    rows = drop_all_null(clean_strings(sheet))
    rows = rows.filter(F.coalesce(F.col(constraint), F.lit("")) != "")
    if group:
        rows = rows.filter(F.coalesce(F.lower(group), F.lit("")) != "not active")
    numbered = dense_number(rows, order or ["dq_rule_id"], "dq_rule_master_key", 1)
    chosen = [c for c in RULE_COLUMNS if c in rows.columns and c != "dq_rule_severity_score"]
    return numbered.select(
        F.col("dq_rule_master_key").cast("int").alias("dq_rule_master_key"), *chosen,
        F.expr("try_cast(dq_rule_severity_score as double)").alias("dq_rule_severity_score"),
        F.lit(True).alias("is_current_flag"), F.lit(effective).alias("row_effective_date"), F.lit(expires).alias("row_expiration_date"),
    )


def rule_documents(table: DataFrame) -> DataFrame:
    """The rule table as one JSON document per rule."""
    return table.select(F.to_json(F.struct(*table.columns)).alias("dq_json"))


def add_rule_flags(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """0 where the (bad) condition holds, else 1."""
    return df.withColumns({n: F.when(bad, 0).otherwise(1) for n, bad in rules.items()})


def validate_counts(source: DataFrame, processed: DataFrame, expected_min: int = 1) -> DataFrame:
    """One row: both counts, ``status`` (ok, warning or failed) and the message."""
    s = source.agg(F.count(F.lit(1)).alias("source_rows"))
    p = processed.agg(F.count(F.lit(1)).alias("processed_rows"))
    both = s.withColumn("_k", F.lit(1)).join(p.withColumn("_k", F.lit(1)), "_k").drop("_k")
    n, m = F.col("source_rows"), F.col("processed_rows")
    message = (
        F.when(n == 0, "source has no rows").when(m == 0, "no rows after processing")
        .when(m < expected_min, "fewer rows than expected").when(m > n, "more rows than the source").otherwise("ok")
    )
    status = F.when((n == 0) | (m == 0) | (m < expected_min), "failed").when(m > n, "warning").otherwise("ok")
    return both.withColumns({"status": status, "message": message})


def contract_check(
    df: DataFrame, dataset: str, required: list[str], unique: list[str], allowed: dict[str, list], fresh: str | None,
    sla: dict[str, float], as_of: datetime | None = None,
) -> DataFrame:
    """Measured quality against the agreed levels, one row: completeness, uniqueness and validity in percent, age of the
    newest row in days, and 1/0 per level met. ``sla`` may hold completeness, uniqueness, validity and freshness_days."""
    filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required], F.lit(True))
    valid = reduce(lambda a, b: a & b, [F.coalesce(F.col(c).isin(v), F.lit(False)) for c, v in allowed.items()], F.lit(True))
    by_key = df.groupBy(*unique).agg(
        F.count(F.lit(1)).alias("_n"), F.count(F.when(filled, 1)).alias("_filled"), F.count(F.when(valid, 1)).alias("_valid"),
        *([F.max(fresh).alias("_newest")] if fresh else []),
    )
    sums = by_key.agg(
        F.sum("_n").alias("n"), F.sum("_filled").alias("filled"), F.sum("_valid").alias("valid"), F.count(F.lit(1)).alias("keys"),
        *([F.max("_newest").alias("newest")] if fresh else []),
    )
    def pct(c: str) -> Column:
        return F.col(c).cast("double") * 100 / F.nullif(F.col("n").cast("double"), F.lit(0.0))

    out = sums.select(
        F.lit(dataset).alias("dataset_name"), F.col("n").cast("long").alias("row_count"), pct("filled").alias("completeness_pct"),
        pct("keys").alias("uniqueness_pct"), pct("valid").alias("validity_pct"),
        *([F.datediff(F.lit(as_of), "newest").cast("long").alias("age_days")] if fresh else []),
    )
    met = {}
    for name, col in (("completeness", "completeness_pct"), ("uniqueness", "uniqueness_pct"), ("validity", "validity_pct")):
        if name in sla:
            met[f"{name}_met"] = (F.col(col) >= sla[name]).cast("int")
    if fresh and "freshness_days" in sla:
        met["freshness_met"] = (F.col("age_days") <= sla["freshness_days"]).cast("int")
    return out.withColumns(met)
