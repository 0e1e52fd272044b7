"""Smaller dimensions and status reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.functions.columns import norm
from tarnwork.operators.hierarchy import hierarchy_paths
from tarnwork.operators.sets import two_branch
from tarnwork.operators.windows import days_in_status
from tarnwork.plans.chain import load_target
from tarnwork.plans.transactions import history_columns

LEVELS = 5  # levels of the status hierarchy, l0 to l4


def adjuster_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Employees and external parties that handle claims, as one dimension's rows."""
    def current(name: str) -> DataFrame:
        return tables[name].filter("dl_iscurrent = 1")

    claims = tables["claimant"].select(norm("adjustor").alias("emp_n"), norm("tpataxid").alias("party_n"), "wcclaimid").distinct()
    staff = current("employee").select(norm("empcode").alias("emp_n"), "empcode", F.col("name").alias("emp_name"), "emptype", "userid")
    kinds = current("wcclaim").select("wcclaimid", norm("coveragecategory").alias("cover_n"))
    types = current("lookups").filter(norm("keyfield") == "EMPTYPE").select(norm("vals").alias("type_n"), F.col("descrip").alias("type_desc"))
    limits = current("reservelimits").select("userid", norm("coveragecategory").alias("cover_n"), "coveragecategory", "totallimit", F.col("userid").alias("limit_user"))
    # Claims reduce to distinct (employee, category) pairs before the wider joins.
    pairs = claims.join(kinds, "wcclaimid").select("emp_n", "cover_n").distinct()
    employees = pairs.join(staff, "emp_n").withColumn("type_n", norm("emptype")).join(types, "type_n", "left").join(limits, ["userid", "cover_n"], "left")

    kind_of = current("provtype").select(norm("provtype").alias("kind_n"), "provtype", "provtypdes")
    provider = current("provider").select(norm("provider").alias("party_n"), "provider", "name", "county", norm("provtype").alias("kind_n"))
    parties = claims.select("party_n").distinct().join(provider, "party_n").join(kind_of, "kind_n")
    return two_branch(employees, parties, {
        "adjustr_bus_key": (F.concat(F.lit("EMP-"), "empcode", F.lit("-"), "cover_n"), F.concat(F.lit("TPA-"), "provider")),
        "adjustr_nm": (F.col("emp_name"), F.concat(F.trim("name"), F.lit("("), F.trim("county"), F.lit(")"))),
        "adjustr_cd": (F.col("empcode"), F.col("provider")),
        "adjustr_type_cd": (F.col("emptype"), F.col("provtype")),
        "adjustr_type_desc": (F.col("type_desc"), F.col("provtypdes")),
        "adjustr_tpa_flg": (F.lit(0), F.lit(1)),
        "reserve_entry_userid": (F.coalesce("limit_user", F.lit(0)).cast("long"), F.lit(0).cast("long")),
        "reserve_limit_cvrg_ctgry": (F.coalesce("coveragecategory", F.lit("NA")), F.lit("NA")),
        "reserve_limit_amt": (F.coalesce("totallimit", F.lit(0.0)), F.lit(0.0)),
    })


def dim_adjuster(tables: dict[str, DataFrame], existing: DataFrame | None, batch_time: datetime) -> DataFrame:
    """The adjuster dimension's next state: type two, with identity and unknown member."""
    target = {"table": "adjuster", "load_strategy": "type_two", "key_columns": ["adjustr_bus_key"], "identity": True, "identity_column_name": "adjustr_key", "unknown_record": True}
    return load_target(target, existing, adjuster_rows(tables), batch_time)


def dim_with_archive(tables: dict[str, DataFrame]) -> DataFrame:
    """The insured dimension. Where the name was redacted, name and address come from the archive."""
    def locations(name: str, use: str, prefix: str, cols: list[str]) -> DataFrame:
        rows = tables[name].filter(F.col("uselocnum") == use)
        rows = rows.filter("type = 'n'") if use == "n" else rows
        return rows.select("code", *[F.col(c).alias(f"{prefix}_{c}") for c in cols])

    address = ["address1", "address2", "city"]
    i = tables["insured"]
    old = tables["archive_insured"].filter(F.lower("name") != "redacted").select("code", *[F.col(c).alias(f"ai_{c}") for c in [*address, "name"]])
    b = i.join(tables["mgextra"].select("code", "yrbusst", "descriptionofoperations"), "code", "left")
    b = b.join(locations("wclocnam", "m", "m", [*address, "state", "zipcode", "county"]), "code", "left").join(locations("archive_wclocnam", "m", "am", address), "code", "left")
    b = b.join(locations("wclocnam", "n", "n", ["text"]), "code", "left").join(locations("archive_wclocnam", "n", "an", ["text"]), "code", "left").join(old, "code", "left")
    kinds = tables["dim_insured_legal_entity_type"].select(F.col("insd_leg_ent_type_cd_bus_key").alias("biztype"), "insd_leg_ent_type_key")
    b = b.join(kinds, "biztype", "left").withColumn("county_code", F.coalesce("m_county", "county"))
    fips = tables["fips"].select("state", F.col("fips").alias("county_code"), F.col("name").alias("county_name"))
    b = b.join(fips, ["state", "county_code"], "left")
    known = F.lower(F.col("name")) != "redacted"
    def pick(col: str):
        return F.when(known, F.coalesce(f"m_{col}", col)).otherwise(F.coalesce(f"am_{col}", f"ai_{col}"))

    b = b.withColumns(history_columns())
    return b.select(
        F.col("code").alias("policy_num_bus_key"), pick("address1").alias("mail_add1"), pick("address2").alias("mail_add2"), pick("city").alias("mail_city"),
        F.coalesce("m_state", "state").alias("mail_state"), F.substring(F.coalesce("m_zipcode", "zipcode"), 1, 5).alias("mail_zip"), F.col("county_name").alias("mail_county"),
        F.when(known, F.coalesce("n_text", "name")).otherwise(F.coalesce("an_text", "ai_name")).alias("insd_nm"), F.col("insd_leg_ent_type_key").alias("legal_ent_type_key"),
        F.col("yrbusst").alias("bus_start_year"), F.col("descriptionofoperations").alias("desc_of_ops"), "crmid", *history_columns(),
    )


def dim_simple(codes: DataFrame, special: str, field: str = "carrier", program: str = "*") -> DataFrame:
    """Carriers from the code table, the special one as non-admitted, sorted by code."""
    rows = codes.filter((F.lower("keyfield") == field) & (F.lower("programid") == program)).select(
        F.col("vals").alias("carrier_cd_bus_key"), F.col("descrip").alias("carrier_nm"), F.when(F.lower("descrip") == special, "Non-admitted").otherwise("Admitted").alias("carrier_type"),
    )
    return rows.distinct().withColumns(history_columns()).orderBy("carrier_cd_bus_key")


def status_hierarchy(rows: DataFrame, code: str, parent: str, levels: int = LEVELS) -> DataFrame:
    """Path columns ``l0_level`` … of a parent-pointer hierarchy with ``level_count`` and ``hierarchy_state``, see
    ``hierarchy_paths``: deeper hierarchies and circles show no path and say so."""
    return hierarchy_paths(rows, code, parent, levels)


def status_history(facts: DataFrame, history: DataFrame, key: str, status: str, ts: str, tie: str) -> DataFrame:
    """Each status change of the keys in ``facts`` (distinct key and current status) with the days since the one
    before; a key without changes keeps one row."""
    timed = days_in_status(history, [key], ts, [ts, tie])
    return facts.select(key, F.col(status).alias("current_status")).distinct().join(timed, key, "left")
