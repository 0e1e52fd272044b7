"""Adjuster transfers: every assignment of a claimant with its codes, party and whether it changed hands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.functions.columns import classify
from tarnwork.operators.joins import asof_latest, lookup_codes
from tarnwork.operators.windows import running

# Fixed values.
TRANSFER_TYPES = ["N", "TI", "SN", "RO"]
REOPENED = "RO"
SYSTEM_ADJUSTER = 11220
OPEN_STATES = [0, 2]
GROUPS = {"mcuadj": "mcuadj_YN", "lladj": "lladj_YN", "pdliadj": "pdliadj_YN"}


def assignments(stats: DataFrame) -> DataFrame:
    kind = F.upper("transactiontype")
    return stats.filter(kind.isin(TRANSFER_TYPES) & ((F.col("adjustor") != SYSTEM_ADJUSTER) | (kind == REOPENED)) & F.col("adjustorstatus").isin(OPEN_STATES)).select(
        "adjustorstatsid", "claimantid", "transactiontype", "enteredon", "lob", "coveragecategory", "complexity", "businessunit", "adjustor", "adjustorstatus"
    )


def claim_type(cat_teams: tuple[str, ...]) -> Column:
    property_lob, lob = F.upper("lob").isin("BP", "HO"), F.upper("lob")
    damage, liability = F.upper("coveragecategory") == "PD", F.upper("coveragecategory") == "LI"
    return classify([
        (lob.isin("WC", "DB"), F.col("lob_descrip")),
        (property_lob & F.col("adjustor_name").isin(*cat_teams), "Property"),
        (property_lob & damage & (F.upper("complexity") == "FT") & (F.col("lladj_YN") == "N"), "Property / Inland Marine"),
        (property_lob & liability & (F.col("pdliadj_YN") == "Y"), "PD Liability"),
        (property_lob & damage, "Property"),
        (property_lob & liability, "Liability"),
        (lob == "CA", "Liability"),
    ])


def unit(cat_teams: tuple[str, ...]) -> Column:
    property_lob, lob = F.upper("lob").isin("BP", "HO"), F.upper("lob")
    mcu = F.col("mcuadj_YN") == "Y"
    return classify([
        (F.col("tpa_YN") == "Y", "TPA"),
        (lob == "DB", "All"),
        (lob == "WC", F.concat("unit_code", F.lit("-WC"))),
        (property_lob & F.col("adjustor_name").isin(*cat_teams), "CAT Team"),
        ((lob == "BP") & (F.upper("coveragecategory") == "PD") & (F.col("lladj_YN") == "Y"), "Large Loss"),
        (property_lob & (F.upper("coveragecategory") == "LI") & mcu, "MCU"),
        ((lob == "CA") & mcu, "MCU"),
        (property_lob | (lob == "CA"), F.col("complexity_code")),
    ])


def stg_transfers(tables: dict[str, DataFrame], cat_teams: tuple[str, ...]) -> DataFrame:
    """One row per assignment of a claimant that is neither void nor transferred. ``cat_teams`` names the adjusters that stand
    for catastrophe teams.

    The party in force at the assignment is found by the as-of operator, so an assignment stays one row; sequence and
    previous values come from one running pass per claimant.
    """
    a = assignments(tables["claims_adjustor_stats"])
    party = tables["tpaasof"].select("claimantid", F.col("enteredon").alias("party_on"), "tpataxid")
    a = asof_latest(a, party, ["claimantid"], "enteredon", "party_on", ["tpataxid"], tie="tpataxid")
    a = a.withColumn("tpa_YN", F.when(F.coalesce("tpataxid", F.lit("")) != "", "Y").otherwise("N")).drop("tpataxid")

    claimants = tables["claimant"].filter(F.coalesce("voidortransfer", F.lit("")) == "").select("claimantid", "code", "fullclaimnumber")
    a = a.join(claimants, "claimantid").join(tables["insured"].select("code", "markettype"), "code").drop("code")
    a = a.join(tables["lob"].select("lob", F.replace(F.col("lobdescrip"), F.lit("'"), F.lit("")).alias("lob_descrip")), "lob", "left")
    staff = tables["employee"].select(F.col("userid").alias("adjustor"), F.col("name").alias("adjustor_name"), F.lit(True).alias("is_staff"))
    a = a.join(staff, "adjustor", "left")
    # One row per member with all its groups, so that one join tells them.
    groups = tables["user_adjustor_groups"].groupBy(F.col("userid").alias("adjustor")).agg(
        *[F.bool_or(F.col("adjustor_group") == group).alias(f"_{flag}") for group, flag in GROUPS.items()]
    )
    a = a.join(groups, "adjustor", "left").withColumns({flag: F.when(F.col(f"_{flag}") & F.col("is_staff"), "Y").otherwise("N") for flag in GROUPS.values()})

    codes = tables["lookups"]
    by_lob = codes.filter((F.upper("programid") == "WCCLAIM") & (F.upper("keyfield") == "COVERAGECATEGORY"))
    by_lob = by_lob.select(F.upper("lob").alias("_lob"), F.upper("vals").alias("_vals"), F.col("descrip").alias("cvgcategory_descrip"))
    a = a.join(by_lob, (F.upper(a["lob"]) == by_lob["_lob"]) & (F.upper(a["coveragecategory"]) == by_lob["_vals"]), "left").drop("_lob", "_vals")
    a = a.withColumn("status_text", F.col("adjustorstatus").cast("string"))
    a = lookup_codes(a, codes, [
        ("stats", "stattype", "transactiontype", "transactiondescrip"), ("insured", "markettype", "markettype", "mkttype_descrip"), ("claimant", "complexity", "complexity", "complexity_descrip"),
        ("business_unit", "business_unit", "businessunit", "busunit_descrip"), ("nis_wcclaim", "adjustorstatus", "status_text", "adjustorstat_descrip"),
    ])
    spelled = codes.withColumn("descrip", F.col("vals"))
    a = lookup_codes(a, spelled, [("claimant", "complexity", "complexity", "complexity_code"), ("business_unit", "business_unit", "businessunit", "unit_code")])

    a = a.withColumns({"claimType": claim_type(cat_teams), "unit": unit(cat_teams)})
    t = running(a, ["claimantid"], ["enteredon", "adjustorstatsid"], {
        "rcount": ("row_number",), "prevClaimType": ("lag", "claimType"), "prev_unit_bus_key": ("lag", "unit"),
    }, profile=assignments(tables["claims_adjustor_stats"]))
    same = (F.col("claimType") == F.col("prevClaimType")) & (F.col("unit") == F.col("prev_unit_bus_key"))
    return t.select(
        "adjustorstatsid", F.concat(F.lit("EMP-"), F.col("adjustor").cast("string"), F.lit("-"), F.upper(F.trim("coveragecategory"))).alias("adjustr_bus_key"),
        F.col("claimantid").alias("claimant_bus_key"), F.col("transactiontype").alias("adjustr_trans_type_bus_key"), "transactiondescrip", F.col("enteredon").alias("adjustr_entry_date_bus_key"),
        F.concat(F.year("enteredon").cast("string"), F.lit("-"), F.lpad(F.month("enteredon").cast("string"), 2, "0")).alias("entered_mo"), "fullclaimnumber", F.col("lob").alias("lob_cd_bus_key"),
        "lob_descrip", F.col("markettype").alias("mkt_type_cd_bus_key"), "mkttype_descrip", F.col("coveragecategory").alias("cvrg_category_bus_key"), "cvgcategory_descrip",
        F.col("complexity").alias("complexity_bus_key"), "complexity_descrip", F.col("businessunit").alias("bus_unit_bus_key"), "busunit_descrip", "adjustor", "adjustor_name",
        *GROUPS.values(), (F.col("tpa_YN") == "Y").alias("is_tpa"), F.col("adjustorstatus").alias("adjustr_status_bus_key"), "adjustorstat_descrip",
        F.when(F.col("adjustorstatus").isin(OPEN_STATES), "Open").otherwise("Closed").alias("adjustorstat_group"), F.col("rcount").alias("trancnt"), "claimType",
        F.col("unit").alias("unit_bus_key"), F.when(F.col("rcount") > 1, F.col("rcount") - 1).alias("prev_trancnt"), "prevClaimType", "prev_unit_bus_key",
        F.when(same, "N").otherwise("Y").alias("TrueTransfer"),
    )
