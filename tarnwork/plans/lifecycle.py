"""The lifecycle dimension: one row per master policy with its current status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.functions.columns import classify, norm
from tarnwork.operators.aggregates import all_of
from tarnwork.operators.windows import latest_per_key
from tarnwork.plans.transactions import House, history_columns

# Stands in the table for the status of a renewal that the insurer itself refuses, which names the insurer.
HOUSE_DECLINED = ""
# The decision table: attribute values a policy must have -> status. The first row that fits decides. Attributes:
# kind (new, renewal), rewrite (w, x), canceled, cancel (flat, short rate, pro-rata), prelim (still a preliminary
# submission), declined (agency, uw), priced (has a premium estimate), auto (automatic underwriting declined),
# chased (underwriting asked back), quoted, issued, pending (waiting on the agency), paid, offered (the prior policy
# offers renewal). An attribute that is unknown fits no row that names it. The status names are fixed values.
STATUS_TABLE: list[tuple[dict, str]] = [
    ({"kind": "n", "rewrite": "any", "canceled": True, "cancel": "p"}, "nb - canceled pro-rata"),
    ({"kind": "r", "rewrite": "any", "canceled": True, "cancel": "p"}, "rn - canceled pro-rata"),
    ({"rewrite": "w"}, "re-write"),
    ({"rewrite": "x"}, "re-issue"),
    ({"kind": "n", "canceled": True, "cancel": "f"}, "nb - canceled flat"),
    ({"kind": "n", "canceled": True, "cancel": "s"}, "nb - canceled short rate"),
    ({"kind": "n", "canceled": True, "cancel": "p"}, "nb - canceled pro-rata"),
    ({"kind": "n", "prelim": True, "declined": "agency", "priced": False, "auto": False}, "nb - abandoned before prem est"),
    ({"kind": "n", "prelim": True, "declined": "agency", "priced": False, "auto": True}, "nb - decline - class of exposure"),
    ({"kind": "n", "prelim": True, "declined": "agency", "priced": True, "auto": False}, "nb - agent withdrew after initial prem estimate"),
    ({"kind": "n", "prelim": True, "declined": "agency", "priced": True, "auto": True}, "nb - decline - questions"),
    ({"kind": "n", "prelim": True, "declined": "uw"}, "nb - decline - broker of record"),
    ({"kind": "n", "prelim": False, "declined": "agency", "quoted": False, "chased": True}, "nb - not responding to uw"),
    ({"kind": "n", "prelim": False, "declined": "agency", "quoted": True}, "nb - quote not taken"),
    ({"kind": "n", "prelim": False, "declined": "agency", "quoted": False}, "nb - agent withdrew before quote"),
    ({"kind": "n", "prelim": False, "declined": "uw"}, "nb - decline - uw"),
    ({"kind": "n", "prelim": False, "issued": True, "canceled": False}, "nb - issued"),
    ({"kind": "n", "prelim": False, "pending": True}, "nb - open quote"),
    ({"kind": "n", "prelim": True, "priced": True}, "nb - open completed submission"),
    ({"kind": "n", "prelim": False}, "nb - open completed submission"),
    ({"kind": "n", "prelim": True}, "nb - open submission"),
    ({"kind": "r", "issued": True, "canceled": False, "paid": True}, "rn - issued paid"),
    ({"kind": "r", "issued": True, "canceled": False, "paid": False}, "rn - issued not paid"),
    ({"kind": "r", "issued": True, "canceled": True, "cancel": "s"}, "rn - canceled short rate"),
    ({"kind": "r", "issued": True, "canceled": True, "cancel": "p"}, "rn - canceled pro-rata"),
    ({"kind": "r", "issued": False, "declined": "uw"}, HOUSE_DECLINED),
    ({"kind": "r", "issued": False, "declined": "agency", "offered": True}, "rn - quote not taken"),
    ({"kind": "r", "issued": True, "canceled": True, "cancel": "f"}, "rn - quote not taken"),
    ({"kind": "r", "issued": False, "offered": True}, "rn - open quote"),
    ({"kind": "r", "issued": False, "offered": False}, "rn - open renewal"),
    ({"kind": "r"}, "rn - other exception"),
]
DEFAULT_STATUS = "other - exception"
DECLINED_BY = {"declined by agency": "agency", "declined by ca/uw": "uw"}
PENDING = ["pending agy decision", "accepted by agency"]
WAITING = "waiting for info"


def low(col: str) -> Column:
    return F.lower(F.trim(F.col(col)))


def status_table(house: House) -> list[tuple[dict, str]]:
    """The decision table with the insurer's own name for what it refuses."""
    return [(wanted, status or house.refuses_as) for wanted, status in STATUS_TABLE]


def status_of(attributes: dict[str, Column], house: House) -> Column:
    """The status by the decision table."""
    def fits(name: str, value) -> Column:
        col = attributes[name]
        if value == "any":
            return col.isin("w", "x")
        return col == F.lit(value)

    return classify([(all_of([fits(n, v) for n, v in wanted.items()]), status) for wanted, status in status_table(house)], DEFAULT_STATUS)


def next_policies(tables: dict[str, DataFrame], policies: DataFrame) -> DataFrame:
    """``code_n`` with the next policy's code and states: the explicit successor, else the latest policy renewing it."""
    masters = tables["insured"].filter(norm("code") == norm("basemgacode"))
    open_refs = masters.filter(F.coalesce(low("flags04"), F.lit("")) == "").filter(F.col("renewof").isNotNull())
    refs = open_refs.select(norm("renewof").alias("code_n"), F.col("code").alias("by_ref"), "enteredon")
    latest = latest_per_key(refs, ["code_n"], [F.col("enteredon").desc(), F.col("by_ref").desc()]).select("code_n", norm("by_ref").alias("by_ref_n"))
    wanted = policies.select("code_n", norm("renewedbycode").alias("pointer_n")).join(latest, "code_n", "left")
    wanted = wanted.select("code_n", F.coalesce("pointer_n", "by_ref_n").alias("next_n")).filter("next_n IS NOT NULL")
    records = tables["insured"].select(norm("code").alias("next_n"), low("stat2").alias("next_stat2"), low("stat7").alias("next_stat7"))
    return wanted.join(records, "next_n")


def tagged_priors(tables: dict[str, DataFrame]) -> DataFrame:
    """Codes with an exclusion that carries extra text, and a tag of the exclusion type, in any of their rows."""
    m = tables["mgnotrans"]
    filled = F.exists(F.split(F.coalesce("extra", F.lit("")), r"\|"), lambda v: F.trim(v) != "")
    by_code = m.groupBy(norm("code").alias("prior_n")).agg(
        F.max(((low("transcode") == "ex") & filled).cast("int")).alias("has_text"), F.max((F.col("typeid") == 143).cast("int")).alias("has_tag"),
    )
    return by_code.filter("has_text = 1 AND has_tag = 1").select("prior_n", F.lit(1).alias("is_tagged"))


def dim_lifecycle(tables: dict[str, DataFrame], house: House) -> DataFrame:
    """Status, dates and renewal flags of every master policy outside the test agency."""
    policies = tables["insured"].withColumn("code_n", norm("code"))
    policies = policies.filter((F.col("code_n") == norm("basemgacode")) & (norm("agency") != house.test_agency)).withColumns({
        "s7": low("stat7"), "prior_n": norm("renewalofcode"),
    })
    paid = tables["billings"].filter("paymentdate IS NOT NULL").groupBy(norm("code").alias("code_n")).agg(F.min("paymentdate").alias("firstpaid"))
    gov = tables["wcinfo"].select(norm("code").alias("code_n"), "govstate")
    auto = tables["autouw_results"].filter("systemkey <> 'IIS_AUTHORITY_BP'")
    auto = latest_per_key(auto.select(norm("keyfield").alias("code_n"), "autouwstatus", "updateon"), ["code_n"], [F.col("updateon").desc(), F.col("autouwstatus")]).drop("updateon")
    chased = tables["mgnotrans"].filter("reason = '13.00'").select(norm("code").alias("code_n")).distinct().withColumn("was_chased", F.lit(True))
    priors = tables["insured"].select(norm("code").alias("prior_n"), low("offerren").alias("prior_offer"))
    codes = tables["lookups"].filter((low("keyfield") == "stat7") & (low("programid") == "insured"))
    here = codes.select(low("vals").alias("s7"), F.col("descrip").alias("stat7_text"))
    there = codes.select(low("vals").alias("next_stat7"), low("descrip").alias("next_text"))

    b = policies
    for side in (paid, gov, auto, chased, next_policies(tables, policies)):
        b = b.join(side, "code_n", "left")
    # One join for all that is known of the prior policy. New business has none: those rows get a key of their own, which
    # matches nothing and spreads them.
    priors = priors.join(tagged_priors(tables), "prior_n", "left").withColumnRenamed("prior_n", "prior_key")
    b = b.withColumn("prior_key", F.coalesce("prior_n", F.concat(F.lit("\u0000"), "code_n"))).join(priors, "prior_key", "left")
    b = b.join(here, "s7", "left").join(there, "next_stat7", "left")

    text, offer = F.lower(F.trim("stat7_text")), low("offerren")
    issued, canceled = low("stat2") == "i", F.coalesce(low("stat5"), F.lit("")) == "c"
    quoted = low("stat0") == "p"
    status = status_of({
        "kind": low("flags14"), "rewrite": low("flags39"), "canceled": canceled, "cancel": low("typcancel"), "prelim": F.coalesce(low("flags33"), F.lit("")) == "p",
        "declined": classify([(text == t, v) for t, v in DECLINED_BY.items()]), "priced": F.col("poytdprem").isNotNull(), "auto": low("autouwstatus") == "decline",
        "chased": F.coalesce("was_chased", F.lit(False)), "quoted": quoted, "issued": issued,
        "pending": F.coalesce(text.isin(PENDING) & ~issued, F.lit(False)) | F.coalesce((text == WAITING) & quoted, F.lit(False)),
        "paid": F.col("firstpaid").isNotNull(), "offered": F.col("prior_offer") == "y",
    }, house)
    followed = F.col("next_n").isNotNull()
    next_issued = F.col("next_stat2") == "i"
    renewable = (
        F.when(issued & canceled, "n").when(followed & (next_issued | (~next_issued & (offer == "y"))), "y")
        .when((offer != "y") | (~next_issued & (F.col("next_text") == "declined by ca/uw")) | text.isin(list(DECLINED_BY)), "n").otherwise("U")
    )
    b = b.withColumns({"status_n": norm(status), **history_columns()})
    dim = tables["dim_policy_status"].select(norm("policy_status_cd_bus_key").alias("status_n"), F.col("policy_status_key").alias("latest_policy_status_key"))
    return b.join(dim, "status_n", "left").select(
        F.col("code").alias("policy_num_bus_key"), F.when(low("flags14") == "n", "New Business").otherwise("Renewal").alias("policy_bus_type"), F.col("govstate").alias("gov_state"),
        F.col("pobegin").alias("policy_effec_start_dt"), F.col("poexpir").alias("policy_effec_end_dt"), F.col("pobegin").alias("policy_coverage_start_dt"),
        F.when(canceled, F.col("pocancel")).otherwise(F.col("poexpir")).alias("policy_coverage_end_dt"), F.when(canceled, F.col("pocancel")).alias("policy_cancel_dt"),
        F.when(canceled, F.col("trcancel")).alias("policy_cancel_trans_dt"), F.col("poaudit").alias("policy_audit_dt"), F.col("enteredon").alias("policy_sub_dt"), F.col("poissue").alias("policy_issue_dt"),
        F.when(offer == "y", 1).otherwise(0).alias("offer_rn"), F.col("renewalofcode").alias("rn_of"), F.col("renewedbycode").alias("rn_by"), F.col("chainid").alias("chain_id"),
        F.col("firstpaid").alias("first_dwnpymnt_recd_dt"), F.when(F.col("flags39").isin("w", "x"), F.col("flags39")).alias("rewrite_reissue"),
        F.when(issued & (low("stat5") != "c"), 1).otherwise(0).alias("is_expiring_flag"), renewable.alias("is_renewable_flag"), F.coalesce("is_tagged", F.lit(0)).alias("is_prev_policy_ubetag_flag"),
        followed.cast("int").alias("is_cloned_flag"), F.col("stat7_text").alias("src_policy_status_descrip"), "latest_policy_status_key", *history_columns(),
    )
