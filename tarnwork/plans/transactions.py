"""Transaction facts: the transaction fact and the detail fact.

``tables`` maps the source and dimension names to frames. All text keys compare without regard to case and outer blanks;
each is normalised once, before its first join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.functions.columns import norm, prefer, total_of
from tarnwork.operators import skew
from tarnwork.operators.joins import choice_key, date_roles, star_lookup
from tarnwork.operators.skew import KeyBits, dealt, key_bits, likely
from tarnwork.operators.windows import top_n_per_key
from tarnwork.session import cut

# Measure of the fact -> amount column of a written transaction.
AMOUNTS = {
    "prem_amt": "amount", "fsa_amt": "fsamount", "paa_amt": "paamount", "sf3_amt": "sf3amount", "sf4_amt": "sf4amount", "sf5_amt": "sf5amount",
    "sf6_amt": "sf6amount", "sf7_amt": "sf7amount", "comm_amt": "commisamt", "non_comm_prem_amt": "nocommprem",
}
# Reconciliation flag -> measure.
RECONCILED = {
    "dq_rule_544": "prem_amt", "dq_rule_545": "fsa_amt", "dq_rule_546": "paa_amt", "dq_rule_547": "sf3_amt", "dq_rule_548": "sf4_amt",
    "dq_rule_549": "sf5_amt", "dq_rule_550": "sf6_amt", "dq_rule_551": "sf7_amt", "dq_rule_552": "comm_amt", "dq_rule_553": "non_comm_prem_amt",
}
NO_CLASS = "NOT APPLICABLE"
COPIES = "_copies"


@dataclass(frozen=True)
class House:
    """The codes by which one insurer's data names its own things; all in upper case but for names."""

    test_agency: str
    surplus_carrier: str
    surplus_market: str
    admitted_lobs: tuple[str, ...]
    classed_lobs: tuple[str, ...]
    special_carrier: str
    cat_teams: tuple[str, ...]
    refuses_as: str


Frames = dict[str, DataFrame]


def dominant(rows: DataFrame, keys: list[str], group: list[str], measures: dict[str, str], order: list[Column]) -> DataFrame:
    """Per key the group that comes first by its summed measures."""
    sums = rows.groupBy(*keys, *group).agg(*[total_of(rows, c).alias(o) for o, c in measures.items()])
    top = top_n_per_key(sums, keys, order, 1)
    return top.select(*keys, *group, *[F.col(o).cast("double").alias(o) for o in measures])


def with_archive(tables: Frames, name: str, cols: list[str]) -> DataFrame:
    """Current and archived rows of a table, keyed by the normalised policy code."""
    both = tables[name].select("code", *cols).union(tables[f"archive_{name}"].select("code", *cols))
    return both.withColumn("code_n", norm("code")).drop("code")


def payroll_class(tables: Frames, order: list[Column], policies: DataFrame) -> DataFrame:
    """The policy's dominant payroll class among those its governing classes name, for the codes of ``policies``."""
    pay = with_archive(tables, "wcpayrol", ["classcode", "classuffix", "state", "premium", "exposure", "primeseq", "seqcode"])
    pay = pay.filter((norm("primeseq") == "1") & (norm("seqcode") == "000")).withColumn("class_n", norm("classcode"))
    wanted = key_bits(policies, ["code_n"], skew.CONSTANT_BITS)
    pay = likely(pay, ["code_n"], wanted, below_joins=True).join(policies.select("code_n"), "code_n", "left_semi")
    gov = likely(tables["wcinfo"].select(norm("code").alias("code_n"), norm("govclass").alias("class_n")), ["code_n"], wanted, below_joins=True)
    ranked = dominant(pay.join(gov, ["code_n", "class_n"]), ["code_n"], ["classcode", "classuffix", "state"], {"exposure": "exposure", "premium": "premium"}, order)
    return ranked.select("code_n", norm(F.concat("classcode", "state")).alias("wc_class"), norm("classuffix").alias("wc_suffix"))


def building_class(tables: Frames, policies: DataFrame) -> DataFrame:
    """The class of the policy's building with the largest premium, then insured value, at least for the codes of ``policies``."""
    rows = with_archive(tables, "uwbuildings", ["class", "classsuffix", "bpclass_id", "premium", "tiv"])
    rows = likely(rows, ["code_n"], key_bits(policies, ["code_n"], skew.CONSTANT_BITS), below_joins=True)
    order = [F.col("premium").desc(), F.col("tiv").desc(), F.col("class"), F.col("classsuffix"), F.col("bpclass_id")]
    top = top_n_per_key(rows, ["code_n"], order, 1)
    return top.select("code_n", norm("class").alias("bp_class"), norm("classsuffix").alias("bp_suffix"), norm(F.col("bpclass_id").cast("string")).alias("bp_id"))


def with_class(rows: DataFrame, tables: Frames, order: list[Column], policies: DataFrame) -> DataFrame:
    """Add the three parts of the business class key, chosen by line of business (``lob_n``), to rows of ``policies``."""
    # Only the policies of one line of business use payroll classes and those of another use buildings, so no others are ranked.
    wc, bp = (policies.filter(F.col("lob_n") == lob) for lob in ("WC", "BP"))
    out = rows.join(payroll_class(tables, order, wc), "code_n", "left").join(building_class(tables, bp), "code_n", "left")
    def by_lob(wc, bp):
        return F.when(F.col("lob_n") == "WC", wc).when(F.col("lob_n") == "BP", bp).otherwise(NO_CLASS)

    return out.withColumns({
        "class_n": by_lob(F.col("wc_class"), F.col("bp_class")), "suffix_n": by_lob(F.col("wc_suffix"), F.col("bp_suffix")),
        "class_id_n": by_lob(F.lit("0"), F.col("bp_id")),
    }).drop("wc_class", "wc_suffix", "bp_class", "bp_suffix", "bp_id")


def master_policies(tables: Frames, test_agency: str | None) -> DataFrame:
    """Policies that are their own master, without those of a test agency, with normalised dimension codes."""
    i = tables["insured"].withColumn("code_n", norm("code")).filter(F.col("code_n") == norm("basemgacode"))
    if test_agency:
        i = i.filter(norm("agency") != test_agency)
    return i.withColumns({
        "lob_n": norm("lob"), "agency_n": norm("agency"), "market_n": norm("markettype"), "source_n": norm("productionsrc"), "carrier_n": norm("carrier"),
        "is_canceled": F.coalesce(norm("stat5") == "C", F.lit(False)),
    })


def _dim(tables: Frames, name: str, code: str, key: str, attrs: dict[str, str] | None = None) -> DataFrame:
    return tables[name].select(norm(code).alias("code_n"), key, *[norm(c).alias(a) for a, c in (attrs or {}).items()])


def extra_rows(tables: Frames) -> DataFrame:
    return tables["mgextra"].select(norm("code").alias("code_n"), norm("naics").alias("naics_n")).distinct()


def resolve_policies(policies: DataFrame, tables: Frames, order: list[Column], roles: dict[str, str], names: tuple[str, str, str], house: House, given: DataFrame) -> DataFrame:
    """Surrogate keys, dates and cross-dimension flags of each policy.

    Everything that depends on the policy alone is looked up here, once per policy; the transactions then take it over
    with a single join. ``policies`` must be distinct: distinct policy rows joined to distinct transaction rows give
    distinct fact rows, so the fact itself needs no distinct over its full width. ``given`` holds the same policies as
    they were written, before they were dealt.
    """
    p = with_class(policies, tables, order, given).join(extra_rows(tables), "code_n", "left")
    one = lambda col: {col: "code_n"}
    classes = tables["dim_business_class"].select(
        norm("bus_class_cd_bus_key").alias("c1"), norm("bus_class_suffix_bus_key").alias("c2"), norm("bus_class_src_id_bus_key").alias("c3"), "bus_class_key"
    )
    classes = cut(classes, "classes")  # it is measured before it is looked up, and worked out once for both
    keyed = star_lookup(p, [
        (_dim(tables, "dim_policy", "policy_num_bus_key", "policy_key"), one("code_n"), {"policy_key": "policy_key"}),
        (_dim(tables, "dim_insured", "policy_num_bus_key", "insd_key"), one("code_n"), {"insd_key": "insd_key"}),
        (_dim(tables, "dim_lob", "lob_cd_bus_key", "lob_key", {"lob_found": "lob_cd_bus_key"}), one("lob_n"), {"lob_key": "lob_key"}, {"lob_found": "lob_found"}),
        (_dim(tables, "dim_dist_chnl", "agcy_cd_bus_key", "dist_chnl_key"), one("agency_n"), {"dist_chnl_key": "dist_chnl_key"}),
        (_dim(tables, "dim_naics", "naics_bus_key", "naics_key"), one("naics_n"), {"naics_key": "naics_key"}),
        (_dim(tables, "dim_employee", "emp_cd_bus_key", "emp_key"), one("emp_n"), {"dec_uw_emp_key": "emp_key"}),
        (_dim(tables, "dim_mkt_type", "mkt_type_cd_bus_key", "mkt_type_key", {"market": "mkt_type_desc"}), one("market_n"), {"mkt_type_key": "mkt_type_key"}, {"market": "market"}),
        (_dim(tables, "dim_prod_src", "prod_src_cd_bus_key", "prod_src_key"), one("source_n"), {"prod_src_key": "prod_src_key"}),
        (_dim(tables, "dim_carrier", "carrier_cd_bus_key", "carrier_key", {"carrier_found": "carrier_cd_bus_key"}), one("carrier_n"), {"carrier_key": "carrier_key"}, {"carrier_found": "carrier_found"}),
        (classes, {"class_n": "c1", "suffix_n": "c2", "class_id_n": "c3"}, {"bus_class_key": "bus_class_key"}, {"class_found": "c1"}),
    ])
    dated = date_roles(keyed, tables["dim_date"], roles)
    flags = cross_rules(names, house)
    return dated.select("code_n", *POLICY_KEYS, *roles, *[c.alias(o) for o, c in flags.items()])


# Surrogate keys that depend on the policy alone.
POLICY_KEYS = [
    "policy_key", "lob_key", "dist_chnl_key", "insd_key", "naics_key", "dec_uw_emp_key", "mkt_type_key", "prod_src_key", "carrier_key", "bus_class_key",
]


def cross_rules(names: tuple[str, str, str], house: House) -> dict[str, Column]:
    """The three cross-dimension flags (1 pass, 0 fail) under the given names."""
    surplus = F.col("market") == house.surplus_market
    bad = [
        F.col("lob_found").isin(*house.admitted_lobs) & surplus,
        (F.col("carrier_found") == house.surplus_carrier) & ~surplus,
        ~F.col("lob_found").isin(*house.classed_lobs) & F.col("class_found").isNotNull(),
    ]
    return {n: F.when(b, 0).otherwise(1) for n, b in zip(names, bad, strict=True)}


def history_columns() -> dict[str, Column]:
    return {
        "dl_is_current_flag": F.lit(True), "dl_row_effective_date": F.lit("1901-01-01"), "dl_row_expiration_date": F.lit("9999-12-31"), "dl_is_deleted_flag": F.lit(False),
    }


def transaction_rows(tables: Frames, policies: KeyBits | None = None) -> tuple[DataFrame, DataFrame]:
    """The distinct transactions in two parts: the written ones, and the others whose (policy, count) was not written.

    A (policy, count) that both sources hold takes the written row whole, even where a value is null. Choosing by
    anti-join keeps the two sources apart, so their rows are never paired. Written rows tell in ``COPIES`` how often the
    source has them; they are dealt by policy once, for this count, for the reconciliation and for the fact. With
    ``policies`` most transactions of other policies are left out before they move.
    """
    def of_policies(rows):
        return rows if policies is None else likely(rows, ["code_n"], policies)

    w = tables["mgtrans"].withColumn("code_n", norm("code"))
    written = w.select(
        "code_n", "trancnt", "transcode", "effdate", F.col("transdate").alias("trans_date"), F.col("transno").cast("long").alias("trans_id"), "writtenon", "state",
        *[F.col(c).alias(o) for o, c in AMOUNTS.items()], F.lit(1).alias("src_trans_id_type"),
    )
    n = of_policies(tables["mgnotrans"].withColumn("code_n", norm("code")))
    # Both are asked for the keys of ``n`` only.
    key = ["code_n", "trancnt"]
    wanted = key_bits(n, key)
    same, acts = (likely(rows, key, wanted) for rows in (w.select(*key), tables["polact"].select(norm("code").alias("code_n"), "trancnt", "effdate")))
    other = n.join(same, key, "left_anti").join(acts.groupBy(*key).agg(F.max("effdate").alias("act_date")), key, "left")
    other = other.select(
        "code_n", "trancnt", "transcode", F.coalesce("effdate", "act_date").alias("effdate"), F.col("enteredon").alias("trans_date"), F.col("id").cast("long").alias("trans_id"),
        F.col("enteredon").alias("writtenon"), "state", F.lit(2).alias("src_trans_id_type"),
    )
    return of_policies(dealt(written, "code_n")).groupBy(*written.columns).agg(F.count(F.lit(1)).alias(COPIES)), other.distinct()


def reconciliation(policies: DataFrame, transactions: DataFrame, tables: Frames) -> DataFrame:
    """Flags per policy code: the fact's total of a measure equals the source's (a missing total fails).

    Both sides are aggregated at once for all measures: the fact has a transaction once and the source ``COPIES`` times.
    A code with several policy rows counts its transactions as often as the fact does; that number follows from the two
    distinct inputs, without building the policy rows again.
    """
    found = {f"f_{m}": total_of(transactions, m) for m in AMOUNTS} | {f"s_{m}": total_of(transactions, m, times=F.col(COPIES)) for m in AMOUNTS}
    sums = transactions.groupBy("code_n").agg(*[c.alias(o) for o, c in found.items()])
    extras = extra_rows(tables).groupBy("code_n").agg(F.count(F.lit(1)).alias("_extras"))
    both = policies.groupBy("code_n").agg(F.count(F.lit(1)).alias("_rows")).join(extras, "code_n", "left").join(sums, "code_n", "left")
    copies = F.col("_rows") * F.coalesce("_extras", F.lit(1))
    return both.select("code_n", *[F.when(F.col(f"f_{m}") * copies == F.col(f"s_{m}"), 1).otherwise(0).alias(flag) for flag, m in RECONCILED.items()])


def fact_transactions(tables: Frames, house: House) -> DataFrame:
    """The transaction fact: dimension keys (-1 when unknown), measures and the quality flags."""
    chosen = cut(master_policies(tables, house.test_agency).select(
        "code_n", "pobegin", "poexpir", F.when(F.col("is_canceled"), F.col("pocancel")).otherwise(F.col("poexpir")).alias("coverage_end"),
        "lob_n", "agency_n", "market_n", "source_n", "carrier_n", norm(prefer(F.col("decsbr"), F.col("decsbr"), F.col("decuw"))).alias("emp_n"),
    ), "policies")
    policy = dealt(chosen, "code_n").distinct()
    order = [F.col("exposure").desc(), F.col("premium").desc(), F.col("state"), F.col("classcode"), F.col("classuffix")]
    begin = {
        "policy_effec_start_dt_key": "pobegin", "policy_effec_end_dt_key": "poexpir", "policy_coverage_start_dt_key": "pobegin", "policy_coverage_end_dt_key": "coverage_end",
    }
    policies = resolve_policies(policy, tables, order, begin, ("dq_rule_542", "dq_rule_543", "dq_rule_554"), house, chosen)
    written, other = transaction_rows(tables, key_bits(chosen, ["code_n"]))
    policies = policies.join(reconciliation(policy, written, tables), "code_n")
    # Each source is joined on its own, as only one of them lies by policy already.
    rows = written.drop(COPIES).join(policies, "code_n").unionByName(other.join(policies, "code_n"), allowMissingColumns=True)

    types = _dim(tables, "dim_policy_trans_type", "policy_trans_type_cd_bus_key", "policy_trans_type_key")
    keyed = star_lookup(rows.withColumn("trans_type_n", norm("transcode")), [(types, {"trans_type_n": "code_n"}, {"policy_trans_type_key": "policy_trans_type_key"})])
    happened = {"policy_trans_effec_dt_key": "effdate", "policy_trans_dt_key": "trans_date", "policy_trans_written_on_dt_key": "writtenon"}
    return date_roles(keyed, tables["dim_date"], happened).select(
        *POLICY_KEYS, "policy_trans_type_key", *begin, *happened, F.col("trancnt").alias("policy_trans_seq_num"), "src_trans_id_type", F.col("trans_id").alias("src_trans_id"), *AMOUNTS,
        F.col("state").alias("policy_trans_state"), *[c.alias(o) for o, c in history_columns().items()], "dq_rule_542", "dq_rule_543", *RECONCILED, "dq_rule_554",
    )


def fact_detail(tables: Frames, house: House) -> DataFrame:
    """The detail fact of transactions that were not written: one row per source row of a master policy."""
    policy = cut(choice_key(master_policies(tables, None), norm("flags19") == "S", "decsbr", "decuw", "emp").select(
        "code_n", "pobegin", "poexpir", F.when(F.col("is_canceled"), F.col("pocancel")).otherwise(F.col("poexpir")).alias("inforce_end"),
        "lob_n", "agency_n", "market_n", "source_n", "carrier_n", norm("emp").alias("emp_n"),
    ), "policies")
    order = [F.col("premium").desc(), F.col("exposure").desc(), F.col("state"), F.col("classcode"), F.col("classuffix")]
    begin = {
        "policy_effec_start_dt_key": "pobegin", "policy_effec_end_dt_key": "poexpir", "policy_inforce_start_dt_key": "pobegin", "policy_inforce_end_dt_key": "inforce_end",
    }
    policies = resolve_policies(policy, tables, order, begin, ("dq_rule_558", "dq_rule_559", "dq_rule_560"), house, policy)
    details = tables["mgnotrans"].withColumns({"code_n": norm("code"), "trans_type_n": norm("transcode"), "subtype_n": norm(F.col("typeid").cast("string"))})
    keyed = star_lookup(details.join(policies, "code_n"), [
        (_dim(tables, "dim_policy_trans_type", "policy_trans_type_cd_bus_key", "policy_trans_type_key"), {"trans_type_n": "code_n"}, {"policy_trans_type_key": "policy_trans_type_key"}),
        (_dim(tables, "dim_policy_trans_subtype", "policy_trans_subtype_bus_key", "policy_trans_subtype_key"), {"subtype_n": "code_n"}, {"policy_trans_subtype_key": "policy_trans_subtype_key"}),
    ])
    happened = {"policy_trans_effec_dt_key": "effdate", "policy_trans_dt_key": "enteredon"}
    return date_roles(keyed, tables["dim_date"], happened).select(
        *POLICY_KEYS, "policy_trans_type_key", *begin, *happened, F.col("trancnt").alias("policy_trans_seq_num"), F.col("id").alias("src_trans_detail_id"), "policy_trans_subtype_key",
        F.col("extra").alias("extra_info"), "additional_info", F.col("reason").alias("reason_cd"), *[c.alias(o) for o, c in history_columns().items()], "dq_rule_558", "dq_rule_559", "dq_rule_560",
    )
