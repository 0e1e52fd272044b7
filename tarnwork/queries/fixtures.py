"""The given tables in the shape of the policy and claims sources.

Each view is one SELECT that Spark and DuckDB both run, over whole tables; ``{name}`` stands for a given table. Codes are
spelled differently per view (case, blanks) on purpose.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from tarnwork.plans.transactions import House

PAYROLL = """SELECT concat('P', CAST(l_orderkey AS STRING)) AS code, p_brand AS classcode, lower(p_type) AS classuffix, l_linestatus AS state, l_extendedprice AS premium,
    l_quantity AS exposure, '1' AS primeseq, CASE WHEN l_linenumber <= 5 THEN '000' ELSE '001' END AS seqcode FROM {lineitem} JOIN {part} ON l_partkey = p_partkey WHERE l_shipdate """
BUILDINGS = """SELECT concat(' P', CAST(l_orderkey AS STRING)) AS code, p_type AS class, p_brand AS classsuffix, p_size AS bpclass_id, l_extendedprice AS premium, l_quantity AS tiv
    FROM {lineitem} JOIN {part} ON l_partkey = p_partkey WHERE l_shipdate """

POLICY = {
    "insured": """SELECT concat('P', CAST(o_orderkey AS STRING)) AS code, CASE WHEN o_orderpriority = '5-LOW' THEN 'other' ELSE concat(' p', CAST(o_orderkey AS STRING)) END AS basemgacode,
        CASE WHEN c_nationkey = 10 THEN 'PAFAKE10' ELSE concat('AG', CAST(c_nationkey AS STRING)) END AS agency,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'WC' WHEN '2-HIGH' THEN 'bp ' WHEN '3-MEDIUM' THEN 'CA' ELSE 'ho' END AS lob, o_orderdate AS pobegin, o_orderdate + INTERVAL 1 YEAR AS poexpir,
        o_orderdate + INTERVAL 60 DAY AS pocancel, o_orderdate + INTERVAL 61 DAY AS trcancel, o_orderdate + INTERVAL 400 DAY AS poaudit, o_orderdate + INTERVAL 2 DAY AS poissue, o_orderdate - INTERVAL 9 DAY AS enteredon,
        CASE o_orderstatus WHEN 'F' THEN 'C' WHEN 'P' THEN 'a' END AS stat5, CASE WHEN o_totalprice > 100000 THEN 'i' WHEN o_totalprice > 2000 THEN 'q' END AS stat2,
        CASE WHEN c_acctbal > 5000 THEN 'P' WHEN c_acctbal > 0 THEN 'a' END AS stat0, CASE WHEN o_totalprice > 150000 THEN '1' WHEN o_totalprice > 90000 THEN '2' WHEN o_totalprice > 60000 THEN '3' WHEN o_totalprice > 30000 THEN '4' END AS stat7,
        CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'N' WHEN c_mktsegment = 'FURNITURE' THEN 'x' ELSE 'r' END AS flags14, CASE WHEN c_nationkey < 12 THEN 'p' WHEN c_nationkey < 20 THEN 'z' END AS flags33,
        CASE WHEN c_nationkey = 3 THEN 'w' WHEN c_nationkey = 4 THEN 'X' END AS flags39, CASE WHEN o_orderstatus = 'P' THEN 's' ELSE 'n' END AS flags19, CASE WHEN c_nationkey = 7 THEN 'hold' END AS flags04,
        CASE WHEN o_totalprice < 80000 THEN 'f' WHEN o_totalprice < 200000 THEN 'P' ELSE 's' END AS typcancel, CASE WHEN c_acctbal > 3000 THEN 'Y' WHEN c_acctbal > 0 THEN 'n' END AS offerren,
        CASE WHEN o_totalprice > 50000 THEN o_totalprice END AS poytdprem, concat('p', CAST(o_orderkey - 1 AS STRING)) AS renewalofcode, concat('P', CAST(o_orderkey - c_nationkey AS STRING)) AS renewof,
        CASE WHEN c_nationkey = 5 THEN concat('P', CAST(o_orderkey + 3 AS STRING)) END AS renewedbycode, o_custkey AS chainid, CASE WHEN o_orderstatus = 'P' THEN concat('emp', CAST(c_nationkey AS STRING)) END AS decsbr,
        concat('EMP', o_orderstatus) AS decuw, CASE WHEN c_mktsegment = 'BUILDING' THEN 'es' ELSE 'AD' END AS markettype, c_mktsegment AS productionsrc,
        CASE WHEN c_acctbal < 0 THEN 'PAAZGU10' ELSE concat('CAR', CAST(c_nationkey AS STRING)) END AS carrier FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "mgtrans": """SELECT concat(' p', CAST(l_orderkey AS STRING), ' ') AS code, l_linenumber AS trancnt, concat('T', l_returnflag) AS transcode, l_shipdate AS effdate, l_shipdate + INTERVAL 1 DAY AS transdate,
        l_partkey AS transno, l_shipdate + INTERVAL 3 DAY AS writtenon, concat('S', l_linestatus) AS state, l_extendedprice AS amount, l_quantity AS fsamount, l_tax AS paamount, l_discount AS sf3amount,
        l_quantity * 2 AS sf4amount, CASE WHEN l_linestatus = 'F' THEN l_quantity END AS sf5amount, l_tax AS sf6amount, l_discount AS sf7amount, l_extendedprice AS commisamt, CAST(NULL AS DOUBLE) AS nocommprem
        FROM {lineitem} WHERE l_returnflag <> 'N'""",
    "mgnotrans": """SELECT l_suppkey AS id, concat('P', CAST(l_orderkey AS STRING)) AS code, l_linenumber AS trancnt, CASE WHEN l_linestatus = 'F' THEN 'ex' ELSE concat('t', l_returnflag) END AS transcode,
        CASE WHEN l_linestatus = 'O' THEN l_shipdate END AS effdate, l_shipdate + INTERVAL 2 DAY AS enteredon, concat('N', l_linestatus) AS state, CASE WHEN l_quantity > 40 THEN 143 ELSE 7 END AS typeid,
        CASE WHEN l_linenumber = 3 THEN '13.00' ELSE '2.00' END AS reason, CASE WHEN l_quantity > 20 THEN concat('|', l_linestatus, '||') ELSE '||' END AS extra, concat('line ', CAST(l_linenumber AS STRING)) AS additional_info
        FROM {lineitem} WHERE l_returnflag = 'N'""",
    "polact": "SELECT concat('p', CAST(l_orderkey AS STRING)) AS code, l_linenumber AS trancnt, l_shipdate + INTERVAL 5 DAY AS effdate FROM {lineitem}",
    "mgextra": "SELECT concat('p', CAST(o_orderkey AS STRING)) AS code, c_mktsegment AS naics FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE o_orderstatus <> 'P'",
    "wcpayrol": PAYROLL + ">= TIMESTAMP '1998-01-01'",
    "archive_wcpayrol": PAYROLL + "< TIMESTAMP '1998-01-01'",
    "wcinfo": "SELECT DISTINCT concat('p', CAST(l_orderkey AS STRING)) AS code, upper(p_brand) AS govclass FROM {lineitem} JOIN {part} ON l_partkey = p_partkey WHERE l_quantity > 10",
    "uwbuildings": BUILDINGS + ">= TIMESTAMP '1998-01-01'",
    "archive_uwbuildings": BUILDINGS + "< TIMESTAMP '1998-01-01'",
    "dim_policy": "SELECT o_orderkey AS policy_key, concat('p', CAST(o_orderkey AS STRING)) AS policy_num_bus_key FROM {orders} WHERE o_totalprice > 5000",
    "dim_insured": "SELECT o_orderkey + 1000000 AS insd_key, concat('P', CAST(o_orderkey AS STRING)) AS policy_num_bus_key FROM {orders} WHERE o_totalprice > 9000",
    "dim_date": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INT) AS date_key FROM {orders}",
    "dim_lob": "SELECT min(o_orderkey) AS lob_key, CASE o_orderpriority WHEN '1-URGENT' THEN 'wc' WHEN '2-HIGH' THEN 'BP' WHEN '3-MEDIUM' THEN 'ca' ELSE 'HO' END AS lob_cd_bus_key FROM {orders} WHERE o_orderpriority <> '5-LOW' GROUP BY 2",
    "dim_dist_chnl": "SELECT n_nationkey AS dist_chnl_key, concat('ag', CAST(n_nationkey AS STRING)) AS agcy_cd_bus_key FROM {nation} WHERE n_regionkey < 4",
    "dim_naics": "SELECT min(c_custkey) AS naics_key, c_mktsegment AS naics_bus_key FROM {customer} GROUP BY c_mktsegment",
    "dim_employee": "SELECT n_nationkey AS emp_key, concat('EMP', CAST(n_nationkey AS STRING)) AS emp_cd_bus_key FROM {nation} UNION ALL SELECT 100 + r_regionkey, concat('emp', CASE r_regionkey WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE r_name END) FROM {region}",
    "dim_mkt_type": "SELECT min(c_custkey) AS mkt_type_key, CASE WHEN c_mktsegment = 'BUILDING' THEN 'ES' ELSE 'ad' END AS mkt_type_cd_bus_key, CASE WHEN c_mktsegment = 'BUILDING' THEN 'E&S' ELSE 'Admitted' END AS mkt_type_desc FROM {customer} GROUP BY 2, 3",
    "dim_prod_src": "SELECT min(c_custkey) AS prod_src_key, lower(c_mktsegment) AS prod_src_cd_bus_key FROM {customer} WHERE c_mktsegment <> 'MACHINERY' GROUP BY 2",
    "dim_carrier": "SELECT n_nationkey AS carrier_key, concat('car', CAST(n_nationkey AS STRING)) AS carrier_cd_bus_key FROM {nation} UNION ALL SELECT 200 + max(r_regionkey), 'paazgu10' FROM {region}",
    "dim_policy_trans_type": "SELECT min(l_orderkey) AS policy_trans_type_key, concat('T', l_returnflag) AS policy_trans_type_cd_bus_key FROM {lineitem} GROUP BY 2",
    "dim_policy_trans_subtype": "SELECT max(l_orderkey) AS policy_trans_subtype_key, CASE WHEN l_quantity > 40 THEN '143' ELSE '8' END AS policy_trans_subtype_bus_key FROM {lineitem} GROUP BY 2",
    "dim_business_class": """SELECT min(l_partkey) AS bus_class_key, concat(p_brand, l_linestatus) AS bus_class_cd_bus_key, p_type AS bus_class_suffix_bus_key, '0' AS bus_class_src_id_bus_key FROM {lineitem} JOIN {part} ON l_partkey = p_partkey GROUP BY 2, 3
        UNION ALL SELECT min(p_partkey) + 1000000, lower(p_type), lower(p_brand), CAST(p_size AS STRING) FROM {part} GROUP BY 2, 3, 4 UNION ALL SELECT max(r_regionkey), 'Not Applicable', 'not applicable', 'not applicable' FROM {region}""",
    "billings": "SELECT concat('p', CAST(l_orderkey AS STRING)) AS code, CASE WHEN l_linenumber > 2 THEN l_shipdate END AS paymentdate FROM {lineitem} WHERE l_quantity > 25",
    "govern": "SELECT concat('p', CAST(o_orderkey AS STRING)) AS code, concat('G', o_orderstatus) AS govstate FROM {orders} WHERE o_orderpriority <> '4-NOT SPECIFIED'",
    "autouw_results": """SELECT concat('p', CAST(l_orderkey AS STRING)) AS keyfield, CASE WHEN l_linestatus = 'F' THEN 'Decline' ELSE 'accept' END AS autouwstatus, l_shipdate AS updateon,
        CASE WHEN l_linenumber = 7 THEN 'IIS_AUTHORITY_BP' ELSE 'OTHER' END AS systemkey FROM {lineitem}""",
    "lookups": """SELECT 'Insured' AS programid, 'stat7' AS keyfield, CAST(n_nationkey AS STRING) AS vals, CASE n_nationkey WHEN 1 THEN 'declined by agency' WHEN 2 THEN 'Declined by CA/UW' WHEN 3 THEN 'accepted by agency' ELSE 'waiting for info' END AS descrip
        FROM {nation} WHERE n_nationkey BETWEEN 1 AND 4""",
}

CLAIMS = {
    "claims_adjustor_stats": """SELECT event_id AS adjustorstatsid, user_id AS claimantid, CASE event_type WHEN 'signup' THEN 'n' WHEN 'click' THEN 'TI' WHEN 'purchase' THEN 'SN' WHEN 'view' THEN 'ro' ELSE 'XX' END AS transactiontype, ts AS enteredon,
        CASE WHEN value < 10 THEN 'wc' WHEN value < 30 THEN 'BP' WHEN value < 60 THEN 'HO' WHEN value < 70 THEN 'CA' ELSE 'DB' END AS lob, CASE WHEN event_type IN ('click', 'view') THEN 'PD' ELSE 'LI' END AS coveragecategory,
        CASE WHEN value < 20 THEN 'FT' WHEN value < 40 THEN 'M' ELSE 'H' END AS complexity, CASE WHEN value < 5 THEN 'B1' ELSE 'b2' END AS businessunit,
        CASE WHEN value > 100 THEN 11220 ELSE c_nationkey END AS adjustor, CASE WHEN value > 140 THEN 1 WHEN value > 20 THEN 0 ELSE 2 END AS adjustorstatus FROM {events} JOIN {customer} ON c_custkey = user_id""",
    "claimant": "SELECT c_custkey AS claimantid, concat('P', CAST(c_custkey AS STRING)) AS code, concat('FCN-', c_name) AS fullclaimnumber, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'V' WHEN c_mktsegment = 'BUILDING' THEN '' END AS voidortransfer FROM {customer}",
    "insured": "SELECT concat('P', CAST(c_custkey AS STRING)) AS code, CASE WHEN c_acctbal > 4000 THEN 'es' ELSE 'AD' END AS markettype FROM {customer}",
    "tpaasof": "SELECT user_id AS claimantid, ts AS enteredon, CASE WHEN event_type = 'error' THEN '' ELSE concat('TAX', CAST(event_id AS STRING)) END AS tpataxid FROM {events} WHERE event_type IN ('error', 'signup') AND value > 40",
    "lob": "SELECT CASE r_regionkey WHEN 0 THEN 'wc' WHEN 1 THEN 'BP' WHEN 2 THEN 'HO' WHEN 3 THEN 'DB' ELSE 'ZZ' END AS lob, concat(r_name, '''s line') AS lobdescrip FROM {region}",
    "employee": "SELECT n_nationkey AS userid, CASE n_nationkey WHEN 3 THEN 'Team - BOP*GUARD CAT' ELSE n_name END AS name FROM {nation} WHERE n_regionkey < 4",
    "user_adjustor_groups": "SELECT n_nationkey AS userid, CASE WHEN n_regionkey = 0 THEN 'mcuadj' WHEN n_regionkey = 1 THEN 'lladj' ELSE 'pdliadj' END AS adjustor_group FROM {nation} UNION ALL SELECT n_nationkey, 'mcuadj' FROM {nation} WHERE n_regionkey > 2",
    "lookups": """SELECT programid, keyfield, vals, descrip, lobcode AS lob FROM (SELECT 'STATS' AS programid, 'stattype' AS keyfield, CASE r_regionkey WHEN 0 THEN 'N' WHEN 1 THEN 'TI' WHEN 2 THEN 'SN' WHEN 3 THEN 'RO' ELSE 'ZZ' END AS vals, concat('type ', r_name) AS descrip, '' AS lobcode FROM {region}
        UNION ALL SELECT 'Insured', 'MarketType', CASE r_regionkey WHEN 0 THEN 'ES' WHEN 1 THEN 'ad' ELSE r_name END, concat('market ', r_name), '' FROM {region}
        UNION ALL SELECT 'wcclaim', 'CoverageCategory', 'pd', concat('damage ', r_name), CASE r_regionkey WHEN 0 THEN 'WC' WHEN 1 THEN 'bp' WHEN 2 THEN 'HO' ELSE r_name END FROM {region}
        UNION ALL SELECT 'claimant', 'complexity', CASE r_regionkey WHEN 0 THEN 'Ft' WHEN 1 THEN 'm' ELSE r_name END, concat('complex ', r_name), '' FROM {region}
        UNION ALL SELECT 'business_unit', 'business_unit', CASE r_regionkey WHEN 0 THEN 'b1' WHEN 1 THEN 'B2' ELSE r_name END, concat('unit ', r_name), '' FROM {region}
        UNION ALL SELECT 'nis_wcclaim', 'adjustorstatus', CAST(r_regionkey AS STRING), concat('status ', r_name), '' FROM {region}) x""",
}

PARTIES = {
    "claimant": "SELECT o_orderkey AS claimantid, CASE WHEN o_orderstatus <> 'F' THEN concat(' e', CAST(c_nationkey AS STRING)) END AS adjustor, CASE WHEN o_orderstatus = 'F' THEN concat('tax', CAST(c_nationkey AS STRING)) END AS tpataxid, o_orderkey AS wcclaimid FROM {orders} JOIN {customer} ON c_custkey = o_custkey",
    "employee": "SELECT concat('E', CAST(n_nationkey AS STRING)) AS empcode, n_name AS name, CASE WHEN n_regionkey < 2 THEN 'full' ELSE 'Part' END AS emptype, n_nationkey AS userid, CASE WHEN n_regionkey = 4 THEN 0 ELSE 1 END AS dl_iscurrent FROM {nation}",
    "wcclaim": "SELECT o_orderkey AS wcclaimid, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN ' pd' ELSE 'LI' END AS coveragecategory, 1 AS dl_iscurrent FROM {orders}",
    "lookups": "SELECT 'EmpType' AS keyfield, CASE r_regionkey WHEN 0 THEN 'FULL' WHEN 1 THEN 'part' ELSE r_name END AS vals, concat('staff ', r_name) AS descrip, 1 AS dl_iscurrent FROM {region}",
    "reservelimits": "SELECT n_nationkey AS userid, 'Pd' AS coveragecategory, CAST(n_nationkey * 1000 AS DOUBLE) AS totallimit, 1 AS dl_iscurrent FROM {nation} WHERE n_regionkey <> 2",
    "provider": "SELECT concat('TAX', CAST(n_nationkey AS STRING)) AS provider, concat(' ', n_name, ' ') AS name, r_name AS county, CASE WHEN n_regionkey < 3 THEN 'law' ELSE 'MED' END AS provtype, CASE WHEN n_regionkey = 1 THEN 0 ELSE 1 END AS dl_iscurrent FROM {nation} JOIN {region} ON n_regionkey = r_regionkey",
    "provtype": "SELECT CASE r_regionkey WHEN 0 THEN 'LAW' WHEN 1 THEN 'med' ELSE r_name END AS provtype, concat('kind ', r_name) AS provtypdes, 1 AS dl_iscurrent FROM {region}",
}

INSURED = {
    "insured": """SELECT concat('P', CAST(c_custkey AS STRING)) AS code, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Redacted' ELSE c_name END AS name, concat('street ', c_name) AS address1, CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS address2, concat('city ', CAST(c_nationkey AS STRING)) AS city,
        concat('S', CAST(c_nationkey AS STRING)) AS state, concat('9', lpad(CAST(c_custkey AS STRING), 12, '0')) AS zipcode, CAST(c_nationkey AS STRING) AS county, CASE WHEN c_nationkey < 20 THEN c_nationkey END AS biztype, c_custkey + 5 AS crmid FROM {customer}""",
    "archive_insured": "SELECT concat('P', CAST(c_custkey AS STRING)) AS code, CASE WHEN c_acctbal < 1000 THEN 'REDACTED' ELSE c_name END AS name, concat('old street ', c_name) AS address1, 'old' AS address2, 'old city' AS city FROM {customer}",
    "mgextra": "SELECT concat('P', CAST(c_custkey AS STRING)) AS code, 1950 + c_nationkey AS yrbusst, c_mktsegment AS descriptionofoperations FROM {customer} WHERE c_acctbal > 2000",
    "wclocnam": """SELECT concat('P', CAST(c_custkey AS STRING)) AS code, 'm' AS uselocnum, 'a' AS type, CASE WHEN c_nationkey > 5 THEN concat('mail ', c_name) END AS address1, CAST(NULL AS STRING) AS address2, 'mail city' AS city, 'MS' AS state, '123456789' AS zipcode, '7' AS county, 'x' AS text FROM {customer} WHERE c_nationkey < 15
        UNION ALL SELECT concat('P', CAST(c_custkey AS STRING)), 'n', 'n', 'y', 'y', 'y', 'y', 'y', 'y', concat('named ', c_name) FROM {customer} WHERE c_nationkey BETWEEN 10 AND 18""",
    "archive_wclocnam": """SELECT concat('P', CAST(c_custkey AS STRING)) AS code, 'm' AS uselocnum, 'a' AS type, concat('old mail ', c_name) AS address1, CAST(NULL AS STRING) AS address2, 'old mail city' AS city, 'x' AS text FROM {customer} WHERE c_nationkey < 9
        UNION ALL SELECT concat('P', CAST(c_custkey AS STRING)), 'n', 'n', 'y', 'y', 'y', concat('old named ', c_name) FROM {customer} WHERE c_nationkey > 20""",
    "dim_insured_legal_entity_type": "SELECT n_nationkey AS insd_leg_ent_type_cd_bus_key, n_nationkey + 300 AS insd_leg_ent_type_key FROM {nation}",
    "fips": "SELECT concat('S', CAST(n_nationkey AS STRING)) AS state, CAST(n_nationkey AS STRING) AS fips, n_name AS name FROM {nation} UNION ALL SELECT concat('S', CAST(n_nationkey AS STRING)), '7', concat('seven ', n_name) FROM {nation} WHERE n_nationkey <> 7",
}

# Values of the data that the views imitate: codes and names by which one insurer tells its own things apart.
HOUSE = House(
    test_agency="PAFAKE10", surplus_carrier="PAAZGU10", surplus_market="E&S", admitted_lobs=("WC", "CA", "DB", "PL", "UM", "UP", "CX", "CP"),
    classed_lobs=("WC", "BP"), special_carrier="azguard", cat_teams=("Team - BOP*GUARD CAT", "Team - HO*GUARD CAT", "HO CAT Team*GUARD"),
    refuses_as="rn - guard declined",
)

GIVEN = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


class frames(dict):  # noqa: N801
    """The views as frames over the tables ``t``, each built when it is first asked for."""

    def __init__(self, t, views: dict[str, str]):
        super().__init__()
        self.t, self.views = t, views

    def __missing__(self, name: str) -> DataFrame:
        sql = self.views[name]
        used = [g for g in GIVEN if "{" + g + "}" in sql]
        self[name] = self.t.spark.sql(sql, **{g: getattr(self.t, g) for g in used})
        return self[name]


def ctes(views: dict[str, str], prefix: str = "") -> str:
    """The views as common table expressions, named ``<prefix><name>``."""
    def bare(sql: str) -> str:
        return reduce(lambda s, g: s.replace("{" + g + "}", g), GIVEN, sql)

    return ",\n".join(f"{prefix}{name} AS ({bare(sql)})" for name, sql in views.items())
