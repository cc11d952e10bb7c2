"""The driver's star-schema tables read as title snapshots, owners and a company register.

Each column is one SQL expression that Spark and the oracle engine both understand, so a query and its oracle start from the
same rows; what they then do with them is written twice.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import table

AS_OF = date(2001, 6, 30)
TITLES = {
    "id": "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string), '-', cast(l_suppkey as string), '-', cast(cast(round(l_extendedprice * 100) as bigint) as string))",
    "title_number": "concat('T', cast(l_partkey as string))",
    "file_month": "cast(date_trunc('month', l_shipdate) as date)",
    "dataset_type": "case when l_linestatus = 'F' then 'CCOD' else 'OCOD' end",
    "update_type": "case when l_linenumber % 2 = 0 then 'COU' else 'FULL' end",
    "change_indicator": "case l_returnflag when 'A' then 'A' when 'R' then 'D' end",
    "change_date": "case when l_returnflag <> 'N' then cast(l_shipdate as date) end",
    "date_proprietor_added": "case when l_discount >= 0.03 then cast(l_shipdate as date) - cast(l_quantity as int) * 30 end",
    "price_paid": "case when l_tax < 0.07 then cast(floor(l_extendedprice) as bigint) * 20 end",
    "region": "case when l_suppkey % 9 = 0 then '' else concat('Region ', cast(l_suppkey % 5 as string)) end",
    "county": "concat('County ', cast(l_suppkey % 11 as string))",
    "district": "concat('District ', cast(l_suppkey % 23 as string))",
    "postcode": "case when l_partkey % 7 = 0 then concat('ZZ', cast(l_partkey % 40 as string)) else concat('AB', cast(l_partkey % 40 as string), ' ', cast(l_partkey % 9 as string), 'XY') end",
    "multiple_address_indicator": "case when l_linenumber % 3 = 0 then 'Y' else 'N' end",
    "source_filename": "concat(case when l_linestatus = 'F' then 'CCOD' else 'OCOD' end, case when l_linenumber % 2 = 0 then '_COU_' else '_FULL_' end, substr(cast(cast(l_shipdate as date) as string), 1, 7), '.csv')",
    "proprietor_1_name": "case when l_quantity < 2 then '' else concat('Supplier#', lpad(cast(l_suppkey as string), 9, '0'), case when l_linenumber % 2 = 0 then ' Ltd' else ' LIMITED' end) end",
    "company_1_reg_no": "case when l_tax < 0.03 then cast(l_suppkey as string) when l_tax < 0.05 then concat('RS', cast(l_suppkey as string)) end",
    "proprietorship_1_category": "case when l_discount < 0.08 then 'Limited Company or Public Limited Company' else 'Local Authority' end",
    "country_1_incorporated": "case when l_linestatus = 'O' then 'JERSEY' end",
    "proprietor_2_name": "case when l_linenumber >= 3 then concat('supplier#', lpad(cast(l_suppkey % 17 + 1 as string), 9, '0')) end",
    "company_2_reg_no": "case when l_tax > 0.04 then cast(l_suppkey % 19 + 1 as string) end",
    "proprietorship_2_category": "'Limited Liability Partnership'",
    "country_2_incorporated": "cast(null as string)",
    "proprietor_3_name": "case when l_linenumber >= 5 then concat('Former#', lpad(cast(l_suppkey % 31 as string), 9, '0'), ' PLC') end",
    "company_3_reg_no": "cast(null as string)",
    "proprietorship_3_category": "'Limited Company or Public Limited Company'",
    "country_3_incorporated": "cast(null as string)",
    "proprietor_4_name": "case when l_linenumber >= 6 and l_quantity >= 2 then concat('Supplier#', lpad(cast(l_suppkey as string), 9, '0'), case when l_linenumber % 2 = 0 then ' Ltd' else ' LIMITED' end) end",
    "company_4_reg_no": "cast(null as string)",
    "proprietorship_4_category": "'Limited Company or Public Limited Company'",
    "country_4_incorporated": "cast(null as string)",
}
COMPANIES = {
    "company_number": "lpad(cast(s_suppkey as string), 8, '0')",
    "company_name": "concat(case when s_suppkey % 10 = 0 then concat('Supplier#', lpad(cast(s_suppkey - 1 as string), 9, '0')) else s_name end, case when s_suppkey % 3 = 0 then ' PLC' else ' LIMITED' end)",
    "company_status": "case when s_acctbal < 0 then 'Dissolved' else 'Active' end",
    "incorporation_date": "cast('1985-01-01' as date) + cast(s_suppkey as int) * 20",
}
#: Previous names: none, one or two.
PREVIOUS = ("case when s_suppkey % 2 = 0 then concat('Former#', lpad(cast(s_suppkey % 31 as string), 9, '0'), ' Co') end", "case when s_suppkey % 5 = 0 then concat('Old Supplier ', cast(s_suppkey as string)) end")


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*[F.expr(e).alias(n) for n, e in TITLES.items()])


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = F.filter(F.array(*[F.expr(p) for p in PREVIOUS]), lambda x: x.isNotNull())
    return table(spark, sf_dir, "supplier").select(*[F.expr(e).alias(n) for n, e in COMPANIES.items()], old.alias("previous_names"))


#: The same as CTEs of an oracle.
_cols = lambda c: ", ".join(f"{e} AS {n}" for n, e in c.items())
SQL_TITLES = f"titles AS (SELECT {_cols(TITLES)} FROM lineitem)"
SQL_COMPANIES = f"companies AS (SELECT {_cols(COMPANIES)} FROM supplier), previous AS (SELECT company_number, company_name, incorporation_date, old FROM (SELECT {_cols(COMPANIES)}, {PREVIOUS[0]} AS old FROM supplier UNION ALL SELECT {_cols(COMPANIES)}, {PREVIOUS[1]} AS old FROM supplier) WHERE old IS NOT NULL)"
_slot = lambda i: f"SELECT id, title_number, file_month, dataset_type, update_type, change_indicator, change_date, date_proprietor_added, price_paid, region, county, district, postcode, {i} AS slot, proprietor_{i}_name AS proprietor_name, company_{i}_reg_no AS company_reg_no, proprietorship_{i}_category AS category, country_{i}_incorporated AS country_incorporated FROM titles WHERE proprietor_{i}_name IS NOT NULL AND proprietor_{i}_name <> ''"
SQL_LONG = "long AS (" + " UNION ALL ".join(_slot(i) for i in range(1, 5)) + ")"
NAME_SQL = r"regexp_replace(regexp_replace(replace(replace(trim(upper({0})), ' AND ', ' '), ' & ', ' '), '\s*(LIMITED LIABILITY PARTNERSHIP|LIMITED|COMPANY|LTD\.|LLP|LTD|PLC|CO\.|CO).*$', ''), '[^A-Z0-9]', '', 'g')"
NUMBER_SQL = "(CASE WHEN regexp_full_match(regexp_replace(upper(trim({0})), '[^A-Z0-9]', '', 'g'), '[0-9]+') AND length(regexp_replace(upper(trim({0})), '[^A-Z0-9]', '', 'g')) < 8 THEN lpad(regexp_replace(upper(trim({0})), '[^A-Z0-9]', '', 'g'), 8, '0') ELSE coalesce(regexp_replace(upper(trim({0})), '[^A-Z0-9]', '', 'g'), '') END)"
SQL_MATCHED = f"""
bn AS (SELECT {NUMBER_SQL.format("company_number")} AS k, max(company_number) AS company_number, arg_max(company_name, company_number) AS company_name FROM companies GROUP BY 1),
nm AS (SELECT {NAME_SQL.format("company_name")} AS k, min(company_number) AS company_number, arg_min(company_name, company_number) AS company_name FROM companies GROUP BY 1),
pn AS (SELECT {NAME_SQL.format("old")} AS k, min(company_number) AS company_number, arg_min(company_name, company_number) AS company_name FROM previous GROUP BY 1),
keyed AS (SELECT long.*, {NUMBER_SQL.format("company_reg_no")} AS nk, {NAME_SQL.format("proprietor_name")} AS mk FROM long),
matched AS (
  SELECT keyed.* EXCLUDE (nk, mk), t.*
  FROM keyed LEFT JOIN bn ON nk <> '' AND nk = bn.k LEFT JOIN nm ON mk <> '' AND mk = nm.k LEFT JOIN pn ON mk <> '' AND mk = pn.k,
  LATERAL (SELECT
    CASE WHEN coalesce(category, '') NOT IN ('Limited Company or Public Limited Company', 'Limited Liability Partnership') THEN 'Not_Company'
         WHEN bn.k IS NOT NULL THEN CASE WHEN {NAME_SQL.format("bn.company_name")} = mk THEN 'Name+Number' ELSE 'Number' END
         WHEN nm.k IS NOT NULL THEN 'Name' WHEN pn.k IS NOT NULL THEN 'Previous_Name' ELSE 'Land_Registry' END AS match_type) y,
  LATERAL (SELECT y.match_type AS match_type,
    CASE y.match_type WHEN 'Name+Number' THEN 1.0 WHEN 'Number' THEN 0.9 WHEN 'Name' THEN 0.7 WHEN 'Previous_Name' THEN 0.5 WHEN 'Land_Registry' THEN 0.3 ELSE 0.0 END AS confidence,
    CASE WHEN y.match_type IN ('Name+Number', 'Number') THEN bn.company_number WHEN y.match_type = 'Name' THEN nm.company_number WHEN y.match_type = 'Previous_Name' THEN pn.company_number WHEN y.match_type = 'Land_Registry' THEN substr(company_reg_no, 1, 20) END AS matched_number,
    CASE WHEN y.match_type IN ('Name+Number', 'Number') THEN bn.company_name WHEN y.match_type = 'Name' THEN nm.company_name WHEN y.match_type = 'Previous_Name' THEN pn.company_name WHEN y.match_type = 'Land_Registry' THEN proprietor_name END AS matched_name) t
)"""
BASE = f"WITH {SQL_TITLES}, {SQL_COMPANIES}, {SQL_LONG}"
MATCHED = f"{BASE}, {SQL_MATCHED}"
