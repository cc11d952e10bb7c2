"""Entity resolution and normaliser queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query, table
from ..functions import labels, text
from ..operators import analytics, resolve, slots
from .testdata import BASE, MATCHED, NAME_SQL, NUMBER_SQL, companies, titles

SHOWN = ["id", "slot", "proprietor_name", "matched_name", "matched_number", "match_type"]


def matched(spark, d, rules=resolve.PRODUCTION):
    return resolve.resolve(slots.unpivot(titles(spark, d)), companies(spark, d), rules)


def counted(spark, d):
    """matched() for counts by slot: a row for each different owner and slot, with its number of rows, n."""
    owner = ["slot", "proprietor_name", "company_reg_no", "category"]
    return resolve.resolve(slots.unpivot(titles(spark, d)).groupBy(*owner).agg(F.count("*").alias("n")), companies(spark, d))


def shown(df):
    return df.select(*SHOWN, F.col("confidence").cast("double").alias("confidence"))


_SHOWN = "id, slot, proprietor_name, matched_name, matched_number, match_type, CAST(confidence AS DOUBLE) AS confidence"


@query("unpivot_slots", f"{BASE} SELECT id, slot, proprietor_name, company_reg_no, category FROM long")
def unpivot_slots(spark, d):
    return slots.unpivot(titles(spark, d)).select("id", "slot", "proprietor_name", "company_reg_no", "category")


@query("pivot_slots", f"{BASE} SELECT id, " + ", ".join(f"max(CASE WHEN slot = {i} THEN proprietor_name END) AS owner_{i}" for i in range(1, 5)) + " FROM long GROUP BY id")
def pivot_slots(spark, d):
    return slots.pivot(slots.unpivot(titles(spark, d)), ["id"], {"proprietor_name": "owner_{}"})


@query("cross_slot_distinct", f"{BASE} SELECT id, proprietor_name, min(slot) AS slot FROM long GROUP BY id, proprietor_name")
def cross_slot(spark, d):
    return slots.cross_slot_distinct(slots.unpivot(titles(spark, d))).select("id", "proprietor_name", "slot")


@query("tiered_match", f"{MATCHED} SELECT {_SHOWN} FROM matched")
def tiered_match(spark, d):
    return shown(matched(spark, d))


_VARIANT = """, cand AS (SELECT {name} AS k, company_number, company_name, incorporation_date FROM companies),
cn AS (SELECT k, count(DISTINCT company_number) AS n, min(company_number) AS company_number, arg_min(company_name, company_number) AS company_name FROM cand GROUP BY k),
pcand AS (SELECT {old} AS k, company_number, company_name, incorporation_date FROM previous),
cp AS (SELECT k, count(DISTINCT company_number) AS n, min(company_number) AS company_number, arg_min(company_name, company_number) AS company_name FROM pcand GROUP BY k),
bn AS (SELECT {num} AS k, max(company_number) AS company_number, arg_max(company_name, company_number) AS company_name FROM companies GROUP BY 1),
keyed AS (SELECT long.*, {reg} AS nk, {own} AS mk FROM long)
""".format(name=NAME_SQL.format("company_name"), old=NAME_SQL.format("old"), num=NUMBER_SQL.format("company_number"), reg=NUMBER_SQL.format("company_reg_no"), own=NAME_SQL.format("proprietor_name"))
_TOP = f"CASE WHEN bn.k IS NOT NULL AND {NAME_SQL.format('bn.company_name')} = mk THEN 'Name+Number' WHEN bn.k IS NOT NULL THEN 'Number'"
_JOINS = "FROM keyed LEFT JOIN bn ON nk <> '' AND nk = bn.k LEFT JOIN cn ON mk <> '' AND mk = cn.k LEFT JOIN cp ON mk <> '' AND mk = cp.k"


def _variant(name_rule: str, old_rule: str, conf_name: str = "0.7", conf_old: str = "0.5", pick=("cn.company_number", "cn.company_name", "cp.company_number", "cp.company_name"), joins: str = "") -> str:
    return f"""{BASE}{_VARIANT}, typed AS (
 SELECT keyed.*, {_TOP} WHEN {name_rule} THEN 'Name' WHEN {old_rule} THEN 'Previous_Name' ELSE 'No_Match' END AS match_type,
  bn.company_number AS b1, bn.company_name AS b2, {pick[0]} AS c1, {pick[1]} AS c2, {pick[2]} AS p1, {pick[3]} AS p2, {conf_name} AS cf, {conf_old} AS pf {_JOINS} {joins})
SELECT id, slot, proprietor_name, match_type,
 CASE match_type WHEN 'Name+Number' THEN b2 WHEN 'Number' THEN b2 WHEN 'Name' THEN c2 WHEN 'Previous_Name' THEN p2 END AS matched_name,
 CASE match_type WHEN 'Name+Number' THEN b1 WHEN 'Number' THEN b1 WHEN 'Name' THEN c1 WHEN 'Previous_Name' THEN p1 END AS matched_number,
 CAST(CASE match_type WHEN 'Name+Number' THEN 1.0 WHEN 'Number' THEN 0.9 WHEN 'Name' THEN cf WHEN 'Previous_Name' THEN pf ELSE 0.0 END AS DOUBLE) AS confidence FROM typed"""


@query("match_classic", _variant("cn.k IS NOT NULL", "cp.k IS NOT NULL"))
def match_classic(spark, d):
    return shown(matched(spark, d, resolve.CLASSIC))


@query("match_ambiguous_reject", _variant("cn.n = 1", "cn.k IS NULL AND cp.n = 1"))
def match_reject(spark, d):
    return shown(matched(spark, d, resolve.REJECTING))


_BEST = "LEFT JOIN LATERAL (SELECT arg_min(company_number, (-epoch(incorporation_date), company_number)) AS num, arg_min(company_name, (-epoch(incorporation_date), company_number)) AS nam FROM {0} c WHERE c.k = mk AND c.incorporation_date <= date_proprietor_added) {1} ON true"


@query(
    "match_asof_date",
    _variant(
        "cn.n = 1 OR (cn.n > 1 AND e1.num IS NOT NULL)", "cn.k IS NULL AND (cp.n = 1 OR (cp.n > 1 AND e2.num IS NOT NULL))",
        "CASE WHEN cn.n > 1 THEN 0.6 ELSE 0.7 END", "CASE WHEN cp.n > 1 THEN 0.4 ELSE 0.5 END",
        ("CASE WHEN cn.n = 1 THEN cn.company_number ELSE e1.num END", "CASE WHEN cn.n = 1 THEN cn.company_name ELSE e1.nam END", "CASE WHEN cp.n = 1 THEN cp.company_number ELSE e2.num END", "CASE WHEN cp.n = 1 THEN cp.company_name ELSE e2.nam END"),
        _BEST.format("cand", "e1") + " " + _BEST.format("pcand", "e2"),
    ),
)
def match_asof(spark, d):
    return shown(matched(spark, d, resolve.BY_DATE))


@query("match_upgrade", f"{MATCHED} SELECT id, slot, CASE WHEN match_type = 'Number' AND slot = 2 THEN 'Name+Number' ELSE match_type END AS match_type, CAST(CASE WHEN match_type = 'Number' AND slot = 2 THEN 1.0 ELSE confidence END AS DOUBLE) AS confidence FROM matched")
def match_upgrade(spark, d):
    # A laxer key for the second look: all names of slot 2 agree under it, and no others do.
    key = lambda c: F.when(F.col("slot") == 2, F.lit("same")).otherwise(F.concat(c, F.col("id")))
    low = matched(spark, d).withColumn("proprietor_name", F.concat("proprietor_name", F.lit("?")))
    return resolve.upgrade(low, key).select("id", "slot", "match_type", F.col("confidence").cast("double").alias("confidence"))


@query("match_upgrade_renormalised", f"""{MATCHED}, o AS (SELECT id, slot, match_type, confidence, matched_name, CASE WHEN slot = 1 THEN proprietor_name ELSE lower(matched_name) || ' Limited' END AS p FROM matched),
u AS (SELECT *, coalesce(match_type = 'Number' AND {NAME_SQL.format("p")} = {NAME_SQL.format("matched_name")}, false) AS agree FROM o)
SELECT id, slot, CASE WHEN agree THEN 'Name+Number' ELSE match_type END AS match_type, CAST(CASE WHEN agree THEN 1.0 ELSE confidence END AS DOUBLE) AS confidence FROM u""")
def match_upgrade_renormalised(spark, d):
    # Names of the later slots have been corrected since, in another style; those of the first still differ.
    later = F.when(F.col("slot") == 1, F.col("proprietor_name")).otherwise(F.concat(F.lower("matched_name"), F.lit(" Limited")))
    return resolve.upgrade(matched(spark, d).withColumn("proprietor_name", later)).select("id", "slot", "match_type", F.col("confidence").cast("double").alias("confidence"))


def scraped(spark, d):
    return companies(spark, d).where("company_status = 'Active'").select("company_number", F.concat(F.lit("Found "), "company_name").alias("company_name"), "previous_names")


@query("match_scraped", f"""{MATCHED}, f AS (SELECT {NUMBER_SQL.format("company_number")} AS k, max('Found ' || company_name) AS found FROM companies WHERE company_status = 'Active' GROUP BY 1)
SELECT id, slot, proprietor_name, coalesce(found, matched_name) AS matched_name, matched_number, CASE WHEN found IS NOT NULL THEN 'Scraped' ELSE match_type END AS match_type, CAST(CASE WHEN found IS NOT NULL THEN 0.8 ELSE confidence END AS DOUBLE) AS confidence
FROM matched LEFT JOIN f ON match_type = 'Land_Registry' AND {NUMBER_SQL.format("matched_number")} <> '' AND {NUMBER_SQL.format("matched_number")} = k""")
def match_scraped(spark, d):
    # The search also knows the numbers that the register writes with a prefix.
    # They are looked up for the different owners, before the owners' rows fetch their match.
    found = scraped(spark, d)
    return shown(resolve.resolve(slots.unpivot(titles(spark, d)), companies(spark, d), then=lambda answers: resolve.apply_scraped(answers, found)))


_SPELL = "list_distinct(list_filter([upper(trim({0})), {1}, regexp_replace(upper(trim({0})), '^[A-Z]+', ''), CASE WHEN length(regexp_replace(regexp_replace(upper(trim({0})), '^[A-Z]+', ''), '^0+', '')) < 8 THEN lpad(regexp_replace(regexp_replace(upper(trim({0})), '^[A-Z]+', ''), '^0+', ''), 8, '0') ELSE regexp_replace(regexp_replace(upper(trim({0})), '^[A-Z]+', ''), '^0+', '') END, regexp_replace(regexp_replace(upper(trim({0})), '^[A-Z]+', ''), '^0+', '')], lambda x: x IS NOT NULL AND x <> ''))"


@query("match_number_variants", f"""{BASE}, o AS (SELECT id, slot, proprietor_name, company_reg_no FROM long), c AS (SELECT * FROM companies WHERE company_status = 'Active'),
cs AS (SELECT company_number, unnest({_SPELL.format("company_number", NUMBER_SQL.format("company_number"))}) AS s FROM c),
os AS (SELECT DISTINCT company_reg_no, unnest({_SPELL.format("company_reg_no", NUMBER_SQL.format("company_reg_no"))}) AS s FROM o WHERE company_reg_no IS NOT NULL),
n1 AS (SELECT company_reg_no, min(company_number) AS n1 FROM os JOIN cs USING (s) GROUP BY 1),
nn AS (SELECT upper(trim(name)) AS u, min(company_number) AS n2 FROM (SELECT 'Found ' || company_name AS name, company_number FROM c UNION ALL SELECT old, p.company_number FROM previous p JOIN c USING (company_number)) GROUP BY 1)
SELECT o.id, o.slot, o.proprietor_name, o.company_reg_no, coalesce(n1, n2) AS company_number, CAST(CASE WHEN n1 IS NOT NULL THEN 1.0 WHEN n2 IS NOT NULL THEN 0.9 END AS DOUBLE) AS confidence
FROM o LEFT JOIN n1 ON o.company_reg_no = n1.company_reg_no LEFT JOIN nn ON upper(trim(o.proprietor_name)) = u""")
def match_number_variants(spark, d):
    owners = slots.unpivot(titles(spark, d)).select("id", "slot", "proprietor_name", "company_reg_no")
    out = resolve.match_by_spellings(owners, scraped(spark, d))
    return out.withColumn("confidence", F.col("confidence").cast("double"))


#: A search's results, made from the register: it looked for an old style of name, and some companies still have that one.
_SEARCHED = "concat('Former#', lpad(cast(cast(company_number as int) % 31 as string), 9, '0'), ' PLC')"
_FOUND = f"""SELECT {_SEARCHED} AS search_name, company_number, CASE WHEN cast(company_number as int) % 3 = 0 THEN {_SEARCHED} ELSE company_name END AS company_name, company_status,
 'supplier#' || lpad(cast(cast(company_number as int) % 17 + 1 as string), 9, '0') AS former FROM companies"""


def found(spark, d):
    search = F.expr(_SEARCHED)
    c = companies(spark, d).withColumn("n", F.col("company_number").cast("int"))
    former = F.concat(F.lit("supplier#"), F.lpad((F.col("n") % 17 + 1).cast("string"), 9, "0"))
    return c.select(search.alias("search_name"), "company_number", F.when(F.col("n") % 3 == 0, search).otherwise(F.col("company_name")).alias("company_name"), "company_status", F.array(former).alias("previous_names"))


_OPEN = "('Land_Registry', 'Previous_Name', 'Name')"


@query("scraped_match_labels", f"""{MATCHED}, f AS ({_FOUND}), u AS (SELECT id, proprietor_name FROM matched WHERE match_type IN {_OPEN}),
m AS (SELECT u.*, company_number, company_name, company_status, CASE WHEN company_status = 'Dissolved' THEN 'Dissolved_Company' WHEN proprietor_name <> company_name THEN 'Name_Changed' ELSE 'Exact_Match' END AS match_type, 'Direct match on search_name' AS match_reason
 FROM u JOIN f ON proprietor_name = search_name
 UNION SELECT u.*, company_number, company_name, company_status, 'Previous_Name_Match', 'Matched on previous company name' FROM u JOIN f ON proprietor_name = former)
SELECT proprietor_name AS search_name, company_number, company_name, company_status, match_type, match_reason, count(*) AS properties FROM m GROUP BY ALL""")
def scraped_match_labels(spark, d):
    return resolve.scraped_label_report(matched(spark, d), found(spark, d), ("Land_Registry", "Previous_Name", "Name"))


@query("candidate_report", f"""{BASE}, f AS ({_FOUND}), p AS (SELECT DISTINCT title_number, proprietor_name, company_number, company_name, company_status,
 CASE WHEN proprietor_name = company_name THEN 'exact_match' WHEN proprietor_name = former THEN 'previous_name_match' ELSE 'search_name_match' END AS match_type
 FROM long JOIN f ON proprietor_name = search_name OR proprietor_name = company_name OR proprietor_name = former WHERE company_reg_no IS NULL)
SELECT match_type, company_status, count(*) AS match_count, count(DISTINCT company_number) AS unique_companies, count(DISTINCT title_number) AS unique_properties FROM p GROUP BY 1, 2""")
def candidate_report(spark, d):
    return resolve.candidate_report(slots.unpivot(titles(spark, d)), found(spark, d))


@query("unmatched_export", f"{MATCHED} SELECT upper(trim(proprietor_name)) AS search_name, max(company_reg_no) AS company_reg_no, count(DISTINCT title_number) AS properties FROM matched WHERE match_type = 'Land_Registry' GROUP BY 1")
def unmatched_export(spark, d):
    return resolve.unmatched(matched(spark, d))


@query("unmatched_reasons", f"""{MATCHED} SELECT CASE WHEN coalesce(company_reg_no, '') <> '' THEN CASE WHEN company_reg_no LIKE 'RS%' THEN 'RS - Registered Society' WHEN regexp_full_match(company_reg_no, '0+') THEN 'Zero-filled' WHEN regexp_full_match(company_reg_no, '[0-9]+') THEN 'Standard UK Number' ELSE 'Other Format' END
 ELSE CASE WHEN upper(proprietor_name) LIKE '%LIMITED%' OR upper(proprietor_name) LIKE '%LTD%' OR upper(proprietor_name) LIKE '%PLC%' THEN 'UK Company' ELSE 'Other' END END AS reason,
 coalesce(company_reg_no, '') <> '' AS has_number, count(*) AS records, count(DISTINCT proprietor_name) AS names FROM matched WHERE match_type IN ('No_Match', 'Land_Registry') GROUP BY 1, 2""")
def unmatched_reasons(spark, d):
    return analytics.unmatched_reasons(matched(spark, d))


@query("match_quality_by_region", f"""{MATCHED} SELECT region, count(*) AS total_proprietors, count(*) FILTER (match_type NOT IN ('No_Match', 'Land_Registry', 'Not_Company')) AS matched,
 count(*) FILTER (match_type = 'Name+Number') AS name_number, count(*) FILTER (match_type = 'Number') AS number_only, count(*) FILTER (match_type = 'Name') AS name_only, count(*) FILTER (match_type = 'Previous_Name') AS previous_name,
 round(100.0::DOUBLE * count(*) FILTER (match_type NOT IN ('No_Match', 'Land_Registry', 'Not_Company')) / count(*), 2) AS match_rate FROM matched GROUP BY region""")
def match_quality_by_region(spark, d):
    return analytics.match_quality_by_region(matched(spark, d))


@query("match_summary", f"""{MATCHED} SELECT count(DISTINCT id) AS total_properties, count(DISTINCT CASE WHEN match_type <> 'No_Match' THEN title_number END) AS properties_with_matches,
 count(*) FILTER (slot = 1 AND match_type = 'Name+Number') AS prop1_name_number_matches, count(*) FILTER (slot = 1 AND match_type = 'Number') AS prop1_number_matches, count(*) FILTER (slot = 1 AND match_type = 'Name') AS prop1_name_matches,
 count(*) FILTER (slot = 1 AND match_type = 'Previous_Name') AS prop1_previous_name_matches, count(*) FILTER (slot = 1 AND match_type = 'No_Match') AS prop1_no_matches, count(*) FILTER (match_type <> 'No_Match') AS total_proprietor_matches FROM matched""")
def match_summary(spark, d):
    return analytics.match_summary(matched(spark, d))


@query("not_in_null_semantics", f"{MATCHED} SELECT slot, count(CASE WHEN match_type NOT IN ('No_Match', NULL) THEN 1 END) AS matched, count(*) AS total FROM matched GROUP BY slot")
def not_in_null(spark, d):
    return analytics.not_in_with_null(counted(spark, d), rows=F.col("n"))


@query("not_in_corrected", f"{MATCHED} SELECT slot, count(CASE WHEN match_type <> 'No_Match' THEN 1 END) AS matched, count(*) AS total FROM matched GROUP BY slot")
def not_in_corrected(spark, d):
    return analytics.not_in_with_null(counted(spark, d), strict=False, rows=F.col("n"))


@query("incremental_missing", f"{MATCHED} SELECT id, slot FROM long EXCEPT SELECT id, slot FROM matched WHERE slot <> 2")
def incremental_missing(spark, d):
    return resolve.incremental(slots.unpivot(titles(spark, d)), matched(spark, d).where("slot <> 2")).select("id", "slot")


@query("incremental_full", f"{BASE} SELECT id, slot FROM long")
def incremental_full(spark, d):
    return resolve.incremental(slots.unpivot(titles(spark, d)), None, "full").select("id", "slot")


@query("incremental_no_match", f"{MATCHED} SELECT id, slot FROM matched WHERE match_type IN ('No_Match', 'Land_Registry')")
def incremental_no_match(spark, d):
    return resolve.incremental(slots.unpivot(titles(spark, d)), matched(spark, d), "no_match_only").select("id", "slot")


@query("incremental_date_range", f"{BASE} SELECT id, slot FROM long WHERE file_month BETWEEN DATE '1997-01-01' AND DATE '1997-06-01'")
def incremental_range(spark, d):
    return resolve.incremental(slots.unpivot(titles(spark, d)), None, "date_range", date_range=("1997-01-01", "1997-06-01")).select("id", "slot")


@query("coverage_missing", f"{MATCHED} SELECT count(*) AS missing FROM long l WHERE NOT EXISTS (SELECT 1 FROM matched m WHERE m.id = l.id AND m.slot = l.slot)")
def coverage(spark, d):
    return analytics.missing(slots.unpivot(titles(spark, d)), matched(spark, d).select("id", "slot"), ["id", "slot"]).agg(F.count("*").alias("missing"))


@query("duplicate_names", f"""{BASE} SELECT regexp_replace(regexp_replace(upper(company_name), '\\s*(LIMITED LIABILITY PARTNERSHIP|LIMITED|COMPANY|LTD\\.|LLP|LTD|PLC|CO\\.|CO|LP|L\\.P\\.)$', ''), '[^A-Z0-9]', '', 'g') AS normalized, count(*) AS company_count,
 string_agg(company_name || ' (' || company_number || ')', '; ' ORDER BY company_name || ' (' || company_number || ')') AS companies FROM companies GROUP BY 1 HAVING count(*) >= 2""")
def duplicate_names(spark, d):
    return analytics.duplicate_names(companies(spark, d))


@query("normalise_name", f"SELECT p_partkey, {NAME_SQL.format('p_name || CASE p_partkey % 4 WHEN 0 THEN {q} and sons LTD{q} WHEN 1 THEN {q} & partners LLP{q} WHEN 2 THEN {q} Company (UK){q} ELSE {q}{q} END').replace('{q}', chr(39))} AS name_key FROM part")
def normalise_name(spark, d):
    end = F.when(F.col("p_partkey") % 4 == 0, " and sons LTD").when(F.col("p_partkey") % 4 == 1, " & partners LLP").when(F.col("p_partkey") % 4 == 2, " Company (UK)").otherwise("")
    return table(spark, d, "part").select("p_partkey", text.name_key(F.concat("p_name", end)).alias("name_key"))


@query("normalise_number", f"SELECT s_suppkey, {NUMBER_SQL.format('n')} AS number_key FROM (SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN {{q}} {{q}} || s_suppkey WHEN 1 THEN {{q}}sc{{q}} || s_suppkey WHEN 2 THEN {{q}}0000{{q}} || s_suppkey || {{q}}-567{{q}} WHEN 3 THEN NULL ELSE {{q}}r.s. {{q}} || s_suppkey END AS n FROM supplier)".replace("{q}", "'"))
def normalise_number(spark, d):
    k, s = F.col("s_suppkey") % 5, F.col("s_suppkey").cast("string")
    n = F.when(k == 0, F.concat(F.lit(" "), s)).when(k == 1, F.concat(F.lit("sc"), s)).when(k == 2, F.concat(F.lit("0000"), s, F.lit("-567"))).when(k == 4, F.concat(F.lit("r.s. "), s))
    return table(spark, d, "supplier").select("s_suppkey", text.number_key(n).alias("number_key"))


@query("regno_class", f"{BASE} SELECT CASE WHEN company_reg_no LIKE 'RS%' THEN 'RS - Registered Society' WHEN regexp_full_match(company_reg_no, '0+') THEN 'Zero-filled' WHEN regexp_full_match(company_reg_no, '[0-9]+') THEN 'Standard UK Number' ELSE 'Other Format' END AS reg_type, count(*) AS records FROM long WHERE company_reg_no IS NOT NULL AND company_reg_no <> '' GROUP BY 1")
def regno_class(spark, d):
    long = slots.unpivot(titles(spark, d)).where(text.present(F.col("company_reg_no")))
    return long.groupBy(labels.number_class(F.col("company_reg_no")).alias("reg_type")).agg(F.count("*").alias("records"))


@query("name_class", """SELECT p_partkey, CASE WHEN n LIKE '%COUNCIL%' OR n LIKE '%BOROUGH%' OR n LIKE '%AUTHORITY%' THEN 'Council/Government' WHEN n LIKE '%NHS%' THEN 'NHS/Healthcare' WHEN n LIKE '%TRUST%' AND n LIKE '%HOUSING%' THEN 'Housing Trust'
 WHEN n LIKE '%HOUSING%' THEN 'Housing Association' WHEN n LIKE '%CHURCH%' THEN 'Religious' WHEN regexp_full_match(n, '[A-Z][A-Z\\s\\-'']+') AND n NOT LIKE '%LIMITED%' THEN 'Possible Individual' WHEN n LIKE '%LTD%' OR n LIKE '%LIMITED%' OR n LIKE '%PLC%' THEN 'UK Company' ELSE 'Other' END AS owner_class
 FROM (SELECT p_partkey, upper(CASE p_partkey % 8 WHEN 0 THEN 'borough of ' || p_name WHEN 1 THEN p_name || ' housing trust' WHEN 2 THEN 'housing ' || p_name WHEN 3 THEN 'nhs ' || p_name WHEN 4 THEN p_name || ' 1 ltd' WHEN 5 THEN 'church of ' || p_name WHEN 6 THEN 'smith' ELSE p_name || ' 12' END) AS n FROM part)""")
def name_class(spark, d):
    k, p = F.col("p_partkey") % 8, F.col("p_name")
    c = lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y for y in x])
    n = F.when(k == 0, c("borough of ", p)).when(k == 1, c(p, " housing trust")).when(k == 2, c("housing ", p)).when(k == 3, c("nhs ", p)).when(k == 4, c(p, " 1 ltd")).when(k == 5, c("church of ", p)).when(k == 6, F.lit("smith")).otherwise(c(p, " 12"))
    return table(spark, d, "part").select("p_partkey", labels.owner_class(F.upper(n)).alias("owner_class"))
