"""Entity resolution: owners to registered companies, in tiers.

Owners are matched by registration number, name and previous name through three equi-joins on normalised keys,
and a ladder picks the first tier that holds. The register's sides are reduced to a row per key first, so that
a join never multiplies owners. Ties in the register go to the smallest company number.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text
from ..functions.labels import COMPANY_CATEGORIES, CONFIDENCE
from .joins import spread

ADDED = "date_proprietor_added"
#: Is the owner's category a company's? All that a match depends on of the category.
COMPANY = "_company"


@dataclass(frozen=True)
class Rules:
    """What the ladder does.

    companies_only: other owner categories are Not_Company and tried no further.
    fallback: type of unmatched owners; "Land_Registry" keeps their own name and number, "No_Match" leaves none.
    ambiguous: what a name with several companies gives: "first", "reject" or "by_date" (the latest incorporated by
    the day the owner was added, at a lower confidence).
    previous_names: how many of a company's previous names count.
    """

    companies_only: bool = True
    fallback: str = "Land_Registry"
    ambiguous: str = "first"
    previous_names: int = 5
    name_key: Callable[[Column], Column] = text.name_key


PRODUCTION = Rules()
CLASSIC = Rules(companies_only=False, fallback="No_Match")
REJECTING = Rules(companies_only=False, fallback="No_Match", ambiguous="reject")
BY_DATE = Rules(companies_only=False, fallback="No_Match", ambiguous="by_date", previous_names=10)


def is_company(category: Column) -> Column:
    return F.coalesce(category.isin(*COMPANY_CATEGORIES), F.lit(False))


def _confidence(c: Column) -> Column:
    return c.cast("decimal(3,2)")


def register_by_number(companies: DataFrame, rules: Rules = PRODUCTION) -> DataFrame:
    key = text.number_key(F.col("company_number"))
    best = F.max_by(F.struct("company_number", "company_name"), F.col("company_number"))
    out = companies.where(key != "").groupBy(key.alias("number_key")).agg(best.alias("by_number"))
    return out.withColumn("number_name_key", rules.name_key(F.col("by_number.company_name")))


def _candidates(named: DataFrame, key: str, out: str) -> DataFrame:
    """Of each key: the first company, their number and the day of the first incorporation."""
    one = F.struct("company_number", "company_name")
    return named.where(F.col(key) != "").groupBy(key).agg(
        F.min_by(one, F.col("company_number")).alias(out), F.count_distinct("company_number").alias(f"{out}_n"), F.min("incorporation_date").alias(f"{out}_from")
    )


def _named(companies: DataFrame, rules: Rules) -> DataFrame:
    named = companies.select("company_number", "company_name", "incorporation_date", rules.name_key(F.col("company_name")).alias("name_key"))
    return named.where("name_key <> ''")


def _formerly(companies: DataFrame, rules: Rules) -> DataFrame:
    old = companies.select("company_number", "company_name", "incorporation_date", F.explode(F.slice("previous_names", 1, rules.previous_names)).alias("old"))
    return old.withColumn("name_key", rules.name_key(F.col("old"))).where("name_key <> ''")


def register_by_name(companies: DataFrame, rules: Rules = PRODUCTION) -> DataFrame:
    return _candidates(_named(companies, rules), "name_key", "by_name")


def register_by_previous_name(companies: DataFrame, rules: Rules = PRODUCTION) -> DataFrame:
    """companies.previous_names: array<string>."""
    return _candidates(_formerly(companies, rules), "name_key", "by_previous")


def latest_by(asked: DataFrame, named: DataFrame, out: str) -> DataFrame:
    """asked (key, day; without nulls) with the company of that key incorporated last by that day, as out: of one day the smallest number.

    Companies and questions of a key are one stream in the order of days, and the last company is carried forward in a
    window, which can spill: no question meets all companies of its name."""
    asked = asked.distinct()
    company = F.struct("company_number", "company_name")
    known = named.where("incorporation_date is not null").select(F.col("name_key").alias("key"), F.col("incorporation_date").alias("day"), F.lit(0).alias("_kind"), F.col("company_number").alias("_no"), company.alias("_c"))
    asks = asked.select("key", "day", F.lit(1).alias("_kind"), F.lit(None).cast("string").alias("_no"), F.lit(None).cast(known.schema["_c"].dataType).alias("_c"))
    order = Window.partitionBy("key").orderBy("day", "_kind", F.desc("_no")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return known.unionByName(asks).withColumn(out, F.last("_c", ignorenulls=True).over(order)).where("_kind = 1").select("key", "day", out)


def _chosen(found: str, rules: Rules) -> tuple[Column, Column, Column]:
    """(company, is there one, was it ambiguous) by the rule for names with several companies."""
    first, n = F.col(found), F.col(f"{found}_n")
    return first, n.isNotNull() if rules.ambiguous == "first" else (n == 1), n > 1


def _row(kind: str, name: Column, number: Column, confidence: float | None = None) -> Column:
    return F.struct(name.alias("matched_name"), number.alias("matched_number"), F.lit(kind).alias("match_type"), _confidence(F.lit(CONFIDENCE[kind] if confidence is None else confidence)).alias("confidence"))


def _answers(asked: DataFrame, companies: DataFrame, rules: Rules) -> DataFrame:
    """asked with its match: everything here is as small as there are different owners. By date, names of several companies have no
    match yet, but _ask, the key to ask of with a day, and _from, the first day that has an answer."""
    keyed = asked.withColumns({"_nk": text.number_key(F.col("company_reg_no")), "_mk": rules.name_key(F.col("proprietor_name"))})
    number = register_by_number(companies, rules)
    name = register_by_name(companies, rules).withColumnRenamed("name_key", "_k1")
    previous = register_by_previous_name(companies, rules).withColumnRenamed("name_key", "_k2")
    # Empty keys match nothing and would be one hot key: they are spread.
    keyed = keyed.withColumns({"_nj": spread(F.col("_nk"), asked), "_mj": spread(F.col("_mk"), asked)})
    joined = keyed.join(number, F.col("_nj") == F.col("number_key"), "left").join(name, F.col("_mj") == F.col("_k1"), "left").join(previous, F.col("_mj") == F.col("_k2"), "left")
    by_name, name_ok, name_many = _chosen("by_name", rules)
    by_old, old_ok, old_many = _chosen("by_previous", rules)
    if rules.ambiguous != "first":  # several companies of that name: previous names aren't tried
        old_ok = old_ok & F.col("by_name_n").isNull()
    number_ok = F.col("by_number").isNotNull()
    none = F.lit(None).cast("string")
    row = _row
    skip = ~F.col(COMPANY) if rules.companies_only else F.lit(False)
    ladder = (
        F.when(text.blank(F.col("proprietor_name")), F.lit(None))
        .when(skip, row("Not_Company", none, none))
        .when(number_ok & (F.col("number_name_key") == F.col("_mk")), row("Name+Number", F.col("by_number.company_name"), F.col("by_number.company_number")))
        .when(number_ok, row("Number", F.col("by_number.company_name"), F.col("by_number.company_number")))
        .when(name_ok, row("Name", by_name["company_name"], by_name["company_number"]))
        .when(old_ok, row("Previous_Name", by_old["company_name"], by_old["company_number"]))
        .otherwise(row("Land_Registry", F.col("proprietor_name"), F.substring("company_reg_no", 1, 20)) if rules.fallback == "Land_Registry" else row("No_Match", none, none))
    )
    joined = joined.withColumn("_m", ladder)
    if rules.ambiguous != "by_date":
        return joined.select(*asked.columns, "_m.*")
    untold = ~text.blank(F.col("proprietor_name")) & ~skip & ~number_ok
    ask_name, ask_old = untold & name_many, untold & F.col("by_name_n").isNull() & old_many
    ask = F.when(ask_name, F.concat(F.lit("1"), "_mk")).when(ask_old, F.concat(F.lit("2"), "_mk"))
    return joined.select(*asked.columns, "_m.*", ask.alias("_ask"), F.when(ask_name, F.col("by_name_from")).when(ask_old, F.col("by_previous_from")).alias("_from"))


def resolve(owners: DataFrame, companies: DataFrame, rules: Rules = PRODUCTION, then: Callable[[DataFrame], DataFrame] | None = None, of: DataFrame | None = None, keep: bool = False) -> DataFrame:
    """owners (proprietor_name, company_reg_no, category, date_proprietor_added, ...) with matched_name,
    matched_number, match_type, confidence.

    What a match depends on (name, number and, where the rules ask for it, whether the category is a company's) is
    made distinct first, in the map side, and goes through the ladder once; owners, with all their columns, are shuffled once, to
    fetch the result, and not sorted: a task has the different owners of its share as a hash table. AQE splits the rows of an owner
    that has very many. then: more columns for the results, while they are small. of: rows with all different owners, where they are
    had more cheaply than from owners. Either may bring the category's answer as COMPANY, which stays with keep."""
    kept = [c for c in owners.columns if keep or c != COMPANY]
    if rules.companies_only:
        owners, of = (d if d is None or COMPANY in d.columns else d.withColumn(COMPANY, is_company(F.col("category"))) for d in (owners, of))
    dated = rules.ambiguous == "by_date"
    on = [c for c in ("proprietor_name", "company_reg_no", *([COMPANY] if rules.companies_only else [])) if c in owners.columns]
    every = owners if of is None else of
    answers = _answers(every.select(*on).distinct(), companies, rules)
    answers = then(answers) if then else answers
    more = [c for c in answers.columns if c not in (*on, "_ask", "_from")]
    out = [*[c for c in kept if c not in more], *more]
    if dated and ADDED in owners.columns:
        answers = _answers_by_day(every.select(*on, ADDED).distinct(), answers, on, companies, rules, then)
        on = [*on, ADDED]
    return _fetched(owners.drop(*more), answers.select(*on, *more), on).select(*out)


def _answers_by_day(asked: DataFrame, answers: DataFrame, on: list[str], companies: DataFrame, rules: Rules, then: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """asked (owners with their days) with their match: answers settle all but names of several companies from the first one's day on. Of
    these the different names and days are asked for, and no others."""
    found, day, early = _fetched(asked, answers, on), F.col(ADDED), F.coalesce(F.col(ADDED) < F.col("_from"), F.lit(True))
    settled, late = found.where(F.col("_ask").isNull() | early), found.where(F.col("_ask").isNotNull() & ~early).select(*on, ADDED, "_ask")
    known = [n.select(F.concat(F.lit(i), "name_key").alias("name_key"), "company_number", "company_name", "incorporation_date") for i, n in (("1", _named(companies, rules)), ("2", _formerly(companies, rules)))]
    told = latest_by(late.select(F.col("_ask").alias("key"), day.alias("day")), known[0].unionByName(known[1]), "_c")
    name, number = F.col("_c.company_name"), F.col("_c.company_number")
    told = told.withColumn("_m", F.when(F.startswith("key", F.lit("1")), _row("Name", name, number, 0.6)).otherwise(_row("Previous_Name", name, number, 0.4))).select("key", "day", "_m.*")
    told = then(told) if then else told
    late = late.join(told, (F.col("_ask") == F.col("key")) & (day == F.col("day")), "left").drop("key", "day", "_ask")
    return settled.drop("_ask", "_from").unionByName(late)


def _fetched(owners: DataFrame, answers: DataFrame, on: list[str]) -> DataFrame:
    """owners with the answers' other columns, joined on `on`, where nulls are equal."""
    side = answers.withColumnsRenamed({c: f"_on_{c}" for c in on}).hint("shuffle_hash")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on])
    return owners.join(side, same, "left").drop(*[f"_on_{c}" for c in on])


def incremental(owners: DataFrame, matched: DataFrame, mode: str = "missing_only", keys: tuple[str, ...] = ("id", "slot"), date_range: tuple[str, str] | None = None) -> DataFrame:
    """Owners that a mode asks to match: full, no_match_only, missing_only, or date_range over file_month."""
    on = list(keys)
    if mode == "full":
        return owners
    if mode == "missing_only":
        return owners.join(matched, on, "left_anti")
    if mode == "no_match_only":
        return owners.join(matched.where(F.col("match_type").isin("No_Match", "Land_Registry")), on, "left_semi")
    if mode == "date_range":
        return owners.where(F.col("file_month").between(*date_range))
    raise ValueError(f"unknown mode {mode!r}")


def upgrade(matched: DataFrame, name_key: Callable[[Column], Column] = text.name_key) -> DataFrame:
    """Number matches whose names agree after all become Name+Number."""
    agree = (F.col("match_type") == "Number") & (name_key(F.col("proprietor_name")) == name_key(F.col("matched_name")))
    return matched.withColumns({"match_type": F.when(agree, "Name+Number").otherwise(F.col("match_type")), "confidence": F.when(agree, _confidence(F.lit(1.0))).otherwise(F.col("confidence"))})


def apply_scraped(matched: DataFrame, scraped: DataFrame) -> DataFrame:
    """Unmatched owners whose number was found since take the found name: scraped(company_number, company_name)."""
    found = scraped.where(text.present(F.col("company_number"))).groupBy(text.number_key(F.col("company_number")).alias("_k")).agg(F.max("company_name").alias("_found"))
    key = spread(F.when(F.col("match_type") == "Land_Registry", text.number_key(F.col("matched_number"))), matched)
    hit = F.col("_found").isNotNull()
    return (
        matched.withColumn("_key", key)
        .join(found, F.col("_key") == F.col("_k"), "left")
        .withColumns({"matched_name": F.coalesce("_found", "matched_name"), "match_type": F.when(hit, "Scraped").otherwise(F.col("match_type")), "confidence": F.when(hit, _confidence(F.lit(0.8))).otherwise(F.col("confidence"))})
        .select(*matched.columns)
    )


def match_by_spellings(owners: DataFrame, scraped: DataFrame) -> DataFrame:
    """(owner columns, company_number, confidence) of every row: by any spelling of the number (1.00), else by name or a previous
    name (0.90).

    An OR of spellings would be a nested-loop join; each side's spellings are rows of an equi-join here. Numbers and names are
    looked up for every different pair once, and owners are shuffled once, to fetch the result; rows that repeat come back as often."""
    theirs = scraped.withColumn("_s", F.explode(text.number_spellings(F.col("company_number")))).groupBy("_s").agg(F.min("company_number").alias("_n1"))
    names = scraped.withColumn("_s", F.explode(F.array_union(F.array("company_name"), F.coalesce("previous_names", F.array().cast("array<string>")))))
    by_name = names.where(text.present(F.col("_s"))).groupBy(F.upper(text.strip(F.col("_s"))).alias("_u")).agg(F.min("company_number").alias("_n2"))
    # A row without a spelling stays as one that matches nothing.
    asked = owners.select(F.col("company_reg_no").alias("_reg"), F.col("proprietor_name").alias("_name")).distinct()
    spelt = asked.withColumn("_t", F.explode_outer(text.number_spellings(F.when(text.present(F.col("_reg")), F.col("_reg")))))
    spelt = spelt.withColumn("_t", spread(F.col("_t"), asked)).join(theirs, F.col("_t") == F.col("_s"), "left").groupBy("_reg", "_name").agg(F.min("_n1").alias("_n1"))
    found = spelt.withColumn("_uj", spread(F.upper(text.strip(F.col("_name"))), asked)).join(by_name, F.col("_uj") == F.col("_u"), "left").select("_reg", "_name", "_n1", "_n2")
    got = owners.join(found, F.col("company_reg_no").eqNullSafe(F.col("_reg")) & F.col("proprietor_name").eqNullSafe(F.col("_name")), "left")
    number = F.coalesce("_n1", "_n2")
    return got.select(*owners.columns, number.alias("company_number"), _confidence(F.when(F.col("_n1").isNotNull(), 1.0).when(F.col("_n2").isNotNull(), 0.9)).alias("confidence"))


SCRAPED = ["company_number", "company_name", "company_status"]


def label_scraped(matched: DataFrame, scraped: DataFrame, kinds: tuple[str, ...] = ("No_Match", "Land_Registry")) -> DataFrame:
    """Unmatched company owners whose name a search found, by the name searched for or by a previous name of the company:
    matched columns id and proprietor_name, the company, match_type (Exact_Match, Name_Changed, Dissolved_Company,
    Previous_Name_Match) and match_reason, each combination once. scraped: search_name, SCRAPED, previous_names."""
    return _open(matched, kinds).join(_labels(scraped), F.col("proprietor_name") == F.col("_name")).drop("_name").distinct()


def _open(matched: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    return matched.where(F.col("category").isin(*COMPANY_CATEGORIES) & (F.col("match_type").isNull() | F.col("match_type").isin(*kinds)) & text.present(F.col("proprietor_name"))).select("id", "proprietor_name")


def _labels(scraped: DataFrame) -> DataFrame:
    """The names by which a search knows a company, with what label_scraped says of them: each combination once."""
    direct = F.when(F.col("company_status") == "Dissolved", "Dissolved_Company").when(F.col("_name") != F.col("company_name"), "Name_Changed").otherwise("Exact_Match")
    searched = scraped.select(F.col("search_name").alias("_name"), *SCRAPED).withColumns({"match_type": direct, "match_reason": F.lit("Direct match on search_name")})
    former = scraped.select(F.explode("previous_names").alias("_name"), *SCRAPED).withColumns({"match_type": F.lit("Previous_Name_Match"), "match_reason": F.lit("Matched on previous company name")})
    return searched.unionByName(former).where("_name is not null").distinct()


def scraped_label_report(matched: DataFrame, scraped: DataFrame, kinds: tuple[str, ...] = ("No_Match", "Land_Registry")) -> DataFrame:
    """Of label_scraped's rows: the number of ids by name searched for, company and label. Ids are counted for each name before
    its companies join, so that names with many of both aren't multiplied out."""
    properties = _open(matched, kinds).distinct().groupBy("proprietor_name").agg(F.count("*").alias("properties"))
    found = _labels(scraped).join(properties, F.col("proprietor_name") == F.col("_name"))
    return found.select(F.col("proprietor_name").alias("search_name"), *SCRAPED, "match_type", "match_reason", "properties")


def candidate_report(owners: DataFrame, scraped: DataFrame) -> DataFrame:
    """Of owners without a number whose name is a scraped company's search name, name or previous name: matches, companies
    and titles by kind of match and company status. An OR of names would be a nested-loop join: they are rows here.

    Titles and companies of a name are counted by themselves and multiplied, and never joined with each other."""
    names = F.array_distinct(F.concat(F.array("search_name", "company_name"), F.coalesce("previous_names", F.array().cast("array<string>"))))
    old = F.coalesce(F.array_contains("previous_names", F.col("_name")), F.lit(False))
    kind = F.when(F.col("_name") == F.col("company_name"), "exact_match").when(old, "previous_name_match").otherwise("search_name_match")
    known = scraped.withColumn("_name", F.explode(names)).where("_name is not null").select("_name", *SCRAPED, kind.alias("match_type")).distinct()
    open_ = owners.where(F.col("company_reg_no").isNull()).select("title_number", "proprietor_name").distinct()
    group = ["match_type", "company_status"]
    titles = open_.groupBy("proprietor_name").agg(F.count("*").alias("_titles"))
    pairs = known.join(titles, F.col("proprietor_name") == F.col("_name"))
    counted = pairs.groupBy(*group).agg(F.sum("_titles").alias("match_count"), F.count_distinct("company_number").alias("unique_companies"))
    # A name has few combinations of kind and status; they come with a title as one list.
    kinds = known.groupBy("_name").agg(F.collect_set(F.struct(*group)).alias("_kinds"))
    hit = open_.join(kinds, F.col("proprietor_name") == F.col("_name")).select("title_number", F.explode("_kinds").alias("_kind")).distinct()
    properties = hit.where("title_number is not null").groupBy(*[F.col(f"_kind.{c}").alias(f"_{c}") for c in group]).agg(F.count("*").alias("_properties"))
    same = F.col("match_type").eqNullSafe(F.col("_match_type")) & F.col("company_status").eqNullSafe(F.col("_company_status"))
    return counted.join(properties, same, "left").select(*group, "match_count", "unique_companies", F.coalesce("_properties", F.lit(0)).alias("unique_properties"))


def unmatched(matched: DataFrame, kind: str = "Land_Registry") -> DataFrame:
    """Distinct names left for a search, with their numbers of titles and a registration number."""
    return matched.where(F.col("match_type") == kind).groupBy(F.upper(text.strip(F.col("proprietor_name"))).alias("search_name")).agg(
        F.max("company_reg_no").alias("company_reg_no"), F.count_distinct("title_number").alias("properties")
    )
