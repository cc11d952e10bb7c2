"""Company pages made of the supplier table, compressed and parsed; the oracles compute the facts from the same columns."""

from __future__ import annotations

import bz2

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..catalog import query, table
from ..sources import pages
from .timelines import text_dates

STATUS = "CASE WHEN s_acctbal < 0 THEN 'Dissolved' ELSE 'Active' END"
TYPE = "CASE WHEN s_suppkey % 3 = 0 THEN 'Public & limited' ELSE 'Private limited company' END"
BORN = "CAST('1985-01-01' AS DATE) + CAST(s_suppkey AS INT) * 20"
DUE = "CAST('2024-01-31' AS DATE) + CAST(s_suppkey AS INT)"
NUMBER = "lpad(CAST(s_suppkey AS STRING), 8, '0')"
#: Charges of a company: none to four.
CHARGES = "CAST(s_suppkey % 5 AS INT)"


@F.pandas_udf(BinaryType())
def compressed(text: pd.Series) -> pd.Series:
    """Pages as they are stored: bz2 in two streams, and every fourth as it is."""
    return pd.Series([None if t is None else t.encode() if len(t) % 4 == 0 else bz2.compress(t[: len(t) // 3].encode()) + bz2.compress(t[len(t) // 3 :].encode()) for t in text])


def _long(day: str) -> str:
    return f"date_format({day}, 'd MMMM yyyy')"


OVERVIEW = f"""concat('<html><body><dl><dt>Company status</dt><dd> ', {STATUS}, '</dd><dt>Company type</dt><dd>', replace({TYPE}, '&', '&amp;'), '</dd><dt>Incorporated on</dt><dd>', {_long(BORN)},
 '</dd><dt>Registered office address</dt><dd>', s_name, ' <br>\n House,   ', CAST(s_nationkey AS STRING), ' Zoë Road</dd></dl><h2>Accounts</h2><p>Next accounts due by <strong>', {_long(DUE)}, '</strong></p>',
 CASE WHEN s_suppkey % 2 = 0 THEN concat('<h2>Confirmation statement</h2><div>x</div><p>Next statement due by ', {_long(DUE)}, '</p>') ELSE '' END,
 '<h2>Nature of business (SIC)</h2><ul>', CASE WHEN s_suppkey % 4 > 0 THEN concat('<li>', lpad(CAST(s_suppkey AS STRING), 5, '0'), ' - Growing</li><li> 62020 - Advice</li>') ELSE '<li>None</li>' END, '</ul>',
 CASE WHEN s_suppkey % 3 > 0 THEN concat('<h2>Previous company names</h2><table><tr><th>Name</th></tr><tr><td>OLD ', s_name, '</td><td>1 May 1999</td></tr><tr><td></td></tr><tr><td>OLDER</td></tr></table>') ELSE '' END, '</body></html>')"""


def stored(spark, d, page: str):
    """company_number, page (bytes); every eleventh company has none."""
    rows = table(spark, d, "supplier").select("*", F.expr(NUMBER).alias("company_number"), F.when(F.col("s_suppkey") % 11 > 0, F.expr(page)).alias("_text"))
    return rows.select("company_number", compressed("_text").alias("page"))


_IF = "CASE WHEN s_suppkey % 11 > 0 THEN {0} END"
_SQL_NUMBER = "lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS company_number"


@query("company_pages", f"""SELECT {_SQL_NUMBER}, {_IF.format(STATUS)} AS company_status, {_IF.format(TYPE)} AS company_type, CAST({_IF.format(BORN)} AS VARCHAR) AS incorporated_on,
 {_IF.format("s_name || ' House, ' || s_nationkey || ' Zoë Road'")} AS registered_address, CAST({_IF.format(DUE)} AS VARCHAR) AS accounts_due, CAST(CASE WHEN s_suppkey % 2 = 0 THEN {_IF.format(DUE)} END AS VARCHAR) AS statement_due,
 CASE WHEN s_suppkey % 4 > 0 AND s_suppkey % 11 > 0 THEN lpad(CAST(s_suppkey AS VARCHAR), 5, '0') || ',62020' ELSE '' END AS sic_codes, CASE WHEN s_suppkey % 3 > 0 AND s_suppkey % 11 > 0 THEN 'OLD ' || s_name || ',OLDER' ELSE '' END AS previous_names FROM supplier""")
def company_pages(spark, d):
    out = pages.overviews(stored(spark, d, OVERVIEW))
    return text_dates(out.withColumns({c: F.array_join(c, ",") for c in ("sic_codes", "previous_names")}))


def _described(i: str) -> str:
    return f"CASE ({i} + s_suppkey) % 4 WHEN 0 THEN 'A Fixed Charge over land and a floating charge' WHEN 1 THEN 'Floating charge' WHEN 2 THEN 'fixed and floating security' ELSE 'All monies' END"


def _block(i: str) -> str:
    return f"""concat('<div class="mortgage-', CAST({i} AS STRING), '"><h2><a href="#">Charge code ', {NUMBER}, ' ', lpad(CAST({i} AS STRING), 4, '0'), '</a></h2><dl><dd id="mortgage-status-', CAST({i} AS STRING), '"> ', CASE WHEN {i} % 2 = 0 THEN 'Satisfied' ELSE 'Outstanding' END,
 ' </dd><dd id="mortgage-created-on-1">', date_format({BORN} + CAST({i} AS INT), 'd MMMM yyyy'), '</dd><dd id="mortgage-delivered-on-1">not known</dd>', CASE WHEN {i} % 2 = 0 THEN concat('<dd id="mortgage-satisfied-on-1">', date_format({DUE}, 'd MMMM yyyy'), '</dd>') ELSE '' END,
 '</dl><ul><li id="persons-entitled-1">Bank ', CAST({i} AS STRING), '</li>', CASE WHEN {i} > 2 THEN '<li id="persons-entitled-2">Crown &amp; Co</li>' ELSE '' END, '</ul><p id="mortgage-particulars-1">', {_described(i)}, '</p></div>')"""


CHARGE_LIST = f"""concat('<html><h1>Charges</h1><div class="other">x</div>', array_join(transform(filter(sequence(0, {CHARGES}), i -> i > 0), i -> {_block('i')}), ''), '</html>')"""


@query("charge_lists", f"""SELECT {_SQL_NUMBER}, lpad(CAST(s_suppkey AS VARCHAR), 8, '0') || '_charge_' || i AS charge_id, CASE (i + s_suppkey) % 4 WHEN 0 THEN 'Fixed charge' WHEN 1 THEN 'Floating charge' WHEN 2 THEN 'Fixed and floating charge' END AS charge_type,
 lpad(CAST(s_suppkey AS VARCHAR), 8, '0') || ' ' || lpad(CAST(i AS VARCHAR), 4, '0') AS code, CASE WHEN i % 2 = 0 THEN 'Satisfied' ELSE 'Outstanding' END AS status, CAST({BORN} + CAST(i AS INT) AS VARCHAR) AS created_on, CAST(NULL AS VARCHAR) AS delivered_on,
 CAST(CASE WHEN i % 2 = 0 THEN {DUE} END AS VARCHAR) AS satisfied_on, 'Bank ' || i || CASE WHEN i > 2 THEN '|Crown & Co' ELSE '' END AS persons_entitled, {_described('i')} AS description
 FROM (SELECT *, unnest(range(1, s_suppkey % 5 + 1)) AS i FROM supplier WHERE s_suppkey % 11 > 0)""")
def charge_lists(spark, d):
    return text_dates(pages.charge_lists(stored(spark, d, CHARGE_LIST)).withColumn("persons_entitled", F.array_join("persons_entitled", "|")))


DETAIL = f"""concat('<h2>Charge code ', {NUMBER}, ' 0001</h2><dl><dd id="mortgage-status">', CASE WHEN s_suppkey % 2 = 0 THEN concat('Fully Satisfied on ', {_long(DUE)}) ELSE 'Outstanding' END, '</dd><dd id="mortgage-created-on">', {_long(BORN)}, '</dd></dl><ul id="persons-entitled"><li>A Bank</li><li> ', s_name, '</li></ul><p id="mortgage-particulars">', {_described('0')}, CASE WHEN s_suppkey % 3 = 0 THEN '. Contains negative pledge.' ELSE '' END, '</p>')"""


@query("charge_details", f"""SELECT {_SQL_NUMBER}, {_IF.format("lpad(CAST(s_suppkey AS VARCHAR), 8, '0') || ' 0001'")} AS code, {_IF.format("CASE WHEN s_suppkey % 2 = 0 THEN 'Satisfied' ELSE 'Outstanding' END")} AS status, CAST({_IF.format(BORN)} AS VARCHAR) AS created_on,
 CAST(CASE WHEN s_suppkey % 2 = 0 THEN {_IF.format(DUE)} END AS VARCHAR) AS satisfied_on, CASE WHEN s_suppkey % 11 > 0 THEN 'A Bank|' || s_name ELSE '' END AS persons_entitled, s_suppkey % 11 > 0 AND s_suppkey % 3 = 0 AS negative_pledge,
 s_suppkey % 11 > 0 AND s_suppkey % 4 IN (0, 1) AS floating_charge, s_suppkey % 11 > 0 AND s_suppkey % 4 = 0 AS fixed_charge FROM supplier""")
def charge_details(spark, d):
    out = pages.charge_details(stored(spark, d, DETAIL)).withColumn("persons_entitled", F.array_join("persons_entitled", "|"))
    return text_dates(out.select("company_number", "code", "status", "created_on", "satisfied_on", "persons_entitled", "negative_pledge", "floating_charge", "fixed_charge"))
