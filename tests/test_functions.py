"""Expression vectors, and properties against plain Python."""

import re
from datetime import date, timedelta
import random

import pytest
from pyspark.sql import functions as F

from deedflow.functions import dates, html, labels, text

NAMES = {
    "TENSATOR LIMITED": "TENSATOR", "TENSATOR LTD": "TENSATOR", "PATHTOP PROPERTY CO LIMITED": "PATHTOPPROPERTY", "HARRY TAYLOR & CO. LIMITED": "HARRYTAYLOR",
    "Circle Thirty Three Housing Trust Limited": "CIRCLETHIRTYTHREEHOUSINGTRUST", "WARBURTONS LIMITED": "WARBURTONS", "ADACTUS HOUSING ASSOCIATION LIMITED": "ADACTUSHOUSINGASSOCIATION",
    "TEST COMPANY PLC": "TEST", "TEST COMPANY LTD.": "TEST", "EXAMPLE LLP": "EXAMPLE", "SAMPLE CO.": "SAMPLE", "TESCO PLC": "TES", "SCOTTISH WIDOWS LIMITED": "S", "COSTA LIMITED": "", None: "", "  ": "", "A AND B AND C LTD": "ABC",
}
NUMBERS = {"178711": "00178711", "00178711": "00178711", "  178711  ": "00178711", "123": "00000123", "SC123456": "SC123456", "NI123456": "NI123456", "000178711": "000178711", "": "", None: "", "1234-567": "01234567", "ip29530r": "IP29530R", "R.S. 12": "RS12", "00000000": "00000000"}


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("v"))).collect()]


def test_name_keys(spark):
    assert column(spark, list(NAMES), text.name_key) == list(NAMES.values())
    strict = ["TESCO PLC", "COSTA LIMITED", "ACME CO", "ACME LTD UK", None]
    assert column(spark, strict, lambda c: text.name_key(c, "strict")) == ["TESCO", "COSTA", "ACME", "ACMELTDUK", ""]
    assert column(spark, ["A.B. & C LTD", "ACME LTD UK"], text.name_key_anchored) == ["ABC", "ACMELTDUK"]
    assert column(spark, ["ACME (UK) CO LTD", "TESCO PLC"], text.name_key_full) == ["ACMEUKCOMPANYLIMITED", "TESCOPUBLICLIMITEDCOMPANY"]
    with pytest.raises(ValueError):
        text.name_key(F.lit("x"), "other")


def test_name_key_against_python(spark):
    rnd = random.Random(1)
    bits = [" AND ", " & ", "LIMITED", "LTD.", " CO", "é", "ß", "½", "Ab", " ", "\n", "-", "9", "PLC "]
    names = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 7))) for _ in range(300)]

    def key(n):
        n = n.upper().strip().replace(" AND ", " ").replace(" & ", " ")
        return "".join(c for c in re.sub(r"\s*" + text.NAME_ENDINGS + r".*$", "", n) if c.isalnum())

    single = [n for n in names if "\n" not in n.strip()]
    assert column(spark, single, text.name_key) == [key(n) for n in single]


def test_numbers(spark):
    assert column(spark, list(NUMBERS), text.number_key) == list(NUMBERS.values())
    assert set(column(spark, ["SC001234"], text.number_spellings)[0]) == {"SC001234", "001234", "00001234", "1234"}


def test_cleaning_and_lists(spark):
    assert column(spark, [" a \t b\n", "", "  ", None, "none"], text.clean) == ["a b", None, None, None, "none"]
    assert column(spark, ["none", " NONE ", "x"], text.clean_none) == [None, None, "x"]
    assert column(spark, ["\x00 a\x00b ", None], text.strip_nul) == ["ab", ""]
    assert column(spark, ["a | b||a|", None], text.split_list) == [["a", "b"], []]
    assert column(spark, ["12345 - X, 123456, 54321; 11111 22222 33333", None], text.sic_codes) == [["12345", "54321", "11111", "22222"], []]
    assert column(spark, ["AB1 2CD", "AB12CD", ""], text.outward_postcode) == ["AB1", "AB12CD", ""]
    assert column(spark, ["at SW1A 1AA, UK", "none"], text.find_postcode) == ["SW1A 1AA", None]


def test_dates(spark):
    assert column(spark, ["03-04-2020", "2020-04-03", "2020-13-01", "", None, "31-02-2020"], dates.snapshot_date) == [date(2020, 4, 3)] * 2 + [None] * 4
    assert column(spark, ["3/4/2020", "2020-4-3", "03-04-2020", "x"], dates.register_date) == [date(2020, 4, 3)] * 3 + [None]
    assert column(spark, ["2020-04-03", "2020-04-03T01:02:03Z", "2020-04-03Z", "3 April 2020"], dates.iso_date) == [date(2020, 4, 3)] * 3 + [None]
    assert column(spark, ["3 April 2020", "3 Apr 2020", "03/04/2020", "April"], dates.scraped_date) == [date(2020, 4, 3)] * 3 + [None]
    assert column(spark, ["20200403", "3 Apr 2020"], dates.any_date) == [date(2020, 4, 3)] * 2


def test_whole_months(spark):
    pairs = [(date(2020, 2, 29), date(2019, 9, 30), 4), (date(2023, 4, 30), date(2022, 12, 31), 3), (date(2025, 2, 28), date(2021, 4, 30), 45), (date(2019, 10, 31), date(2020, 11, 30), -12), (date(2020, 1, 1), date(2020, 1, 1), 0), (None, date(2020, 1, 1), None)]
    rnd = random.Random(2)
    for _ in range(300):
        a, b = (date(2000, 1, 1) + timedelta(rnd.randint(0, 9000)) for _ in range(2))
        hi, lo = max(a, b), min(a, b)
        n = (hi.year - lo.year) * 12 + hi.month - lo.month - (hi.day < lo.day)
        pairs.append((a, b, n if a >= b else -n))
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, e date, s date, n int").orderBy("i")
    assert [r[0] for r in rows.select(dates.whole_months(F.col("e"), F.col("s"))).collect()] == [p[2] for p in pairs]


def test_labels(spark):
    assert column(spark, ["Name+Number", "Number", "Name", "Previous_Name", "No_Match", None, "Scraped"], labels.match_quality) == ["Excellent", "Very Good", "Good", "Fair", "No Match", "No Match", "Unknown"]
    assert column(spark, [None], lambda c: labels.match_quality(c, null_is_no_match=False)) == ["Unknown"]
    assert column(spark, [None, 249_999, 250_000, 999_999, 5_000_000], labels.price_band, "long") == ["0. No Price", "1. Under £250k", "2. £250k-£500k", "3. £500k-£1m", "5. Over £5m"]
    assert column(spark, [1, 5, 6, 100, 101], labels.portfolio_band, "long") == ["1. Single Property", "2. 2-5 Properties", "3. 6-10 Properties", "5. 51-100 Properties", "6. Over 100 Properties"]
    assert column(spark, ["0000", "12", "SC1", "RS9", "X"], labels.number_class) == ["Zero-filled", "Standard UK Number", "SC - Scotland", "RS - Registered Society", "Other Format"]
    assert column(spark, ["HOUSING TRUST", "TRUST OF HOUSING", "O'BRIEN", "ACME LTD 1", "7"], labels.owner_class) == ["Housing Trust", "Housing Trust", "Possible Individual", "UK Company", "Other"]
    assert column(spark, ["individual-person", "corporate-entity-x", "legal-person-y", "z", None], labels.psc_kind) == ["individual", "corporate-entity", "legal-person", "other", "other"]
    assert column(spark, ["a Fixed Charge over", "floating charge", "fixed and floating charge", "fixed and floating", "none"], labels.charge_kind) == ["Fixed charge", "Floating charge", "Floating charge", "Fixed and floating charge", None]
    assert column(spark, ["A", "D", "M", None], labels.change_label) == ["Added", "Deleted", "Modified", "Unchanged"]


OFFICER = """<div class="x"><h2><span id="officer-name-4"><a href="/o/1">DOE, Jane Q</a></span></h2><dl><dt id="officer-address-field-4">Correspondence address</dt>
<dd>\n1 Any Street, Town </dd></dl><dl><dt>Role <span id="officer-status-tag-4">Resigned</span></dt><dd id="officer-role-4">\n Secretary </dd></dl>
<dl><dt>Appointed on</dt><dd>7 May 2013</dd></dl><dl><dt>Resigned on</dt><dd> 27 November\n 2013</dd></dl></div>"""
OVERVIEW = """<dl><dt>Company status</dt><dd>Active</dd><dt>Company type</dt><dd>Private limited</dd><dt>Incorporated on</dt><dd>1 May 2001</dd><dt>Registered office address</dt><dd>1 High St</dd></dl>
<div><h2><strong>Accounts</strong></h2><p>Next accounts due by 31 March 2026</p></div><div><h2>Nature of business (SIC)</h2><ul><li>01110 - Growing</li><li>62020 - IT</li></ul></div>
<div><h2>Previous company names</h2><table><tr><th>Name</th></tr><tr><td>OLD LTD</td><td>x</td></tr></table></div>"""
CHARGE = """<h2><a>Charge code 0123 4567 0001</a></h2><dl><dt>Status</dt><dd id="mortgage-status-1">Satisfied on 3 May 2020</dd><dd id="mortgage-created-on-1">1 May 2010</dd></dl>
<ul id="persons-entitled"><li> A Bank </li><li>B Bank</li></ul><p id="mortgage-particulars-1">Fixed charge over land. Contains negative pledge.</p>"""


def test_html(spark):
    import bz2

    rows = spark.createDataFrame([(0, bytearray(bz2.compress(OFFICER.encode()))), (1, bytearray(OFFICER.encode())), (2, None)], "i int, page binary")
    got = rows.orderBy("i").select(html.officer_of(F.col("page")).alias("o")).select("o.*").collect()
    assert got[0] == got[1] and (got[0].name, got[0].status, got[0].role, got[0].appointed_on, got[0].resigned_on, got[0].address) == ("DOE, Jane Q", "Resigned", "Secretary", "7 May 2013", "27 November 2013", "1 Any Street, Town")
    assert got[2].name is None
    o = html.overview(OVERVIEW)
    assert (o["company_status"], o["incorporated_on"], o["accounts_due"], o["statement_due"], o["sic_codes"], o["previous_names"]) == ("Active", "1 May 2001", "31 March 2026", None, ["01110", "62020"], ["OLD LTD"])
    c = html.charge(CHARGE)
    assert (c["code"], c["status"], c["satisfied_on"], c["persons_entitled"], c["negative_pledge"], c["fixed_charge"], c["floating_charge"]) == ("0123 4567 0001", "Satisfied", "3 May 2020", ["A Bank", "B Bank"], True, True, False)
