"""Tier, quality, band and class labels. The lists are fixed values, first fit wins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import present

#: Confidence of each match type.
CONFIDENCE = {"Name+Number": 1.0, "Number": 0.9, "Scraped": 0.8, "Name": 0.7, "Previous_Name": 0.5, "Land_Registry": 0.3, "Not_Company": 0.0, "No_Match": 0.0}
QUALITY = {"Name+Number": "Excellent", "Number": "Very Good", "Name": "Good", "Previous_Name": "Fair", "No_Match": "No Match"}
CONFIDENCE_LABELS = (
    (1.0, "Perfect Match - Company Number & Name"), (0.9, "High Confidence - Company Number Only"), (0.7, "Medium Confidence - Name Match"),
    (0.5, "Low Confidence - Previous Name"), (0.3, "Land Registry Data Only"),
)
CONFIDENCE_GRADES = ((0.9, "High"), (0.7, "Good"), (0.5, "Medium"), (0.3, "Poor"))
#: Categories that count as companies.
COMPANY_CATEGORIES = ("Limited Company or Public Limited Company", "Limited Liability Partnership")
CHANGES = {"reference": ({"A": "Added", "D": "Deleted", "M": "Modified"}, "Unchanged"), "updated": ({"A": "Added", "D": "Deleted", "U": "Updated"}, "No Change"), "short": ({"A": "Added", "D": "Deleted"}, "No Change")}
PRICE_BANDS = ((250_000, "1. Under £250k"), (500_000, "2. £250k-£500k"), (1_000_000, "3. £500k-£1m"), (5_000_000, "4. £1m-£5m"))
PORTFOLIO_BANDS = ((1, "1. Single Property"), (5, "2. 2-5 Properties"), (10, "3. 6-10 Properties"), (50, "4. 11-50 Properties"), (100, "5. 51-100 Properties"))
NUMBER_CLASSES = (("^RS", "RS - Registered Society"), ("^IP", "IP - Industrial & Provident"), ("^RP", "RP - Royal Patent"), ("^NI", "NI - Northern Ireland"), ("^SC", "SC - Scotland"), ("^0+$", "Zero-filled"), ("^[0-9]+$", "Standard UK Number"))
OVERSEAS_CLASSES = (("^FC", "FC - Foreign Company"), ("^OE", "OE - Overseas Entity"), ("^OC", "OC - Overseas Company"), ("^BR", "BR - Branch"), ("^NF", "NF - Northern Ireland Foreign"), ("^SF", "SF - Scottish Foreign"), ("^[0-9]", "UK - Standard UK Company"), ("^SC", "SC - Scottish Company"), ("^NI", "NI - Northern Ireland"), ("^RS", "RS - Registered Society"), ("^IP", "IP - Industrial & Provident"))
OWNER_CLASSES = (
    ("COUNCIL|BOROUGH|AUTHORITY", "Council/Government"), ("NHS", "NHS/Healthcare"), ("TRUST.*HOUSING|HOUSING.*TRUST", "Housing Trust"), ("HOUSING", "Housing Association"), ("HOMES", "Housing/Homes"),
    ("CHURCH|PARISH", "Religious"), ("CHARITY", "Charity"), ("SCHOOL|COLLEGE|UNIVERSITY", "Education"), (r"^(?!.*LIMITED)[A-Z][A-Z\s\-']+$", "Possible Individual"), ("LIMITED|LTD|PLC", "UK Company"),
)
PSC_KINDS = (("individual", "individual"), ("corporate-entity", "corporate-entity"), ("legal-person", "legal-person"))
CHARGE_KINDS = (("fixed charge", "Fixed charge"), ("floating charge", "Floating charge"), ("fixed and floating", "Fixed and floating charge"))


def _ladder(steps, rest=None) -> Column:
    """when(condition, label) for each step, in order."""
    first, *others = steps
    out = reduce(lambda c, s: c.when(*s), others, F.when(*first))
    return out if rest is None else out.otherwise(rest)


def match_quality(kind: Column, null_is_no_match: bool = True) -> Column:
    """Words for a match type; types outside the list are Unknown."""
    steps = [(kind == k, v) for k, v in QUALITY.items()]
    return _ladder(steps + ([(kind.isNull(), "No Match")] if null_is_no_match else []), "Unknown")


def confidence_label(c: Column) -> Column:
    return _ladder([(c >= low, name) for low, name in CONFIDENCE_LABELS], "No Match")


def confidence_grade(c: Column) -> Column:
    return _ladder([(c >= low, name) for low, name in CONFIDENCE_GRADES], "No Match")


def confidence_bucket(c: Column) -> Column:
    return _ladder([(c >= 0.9, "high"), (c >= 0.7, "medium"), (c > 0, "low")], "none")


def change_label(c: Column, style: str = "reference") -> Column:
    names, rest = CHANGES[style]
    return _ladder([(c == k, v) for k, v in names.items()], rest)


def owner_origin(dataset: Column) -> Column:
    return _ladder([(dataset == "OCOD", "OVERSEAS COMPANY"), (dataset == "CCOD", "UK COMPANY")], "OTHER")


def price_band(price: Column) -> Column:
    return _ladder([(price.isNull(), "0. No Price"), *[(price < top, name) for top, name in PRICE_BANDS]], "5. Over £5m")


def portfolio_band(n: Column) -> Column:
    return _ladder([(n <= top, name) for top, name in PORTFOLIO_BANDS], "6. Over 100 Properties")


def number_class(c: Column) -> Column:
    return _ladder([(c.rlike(p), name) for p, name in NUMBER_CLASSES], "Other Format")


def register_class(c: Column) -> Column:
    return _ladder([(c.rlike(p), name) for p, name in OVERSEAS_CLASSES], "Other")


def owner_class(c: Column) -> Column:
    return _ladder([(c.rlike(p), name) for p, name in OWNER_CLASSES], "Other")


def psc_kind(c: Column) -> Column:
    return _ladder([(c.contains(p), name) for p, name in PSC_KINDS], "other")


def charge_kind(description: Column) -> Column:
    return _ladder([(F.lower(description).contains(p), name) for p, name in CHARGE_KINDS])


def company_owner(name: Column, category: Column) -> Column:
    return present(name) & category.isin(*COMPANY_CATEGORIES)
