import random

import pytest

from deedflow.llm import pii
from deedflow.llm.pii import MAPS, Feistel, iban_check, luhn, protect, pseudonymise

KEY = b"a key for tests"
FE = Feistel(KEY)


def swap(kind, value):
    return MAPS[kind](FE, value)


def test_small_sets_are_permuted():
    assert sorted(FE.index(i, 97, "t") for i in range(97)) == list(range(97))
    assert sorted(tuple(FE.mixed([a, b, c], [3, 5, 2], "t")) for a in range(3) for b in range(5) for c in range(2)) == [(a, b, c) for a in range(3) for b in range(5) for c in range(2)]


VALUES = {
    "email": ["a.b+c@mail0.example.com", "x_1@a-b.co.uk"],
    "iban": ["DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819"],
    "ip": ["78.181.149.139", "233.0.0.255"],
    "card": ["4562298812442145"[:15] + str(luhn("456229881244214")), "5105 1051 0510 5100", "3782-822463-10005"],
    "ssn": ["123-45-6789", "899-99-9999", "665-01-0001", "667-01-0001"],
    "phone": ["+1 (935) 555-6637", "+1 (017) 555-7713", "(212) 555-1234", "212-555-1234", "+44 20 7946 0958"],
    "date": ["1999-12-31", "29.02.2000", "01/02/2003"],
}


@pytest.mark.parametrize("kind", pii.KINDS)
def test_values_change_within_their_format_and_come_back(kind):
    for value in VALUES[kind]:
        new, n = pseudonymise(f"see {value}, ok", swap)
        assert n == {kind: 1}, value
        new = new[4:-4]
        assert len(new) == len(value) or kind == "ip"
        assert new != value
        assert pseudonymise(new, swap)[1] == {kind: 1}
        assert MAPS[kind](FE, new, back=True) == value


def test_links_across_layouts_and_documents():
    flat, spaced = swap("card", "5105105105105100"), swap("card", "5105 1051 0510 5100")
    assert spaced.replace(" ", "") == flat
    assert luhn(flat[:-1]) == int(flat[-1])
    assert swap("date", "2001-02-03").split("-") == swap("date", "03.02.2001").split(".")[::-1]
    new = swap("iban", "DE89370400440532013000")
    assert iban_check(new[:2], new[4:]) == new[2:4]


@pytest.mark.parametrize("spaced", ["+353 1 234 5678", "+7 495 123 45 67", "+44 20 7946 0958", "+1 212 555 1234", "+971-4-123-4567", "+33 1 23 45 67 89"])
def test_international_numbers_link_across_layouts(spaced):
    flat = "+" + pii.digits_of(spaced)
    new = swap("phone", spaced)
    assert "+" + pii.digits_of(new) == swap("phone", flat) != flat
    assert MAPS["phone"](FE, new, back=True) == spaced


@pytest.mark.parametrize(
    ("text", "hidden"),
    [("2021-03-04T10:11:12Z", ["2021-03-04"]), ("3/4/1981", ["3/4/1981"]), ("2020-01-01/2020-02-01", ["2020-01-01", "2020-02-01"]), ("10.20.30.40/24", ["10.20.30.40"]), ("10.0.0.1-10.0.0.9", ["10.0.0.1", "10.0.0.9"]),
     ("Tel.212-555-1234", ["212-555-1234"]), ("Tel.+44 20 7946 0958", ["20 7946 0958"]), ("card-4111111111111111", ["4111111111111111"]), ("555 123 4567", ["555 123 4567"]), ("5551234567", ["5551234567"]),
     ("+44 20 7946 0958 2021", ["20 7946 0958"]), ("ES91 2100 0418 4502 0005 1332 IS", ["2100 0418 4502 0005 1332"])],
)
def test_values_in_any_surroundings(text, hidden):
    for around in (text, f"see {text}, ok", f"({text})", f"{text}."):
        new, n = pseudonymise(around, swap)
        assert sum(n.values()) == len(hidden), (around, new)
        assert not any(x in new for x in hidden)


def test_ten_digits_link_across_layouts():
    assert {pii.digits_of(swap("phone", x)) for x in ("5551234567", "555 123 4567", "555-123-4567", "(555) 123-4567")} == {swap("phone", "5551234567")}


@pytest.mark.parametrize("text", ["", "no data", "version 1.2.3", "4562298812442146", "2023-02-30", "999.1.1.1", "000-12-3456", "@", "a@b", "x" * 100_000 + "@", "12345678901234567890123", "é" * 1000, "AB12CD", "1.2.3.4.5"])
def test_clean_texts_stay(text):
    assert pseudonymise(text, swap) == (text, {})


def test_rows(spark):
    rnd = random.Random(3)
    rows = [(1, None, "q"), (2, "", "q"), (3, VALUES["email"][0], None), (3, VALUES["email"][0], None), (None, "x " * 50_000 + VALUES["phone"][0], "z")]
    rows += [(10 + i, " ".join(rnd.choice(VALUES[rnd.choice(pii.KINDS)]) for _ in range(20)), "s") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_email_x string")
    got = protect(docs, KEY).collect()
    assert sorted((str(r.doc_id), r.text or "", r.n_email, r.n_phone) for r in got) == sorted((str(d), (pseudonymise(t, swap)[0] if t else t or ""), *(pseudonymise(t or "", swap)[1].get(k, 0) for k in ("email", "phone"))) for d, t, _ in rows)
    assert protect(docs.limit(0), KEY).collect() == []
    assert protect(docs, KEY, counts=False).columns == docs.columns
    clash = docs.withColumnRenamed("n_email_x", "n_email").withColumn("_n_email", docs.doc_id)
    assert sorted(map(str, protect(clash, KEY).select("text", "n_email").collect())) == sorted(map(str, protect(docs, KEY).select("text", "n_email").collect()))
    assert protect(clash, KEY, counts=False).columns == clash.columns
    with pytest.raises(ValueError, match="secret"):
        protect(docs, b"")


def test_an_address_is_taken_whole():
    new, n = pseudonymise("z" * 70 + "@x.com", swap)
    assert n == {"email": 1} and not new.startswith("zzzz") and new.endswith(".com") and len(new) == 76


def test_lengths_of_ibans_and_area_codes_count():
    body = "3704004405320130"
    short = "DE" + iban_check("DE", body) + body  # right check digits, but a German one has 22 characters
    assert MAPS["iban"](FE, short) is None
    assert pseudonymise("000-000-0000 and 112-555-1234", swap)[1] == {}
