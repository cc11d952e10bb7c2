"""Company pages: facts out of (possibly bz2-compressed) HTML, as pandas UDFs on the standard library's parser."""

from __future__ import annotations

import bz2
import codecs
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F

#: Bytes decoded at once.
STEP = 1 << 16
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class Node:
    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def text(self) -> str:
        """All text inside, white space collapsed."""
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            else:
                todo += reversed(x.children)
        return " ".join("".join(out).split())

    def own_text(self) -> str:
        return " ".join("".join(c for c in self.children if isinstance(c, str)).split())

    def walk(self):
        todo = [self]
        while todo:
            x = todo.pop()
            yield x
            todo += [c for c in reversed(x.children) if isinstance(c, Node)]

    def find(self, tag: str, id_part: str = "", text: str = "") -> list[Node]:
        return [n for n in self.walk() if n.tag == tag and id_part in n.attrs.get("id", "") and text.lower() in n.text().lower()]

    def following(self, tag: str) -> Node | None:
        """The next sibling of that tag."""
        kin = [c for c in self.parent.children if isinstance(c, Node)] if self.parent else []
        rest = kin[kin.index(self) + 1 :] if self in kin else []
        return next((n for n in rest if n.tag == tag), None)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_endtag(self, tag):
        x = self.at
        while x.parent and x.tag != tag:
            x = x.parent
        if x.parent:
            self.at = x.parent

    def handle_data(self, data):
        self.at.children.append(data)


def texts(page: bytes | str | None) -> Iterator[str]:
    """A page's text in pieces; bytes may be bz2, in one stream or several, and are decoded as they are read. What isn't
    bz2 is taken as it is; a stream that breaks off gives what came before."""
    if page is None or isinstance(page, str):
        yield page or ""
        return
    raw, utf8, squeezed = bytes(page), codecs.getincrementaldecoder("utf-8")("replace"), False
    if raw[:3] == b"BZh":
        stream = bz2.BZ2Decompressor()
        try:
            data = stream.decompress(raw, STEP)
            while data or not stream.eof:
                squeezed = True
                yield utf8.decode(data)
                if stream.eof and stream.unused_data[:3] == b"BZh":
                    rest, stream = stream.unused_data, bz2.BZ2Decompressor()
                    data = stream.decompress(rest, STEP)
                elif stream.eof or stream.needs_input:
                    break
                else:
                    data = stream.decompress(b"", STEP)
            squeezed = True
        except (OSError, ValueError):
            pass
    yield utf8.decode(b"" if squeezed else raw, True)


def tree(page: bytes | str | None) -> Node:
    """The page's tree; bytes may be compressed. What can't be read is an empty page."""
    builder = _Builder()
    for text in texts(page):
        builder.feed(text)
    builder.close()
    return builder.root


def pairs(root: Node) -> dict[str, str]:
    """dt texts (lower case, without nested tags such as status marks) to dd texts."""
    out = {}
    for dt in root.find("dt"):
        kin = [c for c in dt.parent.children if isinstance(c, Node)]
        after = kin[kin.index(dt) + 1 : kin.index(dt) + 2]
        if after and after[0].tag == "dd":
            out[dt.own_text().lower()] = after[0].text()
    return out


def _due(root: Node, heading: str) -> str | None:
    for h in root.find("h2", text=heading):
        p = h.following("p")
        m = re.search(r"due by\s*(\d{1,2}\s+\w+\s+\d{4})", p.text(), re.I) if p else None
        if m:
            return m[1]
    return None


def overview(page) -> dict:
    root = tree(page)
    by = pairs(root)
    sic = [m[1] for h in root.find("h2", text="Nature of business")[:1] if (ul := h.following("ul")) for li in ul.find("li") if (m := re.match(r"(\d+)", li.text()))]
    old = [cells[0].text() for h in root.find("h2", text="Previous company names")[:1] if (t := h.following("table")) for tr in t.find("tr")[1:] if (cells := tr.find("td")) and cells[0].text()]
    return {
        "company_status": by.get("company status", by.get("status")),
        "company_type": by.get("company type", by.get("type")),
        "incorporated_on": by.get("incorporated on", by.get("incorporated")),
        "registered_address": by.get("registered office address"),
        "accounts_due": _due(root, "Accounts"),
        "statement_due": _due(root, "Confirmation statement"),
        "sic_codes": sic,
        "previous_names": old,
    }


def officer(page) -> dict:
    root = tree(page)
    by = pairs(root)
    name = next((n.text() for n in root.find("span", "officer-name")), None)
    born = by.get("date of birth")
    year = re.search(r"\d{4}", born)[0] if born and re.search(r"\d{4}", born) else None
    return {
        "name": name, "status": next((n.text() for n in root.find("span", "officer-status-tag")), None), "role": by.get("role"), "appointed_on": by.get("appointed on"), "resigned_on": by.get("resigned on"),
        "address": by.get("correspondence address"), "nationality": by.get("nationality"), "country_of_residence": by.get("country of residence"), "occupation": by.get("occupation"), "birth_year": int(year) if year else None,
    }


def charge(page) -> dict:
    root = tree(page)
    first = lambda tag, part: next((n.text() for n in root.find(tag, part)), None)
    state = first("dd", "mortgage-status")
    met = re.search(r"on\s+(\d+\s+\w+\s+\d{4})", state) if state and "Satisfied" in state else None
    code = next((m[1] for h in root.find("h2") if (m := re.search(r"Charge code\s+(.+)", h.text()))), None)
    people = [li.text() for ul in root.find("ul", "persons-entitled") for li in ul.find("li")] or [li.text() for li in root.find("li", "persons-entitled")]
    words = first("p", "mortgage-particulars") or first("span", "mortgage-particulars")
    whole = root.text().lower()
    return {
        "code": code, "status": "Satisfied" if state and "Satisfied" in state else state, "created_on": first("dd", "mortgage-created-on"), "delivered_on": first("dd", "mortgage-delivered-on"),
        "satisfied_on": met[1] if met else first("dd", "mortgage-satisfied-on"), "persons_entitled": people, "description": words,
        "negative_pledge": "negative pledge" in whole, "floating_charge": "floating charge" in whole, "fixed_charge": "fixed charge" in whole,
    }


def charges(page) -> list[dict]:
    """The charges of a list page, one for each block (a div whose class begins with mortgage-), in its order."""
    out = []
    for block in (n for n in tree(page).find("div") if n.attrs.get("class", "").startswith("mortgage-")):
        first = lambda tag, part, block=block: next((n.text() for n in block.find(tag, part)), None)
        code = next((m[1].strip() for h in block.find("h2") for a in h.find("a")[:1] if (m := re.search(r"Charge code\s+(.+)", a.text()))), None)
        people = [n.text() for n in block.find("li", "persons-entitled")]
        out.append({
            "code": code, "status": first("dd", "mortgage-status"), "created_on": first("dd", "mortgage-created-on"), "delivered_on": first("dd", "mortgage-delivered-on"),
            "satisfied_on": first("dd", "mortgage-satisfied-on"), "persons_entitled": people or None, "description": first("p", "mortgage-particulars"),
        })
    return out


OVERVIEW = "company_status string, company_type string, incorporated_on string, registered_address string, accounts_due string, statement_due string, sic_codes array<string>, previous_names array<string>"
OFFICER = "name string, status string, role string, appointed_on string, resigned_on string, address string, nationality string, country_of_residence string, occupation string, birth_year int"
CHARGE = "code string, status string, created_on string, delivered_on string, satisfied_on string, persons_entitled array<string>, description string, negative_pledge boolean, floating_charge boolean, fixed_charge boolean"


def _udf(parse, schema: str):
    names = [c.split()[0] for c in schema.split(", ")]

    @F.pandas_udf(schema)
    def run(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse(p) for p in pages], columns=names)

    return run


def overview_of(page):
    return _udf(overview, OVERVIEW)(page)


def officer_of(page):
    return _udf(officer, OFFICER)(page)


def charge_of(page):
    return _udf(charge, CHARGE)(page)


def _links(page) -> dict:
    root = tree(page)
    title = next((n.text() for n in root.find("title")), None)
    return {"title": title, "headings": [n.text() for n in root.walk() if n.tag in ("h1", "h2")], "links": [n.attrs["href"] for n in root.find("a") if n.attrs.get("href")]}


def page_facts(page):
    """Title, headings and link targets of any page."""
    return _udf(_links, "title string, headings array<string>, links array<string>")(page)
