"""Personal data against the plain patterns, applied one match after the other."""

import re

import pytest

from hearthrate.llm.private import find_private

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def keep(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
        "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def plain(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if keep(k, m[0])]


TRICKY = [
    "a@b.c-d_e@f.g x..y@z.de. @a.b a@b a@b..c é.x@y.zü 🎉q@w.er", "1.2.3.4.5.6.7.8 256.1.1.1 1.256.0.0 0300.1.1.1 007.008.009.010 1.1.1.255",
    "4539 1488 0343 6467 x 4539148803436467-1 4539-1488-0343-6467 45391488034364670 1 2 3", "4539148803436467  4539148803436467", "5-4539148803436467",
    "+1 (743) 555-3824, +49 30 1234567 +12345678 ++1234567890 +1234567890123456 +1 ((((-", "", None, " ", "+", "@", "9" * 5000, "1 " * 4000, "a" * 20000 + "@x.y",
    "IBAN DE89370400440532013000 and GB82WEST12345698765432, DE89370400440532013001", "SSN: 123-45-6789 but 123-45-6780 not", "my ssn 000-12-3456",
]


def spans(df):
    return {r.doc_id: [(s.kind, s.start, s.end) for s in r.private] for r in df.select("doc_id", "private").collect()}


def test_base_spans_are_those_of_the_plain_patterns(docs_of):
    got = spans(find_private(docs_of(enumerate(TRICKY))))
    for i, text in enumerate(TRICKY):
        assert [s for s in got[i] if s[0] in PLAIN] == plain(text), text


def test_real_texts(documents):
    rows = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    got = spans(find_private(documents))
    assert got.keys() == rows.keys()
    assert all([s for s in got[i] if s[0] in PLAIN] == plain(t) for i, t in rows.items())
    assert sum(map(len, got.values())) > 0


def test_added_spans_need_checksum_and_context(docs_of):
    got = spans(find_private(docs_of(enumerate(TRICKY))))
    texts = [[TRICKY[i][a:b] for k, a, b in got[i] if k in ("iban", "ssn")] for i in (14, 15, 16)]
    assert texts == [["DE89370400440532013000", "GB82WEST12345698765432"], ["123-45-6789", "123-45-6780"], []]
    assert spans(find_private(docs_of([(0, "code 123-45-6789")]))) == {0: []}


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, "a@b.cd"), (1, "a@b.cd")]])
def test_edges(docs_of, rows):
    out = find_private(docs_of(rows).selectExpr("*", "1 AS private", "2 AS kind"))
    assert sorted(out.columns) == ["doc_id", "kind", "private", "text"]
    assert out.count() == len(rows)
