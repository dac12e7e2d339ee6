"""Secrets against the plain patterns; automata against hand-made formats."""

import random
import re

import pytest

from hearthrate.llm.automata import Automaton
from hearthrate.llm.secrets import Candidates, Formats, all_spans, find_secrets, infer_formats, labelled, redact

ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
HEX = "7695f98391c04c2f5d7695f98391c04c2f5d"


def plain(text):
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(k, a, b) for a, _, k, b in sorted(out)]


TEXTS = [
    f"token = \"{HEX}\" x", "PassWord: abcdefg1 apikey=12345678 API_KEY : '12345678'", "toKen: a secret=abcdefghij", "AKIAAKIA AKIAAKIA1234567890 AKIA12345678901",
    "é🎉 password=pässword1 secret='x.y-z+/=_'", None, "", "f" * 31 + " " + "f" * 32 + "g" + "0" * 40, "a" * 50000, "token" * 3000, "toſen=abcdefghijk",
]


def spans(df):
    return {r.doc_id: [(s.kind, s.start, s.end) for s in r.secrets] for r in df.collect()}


def test_pattern_spans(docs_of, documents):
    got = spans(find_secrets(docs_of(enumerate(TEXTS))))
    for i, text in enumerate(TEXTS):
        assert [s for s in got[i] if s[0] != "format"] == plain(text)
    rows = {r.doc_id: r.text for r in documents.collect()}
    got = spans(find_secrets(documents))
    assert {i: [s for s in v if s[0] != "format"] for i, v in got.items()} == {i: plain(t) for i, t in rows.items()}
    assert got.keys() == rows.keys()


def test_automata_learn_a_format():
    draw = random.Random(7)
    keys = ["key-" + "".join(draw.choices("0123456789", k=16)) for _ in range(200)]
    learned = Automaton(keys)
    assert len(learned.states) < 60
    assert learned.fit("key-9081726354091827") > 1.2
    assert learned.fit("thequickbrownfoxjumps") < 0
    assert learned.fit("") == 0.0


def test_inferred_spans():
    draw = random.Random(3)
    formats = {"hex": Automaton(["".join(draw.choices("0123456789abcdef", k=40)) for _ in range(200)])}
    text = "so 0a1b2c3d4e5f60718293 and internationalisation2you or token=0a1b2c3d4e5f60718293"
    assert [(k, text[a:b]) for k, a, b, _ in all_spans(text, formats)] == [("format", "0a1b2c3d4e5f60718293"), ("assign", "token=0a1b2c3d4e5f60718293")]


def test_short_dotted_and_long_candidates():
    draw = random.Random(5)
    formats = {"assign": Automaton(["sk.live." + "".join(draw.choices("0123456789", k=8)) for _ in range(200)])}
    long = "sk.live." + ("1" * 30 + "+") * 25 + "z" * 5000
    text = f"see sk.live.2718. or {long} or sk.live internationalisation"
    assert [(text[a:b], k) for k, a, b, _ in all_spans(text, formats)] == [("sk.live.2718", "format")]
    assert formats["assign"].fit(long) < 0 < formats["assign"].fit(long[:512])


def test_formats_learn_from_whole_values():
    draw = random.Random(8)
    tail = Automaton(["a" * 60 + "-" + "".join(draw.choices("01", k=20)) for _ in range(200)])
    assert tail.fit("a" * 60 + "-" + "01" * 10) > tail.fit("a" * 60 + "-" + "xy" * 10) + 0.5


def test_ordinary_text_is_no_format(docs_of):
    # Passwords made of words: the words themselves stay, in all lengths and cases of the text.
    words = ["window", "garden", "yellow", "mountain", "teacher", "evening", "kitchen", "station"]
    draw = random.Random(1)
    rows = [(i, " ".join(draw.choices(words, k=60)) + f" password={draw.choice(words)}{draw.choice(words)}") for i in range(60)]
    rows += [(100, "mountainevening gardenkitchen teacherstation"), (101, None)]
    formats = infer_formats(labelled(docs_of(rows)))
    assert isinstance(formats, Formats) and set(formats.automata) == {"assign"}
    got = spans(find_secrets(docs_of(rows), formats=formats))
    assert all(k == "assign" for found in got.values() for k, _, _ in found)
    assert got[100] == [] and got[101] == []


def test_pairs_of_characters_count_all_texts(docs_of):
    rows = [(0, "abé token=abababab"), (1, None), (2, "")]
    counted = {r.value: r.n for r in labelled(docs_of(rows).repartition(3)).where("kind = 'pair'").groupBy("value").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert counted["ab"] == 5 and counted["ba"] == 3 and counted[" t"] == 1 and counted["b\0"] == 1
    pairs = infer_formats(labelled(docs_of(rows))).candidates.pairs
    own = [ord(c) for c in Candidates.symbols]
    assert all(abs(sum(2.718281828459045 ** pairs[a][b] for b in own) - 1) < 1e-9 for a in [0, *own])


def test_redaction(docs_of):
    rows = redact(docs_of(enumerate(TEXTS))).collect()
    cleaned = {r.doc_id: r.text for r in rows}
    assert cleaned[0] == "[SECRET]\" x"
    assert cleaned[5] is None and cleaned[6] == "" and cleaned[8] == "[SECRET]"
    assert cleaned[3] == "AKIAAKIA [SECRET] AKIA12345678901"
    assert all(not plain(t) for t in cleaned.values())


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, "token=12345678"), (1, "token=12345678")]])
def test_edges(docs_of, rows):
    out = find_secrets(docs_of(rows).selectExpr("*", "1 AS secrets", "2 AS kind"))
    assert sorted(out.columns) == ["doc_id", "kind", "secrets", "text"]
    assert out.count() == len(rows)
