import re

from hypothesis import given, settings
from hypothesis import strategies as st

from panelwright.llm import queries, secrets
from panelwright.sources.tables import read_table

from ..conftest import SF_SMALL
from . import helpers as H

ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def base(text):
    t = text or ""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(t) if len(m.group(2)) >= 8]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(t) if len(m.group()) >= 16]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(t) if len(m.group()) >= 32]
    return sorted(out, key=lambda x: (x[0], secrets.BASE.index(x[2])))


def row(d, t):
    b = base(t)
    n = [sum(k == x[2] for x in b) for k in secrets.BASE]
    return (d, *n, H.sha(",".join(f"{k}:{s}:{e}" for s, e, k in b).encode()))


TEXTS = ["password=short", "password: 'longenough1'", "ApiKey=\"abc=def/ghi\" api_key = tokentoken=xxxxxxxxxx", "tokentoken=12345678",
         "AKIA" + "A" * 12 + " AKIAAKIA" + "B" * 20 + " AKIAx", "a" * 32, "0f" * 40 + "g" + "ab" * 16, "x" + "d" * 31, "é" * 9 + "secret=abcdefgh" + "e" * 64,
         "ſecret=abcdefghij toKen=abcdefghij", "password==========", "f" * 100 + " " + "f" * 31, "\U0001F600 token = \"abcdefgh1\"",
         "PASSWORD = PASSWORD=abcdefgh", "a" * 15 + "z" + "a" * 32]


def test_base_spans_match_plain_patterns():
    for t in [*TEXTS, *(t for _, t in H.EDGE)]:
        assert [s for s in secrets.scan(t) if s[2] in secrets.BASE] == base(t), t


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["token", "=", ": ", "\"", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "deadbeef", "é", " ", "x", "api_key", "Passwd", "=abcdefgh", "\n"]), max_size=25))
def test_random_joins(parts):
    t = "".join(parts)
    assert [s for s in secrets.scan(t) if s[2] in secrets.BASE] == base(t)


def test_checksums():
    body = b"0123456789abcdefghijABCDEFGHIJ"
    good = (b"ghp_" + body + secrets.crc_base62(body)).decode()
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    kinds = lambda t: [k for _, _, k in secrets.scan(t)]
    assert kinds(f"x {good} y") == ["github"] and kinds(f"x {bad} y") == []
    assert kinds("IBAN: GB82WEST12345698765432.") == ["iban"] and kinds("IBAN GB83WEST12345698765432") == []


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").collect()]
    got = queries.op9_secrets(spark, SF_SMALL)
    assert H.bag(got.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")) == sorted((row(d, t) for d, t in rows), key=repr)


def test_mask(spark):
    rows = [*H.EDGE, *((100 + i, t) for i, t in enumerate(TEXTS))]
    d = H.docs(spark, rows)
    made = secrets.mask_secrets(d)
    assert made.columns == d.columns and made.count() == len(rows)
    for r in made.collect():
        assert not [s for s in base(r.text) if "[" not in r.text[s[0]:s[1]]], r.text
        assert r.text is None or r.n_chars == len(r.text)
    assert secrets.mask("a token=abcdefgh1 b") == "a [assign] b"
    assert secrets.find_secrets(H.docs(spark, [])).count() == 0
    assert secrets.find_secrets(H.docs(spark, H.EDGE)).count() == len(H.EDGE)
