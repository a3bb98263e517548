import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelwright.llm import queries, viterbi
from panelwright.sources.tables import read_table

from ..conftest import SF_SMALL
from . import helpers as H


@pytest.fixture(scope="module")
def pieces():
    return viterbi.Pieces(viterbi.default_model())


def slow(p, text):
    """Full Viterbi over the whole text."""
    if not text:
        return []
    t = "▁" + text.replace(" ", "▁")
    best, back = [0.0] + [None] * len(t), [0] * (len(t) + 1)
    for i in range(len(t)):
        for n in range(1, min(p.longest, len(t) - i) + 1):
            v = p.score.get(t[i:i + n], p.unknown if n == 1 else None)
            if v is not None and (best[i + n] is None or best[i] + v > best[i + n]):
                best[i + n], back[i + n] = best[i] + v, i
    out, at = [], len(t)
    while at:
        s = t[back[at]:at]
        out.append([p.ids[s]] if s in p.ids else [p.byte_id[b] for b in s.encode()])
        at = back[at]
    return [i for x in reversed(out) for i in x]


def test_texts_match_the_full_search_and_decode_back(pieces):
    for t in ["", " ", "a", "Hello  world, it's   fine\n\nnext\tline ", "naïve 漢字かな \U0001F600 ½", "thththethethe" * 40, "é" * 100]:
        got = pieces.encode(t)
        assert np.frombuffer(got, "<u4").tolist() == slow(pieces, t), t
        assert pieces.decode(got).decode() == t


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abetnhoi ▁\n.é漢", max_size=120))
def test_random_texts(t):
    p = viterbi.pieces(viterbi.default_model())
    t = t.replace("▁", " ")
    got = p.encode(t)
    assert np.frombuffer(got, "<u4").tolist() == slow(p, t)
    assert p.decode(got).decode() == t


def test_short_words_are_found_in_one_pass(pieces, monkeypatch):
    rng = np.random.default_rng(3)
    for n in range(1, pieces.window):
        t = "".join(rng.choice(list("▁▁abetnhoi\n.é漢😀"), n))
        assert pieces._short(t) == pieces._stream(t), t
    monkeypatch.setattr(pieces, "kept", {})
    monkeypatch.setattr(viterbi.Pieces, "_stream", lambda self, text: pytest.fail("streamed a short word"))
    assert pieces.encode("the  unlikeliest wrods é漢\n")


def test_window_stays_bounded_without_word_starts(pieces):
    rng = np.random.default_rng(1)
    t = "".join(rng.choice(list("etaoinshrdlu"), 20_000))
    s = viterbi.StreamingViterbi(pieces)
    out = []
    for lo in range(0, len(t), 777):
        out += s.feed(t[lo:lo + 777])
    widest = s.widest
    out += s.finish()
    assert 0 < widest < 2000
    assert b"".join(pieces.bytes[i] for i in out).decode() == t


def test_query_decodes_every_text(spark):
    rows = {r.doc_id: r.text for r in read_table(spark, SF_SMALL, "documents").collect()}
    p = viterbi.Pieces(viterbi.default_model())
    got = queries.op3_sentencepiece(spark, SF_SMALL).collect()
    assert {r.doc_id for r in got} == set(rows)
    for r in got:
        assert r.decoded_sha256 == H.sha((rows[r.doc_id] or "").encode())
        ids = slow(p, rows[r.doc_id])
        assert (r.n_tokens, r.ids_crc32) == (len(ids), H.crc(ids))


def test_edge_rows(spark):
    made = viterbi.encode(H.docs(spark, H.EDGE)).select("doc_id", "decoded")
    assert H.bag(made) == sorted(((d, (t or "").replace("▁", " ")) for d, t in H.EDGE), key=repr)
    assert viterbi.encode(H.docs(spark, [])).count() == 0
