import sys

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelwright.llm import bpe, queries
from panelwright.sources.tables import read_table

from ..conftest import SF_SMALL
from . import helpers as H

PATH = bpe.default_vocabulary()
LIBRARY = Tokenizer.from_file(PATH)


def expected(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.fixture(scope="module")
def model():
    return bpe.Bpe(PATH)


def both(model, texts):
    ids, ends = model.encode_batch(pa.array(texts, pa.string()))
    out = [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]
    return list(zip(out, model.decode_batch(ids, ends).to_pylist()))


def test_texts_match_the_library(model):
    texts = ["", " ", None, "Hello  World, it's <|endoftext|>fine<|ENDOFTEXT|>", "BİLGİ? evet", "İ! ΌΔΟΣ, Σας", "a\x1cb \x85c",
             "aaaa aaaaa aaaaaaaaaaaaaaaaaaaaaaa", "漢字かな交じり \U0001F600\U0001F600", "x" * 5000, "é É.", "1234 ½ ²", "<|startoftext|>",
             "word " * 3000, "don't DON'T we'LL", " 　"]
    assert both(model, texts) == [expected(t) for t in texts]


def test_every_character_beside_marks(model):
    chars = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and (c < 0x3200 or c % 37 == 0)]
    texts = [f"a{c}? {c}.b 'S{c}" for c in chars]
    want = [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    assert [i for i, _ in both(model, texts)] == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60) | st.text("abcdetshin' \n.İ<|>", max_size=60), max_size=8))
def test_random_texts(texts):
    assert both(bpe.bpe(PATH), texts) == [expected(t) for t in texts]


def test_table_whose_parts_are_younger_joins_one_pair_at_a_time():
    # (ab, b) outranks (a, b): after one join the next pair is the new one
    merges = bpe.Merges([(3, 1, 4), (0, 1, 3), (0, 0, 5)], 6)
    assert not merges.ordered
    ids, of = merges.apply(np.array([0, 1, 1, 0, 0, 0]), np.array([0, 0, 0, 1, 1, 1]))
    assert (ids.tolist(), of.tolist()) == ([4, 5, 0], [0, 1, 1])


def test_query_matches_the_library(spark):
    rows = {r.doc_id: r.text for r in read_table(spark, SF_SMALL, "documents").collect()}
    got = queries.op13_bpe(spark, SF_SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        ids, text = expected(rows[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), H.sha(np.array(ids, "<u4").tobytes()), H.sha(text.encode()))


def test_edge_rows(spark):
    made = bpe.decode(bpe.encode(H.docs(spark, H.EDGE)))
    want = [(d, np.array(i, "<u4").tobytes(), len(i), t) for d, (i, t) in ((d, expected(t)) for d, t in H.EDGE)]
    assert sorted(((r.doc_id, bytes(r.ids), r.n_tokens, r.decoded) for r in made.collect()), key=repr) == sorted(want, key=repr)
    assert bpe.decode(bpe.encode(H.docs(spark, []))).count() == 0
