from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelwright.llm import alignment, queries
from panelwright.sources.tables import read_table

from ..conftest import SF_SMALL
from . import helpers as H

FILES = alignment.default_files()
A = Tokenizer.from_file(FILES[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
MODEL = alignment.Pair(*FILES)


def tokens(text):
    """(ids of A, ends, ids of B, ends) by whole-text encoding; None where
    the bytes do not come back."""
    if not text:
        return None
    raw, a, b = (" " + text).encode(), A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    ta, tb = MODEL.table_a, MODEL.table_b
    if ta.joined(a) != raw or tb.joined(b) != raw:
        return None
    return a, np.cumsum([len(ta.tokens[i]) for i in a]).tolist(), b, np.cumsum([len(tb.tokens[i]) for i in b]).tolist()


def groups(a, ea, b, eb):
    common, out, links = set(ea) & set(eb), [([], [])], []
    ia = ib = 0
    for end in sorted(common):
        while ia < len(a) and ea[ia] <= end:
            out[-1][0].append(a[ia])
            ia += 1
        while ib < len(b) and eb[ib] <= end:
            out[-1][1].append(b[ib])
            ib += 1
        links.append((a[ia - 1], b[ib - 1]))
        out.append(([], []))
    return ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in out[:-1]), links


def expected(rows):
    found = [(d, tokens(t)) for d, t in rows]
    made = [(d, x, *(groups(*x) if x else ("", []))) for d, x in found]
    count = Counter(p for *_, links in made for p in links)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return [(d, len(x[0]) if x else 0, len(x[2]) if x else 0, len(links), len(links),
             sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), H.sha(text.encode()) if x else "")
            for d, x, text, links in made]


def result(df):
    return H.bag(df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))


@settings(max_examples=120, deadline=None)
@given(st.lists(st.text(max_size=40) | st.text("ab cd\n\t'.é▁漢\x1c  ", max_size=40), min_size=1, max_size=6))
def test_words_give_whole_text_tokens(texts):
    ta, tb, has = MODEL.tokens(texts)
    for i, t in enumerate(texts):
        x = tokens(t)
        assert has[i] == (x is not None)
        if x:
            assert ta.ids[ta.text == i].tolist() == x[0] and tb.ids[tb.text == i].tolist() == x[2]


@settings(max_examples=100, deadline=None)
@given(st.text("abcdetshin' \n.é漢", min_size=1, max_size=80), st.lists(st.integers(1, 90), max_size=6), st.randoms())
def test_fragments_compose_in_any_order(text, cuts, random):
    a, ea, b, eb = (np.array(x) for x in tokens(text))
    cuts = sorted({0, *(c for c in cuts if c < ea[-1]), int(ea[-1])})
    parts = []
    for lo, hi in zip(cuts, cuts[1:]):
        x, y = (ea > lo) & (ea <= hi), (eb > lo) & (eb <= hi)
        parts.append(alignment.Fragment.of(a[x], ea[x], b[y], eb[y]))
    while len(parts) > 1:
        i = random.randrange(len(parts) - 1)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    assert parts[0].closed().decode() == groups(*(x.tolist() for x in (a, ea, b, eb)))[0]


@settings(max_examples=100, deadline=None)
@given(st.text("ab é漢\n  ", min_size=1, max_size=60), st.integers(1, 12))
def test_ranges_cover_the_text(text, chunk):
    total, at = len(text.encode()) + 1, 0
    found = alignment.ranges(text, chunk, True)
    for words, lo, hi in found:
        assert words in text and 0 <= lo < hi <= len(words.encode()) + 1
        at += hi - lo
    assert at == total and found[0][1] == 0


@pytest.mark.parametrize("chunk, fan", [(alignment.CHUNK_BYTES, 16), (300, 2), (37, 3)])
def test_whole_and_composed_texts_match_brute_force(spark, chunk, fan):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").orderBy("doc_id").limit(40).collect()]
    rows += H.EDGE + [(77, "<s> </s> <|endoftext|> <unk> <0x41>"), (78, "x" * 900 + " y " + "漢" * 500)]
    assert result(alignment.align(H.docs(spark, rows), chunk=chunk, fan=fan, block_links=3000)) == sorted(expected(rows), key=repr)


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").collect()]
    assert result(queries.op12_alignment(spark, SF_SMALL)) == sorted(expected(rows), key=repr)


def test_empty_table(spark):
    assert alignment.align(H.docs(spark, [])).count() == 0
