import itertools
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelwright.llm import queries, variants
from panelwright.sources.tables import read_table

from ..conftest import SF_SMALL
from . import helpers as H

LOWER = str.maketrans(variants.UPPER, variants.LOWER)


def counted(rows):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a != b and (a[i:] == b[i + 1:] or len(a) == len(b) and a[i + 1:] == b[i + 1:])


def expected(n):
    by = defaultdict(set)
    for w in n:
        for key in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            by[key].add(w)
    near = defaultdict(set)
    for group in by.values():
        for a, b in itertools.combinations(group, 2):
            if one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def result(df):
    return H.bag(df.select("word", "form", "root", "n", "n_near", "form_n"))


@settings(max_examples=300, deadline=None)
@given(st.text("abcé", min_size=7, max_size=14), st.data())
def test_one_edit_leaves_an_asked_gram(word, data):
    i = data.draw(st.integers(0, len(word)))
    kind, c = data.draw(st.sampled_from("ids")), data.draw(st.sampled_from("abcé"))
    other = {"i": word[:i] + c + word[i:], "d": word[:i] + word[i + 1:], "s": word[:i] + c + word[i + 1:]}[kind]
    if len(other) < 7 or not one_edit(word, other):
        return
    frequent = data.draw(st.sets(st.text("abcé<>", min_size=3, max_size=5), max_size=20))
    frequent |= {f"<{word}>"[k:k + q] for k in range(len(word)) for q in range(3, 7) if data.draw(st.booleans())}
    a, b = sorted((word, other), key=len, reverse=True)
    (grams, (i, j)), (held, _) = variants.decompose(a, frequent), variants.decompose(b, frequent)
    assert i + len(grams[i]) <= j
    places = (0,) if len(a) == len(b) else (0, 1)
    assert any(at >= d and grams[at] == held[at - d] for at in (i, j) for d in places if at - d < len(held))


WORDS = {"separate": 500, "seperate": 40, "seperat": 4, "separat": 2, "ababababab": 7, "abababababa": 70, "bababababa": 3, "étranger": 12,
         "etranger": 120, "x" * 40: 2, "x" * 41: 30, "nothing": 9, "aaaaaaa": 5, "aaaaaaaa": 50, "aaaaaaaaa": 500, "tiedone": 2, "tiedona": 20, "tiedonb": 20}


def test_counting_matches_brute_force(spark):
    rows = H.EDGE + [(i, "Separate SEPARATE separate Étranger étranger ×wordsabc÷ wordsabc " + "y" * 300) for i in range(90)]
    got = {r.word: r.n for r in variants.count_words(H.docs(spark, rows)).collect()}
    assert got == counted(rows)
    assert variants.group_variants(variants.count_words(H.docs(spark, []))).count() == 0


@pytest.mark.parametrize("how", [{}, {"rare": 1, "most": 100}, {"list_rows": 1}, {"list_rows": 3, "rare": 0, "most": 100_000}])
def test_groups_match_brute_force(spark, how):
    n = dict(WORDS)
    for i in range(400):        # a third of all words in one list
        n[f"prefix{chr(97 + i % 20)}{chr(97 + i // 20)}ending"] = 2 + 37 * (i % 11 == 0)
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    assert result(variants.group_variants(df, **how)) == expected(n)


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").collect()]
    assert result(queries.op11_spelling_variants(spark, SF_SMALL)) == expected(counted(rows))
