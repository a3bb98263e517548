import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.llm import queries, token_store
from panelwright.llm.wordbpe import Encoder, default_vocabulary
from panelwright.sources.tables import read_table

from ..conftest import SF_SMALL
from . import helpers as H


@pytest.fixture(scope="module")
def whole():
    t = Encoder(default_vocabulary()).tokenizer
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def expected(rows, whole):
    out, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = whole(t) + [2]
        out.append((d, start, len(ids), H.crc(ids)))
        start += len(ids)
    return sorted(out, key=repr)


def test_chunks_give_the_ids_of_the_whole_text(whole):
    e = Encoder(default_vocabulary())
    for text in ["", "Hello, World...  don't\n\tstop", "<|endoftext|> x<|startoftext|>Y", "naïve CAFÉ É H̱",
                 " a b\x0bc\x1cd", "x" * 5000, "ſ K İ ß Ǆ", "a's 're 've 12,345.", ".,.,"]:
        assert np.frombuffer(e.ids(text), "<u4").tolist() == whole(text), text


def test_every_letter_before_marks(whole):
    e = Encoder(default_vocabulary())
    texts = [f"a{chr(c)}? {chr(c)}.x {chr(c)}," for c in range(0x80, 0x3200) if chr(c).isalpha()]
    for t, ids in zip(texts, e.ids_batch(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == whole(t), ascii(t)


def test_ids_must_fit(spark):
    with pytest.raises(Exception, match="does not fit in 2 bytes"):
        token_store.write_store(H.docs(spark, [(1, "a")]), end_id=70_000, id_bytes=2).read(
            token_store.keys_of(H.docs(spark, [(1, "a")]))).collect()


def test_query_matches_brute_force(spark, whole):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").collect()]
    assert H.bag(queries.op1_token_store(spark, SF_SMALL)) == expected(rows, whole)


def test_edge_rows_and_small_shards(spark, whole):
    s = token_store.write_store(H.docs(spark, H.EDGE), end_id=2, shard_ids=50, bucket_keys=3)
    got = s.read(token_store.keys_of(H.docs(spark, H.EDGE))).select("doc_id", "start", "n_tokens", F.crc32("ids"))
    assert H.bag(got) == expected(H.EDGE, whole)
    absent = spark.createDataFrame([(99, 0), (6, 2), (-1, 0)], "doc_id long, rep long")
    assert s.locate(absent).count() == 0


def test_empty_table(spark):
    d = H.docs(spark, [])
    assert token_store.write_store(d).read(token_store.keys_of(d)).count() == 0


def test_perfect_hash_is_minimal():
    keys = token_store.mix(np.arange(50_000, dtype=np.uint64), 3)
    h = token_store.PerfectHash.build(keys)
    assert sorted(h.slots(keys).tolist()) == list(range(len(keys)))
