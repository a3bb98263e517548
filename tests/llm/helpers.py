"""Brute-force counterparts of the text operators, on small tables."""

import hashlib
import re
import zlib

import numpy as np
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()), T.StructField("key", T.StringType()),
                     T.StructField("row", T.IntegerType()), T.StructField("digest", T.StringType())])


def docs(spark, rows):
    """``rows`` of (doc_id, text) with extra columns whose names clash with
    those operators use inside."""
    return spark.createDataFrame([(d, t, "en", "s", None if t is None else len(t), "k", 1, "d") for d, t in rows], DOCS)


EDGE = [(1, "Some words are here. And here are some more, idiot!"), (2, None), (3, ""), (4, " \t\n "), (None, "null id text"),
        (None, None), (5, "same  text\there"), (6, "same text here"), (6, "same text here"), (7, "same text here "),
        (8, "é" * 300 + " ünï " + "x" * 700), (9, "word " * 30_000), (10, "a\0b"), (11, "\U0001F600 emoji ▁ token = \"abcdefgh1\"")]


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def sha(b):
    return hashlib.sha256(b).hexdigest()


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def reachable(nodes, links):
    """Smallest node reachable from each node."""
    label = {n: n for n in nodes}
    moved = True
    while moved:
        moved = False
        for a, b in links:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                moved = True
    return label


def removed(texts, length):
    """Bytes of each text in a ``length``-byte string that starts elsewhere too."""
    n = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            n[t[i:i + length]] = n.get(t[i:i + length], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if n[t[i:i + length]] > 1:
                gone[i:i + length] = True
        out.append(gone)
    return out


