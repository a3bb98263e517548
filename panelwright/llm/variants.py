"""Spelling variants: words one edit apart, found with variable-length grams.

Words are counted over the corpus in partial aggregates. A word between ``<``
and ``>`` has one gram at every start: the shortest of ``QMIN`` characters or
more that is not frequent, at most ``QMAX`` long, or up to the end. Frequent
grams (more than one in ``DICTIONARY`` of their length, so at most that many)
are the pruned dictionary, the only thing sent to all tasks.

A gram depends on its own characters alone, so one edit changes only the
grams that cover it: of any set of a word's grams at most as many as cover one
character, the set's bound. A near word has all others, at places that follow
from the lengths. For each word a smallest set larger than its bound is taken,
two infrequent grams that cover no common character (they exist from 7
characters on, bound 1), and the lists of all words with these grams at fitting
places and lengths are merged; the edit distance of what they hold is computed.
A list longer than ``LIST_ROWS`` that a word asks for is not paired: its words
and those that ask for it go by the hashes of what is left when one character is deleted, which
words one edit apart share, so no list grows into its square.

A word's form is its most frequent near word (ties: the smallest) if that is
at least ``ratio`` times as frequent; root follows forms to the last one. Each
step is ``ratio`` times as frequent, so chains have at most log(n) steps.

Rows: a null text has no words, a null doc_id stands as an empty string in the
hash; repeated rows count as often as they come; a run of any length is one
word; other columns are ignored; an empty table gives no words.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, columns, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUNS = "[a-zÀ-ÿ]+"
QMIN, QMAX = 3, 6
DICTIONARY = 100_000     # most frequent grams of one length
LEAST_FREQUENT = 32      # a gram this rare is never extended
LIST_ROWS = 500          # longest list whose pairs are compared


def count_words(docs: DataFrame, every: int = 31, length: int = 7, least: int = 2) -> DataFrame:
    """(word, n): lower-cased runs of letters of ``length`` code points or
    more that occur ``least`` times. Of a run whose hash with its document
    ``every`` divides, one code point is deleted."""
    text = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    runs = docs.select(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("doc"),
                       F.explode(F.regexp_extract_all(text, F.lit(RUNS), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= length)
    h = F.crc32(F.concat_ws(":", "doc", "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % every == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    return (runs.withColumn("h", h).select(word.alias("word")).where(F.length("word") >= length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least))


# -- grams -----------------------------------------------------------------
def dictionary(words: DataFrame, most: int = DICTIONARY, rare: int = LEAST_FREQUENT) -> set[str]:
    """Frequent grams of QMIN to QMAX characters: at most ``most`` of a
    length by their threshold, one in ``most`` of all grams of that length."""
    p = F.concat(F.lit("<"), "word", F.lit(">"))

    def grams(q):
        return F.transform(F.sequence(F.lit(1), F.length(p) - (q - 1)), lambda i: F.substring(p, i, F.lit(q)))
    total = words.agg(F.sum(F.length("word").cast("long")).alias("n"), F.count(F.lit(1)).alias("w")).first()
    if not total["w"]:
        return set()
    one = words.select(F.explode(F.concat(*[grams(q) for q in range(QMIN, QMAX + 1)])).alias("gram"))
    bound = {q: max(rare, (total["n"] + total["w"] * (3 - q)) // most) for q in range(QMIN, QMAX + 1)}
    limit = F.element_at(F.create_map(*[F.lit(x) for q, b in bound.items() for x in (q, b)]), F.length("gram"))
    found = one.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    return {r["gram"] for r in found.select("gram").collect()}


def decompose(word: str, frequent: frozenset[str] | set[str]) -> tuple[list[str], tuple[int, int]]:
    """(gram at each start, starts of the two grams whose lists are merged)."""
    p = f"<{word}>"
    n = len(p)
    grams = []
    for i in range(n - QMIN + 1):
        q = QMIN
        while q < QMAX and i + q < n and p[i:i + q] in frequent:
            q += 1
        grams.append(p[i:i + q])
    # the last infrequent gram, or the last one, from each start on
    late, last = [n] * (n + 1), len(grams) - 1
    for i in range(last, -1, -1):
        late[i] = i if late[i + 1] == n and grams[i] not in frequent else late[i + 1]
    best = None
    for i, g in enumerate(grams):
        j = i + len(g)
        if j > last:
            break
        far = late[j] if late[j] < n else last
        cost = (g in frequent) + (grams[far] in frequent)
        if best is None or cost < best[0]:
            best = cost, i, far
        if not cost:
            break
    return grams, best[1:]


LISTED = "word string, n long, length int, gram string, at int, asked boolean"


def _listed(frequent):
    """A row for each gram of a word, marked if the word asks for its list."""
    def make(batches):
        known = frequent.value
        for b in columns(batches):
            for lo in range(0, len(b["word"]), 1000):
                words, n = b["word"].slice(lo, 1000), b["n"].slice(lo, 1000)
                made = [decompose(w, known) for w in words.to_pylist()]
                row = np.repeat(np.arange(len(made)), [len(m[0]) for m in made])
                yield pa.RecordBatch.from_arrays([
                    words.take(row), n.take(row), pa.array([len(m[0]) for m in made], pa.int32()).take(row),
                    pa.array([g for m in made for g in m[0]], pa.string()), pa.array([i for m in made for i in range(len(m[0]))], pa.int32()),
                    pa.array([i in m[1] for m in made for i in range(len(m[0]))])],
                    names=[c.split(" ")[0] for c in LISTED.split(", ")])
    return make


def _deleted(batches):
    """A hash of each word and of what is left without each of its characters."""
    base = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for b in columns(batches):
            for word, n in zip(b["word"].to_pylist(), b["n"].to_pylist()):
                c = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
                power = np.cumprod(np.full(len(c) + 1, base)) * np.uint64(0xC4CEB9FE1A85EC53)
                here = np.concatenate([[np.uint64(0)], np.cumsum(c * power[:-1])])
                down = np.concatenate([[np.uint64(0)], np.cumsum(c * power[:-1] * _inverse(base))])
                gone = here[:-1] + (down[-1] - down[1:])
                keys = np.unique(np.concatenate([here[-1:], gone])).view(np.int64)
                for lo in range(0, len(keys), 100_000):
                    k = keys[lo:lo + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array(k), pa.array([word] * len(k)), pa.array([n] * len(k), pa.int64())],
                                                     names=["key", "word", "n"])


def _inverse(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 1 << 64))


# -- near words ------------------------------------------------------------
def near_pairs(words: DataFrame, most: int = DICTIONARY, rare: int = LEAST_FREQUENT, list_rows: int = LIST_ROWS) -> DataFrame:
    """(a, b, na, nb) for each pair a < b of ``words`` (word, n), one edit apart."""
    spark = words.sparkSession
    bounded_batches(spark, 5000)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frequent = spark.sparkContext.broadcast(frozenset(dictionary(words, most, rare)))
    rows = written(words.repartition(tasks, "word").mapInArrow(_listed(frequent), LISTED), "variant-grams")

    def key(at, length):
        return F.xxhash64("gram", at, length).alias("key")
    lists = rows.select(key("at", "length"), F.col("word").alias("b"), F.col("n").alias("nb"))
    # a word of the same length has the gram in its place; one without a
    # character there, or one place before
    asked = rows.where("asked").select(F.col("word").alias("a"), F.col("n").alias("na"), F.explode(F.array(
        key("at", "length"), key("at", F.col("length") - 1), key(F.col("at") - 1, F.col("length") - 1))).alias("key"))
    long = written(lists.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > list_rows)
                   .join(asked.select("key").distinct(), "key", "left_semi").select("key"), "variant-long")
    merged = (asked.join(long, "key", "left_anti").join(lists, "key")
              .where((F.length("a") > F.length("b")) | (F.col("a") > F.col("b"))).select("a", "b", "na", "nb"))
    hot = (asked.join(long, "key", "left_semi").select(F.col("a").alias("word"), F.col("na").alias("n"))
           .unionByName(lists.join(long, "key", "left_semi").select(F.col("b").alias("word"), F.col("nb").alias("n")))
           .groupBy("word").agg(F.first("n").alias("n")).repartition(tasks, "word"))
    left = hot.mapInArrow(_deleted, "key long, word string, n long")
    x, y = left.alias("x"), left.alias("y")
    by_rest = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.word") < F.col("y.word"))).select(
        F.col("x.word").alias("a"), F.col("y.word").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb"))
    near = merged.unionByName(by_rest).where(F.levenshtein("a", "b", 1) == 1)
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(F.col("a") < F.col("b"), F.col("na")).otherwise(F.col("nb")).alias("na"),
                       F.when(F.col("a") < F.col("b"), F.col("nb")).otherwise(F.col("na")).alias("nb")).distinct()


def group_variants(words: DataFrame, ratio: int = 10, **settings) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each of ``words`` (word, n)."""
    words = written(words, "variant-words")
    pairs = written(near_pairs(words, **settings), "variant-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("na").alias("n"), F.col("nb").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("nb").alias("n"), F.col("na").alias("m")))
    top = (both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("m"), F.col("other"))).alias("top"), F.first("n").alias("n"))
           .select("word", "n_near", F.col("top.other").alias("form"), (-F.col("top.col1")).alias("form_n"), "n"))
    rises = F.col("form_n") >= ratio * F.col("n")
    top = written(top.select("word", "n_near", F.when(rises, F.col("form")).alias("form"), F.when(rises, F.col("form_n")).alias("form_n")), "variant-forms")
    most = words.agg(F.max("n")).first()[0] or 1
    steps = max(1, int(math.log(most, ratio)) + 1)
    root = top.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        root = written(root, "variant-roots")
        on = root.select(F.col("word").alias("root"), F.col("root").alias("further"))
        root = root.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return (words.join(top, "word", "left").join(root, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n"))
