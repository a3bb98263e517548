"""Repeated byte strings over an enhanced suffix array.

A byte goes if it lies in a ``length``-byte string that also starts anywhere
else in the corpus. Comparing all suffixes of a corpus in one place is not
possible, so suffixes are sampled by content: of every ``WINDOW`` neighbouring
k-grams the one with the smallest hash is an anchor, and a ``length``-byte
string holds a whole window of k-grams, hence an anchor, the same one wherever
the string occurs. Strings can only repeat around anchors that repeat.

1. Texts are taken once each (a copied text of ``length`` bytes or more goes
   whole) and written with a number to the shared folder.
2. Anchors are (k-gram hash, hash of the context that all strings through the
   anchor lie in, text, position). Contexts that repeat are covered whole:
   they are counted by a map-side combined aggregate.
3. Anchors that repeat with different contexts are compared: one row per
   distinct context, dealt out by anchor. Their right contexts, sorted, with
   the common prefixes of neighbours are an enhanced suffix array of the
   sampled suffixes; a stack scan gives its common-prefix intervals, and
   within an interval of depth d the left extensions are tested: where two
   occurrences share at least ``length - d`` bytes to the left, all of them
   are occurrences of one repeat and are covered. An anchor with more contexts
   than a task should hold is settled by counting the hashes of all its
   windows instead, which needs no group at all.
4. Covered ranges meet their text again file by file; the text is not shuffled.

:func:`repeat_groups` returns the maximal repeats themselves, each with all its
occurrences: strings of ``length`` bytes or more that occur at least twice and
whose occurrences differ (or end) both before and after them. Within a
common-prefix interval the occurrences are sorted by what stands before them;
a second stack scan gives the sets that share a left extension, and a set
that lies in more than one child of the interval is a maximal repeat.
Contexts reach ``reach`` bytes, so every maximal repeat shorter than that is
whole; a longer one comes in parts, one an anchor, marked ``cut``.

Rows: null counts as empty; texts shorter than ``length`` match nothing;
repeated rows and null ids are texts like any other; matches within one text
count, overlapping ones too, and never cross texts. Hashes of contexts are
64-bit beside the anchor's 64. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, columns, having, lean, runs, small_side, store, text_of, written

K = 50                       # bytes of an anchor's k-gram
_P = 0x9E3779B97F4A7C15 | 1  # odd, invertible modulo 2**64
_PI = pow(_P, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, _P, np.uint64), np.full(size, _PI, np.uint64)
        up[0] = down[0] = 1
        _POWERS[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _POWERS[0][:n], _POWERS[1][:n]


def _slide(x: np.ndarray, w: int, f) -> np.ndarray:
    """f (minimum or maximum) over every w neighbouring values, by prefix and
    suffix passes over blocks of w."""
    n = len(x)
    pad = -n % w
    fill = x[-1:] if pad else x[:0]
    y = np.concatenate([x, np.repeat(fill, pad)]).reshape(-1, w)
    pre = f.accumulate(y, axis=1).ravel()
    suf = f.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return f(suf[:n - w + 1], pre[w - 1:n])


def anchors(data: np.ndarray, length: int, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the anchors of a text of ``length`` bytes or more."""
    n = len(data)
    up, down = _powers(n + 1)
    s = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=s[1:])
    h = (s[k:] - s[:-k]) * down[:n - k + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    w = length - k + 1
    low = _slide(h, w, np.minimum)              # of every window of w k-grams
    edge = np.zeros(w - 1, np.uint64)
    high = _slide(np.concatenate([edge, low, edge]), w, np.maximum)
    at = np.flatnonzero(high == h)              # the smallest of some window
    return at, h[at]


# -- the enhanced suffix array of the contexts of a set of anchors --------
def _matrix(parts: list[bytes], width: int) -> np.ndarray:
    """Rows padded to ``width`` bytes, with the length as a last sort key."""
    m = np.zeros((len(parts), width + 2), np.uint8)
    for i, p in enumerate(parts):
        m[i, :len(p)] = np.frombuffer(p, np.uint8)
    n = np.fromiter(map(len, parts), np.int64, len(parts))
    m[:, width], m[:, width + 1] = n >> 8, (n & 255)
    m[:, width] += 1
    return m


def _common(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows a[i], b[i], at most n[i]."""
    out = np.empty(len(a), np.int64)
    for lo in range(0, len(a), 4096):
        d = a[lo:lo + 4096] != b[lo:lo + 4096]
        first = np.where(d.any(axis=1), d.argmax(axis=1), a.shape[1])
        out[lo:lo + 4096] = first
    return np.minimum(out, n)


def intervals(lcp: np.ndarray, least: int):
    """(depth, first, last) of every common-prefix interval of at least
    ``least``, by one scan with a stack; ``lcp[i]`` is of rows i and i+1."""
    stack: list[list[int]] = []
    for i, d in enumerate([*lcp.tolist(), -1]):
        first = i
        while stack and stack[-1][0] > d:
            depth, first = stack.pop()
            yield depth, first, i
        if d >= least and (not stack or stack[-1][0] < d):
            stack.append([d, first])


def _sorted(left: list[bytes], right: list[bytes], reach: int, k: int):
    """(order of the right contexts, common prefixes of neighbours in it,
    left contexts, their lengths, their ranks)."""
    r, l = _matrix(right, reach), _matrix(left, reach - k)
    rn, ln = np.fromiter(map(len, right), np.int64), np.fromiter(map(len, left), np.int64)
    order = np.argsort(np.ascontiguousarray(r).view(f"S{reach + 2}").ravel(), kind="stable")
    lrank = np.empty(len(left), np.int64)
    lrank[np.argsort(np.ascontiguousarray(l).view(f"S{reach - k + 2}").ravel(), kind="stable")] = np.arange(len(left))
    r, l = r[:, :reach], l[:, :reach - k]
    a, b = order[:-1], order[1:]
    return order, _common(r[a], r[b], np.minimum(rn[a], rn[b])), l, ln, lrank


def maximal(left: list[bytes], right: list[bytes], length: int, reach: int, k: int = K):
    """(bytes before the anchor, bytes from it on, occurrences) of every
    maximal repeat of at least ``length`` bytes that holds the anchor, among
    different contexts of at most ``reach - k`` and ``reach`` bytes. The end
    of a context differs from anything."""
    if len(right) < 2:
        return
    order, lcp, l, ln, lrank = _sorted(left, right, reach, k)
    for depth, first, last in intervals(lcp, k):
        rows = order[first:last + 1]
        child = np.concatenate(([0], np.cumsum(lcp[first:last] == depth)))
        need = max(length - depth, 0)
        fit = np.flatnonzero(ln[rows] >= need)
        if len(fit) < 2:
            continue
        fit = fit[np.argsort(lrank[rows[fit]])]
        rows, child = rows[fit], child[fit]
        x, y = rows[:-1], rows[1:]
        share = _common(l[x], l[y], np.minimum(ln[x], ln[y]))
        for before, lo, hi in intervals(share, need):
            if (child[lo:hi + 1] != child[lo]).any():
                yield before, depth, rows[lo:hi + 1]


def repeats(left: list[bytes], right: list[bytes], length: int, k: int = K) -> np.ndarray:
    """For each occurrence of an anchor that lies in a repeat: the range
    [before, after) around it, relative to it, that its repeats cover together
    (each holds the anchor's k-gram, so they join), as rows (occurrence,
    before, after).

    ``left`` are the bytes before the anchor, nearest first (at most
    ``length - k``), ``right`` those from it on (at most ``length``).
    """
    if len(right) < 2:
        return np.zeros((0, 3), np.int64)
    order, lcp, l, ln, lrank = _sorted(left, right, length, k)
    before, after = np.zeros(len(left), np.int64), np.full(len(left), -1)
    for depth, first, last in intervals(lcp, k):
        rows = order[first:last + 1]
        need = length - depth
        if need > 0:
            rows = rows[ln[rows] >= need]
            if len(rows) < 2:
                continue
        rows = rows[np.argsort(lrank[rows])]
        x, y = rows[:-1], rows[1:]
        share = _common(l[x], l[y], np.minimum(ln[x], ln[y]))
        best = np.zeros(len(rows), np.int64)
        best[:-1] = share
        best[1:] = np.maximum(best[1:], share)
        same = np.zeros(len(rows), bool)
        same[:-1] = share >= need
        same[1:] |= share >= need
        hit, best = rows[same], best[same]
        before[hit] = np.minimum(before[hit], -best)
        after[hit] = np.maximum(after[hit], depth)
    hit = np.flatnonzero(after >= 0)
    return np.stack([hit, before[hit], after[hit]], axis=1)


# -- Spark ---------------------------------------------------------------
def _anchor_rows(length: int, k: int, reach: int):
    def make(batches):
        for b in columns(batches):
            hs, cs, rs, ps = [], [], [], []
            for rid, text in zip(b["rid"].to_pylist(), b["text"].to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                at, h = anchors(np.frombuffer(raw, np.uint8), length, k)
                hs.append(h)
                ps.append(at)
                rs.append(np.full(len(at), rid, np.int64))
                end, before = len(raw), reach - k
                # a context cut short by an end of its text differs from a whole one
                cs.append(np.array([xxhash.xxh3_64_intdigest(raw[max(0, p - before):p + reach],
                                                            (p if p < before else before) << 16 | min(end - p, reach))
                                    for p in at.tolist()], np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(hs).view(np.int64)), pa.array(np.concatenate(cs).view(np.int64)),
                 pa.array(np.concatenate(rs)), pa.array(np.concatenate(ps).astype(np.int32))], names=["anchor", "ctx", "rid", "pos"])
    return make


def _per_text(batches):
    """(text number, key, bytes, row) of each text that has a row in
    ``batches``, sorted by (part, rid) with one row per text: its file in the
    shared folder is read once, a few texts at a time."""
    for _, t in runs(batches, "part"):
        rows = {r: i for i, r in enumerate(t["rid"].to_pylist())}
        files, path = store(t["file"][0].as_py())
        with files.open_input_file(path) as f:
            for b in pq.ParquetFile(f).iter_batches(batch_size=100, columns=["rid", "ckey", "text"]):
                for k, r in enumerate(b.column(0).to_pylist()):
                    if r in rows:
                        at = rows[r]
                        yield r, b.column(1)[k].as_py(), b.column(2)[k].as_py().encode("utf-8", "surrogatepass"), (t, at)
        lean()


def _contexts(length: int, k: int):
    def make(batches):
        rows = []

        def batch():
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                              names=["anchor", "rid", "pos", "own", "left", "right"])
        for r, _, raw, (t, at) in _per_text(batches):
            for x in t["marks"][at].as_py():
                p = x["pos"]
                rows.append((x["anchor"], r, p, x["own"], raw[max(0, p - length + k):p][::-1], raw[p:p + length]))
            if len(rows) >= 5000:
                yield batch()
                rows.clear()
        if rows:
            yield batch()
    return make


def _compare(length: int, k: int):
    def make(batches):
        held, n = [], 0

        def settle():
            t = pa.concat_tables(held)
            rid, pos, own = t["rid"].to_numpy(), t["pos"].to_numpy(), t["own"].to_numpy()
            # equal k-grams sort together, so several anchors share one array
            found = repeats(t["left"].to_pylist(), t["right"].to_pylist(), length, k)
            found = found[own[found[:, 0]]]
            at = pos[found[:, 0]].astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(rid[found[:, 0]]), pa.array(at + found[:, 1]), pa.array(at + found[:, 2])],
                                              names=["rid", "lo", "hi"])
        for _, t in runs(batches, "anchor"):
            held.append(t)
            n += t.num_rows
            if n >= 20_000:
                yield settle()
                held, n = [], 0
        if held:
            yield settle()
    return make


def _windows(length: int, k: int):
    """All ``length``-byte strings through each anchor as 128-bit hashes."""
    def make(batches):
        for b in columns(batches):
            out = []
            for rid, pos, own, left, right in zip(*(b[c].to_pylist() for c in ("rid", "pos", "own", "left", "right"))):
                raw = left[::-1] + right
                for lo in range(0, min(len(left), len(raw) - length) + 1):
                    d = xxhash.xxh3_128_digest(raw[lo:lo + length])
                    out.append((d, rid, pos - len(left) + lo, own))
                    if len(out) == 20_000:
                        yield _win(out)
                        out = []
            if out:
                yield _win(out)
    return make


def _win(out):
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["win", "rid", "lo", "own"])


def _cut(batches):
    """Per text with covered ranges: what goes and what stays."""
    rows = []

    def batch():
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.binary(),
                 pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                          names=["ckey", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])
    size = 0
    for _, ckey, raw, (t, at) in _per_text(batches):
        c = t["ranges"][at].values
        lo, hi = np.maximum(c.field("lo").to_numpy(), 0), np.minimum(c.field("hi").to_numpy(), len(raw))
        order = np.argsort(lo, kind="stable")
        lo, hi = lo[order], np.maximum.accumulate(hi[order])
        start = np.flatnonzero(np.concatenate(([True], lo[1:] > hi[:-1])))
        lo, hi = lo[start], hi[np.concatenate((start[1:] - 1, [len(hi) - 1]))]
        kept, done = [], 0
        for a, b in zip(lo.tolist(), hi.tolist()):
            kept.append(raw[done:a])
            done = b
        kept = b"".join([*kept, raw[done:]])
        rows.append((ckey, int((hi - lo).sum()), len(lo), hashlib.sha256(kept).hexdigest(), kept,
                     [{"start": a, "end": b} for a, b in zip(lo.tolist(), hi.tolist())]))
        size += len(kept)
        if len(rows) >= 1000 or size > 8 << 20:
            yield batch()
            rows.clear()
            size = 0
    if rows:
        yield batch()


CUT = "ckey binary, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<struct<start:long,end:long>>"


def _source(docs: DataFrame) -> DataFrame:
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return src.withColumn("n_bytes", F.octet_length("text")).withColumn("ckey", F.unhex(F.sha2("text", 256)))


def _numbered(src: DataFrame, length: int):
    """Step 1: (copied texts, their number, one numbered row per distinct text
    of enough bytes, the files that hold them)."""
    copies = (src.where(F.col("n_bytes") >= length).groupBy("ckey")
              .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("lead")).where("n > 1"))
    copies = written(copies, "copied-texts")
    n_copies = copies.count()
    side = small_side(copies.select("ckey", "lead", F.lit(True).alias("copied")), n_copies)
    once = (src.where(F.col("n_bytes") >= length).join(side, "ckey", "left")
            .where(F.col("copied").isNull() | F.col("doc_id").eqNullSafe(F.col("lead")))
            .select(F.monotonically_increasing_id().alias("rid"), "ckey", F.coalesce("copied", F.lit(False)).alias("copied"), "text"))
    texts = written(once, "texts")
    places = texts.select(F.shiftright("rid", 33).alias("part"), F.input_file_name().alias("file")).distinct()
    places = written(places, "text-files")
    if n_copies and texts.where("copied").count() > n_copies:
        # the leading id repeats with its text, or there is none: one row stands for all
        one = written(texts.where("copied").groupBy("ckey").agg(F.min("rid").alias("rid")), "leading-copies")
        one = small_side(one.select("rid", F.lit(True).alias("leads")), n_copies)
        texts = texts.join(one, "rid", "left").where("leads or not copied").drop("leads")
    return copies, n_copies, texts, places


def _repeated(texts: DataFrame, length: int, k: int, reach: int) -> tuple[DataFrame, DataFrame]:
    """Step 2: (marks of the anchors that repeat, their distinct contexts).
    Anchors that occur once go first, before anything wide is moved."""
    marks = written(texts.select("rid", "text").mapInArrow(_anchor_rows(length, k, reach), "anchor long, ctx long, rid long, pos int"), "anchors")
    again = written(marks.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated-anchors")
    marks = written(having(marks, again, ["anchor"]), "repeated-marks")
    contexts = written(marks.groupBy("anchor", "ctx").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rid", "pos")).alias("one")), "contexts")
    return marks, contexts


def _around(reps: DataFrame, places: DataFrame, reach: int, k: int) -> DataFrame:
    """The bytes around each mark in ``reps`` (anchor, own, rid, pos)."""
    n_places = places.count()
    # one row per text, with its anchors: as many as its own length allows
    located = (reps.withColumn("part", F.shiftright("rid", 33)).repartition("part")
               .groupBy("part", "rid").agg(F.collect_list(F.struct("anchor", "pos", "own")).alias("marks"))
               .join(small_side(places, n_places), "part"))
    return (located.sortWithinPartitions("part", "rid").select("part", "file", "rid", "marks")
            .mapInArrow(_contexts(reach, k), "anchor long, rid long, pos int, own boolean, left binary, right binary"))


def remove_repeats(docs: DataFrame, length: int = 200, k: int = K, unit_rows: int = 50_000, with_kept: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``;
    with ``with_kept`` also ``kept`` (the remaining bytes) and ``spans``."""
    spark = docs.sparkSession
    bounded_batches(spark, 500)
    src = _source(docs)
    copies, n_copies, texts, places = _numbered(src, length)
    marks, contexts = _repeated(texts, length, k, length)
    whole = (having(marks, contexts.where("n > 1").select("anchor", "ctx", "n"), ["anchor", "ctx"])
             .select("rid", (F.col("pos") - (length - k)).cast("long").alias("lo"), (F.col("pos") + length).cast("long").alias("hi")))

    # 3. repeated anchors with different contexts
    shared = written(contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "shared-anchors")
    reps = (contexts.join(shared.select("anchor"), "anchor", "left_semi")
            .select("anchor", (F.col("n") == 1).alias("own"), F.col("one.rid").alias("rid"), F.col("one.pos").alias("pos")))
    n_places = places.count()
    around = _around(reps, places, length, k)
    hot = shared.where(F.col("m") > unit_rows)
    n_hot = hot.count()
    if n_hot:
        around = written(around, "anchor-contexts")
        plain = around.join(small_side(hot.select("anchor"), n_hot), "anchor", "left_anti")
    else:
        plain = around
    parts = plain.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_compare(length, k), "rid long, lo long, hi long")
    spans = whole.unionByName(parts)
    if n_hot:
        wins = written(around.join(small_side(hot.select("anchor"), n_hot), "anchor", "left_semi")
                       .mapInArrow(_windows(length, k), "win binary, rid long, lo long, own boolean")
                       .groupBy("win", "rid", "lo").agg(F.max("own").alias("own")), "hot-windows")
        often = wins.groupBy("win").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("win")
        spans = spans.unionByName(wins.where("own").join(often, "win", "left_semi")
                                  .select("rid", "lo", (F.col("lo") + length).alias("hi")))

    # 4. cut: ranges go to the file of their text
    todo = (spans.withColumn("part", F.shiftright("rid", 33)).repartition("part")
            .groupBy("part", "rid").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
            .join(small_side(places, n_places), "part"))
    cut = todo.sortWithinPartitions("part", "rid").select("part", "file", "rid", "ranges").mapInArrow(_cut, CUT)
    keep = ["ckey", "n_removed", "n_spans", "kept_sha256", *(["kept", "spans"] if with_kept else [])]
    cut = cut.select(*keep)

    # 5. back to the rows; a copied text goes whole
    rows = src.select("doc_id", "n_bytes", "ckey", *(["text"] if with_kept else []))
    out = rows.join(small_side(copies.select("ckey", F.lit(True).alias("copied")), n_copies), "ckey", "left").join(cut, "ckey", "left")
    gone = F.coalesce("copied", F.lit(False))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    cols = [F.col("doc_id"), F.col("n_bytes").cast("long").alias("n_bytes"),
            F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
            F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(gone, nothing).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("ckey")))).alias("kept_sha256")]
    if with_kept:
        cols += [F.when(gone, F.lit(b"")).otherwise(F.coalesce("kept", F.col("text").cast("binary"))).alias("kept"),
                 F.when(gone, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").cast("long").alias("end"))))
                 .otherwise(F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>"))).alias("spans")]
    return out.select(*cols)


# -- the repeats themselves ----------------------------------------------
FOUND = "rid long, pos int, own boolean, gid binary, before int, n_bytes long, cut boolean"


def _found(rows):
    kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.int32(), pa.int64(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                      names=["rid", "pos", "own", "gid", "before", "n_bytes", "cut"])


def _groups(length: int, k: int, reach: int):
    """Maximal repeats of anchors that come whole, one row per context in one;
    a context that occurs more than once (not ``own``) is a repeat itself."""
    def make(batches):
        def settle(held):
            t = pa.concat_tables(held)
            rid, pos, own, left, right = (t[c].to_pylist() for c in ("rid", "pos", "own", "left", "right"))
            out = []
            whole = ((len(left[i]), len(right[i]), [i]) for i in range(len(own)) if not own[i])
            for before, after, at in (*whole, *maximal(left, right, length, reach, k)):
                text = left[at[0]][:before][::-1] + right[at[0]][:after]
                cut = before == reach - k or after == reach
                # in a periodic string the anchor comes again and again: the first one tells of it
                if not cut and text.find(right[at[0]][:k]) < before:
                    continue
                gid = xxhash.xxh3_128_digest(text)
                for i in at:
                    out.append((rid[i], pos[i], own[i], gid, before, len(text), cut))
                if len(out) >= 20_000:
                    yield _found(out)
                    out = []
            if out:
                yield _found(out)
        held, n = [], 0
        for _, t in runs(batches, "anchor"):
            held.append(t)
            n += t.num_rows
            if n >= 5000:
                yield from settle(held)
                held, n = [], 0
        if held:
            yield from settle(held)
    return make


def _window_groups(length: int, k: int):
    """All ``length``-byte strings through each anchor, as parts of repeats."""
    def make(batches):
        for b in columns(batches):
            out = []
            for rid, pos, own, left, right in zip(*(b[c].to_pylist() for c in ("rid", "pos", "own", "left", "right"))):
                near = left[:length - k]
                raw = near[::-1] + right[:length]
                for lo in range(0, min(len(near), len(raw) - length) + 1):
                    out.append((rid, pos, own, xxhash.xxh3_128_digest(raw[lo:lo + length]), len(near) - lo, length, True))
                if len(out) >= 20_000:
                    yield _found(out)
                    out = []
            if out:
                yield _found(out)
    return make


def repeat_groups(docs: DataFrame, length: int = 200, k: int = K, reach: int | None = None, unit_rows: int = 50_000) -> DataFrame:
    """(group_id, n_bytes, cut, doc_id, copies, start): one row per occurrence
    of each maximal repeat of at least ``length`` bytes.

    ``group_id`` is the hash (XXH3, 128 bits, hex) of the repeated string,
    ``start`` its byte offset in the text. Equal texts are one row: ``doc_id``
    is their smallest id and ``copies`` their number; a text that has copies is
    a repeat itself. Without ``cut`` a group is exact: a maximal repeat with
    all its occurrences; every maximal repeat below ``reach`` bytes (four
    times ``length`` by default) is such a group. With ``cut`` it reaches the
    end of the compared contexts and may go on. An anchor with more than
    ``unit_rows`` contexts gives its ``length``-byte strings instead, as
    ``cut`` groups counted in a distributed aggregate, so its shorter
    repeats come in parts too. Null and short texts have no repeats.
    """
    reach = reach or 4 * length
    bounded_batches(docs.sparkSession, 500)
    src = _source(docs)
    _, _, texts, places = _numbered(src, length)
    who = src.where(F.col("n_bytes") >= length).groupBy("ckey").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    names = written(texts.select("rid", "ckey", "text").join(who, "ckey")
                    .select("rid", "doc_id", "copies", F.when(F.col("copies") > 1, F.col("text")).alias("text")), "text-names")
    marks, contexts = _repeated(texts, length, k, reach)
    sizes = written(contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")), "anchor-sizes")
    reps = (contexts.join(sizes.where("m > 1").select("anchor", F.lit(True).alias("shared")), "anchor", "left")
            .where("shared or n > 1").select("anchor", (F.col("n") == 1).alias("own"), F.col("one.rid").alias("rid"), F.col("one.pos").alias("pos")))
    around = written(_around(reps, places, reach, k), "group-contexts")
    hot = sizes.where(F.col("m") > unit_rows).select("anchor")
    n_hot = hot.count()
    plain = around.join(small_side(hot, n_hot), "anchor", "left_anti") if n_hot else around
    found = plain.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_groups(length, k, reach), FOUND)
    if n_hot:
        parts = written(around.join(small_side(hot, n_hot), "anchor", "left_semi").mapInArrow(_window_groups(length, k), FOUND), "hot-groups")
        places_of = parts.groupBy("gid", "rid", (F.col("pos") - F.col("before")).alias("start")).agg(F.min("own").alias("own"))
        often = places_of.groupBy("gid").agg(F.sum(F.when(F.col("own"), 1).otherwise(2)).alias("n")).where("n > 1").select("gid")
        found = found.unionByName(parts.join(often, "gid", "left_semi"))
    found = written(found, "repeat-groups")

    # a context that occurs more than once stands for all its marks
    every = (marks.join(contexts.where("n > 1").select("anchor", "ctx", "one"), ["anchor", "ctx"])
             .select(F.col("one.rid").alias("rid"), F.col("one.pos").alias("pos"), F.col("rid").alias("to"), F.col("pos").alias("at")))
    cols = ["gid", "n_bytes", "cut"]
    own = found.where("own").select(*cols, "rid", (F.col("pos") - F.col("before")).cast("long").alias("start"))
    more = (found.where("not own").join(every, ["rid", "pos"])
            .select(*cols, F.col("to").alias("rid"), (F.col("at") - F.col("before")).cast("long").alias("start")))
    # the same string is found once an anchor; where one of them sees it whole, it is whole
    seen = own.unionByName(more).groupBy("gid", "n_bytes", "rid", "start").agg(F.min("cut").alias("cut"))
    whole = (names.where("copies > 1").mapInArrow(_whole_texts(reach), "gid binary, n_bytes long, cut boolean, rid long, start long"))
    seen = seen.unionByName(whole).groupBy("gid", "n_bytes", "rid", "start").agg(F.min("cut").alias("cut"))
    return seen.join(names.select("rid", "doc_id", "copies"), "rid").select(
        F.lower(F.hex("gid")).alias("group_id"), "n_bytes", "cut", "doc_id", "copies", "start")


def _whole_texts(reach: int):
    def make(batches):
        for b in columns(batches):
            raw = [t.encode("utf-8", "surrogatepass") for t in b["text"].to_pylist()]
            n = pa.array([len(t) for t in raw], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_128_digest(t) for t in raw], pa.binary()), n, pa.array([len(t) >= reach for t in raw]),
                 b["rid"], pa.array([0] * len(raw), pa.int64())], names=["gid", "n_bytes", "cut", "rid", "start"])
    return make
