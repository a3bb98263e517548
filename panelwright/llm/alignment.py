"""Alignment of two tokenizers' tokens over the same bytes.

A byte-level BPE file (A, over blank + text) and a SentencePiece model (B,
which puts the blank itself) cut a text's bytes into tokens; offsets where
tokens of both end cut these into groups, and the two tokens that end there
are linked. How often the corpus links two ids tells how well they correspond.

The alignment of a byte range is a :class:`Fragment`: an open prefix (tokens
up to the first common end), the closed groups, and an open suffix (tokens
after the last common end); a token belongs to the range its last byte is in.
Fragments compose associatively, the suffix of one and the prefix of the next
making a group, so ranges may be aligned anywhere and in any order. A text of
more than ``chunk`` bytes is cut into byte ranges that go to different tasks
as rows of their own, each with the words its ends cut through, and a tree of
grouped reductions, ``FAN`` fragments a task, composes them.

Both tokenizers never join bytes across a blank between two characters that
are not white space (checked in the files: A's splitter keeps white space in
front, no piece of B has U+2581 behind another character), so the words of a
batch are encoded once each, and a range's words give the range's tokens. For
files where that does not hold a text is one word and one range. A byte range
never ends in a word longer than ``chunk``: such a word is in one range.

Counts: a task numbers the id pairs of its block of texts (bounded by
``BLOCK_LINKS``) and writes one row a text with these numbers and one list of
pairs a block. Totals are a sum by pair, the best of each B id is a table of at
most B's vocabulary, and both return to the blocks by pair: a pair has one row
a block, however many texts hold it.

Rows: texts that are null, empty, or whose tokens do not give their bytes back
(a U+2581 in a text is a blank to B) have no tokens: zeros, no digest.
Rows that repeat an id are rows of their own; null ids are kept; other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, claim, columns, text_of, written

CHUNK_BYTES = 32 << 10     # longest text aligned in one piece
FAN = 16                   # fragments composed by one task
BLOCK_LINKS = 3_000_000    # (text, pair) rows that share one numbering of pairs
BATCH_TEXTS = 1000         # texts encoded at a time, and their bytes
BATCH_BYTES = 3 << 20
TOGETHER = 4000            # words encoded as one text
SPACE = "▁"
WHITE = np.array([c for c in range(0x3001) if chr(c).isspace()], np.uint32)
CUT = re.compile(r"(?<=\S) (?=\S)")
_NO = np.zeros(0, np.int32)
_LOADED: dict[tuple[str, str], "Pair"] = {}


def default_files() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# -- tokens ----------------------------------------------------------------
class Table:
    """Bytes of each id."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.size = np.fromiter(map(len, tokens), np.int32, len(tokens))

    def joined(self, ids) -> bytes:
        t = self.tokens
        return b"".join([t[i] for i in ids])


def byte_alphabet() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the others follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Pair:
    """The two tokenizers, and the words' tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet, size = byte_alphabet(), self.a.get_vocab_size()
        table: list[bytes] = [b""] * size
        for token, i in self.a.get_vocab().items():
            table[i] = bytes([alphabet[c] for c in token]) if all(c in alphabet for c in token) else token.encode()
        self.table_a = Table(table)
        sp = self.b
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.table_b = Table([bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(SPACE, " ").encode()
                              for i, p in enumerate(pieces)])
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        probe = sp.encode("  a b ", out_type=str)
        self.by_word = (split.get("type") == "ByteLevel" and split.get("use_regex") is True and not spec.get("normalizer")
                        and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
                        and "".join(probe) == "▁▁▁a▁b▁")

    def cut(self, text: str) -> list[str]:
        return CUT.split(text) if self.by_word else [text]

    def words(self, words: list[str]) -> tuple["Words", "Words", np.ndarray]:
        """Ids of A and of B for blank + word, and whether both give its
        bytes back. Words between blanks are encoded as one text."""
        a, b, ok = Words(len(words)), Words(len(words)), np.ones(len(words), bool)
        alone = []
        plain = []
        for i, w in enumerate(words):
            between = self.by_word and w and SPACE not in w and not w[0].isspace() and not w[-1].isspace()
            (plain if between else alone).append(i)
        for lo in range(0, len(plain), TOGETHER):
            part = plain[lo:lo + TOGETHER]
            text = " " + " ".join([words[i] for i in part])
            raw = text.encode()
            x, y = self.a.encode(text, add_special_tokens=False).ids, self.b.encode(text[1:])
            if self.table_a.joined(x) == raw == self.table_b.joined(y):
                ends = np.cumsum([1 + len(words[i].encode()) for i in part])
                a.add(part, np.array(x, np.int32), ends, self.table_a)
                b.add(part, np.array(y, np.int32), ends, self.table_b)
            else:
                alone += part
        for i in alone:
            raw = (" " + words[i]).encode()
            x, y = self.a.encode(" " + words[i], add_special_tokens=False).ids, self.b.encode(words[i])
            ok[i] = self.table_a.joined(x) == raw == self.table_b.joined(y)
            a.add([i], np.array(x, np.int32), None, self.table_a)
            b.add([i], np.array(y, np.int32), None, self.table_b)
        return a, b, ok

    def tokens(self, texts: list[str]) -> tuple["Tokens", "Tokens", np.ndarray]:
        """Tokens of A and of B of all texts in a row, and which texts have
        any. A text whose tokens do not give its bytes back has none."""
        lists = [self.cut(t) if t else [] for t in texts]
        per = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = pa.array([w for x in lists for w in x], pa.large_string()).dictionary_encode()
        del lists
        a, b, ok = self.words(flat.dictionary.to_pylist())
        code = flat.indices.to_numpy()
        of = np.repeat(np.arange(len(texts), dtype=np.int32), per)
        has = per > 0
        has[of[~ok[code]]] = False
        code, of = code[has[of]], of[has[of]]
        return a.gather(code, of, self.table_a), b.gather(code, of, self.table_b), has


class Words:
    """Ids of numbered words, one after the other in the order they came."""

    def __init__(self, n: int):
        self.first, self.size = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.parts: list[np.ndarray] = []
        self.total = 0

    def add(self, words: list[int], ids: np.ndarray, ends: np.ndarray | None, table: Table) -> None:
        """Ids of some words in a row, the bytes of each ending at ``ends``."""
        stop = [len(ids)] if ends is None else np.searchsorted(np.cumsum(table.size[ids]), ends) + 1
        self.size[words] = np.diff(stop, prepend=0)
        self.first[words] = self.total + np.concatenate([[0], stop[:-1]])
        self.parts.append(ids)
        self.total += len(ids)

    def gather(self, code: np.ndarray, of: np.ndarray, table: Table) -> "Tokens":
        """Tokens of a row of words, each with its text."""
        store = np.concatenate([*self.parts, _NO])
        each = self.size[code]
        place = np.repeat(self.first[code] - (np.cumsum(each, dtype=np.int32) - each), each)
        place += np.arange(len(place), dtype=np.int32)
        ids = store[place]
        return Tokens(ids, np.repeat(of, each), np.cumsum(table.size[ids], dtype=np.int32))


@dataclass
class Tokens:
    ids: np.ndarray       # of all texts in a row
    text: np.ndarray      # text of each
    ends: np.ndarray      # offset after it, counted over all texts

    def where(self, keep: np.ndarray) -> "Tokens":
        return Tokens(self.ids[keep], self.text[keep], self.ends[keep])


def groups_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Common ends, and the number of common ends before each token of a, b."""
    common = np.intersect1d(a, b, assume_unique=True)
    return common, np.searchsorted(common, a), np.searchsorted(common, b)


def render(a: np.ndarray, ga: np.ndarray, b: np.ndarray, gb: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offset after each group's text) of the groups 0..n-1 in order,
    each as ``a1,a2|b1,b2;`` in decimal ids."""
    na, nb = np.bincount(ga, minlength=n), np.bincount(gb, minlength=n)
    upto_a, upto_b = np.cumsum(na), np.cumsum(nb)
    ids = np.empty(len(a) + len(b), np.int32)
    mark = np.full(len(ids), ord(","), np.uint8)
    ids[np.arange(len(a)) + (upto_b - nb)[ga]] = a
    ids[np.arange(len(b)) + upto_a[gb]] = b
    mark[upto_a + (upto_b - nb) - 1] = ord("|")
    mark[upto_a + upto_b - 1] = ord(";")
    digits = np.ones(len(ids), np.int32)
    power = 10
    while len(ids) and power <= int(ids.max()):
        digits += ids >= power
        power *= 10
    ends = np.cumsum(digits + 1)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends - 1] = mark
    at, rest = ends - 2, ids
    while len(rest):
        out[at] = rest % 10 + ord("0")
        more = rest >= 10
        at, rest = at[more] - 1, rest[more] // 10
    return out, ends[upto_a + upto_b - 1]


# -- the monoid ------------------------------------------------------------
@dataclass
class Fragment:
    """Alignment of a byte range. Without a common end in it (``cut`` false)
    all its tokens are prefix."""
    cut: bool = False
    head_a: np.ndarray = field(default_factory=lambda: _NO)
    head_b: np.ndarray = field(default_factory=lambda: _NO)
    body: bytes = b""
    tail_a: np.ndarray = field(default_factory=lambda: _NO)
    tail_b: np.ndarray = field(default_factory=lambda: _NO)

    @classmethod
    def of(cls, a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray) -> "Fragment":
        common, ga, gb = groups_of(ends_a, ends_b)
        n = len(common)
        if not n:
            return cls(False, a, b)
        in_a, in_b = (ga > 0) & (ga < n), (gb > 0) & (gb < n)
        text, _ = render(a[in_a], ga[in_a] - 1, b[in_b], gb[in_b] - 1, n - 1)
        return cls(True, a[ga == 0], b[gb == 0], text[:-1].tobytes(), a[ga == n], b[gb == n])

    def __add__(self, other: "Fragment") -> "Fragment":
        def join(x, y):
            return np.concatenate([x, y])
        if not self.cut:
            return Fragment(other.cut, join(self.head_a, other.head_a), join(self.head_b, other.head_b),
                            other.body, other.tail_a, other.tail_b)
        if not other.cut:
            return Fragment(True, self.head_a, self.head_b, self.body,
                            join(self.tail_a, other.head_a), join(self.tail_b, other.head_b))
        between = group_text(join(self.tail_a, other.head_a), join(self.tail_b, other.head_b))
        return Fragment(True, self.head_a, self.head_b, b";".join(x for x in (self.body, between, other.body) if x),
                        other.tail_a, other.tail_b)

    def closed(self) -> bytes:
        """All groups' text, of a whole document's fragment."""
        if len(self.tail_a) or len(self.tail_b) or not self.cut:
            raise ValueError("not the fragment of a whole document")
        return b";".join(x for x in (group_text(self.head_a, self.head_b), self.body) if x)


def group_text(a: np.ndarray, b: np.ndarray) -> bytes:
    return (",".join(map(str, a.tolist())) + "|" + ",".join(map(str, b.tolist()))).encode()


# -- tasks -----------------------------------------------------------------
PIECE = "row long, doc_id long, k int, text string, lo long, hi long"
PART = ("row long, doc_id long, k int, ok boolean, n_a long, n_b long, n_groups long, groups_sha256 string, "
        "pairs binary, times binary, cut boolean, head_a binary, head_b binary, body binary, tail_a binary, tail_b binary")
BLOCK = ("block long, row long, doc_id long, k int, n_a long, n_b long, n_groups long, groups_sha256 string, "
         "at binary, times binary, pairs array<long>, ns array<long>")


def pair_tokenizers(files: tuple[str, str]) -> Pair:
    if files not in _LOADED:
        _LOADED[files] = Pair(*files)
    found = _LOADED[files]
    claim(found, lambda: None)
    return found


def ranges(text: str, chunk: int, by_word: bool) -> list[tuple[str, int, int]]:
    """(words, lo, hi) for the byte ranges of blank + text: the words a range
    touches, and its first and last byte counted from the blank before them."""
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    upto = np.concatenate([[0], np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))])
    total = int(upto[-1]) + 1
    white = np.isin(code, WHITE)
    blank = np.flatnonzero((code[1:-1] == 32) & ~white[:-2] & ~white[2:]) + 1 if by_word else np.zeros(0, np.int64)
    # a word's first byte is its blank; the text's own first blank is at 0
    start = np.concatenate([[0], upto[blank] + 1, [total]])
    stop = np.arange(chunk, total, chunk)
    of = np.searchsorted(start, stop, "right") - 1
    stop = np.concatenate([[0], stop[start[of + 1] - start[of] <= chunk], [total]])
    char = np.concatenate([[0], blank + 1, [len(text) + 1]])
    out = []
    for lo, hi in zip(stop[:-1].tolist(), stop[1:].tolist()):
        first, last = np.searchsorted(start, lo, "right") - 1, np.searchsorted(start, hi, "left")
        out.append((text[char[first]:char[last] - 1], lo - int(start[first]), hi - int(start[first])))
    return out


def _cut(files: tuple[str, str], chunk: int):
    """Long texts as rows of byte ranges."""
    def make(batches):
        by_word, n = pair_tokenizers(files).by_word, TaskContext.get().partitionId() << 40
        for b in columns(batches):
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                rows = [(n, doc_id, k, *r) for k, r in enumerate(ranges(text, chunk, by_word))]
                n += 1
                for lo in range(0, len(rows), 256):
                    cols = list(zip(*rows[lo:lo + 256]))
                    types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                     names=["row", "doc_id", "k", "text", "lo", "hi"])
    return make


def _linked(a: Tokens, b: Tokens, ga: np.ndarray, gb: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, pair) of each common end: the ids of A and B that end there."""
    at_a, at_b = np.searchsorted(a.ends, common), np.searchsorted(b.ends, common)
    return a.text[at_a], a.ids[at_a].astype(np.int64) << 32 | b.ids[at_b]


def _by_text(text: np.ndarray, pair: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs of each text, how often, and each text's end in them."""
    order = np.lexsort((pair, text))
    text, pair = text[order], pair[order]
    first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (pair[1:] != pair[:-1])])[:len(text)])
    return pair[first], np.diff(first, append=len(text)), np.searchsorted(text[first], np.arange(n + 1))


def _align(files: tuple[str, str], whole: bool):
    """Tokens, groups and id pairs: of whole texts with the digest, of byte
    ranges with the fragment."""
    def make(batches):
        model = pair_tokenizers(files)
        for b in columns(batches):
            texts = b["text"].to_pylist()
            n = len(texts)
            ta, tb, has = model.tokens(texts)
            if not whole:
                # offsets counted over all texts: where each one's words begin
                size = np.where(has, [len(t.encode()) + 1 for t in texts], 0)
                base = np.cumsum(size) - size
                lo, hi = base + b["lo"].to_numpy(), base + b["hi"].to_numpy()
                ta, tb = (t.where((t.ends > lo[t.text]) & (t.ends <= hi[t.text])) for t in (ta, tb))
            common, ga, gb = groups_of(ta.ends, tb.ends)
            text, pair = _linked(ta, tb, ga, gb, common)
            pairs, times, upto = _by_text(text, pair, n)
            n_a, n_b, n_groups = (np.bincount(x, minlength=n) for x in (ta.text, tb.text, text))
            digest, frag = [""] * n, [None] * n
            if whole:
                out, ends = render(ta.ids, ga, tb.ids, gb, len(common))
                last = np.cumsum(n_groups)
                raw, at = memoryview(out), 0
                for i in np.flatnonzero(n_groups).tolist():
                    end = int(ends[last[i] - 1])
                    digest[i] = hashlib.sha256(raw[at:end - 1]).hexdigest()
                    at = end
            else:
                la, lb = (np.searchsorted(t.text, np.arange(n + 1)) for t in (ta, tb))
                for i in range(n):
                    x, y = slice(la[i], la[i + 1]), slice(lb[i], lb[i + 1])
                    frag[i] = Fragment.of(ta.ids[x], ta.ends[x], tb.ids[y], tb.ends[y])
            yield pa.RecordBatch.from_arrays([
                b["row"], b["doc_id"], b["k"], pa.array(has), pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(digest, pa.string()),
                _sliced(pairs, upto), _sliced(times.astype(np.int64), upto), *_fragments(frag)], names=NAMES)
    return make


NAMES = [c.split(" ")[0] for c in PART.split(", ")]


def _sliced(values: np.ndarray, upto: np.ndarray) -> pa.Array:
    raw, size = values.tobytes(), values.itemsize
    cuts = (upto * size).tolist()
    return pa.array([raw[x:y] for x, y in zip(cuts, cuts[1:])], pa.binary())


def _fragments(found: list[Fragment | None]) -> list[pa.Array]:
    def ids(name):
        return pa.array([None if f is None else getattr(f, name).astype("<i4").tobytes() for f in found], pa.binary())
    return [pa.array([None if f is None else f.cut for f in found], pa.bool_()), ids("head_a"), ids("head_b"),
            pa.array([None if f is None else f.body for f in found], pa.binary()), ids("tail_a"), ids("tail_b")]


def _fragment(r: dict) -> Fragment:
    return Fragment(r["cut"], *(np.frombuffer(r[c], "<i4") for c in ("head_a", "head_b")), r["body"],
                    *(np.frombuffer(r[c], "<i4") for c in ("tail_a", "tail_b")))


def _compose(fan: int):
    """One row of a run of fragments of one text."""
    def make(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["k"])
        of, whole, ok = rows[0]["of"], Fragment(), all(r["ok"] for r in rows)
        digest = rows[0]["groups_sha256"]
        if not digest:
            for r in rows if ok else ():
                whole = whole + _fragment(r)
            if ok and of <= fan:
                digest = hashlib.sha256(whole.closed()).hexdigest()
            if of <= fan or not ok:
                whole = Fragment()
        made = {"row": rows[0]["row"], "k": rows[0]["k"] // fan, "of": -(-of // fan), "ok": ok, "groups_sha256": digest,
                **{c: sum(r[c] for r in rows) if ok else 0 for c in ("n_a", "n_b", "n_groups")}}
        return pa.table([pa.array([made[c]], t) for c, t in TREE_TYPES.items()] + _fragments([whole]),
                        names=[*TREE_TYPES, *NAMES[-6:]])
    return make


TREE_TYPES = {"row": pa.int64(), "k": pa.int32(), "of": pa.int32(), "ok": pa.bool_(), "n_a": pa.int64(), "n_b": pa.int64(),
              "n_groups": pa.int64(), "groups_sha256": pa.string()}
TREE = ("row long, k int, of int, ok boolean, n_a long, n_b long, n_groups long, groups_sha256 string, "
        "cut boolean, head_a binary, head_b binary, body binary, tail_a binary, tail_b binary")


def compose(parts: DataFrame, fan: int = FAN) -> DataFrame:
    """One row per text from its fragments, ``fan`` of them a step."""
    sizes = parts.groupBy("row").agg(F.count(F.lit(1)).cast("int").alias("of"))
    tree = parts.join(sizes, "row").select(*[c.split(" ")[0] for c in TREE.split(", ")])
    most = sizes.agg(F.max("of")).first()[0] or 0
    while True:
        tree = tree.groupBy("row", (F.col("k") / fan).cast("int").alias("step")).applyInArrow(_compose(fan), TREE)
        if most <= fan:
            return tree
        tree, most = written(tree, "alignment-tree"), -(-most // fan)


def _number(block_links: int):
    """Texts with numbers in place of pairs, a list of pairs for each block."""
    def make(batches):
        names = [c.split(" ")[0] for c in BLOCK.split(", ")]
        types = [pa.int64()] * 3 + [pa.int32()] + [pa.int64()] * 3 + [pa.string()] + [pa.binary()] * 2 + [pa.list_(pa.int64())] * 2
        schema = pa.schema(list(zip(names, types)))
        block, held, n_held = TaskContext.get().partitionId() << 24, [], 0

        def close():
            raw = [np.frombuffer(x, "<i8") for b in held for x in b["pairs"].to_pylist()]
            times = [np.frombuffer(x, "<i8") for b in held for x in b["times"].to_pylist()]
            upto = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
            pairs, at = np.unique(np.concatenate([*raw, np.zeros(0, np.int64)]), return_inverse=True)
            times = np.concatenate([*times, np.zeros(0, np.int64)])
            ns = np.zeros(len(pairs), np.int64)
            np.add.at(ns, at, times)
            at, times = _sliced(at.astype("<u4"), upto), _sliced(times.astype("<u4"), upto)
            lo = 0
            for b in held:
                n = len(b["row"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * n, pa.int64()), *(b[c] for c in names[1:8]), at.slice(lo, n), times.slice(lo, n),
                     pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))], names=names)
                lo += n
            for part in range(0, len(pairs), 100_000):
                x, y = pairs[part:part + 100_000], ns[part:part + 100_000]
                yield pa.RecordBatch.from_pylist([{"block": block, "row": part, "pairs": x, "ns": y}], schema=schema)
        for b in columns(batches):
            held.append(b)
            n_held += sum(map(len, b["pairs"].to_pylist())) // 8
            if n_held >= block_links:
                yield from close()
                block, held, n_held = block + 1, [], 0
        if held:
            yield from close()
    return make


def _scored(texts: pa.Table, counts: pa.Table) -> pa.Table:
    """Sums over each text's links of their pairs' counts (``value``: twice
    the count, and one if it is the B id's best)."""
    value = np.zeros(counts.num_rows, np.int64)
    value[counts["number"].to_numpy()] = counts["value"].to_numpy()
    n = texts.num_rows
    at = [np.frombuffer(x, "<u4") for x in texts["at"].to_pylist()]
    times = np.frombuffer(b"".join(texts["times"].to_pylist()), "<u4").astype(np.int64)
    of = np.repeat(np.arange(n), [len(x) for x in at])
    value = value[np.concatenate([*at, np.zeros(0, np.uint32)])]

    def total(x):
        out = np.zeros(n, np.int64)
        np.add.at(out, of, x)
        return pa.array(out)
    kept = texts.select(["row", "doc_id", "k", "n_a", "n_b", "n_groups", "groups_sha256"])
    return (kept.append_column("n_links", total(times)).append_column("n_best", total(times * (value & 1)))
            .append_column("count_sum", total(times * (value >> 1))))


SCORED = ("row long, doc_id long, k int, n_a long, n_b long, n_groups long, groups_sha256 string, "
          "n_links long, n_best long, count_sum long")


def align(docs: DataFrame, files: tuple[str, str] | None = None, chunk: int = CHUNK_BYTES,
          fan: int = FAN, block_links: int = BLOCK_LINKS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256) per row of ``docs``."""
    spark, files = docs.sparkSession, files or default_files()
    bounded_batches(spark, BATCH_TEXTS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    long = F.octet_length("text") >= chunk
    short = (src.where(~long).select(F.lit(None).cast("long").alias("row"), "doc_id", F.lit(0).alias("k"), "text")
             .mapInArrow(_align(files, True), PART))
    blocks = written(short.mapInArrow(_number(block_links), BLOCK), "alignment-texts")
    # byte ranges of long texts go to tasks of their own
    cut = src.where(long).mapInArrow(_cut(files, chunk), PIECE).repartition("row", "k")
    parts = written(cut.mapInArrow(_align(files, False), PART), "alignment-ranges")
    found = written(compose(parts, fan), "alignment-composed")
    good = (parts.join(found.where("ok").select("row"), "row", "left_semi")
            .select(*[F.lit("").alias(c) if c == "groups_sha256" else F.col(c) for c in NAMES[:10]]))
    blocks = blocks.unionByName(written(good.mapInArrow(_number(block_links), BLOCK)
                                        .withColumn("block", -1 - F.col("block")), "alignment-numbered"))
    numbered = (blocks.where(F.col("pairs").isNotNull())
                .select("block", F.col("row").alias("part"), F.posexplode(F.arrays_zip("pairs", "ns")).alias("pos", "x"))
                .select("block", (F.col("part") + F.col("pos")).alias("at"), F.col("x.pairs").alias("pair"), F.col("x.ns").alias("n")))
    counts = numbered.groupBy("pair").agg(F.sum("n").alias("count"))
    counts = written(counts.withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1)), "alignment-counts")
    best = counts.groupBy("b").agg(F.max("count").alias("best"))       # at most B's vocabulary
    value = counts.join(F.broadcast(best), "b").select("pair", (F.col("count") * 2 + (F.col("count") == F.col("best")).cast("long")).alias("value"))
    back = (numbered.select(F.col("block").alias("of"), "at", "pair").join(value, "pair")
            .select(F.col("of").alias("in_block"), F.col("at").alias("number"), "value"))
    texts = blocks.where(F.col("pairs").isNull()).drop("pairs", "ns")
    scored = texts.groupBy("block").cogroup(back.groupBy("in_block")).applyInArrow(_scored, SCORED)
    counted = ("n_links", "n_best", "count_sum")
    one = scored.where(F.col("row").isNull()).drop("row", "k")
    sums = scored.where(F.col("row").isNotNull()).groupBy("row").agg(*[F.sum(c).alias(c) for c in counted])
    ids = parts.where("k = 0").select("row", "doc_id")
    many = (ids.join(found.select("row", "n_a", "n_b", "n_groups", "groups_sha256"), "row").join(sums, "row", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "groups_sha256", *[F.coalesce(c, F.lit(0)).alias(c) for c in counted]))
    return one.unionByName(many).select("doc_id", "n_a", "n_b", "n_groups", *counted, "groups_sha256")
