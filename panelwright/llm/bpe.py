"""Byte-pair encoding and decoding by batched merge rounds in numpy.

Reads a `tokenizers` file (BPE model over byte-level symbols, optionally with
a suffix that marks the end of a word). The symbols of all words to encode
stand in one flat array. A round looks up the rank of every pair of
neighbours by binary search in the sorted pair keys, takes each word's lowest
rank, and joins all its occurrences in that word from left to right; words
without a known pair leave the array. A batch of texts is encoded at once:
its different words go through the rounds together and the ids of every text
are gathered from them. Normaliser and splitter are those of the file, called
on the different white-space-separated chunks of a batch (white space is
dropped by the splitter and composes with nothing, so chunks are independent;
for a file where that does not hold a whole text is one chunk).

Special tokens in a text are single ids, as in the library. Decoding joins
the vocabulary strings of the ids with blanks, which is the library's
``decode(ids, skip_special_tokens=False)`` for a file without a decoder.

Rows: a null text is empty and has no ids; white space alone has none either;
very long texts take one row and are encoded whole (the work of a round is in
proportion to the symbols still to be joined); repeated rows and null ids are
kept as they come; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, claim, columns, text_of

# Texts per batch (a larger batch has fewer different words), chunks whose
# ids a worker keeps, and the longest chunk kept.
ENCODED_ROWS = 2000
KEPT_CHUNKS = 200_000
KEPT_CHARS = 40

#: White space of Unicode's White_Space property, which the splitter drops.
BLANKS = "\t\n\v\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
NONE = np.iinfo(np.int32).max      # rank of a pair that is never joined

_LOADED: dict[str, "Bpe"] = {}


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Merges:
    """Merge table: sorted keys (left id, right id) with rank and joined id."""

    def __init__(self, pairs: list[tuple[int, int, int]], size: int):
        left, right, joined = np.array(pairs, np.int64).reshape(-1, 3).T
        self.size = size
        key = left * size + right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.joined = key[order], order.astype(np.int32), joined[order].astype(np.int32)
        # with parts older than what they make, joining all occurrences of the
        # lowest pair at once is the same as one after the other
        made = np.full(size, -1, np.int64)
        made[joined] = np.arange(len(joined))
        rank = np.arange(len(joined))
        self.ordered = bool(((made[left] < rank) & (made[right] < rank)).all())

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, joined id) of each pair of neighbours."""
        if not len(self.keys):
            return np.full(len(left), NONE, np.int32), np.zeros(len(left), np.int32)
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE).astype(np.int32), self.joined[at]

    def apply(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, word of each id) of the words whose symbols stand in a row;
        ``word`` numbers the word of each symbol in ascending order."""
        sym, word = symbols.astype(np.int32), word.astype(np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        n = len(sym)
        rank, joined = np.full(n, NONE, np.int32), np.zeros(n, np.int32)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner], joined[inner] = self.look_up(sym[inner], sym[inner + 1])
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(np.append(first, len(sym)))
            low = np.minimum.reduceat(rank, first)
            each = np.repeat(low, size)
            over = each == NONE
            n_over = np.count_nonzero(over)
            if n_over == len(sym) or 4 * n_over >= len(sym):
                done.append((sym[over], word[over]))
                left = ~over
                sym, word, rank, joined, each = sym[left], word[left], rank[left], joined[left], each[left]
                if not len(sym):
                    break
            hit = np.flatnonzero((rank == each) & (rank != NONE))
            new = np.concatenate([[True], hit[1:] != hit[:-1] + 1])
            if self.ordered:
                # of a run like "aaaa" every other pair, from the left
                hit = hit[(hit - hit[np.maximum.accumulate(np.where(new, np.arange(len(hit)), 0))]) % 2 == 0]
            else:
                hit = hit[np.concatenate([[True], word[hit[1:]] != word[hit[:-1]]])]
            sym[hit] = joined[hit]
            stay = np.ones(len(sym), bool)
            stay[hit + 1] = False
            moved = hit - np.arange(len(hit))       # each hit removes one symbol after it
            sym, word, rank, joined = sym[stay], word[stay], rank[stay], joined[stay]
            near = np.unique(np.concatenate([moved, moved[moved > 0] - 1]))
            last = np.concatenate([word[1:] != word[:-1], [True]])
            rank[near[last[near]]] = NONE
            near = near[~last[near]]
            rank[near], joined[near] = self.look_up(sym[near], sym[near + 1])
        if not done:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        ids, of = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(of, kind="stable")
        return ids[order], of[order]


class Bpe:
    """Encoder and decoder of a `tokenizers` file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec["added_tokens"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or any(
                t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"{path}: not a byte-level BPE file with plain special tokens")
        self.normalizer, self.splitter = tokenizer.normalizer, tokenizer.pre_tokenizer
        vocab = model["vocab"]
        size = 1 + max([*vocab.values(), *(t["id"] for t in added)])
        names: list[str | None] = [None] * size
        for token, i in [*vocab.items(), *((t["content"], t["id"]) for t in added)]:
            names[i] = token
        self.names = pa.array(names, pa.large_string())
        self.by_name = spec.get("decoder") is None
        suffix = model.get("end_of_word_suffix") or ""
        made = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = Merges([(vocab[a], vocab[b], vocab[a + b]) for a, b in made], size)
        # ids of the splitter's one-byte characters, inside and at the end of a word
        alphabet = [c for c in vocab if len(c) == 1]
        self.inside, self.at_end = (np.full(1 + max(map(ord, alphabet)), -1, np.int32) for _ in range(2))
        for c in alphabet:
            self.inside[ord(c)], self.at_end[ord(c)] = vocab[c], vocab.get(c + suffix, -1)
        special = {t["content"]: t["id"] for t in added}
        self.special = special
        self.parts = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        self.by_chunk = (split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") is True
                         and "[^\\s" in (split.get("pattern") or {}).get("Regex", "")
                         and not any(re.search(r"\s", t["content"]) for t in added))
        # printable ASCII, whose bytes stand for themselves, needs the file's
        # pattern only: composing leaves it alone and lower-casing is plain
        steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        plain = self.by_chunk and all("<" in t for t in special) and steps == ["NFC", "Replace", "Lowercase"]
        self.plain = regex.compile(split["pattern"]["Regex"]).findall if plain else None
        self.kept: dict[str, bytes] = {}

    # -- encoding ----------------------------------------------------------
    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words in the splitter's byte alphabet, four bytes each."""
        if not words:
            return []
        size = np.fromiter(map(len, words), np.int64, len(words))
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sym = self.inside[code]
        end = np.cumsum(size)
        sym[end - 1] = self.at_end[code[end - 1]]
        if (sym < 0).any():
            raise ValueError("the vocabulary lacks a byte")
        ids, of = self.merges.apply(sym, np.repeat(np.arange(len(words)), size))
        raw, cuts = ids.astype("<u4").tobytes(), (np.searchsorted(of, np.arange(len(words) + 1)) * 4).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def _words(self, chunk: str) -> list[str | int]:
        """Words of a chunk in the byte alphabet; ids of special tokens."""
        if self.plain and "<" not in chunk and chunk.isascii() and chunk.isprintable():
            return self.plain(chunk.lower())
        parts = self.parts.split(chunk) if self.parts and any(s in chunk for s in self.special) else [chunk]
        out: list[str | int] = []
        for p in parts:
            if p in self.special:
                out.append(self.special[p])
            elif p:
                p = self.normalizer.normalize_str(p) if self.normalizer else p
                out += [w for w, _ in self.splitter.pre_tokenize_str(p)] if self.splitter else [p]
        return out

    def _learn(self, chunks: list[str]) -> list[bytes]:
        """Ids of different chunks, from those kept or by merge rounds over
        all words that are new."""
        out = [self.kept.get(c) for c in chunks]
        new = [(i, self._words(chunks[i])) for i, b in enumerate(out) if b is None]
        words = list(dict.fromkeys(w for _, ws in new for w in ws if isinstance(w, str)))
        ids = dict(zip(words, self.encode_words(words)))
        if len(self.kept) + len(new) > KEPT_CHUNKS:
            self.kept.clear()
        for i, ws in new:
            out[i] = b"".join([ids[w] if isinstance(w, str) else w.to_bytes(4, "little") for w in ws])
            if len(chunks[i]) <= KEPT_CHARS and len(self.kept) < KEPT_CHUNKS:
                self.kept[chunks[i]] = out[i]
        return out

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets of the texts in them)."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.by_chunk:
            lists = pc.split_pattern(pc.replace_substring_regex(texts, f"[{BLANKS}]+", " "), " ")
            if not pa.types.is_large_list(lists.type):
                lists = lists.cast(pa.large_list(pa.large_string()))
            flat, ends = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        else:
            flat, ends = texts, np.arange(len(texts) + 1)
        coded = flat.dictionary_encode()
        found = self._learn(coded.dictionary.to_pylist())
        n = np.fromiter(map(len, found), np.int64, len(found)) // 4
        store, first = np.frombuffer(b"".join(found), "<u4"), np.cumsum(n) - n
        at = coded.indices.to_numpy()
        n = n[at]
        upto = np.concatenate([[0], np.cumsum(n)])
        place = np.repeat(first[at] - upto[:-1], n)
        place += np.arange(upto[-1])
        return store[place], upto[ends]

    # -- decoding ----------------------------------------------------------
    def decode_batch(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Text of each run of ids: vocabulary strings joined with blanks."""
        if not self.by_name:
            raise ValueError("only files without a decoder are decoded")
        names = self.names.take(pa.array(ids.astype(np.int64)))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), names), pa.scalar(" ", pa.large_string()))


def bpe(path: str) -> Bpe:
    """This worker's encoder for a vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    found = _LOADED[path]
    claim(found, found.kept.clear)
    return found


def _source(df: DataFrame, column) -> DataFrame:
    bounded_batches(df.sparkSession, ENCODED_ROWS)
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), column)


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, ids, n_tokens) per row of ``docs``: the ids as little-endian
    unsigned 32-bit integers."""
    path = vocabulary or default_vocabulary()

    def make(batches):
        model = bpe(path)
        for b in columns(batches):
            ids, ends = model.encode_batch(b["text"])
            raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1,
                                                   [None, pa.py_buffer((ends * 4).astype("<i8")), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([b["doc_id"], raw.cast(pa.binary()), pa.array(np.diff(ends))],
                                             names=["doc_id", "ids", "n_tokens"])
    return _source(docs, text_of().alias("text")).mapInArrow(make, "doc_id long, ids binary, n_tokens long")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, ids, n_tokens, decoded): the text that each row's ids stand
    for, beside what :func:`encode` gave."""
    path = vocabulary or default_vocabulary()

    def make(batches):
        model = bpe(path)
        for b in columns(batches):
            raw = b["ids"].cast(pa.large_binary())
            size = pc.fill_null(pc.binary_length(raw), 0).to_numpy() // 4
            ends = np.concatenate([[0], np.cumsum(size)])
            ids = np.frombuffer(b"".join(x for x in raw.to_pylist() if x), "<u4")
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["ids"], b["n_tokens"], model.decode_batch(ids, ends).cast(pa.string())],
                                             names=["doc_id", "ids", "n_tokens", "decoded"])
    bounded_batches(encoded.sparkSession, ENCODED_ROWS)
    return encoded.select("doc_id", "ids", "n_tokens").mapInArrow(make, "doc_id long, ids binary, n_tokens long, decoded string")
