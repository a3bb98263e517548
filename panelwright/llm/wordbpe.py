"""Token ids of whole texts with a `tokenizers` file.

The word-BPE vocabulary drops white space and never merges across it, so the
ids of a text are the ids of its white-space-separated chunks in order. Marks
behind a chunk's letters are words of their own where the letters stay letters
in the normaliser; any other chunk is encoded whole. Each worker encodes a chunk once with the library and keeps the ids of recent
chunks in a bounded table; ``tests/llm`` compares with whole-text encoding.
A tokenizer for which this does not hold (its normaliser, splitter or merges
look across blanks) is called on the whole text.
"""

from __future__ import annotations

import json
import os
import re
import string
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import claim

# Chunks kept by a worker (twice as many while generations change), and the
# longest chunk kept.
KEPT_CHUNKS = 400_000
KEPT_CHARS = 40

# Documents per batch to encode: a larger batch has fewer different chunks.
ENCODED_ROWS = 4000
_MARKS = string.punctuation
_LOADED: dict[str, "Encoder"] = {}


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec.get("normalizer") or {}).get("normalizers", [])
        split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        lower = any(s.get("type") == "Lowercase" for s in steps)
        self.by_chunk = (lower and split.get("type") == "Split" and split.get("behavior") == "Removed"
                         and split.get("invert") is True and "[^\\s" in (split.get("pattern") or {}).get("Regex", "")
                         and not any(t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"])
                                     for t in spec["added_tokens"]))
        # tokens that end a word: they tell the words of a joined text apart
        mark = spec["model"].get("end_of_word_suffix")
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[i] = bool(mark) and token.endswith(mark)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def forget(self) -> None:
        self.young, self.old = {}, {}

    def ids(self, text: str | None) -> bytes:
        """Ids of a text (null: empty) as little-endian unsigned 32-bit integers."""
        return self.ids_batch([text])[0]

    def ids_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text. The chunks of a batch are numbered, and each
        different one is looked up or encoded once."""
        if not self.by_chunk:
            return [_raw(self.tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]
        lists = pc.split_pattern(pa.array([_prepared(t or "") for t in texts], pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        found = self._learn(words)
        n = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, first = np.frombuffer(b"".join(found), "<u4"), np.cumsum(n) - n
        at = coded.indices.to_numpy()
        n = n[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        place = np.repeat(first[at] - ends[:-1], n)
        place += np.arange(ends[-1])
        ids = flat[place]
        cuts = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def _learn(self, words: list[str]) -> list[bytes]:
        """Ids of each of some different words."""
        young, old = self.young, self.old
        out = list(map(young.get, words))
        new, where = [], []
        for i, b in enumerate(out):
            if b is None:
                w = words[i]
                if (b := old.get(w)) is not None:
                    young[w] = out[i] = b
                else:
                    new.append(w)
                    where.append(i)
        got = self._encode(new)
        for i, w in zip(where, new):
            out[i] = got[w]
        young.update({w: b for w, b in got.items() if len(w) <= KEPT_CHARS})
        if len(young) > KEPT_CHUNKS:
            self.old, self.young = young, {}
        return out

    def _encode(self, new: list[str]) -> dict[str, bytes]:
        """Ids of chunks not seen lately, and of the words they consist of."""
        plain, rest, parts, young = [], {""}, [], self.young
        own = set(new)
        stems = set()
        for w in new:
            # an ASCII chunk has the ids of its lower case; letters and ASCII
            # marks behind them are two words to the splitter
            x = w.lower() if w.isascii() and "<|" not in w else w
            s = x if x.isalpha() else x.rstrip(_MARKS)
            if s == w:
                (plain.append if w.isalpha() else rest.add)(w)
            elif s.isalpha() and _one_word(s):
                m = x[len(s):]
                parts.append((w, s, m))
                rest.add(m)
                if s not in own and s not in young:
                    stems.add(s)
            else:
                rest.add(w)
        plain += stems
        got: dict[str, bytes] = {}
        joined = self.tokenizer.encode_batch_fast(["\n".join(plain)], add_special_tokens=False)[0]
        ids = np.array(joined.ids, "<u4")
        at = (np.flatnonzero(self.ends[ids]) + 1) * 4
        if len(at) == len(plain):       # every word is one run of tokens with one end
            raw, at = ids.tobytes(), at.tolist()
            got.update(zip(plain, [raw[a:b] for a, b in zip([0, *at], at)]))
        else:
            rest.update(plain)
        rest = list(rest)
        got.update(zip(rest, (_raw(e.ids) for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))))
        for w, s, m in parts:
            got[w] = (got[s] if s in got else young[s]) + got[m]
        return got


def _prepared(text: str) -> str:
    """Line ends and tabs as blanks; ASCII texts in lower case, as the
    normaliser makes them, for fewer different chunks."""
    if text.isascii() and "<|" not in text:
        text = text.lower()
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ")


def _one_word(stem: str) -> bool:
    """Whether the normaliser leaves letters only, so that marks behind the
    stem are a word of their own ("İ" becomes "i" and a mark, which the
    splitter joins to the marks that follow)."""
    if stem.isascii():
        return True
    low = stem.lower()
    return len(low) == len(stem) and low.isalpha() and unicodedata.is_normalized("NFC", stem)


def _raw(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    found = _LOADED[path]
    claim(found, found.forget)
    return found
