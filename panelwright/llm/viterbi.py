"""SentencePiece pieces by streaming Viterbi.

The best segmentation under a model's piece scores (the unigram reading of a
SentencePiece vocabulary; a character without a piece costs the smallest
score less ten and is written as its UTF-8 byte pieces). Text streams in:
only the boundaries within the longest piece's length of the read position
can start a later piece, so when the backpointer paths of all of them meet in
one boundary, the ids up to it are final and are committed, and the window
moves on. Where the vocabulary has no piece across a word start, every word
start is such a meeting point; words are then encoded on their own and the
ids of recent short words are kept in a bounded table. A word shorter than the
window never commits early: its best path is found in one pass over a tree of
the pieces' characters.

Blanks become U+2581 and one is put before the text, as the vocabulary's
normaliser does; decoding undoes both (a U+2581 of the text itself decodes as
a blank). Null and empty texts have no ids; texts of any length stream
through the same window; repeated rows and null ids are kept as they come.
"""

from __future__ import annotations

import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, claim, columns, text_of

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
KEPT_WORDS = 400_000
KEPT_CHARS = 40

_LOADED: dict[str, "Pieces"] = {}


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """Piece table of a SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece as spm
        sp = spm.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.bytes = [b""] * n
        self.byte_id = [sp.unk_id()] * 256
        for i in range(n):
            p = sp.id_to_piece(i)
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                self.bytes[i] = bytes([int(p[3:5], 16)])
                continue
            self.ids[p], self.score[p] = i, sp.get_score(i)
            self.bytes[i] = p.replace(SPACE, " ").encode()
        self.unknown = min(self.score.values()) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.ids))
        self.tails = {p[k:] for p in self.ids for k in range(len(p))}
        self.word_starts = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        lone = [c for c in "\n\t" if not any(c in p and len(p) > 1 for p in self.ids)]
        inner = "".join(map(re.escape, lone))
        #: words of a blanks-first text; a character in no longer piece is a word
        self.words = re.compile((f"[{inner}]|" if lone else "") + f" *[^ {inner}]+| +")
        self.kept: dict[str, bytes] = {}
        self.window = 4 * self.longest
        self.tree = self._tree()

    def _tree(self) -> dict:
        """Character -> (later characters or None, score or None, id) of the
        piece read so far; a first character that is no piece is unknown."""
        root: dict = {}
        for p, i in self.ids.items():
            node = root
            for c in p[:-1]:
                edge = node.setdefault(c, [{}, None, -1])
                if edge[0] is None:
                    edge[0] = {}
                node = edge[0]
            edge = node.setdefault(p[-1], [None, None, -1])
            edge[1], edge[2] = self.score[p], i
        for edge in root.values():
            if edge[1] is None:
                edge[1] = self.unknown
        return root

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        text = " " + text.replace(SPACE, " ")
        if not self.word_starts:
            return self._stream(text.replace(" ", SPACE))
        kept, out = self.kept, []
        for w in self.words.findall(text):
            ids = kept.get(w)
            if ids is None:
                spaced = w.replace(" ", SPACE)
                ids = self._short(spaced) if len(w) < self.window else self._stream(spaced)
                if len(w) <= KEPT_CHARS:
                    if len(kept) >= KEPT_WORDS:
                        kept.clear()
                    kept[w] = ids
            out.append(ids)
        return b"".join(out)

    def _short(self, text: str) -> bytes:
        """As :meth:`_stream` for a text that ends within the window."""
        n, tree, strange = len(text), self.tree, (None, self.unknown, -1)
        best, back, ident = [float("-inf")] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for lo in range(n):
            base, at = best[lo], lo
            node, v, i = tree.get(text[lo], strange)
            while True:
                at += 1
                # ends are met by their longest piece first, which wins when equal
                if v is not None and (v := base + v) > best[at]:
                    best[at], back[at], ident[at] = v, lo, i
                if node is None or at == n or (edge := node.get(text[at])) is None:
                    break
                node, v, i = edge
        out, at = [], n
        while at:
            lo, i = back[at], ident[at]
            out += [i] if i >= 0 else [self.byte_id[x] for x in reversed(text[lo:at].encode("utf-8", "surrogatepass"))]
            at = lo
        return struct.pack(f"<{len(out)}I", *reversed(out))

    def _stream(self, text: str) -> bytes:
        s, out = StreamingViterbi(self), []
        for lo in range(0, len(text), 4096):
            out += s.feed(text[lo:lo + 4096])
        out += s.finish()
        return np.array(out, "<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 bytes of the text."""
        table = self.bytes
        raw = b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])
        return raw[1:] if raw[:1] == b" " else raw


class StreamingViterbi:
    """Best path over the characters fed so far, kept from the last committed
    boundary on. Of equal paths the one with the longer last piece wins."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.text = ""                 # from the committed boundary on
        self.best = [0.0]              # score of the best path to each boundary
        self.back = [0]                # start of its last piece
        self.check = pieces.window
        self.widest = 0                # most characters ever held (for tests)

    def feed(self, chars: str) -> list[int]:
        p, out = self.p, []
        score, tails, longest, unknown = p.score, p.tails, p.longest, p.unknown
        at = len(self.text)
        self.text += chars
        end = len(self.text)
        best, back = self.best, self.back
        while at < end:
            at += 1
            text = self.text
            one = score.get(text[at - 1])
            top, frm = best[at - 1] + (unknown if one is None else one), at - 1
            for n in range(2, min(longest, at) + 1):
                s = text[at - n:at]
                if s not in tails:
                    break
                v = score.get(s)
                if v is not None and (v := best[at - n] + v) >= top:
                    top, frm = v, at - n
            best.append(top)
            back.append(frm)
            if at >= self.check:
                cut = self._meeting(at)
                if cut:
                    out += self._path(cut)
                    self.text = self.text[cut:]
                    base = best[cut]
                    self.best = best = [x - base for x in best[cut:]]
                    self.back = back = [0] + [x - cut for x in back[cut + 1:]]
                    at, end = at - cut, end - cut
                self.widest = max(self.widest, at)
                self.check = at + longest
        return out

    def _meeting(self, at: int) -> int:
        """The last boundary on the paths of all boundaries a later piece can
        start at."""
        live = set(range(max(0, at - self.p.longest + 1), at + 1))
        while len(live) > 1:
            top = max(live)
            live.discard(top)
            live.add(self.back[top])
        return live.pop()

    def _path(self, at: int) -> list[int]:
        p, out = self.p, []
        while at:
            frm = self.back[at]
            piece = self.text[frm:at]
            i = p.ids.get(piece)
            out += [i] if i is not None else [p.byte_id[x] for x in reversed(piece.encode("utf-8", "surrogatepass"))]
            at = frm
        return out[::-1]

    def finish(self) -> list[int]:
        out = self._path(len(self.text))
        self.__init__(self.p)
        return out


def pieces(path: str) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    found = _LOADED[path]
    claim(found, found.kept.clear)
    return found


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids, n_tokens, decoded) per row of ``docs``: the ids as
    little-endian unsigned 32-bit integers, and the text decoded from them."""
    model = model or default_model()

    def make(batches):
        sp = pieces(model)
        for b in columns(batches):
            ids = [sp.encode(t) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array([sp.decode(x).decode("utf-8", "replace") for x in ids], pa.string())],
                names=["doc_id", "ids", "n_tokens", "decoded"])
    bounded_batches(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return src.mapInArrow(make, "doc_id long, ids binary, n_tokens long, decoded string")
