"""Secret scan: keyword prefilter, anchored patterns, embedded checksums.

An Aho-Corasick automaton finds the keywords of all kinds in one pass over a
text; a kind's pattern is matched only at (anchored to) its keyword's hits,
so text without keywords costs the automaton alone. Runs of hexadecimal
digits have no keyword: their anchor is a pair of neighbouring sample points,
half a run's least length apart, that are both such digits. Kinds whose
tokens carry a checksum are reported only if it holds.

Spans are in code points, end exclusive, leftmost and without overlap within
a kind; matches shorter than a kind's least length are dropped (and still
consume their text). Null and empty texts have no span; texts of any length
are scanned whole; repeated rows and null ids are scanned like any other; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, columns, packed, text_of

BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc_base62(body: bytes) -> bytes:
    """CRC-32 as six base-62 digits, as GitHub and npm tokens end with."""
    n, out = zlib.crc32(body), b""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = BASE62[r:r + 1] + out
    return out


def _crc_ok(m: re.Match) -> bool:
    return crc_base62(m.group(1)) == m.group(2)


def _iban_ok(m: re.Match) -> bool:
    s = m.group(1)
    digits = "".join(str(int(chr(c), 36)) for c in s[4:] + s[:4])
    return int(digits) % 97 == 1


@dataclass(frozen=True)
class Kind:
    name: str
    keywords: tuple[str, ...]              # lower case
    pattern: re.Pattern                    # over UTF-8 bytes, starts at a keyword
    least: Callable[[re.Match], bool]      # on a match: long enough and valid


# Fixed patterns: the first three are the base kinds, in their order.
KINDS = (
    Kind("assign", ("password", "passwd", "secret", "token", "apikey", "api_key"),
         re.compile(rb"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
                    rb"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
         lambda m: len(m.group(1)) >= 8),
    Kind("access", ("akia",), re.compile(rb"AKIA[A-Z0-9]+"), lambda m: m.end() - m.start() >= 16),
    Kind("hex", (), re.compile(rb"[0-9a-f]+"), lambda m: m.end() - m.start() >= 32),
    Kind("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
         re.compile(rb"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"), _crc_ok),
    Kind("npm", ("npm_",), re.compile(rb"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"), _crc_ok),
    Kind("iban", ("iban",), re.compile(rb"[Ii][Bb][Aa][Nn][: ]{1,3}([A-Z]{2}[0-9]{2}[A-Z0-9]{11,30})(?![A-Za-z0-9])"), _iban_ok),
)
BASE = ("assign", "access", "hex")
_HEX = bytes(1 if chr(c) in "0123456789abcdef" else 0 for c in range(256))
_STEP = 16
_AUTOMATON = []


def _automaton():
    if not _AUTOMATON:
        import ahocorasick
        a = ahocorasick.Automaton()
        by_word: dict[str, list[int]] = {}
        for i, k in enumerate(KINDS):
            for w in k.keywords:
                by_word.setdefault(w, []).append(i)
        for w, kinds in by_word.items():
            a.add_word(w, (len(w), kinds))
        a.make_automaton()
        _AUTOMATON.append(a)
    return _AUTOMATON[0]


def scan(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret, by start, then in the kinds' order."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    found = []                      # (start, end, kind number) in bytes
    # positions in code points of the text, ASCII letters lower-cased
    hits = list(_automaton().iter(text.lower() if text.isascii() else raw.lower().decode("utf-8", "surrogatepass")))
    if hits:
        at_byte = _byte_positions(text, raw, [end - n + 1 for end, (n, _) in hits])
        last: dict[int, int] = {}
        for p, (_, (_, kinds)) in sorted(zip(at_byte, hits), key=lambda x: x[0]):
            for i in kinds:
                k = KINDS[i]
                if p < last.get(i, 0):
                    continue
                if m := k.pattern.match(raw, p):
                    last[i] = m.end()
                    if k.least(m):
                        found.append((m.start(), m.end(), i))
    # a run of 32 digits covers two neighbouring points of every 16th byte
    points = raw[_STEP - 1::_STEP].translate(_HEX)
    at, end = points.find(b"\1\1"), 0
    while at >= 0:
        mid = at * _STEP + _STEP - 1
        if mid >= end:
            lo = mid
            while lo > 0 and _HEX[raw[lo - 1]]:
                lo -= 1
            m = KINDS[2].pattern.match(raw, lo)
            end = m.end()
            if KINDS[2].least(m):
                found.append((lo, end, 2))
        at = points.find(b"\1\1", max(at + 1, (end - _STEP + 1) // _STEP))
    found.sort(key=lambda x: (x[0], x[2]))
    if len(raw) != len(text) and found:
        edges = _char_positions(raw, [x for s, e, _ in found for x in (s, e)])
        found = [(edges[s], edges[e], i) for s, e, i in found]
    return [(s, e, KINDS[i].name) for s, e, i in found]


def _byte_positions(text: str, raw: bytes, at: list[int]) -> list[int]:
    if len(raw) == len(text):
        return at
    where, done, n = {}, 0, 0
    for p in sorted(set(at)):
        n += len(text[done:p].encode("utf-8", "surrogatepass"))
        where[p], done = n, p
    return [where[p] for p in at]


def _char_positions(raw: bytes, at: list[int]) -> dict[int, int]:
    where, done, n = {}, 0, 0
    for p in sorted(set(at)):
        n += len(raw[done:p].decode("utf-8", "surrogatepass"))
        where[p], done = n, p
    return where


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): ``spans`` is an array of (kind, start, end)."""
    def make(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in columns(batches):
            spans = [[{"kind": k, "start": s, "end": e} for s, e, k in scan(t)] for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(spans, kind)], names=["doc_id", "spans"])
    bounded_batches(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return src.mapInArrow(make, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def mask(text: str | None) -> str | None:
    """The text with every secret replaced by ``[kind]``; of overlapping
    secrets the first one's kind stands for all."""
    found = scan(text)
    if not found:
        return text
    out, done = [], 0
    cover = 0
    for s, e, k in found:
        if s >= cover:
            out += [text[done:s], f"[{k}]"]
        cover = done = max(cover, e)
    return "".join([*out, text[done:]])


def mask_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets in ``text`` masked; every row stays. A column
    ``n_chars`` is set to the new length of texts that changed."""
    def make(batches):
        for b in batches:
            if b.num_rows:
                i = b.schema.get_field_index("text")
                yield b.set_column(i, "text", pa.array([mask(t) for t in b.column(i).to_pylist()], pa.string()))
    bounded_batches(docs.sparkSession)
    rows = packed(docs).withColumn("text", F.col("text").cast("string"))
    made = rows.mapInArrow(make, rows.schema)
    changed = ~F.col("text").eqNullSafe(F.col("row.text"))

    def column(c):
        if c == "text":
            return F.col("text").alias(c)
        if c == "n_chars":
            kind = docs.schema[c].dataType
            return F.when(changed, F.length("text")).otherwise(F.col("row.n_chars")).cast(kind).alias(c)
        return F.col(f"row.`{c}`").alias(c)
    return made.select(*[column(c) for c in docs.columns])
