"""Secrets in texts: fixed patterns, and random strings exposed by their low token efficiency.

A byte-pair vocabulary packs words into few tokens and random strings into many. A run of key characters is a secret
when it yields fewer than ``MAX_RATIO`` characters per token, letters alone included, unless it is a known digest or an
identifier.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import from_texts
from .tokens import RANKS, rank_encoding

# Kinds in their order, and the patterns that define the first three.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = rb"AKIA[A-Z0-9]+"
ACCESS_LEAST = 20
HEX_LEAST = 24

#: Shortest run of key characters that is tested, and the characters per token below which it is random.
RANDOM_LEAST = 20
MAX_RATIO = 2.2

# Lengths of hexadecimal digests (MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512).
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
UUID = rb"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"

_HEX_CHARS = np.isin(np.arange(256), list(b"0123456789abcdef"))
_JOINT = rb"[+/_=-]+"
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\f\v"))
_KEY_CHARS = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"))


def _runs(member: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal runs of at least ``least`` members."""
    edge = np.flatnonzero(np.diff(member.astype(np.int8), prepend=0, append=0))
    start, end = edge[::2], edge[1::2]
    long = end - start >= least
    return list(zip(start[long].tolist(), end[long].tolist(), strict=True))


def is_known(run: bytes) -> bool:
    """Whether a run is a digest, a UUID, or numbers joined by separators (dates, versions, telephone numbers)."""
    if len(run) in DIGEST_LENGTHS and re.fullmatch(rb"[0-9a-f]+|[0-9A-F]+", run):
        return True
    return bool(re.fullmatch(UUID, run) or re.fullmatch(rb"[0-9+/_=-]+", run))


def tokens_of(run: bytes, encode) -> int:
    """Tokens of a run. Separators of a name (parts of letters or of digits alone) read as spaces: they are no sign of chance."""
    name = all(re.fullmatch(rb"[A-Za-z]*|[0-9]*", part) for part in re.split(_JOINT, run))
    return len(encode((re.sub(_JOINT, b" ", run) if name else run).decode()))


def _addresses(joined: bytes, codes: np.ndarray):
    """A function of rising positions: whether the word there, up to white space on both sides, is a URL or an address.

    The whole word counts, however long; each is looked at once.
    """
    gaps = np.flatnonzero(_SPACE[codes])
    start, end, found = 0, 0, False

    def inside(position: int) -> bool:
        nonlocal start, end, found
        if position >= end:
            k = int(np.searchsorted(gaps, position))
            start, end = int(gaps[k - 1]) + 1 if k else 0, int(gaps[k]) if k < len(gaps) else len(joined)
            found = joined.find(b"://", start, end) >= 0 or joined.find(b"@", start, end) >= 0
        return found

    return inside


def find_secrets(texts: list[bytes], encode) -> list[list[tuple[int, int, int]]]:
    """Spans (kind number, start, end) of each UTF-8 text in code points, sorted by start, kind and end."""
    assign, access = re.compile(ASSIGN, re.I), re.compile(ACCESS)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, text in enumerate(texts):
        found[k] += [(0, *m.span()) for m in assign.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
        if b"AKIA" in text:
            found[k] += [(1, *m.span()) for m in access.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    joined = b"\n".join(texts)
    codes = np.frombuffer(joined, dtype=np.uint8)

    def at(position: int) -> tuple[int, int]:
        k = int(np.searchsorted(starts, position, side="right")) - 1
        return k, int(starts[k])

    for a, b in _runs(_HEX_CHARS[codes], HEX_LEAST):
        k, zero = at(a)
        found[k].append((2, a - zero, b - zero))
    # Of each text: the starts of its spans so far, and the furthest end up to each.
    covered, added = {}, []
    is_address = _addresses(joined, codes)
    for a, b in _runs(_KEY_CHARS[codes], RANDOM_LEAST):
        run = joined[a:b]
        k, zero = at(a)
        if found[k] and k not in covered:
            spans = sorted(x[1:] for x in found[k])
            covered[k] = [x for x, _ in spans], list(accumulate((y for _, y in spans), max))
        before = bisect_left(covered[k][0], b - zero) if k in covered else 0
        if before and covered[k][1][before - 1] > a - zero:
            continue
        if not is_address(a) and not is_known(run) and len(run) < MAX_RATIO * tokens_of(run, encode):
            added.append((k, (3, a - zero, b - zero)))
    for k, span in added:
        found[k].append(span)
    for k, spans in enumerate(found):
        if spans and not texts[k].isascii():
            chars = np.cumsum(np.frombuffer(texts[k], dtype=np.uint8) & 0xC0 != 0x80)
            spans[:] = [(kind, int(chars[a]) - 1, int(chars[b - 1])) for kind, a, b in spans]
        spans.sort(key=lambda x: (x[1], x[0], x[2]))
    return found


def secrets(docs: DataFrame, text_col: str = "text", ranks: str | None = None, name: str = "secrets") -> DataFrame:
    """``docs`` with ``name``: array of (kind, start, end), code points, end exclusive, by start, kind and end.

    The first three kinds are leftmost, non-overlapping matches of their patterns that are long enough, each kind for
    itself; ``random`` runs are added where none of these lies. NULL and empty texts have no spans; each row is judged
    for itself, whatever its id; other columns, the text included, pass through. ``ranks`` is the tiktoken file.
    """
    path = ranks or public_tokenizers.path(RANKS)
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def make():
        encode = rank_encoding(path).encode_ordinary

        def compute(texts: list[bytes]) -> list[pa.Array]:
            found = find_secrets(texts, encode)
            rows = [[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans] for spans in found]
            return [pa.array(rows, pa.list_(kind))]

        return compute

    return from_texts(docs, text_col, f"{name} array<struct<kind:string,start:int,end:int>>", make)


def redacted(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """The text with each maximal stretch that ``spans`` (sorted by start) cover replaced by ``mask``."""
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def cut(done, x):
        gap = F.substring(text, done["at"] + 1, x["start"] - done["at"])
        out = F.when(x["start"] < done["at"], done["out"]).otherwise(F.concat(done["out"], gap, F.lit(mask)))
        return F.struct(out.alias("out"), F.greatest(done["at"], x["end"]).alias("at"))

    return F.aggregate(spans, state, cut, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
