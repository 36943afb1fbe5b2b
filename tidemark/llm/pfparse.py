"""Repeated byte strings by prefix-free parsing.

Triggers of a rolling hash cut the texts into phrases in the same way wherever the same bytes stand: every string of
``length`` bytes is served by the trigger of least hash near its start, so equal strings are served by triggers at the
same place in them. A trigger carries its block, bytes that all strings it serves have in common; only triggers whose
block occurs again can serve a repeated string, which settles most of a corpus by one grouping of hashes. The rest is
ordered as in prefix-free parsing: the dictionary of what stands before a trigger is sorted from the trigger leftwards
and the text behind it rightwards, and a string is repeated when another one has both the same phrase suffix and the
same continuation. Both orders with their common lengths give this for all strings of a group of triggers at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bucketed, byte_column, having, slices, stored

#: Bytes of the rolling hash, and starts of strings among which a trigger is chosen.
HASHED, REACH = 16, 256

#: Triggers with one block that are ordered in one task; strings of larger groups are compared one by one, by hash.
GROUP_ROWS = 8192

_BASE = 0x9E3779B97F4A7C15
_PLACE = 31


def _doubled(x: np.ndarray, size: int, join) -> np.ndarray:
    """``join`` over each run of ``size`` (a power of two) entries; the last runs are cut off by the end."""
    step = 1
    while step < size:
        x = np.concatenate([join(x[:-step], x[step:], step), x[-step:]]) if step < len(x) else x
        step *= 2
    return x


def triggers(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, reach: int) -> tuple[np.ndarray, ...]:
    """(doc, trigger, first, last): each trigger, and the first and last start of the strings it serves.

    ``codes`` are the texts one after another from ``starts`` to ``ends``. A string is served by the least hash of its
    first ``reach`` positions, the rightmost of equal ones.
    """
    held = np.flatnonzero(ends - starts >= length)
    if not len(held):
        return (np.empty(0, np.int64),) * 4
    base = [pow(_BASE, 1 << k, 1 << 64) for k in range(5)]
    hashed = _doubled(codes.astype(np.uint64) + np.uint64(1), HASHED, lambda a, b, s: a * np.uint64(base[s.bit_length() - 1]) + b)
    hashed = (hashed ^ hashed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    places = np.uint64((1 << _PLACE) - 1) - np.arange(len(codes), dtype=np.uint64)
    least = _doubled(hashed >> np.uint64(_PLACE) << np.uint64(_PLACE) | places, reach, lambda a, b, s: np.minimum(a, b))
    n = ends[held] - starts[held] - length + 1
    doc = np.repeat(held, n)
    x = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[held], n)
    at = ((1 << _PLACE) - 1) - (least[x] & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]))
    last = np.append(cut[1:], len(x)) - 1
    return doc[cut], at[cut], x[cut], x[last]


def parse(texts: DataFrame, length: int, reach: int) -> DataFrame:
    """(row, first, last, at, block, context) of each trigger, of (row, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = xxhash.xxh3_64_intdigest, xxhash.xxh3_128_digest
        for part in slices(batches, limit=1_000_000):
            held = byte_column(part.column(1))
            joined = b"".join(held)
            ends = np.cumsum([len(t) for t in held])
            starts = ends - [len(t) for t in held]
            doc, at, first, last = triggers(np.frombuffer(joined, dtype=np.uint8), starts, ends, length, reach)
            rows = part.column(0).to_numpy(zero_copy_only=False)
            block, context = [], []
            for t, a, b in zip(at.tolist(), first.tolist(), last.tolist(), strict=True):
                block.append(hashes[0](joined[t : t + length - reach + 1]))
                context.append(hashes[1](b"%d %d " % (t - a, b - a) + joined[a : b + length]))
            zero = starts[doc] if len(doc) else doc
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[doc]), *(pa.array((v - zero).astype(np.int32)) for v in (first, last, at)),
                 pa.array(np.array(block, dtype=np.uint64).view(np.int64)), pa.array(context, pa.binary())],
                ["row", "first", "last", "at", "block", "context"],
            )

    return texts.mapInArrow(run, "row long, first int, last int, at int, block long, context binary")


def _order(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of byte strings and the length each has in common with the one before it in that order."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    size = max(map(len, parts))
    rows = np.frombuffer(b"".join(parts[k].ljust(size, b"\0") for k in order), dtype=np.uint8).reshape(len(parts), size)
    lengths = np.array([len(parts[k]) for k in order])
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), size) if size else np.zeros(len(parts) - 1, dtype=np.int64)
    return np.array(order), np.concatenate([[0], np.minimum(common, np.minimum(lengths[1:], lengths[:-1]))])


def repeated(left: list[bytes], right: list[bytes], least: np.ndarray, most: np.ndarray, copies: np.ndarray, length: int) -> np.ndarray:
    """(triggers, offsets) bool: whether the string that starts ``offset`` bytes before the trigger occurs again.

    ``left`` is what stands before each trigger, ``right`` what stands from it on; offsets from ``least`` to ``most``
    are served; ``copies`` is how often such a trigger occurs.
    """
    n = len(left)
    out = np.zeros((n, int(most.max()) + 1), dtype=bool)
    # Phrases from the trigger leftwards, and continuations.
    before, in_left = _order([x[::-1] for x in left])
    after, in_right = _order(right)
    suffix, rest = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for offset in range(int(least.min()), out.shape[1]):
        rows = np.flatnonzero((least <= offset) & (offset <= most))
        if not len(rows):
            continue
        suffix[before] = np.cumsum(in_left < offset)
        rest[after] = np.cumsum(in_right < length - offset)
        key = suffix[rows] * (n + 1) + rest[rows]
        sort = np.argsort(key, kind="stable")
        edge = np.flatnonzero(np.diff(key[sort], prepend=-1))
        times = np.add.reduceat(copies[rows][sort], edge)
        sizes = np.diff(np.append(edge, len(rows)))
        out[rows[sort], offset] = np.repeat(times > 1, sizes)
    return out


def _spans_by_order(rows: DataFrame, length: int, group_rows: int) -> DataFrame:
    """(row, begin, end) of repeated strings served by single triggers; ``rows`` of a block are ordered together."""

    def settle(cols: list[list]) -> pa.RecordBatch:
        _, row, at, least, most, copies, left, right = cols
        copies = np.array(copies)
        found = repeated(left, right, np.array(least), np.array(most), copies, length)
        found[copies > 1] = False
        edges = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        owner, low = np.nonzero(edges == 1)
        high = np.nonzero(edges == -1)[1] - 1
        at = np.array(at)[owner]
        out = [np.array(row, dtype=np.int64)[owner], at - high, at - low + length]
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in out], ["row", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(8)]
        for batch in batches:
            for h, c in zip(held, batch.columns, strict=True):
                h += c.to_pylist()
            block = held[0]
            if len(block) >= group_rows and block[0] != block[-1]:
                cut = block.index(block[-1])
                yield settle([h[:cut] for h in held])
                held = [h[cut:] for h in held]
        if held[0]:
            yield settle(held)

    cols = ("block", "row", "at", "least", "most", "copies", "left", "right")
    return rows.repartition("block").sortWithinPartitions("block").select(*cols).mapInArrow(run, "row long, begin long, end long")


def _spans_by_string(rows: DataFrame, length: int) -> DataFrame:
    """The same for groups of any size: each string is a row, whose copies are counted before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, at, least, most, copies, left, right in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = left + right
                # Entry k of the array is the string that starts at - most + k.
                digests = [xxhash.xxh3_128_digest(text[k : k + length]) for k in range(most - least + 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(digests)), pa.array(range(at - most, at - least + 1), pa.int64()), pa.array([copies] * len(digests)),
                     pa.array(digests, pa.binary())], ["row", "begin", "copies", "digest"])

    cols = ("row", "at", "least", "most", "copies", "left", "right")
    strings = stored(rows.select(*cols).mapInArrow(run, "row long, begin long, copies long, digest binary"), "strings")
    often = strings.groupBy("digest").agg(F.sum("copies").alias("times"), F.count_if(F.col("copies") == 1).alias("n")).where("times > 1 AND n > 0")
    found = having(strings.where("copies = 1"), stored(often.select("digest", "n"), "often"), "digest")
    return found.select("row", "begin", (F.col("begin") + length).alias("end"))


def repeated_spans(texts: DataFrame, length: int = 400, reach: int = REACH, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(row, spans): the merged byte ranges of each text that strings of ``length`` bytes cover which start anywhere else too.

    ``texts`` has (row, text), row being unique and text binary, and is read more than once. Texts shorter than
    ``length``, and texts without repeats, are not returned.
    """
    parsed = stored(parse(texts, length, reach), "phrases")
    again = stored(parsed.groupBy("block").agg(F.count("*").alias("n")).where("n > 1"), "again")
    shared = stored(having(parsed, again, "block").drop("n"), "shared")
    one = F.min(F.struct("row", "first", "last", "at"))
    contexts = stored(shared.groupBy("context").agg(F.count("*").alias("copies"), F.first("block").alias("block"), one.alias("one")), "contexts")
    # A context with copies is repeated as a whole; one without is open if its block has another context.
    whole = having(shared, contexts.where("copies > 1").select("context", F.col("copies").alias("n")), "context").select(
        "row", F.col("first").cast("long").alias("begin"), (F.col("last") + length).cast("long").alias("end")
    )
    blocks = contexts.groupBy("block").agg(F.count("*").alias("n"), F.min("copies").alias("least_copies"))
    blocks = stored(blocks.where("n > 1 AND least_copies = 1").select("block", "n"), "blocks")
    opened = having(contexts, blocks, "block").select("block", F.col("n").alias("rows"), "copies", "one.*")
    asked = opened.groupBy("row").agg(F.collect_list(F.struct("block", "rows", "copies", "first", "last", "at")).alias("asked"))
    cut = texts.join(asked, "row").select("row", "text", F.explode("asked").alias("a")).select("row", "text", "a.*")
    # F.substring counts bytes of a binary from 1.
    opened = cut.select(
        "block", "rows", "row", F.col("copies").cast("long").alias("copies"), F.col("at").cast("long").alias("at"),
        (F.col("at") - F.col("last")).alias("least"), (F.col("at") - F.col("first")).alias("most"),
        F.substring("text", F.col("first") + 1, F.col("at") - F.col("first")).alias("left"),
        F.substring("text", F.col("at") + 1, F.col("last") + length - F.col("at")).alias("right"),
    )
    opened = stored(opened, "open")
    found = whole.unionAll(_spans_by_order(opened.where(F.col("rows") <= group_rows), length, group_rows))
    found = found.unionAll(_spans_by_string(opened.where(F.col("rows") > group_rows), length))
    by_row = Window.partitionBy("row").orderBy("begin", "end")
    reach_before = F.max("end").over(by_row.rowsBetween(Window.unboundedPreceding, -1))
    group = F.sum(F.when(F.col("begin") <= F.col("reach"), 0).otherwise(1)).over(by_row.rowsBetween(Window.unboundedPreceding, 0))
    merged = found.withColumn("reach", reach_before).withColumn("run", group).groupBy("row", "run").agg(
        F.min("begin").alias("begin"), F.max("end").alias("end")
    )
    return merged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, reach: int = REACH,
                   group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per document: id, ``bytes`` of the text, ``spans`` removed (array of begin, end) and ``kept`` bytes.

    Removed is every byte covered by a string of ``length`` bytes that also starts anywhere else, in any row or the same
    one, overlaps included, all judged on the input. NULL texts count as empty; texts shorter than ``length`` are kept
    whole; repeated rows remove each other. Repeated and NULL ids are rows of their own; an empty table gives no rows;
    extra columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    numbered = docs.select(F.col(id_col).alias("doc"), text.alias("text"), F.monotonically_increasing_id().alias("row"))
    # Texts are shuffled this once; the joins below bring triggers and spans to them.
    texts = bucketed(numbered, "row", "text", "numbered")
    spans = stored(repeated_spans(texts.select("row", "text"), length, reach, group_rows), "repeats")
    start = F.struct(F.lit(b"").alias("kept"), F.lit(0).cast("long").alias("at"))

    def piece(begin, end):
        return F.substring("text", begin.cast("int") + 1, (end - begin).cast("int"))

    def keep(done, s):
        return F.struct(F.concat(done["kept"], piece(done["at"], s["begin"])).alias("kept"), s["end"].alias("at"))

    size = F.octet_length("text").cast("long")
    kept = F.aggregate("spans", start, keep, lambda done: F.concat(done["kept"], piece(done["at"], size)))
    return texts.join(spans, "row", "left").select(
        F.col("doc").alias(id_col), size.alias("bytes"),
        F.coalesce("spans", F.array().cast("array<struct<begin:bigint,end:bigint>>")).alias("spans"),
        F.when(F.col("spans").isNull(), F.col("text")).otherwise(kept).alias("kept"),
    )
