"""Benchmark passages in training documents, found with a distributed positional inverted index.

The index is partitioned by document: each shard (a few MB of text) is one stored row with the posting lists of the
test terms, as positions in the shard. A test window is looked up from its locally rarest term: that term's positions,
less its offset, are the candidate starts, and the offset-adjusted lists of the other terms are intersected with them
in order of rarity. Nothing is shuffled, so a frequent word or passage makes no hot key; a window's work is the length
of its rarest list in the shard. Test items are sent in blocks of bounded size, one pass each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_column, slices, stored

#: Bytes of item text sent to the tasks at once.
BLOCK_BYTES = 16_000_000

#: Candidate starts examined at once.
CANDIDATES = 2_000_000

_WORD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

INDEX_SCHEMA = (
    "docs array<string>, starts array<int>, lengths array<int>, terms array<int>, counts array<int>, "
    "positions array<int>"
)


def words_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters (A-Z as a-z), digits and non-ASCII characters."""
    return text.translate(_WORD).split()


class Windows(NamedTuple):
    """Distinct word windows of some items."""

    ids: dict[bytes, int]  # of their words
    terms: np.ndarray  # a window's term ids, -1 behind a short one
    lengths: np.ndarray
    items: list[list[str]]  # that hold the window


def windows_of(items: list[tuple[str, bytes]], size: int) -> Windows:
    ids: dict[bytes, int] = {}
    found: dict[tuple, set[str]] = {}
    for item, text in items:
        words = [ids.setdefault(w, len(ids)) for w in words_of(text)]
        for a in range(max(1, len(words) - size + 1) if words else 0):
            found.setdefault(tuple(words[a : a + size]), set()).add(item)
    terms = np.full((len(found), size), -1, dtype=np.int32)
    for row, window in enumerate(found):
        terms[row, : len(window)] = window
    return Windows(ids, terms, (terms >= 0).sum(axis=1), [sorted(x) for x in found.values()])


def positional_index(docs: DataFrame, vocabulary, gap: int) -> DataFrame:
    """Postings of the terms of ``vocabulary`` (a broadcast of word -> id) in (doc, text), a row per shard.

    Documents of a shard lie behind one another with ``gap`` empty positions between, so no match crosses documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.value.get
        for part in slices(batches):
            starts, lengths, found, at = [], [], [], 0
            for text in byte_column(part.column(1)):
                words = words_of(text)
                terms = np.fromiter(map(get, words, repeat(-1)), dtype=np.int32, count=len(words))
                here = np.flatnonzero(terms >= 0)
                found.append(np.stack([terms[here], here + at]))
                starts.append(at)
                lengths.append(len(words))
                at += len(words) + gap
            terms, positions = np.concatenate(found, axis=1)
            order = np.argsort(terms, kind="stable")
            known, counts = np.unique(terms, return_counts=True)
            numbers = [pa.array(x, pa.int32()) for x in (starts, lengths, known, counts, positions[order])]
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays([0, len(x)], x) for x in (part.column(0), *numbers)],
                ["docs", "starts", "lengths", "terms", "counts", "positions"],
            )

    return docs.mapInArrow(run, INDEX_SCHEMA)


def matches(at: np.ndarray, counts: np.ndarray, positions: np.ndarray, firsts: np.ndarray, terms: np.ndarray,
            slop: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(window, start) of matches in one shard; every term lies within ``slop`` words of its place in the window.

    ``at`` has the term at each position, which makes the intersection with a term's offset-adjusted list one look-up.
    """
    here = np.where(terms >= 0, counts[terms], np.iinfo(np.int64).max)
    order = np.argsort(here, axis=1, kind="stable")
    rows = np.arange(len(here))
    rarest = here[rows, order[:, 0]] if len(here) else np.empty(0, np.int64)
    live = rows[rarest > 0]
    for part in np.split(live, np.flatnonzero(np.diff(np.cumsum(rarest[live]) // CANDIDATES)) + 1):
        n = rarest[part]
        window = np.repeat(part, n)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        anchor = order[window, 0]
        start = positions[firsts[terms[window, anchor]] + nth] - anchor
        for k in range(1, terms.shape[1]):
            if not len(window):
                break
            offset = order[window, k]
            term = terms[window, offset]
            hit = term < 0
            for d in range(-slop, slop + 1):
                hit |= at.take(start + offset + d, mode="clip") == term
            window, start = window[hit], start[hit]
        # A window that begins before its document would have met the gap; the first document has none before it.
        yield window[start >= 0], start[start >= 0]


def _runs(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


HIT_SCHEMA = "doc string, n_words long, spans array<struct<start:int,end:int>>, items array<string>, near array<string>"


def _search(index: DataFrame, windows, slop: int) -> DataFrame:
    """For each document of the index: its words, hit word spans, items with phrase and with proximity matches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_terms, terms_of, window_lengths, window_items = windows.value
        size = terms_of.shape[1]
        for batch in batches:
            for k in range(batch.num_rows):
                docs, *cols = (c[k].values for c in batch.columns)
                starts, lengths, terms, n, positions = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in cols)
                counts = np.zeros(n_terms, dtype=np.int64)
                counts[terms] = n
                firsts = np.cumsum(counts) - counts
                span = int(starts[-1] + lengths[-1]) + size + slop
                at = np.full(span, -2, dtype=np.int32)
                at[positions] = np.repeat(terms, n)
                covered = np.zeros(span, dtype=np.int64)
                items: list[set[str]] = [set() for _ in starts]
                near: list[set[str]] = [set() for _ in starts]
                for reach, into in ((0, items), (slop, near)) if slop else ((0, items),):
                    for window, start in matches(at, counts, positions, firsts, terms_of, reach):
                        if not reach:
                            np.add.at(covered, start, 1)
                            np.add.at(covered, start + window_lengths[window], -1)
                        doc = np.searchsorted(starts, start, side="right") - 1
                        for d, x in set(zip(doc.tolist(), window.tolist(), strict=True)):
                            into[d].update(window_items[x])
                begin, end = _runs(np.cumsum(covered) > 0)
                owner = np.searchsorted(starts, begin, side="right") - 1
                spans: list[list[dict]] = [[] for _ in starts]
                for d, a, b in zip(owner.tolist(), begin.tolist(), end.tolist(), strict=True):
                    spans[d].append({"start": a - int(starts[d]), "end": b - int(starts[d])})
                yield pa.RecordBatch.from_arrays(
                    [docs, pa.array(lengths), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                     pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                     pa.array([sorted(x) for x in near], pa.list_(pa.string()))],
                    ["doc", "n_words", "spans", "items", "near"],
                )

    return index.mapInArrow(run, HIT_SCHEMA)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", size: int = 10, slop: int = 2,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: id, ``n_words``, ``spans`` of hit words, ``items`` with phrase and ``near`` with proximity matches.

    A window is ``size`` consecutive words of an item, or all words of a shorter item. ``spans`` are the merged word
    ranges [start, end) of exact occurrences; ``near`` lists items of which some window has each term within ``slop``
    words of its place (exact ones included). Item ids are texts, distinct and sorted; a NULL item id counts as ''.
    NULL, empty and wordless texts have no words and no hits, and such items no windows. Rows with repeated or NULL
    document ids are judged each for itself. Empty tables give no rows or no hits; extra columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("string").alias("doc"), F.col(text_col).cast("binary").alias("text"))
    asked = items.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text).cast("binary").alias("text")
    ).where("text IS NOT NULL")
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    if blocks > 1:
        texts = stored(texts.withColumn("row", F.monotonically_increasing_id()), "numbered").select(
            F.to_json(F.struct("row", "doc")).alias("doc"), "text"
        )
    gap = size + slop
    found = None
    for block in range(blocks):
        held = asked.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).toArrow()
        windows = windows_of(list(zip(held["item"].to_pylist(), held["text"].to_pylist(), strict=True)), size)
        sent = spark.sparkContext.broadcast((len(windows.ids), *windows[1:]))
        index = stored(positional_index(texts, spark.sparkContext.broadcast(windows.ids), gap), "postings")
        part = _search(index, sent, slop)
        found = part if found is None else found.unionAll(part)
    if blocks > 1:
        # A document's few partial results: one from each block.
        merged = found.groupBy("doc").agg(
            F.max("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))).alias("near"),
        )
        found = merged.select(
            F.get_json_object("doc", "$.doc").alias("doc"), "n_words", _merge_spans(F.col("spans")).alias("spans"), "items", "near"
        )
    kind = docs.schema[id_col].dataType
    return found.select(F.col("doc").cast(kind).alias(id_col), "n_words", "spans", "items", "near")


def _merge_spans(spans):
    """Sorted spans with those that overlap or touch joined."""
    empty = F.slice(F.array_sort(spans), 1, 0)

    def add(done, x):
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= x["start"]), F.concat(
            F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(spans), empty, add)
