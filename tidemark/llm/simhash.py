"""SimHash near-duplicate detection with bit-sliced comparison.

A text is a bag of word shingles; its fingerprint takes the majority of each bit of their XXH64 values. Equal
fingerprints collapse first (one grouping, combined before the shuffle). Each distinct fingerprint then enters buckets
in which every pair within the radius meets at least once, and ``bitslice.forest`` compares the rows of a bucket as
vertical bit planes. A bucket gives at most one link per row, never its pairs; components of the links are the groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bitslice import forest
from .common import LOWER, free_name, from_texts, stored
from .graph import components

#: Rows of a bucket that one comparison holds. Larger buckets are compared block by block, each pair of blocks a task.
BLOCK_ROWS = 2048


def shingle_hashes(text: bytes, words: int, seed: int) -> np.ndarray:
    """XXH64 of each run of ``words`` words, repeats included; of all words if they are fewer; none without words.

    Words are what lies between ASCII white space; A-Z count as a-z.
    """
    found = text.translate(LOWER).split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(words, len(found))
    spans = zip(starts[: len(found) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in spans), dtype=np.uint64, count=len(found) - k + 1)


def majority(hashes: np.ndarray, chunk: int = 1 << 16) -> int:
    """Bits set in over half of the hashes; zero for none."""
    ones = np.zeros(64, dtype=np.int64)
    for a in range(0, len(hashes), chunk):
        part = hashes[a : a + chunk].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", words: int = 4, seed: int = 42, name: str = "simhash"):
    """``docs`` without its text and with a long ``name``: the fingerprint's 64 bits.

    NULL, empty and blank texts have fingerprint zero. Other columns pass through, whatever their names.
    """

    def make():
        def compute(texts: list[bytes]) -> list[pa.Array]:
            bits = [majority(shingle_hashes(t, words, seed)) for t in texts]
            return [pa.array(np.array(bits, dtype=np.uint64).view(np.int64))]

        return compute

    return from_texts(docs, text_col, f"{name} long", make, keep_text=False)


def pigeonhole(bits: Column, radius: int) -> Column:
    """Array of (plan, key): fingerprints within ``radius`` bits share at least one.

    The 64 bits fall into radius + 2 blocks, of which at most ``radius`` can differ; each pair of blocks is a key.
    """
    edges = [round(64 * i / (radius + 2)) for i in range(radius + 3)]
    keys = []
    for n, (a, b) in enumerate(combinations(range(radius + 2), 2)):
        mask = sum(1 << p for k in (a, b) for p in range(edges[k], edges[k + 1]))
        mask -= (mask >> 63) << 64
        keys.append(F.struct(F.lit(n).alias("plan"), bits.bitwiseAND(F.lit(mask)).alias("key")))
    return F.array(*keys)


def bucket_links(rows: DataFrame, radius: int, block_rows: int = BLOCK_ROWS, sketch: str | None = None,
                 most: int = 0) -> DataFrame:
    """Links (a, b) that join what fingerprints within ``radius`` join in each bucket of ``rows``.

    ``rows`` has node (long), bits (long), plan and key, and may have a binary ``sketch`` in which linked rows must
    differ in at most ``most`` bits as well. Buckets of one row are dropped before the shuffle. A bucket
    of more than ``block_rows`` rows is dealt into blocks by node, and each pair of its blocks is compared by a task
    of its own, so no task holds more than two blocks of one bucket.
    """
    extra = [sketch] if sketch else []
    sizes = rows.groupBy("plan", "key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block_rows).cast("int")
    held = rows.join(sizes, ["plan", "key"]).select(
        "node", "bits", *extra, "plan", "key", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("i")
    )
    dealt = held.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.xxhash64("plan", "key", F.least("i", "j"), F.greatest("i", "j")).alias("bucket"), "node", "bits", *extra
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole buckets of the sorted partition, a few tens of thousands of rows at a time."""
        rest = [np.empty(0, np.int64)] * 3 + [np.empty(0, object)] * len(extra)

        def links(cols):
            def accept(i, j):
                a, b = (np.frombuffer(b"".join(cols[3][k].tolist()), dtype="<u8").reshape(len(k), -1) for k in (i, j))
                return np.bitwise_count(a ^ b).sum(axis=1) <= most

            i, j = forest(cols[0], cols[2].view(np.uint64), radius, accept if extra else None)
            return pa.RecordBatch.from_arrays([pa.array(cols[1][i]), pa.array(cols[1][j])], ["a", "b"])

        for batch in batches:
            rest = [np.concatenate([r, c.to_numpy(zero_copy_only=False)]) for r, c in zip(rest, batch.columns, strict=True)]
            if len(rest[0]) >= 8 * block_rows and rest[0][0] != rest[0][-1]:
                cut = int(np.searchsorted(rest[0], rest[0][-1]))
                yield links([c[:cut] for c in rest])
                rest = [c[cut:] for c in rest]
        if len(rest[0]):
            yield links(rest)

    return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, seed: int = 42,
                   radius: int = 4, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per document: its id, ``simhash`` (long) and ``component_id``.

    Documents whose fingerprints differ in at most ``radius`` bits are linked; ``component_id`` is the least id that
    links reach. NULL and empty texts share fingerprint zero and are linked like any other. Rows with the same id keep
    their own fingerprints; NULL ids are grouped but never are a component_id unless a group has no other. An empty
    table gives no rows; extra columns are ignored.
    """
    keyed = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    prints = stored(fingerprints(keyed, "text", words, seed, "bits"), "fingerprints")
    nodes = prints.groupBy("bits").agg(F.min("doc").alias("least"))
    rows = nodes.select("bits", F.col("bits").alias("node"), F.inline(pigeonhole(F.col("bits"), radius)))
    roots = components(bucket_links(stored(rows, "buckets"), radius, block_rows))
    joined = nodes.join(roots, nodes["bits"] == roots["node"], "left").select(
        "bits", "least", F.coalesce("root", "bits").alias("root")
    )
    firsts = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = joined.join(firsts, "root").select("bits", "component_id")
    return prints.join(labels, "bits").select(F.col("doc").alias(id_col), F.col("bits").alias("simhash"), "component_id")


#: For near copies by similarity: minwise values of a text, of which the first are banded to choose the buckets.
MINIMA, BANDS, BAND_VALUES = 512, 20, 5

#: Fingerprint bits beyond which a pair is not compared further: texts of similarity 0.8 are up to 14 of 64 apart.
COPY_RADIUS = 20

#: Standard errors of the estimated similarity that are allowed for, so that a pair right at the limit is hardly ever lost.
SLACK = 2.0


def minima(hashes: np.ndarray, factors: np.ndarray, chunk: int = 512) -> np.ndarray:
    """Least value of the hashes under each of the multiplications; all ones for no hash."""
    out = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for a in range(0, len(hashes), chunk):
        np.minimum(out, (hashes[a : a + chunk, None] * factors).min(axis=0), out=out)
    return out


def sketches(docs: DataFrame, text_col: str, words: int, seed: int) -> DataFrame:
    """``docs`` without its text and with ``bits`` (fingerprint), ``node`` (a hash of the shingle set's minima),
    ``sketch`` (one bit of each minimum) and ``bands`` (hashes of groups of minima)."""
    factors = np.random.default_rng(seed).integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def make():
        def compute(texts: list[bytes]) -> list[pa.Array]:
            bits, nodes, marks, bands = [], [], [], []
            for text in texts:
                hashes = shingle_hashes(text, words, seed)
                least = minima(np.unique(hashes), factors)
                raw = least.astype("<u8").tobytes()
                bits.append(majority(hashes))
                nodes.append(xxhash.xxh3_64_intdigest(raw))
                marks.append(np.packbits(least * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(63) == 1).tobytes())
                step = 8 * BAND_VALUES
                bands.append(np.array([xxhash.xxh3_64_intdigest(raw[k * step : (k + 1) * step]) for k in range(BANDS)], dtype=np.uint64).view(np.int64))
            longs = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (bits, nodes)]
            return [*longs, pa.array(marks, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]

        return compute

    return from_texts(docs, text_col, "bits long, node long, sketch binary, bands array<long>", make, keep_text=False)


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, seed: int = 42,
                   similarity: float = 0.8, radius: int = COPY_RADIUS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with one row of each group of near copies: that of the least id, any one of rows with the same id.

    Two texts are near copies if their sets of ``words``-word shingles have a Jaccard similarity of ``similarity`` or
    more. Minwise bits estimate it (standard error 0.027 at 0.8); ``SLACK`` errors are allowed for, so about 1 in 40
    pairs is lost right at the limit, fewer above it, and pairs down to about 0.75 count as copies too. A fingerprint of 64 bits tells such texts
    apart from others only at a radius for which no blocks of bits prune, so pairs that share a band of minima are
    compared: by bit planes first and, within ``radius``, by their minwise bits. NULL, empty and blank texts are copies
    of each other; a NULL id is kept only where its group has no other; an empty table gives no rows.
    """
    number = free_name(docs, "number")
    rows = stored(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    keyed = rows.select(F.col(number).alias("row"), F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    drawn = stored(sketches(keyed, "text", words, seed), "sketches")
    least = F.min(F.struct(F.col("doc").isNull().alias("absent"), "doc", "row")).alias("least")
    nodes = drawn.groupBy("node").agg(*[F.first(c).alias(c) for c in ("bits", "sketch", "bands")], least)
    nodes = stored(nodes, "nodes")
    buckets = nodes.select("node", "bits", "sketch", F.posexplode("bands").alias("plan", "key"))
    # A pair of similarity s differs in (1 - s) / 2 of its minwise bits.
    differ = (1 - similarity) / 2
    most = int(MINIMA * differ + SLACK * (MINIMA * differ * (1 - differ)) ** 0.5)
    links = bucket_links(buckets, radius, block_rows, "sketch", most)
    roots = components(links)
    stay = nodes.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("least").alias("least"))
    return rows.join(stay.select(F.col("least.row").alias(number)), number, "left_semi").drop(number)
