"""Packing documents into sequences of bounded length by linear grouping and best fit.

Lengths are bounded by the sequence size, so their histogram is all the planner needs: at most ``size`` counts reach
the driver, whatever the corpus. Large lengths are sorted and cut into groups of equal cardinality, each rounded up to
its largest; the few rounded sizes make a small configuration program, solved by column generation. Its whole bins are
filled with actual lengths, group by group, and what is left, small lengths included, goes to the bin it fits best.
The plan is a list of runs of bins with equal contents; a piece finds its place by its rank among those of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, from_texts, stored
from .tokens import RANKS, VOCABULARY, rank_encoding, vocabulary_encoder

#: Lengths above a share of a sequence are large; of plans by these shares the one with fewest sequences is used. The
#: more short documents there are to fill gaps, the higher the share that serves best.
LARGE = (1 / 2, 1 / 3, 1 / 4, 1 / 8)

#: Large lengths are rounded in so many groups.
GROUPS = 64

#: Rows of one length that are ranked in one task.
RANKED_ROWS = 100_000


def token_pieces(docs: DataFrame, text_col: str = "text", size: int = 2048, end_id: int = 0, vocabulary: str | None = None,
                 ranks: str | None = None, special: tuple[str, ...] = ("<|endoftext|>",), with_ids: bool = False) -> DataFrame:
    """``docs`` without its text, one row per piece: piece, start, length, ids_crc32 (and ids).

    A document is its ids and then ``end_id``; a longer one than ``size`` is cut so that all pieces but the first have
    ``size`` ids. NULL and empty texts are ``end_id`` alone. ``ranks`` holds the same vocabulary for the faster
    library; texts that hold one of the ``special`` tokens' strings are encoded by ``vocabulary`` itself.
    """
    fast, exact = ranks or public_tokenizers.path(RANKS), vocabulary or public_tokenizers.path(VOCABULARY)
    marks = tuple(s.encode() for s in special)
    kinds = [("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))]
    kind = pa.struct(kinds if with_ids else kinds[:3])

    def make():
        encoding, slow = rank_encoding(fast), []

        def ids_of(text: bytes) -> np.ndarray:
            if any(m in text for m in marks):
                slow[:] = slow or [vocabulary_encoder(exact)]
                ids = np.array(slow[0](text.decode()), dtype=np.uint32)
            else:
                ids = encoding.encode_to_numpy(text.decode(), disallowed_special=())
            return np.append(ids, np.uint32(end_id)).astype("<u4")

        def pieces(text: bytes) -> list[dict]:
            ids = ids_of(text)
            cuts = [0, *range(len(ids) % size or size, len(ids) + 1, size)]
            parts = [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            out = [{"start": a, "length": len(p), "ids_crc32": zlib.crc32(p.tobytes())} for a, p in zip(cuts, parts, strict=False)]
            if with_ids:
                for row, p in zip(out, parts, strict=True):
                    row["ids"] = p.view(np.int32)
            return out

        return lambda texts: [pa.array([pieces(t) for t in texts], pa.list_(kind))]

    ids = ",ids:array<int>" if with_ids else ""
    found = free_name(docs, "pieces")
    ddl = f"{found} array<struct<start:bigint,length:int,ids_crc32:bigint{ids}>>"
    made = ("piece", "start", "length", "ids_crc32", "ids")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in made])
    cut = from_texts(docs, text_col, ddl, make, keep_text=False)
    kept = [F.col(f"`{c}`") for c in cut.columns if c != found]
    return cut.select(*kept, F.posexplode(found).alias("piece", found)).select(*kept, "piece", f"{found}.*")


@dataclass
class Run:
    """``count`` bins from number ``base`` on with the same contents: (length, first rank, copies, offset)."""

    base: int
    count: int
    used: int = 0
    slots: list[tuple[int, int, int, int]] = field(default_factory=list)

    def split(self, count: int) -> Run:
        """Cuts this run to ``count`` bins and returns the others."""
        slots = [(n, rank + count * copies, copies, at) for n, rank, copies, at in self.slots]
        other = Run(self.base + count, self.count - count, self.used, slots)
        self.count = count
        return other

    def put(self, length: int, rank: int, copies: int = 1) -> None:
        self.slots.append((length, rank, copies, self.used))
        self.used += length * copies


def grouped(lengths: list[tuple[int, int]], groups: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(rounded size, its lengths with counts) of equal-cardinality groups of ``lengths``, which descend."""
    total = sum(c for _, c in lengths)
    out: list[tuple[int, list[tuple[int, int]]]] = []
    seen = 0
    for length, count in lengths:
        while count:
            last = -(-total * (seen * groups // total + 1) // groups)
            take = max(1, min(count, last - seen))
            if out and seen * groups // total == out[-1][2] or out and out[-1][0] == length:
                out[-1][1].append((length, take))
            else:
                out.append((length, [(length, take)], seen * groups // total))
            seen, count = seen + take, count - take
    return [(size, parts) for size, parts, _ in out]


def configurations(sizes: list[int], demand: list[int], size: int, rounds: int = 3000) -> list[tuple[float, np.ndarray]]:
    """(bins, items of each size in such a bin): the linear program of fewest bins, by column generation.

    The columns that enter are the best fillings under the current prices; ``rounds`` bounds their number, and any
    number of them leaves a covering solution.
    """
    k = len(sizes)
    basis = np.diag([float(size // s) for s in sizes])
    amount = np.array(demand, dtype=float) / np.diag(basis)
    most = size // min(sizes)
    for _ in range(rounds):
        price = np.linalg.solve(basis.T, np.ones(k))
        worth = np.full((most + 1, size + 1), -np.inf)
        worth[0] = 0
        chosen = np.full((most + 1, size + 1), -1)
        for j in range(1, most + 1):
            worth[j] = worth[j - 1]
            for i in np.flatnonzero(price > 1e-12).tolist():
                s = sizes[i]
                better = worth[j - 1][: size + 1 - s] + price[i]
                gain = np.flatnonzero(better > worth[j][s:] + 1e-12)
                worth[j][s + gain] = better[gain]
                chosen[j][s + gain] = i
        if worth[most][size] <= 1 + 1e-7:
            break
        column, room = np.zeros(k), size
        for j in range(most, 0, -1):
            i = chosen[j][room]
            if i >= 0:
                column[i] += 1
                room -= sizes[i]
        step = np.linalg.solve(basis, column)
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        leave = int(np.argmin(ratio))
        amount = np.maximum(amount - ratio[leave] * step, 0)
        amount[leave] = ratio[leave]
        basis[:, leave] = column
    return [(float(x), basis[:, i].astype(int)) for i, x in enumerate(amount)]


def plan(histogram: dict[int, int], size: int, large: tuple[float, ...] = LARGE, groups: int = GROUPS) -> list[Run]:
    """The plan with fewest bins by any of the shares ``large``; no further ones once none can be saved."""
    least = -(-sum(n * c for n, c in histogram.items()) // size)
    best, bins = [], -1
    for share in large:
        runs = plan_by(histogram, size, share, groups)
        used = sum(r.count for r in runs)
        if bins < 0 or used < bins:
            best, bins = runs, used
        if bins == least:
            break
    return best


def plan_by(histogram: dict[int, int], size: int, large: float, groups: int) -> list[Run]:
    """Runs of bins that hold every length of ``histogram`` (length -> count) once for each of its count."""
    rank: dict[int, int] = dict.fromkeys(histogram, 0)
    left = dict(histogram)
    runs: list[Run] = []
    bins = 0

    def take(length: int, count: int) -> int:
        first = rank[length]
        rank[length] += count
        left[length] -= count
        return first

    def opened(count: int) -> Run:
        nonlocal bins
        bins += count
        return Run(bins - count, count)

    if left.get(size):
        run = opened(left[size])
        run.put(size, take(size, run.count))
        runs.append(run)
    big = [(n, left[n]) for n in sorted(left, reverse=True) if left[n] and size > n > large * size]
    if big:
        queues = [(s, [list(p) for p in parts]) for s, parts in grouped(big, groups)]
        sizes = [s for s, _ in queues]
        demand = [sum(c for _, c in parts) for _, parts in queues]
        for amount, column in sorted(configurations(sizes, demand, size), key=lambda x: -x[0]):
            count = int(min([amount + 1e-9, *(demand[i] // column[i] for i in np.flatnonzero(column))]))
            if not count or not column.any():
                continue
            made = [opened(count)]
            for i in np.flatnonzero(column).tolist():
                demand[i] -= count * int(column[i])
                for _ in range(column[i]):
                    todo, made = made, []
                    while todo:
                        run, part = todo.pop(0), queues[i][1][0]
                        if run.count > part[1]:
                            todo.insert(0, run.split(part[1]))
                        run.put(part[0], take(part[0], run.count))
                        part[1] -= run.count
                        if not part[1]:
                            queues[i][1].pop(0)
                        made.append(run)
            runs += made
    # Best fit, longest first: a length goes where it leaves least room, as often as it fits.
    rooms: list[int] = []
    at: dict[int, list[Run]] = {}
    closed: list[Run] = []

    def shelve(run: Run) -> None:
        room = size - run.used
        if not room:
            closed.append(run)
            return
        if not at.get(room):
            insort(rooms, room)
        at.setdefault(room, []).append(run)

    for run in runs:
        shelve(run)
    for length in sorted(left, reverse=True):
        while left[length]:
            k = bisect_left(rooms, length)
            if k == len(rooms):
                copies = min(size // length, left[length])
                run = opened(left[length] // copies)
            else:
                room = rooms[k]
                run = at[room].pop()
                if not at[room]:
                    rooms.pop(k)
                copies = min(room // length, left[length])
                if run.count * copies > left[length]:
                    shelve(run.split(left[length] // copies))
            run.put(length, take(length, run.count * copies), copies)
            shelve(run)
    return closed + [run for room in rooms for run in at[room]]


def ranked(pieces: DataFrame, length: str, ranked_rows: int = RANKED_ROWS) -> DataFrame:
    """``pieces`` (stored) with ``rank``: 0, 1, ... among the rows of the same length, in no particular order.

    A length may be that of any share of the rows: its rows are dealt over shares, each ranked for itself, and the
    counts of the shares before are added.
    """
    shares = max(1, -(-pieces.count() // ranked_rows))
    dealt = pieces.withColumn("share", F.pmod(F.col("row"), F.lit(shares)))
    counts = dealt.groupBy(length, "share").agg(F.count("*").alias("n"))
    before = Window.partitionBy(length).orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(length, "share", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    nth = F.row_number().over(Window.partitionBy(length, "share").orderBy("row")) - 1
    return dealt.withColumn("nth", nth).join(firsts, [length, "share"]).withColumn("rank", F.col("first") + F.col("nth"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 2048,
         large: tuple[float, ...] = LARGE, groups: int = GROUPS, ranked_rows: int = RANKED_ROWS, with_ids: bool = False,
         **tokens) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    The pieces of a sequence lie one after another from offset 0 and hold at most ``size`` ids. Every row of ``docs``
    is packed for itself: repeated and NULL ids are kept, NULL and empty texts are one id long, an empty table gives
    no rows and extra columns are ignored. ``tokens`` go to ``token_pieces``.
    """
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    cut = token_pieces(texts, "text", size, with_ids=with_ids, **tokens)
    cut = stored(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # Each slot is one row; a plan has a few for each of at most ``size`` lengths and each filling.
    slots = [
        (length, first, first + run.count * copies, copies, run.base, offset)
        for run in plan(histogram, size, large, groups)
        for length, first, copies, offset in run.slots
    ]
    ddl = "length int, first long, last long, copies int, base long, at int"
    places = docs.sparkSession.createDataFrame(slots, ddl)
    nth = F.col("rank") - F.col("first_rank")
    placed = ranked(cut, "length", ranked_rows).join(
        F.broadcast(places.withColumnRenamed("first", "first_rank")),
        ["length"],
    ).where("rank >= first_rank AND rank < last")
    return placed.select(
        F.col("doc").alias(id_col),
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        (F.col("base") + F.floor(nth / F.col("copies"))).alias("sequence_id"),
        (F.col("at") + F.pmod(nth, F.col("copies")) * F.col("length")).cast("long").alias("offset"),
        *(["ids"] if with_ids else []),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence of ``pack(..., with_ids=True)``; a group has at most ``size`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
