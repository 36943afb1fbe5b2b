"""Byte-level BPE with a lexicon of frequent words: encoding, and decoding back to text.

The words (pieces of the pre-tokenizer) of all documents are counted; the most frequent are compiled, with the ids that
the merges give them, into a minimal acyclic transducer. It goes, with the tables of the vocabulary, into one file in
the shared folder; Spark hands the file to every executor and tasks memory-map it. A word outside the lexicon is merged
pair by pair, so results never depend on what the lexicon holds.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

from . import automaton
from .common import byte_column, from_texts, slices, stored
from .tokens import VOCABULARY

#: The lexicon holds at most so many of the most frequent words, none of more than so many bytes; all others are merged.
LEXICON, WORD_BYTES = 100_000, 64

#: Bytes that are handled at once: the arrays over their characters and words take about 60 times as much.
PART_BYTES = 1_000_000

#: Distinct words that a task counts before it lets go of them.
KEPT_WORDS = 100_000

OTHER, LETTER, NUMBER, SPACE = range(4)

#: Where a long text may be cut: a space between two letters always starts a word.
SAFE_CUT = re.compile(rb"[A-Za-z] [A-Za-z]")


def character_classes(split) -> np.ndarray:
    """Class of each code point as the pre-tokenizer ``split`` (str -> pieces) sees it.

    Two Unicode databases of different age say what a character is; where they differ, ``split`` itself is asked.
    """
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    everything = "".join(map(chr, points))
    newer, older = np.zeros((2, 0x110000), dtype=np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        newer[[ord(c) for c in regex.findall(pattern, everything)]] = kind
    older[points] = [{"L": LETTER, "N": NUMBER}.get(unicodedata.category(c)[0], OTHER) for c in everything]
    older[newer == SPACE] = SPACE
    for c in np.flatnonzero(newer != older).tolist():
        alike = [k for k, probe in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(split(probe + chr(c) + probe)) == 1]
        newer[c] = alike[0] if alike else SPACE
    return newer


def word_starts(data: bytes, cuts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Byte positions where words of UTF-8 ``data`` start; no word crosses a position of ``cuts`` (0 among them)."""
    if not data:
        return np.empty(0, dtype=np.int64)
    chars = np.frombuffer(data, dtype=np.uint8)
    at = None
    if chars.max() >= 128:
        chars = np.frombuffer(data.decode().encode("utf-32-le"), dtype=np.uint32)
        width = 1 + (chars >= 0x80).astype(np.int64) + (chars >= 0x800) + (chars >= 0x10000)
        at = np.cumsum(width) - width
        cuts = np.searchsorted(at, cuts)
    n = len(chars)
    kind = classes[chars]
    cut = np.zeros(n + 3, dtype=bool)
    cut[cuts] = cut[n:] = True
    start = cut.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    # White space before more text leaves its last character: a blank joins what follows, another one stands alone.
    ends = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~cut[1:n]) + 1
    start[ends - 1] = True
    start[ends[chars[ends - 1] == 32]] = False
    # 's 't 'm 'd 're 've 'll after anything but a blank or another mark.
    q = np.flatnonzero((chars == 39) & start[:n])
    q = q[~cut[q + 1]]
    q = q[kind[q + 1] == LETTER]
    one = np.isin(chars[q + 1], np.frombuffer(b"stmd", dtype=np.uint8))
    start[q[one] + 1], start[q[one] + 2] = False, True
    q = q[~one]
    q = q[~cut[q + 2]]
    first, second = chars[q + 1], chars[q + 2]
    two = q[(np.isin(first, np.frombuffer(b"rv", dtype=np.uint8)) & (second == ord("e"))) | ((first == ord("l")) & (second == ord("l")))]
    start[two + 1], start[two + 3] = False, True
    found = np.flatnonzero(start[:n])
    return found if at is None else at[found]


def merged(ids: list[int], pair_rank: dict[int, int], made: list[int]) -> list[int]:
    """``ids`` after all merges: always the pair of least rank, the leftmost of equals; n log n for n ids."""
    ids = list(ids)
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := pair_rank.get(ids[i] << 32 | ids[i + 1])) is not None]
    heapify(heap)
    while heap:
        rank, i = heappop(heap)
        j = after[i]
        if j >= n or ids[i] < 0 or pair_rank.get(ids[i] << 32 | ids[j]) != rank:
            continue
        ids[i], ids[j] = made[rank], -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (r := pair_rank.get(ids[a] << 32 | ids[b])) is not None:
                heappush(heap, (r, a))
    return [x for x in ids if x >= 0]


class Merges:
    """The merges of a vocabulary, applied to one word or to many of bounded length at a time."""

    def __init__(self, tables: dict[str, np.ndarray]):
        self.byte_ids, self.made = tables["byte_ids"], np.append(tables["made"], 0)
        self.order = np.argsort(tables["pairs"])
        self.pairs = np.append(tables["pairs"][self.order], 1 << 62)
        self.none = len(tables["pairs"])
        self.by_pair: dict[int, int] = {}

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``none`` for pairs that do not merge."""
        pair = a << 32 | b
        at = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[at] == pair, np.append(self.order, self.none)[at], self.none)

    def one(self, word: bytes) -> list[int]:
        """Ids of a word of any length."""
        if not self.by_pair:
            order = np.argsort(self.order)
            self.by_pair = {p: r for r, p in enumerate(self.pairs[order].tolist())}
            self.made_list = self.made.tolist()
        return merged(self.byte_ids[np.frombuffer(word, dtype=np.uint8)].tolist(), self.by_pair, self.made_list)

    def many(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and how many each has. All words take a merge in each round."""
        counts = np.zeros(len(starts), dtype=np.int64)
        parts, owners = [], []
        for low, high in ((0, 4), (4, 8), (8, 16), (16, 32), (32, WORD_BYTES)):
            mine = np.flatnonzero((lengths > low) & (lengths <= high))
            for at in range(0, len(mine), 20_000):
                rows = mine[at : at + 20_000]
                ids, n = self._matrix(data, starts[rows], lengths[rows], high)
                counts[rows] = n
                parts.append(ids[np.arange(high) < n[:, None]])
                owners.append(np.repeat(rows, n))
        if not parts:
            return np.empty(0, dtype=np.int64), counts
        return np.concatenate(parts)[np.argsort(np.concatenate(owners), kind="stable")], counts

    def _matrix(self, data, starts, lengths, width) -> tuple[np.ndarray, np.ndarray]:
        column = np.arange(width)
        inside = column < lengths[:, None]
        ids = np.where(inside, self.byte_ids[data[np.minimum(starts[:, None] + column, len(data) - 1)]], 0)
        rank = np.full(ids.shape, self.none)
        both = inside[:, 1:]
        rank[:, :-1][both] = self.ranks(ids[:, :-1][both], ids[:, 1:][both])
        n, done, left = lengths.copy(), ids, np.arange(len(ids))
        while len(left):
            best = rank.argmin(axis=1)
            row = np.arange(len(left))
            found = rank[row, best]
            on = found < self.none
            if not on.all():
                done[left[~on]] = ids[~on]
                left, ids, rank, best, found = left[on], ids[on], rank[on], best[on], found[on]
                row = row[: len(left)]
            if not len(left):
                break
            n[left] -= 1
            # All behind the pair moves up by one place.
            source = np.minimum(column + (column > best[:, None]), width - 1)
            ids, rank = np.take_along_axis(ids, source, 1), np.take_along_axis(rank, source, 1)
            ids[row, best] = self.made[found]
            rank[:, -1] = self.none
            rank[row, best] = np.where(best + 1 < n[left], self.ranks(ids[row, best], ids[row, np.minimum(best + 1, width - 1)]), self.none)
            back = best > 0
            rank[row[back], best[back] - 1] = self.ranks(ids[row[back], best[back] - 1], ids[row[back], best[back]])
        return done, n


def _byte_letters() -> dict[str, int]:
    """Printable letter of each byte in byte-level vocabularies: itself, or the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def vocabulary_tables(path: str) -> dict[str, np.ndarray]:
    """Flat tables of a byte-level BPE file: bytes of each id, id of each byte, merges by rank, character classes, specials."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    vocabulary, letters = file["model"]["vocab"], _byte_letters()
    added = {t["id"]: t["content"].encode() for t in file["added_tokens"]}
    spelled = {i: bytes(letters[c] for c in token) for token, i in vocabulary.items()} | added
    tokens = [spelled.get(i, b"") for i in range(max(spelled) + 2)]  # the last one, without bytes, stands for unknown ids
    merges = [m if isinstance(m, list) else m.split(" ") for m in file["model"]["merges"]]
    special = sorted(added.items())
    return {
        "classes": character_classes(Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str),
        "token_ends": np.cumsum([len(t) for t in tokens]),
        "token_bytes": np.frombuffer(b"".join(tokens), dtype=np.uint8),
        "byte_ids": np.array([vocabulary[c] for c in sorted(letters, key=letters.get)], dtype=np.int64),
        "pairs": np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in merges], dtype=np.int64),
        "made": np.array([vocabulary[a + b] for a, b in merges], dtype=np.int64),
        "special_ids": np.array([i for i, _ in special], dtype=np.int64),
        "special_ends": np.cumsum([len(t) for _, t in special], dtype=np.int64),
        "special_bytes": np.frombuffer(b"".join(t for _, t in special), dtype=np.uint8),
    }


def _spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... (count places) of each entry, one after the other."""
    upto = np.cumsum(count)
    return np.repeat(begin - upto + count, count) + np.arange(int(upto[-1]) if len(upto) else 0)


def _valid(texts: list[bytes]) -> bytes:
    data = b"".join(texts)
    try:
        data.decode()
    except UnicodeDecodeError:
        texts[:] = [t.decode(errors="replace").encode() for t in texts]
        data = b"".join(texts)
    return data


class _Encoder:
    """Encodes lists of texts inside a task with the tables of a mapped file."""

    def __init__(self, tables: dict[str, np.ndarray]):
        self.t = tables
        ends = tables["special_ends"].tolist()
        spelled = tables["special_bytes"].tobytes()
        self.special = {spelled[a:b]: i for a, b, i in zip([0, *ends], ends, tables["special_ids"].tolist())}
        # Where two start alike, the longest is meant.
        self.marks = re.compile(b"|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) or rb"(?!)")
        self.merges = Merges(tables)

    def words(self, texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, list[tuple[int, int]]]:
        """Text without specials, byte starts of its words, starts of the texts in it, (place, id) of each special."""
        data, inserted = _valid(texts), []
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        if self.marks.search(data):
            plain, at = [], 0
            for text in texts:
                begin = 0
                for m in self.marks.finditer(text):
                    inserted.append((at + m.start() - begin, self.special[m.group()]))
                    plain.append(text[begin : m.start()])
                    at, begin = at + m.start() - begin, m.end()
                plain.append(text[begin:])
                at += len(text) - begin
            data = b"".join(plain)
            lost = np.array([sum(map(len, self.marks.findall(t))) for t in texts], dtype=np.int64)
            lengths -= lost
        begins = np.cumsum(lengths) - lengths
        cuts = np.append(begins, [i[0] for i in inserted]).astype(np.int64)
        return data, word_starts(data, cuts[cuts < len(data)], self.t["classes"]), begins, inserted

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """Little-endian unsigned 32-bit ids of each text."""
        t = self.t
        data, starts, begins, inserted = self.words(texts)
        lengths = np.diff(np.append(starts, len(data)))
        rank = automaton.ranks(t, np.frombuffer(data, dtype=np.uint8), starts, lengths, WORD_BYTES)
        known = rank >= 0
        begin = np.where(known, t["ids_begin"][rank], 0)
        count = np.where(known, t["ids_begin"][rank + 1] - begin, 0)
        bytes_ = np.frombuffer(data, dtype=np.uint8)
        short = np.flatnonzero(~known & (lengths <= WORD_BYTES))
        short_ids, count[short] = self.merges.many(bytes_, starts[short], lengths[short])
        far = np.flatnonzero(lengths > WORD_BYTES)
        far_ids = [self.merges.one(data[a : a + n]) for a, n in zip(starts[far].tolist(), lengths[far].tolist())]
        count[far] = [len(x) for x in far_ids]
        ends = np.cumsum(count)
        first = ends - count
        total = int(ends[-1]) if len(ends) else 0
        ids = np.empty(total, dtype="<u4")
        ids[_spread(first[known], count[known])] = t["ids"][_spread(begin[known], count[known])]
        ids[_spread(first[short], count[short])] = short_ids
        ids[_spread(first[far], count[far])] = [x for xs in far_ids for x in xs]
        places = np.append(first, total)
        bounds = places[np.searchsorted(starts, np.append(begins, len(data)))]
        if inserted:
            where = places[np.searchsorted(starts, [i[0] for i in inserted])]
            ids = np.insert(ids, where, np.array([i[1] for i in inserted], dtype=np.uint32)).astype("<u4")
            owner = self.owners(texts)
            bounds = bounds + np.searchsorted(owner, np.arange(len(texts) + 1))
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def owners(self, texts: list[bytes]) -> np.ndarray:
        return np.repeat(np.arange(len(texts)), [len(self.marks.findall(t)) for t in texts])

    def __call__(self, texts: list[bytes]) -> list[pa.Array]:
        out = []
        for part in _parts(texts):
            found = self.ids(part) if len(part) > 1 else [self.long(t) for t in part]
            out += [x.tobytes() for x in found]
        return [pa.array(out, pa.binary())]

    def long(self, text: bytes) -> np.ndarray:
        """Ids of one text, piece by piece."""
        parts = [self.ids([piece])[0] for piece in _pieces(text)]
        return np.concatenate(parts) if parts else np.empty(0, dtype="<u4")


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text cut into pieces of about ``PART_BYTES``, at places where a word starts in any case."""
    at = 0
    while at < len(text):
        m = SAFE_CUT.search(text, at + PART_BYTES)
        end = m.start() + 1 if m else len(text)
        yield text[at:end]
        at = end


def _parts(rows: list[bytes]) -> Iterator[list[bytes]]:
    """The rows in lists of at most ``PART_BYTES``, or one longer row."""
    part, size = [], 0
    for row in rows:
        if part and size + len(row) > PART_BYTES:
            yield part
            part, size = [], 0
        part.append(row)
        size += len(row)
    if part:
        yield part


def _decoder(tables: dict[str, np.ndarray]):
    ends, spelled = tables["token_ends"], tables["token_bytes"]
    widths = np.diff(ends, prepend=0)

    def texts_of(rows: list[bytes]) -> list[bytes]:
        ids = np.minimum(np.frombuffer(b"".join(rows), dtype="<u4"), len(ends) - 1)
        width = widths[ids]
        upto = np.cumsum(width)
        total = int(upto[-1]) if len(upto) else 0
        data = spelled[np.repeat(ends[ids] - upto, width) + np.arange(total)].tobytes()
        places = np.append(0, upto)[np.append(0, np.cumsum([len(r) // 4 for r in rows], dtype=np.int64))].tolist()
        texts = [data[a:b] for a, b in zip(places[:-1], places[1:])]
        _valid(texts)
        return texts

    return lambda rows: [pa.array([t for part in _parts(rows) for t in texts_of(part)], pa.binary())]


@dataclass(frozen=True)
class Lexicon:
    """Name of a compiled file that Spark hands to the executors, and how many words and states it holds."""

    name: str
    words: int
    states: int

    def tables(self) -> dict[str, np.ndarray]:
        return automaton.mapped(SparkFiles.get(self.name))


def word_counts(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(word, n) over all texts; each task counts before rows are shuffled."""
    tables = vocabulary_tables(vocabulary or public_tokenizers.path(VOCABULARY))
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    def run(batches):
        encoder, counts = _Encoder(shared.value), Counter()

        def batch():
            out = pa.RecordBatch.from_pydict({"word": pa.array(list(counts), pa.binary()), "n": pa.array(counts.values(), pa.int64())})
            counts.clear()
            return out

        for part in slices(batches, text=0, limit=PART_BYTES):
            pieces = [piece for text in byte_column(part.column(0)) for piece in _pieces(text)]
            for texts in _parts(pieces):
                data, starts, *_ = encoder.words(texts)
                bounds = np.append(starts, len(data)).tolist()
                counts.update([data[a:b] for a, b in zip(bounds, bounds[1:])])
                if len(counts) > KEPT_WORDS:
                    yield batch()
        yield batch()

    texts = docs.select(F.col(text_col).cast("binary"))
    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def compile_words(spark: SparkSession, words: list[bytes], vocabulary: str | None = None) -> Lexicon:
    """Compile ``words`` with their ids and write the file to the shared folder, from where executors get it."""
    tables = vocabulary_tables(vocabulary or public_tokenizers.path(VOCABULARY))
    words = sorted({w for w in words if w and len(w) <= WORD_BYTES})
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    data = np.frombuffer(b"".join(words) or b" ", dtype=np.uint8)
    ids, counts = Merges(tables).many(data, np.cumsum(lengths) - lengths, lengths)
    tables |= automaton.compiled(words)
    # Rank -1, an unseen word, reads entries that are then left unused.
    tables["ids_begin"] = np.append(0, np.cumsum(counts))
    tables["ids"] = np.append(ids, 0).astype(np.uint32)
    path = scratch_dir(spark, "lexicon")
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(jvm_path)
    out.write(bytearray(automaton.to_bytes(tables)))
    out.close()
    spark.sparkContext.addFile(jvm_path.toString())
    return Lexicon(jvm_path.getName(), len(words), len(tables["base"]))


def fit(docs: DataFrame, text_col: str = "text", size: int = LEXICON, vocabulary: str | None = None) -> Lexicon:
    """Lexicon of the most frequent words of all ``docs``, at most ``size``; only those reach the driver.

    Frequencies fall into classes, 16 to a doubling; the lexicon takes whole classes, from the highest down, as long as
    they fit. So a histogram of a few hundred rows chooses it, however many words there are.
    """
    counts = stored(word_counts(docs, text_col, vocabulary).where(F.length("word") <= WORD_BYTES), "words")
    level = F.floor(F.log2("n") * 16)
    histogram = sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect(), reverse=True)
    least, taken = None, 0
    for row in histogram:
        taken += row["words"]
        if taken > size:
            break
        least = row["level"]
    words = [] if least is None else counts.where(level >= least).select("word").collect()
    return compile_words(docs.sparkSession, [bytes(r["word"]) for r in words], vocabulary)


def encode(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", keep_text: bool = True, decoded: str | None = None) -> DataFrame:
    """``docs`` with ``ids``: those of each whole text as little-endian unsigned 32-bit integers, as packed files hold them.

    Equal to the vocabulary's own encoding without special tokens added; strings of special tokens inside a text become
    their ids. ``decoded`` names a column for what the ids decode to, in the same pass. NULL and empty texts have no
    ids. Invalid UTF-8 is read as U+FFFD. Other columns pass through; one that is named as a new one is replaced. Rows
    are handled one by one, repeated or not; an empty table gives no rows. Very long texts are encoded piece by piece.
    There is no shuffle.
    """
    if not decoded:
        return from_texts(docs, text_col, "ids binary", lambda: _Encoder(lexicon.tables()), keep_text)

    def make():
        tables = lexicon.tables()
        encoder, decoder = _Encoder(tables), _decoder(tables)

        def both(texts: list[bytes]) -> list[pa.Array]:
            (ids,) = encoder(texts)
            return [ids, *decoder(ids.to_pylist())]

        return both

    out = from_texts(docs, text_col, f"ids binary, {decoded} binary", make, keep_text)
    return out.withColumn(decoded, F.col(decoded).cast("string"))


def decode(rows: DataFrame, lexicon: Lexicon, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """``rows`` with the text of their packed ids, special tokens included; NULL is no ids, unknown ids add nothing.

    Bytes that are no UTF-8 become U+FFFD. Other columns pass through; one with the name of the new one is replaced.
    """
    out = from_texts(rows, ids_col, f"{name} binary", lambda: _decoder(lexicon.tables()))
    return out.withColumn(name, F.col(name).cast("string"))
