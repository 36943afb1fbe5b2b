"""Language of texts and of the spans of mixed texts.

The script of a word narrows the languages it can be in to those that use the script in training. Each candidate gives
the word a score from its character n-grams, and a Viterbi pass over the words, in which a change of language costs a
penalty, labels spans. A text's language is the one with most letters in its spans.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_column, from_texts, slices

#: First and last code point of the main blocks of scripts; letters elsewhere are of script "other".
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F),),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "gurmukhi": ((0xA00, 0xA7F),),
    "gujarati": ((0xA80, 0xAFF),),
    "tamil": ((0xB80, 0xBFF),),
    "telugu": ((0xC00, 0xC7F),),
    "kannada": ((0xC80, 0xCFF),),
    "malayalam": ((0xD00, 0xD7F),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "ethiopic": ((0x1200, 0x137F),),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF)),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FA1F)),
}

ORDERS, BITS = (2, 3, 4), 17

#: The share of a language's letters from which it uses a script.
SCRIPT_SHARE = 0.01

#: Cost of a change of language, and the most that one word counts against a language, in nats.
SWITCH, WORST = 6.0, 12.0

UNKNOWN = "und"


def script_table() -> np.ndarray:
    """Of each code point: 0 outside words, else 1 + the number of its script, the last for letters of no listed one."""
    table = np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)], dtype=np.uint8)
    table *= len(SCRIPTS) + 1
    for k, blocks in enumerate(SCRIPTS.values()):
        for a, b in blocks:
            table[a : b + 1][table[a : b + 1] > 0] = k + 1
    return table


def words_in(text: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and scripts (by the first character) of the words: runs of letters and marks."""
    scripts = table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    edge = np.flatnonzero(np.diff((scripts > 0).astype(np.int8), prepend=0, append=0))
    return edge[::2], edge[1::2], scripts[edge[::2]]


def word_grams(words: list[str], orders: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(word number, gram id) of the byte n-grams of each lower-cased word and the spaces around it."""
    joined = (" " + " ".join(words) + " ").lower().encode("utf-8", "surrogatepass")
    codes = np.frombuffer(joined, dtype=np.uint8)
    space = np.cumsum(codes == 32)
    hashed = np.zeros(len(codes), dtype=np.uint64)
    owner, ids = [], []
    for n in range(1, orders[-1] + 1):
        if len(codes) < n:
            break
        hashed = hashed[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :] + np.uint64(1)
        if n in orders:
            # No space between the first byte and the last.
            whole = np.flatnonzero(space[n - 2 : len(codes) - 1] == space[: len(codes) - n + 1]) if n > 1 else np.arange(len(codes))
            owner.append(space[whole] - 1)
            mixed = (hashed[whole] ^ hashed[whole] >> np.uint64(31) ^ np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)
            ids.append((mixed >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(owner), np.concatenate(ids)


class Model(NamedTuple):
    langs: list[str]
    logs: np.ndarray  # (2 ** bits, langs) float32
    uses: np.ndarray  # (scripts + 2, langs) bool
    orders: tuple[int, ...]
    bits: int


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", orders: tuple[int, ...] = ORDERS, bits: int = BITS) -> Model | None:
    """A model of all rows with a language and a text; None if there are none. N-grams are counted in Spark."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("binary").alias("text")
    )
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not langs:
        return None
    numbers = docs.sparkSession.createDataFrame([(x, k) for k, x in enumerate(langs)], "lang string, number int")
    numbered = rows.join(F.broadcast(numbers), "lang").select("number", "text")
    scripts, n_langs = len(SCRIPTS) + 2, len(langs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = script_table()
        counts = np.zeros((n_langs, 1 << bits), dtype=np.int64)
        letters = np.zeros((n_langs, scripts), dtype=np.int64)
        for part in slices(batches):
            words: list[Counter] = [Counter() for _ in range(n_langs)]
            for k, raw in zip(part.column(0).to_pylist(), byte_column(part.column(1)), strict=True):
                text = raw.decode("utf-8", "replace")
                start, end, script = words_in(text, table)
                words[k].update([text[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)])
                letters[k] += np.bincount(script, end - start, scripts).astype(np.int64)
            # Each word of these texts is cut into n-grams once.
            for k, held in enumerate(words):
                if held:
                    owner, grams = word_grams(list(held), orders, bits)
                    counts[k] += np.bincount(grams, np.array(list(held.values()))[owner], 1 << bits).astype(np.int64)
        for k in range(n_langs):
            for kind, found in ((0, counts[k]), (1, letters[k])):
                ids = np.flatnonzero(found)
                fixed = [pa.array(np.full(len(ids), x, dtype=np.int32)) for x in (k, kind)]
                yield pa.RecordBatch.from_arrays([*fixed, pa.array(ids), pa.array(found[ids])], ["number", "kind", "id", "n"])

    counted = numbered.mapInArrow(run, "number int, kind int, id long, n long").groupBy("number", "kind", "id")
    # At most 2 ** bits rows and a few for each language.
    found = counted.agg(F.sum("n").alias("n")).toArrow()
    number, kind, ids, n = (found[c].to_numpy() for c in ("number", "kind", "id", "n"))
    counts, letters = np.zeros((1 << bits, n_langs)), np.zeros((scripts, n_langs))
    counts[ids[kind == 0], number[kind == 0]] = n[kind == 0]
    letters[ids[kind == 1], number[kind == 1]] = n[kind == 1]
    logs = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * (1 << bits))).astype(np.float32)
    return Model(langs, logs, letters > SCRIPT_SHARE * letters.sum(axis=0), orders, bits)


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """Best state of each word; ``scores`` has the words of several texts one after another, ``lengths`` their numbers.

    All texts step together, longest first, so a step is a few operations on those that are not at their end.
    """
    order = np.argsort(-lengths, kind="stable")
    first = (np.cumsum(lengths) - lengths)[order]
    active = np.searchsorted(-lengths[order], -np.arange(1, max(lengths, default=0) + 1), side="right")
    came = np.zeros(scores.shape, dtype=np.int16)
    own = np.arange(scores.shape[1], dtype=np.int16)
    total = np.zeros((len(lengths), scores.shape[1]))
    for t, n in enumerate(active.tolist()):
        at, before = first[:n] + t, total[:n]
        if t:
            best = before.argmax(axis=1)
            top = before[np.arange(n), best][:, None] - switch
            stay = before >= top
            came[at] = np.where(stay, own, best[:, None])
            before = np.where(stay, before, top)
        total[:n] = before + scores[at]
    states = np.zeros(len(scores), dtype=np.int64)
    now = total.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = first[:n] + t
        states[at] = now[:n]
        now[:n] = came[at, now[:n]]
    return states


def score(docs: DataFrame, model: Model | None, text_col: str = "text", switch: float = SWITCH, worst: float = WORST) -> DataFrame:
    """``docs`` without its text and with lang_pred, score and spans (array of lang, start, end in code points).

    ``score`` is the share of the text's letters in spans of ``lang_pred``; the first language in order wins a tie.
    NULL texts, texts without a letter, and all texts under no model are "und" with score 0 and no spans. Each row is
    judged by its text alone; other columns pass through, those with the names of new ones are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model) if model else None)
    kind = pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def make():
        table = script_table()
        langs, logs, uses, orders, bits = sent.value or ([], None, None, (), 0)

        def word_scores(words: list[str], scripts: np.ndarray) -> np.ndarray:
            owner, ids = word_grams(words, orders, bits)
            out = np.stack([np.bincount(owner, logs[ids, k], len(words)) for k in range(len(langs))], axis=1) / len(orders)
            candidates = uses[scripts]
            candidates |= ~candidates.any(axis=1, keepdims=True)
            out[~candidates] = -np.inf
            return np.maximum(out - out.max(axis=1, keepdims=True), -worst)

        def compute(texts: list[bytes]) -> list[pa.Array]:
            known: dict[str, int] = {}
            scripts, which, begins, ends = [], [], [], []
            for raw in texts:
                text = raw.decode("utf-8", "replace")
                start, end, script = words_in(text, table) if langs else (np.empty(0, np.int64),) * 3
                if not any(c.isalpha() for c in text):
                    start, end = start[:0], end[:0]
                ids = np.empty(len(start), dtype=np.int64)
                for k, (a, b, s) in enumerate(zip(start.tolist(), end.tolist(), script.tolist(), strict=False)):
                    ids[k] = known.setdefault(text[a:b], len(known))
                    if ids[k] == len(scripts):
                        scripts.append(s)
                which.append(ids)
                begins.append(start)
                ends.append(end)
            lengths = np.array([len(x) for x in which], dtype=np.int64)
            if not lengths.sum():
                return [pa.array([UNKNOWN] * len(texts)), pa.array([0.0] * len(texts)), pa.array([[]] * len(texts), pa.list_(kind))]
            states = viterbi(word_scores(list(known), np.array(scripts))[np.concatenate(which)], lengths, switch)
            pred, sure, spans = [], [], []
            for k, stop in enumerate(np.cumsum(lengths).tolist()):
                if not lengths[k]:
                    pred.append(UNKNOWN), sure.append(0.0), spans.append([])
                    continue
                own = states[stop - lengths[k] : stop]
                letters = np.bincount(own, ends[k] - begins[k], len(langs))
                best = int(letters.argmax())
                pred.append(langs[best])
                sure.append(float(letters[best] / letters.sum()))
                cut = np.flatnonzero(np.diff(own, prepend=-1))
                last = np.append(cut[1:], len(own)) - 1
                spans.append([
                    {"lang": langs[own[a]], "start": int(begins[k][a]), "end": int(ends[k][b])}
                    for a, b in zip(cut.tolist(), last.tolist(), strict=True)
                ])
            return [pa.array(pred), pa.array(sure), pa.array(spans, pa.list_(kind))]

        return compute

    ddl = "lang_pred string, score double, spans array<struct<lang:string,start:int,end:int>>"
    return from_texts(docs, text_col, ddl, make, keep_text=False)
