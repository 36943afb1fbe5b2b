import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from helpers import ODD_TEXTS, docs, empty, prose
from pyspark.sql import Row
from tokenizers import Tokenizer

from tidemark.llm import automaton, bpe, queries
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"
MARK = "<|endoftext|>"
#: Contractions, blanks of all kinds, signs, digits of several scripts, marks, a special token and pieces of one.
BITS = ["'s", "'re", "'ve", "'ll", "'l", "'", "'S", "''", " ", "  ", "\t", "\n", "\r\n", " ", "　", "\u0085", "don't", "we'll've", "a", "Z",
        "é", "é", "日本", "語", "١٢", "Ⅷ", "½", "12", "1", "!", "...", "-", "_", "\x00", "🙂", "👨‍👩‍👧", "﻿", "​", MARK, "<|endof", "text|>",
        "\U0003fc36", "Ᲊ", "\U00018d80", "word", "The", "ing"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tables():
    return bpe.vocabulary_tables(public_tokenizers.path("byte_bpe_50k.json"))


def with_words(tables, words):
    words = sorted(set(words))
    merges = bpe.Merges(tables)
    ids = [merges.one(w) for w in words]
    return {**tables, **automaton.compiled(words), "ids_begin": np.append(0, np.cumsum([len(x) for x in ids], dtype=np.int64)),
            "ids": np.array([x for xs in ids for x in xs] or [0], dtype=np.uint32)}


def test_words_merged_together_equal_words_merged_alone(tables):
    r = random.Random(6)
    merges = bpe.Merges(tables)
    words = [bytes(r.choice(b"aaaaeiounrst \xc3\xa9") for _ in range(r.randrange(1, 65))) for _ in range(3000)] + [b"a" * n for n in range(1, 65)]
    lengths = np.array([len(w) for w in words])
    ids, counts = merges.many(np.frombuffer(b"".join(words), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [merges.one(w) for w in words]


def test_automaton_ranks_its_strings_and_no_others():
    r = random.Random(1)
    strings = sorted({bytes(r.choice(b"abc\xff\x00") for _ in range(r.randrange(1, 9))) for _ in range(900)} | {bytes([k, k]) for k in range(256)})
    t = automaton.compiled(strings)
    asked = strings + [s + b"x" for s in strings] + [s[:-1] for s in strings] + [b"", b"zzz"]
    lengths = np.array([len(s) for s in asked])
    got = automaton.ranks(t, np.frombuffer(b"".join(asked), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths, 9)
    want = {s: k for k, s in enumerate(strings)}
    assert got.tolist() == [want.get(s, -1) for s in asked]
    states = automaton.minimal_states(strings)
    assert len(set(states)) == len(states) < sum(map(len, strings)) / 2
    back = automaton.to_bytes(t)
    assert len(back) % 64 == 0


def test_endings_are_shared():
    stems = [bytes([a, b]) for a in b"abcdefgh" for b in b"abcdefgh"]
    assert len(automaton.minimal_states(sorted(s + e for s in stems for e in (b"ing", b"ed", b"s")))) < 10


@pytest.mark.parametrize("words", [[], [b" the", b"The", b"word", b" ", b"12", b"!", b"ing", "日本".encode()]])
def test_ids_equal_the_library_on_odd_texts(tokenizer, tables, words):
    r = random.Random(2)
    encoder = bpe._Encoder(with_words(tables, words))
    texts = ["".join(r.choice(BITS) for _ in range(r.randrange(0, 12))) for _ in range(3000)]
    texts += ["".join(chr(r.choice([r.randrange(0xD800), r.randrange(0xE000, 0x110000)])) for _ in range(8)) for _ in range(500)]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(x, dtype="<u4").tolist() for x in encoder([t.encode() for t in texts])[0].to_pylist()]
    assert got == want
    back = bpe._decoder(tables)([np.array(x, dtype="<u4").tobytes() for x in want])[0].to_pylist()
    assert [b.decode() for b in back] == texts


def test_decoding_equals_the_library_on_any_ids(tokenizer, tables):
    r = random.Random(3)
    rows = [[r.randrange(50_257) for _ in range(r.randrange(0, 9))] for _ in range(500)]
    back = bpe._decoder(tables)([np.array(x, dtype="<u4").tobytes() for x in rows])[0].to_pylist()
    assert [b.decode() for b in back] == tokenizer.decode_batch(rows, skip_special_tokens=False)
    assert bpe._decoder(tables)([np.array([60_000, 64], dtype="<u4").tobytes(), b""])[0].to_pylist() == [b"a", b""]


def test_long_texts_are_cut_where_words_start(tokenizer, tables, monkeypatch):
    monkeypatch.setattr(bpe, "PART_BYTES", 500)
    encoder = bpe._Encoder(with_words(tables, [b" w12"]))
    texts = [prose(1, 2000) + MARK + " 's  x", "a" * 30_000, "", "12 " * 9_000]
    got = encoder([t.encode() for t in texts])[0].to_pylist()
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_invalid_bytes_are_read_as_replacement(tokenizer, tables):
    got = bpe._Encoder(with_words(tables, []))([b"ok \xff\xfe", "é".encode()])[0].to_pylist()
    assert np.frombuffer(got[0], dtype="<u4").tolist() == tokenizer.encode("ok ��", add_special_tokens=False).ids
    assert np.frombuffer(got[1], dtype="<u4").tolist() == tokenizer.encode("é", add_special_tokens=False).ids


def test_lexicon_is_the_most_frequent_words_of_all_rows(spark):
    rows = docs(spark, [(k, " b b b a a c") for k in range(30)] + [(99, None), (98, "")])
    counts = {bytes(r["word"]): r["n"] for r in bpe.word_counts(rows).collect()}
    assert counts == {b" b": 90, b" a": 60, b" c": 30}
    assert bpe.fit(rows, size=2).words == 2 and bpe.fit(rows, size=0).words == bpe.fit(empty(spark)).words == 0


def test_odd_rows(spark, tokenizer):
    rows = ODD_TEXTS + [(9, MARK), (9, f"x{MARK}{MARK} y"), (10, f"{MARK} z")]
    table_ = docs(spark, rows).withColumnRenamed("node", "IDS")
    lexicon = bpe.fit(table_)
    got = bpe.decode(bpe.encode(table_, lexicon), lexicon).collect()
    assert set(got[0].asDict()) == {"doc_id", "text", "row", "bytes", "ids", "decoded"} and len(got) == len(rows)
    for r in got:
        assert np.frombuffer(r["ids"], dtype="<u4").tolist() == tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["decoded"] == (r["text"] or "")
    assert bpe.decode(bpe.encode(empty(spark), lexicon), lexicon).count() == 0
    same = bpe.encode(table_, lexicon, decoded="decoded").select("ids", "decoded")
    assert sorted(map(str, same.collect())) == sorted(str(Row(ids=r["ids"], decoded=r["decoded"])) for r in got)


def test_query_equals_the_library(spark, tokenizer):
    got = {r["doc_id"]: r for r in queries.op11_bpe(spark, SF).collect()}
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert got[doc_id]["n_tokens"] == len(ids)
        assert got[doc_id]["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        back = tokenizer.decode(ids, skip_special_tokens=False)
        assert got[doc_id]["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
