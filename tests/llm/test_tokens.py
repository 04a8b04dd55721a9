"""Byte-level BPE, token files: against the tokenizer libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from ledgerlens.llm import byte_bpe, token_store
from ledgerlens.llm.common import scratch


@pytest.fixture(scope="module")
def vocab():
    return byte_bpe.vocabulary(byte_bpe.default_ranks())


@pytest.fixture(scope="module")
def library(vocab):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})


def check(vocab, library, texts):
    ids, ends, counts = vocab.encode(texts)
    a = 0
    for t, n in zip(texts, counts):
        assert ids[a:a + n].tolist() == library.encode_ordinary(t), repr(t[:80])
        a += n
    assert a == len(ids)


def test_pieces_and_merges_like_the_library(vocab, library):
    random.seed(5)
    alphabet = "'  \n\t aestmdrvlxLSéß漢1²९.!? 😀_\x1c\x85- "
    check(vocab, library, ["".join(random.choices(alphabet, k=random.randint(0, 40))) for _ in range(8000)])


def test_long_pieces_use_the_heap(vocab, library):
    random.seed(6)
    check(vocab, library, ["banana" * 400, "".join(random.choices("abc", k=3000)), " " * 2000, "", "x"])


def test_long_merge_equals_side_by_side_merge(vocab):
    random.seed(7)
    for _ in range(200):
        p = "".join(random.choices("thequickbrown ", k=random.randint(2, 60))).encode()
        if p not in vocab.ranks:
            assert vocab._merge_long(p) == vocab.merge([p])[0]


def test_cache_that_overflows_changes_nothing(vocab, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_PIECES", 50)
    vocab.cache.clear()
    check(vocab, library, [f"word{i} other{i * 7} '{i}" for i in range(300)])


def test_scan_is_the_automaton_run_one_by_one():
    random.seed(8)
    symbols = np.array(random.choices(range(byte_bpe.N_SYM), k=3000), np.uint8)
    state, want = byte_bpe.START, []
    for y in symbols:
        state = byte_bpe._next_state(state, int(y))
        want.append(state)
    assert byte_bpe.states(symbols).tolist() == want


def brute_bpe(library, text):
    ids = library.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_roundtrip_edge_cases(spark, edge, empty, library):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256)
                 for r in byte_bpe.roundtrip(edge).collect())
    want = sorted((r.doc_id is None, r.doc_id or 0, *brute_bpe(library, r.text)) for r in edge.collect())
    assert got == want
    assert byte_bpe.roundtrip(empty).count() == 0


def test_decode_and_ends(spark, edge):
    enc = byte_bpe.encode(edge.filter("doc_id in (4, 11, 9)"))
    ends = {r.doc_id: r.ends for r in enc.collect()}
    got = {r.doc_id: bytes(r.decoded) for r in byte_bpe.decode(enc).collect()}
    want = {r.doc_id: r.text.encode() for r in edge.filter("doc_id in (4, 11, 9)").collect()}
    assert got == want and all(ends[i][-1] == len(want[i]) for i in want)


def test_token_files_edge_cases(spark, edge, empty):
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = sorted(edge.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    start, want = 0, []
    for r in rows:
        ids = [*lib.encode(r.text or "", add_special_tokens=False).ids, 1]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        start += len(ids)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_store.write_and_check(edge).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    assert token_store.write_and_check(empty).count() == 0


def test_sequences_are_equal_and_masked(spark, documents):
    path = scratch(spark, "sequences")
    index = token_store.write(documents, path, sequence=64)
    row = index.orderBy("start").first()
    total = index.filter(index.file == row.file).agg({"n_tokens": "sum"}).first()[0]
    f = token_store.SequenceFile(row.file)
    masks = []
    for i in range(-(-total // 64)):
        ids, mask = f.sequence_at(i)
        assert len(ids) == len(mask) == 64 and not ids.flags.owndata  # a view of the mapped file
        again = f.sequence_at(i)[1]
        assert mask.buffers()[1].address == again.buffers()[1].address  # the mapped bits themselves
        masks.append(mask.to_numpy(zero_copy_only=False))
    masks = np.concatenate(masks)
    assert masks[:total].all() and not masks[total:].any()
    f.close()


def test_word_cache_that_overflows_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_store, "CACHE_WORDS", 40)
    enc = token_store.WordEncoder(token_store.default_tokenizer())
    texts = [f"Word{i}, Émile{i % 9}! don't <|endoftext|> ǅ ΑΣ. é́{i}" for i in range(200)]
    for t in texts:
        assert np.frombuffer(enc.encode([t.encode()])[0], enc.dtype).tolist() == \
            enc.tokenizer.encode(t, add_special_tokens=False).ids


def test_words_equal_the_library_on_marks_capitals_and_special_strings():
    """Combining marks, capitals that gain or lose a composed form, composition
    exclusions, special-token strings, odd white space: ids as the library gives."""
    enc = token_store.WordEncoder(token_store.default_tokenizer())
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    texts = ["BELKİ.", "H̱ello", "J̌an", "T̈", "W̊ x", "क़.", "a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|>", "ΑΣ ΟΔΟΣ. ς",
             "É e\u0301 E\u0301x \u0301a a\u0301. ÿŸ ß ẞ ǅ ﬁ Å K", "x\u00a0y \u2028z \x1cq", "don't I'LL 'S it's", "ªº µ × ÷ Ø ø"]
    rng = random.Random(11)
    parts = ["a", "E", "ñ", "Ñ", "İ", "ı", "ß", "\u0301", "\u0308", "\u0331", "\u030c", "\u0327", "क", "\u093c", "Σ", "漢", "1", ".", "!", "'s",
             "<|endoftext|>", "<|", "|>", " ", "\n", "\u00a0", "\u200d", "K", "Ç", "ÿ", "\u1100", "\u1161", "한"]
    texts += ["".join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(6000)]
    for t, got in zip(texts, enc.encode([t.encode() for t in texts])):
        assert np.frombuffer(got, enc.dtype).tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_a_word_part_is_learnt_once_for_all_texts(monkeypatch):
    """Words are not looked up one by one: capitals, marks and repeats of a word share one look-up a chunk."""
    enc = token_store.WordEncoder(token_store.default_tokenizer())
    asked = []

    class Asked(dict):
        def __getitem__(self, piece):
            asked.append(piece)
            return enc._piece(piece)

    enc.pieces = Asked()
    texts = pa.array(["Émile émile, ÉMILE! odd1 ", "", "  ", "émile;\x0bodd1 odd1, zebra. " * 500])
    ids, counts = enc.encode_rows(texts.slice(1))
    assert sorted(asked) == sorted(["émile".encode(), b"zebra", b";", b"."])
    asked.clear()
    ids, counts = enc.encode_rows(texts)
    assert sorted(asked) == sorted(["émile".encode(), b"zebra", b"", b",", b"!", b";", b"."])
    want = [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts.to_pylist()]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert enc.encode([]) == []


def test_caches_of_word_parts_that_overflow_change_nothing(monkeypatch):
    monkeypatch.setattr(token_store, "CACHE_PIECES", 20)
    enc = token_store.WordEncoder(token_store.default_tokenizer())
    for i in range(60):
        t = f"Word{'xyz'[i % 3] * (i % 30)} émile{chr(97 + i % 26)}, Zebra{chr(97 + i % 25)}."
        assert np.frombuffer(enc.encode([t.encode()])[0], enc.dtype).tolist() == \
            enc.tokenizer.encode(t, add_special_tokens=False).ids
        assert len(enc.pieces) <= 20 + 5


def test_null_and_repeated_ids_are_spread(spark):
    rows = [(None, f"text {i} " * 3) for i in range(3000)] + [(5, f"other {i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # few rows would make one partition
    try:
        index = token_store.write(df, scratch(spark, "spread"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert index.groupBy("part").count().agg({"count": "max"}).first()[0] < 2500
    got = index.orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] * 3000 + [5] * 1000
    assert all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:]))
