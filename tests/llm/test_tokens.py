import random
import struct
import zlib
from collections import Counter

import public_tokenizers as P
import pyarrow.fs
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from taxaflow.llm.packing import cut, pack_documents, plan_best_fit
from taxaflow.llm.token_count import PieceCounter, count_tokens
from taxaflow.llm.token_frames import FrameReader, read_token_frames, token_frames, write_token_frames
from taxaflow.llm.tokens import ByteEncoder, WordCache, WordEncoder

WORDS, BYTES, PIECES = (P.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
HARD = [
    "", " ", "  a  b \n\n c", "\n", "a\n b", " x\ty\t z ", "it's we'll I'd <|endoftext|>x <|endoftext|> y", "x y   z ", "日本語 テスト é́ é İ ΑΣ straße",
    "a'b 's  's", "foo.bar, baz!!! 123 4a5", "\x1c a\x1c \x00", "🙂🙂 ok", "trail \n", "a \nb", "a\n\n b", "ſ ª º", "<s> </s> <unk> <0x0A>", "▁ ▁▁x", "a" * 5000, "word " * 3000,
]


def texts():
    rng = random.Random(8)
    alphabet = ["the", "Éte", "x1", "...", "'s", " ", "  ", "\n", "\t", "ñ", "Ab", "9", "<|endoftext|>", " ", "\xa0", "é", "!?", "▁", "🙂"]
    return HARD + ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(400)] + [" ".join(rng.choices(alphabet, k=40)) for _ in range(100)]


def ids_of(file, text):
    ids = Tokenizer.from_file(file).encode(text, add_special_tokens=False).ids
    return struct.pack(f"<{len(ids)}I", *ids)


@pytest.mark.parametrize("kind, file", [(WordEncoder, WORDS), (ByteEncoder, BYTES)])
def test_ids_are_the_librarys(kind, file):
    own = kind(file)
    library = Tokenizer.from_file(file)
    for text, want in zip(texts(), library.encode_batch(texts(), add_special_tokens=False), strict=True):
        assert own.encode(text) == struct.pack(f"<{len(want.ids)}I", *want.ids), text


def test_counts_are_the_librarys():
    own, library = PieceCounter(PIECES), SentencePieceProcessor(model_file=PIECES)
    for text in texts():
        assert own.count(text) == len(library.encode(text)), text


def test_cache_forgets_but_stays_right():
    cache = WordCache(len, 3)
    for w in ["a", "bb", "ccc", "dddd", "a", "bb", "eeeee"] * 5:
        assert cache[w] == len(w)
        assert len(cache) + len(cache.old) <= 7


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, ids int, start string")


def test_token_frames_round_trip(spark, tmp_path):
    rows = [(i * 7 % 101, t) for i, t in enumerate(texts()[:101])] + [(None, "nobody"), (5, "again"), (5, None)]
    got = token_frames(frame(spark, rows), WORDS).collect()
    assert [r.start for r in sorted(got, key=lambda r: r.start)][0] == 0
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((d for d, _ in rows), key=lambda d: -1 if d is None else d)
    at = 0
    for r in ordered:
        assert r.start == at
        at += r.n_tokens
    end = struct.pack("<I", 1)
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == Counter((d, ids_of(WORDS, t or "") + end) for d, t in rows)

    path = f"file://{tmp_path}/tokens"
    write_token_frames(frame(spark, rows), path, WORDS)
    some = read_token_frames(spark, path, [5, 100, 9999]).collect()
    assert sorted(r.doc_id for r in some) == [5, 5, 5, 100]
    assert {(r.start, bytes(r.ids)) for r in some} <= {(r.start, bytes(r.ids)) for r in got}
    assert token_frames(frame(spark, []), WORDS).count() == 0


def test_damage_is_found(spark, tmp_path):
    path = f"file://{tmp_path}/tokens"
    m = write_token_frames(frame(spark, [(1, "some text here"), (2, "and more")]).coalesce(1), path, WORDS).collect()[0]
    file = tmp_path / "tokens" / m.file
    data = bytearray(file.read_bytes())
    with pyarrow.fs.LocalFileSystem().open_input_file(str(file)) as f:
        assert [d for d, _, _ in FrameReader(f, m.n_bytes).read({2})] == [2]
    data[8] ^= 1
    file.write_bytes(bytes(data))
    with pyarrow.fs.LocalFileSystem().open_input_file(str(file)) as f, pytest.raises(Exception, match=r"(?i)damaged|decompress|checksum"):
        list(FrameReader(f, m.n_bytes).read())


def test_count_query_edges(spark):
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(frame(spark, [(1, None), (2, "é"), (None, ""), (3, "a b " * 3000)]), PIECES).collect()}
    n = len(SentencePieceProcessor(model_file=PIECES).encode("a b " * 3000))
    assert got == {(1, 0, 0, False), (2, 2, len(SentencePieceProcessor(model_file=PIECES).encode("é")), False), (None, 0, 0, False), (3, 12000, n, True)}
    assert count_tokens(frame(spark, []), PIECES).count() == 0


def best_fit_by_piece(lengths, capacity):
    from bisect import bisect_left, insort

    rooms = []
    for n in sorted(lengths, reverse=True):
        i = bisect_left(rooms, n)
        insort(rooms, (rooms.pop(i) if i < len(rooms) else capacity) - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 32, 100, 1024])
    lengths = [min(capacity, max(1, int(rng.expovariate(1 / (capacity * rng.choice([0.1, 0.3, 0.6])))))) for _ in range(rng.choice([5, 100, 3000]))]
    plan, used, ranks = plan_best_fit(Counter(lengths), capacity), {}, Counter()
    for length, first, count, each, sequence, offset in plan:
        assert ranks[length] == first
        ranks[length] += count
        for k in range(count):
            used.setdefault(sequence + k // each, []).append((offset + k % each * length, length))
    assert ranks == Counter(lengths)
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(used) == best_fit_by_piece(lengths, capacity)


def test_packing_of_a_table(spark):
    rows = list(enumerate(texts())) + [(3, "x"), (3, "x"), (None, None), (900, "word " * 5000), (901, None)]
    got = pack_documents(frame(spark, rows), BYTES, capacity=256).collect()
    whole = {}
    for r in got:
        assert r.ids_crc32 == zlib.crc32(r.ids)
        assert len(r.ids) == 4 * r.length
        whole.setdefault(r.sequence_id, []).append(r)
    for pieces in whole.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    end = struct.pack("<I", 2)
    want = Counter()
    for d, t in rows:
        ids = ids_of(BYTES, t or "") + end
        for piece, (start, n) in enumerate(cut(len(ids) // 4, 256)):
            want[d, piece, start, ids[4 * start : 4 * (start + n)]] += 1
    assert Counter((r.doc_id, r.piece, r.start, bytes(r.ids)) for r in got) == want
    assert len(whole) == best_fit_by_piece([r.length for r in got], 256)
    assert pack_documents(frame(spark, []), BYTES).agg(F.count("*")).first()[0] == 0
