"""Token alignment against whole texts in the libraries and sets of ends."""

import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from taxaflow.llm import common
from taxaflow.llm.token_alignment import Aligner, align_tokenizers, aligned_tokens, link_counts
from taxaflow.llm.tokens import _byte_letters

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = ["", " ", "\n", "a", "  two  spaces\n\n next\n line\tend ", "<|endoftext|> in <s>text</s> <unk>", "▁ a mark", "a▁b", "it's\n'tis 'twas we'll", "日本語 テキスト\nです", "é" * 900, "x" * 3000, "\x00 nul \x1c fs\x85nel", "a\n᠎b c", "tail\n", "\nhead", "<0x0A> as text", "𝔘nicode 🎉🎊 ok", "1234567 89,10.11 $5 50%"]


@pytest.fixture(scope="module")
def library():
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = {c: x for x, c in _byte_letters().items()}
    vocab = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t, i in a.get_vocab().items()}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def align(text):
        """(ids of a, ids of b, groups as text, linked pairs) by sets of ends over the whole text."""
        if not text:
            return [], [], "", []
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text))
        data = [[vocab[i] for i in ids[0]], [piece(i) for i in ids[1]]]
        if any(b"".join(d) != (" " + text).encode() for d in data):
            return [], [], "", []
        ends = []
        for d in data:
            at, own = 0, []
            for x in d:
                at += len(x)
                own.append(at)
            ends.append(own)
        both = sorted(set(ends[0]) & set(ends[1]))
        parts, low, links = [], 0, []
        for end in both:
            of = [[i for i, e in zip(ids[k], ends[k], strict=True) if low < e <= end] for k in (0, 1)]
            parts.append("|".join(",".join(map(str, x)) for x in of))
            links.append((of[0][-1], of[1][-1]))
            low = end
        return *ids, ";".join(parts), links

    return align


def wanted(rows, library):
    found = [(i, *library(t)) for i, t in rows]
    counts = Counter(x for f in found for x in f[4])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for i, a, b, groups, links in found:
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out.append((i, len(a), len(b), len(links), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest))
    return sorted(out, key=repr), counts


def rows():
    rng, words = random.Random(4), ["the", "Haus", "l'été", "42", "naïve", "x_y", "(so)", "—", "don't", "ñandú.", "日本", "ok,", "UPPER", "🎉"]
    made = ["".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", "  ", "\n\n", "\t"]) for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    return [(i, t) for i, t in enumerate([*ODD, *made, made[0], made[0]])] + [(None, "no id"), (7, "an id twice"), (90, None)]


def test_whole_texts(spark, library):
    docs = spark.createDataFrame([(i, t, "x", 5) for i, t in rows()], "doc_id long, text string, links string, row int")
    want, counts = wanted(rows(), library)
    assert sorted((tuple(r) for r in align_tokenizers(docs, A, B).collect()), key=repr) == want
    aligned = aligned_tokens(docs, A, B, keep_groups=True)
    assert {r.groups for r in aligned.collect()} == {library(t)[2] for _, t in rows()}
    assert {(r.a, r.b): r["count"] for r in link_counts(aligned, A, B).collect()} == counts


def test_joined_without_a_broadcast(spark, library, monkeypatch):
    monkeypatch.setattr(common.small_side, "__defaults__", (0,))
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    assert sorted((tuple(r) for r in align_tokenizers(docs, A, B).collect()), key=repr) == wanted(rows(), library)[0]


def test_units_as_whole_texts():
    """Texts of odd characters, unit by unit and at once."""
    aligner, rng = Aligner(A, B, "int"), random.Random(8)
    letters = " \n\t\r abcXYZ'’.,-_<>|0123éß日本🎉▁ ​́\x1c"
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randrange(1, 40)))
        assert aligner.align(text) == (aligner.unit(" " + text) or (0, 0, 0, "", b"")), repr(text)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align_tokenizers(docs, A, B).count() == 0
