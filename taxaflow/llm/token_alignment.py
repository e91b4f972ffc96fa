"""Where two tokenizers end tokens at the same byte of a text, and which of their ids end together how often.

A text's tokens become byte ranges on both sides; a two-pointer merge of the cumulative ends cuts them into groups,
and the last tokens of a group are linked. Both files cut texts before single spaces and around single line feeds,
so texts are encoded and merged unit by unit, with a bounded cache of units. Spark counts the links of the corpus,
finds each second id's highest count and joins both back to the documents.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, id_text, small_side, written
from .tokens import WordCache, _byte_letters

SPACE = "▁"
CACHED_CHARS = 64  # longer units are not kept
CACHE_UNITS = 150_000  # kept per generation; two generations live in each Python worker
_LETTERS = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
_MARKED = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?*$%&#]+)")
_RUNS = re.compile(r"\s\s|[^\S \n]|᠎")
_INK = r"[^\s᠎]"
_CUTS = re.compile(rf"(?<={_INK})(?= {_INK})|(?<={_INK})(?=\n{_INK})|(?<={_INK}\n)(?={_INK})")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


Unit = tuple[int, int, int, str, bytes]  # n_a, n_b, n_groups, groups, links
NOTHING = (0, 0, 0, "", b"")


def joined(units: list[Unit]) -> Unit:
    n_a, n_b, n_groups, groups, links = zip(*units, strict=True)
    return (sum(n_a), sum(n_b), sum(n_groups), ";".join(groups), b"".join(links))


class Aligner:
    """Aligns a byte-level file of the tokenizers library (on space + text) with a sentencepiece model (on text)."""

    def __init__(self, path_a: str, path_b: str, pair_type: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.model, self.letters = self.a.model, _byte_letters()
        self.b = SentencePieceProcessor(model_file=path_b)
        letters = {c: x for x, c in self.letters.items()}
        entries = {i: bytes(map(letters.__getitem__, t)) if all(c in letters for c in t) else t.encode() for t, i in self.a.get_vocab().items()}
        self.bytes_a = [entries.get(i, b"") for i in range(max(entries) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(len(self.b))]
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace(SPACE, " ").encode() for p in pieces]
        whole = [p for i, p in enumerate(pieces) if not self.b.is_byte(i)]
        self.pairs = {p[i : i + 2] for p in whole for i in range(len(p) - 1)}  # the library joins no others
        self.feed = self.b.encode("\n")
        if any("\n" in p or p[1] == SPACE != p[0] for p in self.pairs) or len(self.feed) != 2:
            raise ValueError("this model's pieces cross spaces or line feeds")
        self.len_a, self.len_b = (list(map(len, x)) for x in (self.bytes_a, self.bytes_b))
        self.str_a, self.str_b = (list(map(str, range(len(x)))) for x in (self.bytes_a, self.bytes_b))
        self.size, self.pack = len(self.bytes_b), struct.Struct("<i" if pair_type == "int" else "<q").pack
        self.plain, self.spaced = WordCache(self.found, CACHE_UNITS // 4), WordCache(lambda word: self.found(" " + word), CACHE_UNITS)

    def ids_a(self, text: str) -> list[int]:
        if _LETTERS.fullmatch(text):  # one pre-token
            return [t.id for t in self.model.tokenize(text.encode().decode("latin-1").translate(self.letters))]
        return self.a.encode(text, add_special_tokens=False).ids

    def ids_b(self, text: str) -> list[int]:
        """Ids of a unit of space + text; the library adds the space itself. Other units are read behind a line feed, whose ids are taken off."""
        return self.b.encode(text[1:]) if text[0] == " " else self.b.encode("\n" + text)[len(self.feed) :]

    def unit(self, text: str) -> Unit | None:
        """Both pointers walk to the next end that both sides have. None if a side's bytes are not the text's."""
        data, a, b = text.encode(), self.ids_a(text), self.ids_b(text)
        if b"".join([self.bytes_a[i] for i in a]) != data or b"".join([self.bytes_b[i] for i in b]) != data:
            return None
        if len(a) == 1 or len(b) == 1:  # one group
            return (len(a), len(b), 1, f"{','.join(map(str, a))}|{','.join(map(str, b))}", self.pack(a[-1] * self.size + b[-1]))
        len_a, len_b, str_a, str_b = self.len_a, self.len_b, self.str_a, self.str_b
        groups, links, other = [], [], iter(b)
        part_a, part_b, ahead = "", "", 0  # ids since the last common end, and the bytes by which the first side leads
        for x in a:
            part_a += "," + str_a[x] if part_a else str_a[x]
            ahead += len_a[x]
            while ahead > 0:
                y = next(other)
                part_b += "," + str_b[y] if part_b else str_b[y]
                ahead -= len_b[y]
            if not ahead:
                groups.append(f"{part_a}|{part_b}")
                links.append(x * self.size + y)
                part_a = part_b = ""
        return (len(a), len(b), len(links), ";".join(groups), b"".join(map(self.pack, links)))

    def found(self, text: str) -> Unit | None:
        """A unit, taken apart between letters and marks if no piece holds both neighbours."""
        if (m := _MARKED.fullmatch(text)) and m[1][-1] + m[2][0] not in self.pairs:
            parts = [self.spaced[m[1][1:]] if m[1][0] == " " else self.plain[m[1]], self.plain[m[2]]]
            return None if None in parts else joined(parts)
        return self.unit(text)

    def units(self, text: str) -> list[Unit | None]:
        """Of space + text, cut where both files cut."""
        out: list[Unit | None] = []
        if _RUNS.search(text) or text[0] in " \n":
            for part in _CUTS.split(" " + text):
                out.append(self.unit(part) if len(part) > CACHED_CHARS else self.spaced[part[1:]] if part[0] == " " else self.plain[part])
            return out
        for n, line in enumerate(text.split("\n")):  # neither spaces nor line feeds stand side by side
            words = line.split(" ")
            if n:
                out.append(self.plain["\n"])
                if words[0]:
                    out.append(self.unit(words[0]) if len(words[0]) > CACHED_CHARS else self.plain[words[0]])
                del words[0]
            if len(line) > CACHED_CHARS and max(map(len, words), default=0) > CACHED_CHARS:
                out += [self.unit(" " + w) if len(w) > CACHED_CHARS else self.spaced[w] for w in words]
            else:
                out += map(self.spaced.__getitem__, words)
        return out

    def align(self, text: str) -> Unit:
        """Of a whole text; all zero if it is empty or if a side's bytes differ from space + text."""
        if not text:
            return NOTHING
        units = self.units(text)
        if None in units:
            return self.unit(" " + text) or NOTHING
        return joined(units)


_ALIGNERS: dict[tuple, Aligner] = {}


def aligned_tokens(docs: DataFrame, path_a: str, path_b: str, keep_groups: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes and returns row (a number of its own), doc_id, n_a, n_b, n_groups, groups_sha256 and links (first id * size of
    the second vocabulary + second id, for each group), and groups as text if asked for. No shuffle.

    Null and empty texts, and texts whose tokens' bytes on either side differ from space + text, have zeros, an empty
    digest and no links. Null and repeated doc_ids are kept as they are; other columns are not read.
    """
    sizes = _vocabularies(path_a, path_b)
    pair_type = "int" if sizes[0] * sizes[1] < 2**31 else "long"
    schema = f"row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links array<{pair_type}>" + ", groups string" * keep_groups

    def align(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = (path_a, path_b, pair_type)
        if key not in _ALIGNERS:
            _ALIGNERS[key] = Aligner(*key)
        aligner, kind = _ALIGNERS[key], np.dtype("<i4" if pair_type == "int" else "<i8")
        for frame in frames:
            units = [aligner.align(t) for t in frame["text"]]
            out = pd.DataFrame({"row": frame["row"], "doc_id": frame["doc_id"].astype("Int64")})
            out["n_a"], out["n_b"], out["n_groups"] = ([u[k] for u in units] for k in range(3))
            out["groups_sha256"] = [hashlib.sha256(u[3].encode()).hexdigest() if u[3] else "" for u in units]
            out["links"] = [np.frombuffer(u[4], kind) for u in units]
            if keep_groups:
                out["groups"] = [u[3] for u in units]
            yield out

    bounded_batches(docs.sparkSession)
    rows = id_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    return written(rows.mapInPandas(align, schema), "aligned")


def _vocabularies(path_a: str, path_b: str) -> tuple[int, int]:
    from sentencepiece import SentencePieceProcessor

    with open(path_a, encoding="utf-8") as f:
        file = json.load(f)
    return max([*file["model"]["vocab"].values(), *(t["id"] for t in file["added_tokens"])]) + 1, len(SentencePieceProcessor(model_file=path_b))


def link_counts(aligned: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """pair, a, b, count of each linked pair of ids in the corpus, and whether it is its second id's highest (best: 1 or 0;
    all that tie are). Links are counted in tasks before they are shuffled; what follows is bounded by the vocabularies."""
    size = _vocabularies(path_a, path_b)[1]
    pairs = aligned.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("count"))
    pairs = written(pairs.withColumns({"a": F.floor(F.col("pair") / size), "b": F.col("pair") % size}), "pairs")
    most = pairs.groupBy("b").agg(F.max("count").alias("most"))
    return written(pairs.join(most, "b").select("pair", "a", "b", "count", (F.col("count") == F.col("most")).cast("int").alias("best")), "pair-counts")


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row.

    n_links: links of the row, one a group, as two tokens end together once; n_best: those whose pair has the highest count among
    the pairs of its second id; count_sum: their pairs' counts, summed. Counts are of all rows. The pairs are broadcast where they are
    counted to be few, else joined by a shuffle that AQE splits at frequent pairs. Cases as in ``aligned_tokens``; an
    empty table gives an empty result.
    """
    aligned = aligned_tokens(docs, path_a, path_b, id_col=id_col, text_col=text_col)
    counts = small_side(link_counts(aligned, path_a, path_b).select("pair", "count", "best"))
    links = aligned.select("row", F.explode("links").alias("pair")).join(counts, "pair")
    sums = links.groupBy("row").agg(F.count(F.lit(1)).alias("n_links"), F.sum("best").alias("n_best"), F.sum("count").alias("count_sum"))
    joined = aligned.drop("links").join(sums, "row", "left")
    return joined.select("doc_id", "n_a", "n_b", "n_groups", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_links", "n_best", "count_sum")), "groups_sha256")
