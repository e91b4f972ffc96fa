"""Exact token counts of a byte-pair vocabulary by heap and linked list, without making any ids.

A text's count is its initial symbols minus the merges made: the lowest-ranked adjacent pair (the leftmost of
equals) is popped from a heap and joined in a linked list until no pair is in the vocabulary. A character
that no piece holds counts once for each of its UTF-8 bytes. Merges never cross two characters that stand
side by side in no piece, so a text falls apart there first, and the parts' counts are kept in a bounded cache.
"""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text
from .tokens import WordCache

SPACE = "▁"
_PARTS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def count_symbols(part: str, ranks: dict[str, float]) -> int:
    """Symbols left of ``part`` when no adjacent pair is in ``ranks`` any more."""
    n = len(part)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # by a symbol's first character; after: its end
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(part[i : i + 2])) is not None]
    heapify(heap)
    symbols = n
    alive = [True] * (n + 1)
    while heap:
        _, left, mid, end = heappop(heap)
        if not alive[left] or after[left] != mid or not alive[mid] or after[mid] != end:
            continue
        symbols -= 1
        after[left], alive[mid] = end, False
        if end < n:
            before[end] = left
            if (r := ranks.get(part[left : after[end]])) is not None:
                heappush(heap, (r, left, end, after[end]))
        if (p := before[left]) >= 0 and (r := ranks.get(part[p:end])) is not None:
            heappush(heap, (r, p, left, end))
    for i, c in enumerate(part):  # single characters outside the vocabulary fall back to bytes
        if alive[i] and after[i] == i + 1 and c not in ranks:
            symbols += len(c.encode()) - 1
    return symbols


class PieceCounter:
    """Counts of a sentencepiece byte-pair model file with identity normalisation and byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        ids = [i for i in range(len(sp)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.ranks = {sp.id_to_piece(i): -sp.get_score(i) for i in ids}
        self.pairs = {p[i : i + 2] for p in self.ranks for i in range(len(p) - 1)}
        if any(p[1] == SPACE != p[0] for p in self.pairs) or sp.encode(" \n  a", out_type=str)[:2] != [SPACE * 2, "<0x0A>"]:
            raise ValueError("this model's spaces are not as expected")
        self.cache = WordCache(self.part)

    def part(self, word: str) -> int:
        """A space mark (or several) and what follows up to the next."""
        cuts = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in self.pairs]
        if not cuts:
            return count_symbols(word, self.ranks)
        return sum(self.cache[word[a:b]] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True))

    def count(self, text: str) -> int:
        if not text:
            return 0
        return sum(map(self.cache.__getitem__, _PARTS.findall(SPACE + text.replace(" ", SPACE))))


_COUNTERS: dict[str, PieceCounter] = {}


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit of each row, as the model's own library would count.

    No shuffle: one pass over the texts. Null texts count as empty (0 bytes, 0 tokens); null and repeated
    doc_ids are kept as they are; other columns are not read; an empty table gives an empty result.
    """

    @F.arrow_udf("long")
    def tokens(texts: pa.Array) -> pa.Array:
        if model_path not in _COUNTERS:
            _COUNTERS[model_path] = PieceCounter(model_path)
        count = _COUNTERS[model_path].count
        return pa.array((count(t.as_py()) for t in texts), pa.int64())

    docs = id_text(docs)
    return docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), tokens("text").alias("n_tokens")).withColumn("over_limit", F.col("n_tokens") > limit)
