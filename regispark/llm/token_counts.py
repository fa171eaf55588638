"""Token counts of whole texts by a two-tier lookup on the map side.

A byte-level BPE splits a text into pre-tokens first; the tokens of a text are those of its
pre-tokens. Tier one is a broadcast table of the token counts of frequent pre-tokens; tier
two encodes the rest with the library and keeps them in a cache of the task, bounded in
entries and emptied when full. No pre-token is shuffled: only the table's candidates, from
a bounded sample of documents, are. The table is a cache and changes no result.

Pre-tokens are cut here by the vocabulary's own pattern for texts whose characters all lie
in ``SAME``, where this cut and the library's are tested to agree; other texts are encoded
whole by the library. Special strings inside texts count as the library's default has it: one
token each. Defined results: a null text is empty and has 0 bytes and tokens.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from regispark.llm.common import bounded_sample, slices, strings

#: Fixed value: the pre-token pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters on which the cuts agree: Latin letters and signs, dashes, quotes, the euro.
SAME = "\\t\\n\\r\\x20-\\x7e\\xa1-\\u024f\\u2010-\\u2027\\u20ac"
#: Longer pre-tokens are encoded but not cached.
LONGEST_CACHED = 256


def default_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


class Counting:
    """Token counts of texts, for one task."""

    def __init__(self, path: str | None, table: dict[str, int], cache_entries: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or default_path())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.pattern, self.other = regex.compile(PATTERN), regex.compile(f"[^{SAME}]")
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.table, self.cache, self.cache_entries = table, {}, cache_entries

    def encode(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False))

    def miss(self, piece: str) -> int:
        n = self.cache.get(piece)
        if n is None:
            n = self.encode(piece)
            if len(piece) <= LONGEST_CACHED:
                if len(self.cache) >= self.cache_entries:
                    self.cache.clear()
                self.cache[piece] = n
        return n

    def pieces(self, text: str) -> list[str] | None:
        return None if self.other.search(text) else self.pattern.findall(text)

    def plain(self, text: str) -> int:
        pieces = self.pieces(text)
        if pieces is None:
            return self.encode(text)
        get, miss = self.table.get, self.miss
        return sum([get(p) or miss(p) for p in pieces])

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        if self.other.search(text):
            return self.encode(text)
        parts = self.special.split(text)
        return sum(map(self.plain, filter(None, parts))) + len(parts) - 1


def frequent_pieces(docs: DataFrame, path: str | None, sample_docs: int = 2000, entries: int = 50_000) -> dict[str, int]:
    """Token counts of the ``entries`` most frequent pre-tokens of ``sample_docs`` documents
    (those of the least hash); the table is at most a few MB."""
    sample = bounded_sample(docs, "doc_id", sample_docs).select(F.col("text").cast("string").alias("text")).where("text is not null")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = Counting(path, {})
        for batch in batches:
            seen: Counter = Counter()
            for text in strings(batch):
                seen.update(p for p in counting.pieces(text) or () if len(p) <= 32)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["piece", "n"])

    rows = sample.mapInArrow(tally, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(entries).collect()
    counting = Counting(path, {})
    return {r["piece"]: counting.encode(r["piece"]) for r in rows}


def token_counts(docs: DataFrame, limit: int = 1024, path: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent_pieces(docs, path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = Counting(path, shared.value)
        for batch in slices(batches):
            n = [counting.count(t) for t in strings(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long")).alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(count, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
