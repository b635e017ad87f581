"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut into pre-tokens; each pre-token starts as a linked list of byte symbols. A heap holds the adjacent pairs
that can merge; the lowest rank (leftmost on ties) is popped again and again, stale entries are passed over. The count
is the number of initial symbols minus the number of merges; identifiers are never written out.

Memory: one pre-token's list and heap, a vocabulary (some MB) and a bounded memo of counts per Python worker.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablelog.llm.common import bounded_batches

# The published byte-level pre-token pattern.
PRETOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Entries of the memo, and the longest pre-token (characters) that it keeps. The counts do not depend on either.
MEMO, MEMO_CHARS = 1_000_000, 64
LONG_TEXT = 1 << 20


def byte_alphabet() -> dict[int, str]:
    """Printable stand-ins of the 256 bytes: visible Latin-1 characters stand for themselves, the others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return out


class Merger:
    """Counts tokens as the vocabulary file (tokenizers JSON, byte-level BPE) defines them."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or spec["normalizer"] or pre.get("add_prefix_space"):
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens that strip or need word bounds are not handled")
        vocab = model["vocab"]
        if len(vocab) > 1 << 17 or len(model["merges"]) > 1 << 20:
            raise ValueError(f"{path}: vocabulary too large")
        alphabet = byte_alphabet()
        self.first = [vocab[alphabet[b]] for b in range(256)]
        self.pairs: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs.setdefault(vocab[left] << 17 | vocab[right], rank << 52 | vocab[left + right])
        self.words = regex.compile(PRETOKEN)
        added = sorted((a["content"] for a in spec["added_tokens"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.memo: dict[str, int] = {}

    def merged(self, data: bytes) -> int:
        """Symbols left of data when no adjacent pair can merge."""
        n = left = len(data)
        if n < 2:
            return n
        get = self.pairs.get
        symbol = [self.first[b] for b in data]
        heap = [v | i << 17 for i in range(n - 1) if (v := get(symbol[i] << 17 | symbol[i + 1])) is not None]
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            item = heappop(heap)
            i = item >> 17 & 0x7FFFFFFFF
            j = after[i]
            if symbol[i] < 0 or j >= n or get(symbol[i] << 17 | symbol[j]) != item ^ i << 17:
                continue  # one side has merged since
            symbol[i], symbol[j] = item & 0x1FFFF, -1
            left -= 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (v := get(symbol[i] << 17 | symbol[k])) is not None:
                    heappush(heap, v | i << 17)
            if (h := before[i]) >= 0 and (v := get(symbol[h] << 17 | symbol[i])) is not None:
                heappush(heap, v | h << 17)
        return left

    def plain(self, text: str) -> int:
        total, memo = 0, self.memo
        found = self.words.findall(text) if len(text) < LONG_TEXT else (m.group() for m in self.words.finditer(text))
        for w in found:
            c = memo.get(w)
            if c is None:
                c = self.merged(w.encode())
                if len(w) <= MEMO_CHARS:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[w] = c
            total += c
        return total

    def count(self, text: str) -> int:
        """Tokens of text; the file's added tokens count as one each where their strings occur."""
        if self.added is None or not (cuts := [m.span() for m in self.added.finditer(text)]):
            return self.plain(text)
        at = total = 0
        for a, b in cuts:
            total += self.plain(text[at:a]) + 1
            at = b
        return total + self.plain(text[at:])


@lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    return Merger(path)


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = 1024) -> DataFrame:
    """One row per input row: the id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > max_tokens).

    vocabulary: path of a tokenizers JSON file, the same on every machine. No begin, end or other special tokens are
    added; strings of the file's added tokens count as the library counts them by default. No truncation.
    Null text counts as empty: 0, 0, False. A null id stays null; repeated rows give repeated rows; an empty table gives
    an empty result; other columns of docs, whatever their names, are neither read nor returned. Narrow: no shuffle.
    """
    schema = T.StructType([docs.schema[id_col], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(vocabulary)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for x in batch.column(1):
                text = x.as_py() or ""
                n_bytes.append(len(text.encode()))
                n_tokens.append(m.count(text))
            columns = [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > max_tokens for n in n_tokens], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    bounded_batches(docs.sparkSession)
    return docs.select(id_col, text_col).mapInArrow(count, schema)
