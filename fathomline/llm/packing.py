"""Packing by best-fit decreasing with a segment tree over remaining capacity.

Tokenising is one map pass that emits piece metadata only (a few numbers a document); ids never shuffle. The tokenizer
drops white space and joins nothing across it, nor across the border of ASCII letters, marks and digits, so each distinct
part of a word is encoded once and documents are put together from the parts' ids. Overlong documents are first cut into full windows. The remaining pieces are dealt to
shards of bounded size by a hash of the piece; each shard packs itself, so padding is at most part of its last windows.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.shared import checkpointed
from fathomline.llm.wordvec import _SPACE, chunks, column, ranges, tokenise

#: Tokens of leftover pieces in a shard, about; it bounds a packing task and the padding share.
SHARD_TOKENS = 8_000_000
#: Parts of words whose ids a task remembers; beyond, it begins anew.
MEMO_WORDS = 600_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


#: A part that the tokenizer takes as one piece: letters up to U+00FF, or ASCII without letters and digits.
_ONE = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+|[0-9]|[!-&(-/:-@\\[-`{-~]+")
#: Begins the text of a special token, which the tokenizer takes whole; such documents are encoded as they are.
SPECIAL = "<|"


class WordEncoder:
    """Ids of texts, one part of a word at a time, with a bounded memo of parts seen."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a piece
        self.last[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self._reset()

    def _reset(self):
        self.place: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.at = np.zeros(1 << 14, np.int64)  # where the ids of each part seen begin; they end where the next one's begin

    def _learn(self, parts: list[str]):
        single = [_ONE.fullmatch(w) is not None for w in parts]
        one = list(compress(parts, single))
        rest = [w for w, x in zip(parts, single, strict=True) if not x]
        joined = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast([" ".join(one[k : k + 2000]) for k in range(0, len(one), 2000)], add_special_tokens=False)]
        flat = np.concatenate(joined) if joined else np.zeros(0, np.uint32)
        ends = np.flatnonzero(self.last[flat]) + 1
        if len(ends) != len(one):  # not one end for each: take them one by one
            one, rest, flat, ends = [], parts, flat[:0], ends[:0]
        alone = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
        flat = np.concatenate([flat, np.fromiter(chain.from_iterable(alone), np.uint32)])
        ends = np.r_[ends, (ends[-1] if len(ends) else 0) + np.cumsum([len(x) for x in alone], dtype=np.int64)].astype(np.int64)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(flat)] = flat
        known = len(self.place)
        while known + len(parts) >= len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.at[known + 1 : known + 1 + len(parts)] = ends + self.used
        self.place.update(zip([*one, *rest], range(known, known + len(parts)), strict=True))
        self.used += len(flat)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by ``end_id``, and where each text's begin (with one more entry at the end)."""
        odd = pc.fill_null(pc.match_substring(texts, SPECIAL), False)
        if pc.any(odd).as_py():
            each = []
            for text, whole in zip(texts, odd.to_pylist(), strict=True):
                ids = self.tokenizer.encode(text.as_py(), add_special_tokens=False).ids if whole else self._encode(pa.array([text.as_py()], pa.string()), end_id)[0][:-1]
                each.append(np.append(np.array(ids, np.uint32), np.uint32(end_id)))
            return np.concatenate(each), np.r_[0, np.cumsum([len(x) for x in each])]
        return self._encode(texts, end_id)

    def _encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        words = tokenise(texts, parts=True)
        # the parts as one Arrow column: their bytes without the gaps between them, A-Z lower-cased where all are ASCII
        size = words.end - words.start
        data = words.data[~_SPACE[words.data]]
        offsets = np.zeros(len(size) + 1, np.int32)
        np.cumsum(size, out=offsets[1:])
        upper = (data >= 65) & (data <= 90)
        wide = data >= 128
        if wide.any():
            upper &= np.repeat(~np.logical_or.reduceat(wide, offsets[:-1]), size)
        data |= upper.view(np.uint8) << 5
        coded = pc.dictionary_encode(pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data)]))
        if len(self.place) > MEMO_WORDS:
            self._reset()
        distinct = coded.dictionary.to_pylist()
        row = np.fromiter(map(self.place.get, distinct, repeat(-1)), np.int64, len(distinct))
        if len(fresh := np.flatnonzero(row < 0)):
            new = [distinct[k] for k in fresh.tolist()]
            self._learn(new)
            row[fresh] = np.fromiter(map(self.place.__getitem__, new), np.int64, len(new))
        begin, count = self.at[row], self.at[row + 1] - self.at[row]
        code = coded.indices.to_numpy(zero_copy_only=False)
        counts = count[code] if len(code) else np.zeros(0, np.int64)
        before = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=before[1:])
        first = before[words.first] + np.arange(len(words.first))  # one end id before each later text
        out = np.empty(int(first[-1]), np.uint32)
        body = np.ones(len(out), bool)
        body[first[1:] - 1] = False
        if len(code):
            out[body] = self.ids[np.repeat(begin[code] - before[:-1], counts) + np.arange(before[-1])]
        out[first[1:] - 1] = end_id
        return out, first


def _piece_maker(path: str, window: int, end_id: int):
    def make(batches):
        encoder = WordEncoder(path)
        for batch in chunks(batches):
            ids, first = encoder.encode(column(batch, "text"), end_id)
            raw = memoryview(ids.astype("<u4").tobytes())
            n = np.diff(first)
            pieces = -(-n // window)
            doc = np.repeat(np.arange(len(n)), pieces)
            start = ranges(pieces) * window
            length = np.minimum(window, n[doc] - start)
            low = (first[doc] + start) * 4
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(low.tolist(), (low + 4 * length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id").take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(n[doc])], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return make


class CapacityTree:
    """Segment tree over capacities 0..size: how many open windows have each; finds the tightest that fits."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, capacity: int, item: int) -> None:
        self.open[capacity].append(item)
        k = capacity + self.leaves
        while k:
            self.count[k] += 1
            k >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """An item of the smallest capacity of ``least`` or more, removed; its capacity with it."""
        k = least + self.leaves
        if not self.count[k]:
            while k > 1 and (k & 1 or not self.count[k + 1]):
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.leaves:
                k = 2 * k if self.count[2 * k] else 2 * k + 1
        capacity = k - self.leaves
        while k:
            self.count[k] -= 1
            k >>= 1
        return capacity, self.open[capacity].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of each piece; lengths in any order."""
    tree, bins = CapacityTree(window), 0
    where, offset = [0] * len(lengths), [0] * len(lengths)
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        n = lengths[k]
        if (got := tree.take(n)) is None:
            got = (window, bins)
            bins += 1
        capacity, b = got
        where[k], offset[k] = b, window - capacity
        if capacity > n:
            tree.add(capacity - n, b)
    return where, offset


def _packer(window: int):
    def pack(key, pieces):
        pieces = pieces.drop_columns(["shard"]).sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        where, offset = best_fit_decreasing(pieces["length"].to_pylist(), window)
        base = key[0].as_py() << 32
        return pieces.append_column("sequence_id", pa.array([base + w for w in where], pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    return pack


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of the documents' token streams, placed into sequences of at most ``window`` tokens.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null or empty text is its end id alone;
    repeated rows are packed as often as they come; a null doc_id stays null; other columns are ignored. sequence_id is
    unique but not dense: shard and window within it.
    """
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_piece_maker(tokenizer_path, window, end_id), PIECES)
    pieces = checkpointed(pieces)
    partial = pieces.where(F.col("length") < window)
    tokens = partial.agg(F.sum("length")).first()[0] or 0
    shards = int(-(-tokens // SHARD_TOKENS)) or 1
    dealt = partial.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start", "length", "ids_crc32"), F.lit(shards)))
    schema = f"{PIECES}, sequence_id long, offset long"
    packed = dealt.groupBy("shard").applyInArrow(_packer(window), schema)
    whole = pieces.where(F.col("length") == window).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return whole.unionByName(packed)
