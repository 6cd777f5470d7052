"""Substring dedup by level-wise doubling.

Every window of ``window`` words is reduced to the smallest hash among its base windows (its anchor), so a window can
only repeat if its anchor repeats. Level by level (9, 18, ..., window) the anchors of the surviving windows are matched
across the corpus; only windows whose anchor repeats at one length are hashed at twice that length, until the full
length decides. Each map task first matches within itself: a key seen twice there is known to repeat, and only one
marker for it is shuffled, so that a passage held by a third of all documents costs each task one entry. Entries travel
as packed blobs, hash-partitioned by anchor; verdicts return to their documents by an equi-join on a row key.

Equality at the full length rests on two independent 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.wordvec import binary_rows, chunks, column, ranges, repeated, runs_hash, tokenise

FLUSH = 1_000_000
ANCHORS = "bucket int, row_key long, blob binary"
_NONE = np.uint32(0xFFFFFFFF)


def levels(window: int, base: int) -> list[int]:
    out = [min(base, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def sliding_argmin(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest of each ``width`` consecutive values."""
    value, place, have = h, np.arange(len(h)), 1
    while have < width:
        step = min(have, width - have)
        later = value[step:] < value[:-step]
        place = np.where(later, place[step:], place[:-step])
        value = np.where(later, value[step:], value[:-step])
        have += step
    return place


class _Windows:
    """Window starts of a chunk and their anchors at one level."""

    def __init__(self, batch: pa.RecordBatch, window: int):
        self.words = tokenise(column(batch, "text"))
        self.window, self.hash = window, self.words.hashes(0)
        n = self.words.counts
        self.starts = np.repeat(self.words.first[:-1], np.maximum(n - window + 1, 0)) + ranges(np.maximum(n - window + 1, 0))
        self.doc = np.repeat(np.arange(len(n)), np.maximum(n - window + 1, 0))
        self.keys = column(batch, "row_key").to_numpy(zero_copy_only=False).astype(np.int64)

    def anchors(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.starts):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        gram = runs_hash(self.hash, length)
        return sliding_argmin(gram, self.window - length + 1)[self.starts], gram

    def among(self, batch: pa.RecordBatch, length: int) -> np.ndarray:
        """Which windows have an anchor of this level among the survivors listed in ``found``."""
        found = _positions(batch, self.words.first)
        alive = np.zeros(len(self.hash) + 1, bool)
        alive[found] = True
        return alive[self.anchors(length)[0]]


def _positions(batch: pa.RecordBatch, first: np.ndarray) -> np.ndarray:
    lists = column(batch, "found")
    flat = [np.frombuffer(b"".join(x), np.uint32).astype(np.int64) + first[k] for k, x in enumerate(lists.to_pylist()) if x]
    return np.concatenate(flat) if flat else np.zeros(0, np.int64)


def _by_row(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    order = np.lexsort((values, keys))
    keys, values = keys[order], values[order]
    cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[cuts], binary_rows(values.astype(np.uint32), np.append(cuts, len(keys)))


def _rows(bucket, keys, blobs) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(keys, pa.int64()), blobs], names=["bucket", "row_key", "blob"])


def _known(keys: np.ndarray, places: np.ndarray, buckets: int):
    if len(keys):
        row, blobs = _by_row(keys, places)
        yield _rows((-1 - row % buckets).astype(np.int32), row, blobs)


def _anchor_sender(length: int, previous: int | None, window: int, buckets: int):
    """Anchors of one level, of all windows or of those that survived the previous level."""

    def send(batches):
        held, size = [], 0

        def flush():
            gram, key, place = (np.concatenate(x) for x in zip(*held, strict=True))
            many, first = repeated(gram)
            yield from _known(key[many], place[many], buckets)
            keep = ~many | first
            gram, key, place = gram[keep], key[keep], np.where(many, _NONE, place)[keep].astype(np.uint32)
            bucket = (gram >> np.uint64(20)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            record = np.empty(len(order), dtype=[("gram", "<u8"), ("key", "<i8"), ("place", "<u4")])
            record["gram"], record["key"], record["place"] = gram[order], key[order], place[order]
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
            yield _rows(np.arange(buckets), np.zeros(buckets), binary_rows(record, cuts)).filter(pa.array(np.diff(cuts) > 0))

        for batch in chunks(batches):
            w = _Windows(batch, window)
            place, gram = w.anchors(length)
            doc = w.doc
            if previous is not None and len(place):
                alive = w.among(batch, previous)
                place, doc = place[alive], doc[alive]
            if not len(place):
                continue
            new = np.r_[True, place[1:] != place[:-1]]
            place, doc = place[new], doc[new]
            held.append((gram[place], w.keys[doc], (place - w.words.first[doc]).astype(np.uint32)))
            size += len(place)
            if size >= FLUSH:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    return send


def _anchor_matcher(batches):
    """Rows of one partition hold all entries of their anchors: those that occur twice go back to their documents."""
    entries = []
    for batch in batches:
        direct = pa.compute.less(column(batch, "bucket"), 0)
        known = batch.filter(direct)
        if known.num_rows:
            yield known.select(["row_key", "blob"])
        entries += [np.frombuffer(x.as_py(), dtype=[("gram", "<u8"), ("key", "<i8"), ("place", "<u4")]) for x in column(batch.filter(pa.compute.invert(direct)), "blob")]
    if entries:
        all_ = np.concatenate(entries)
        marker = all_["place"] == _NONE
        many, _ = repeated(np.ascontiguousarray(all_["gram"]), heavy=marker)
        out = many & ~marker
        if out.any():
            row, blobs = _by_row(all_["key"][out], all_["place"][out])
            yield pa.RecordBatch.from_arrays([pa.array(row), blobs], names=["row_key", "blob"])


def _window_sender(previous: int, window: int, base: int, buckets: int):
    """Full-length hashes of the windows that survived the previous level, in runs of neighbours with one anchor."""

    def send(batches):
        held, size = [], 0

        def flush():
            full, gram, key, place, run = (np.concatenate(x) for x in zip(*held, strict=True))
            many, first = repeated(full, gram)
            yield from _known(key[many], place[many], buckets)
            bucket = ((gram >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
            mark = many & first
            rest = np.flatnonzero(~many)
            new = np.r_[True, (np.diff(run[rest]) != 0) | (np.diff(place[rest].astype(np.int64)) != 1)] if len(rest) else np.zeros(0, bool)
            head = rest[new]
            length = np.diff(np.append(np.flatnonzero(new), len(rest)))
            order = np.argsort(bucket[head], kind="stable")
            body = rest[np.repeat(np.flatnonzero(new)[order], length[order]) + ranges(length[order])] if len(rest) else rest
            heads, length = head[order], length[order]
            at = np.searchsorted(bucket[heads], np.arange(buckets + 1))
            at_body = np.r_[0, np.cumsum(length)][at]
            marks = np.flatnonzero(mark)
            marks = marks[np.argsort(bucket[marks], kind="stable")]
            at_mark = np.searchsorted(bucket[marks], np.arange(buckets + 1))
            rows, blobs = [], []
            for b in np.flatnonzero((np.diff(at) > 0) | (np.diff(at_mark) > 0)):
                h, m = heads[at[b] : at[b + 1]], marks[at_mark[b] : at_mark[b + 1]]
                rows.append(b)
                blobs.append(b"".join((np.array([len(h), len(m)], np.int64).tobytes(), gram[h].tobytes(), key[h].tobytes(), place[h].tobytes(), length[at[b] : at[b + 1]].astype(np.uint32).tobytes(), full[body[at_body[b] : at_body[b + 1]]].tobytes(), gram[m].tobytes(), full[m].tobytes())))
            if rows:
                yield _rows(rows, np.zeros(len(rows)), pa.array(blobs, pa.binary()))

        offset = 0
        for batch in chunks(batches):
            w = _Windows(batch, window)
            if not len(w.starts):
                continue
            alive = w.among(batch, previous)
            starts, doc = w.starts[alive], w.doc[alive]
            if not len(starts):
                continue
            anchor, gram = w.anchors(base)
            anchor = anchor[alive]
            full = runs_hash(w.words.hashes(1), window, 1)[starts]
            held.append((full, gram[anchor], w.keys[doc], (starts - w.words.first[doc]).astype(np.uint32), anchor + offset))
            offset += len(w.hash)
            size += len(starts)
            if size >= FLUSH:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    return send


def _window_matcher(batches):
    parts = []
    for batch in batches:
        direct = pa.compute.less(column(batch, "bucket"), 0)
        known = batch.filter(direct)
        if known.num_rows:
            yield known.select(["row_key", "blob"])
        for x in column(batch.filter(pa.compute.invert(direct)), "blob"):
            raw = x.as_py()
            h, m = np.frombuffer(raw, np.int64, 2)
            at = 16
            take = []
            for kind, n in (("<u8", h), ("<i8", h), ("<u4", h), ("<u4", h)):
                take.append(np.frombuffer(raw, kind, n, at))
                at += n * np.dtype(kind).itemsize
            gram, key, place, length = take
            total = int(length.sum())
            full = np.frombuffer(raw, "<u8", total, at)
            at += 8 * total
            marked_gram, marked = np.frombuffer(raw, "<u8", m, at), np.frombuffer(raw, "<u8", m, at + 8 * m)
            parts.append((np.r_[full, marked], np.r_[np.repeat(gram, length), marked_gram], np.r_[np.repeat(key, length), np.zeros(m, np.int64)], np.r_[np.repeat(place, length) + ranges(length.astype(np.int64)).astype(np.uint32), np.full(m, _NONE)]))
    if parts:
        full, gram, key, place = (np.concatenate(x) for x in zip(*parts, strict=True))
        marker = place == _NONE
        many, _ = repeated(full, gram, marker)
        out = many & ~marker
        if out.any():
            row, blobs = _by_row(key[out], place[out])
            yield pa.RecordBatch.from_arrays([pa.array(row), blobs], names=["row_key", "blob"])


def _cutter(window: int, with_text: bool):
    def cut(batches):
        for batch in batches:
            removed, digest, n_words, kept_text = [], [], [], []
            for text, found in zip(column(batch, "text").to_pylist(), column(batch, "found").to_pylist(), strict=True):
                words = (text or "").encode().split()
                n_words.append(len(words))
                if found:
                    cover = np.zeros(len(words) + 1, np.int64)
                    at = np.unique(np.frombuffer(b"".join(found), np.uint32)).astype(np.int64)
                    cover[at] += 1
                    np.subtract.at(cover, at + window, 1)
                    keep = np.cumsum(cover)[:-1] == 0
                    words = list(compress(words, keep.tolist()))
                kept = b" ".join(words)
                removed.append(n_words[-1] - len(words))
                digest.append(hashlib.sha256(kept).hexdigest())
                kept_text.append(kept.decode() if with_text else None)
            out = [column(batch, "doc_id"), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                out, names = [*out, pa.array(kept_text, pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    return cut


def remove_repeated_windows(docs: DataFrame, window: int = 35, base: int = 9, with_text: bool = False) -> DataFrame:
    """Remove every word covered by a window of ``window`` words whose word sequence also starts anywhere else.

    Needs columns doc_id and text; others are ignored. Null text has no words and keeps its row; repeated rows count as
    separate documents and all lose their windows; a null doc_id is returned as null. Windows are judged on the input.
    Returns doc_id, n_words, n_removed, kept_sha256 and, on request, kept_text.
    """
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("row_key"))
    dealt = keyed.repartition("row_key")

    def matched(sent: DataFrame, matcher) -> DataFrame:
        found = sent.repartition("bucket").mapInArrow(matcher, "row_key long, blob binary")
        return found.groupBy("row_key").agg(F.collect_list("blob").alias("found"))

    def with_found(found: DataFrame, how: str) -> DataFrame:
        return dealt.join(found.hint("shuffle_hash"), "row_key", how).select("doc_id", "text", "row_key", "found")

    steps = levels(window, base)
    found = matched(keyed.mapInArrow(_anchor_sender(steps[0], None, window, buckets), ANCHORS), _anchor_matcher)
    for before, length in zip(steps[:-2], steps[1:-1], strict=True):
        found = matched(with_found(found, "inner").mapInArrow(_anchor_sender(length, before, window, buckets), ANCHORS), _anchor_matcher)
    last = steps[-2] if len(steps) > 1 else steps[0]
    found = matched(with_found(found, "inner").mapInArrow(_window_sender(last, window, steps[0], buckets), ANCHORS), _window_matcher)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return with_found(found, "left").mapInArrow(_cutter(window, with_text), schema)
