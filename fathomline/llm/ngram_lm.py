"""Language-model scores by a weighted backoff automaton.

Words, bigrams and trigrams are counted over every training token and stay distributed by hash; n-grams seen twice are
arcs. Each state (a word or bigram with arcs) holds the discounted probabilities of its arcs and a failure arc whose
weight hands the mass left to the shorter context, so every state's probabilities sum to one. An n-gram's weight is what
its arc adds to the path by the failure arc, and its own failure weight as a context: a text's score is then the sum
of the weights of all its words, bigrams and trigrams, whatever their order. An n-gram goes, packed, to the word or
bigram at its end and then to its context, where it is weighed beside the other arcs. Weights are requested by hash in the
partition that holds them, and only sums return to the documents; the most frequent ones, of a fixed share of the corpus
and so of bounded number, are known to every task and are not requested. That changes the traffic, never a score.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.shared import checkpointed, dropped
from fathomline.llm.toxicity import held_out
from fathomline.llm.wordvec import chunks, column, mix, ranges, tokenise

#: Least share of the training tokens of a word in bigrams, of one in trigrams, and of an arc: none, two occurrences are enough.
BIGRAM_SHARE, TRIGRAM_SHARE, ARC_SHARE = 0.0, 0.0, 0.0
#: Least share of the training tokens of a word and of an n-gram whose weights every task holds.
WORD_SHARE, GRAM_SHARE = 2.0**-17, 2.0**-19
DISCOUNT = 0.5
SMOOTH = 0.1
END = mix(np.array([0x5E0D], np.uint64))[0]
FLUSH = 1_000_000
#: Bytes of text at a time: what is made of them stays in a core's cache.
TEXT_BYTES = 250_000
#: Slices of the n-grams, counted one after the other, and of the documents, scored so: only one slice's traffic lies on disk.
COUNT_SLICES, SCORE_SLICES = 2, 3
#: Slices of the contexts whose arcs are weighed one after the other.
ARC_SLICES = 2
#: N-grams that one task deals at least: with fewer, what it deals to each bucket would be a few.
TASK_GRAMS = 250_000
COUNTED = np.dtype([("key", "<u8"), ("n", "<u4")])
GRAM = np.dtype([("left", "<u8"), ("right", "<u8"), ("n", "<u4")])
PAIR = np.dtype([("left", "<u8"), ("right", "<u8")])
TALLY = np.dtype([("left", "<u8"), ("right", "<u8"), ("n", "<i8")])
LOW = np.dtype([("key", "<u8"), ("p", "<f8")])
STATE = np.dtype([("key", "<u8"), ("n", "<i8"), ("p", "<f8"), ("arc", "<f8")])
ARC = np.dtype([("left", "<u8"), ("right", "<u8"), ("n", "<i8"), ("low", "<f8")])
WEIGHT = np.dtype([("key", "<u8"), ("own", "<f8"), ("rest", "<f8")])
REST = np.dtype([("key", "<u8"), ("rest", "<f8")])
ASKED = np.dtype([("key", "<u8"), ("row", "<i8"), ("n", "<u4")])
DOCUMENT = np.dtype([("row", "<i8"), ("doc_id", "<i8"), ("no_id", "?"), ("out", "?"), ("tokens", "<i8"), ("known", "<i8"), ("own", "<f8"), ("rest", "<f8")])


class Lookup:
    """Place of each key in a list of distinct keys, or -1: one probe, and a binary search where slots are shared."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = max(10, int(4 * len(keys)).bit_length())
        slot = self._slot(keys)
        self.table = np.full(1 << self.bits, -1, np.int32)
        self.table[slot] = np.arange(len(keys), dtype=np.int32)
        self.shared = np.bincount(slot, minlength=1 << self.bits) > 1
        self.order = np.argsort(keys)
        self.sorted = keys[self.order]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        slot = self._slot(keys)
        at = self.table[slot]
        at = np.where((at >= 0) & (self.keys[at] == keys), at, -1)
        hard = np.flatnonzero(at < 0)
        hard = hard[self.shared[slot[hard]]]
        if len(hard):
            k = np.minimum(np.searchsorted(self.sorted, keys[hard]), len(self.sorted) - 1)
            at[hard] = np.where(self.sorted[k] == keys[hard], self.order[k], -1)
        return at


def _stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each followed by its end token, and where each text begins."""
    words = tokenise(texts, lower=True)
    first = words.first + np.arange(len(words.first))
    out = np.full(int(first[-1]), END, np.uint64)
    out[ranges(words.counts) + np.repeat(first[:-1], words.counts)] = words.hashes()
    return out, first


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Keys of n-grams from those of the (n-1)-grams at their two ends; even, where those of words are odd."""
    return mix(left * _ODD + mix(right)) & ~np.uint64(1)


def _grams(stream: np.ndarray, first: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and keys of the words, bigrams and trigrams that end there; none crosses texts."""
    place = np.arange(len(stream)) - np.repeat(first[:-1], np.diff(first))
    one = stream | np.uint64(1)
    two = np.zeros(len(one), np.uint64)
    at2, at3 = np.flatnonzero(place >= 1), np.flatnonzero(place >= 2)
    two[at2] = _joined(one[at2 - 1], one[at2])
    return [(np.arange(len(one)), one), (at2, two[at2]), (at3, _joined(two[at3 - 1], two[at3]))]


def _ends(stream: np.ndarray, first: np.ndarray, slice_: int, slices: int) -> list[np.ndarray]:
    """GRAM records, not yet added up, of the words (in ``left``), bigrams and trigrams whose keys are in the slice."""
    grams = _grams(stream, first)
    one, (at2, key2) = grams[0][1], grams[1]
    two = np.zeros(len(one), np.uint64)
    two[at2] = key2
    out = []
    for order, (at, key) in enumerate(grams, 1):
        if slices > 1:
            at = at[(key >> np.uint64(8)) % np.uint64(slices) == slice_]
        record = np.empty(len(at), GRAM)
        ends = two if order == 3 else one
        record["left"], record["right"], record["n"] = (one[at], 0, 1) if order == 1 else (ends[at - 1], ends[at], 1)
        out.append(record)
    return out


def _cat(parts: list[np.ndarray]) -> np.ndarray:
    """Records joined as bytes: numpy copies records field by field."""
    return np.concatenate([x.view(f"V{x.dtype.itemsize}") for x in parts]).view(parts[0].dtype)


def _take(record: np.ndarray, at: np.ndarray) -> np.ndarray:
    return record.view(f"V{record.dtype.itemsize}")[at].view(record.dtype)


def _keys(record: np.ndarray, order: int) -> np.ndarray:
    return record["left"].copy() if order == 1 else _joined(record["left"], record["right"])


def _totals(parts: list[np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, ascending, the first GRAM record of each and its count over all parts, in 64 bits."""
    all_ = _cat(parts) if parts else np.zeros(0, GRAM)
    key = _keys(all_, order)
    by = np.argsort(key)
    key = key[by]
    if not len(all_):
        return key, all_, np.zeros(0, np.int64)
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[at], _take(all_, by[at]), np.add.reduceat(all_["n"][by].astype(np.int64), at)


def _sum(parts: list[np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and GRAM records with equal keys added up. One task's counts stay far below 2**32: its tokens are fewer."""
    key, out, n = _totals(parts, order)
    out["n"] = n
    return key, out


def _dealt(key: np.ndarray, record: np.ndarray, kind: int, buckets: int, single: bool = False) -> pa.RecordBatch:
    """A row for each bucket that has records; with ``single``, those whose last field is 1 come without it (see _singles)."""
    bucket = ((key >> np.uint64(48)) * np.uint64(buckets)) >> np.uint64(16)  # ascending with the keys
    if (bucket[1:] < bucket[:-1]).any():
        by = np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")
        record, bucket = _take(record, by), bucket[by]
    bounds = np.arange(buckets + 1, dtype=np.uint64)
    cuts = np.searchsorted(bucket, bounds)
    used = np.flatnonzero(np.diff(cuts))
    if not single:
        return _rows(used, kind, [record[cuts[b] : cuts[b + 1]].tobytes() for b in used.tolist()])
    record = record.view(GRAM)
    one = record["n"] == 1
    pair, many = _records(PAIR, left=record["left"][one], right=record["right"][one]), _take(record, np.flatnonzero(~one))
    cut1 = np.r_[0, np.cumsum(one)][cuts]
    cut2 = cuts - cut1
    blobs = [b"".join((int(cut1[b + 1] - cut1[b]).to_bytes(8, "little"), pair[cut1[b] : cut1[b + 1]].tobytes(), many[cut2[b] : cut2[b + 1]].tobytes())) for b in used.tolist()]
    return _rows(used, kind, blobs)


def _singles(blob: pa.Buffer) -> np.ndarray:
    """GRAM records of a blob that holds the number of those with a count of 1, these as PAIR records, and then the others."""
    ones = int(np.frombuffer(blob, "<u8", 1)[0])
    pair = np.frombuffer(blob, PAIR, ones, 8)
    many = (blob.size - 8 - pair.nbytes) // GRAM.itemsize
    out = np.empty(ones + many, GRAM)
    out["left"][:ones], out["right"][:ones], out["n"][:ones] = pair["left"], pair["right"], 1
    out[ones:] = np.frombuffer(blob, GRAM, many, 8 + pair.nbytes)
    return out


def _rows(buckets, kind: int, blobs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array([kind] * len(blobs), pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "kind", "blob"])


def _counts(buckets: int, slice_: int = 0, slices: int = 1, single: bool = False):
    """N-grams of each text's token stream whose keys are in the slice, counted within the task before they are dealt, as
    GRAM records or, with ``single``, as _singles reads them."""

    def count(batches):
        held, size = {1: [], 2: [], 3: []}, {1: 0, 2: 0, 3: 0}
        for batch in chunks(batches, size=TEXT_BYTES):
            for order, record in enumerate(_ends(*_stream(column(batch, "text")), slice_, slices), 1):
                held[order].append(record)
                size[order] += len(record)
                if size[order] >= FLUSH:
                    key, part = _sum(held[order], order)
                    held[order], size[order] = [part], len(part)
                    if len(part) >= FLUSH // 2:
                        yield _dealt(key, part, order, buckets, single)
                        held[order], size[order] = [], 0
        for order in held:
            if size[order]:
                yield _dealt(*_sum(held[order], order), order, buckets, single)

    return count


def _blobs(batches, kinds: dict[int, np.dtype], single: bool = False):
    """Bucket, kind and records of each row."""
    for batch in batches:
        for bucket, kind, blob in zip(column(batch, "bucket").to_pylist(), column(batch, "kind").to_pylist(), column(batch, "blob"), strict=True):
            yield bucket, kind, _singles(blob.as_buffer()) if single else np.frombuffer(blob.as_buffer(), kinds[kind])


def _by_bucket(batches, kinds: dict[int, np.dtype], single: bool = False):
    """Bucket and, by kind, the records of each bucket of a partition."""
    parts: dict[int, dict[int, list[np.ndarray]]] = {}
    for bucket, kind, record in _blobs(batches, kinds, single):
        parts.setdefault(bucket, {}).setdefault(kind, []).append(record)
    for bucket in list(parts):
        held = parts.pop(bucket)
        yield bucket, {kind: _cat(held[kind]) if kind in held else np.zeros(0, dtype) for kind, dtype in kinds.items()}


def _sent(source, buckets: int):
    """What the source yields as kind, keys and records, dealt by key, many records at a time."""
    held: dict[int, list] = {}
    size = 0

    def out():
        for kind, parts in held.items():
            yield _dealt(np.concatenate([k for k, _ in parts]), _cat([r for _, r in parts]), kind, buckets)
        held.clear()

    for kind, key, record in source:
        if len(record):
            held.setdefault(kind, []).append((key, record))
            size += len(record)
            if size >= FLUSH:
                yield from out()
                size = 0
    yield from out()


def _records(dtype: np.dtype, **columns: np.ndarray) -> np.ndarray:
    out = np.empty(len(columns["key"] if "key" in columns else columns["left"]), dtype)
    for name, values in columns.items():
        out[name] = values
    return out


def _reduce(batches):
    """TALLY records of the words (kind 1) and of the n-grams that occur twice (kinds 2 and 3), and how many words, tokens
    and records there are (kind 0)."""
    size = np.zeros(3, np.int64)
    for bucket, held in _by_bucket(batches, {1: GRAM, 2: GRAM, 3: GRAM}, single=True):
        for order, record in held.items():
            if len(record):
                _, total, n = _totals([record], order)
                keep = n >= (1 if order == 1 else 2)
                size += (len(n), n.sum(), len(n)) if order == 1 else (0, 0, keep.sum())
                yield _rows([bucket], order, [_records(TALLY, left=total["left"][keep], right=total["right"][keep], n=n[keep]).tobytes()])
    yield _rows([0], 0, [size.tobytes()])


def _words(bottom: float):
    """STATE records of the words."""

    def words(batches):
        for bucket, _, total in _blobs(batches, {1: TALLY}):
            yield _rows([bucket], 0, [_records(STATE, key=total["left"], n=total["n"], p=(total["n"] + SMOOTH) / 10**bottom, arc=0.0).tobytes()])

    return words


def _in_slice(context: np.ndarray, slice_: int) -> np.ndarray:
    return (context >> np.uint64(24)) % np.uint64(ARC_SLICES) == slice_


def _lows(buckets: int):
    return lambda batches: _sent(((0, s["key"].copy(), _records(LOW, key=s["key"], p=s["p"])) for _, _, s in _blobs(batches, {0: STATE, 3: STATE})), buckets)


def _contexts(slice_: int, buckets: int):
    def send(batches):
        mine = (s[_in_slice(s["key"], slice_)] for _, _, s in _blobs(batches, {0: STATE, 3: STATE}))
        return _sent(((0, s["key"].copy(), s) for s in mine), buckets)

    return send


def _by_right(order: int, least: int, slice_: int, buckets: int):
    def send(batches):
        mine = (t[(t["n"] >= least) & _in_slice(t["left"], slice_)] for _, _, t in _blobs(batches, {order: TALLY}))
        return _sent(((1, t["right"].copy(), t) for t in mine), buckets)

    return send


def _found(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What is asked and there, and its places in ascending keys. Missing are only n-grams of two that share their key."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    k = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    there = np.flatnonzero(keys[k] == asked)
    return there, k[there]


def _with_low(buckets: int):
    """Each n-gram learns the probability of its last word after the shorter context, and goes to its own context."""

    def source(batches):
        for _, held in _by_bucket(batches, {0: LOW, 1: TALLY}):
            low, t = held[0], held[1]
            low = _take(low, np.argsort(low["key"]))
            there, k = _found(low["key"], t["right"])
            t = _take(t, there)
            yield 1, t["left"].copy(), _records(ARC, left=t["left"], right=t["right"], n=t["n"], low=low["p"][k])

    return lambda batches: _sent(source(batches), buckets)


def _arcs(order: int, words_from: float, grams_from: float, buckets: int):
    """Contexts and their arcs: final weights of the contexts and, of trigrams, of the arcs (kind 0 of words, -1 of n-grams),
    those of the most frequent (kind 4), and STATE records of bigrams (kind 3)."""

    def weights(of: int, key: np.ndarray, n: np.ndarray, rest: np.ndarray):
        own = np.log10(n + SMOOTH) if of == 1 else np.zeros(len(n))
        yield (0, key, _records(WEIGHT, key=key, own=own, rest=rest)) if of == 1 else (-1, key, _records(REST, key=key, rest=rest))
        top = n >= (words_from if of == 1 else grams_from)
        yield 4, key[top], _records(WEIGHT, key=key[top], own=own[top], rest=rest[top])

    def source(batches):
        for _, held in _by_bucket(batches, {0: STATE, 1: ARC}):
            state, arc = held[0], held[1]
            state, arc = _take(state, np.argsort(state["key"])), _take(arc, np.argsort(arc["left"]))
            there, k = _found(state["key"], arc["left"])
            arc = _take(arc, there)
            p = (arc["n"] - DISCOUNT) / state["n"][k]
            fail = np.zeros(len(state))
            if len(arc):
                at = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
                fail[k[at]] = np.log10((1 - np.add.reduceat(p, at)) / (1 - np.add.reduceat(arc["low"], at)))
            yield from weights(order - 1, state["key"].copy(), state["n"], state["arc"] + fail)
            key, adds = _joined(arc["left"], arc["right"]), np.log10(p) - np.log10(arc["low"]) - fail[k]
            if order == 2:
                yield 3, key, _records(STATE, key=key, n=arc["n"], p=p, arc=adds)
            else:
                yield from weights(3, key, arc["n"], adds)

    return lambda batches: _sent(source(batches), buckets)


BLOBS = "bucket int, kind int, blob binary"


def _weighed(counts: DataFrame, states: DataFrame, order: int, least: int, total: int, buckets: int, tasks: int) -> list[DataFrame]:
    """The output of ``_arcs`` for the n-grams of an order and the states that they follow."""
    grams = counts.where(f"kind = {order}")
    tops = max(2, total * WORD_SHARE), max(2, total * GRAM_SHARE)

    def weighed(k: int) -> DataFrame:
        asked = states.mapInArrow(_lows(buckets), BLOBS).unionByName(grams.mapInArrow(_by_right(order, least, k, buckets), BLOBS))
        arcs = asked.repartition("bucket").coalesce(tasks).mapInArrow(_with_low(buckets), BLOBS)
        here = states.mapInArrow(_contexts(k, buckets), BLOBS).unionByName(arcs)
        return checkpointed(here.repartition("bucket").coalesce(tasks).mapInArrow(_arcs(order, *tops, buckets), BLOBS))

    return [weighed(k) for k in range(ARC_SLICES)]


def _weights(slices: list[DataFrame], least: int, bottom: float, total: int, grams: int, buckets: int) -> tuple[DataFrame, tuple[Lookup, np.ndarray, np.ndarray]]:
    """What each word (besides log10(c + 0.1)), bigram and trigram adds to the score, dealt by key, and the most frequent ones.
    The counts, and what is made of them, are dropped when they have been used."""
    tasks = max(1, min(buckets // 4, grams // TASK_GRAMS))
    counts = reduce(DataFrame.unionAll, slices).coalesce(tasks)
    low = _weighed(counts, counts.where("kind = 1").mapInArrow(_words(bottom), BLOBS), 2, least, total, buckets, tasks)
    lower = reduce(DataFrame.unionAll, low).coalesce(tasks)
    high = _weighed(counts, lower.where("kind = 3"), 3, least, total, buckets, tasks)
    dropped(*slices)
    both = reduce(DataFrame.unionAll, [lower, *high])
    top = [np.frombuffer(x.as_buffer(), WEIGHT) for x in both.where("kind = 4").select("blob").toArrow()["blob"]]
    top = np.concatenate(top) if top else np.zeros(0, WEIGHT)
    words = checkpointed(lower.where("kind = 0"))
    dropped(*low)
    frequent = Lookup(top["key"].copy()), top["own"].copy(), top["rest"].copy()
    return reduce(DataFrame.unionAll, [words, *high]).where("kind <= 0"), frequent


def _before(w: np.ndarray, first: np.ndarray, step: int) -> np.ndarray:
    """The token ``step`` places earlier in the same text, or -1."""
    out = np.full(len(w), -1, np.int64)
    out[step:] = w[:-step]
    for k in range(step):
        at = first[:-1] + k
        out[at[at < first[1:]]] = -1
    return out


def _key2(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return _spread((np.uint64(1) << np.uint64(40)) | (v.astype(np.uint64) << np.uint64(20)) | w.astype(np.uint64))


def _key3(u: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return _spread((np.uint64(2) << np.uint64(40)) | (u.astype(np.uint64) << np.uint64(26)) | (v.astype(np.uint64) << np.uint64(13)) | w.astype(np.uint64))


_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_ODD), -1, 1 << 64))


def _spread(x: np.ndarray) -> np.ndarray:
    return x * _ODD


@dataclass
class Automaton:
    """The same model as one table in memory, run from left to right."""

    words: Lookup  # numbered words, most frequent first
    counts: np.ndarray  # of each
    n2: int
    n3: int
    arcs2: Lookup
    logs2: np.ndarray
    fail1: np.ndarray  # failure weight of each word's state
    arcs3: Lookup
    logs3: np.ndarray
    states3: Lookup  # keys of bigrams that are states
    fail2: np.ndarray
    bottom: float  # log10 of N + 0.1 * (V + 1)

    def run(self, stream: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers, log10(c + 0.1) (0 for the tail) and log10 probability (of the tail: without its own count) per token."""
        w = self.words.find(stream).astype(np.int64)
        own = np.where(w >= 0, np.log10(self.counts + SMOOTH)[w] if len(self.counts) else 0.0, 0.0)
        v, u = _before(w, first, 1), _before(w, first, 2)
        out = own - self.bottom
        near = np.flatnonzero((v >= 0) & (v < self.n2))
        out[near] += self.fail1[v[near]]
        near = near[(w[near] >= 0) & (w[near] < self.n2)]
        arc = self.arcs2.find(_key2(v[near], w[near]))
        out[near[arc >= 0]] = self.logs2[arc[arc >= 0]]
        far = np.flatnonzero((u >= 0) & (u < self.n3) & (v >= 0) & (v < self.n3))
        state = self.states3.find(_key2(u[far], v[far]))
        far, state = far[state >= 0], state[state >= 0]
        out[far] += self.fail2[state]
        far = far[(w[far] >= 0) & (w[far] < self.n3)]
        arc = self.arcs3.find(_key3(u[far], v[far], w[far]))
        out[far[arc >= 0]] = self.logs3[arc[arc >= 0]]
        return w, own, out


def build(words: np.ndarray, n2: int, n3: int, grams: np.ndarray, bottom: float) -> Automaton:
    """The automaton from numbered words and kept n-grams (COUNTED records)."""
    counts = words["n"].astype(np.float64)
    raw = grams["key"] * _BACK
    order, n = raw >> np.uint64(40), grams["n"].astype(np.float64)
    mask = lambda x, low, bits: ((x >> np.uint64(low)) & np.uint64((1 << bits) - 1)).astype(np.int64)
    two = order == 1
    v, w = mask(raw[two], 20, 20), mask(raw[two], 0, 20)
    p1 = (counts + SMOOTH) / 10**bottom
    p2 = (n[two] - DISCOUNT) / counts[v]
    fail1 = np.zeros(len(counts))
    kept, rest = np.bincount(v, p2, len(counts)), np.bincount(v, p1[w], len(counts))
    has = np.bincount(v, minlength=len(counts)) > 0
    fail1[has] = np.log10((1 - kept[has]) / (1 - rest[has]))
    arcs2, logs2 = Lookup(grams["key"][two]), np.log10(p2)
    three = order == 2
    u, v, w = mask(raw[three], 26, 14), mask(raw[three], 13, 13), mask(raw[three], 0, 13)
    context = arcs2.find(_key2(u, v))
    ok = context >= 0  # a trigram of that share has a bigram of that share before it
    u, v, w, context, key3, n3_ = u[ok], v[ok], w[ok], context[ok], grams["key"][three][ok], n[three][ok]
    n2_ = n[two]
    p3 = (n3_ - DISCOUNT) / n2_[context] if len(n3_) else np.zeros(0)
    arc = arcs2.find(_key2(v, w))
    lower = np.where(arc >= 0, p2[arc] if len(p2) else 0.0, 10.0 ** fail1[v] * p1[w]) if len(v) else np.zeros(0)
    kept, rest = np.bincount(context, p3, len(n2_)), np.bincount(context, lower, len(n2_))
    state = np.flatnonzero(np.bincount(context, minlength=len(n2_)))
    fail2 = np.log10((1 - kept[state]) / (1 - rest[state]))
    return Automaton(Lookup(words["key"].copy()), counts, n2, n3, arcs2, logs2, fail1, Lookup(key3), np.log10(p3), Lookup(arcs2.keys[state]), fail2, bottom)


UNKNOWN = float(np.log10(SMOOTH))


def _asked(held: list[tuple[np.ndarray, np.ndarray]], buckets: int) -> pa.RecordBatch:
    """Requests, ascending by key, as they are looked up the faster; neighbours of the same row are one."""
    key, row = (np.concatenate(x) for x in zip(*held, strict=True))
    by = np.argsort(key)
    key, row = key[by], row[by]
    at = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (row[1:] != row[:-1])])
    record = _records(ASKED, key=key[at], row=row[at], n=np.diff(np.append(at, len(key))))
    return _dealt(key[at], record, 1, buckets, single=True)


def _scorer(frequent: tuple[Lookup, np.ndarray, np.ndarray], buckets: int):
    """Sums of each document over the frequent weights, all other words as unknown, and requests for what is not frequent."""
    lookup, own, rest = frequent

    def score(batches):
        held, size = [], 0
        for batch in chunks(batches, size=TEXT_BYTES):
            stream, first = _stream(column(batch, "text"))
            row = column(batch, "row_key").to_numpy(zero_copy_only=False).astype(np.int64)
            doc_id = column(batch, "doc_id")
            record = np.zeros(batch.num_rows, DOCUMENT)
            record["row"], record["no_id"] = row, doc_id.is_null().to_numpy(zero_copy_only=False)
            record["doc_id"] = pa.compute.fill_null(doc_id, 0).to_numpy(zero_copy_only=False)
            record["out"] = column(batch, "held_out").to_numpy(zero_copy_only=False)
            record["tokens"] = np.diff(first)
            doc_of = np.repeat(np.arange(batch.num_rows), np.diff(first))
            for order, (at, key) in enumerate(_grams(stream, first), 1):
                k, doc = lookup.find(key), doc_of[at]
                here, far = np.flatnonzero(k >= 0), np.flatnonzero(k < 0)
                record["rest"] += np.bincount(doc[here], rest[k[here]], batch.num_rows)
                if order == 1:
                    record["known"] = np.bincount(doc[here], minlength=batch.num_rows)
                    record["own"] = np.bincount(doc[here], own[k[here]], batch.num_rows) + UNKNOWN * np.bincount(doc[far], minlength=batch.num_rows)
                held.append((key[far], row[doc[far]]))
                size += len(far)
            yield _rows([int(row[0] % buckets)], 2, [record.tobytes()])
            if size >= FLUSH:
                yield _asked(held, buckets)
                held, size = [], 0
        if size:
            yield _asked(held, buckets)

    return score


PART = np.dtype([("row", "<i8"), ("hits", "<i8"), ("own", "<f8"), ("rest", "<f8")])
TOTALS = "doc_id long, held_out boolean, n_tokens long, n_known long, own double, rest double"


def _answerer(buckets: int):
    """Rows of a partition, by bucket and kind: weights first, then requests; documents pass through. Sums are dealt by
    document, packed."""

    def answer(batches):
        here, loose, known = None, [], np.zeros(0, WEIGHT)
        parts, size = [], 0
        for batch in batches:
            for bucket, kind, blob in zip(column(batch, "bucket").to_pylist(), column(batch, "kind").to_pylist(), column(batch, "blob"), strict=True):
                if bucket != here:
                    here, loose, known = bucket, [], np.zeros(0, WEIGHT)
                if kind == 0:
                    loose.append(np.frombuffer(blob.as_buffer(), WEIGHT))
                elif kind == -1:
                    rest = np.frombuffer(blob.as_buffer(), REST)
                    loose.append(_records(WEIGHT, key=rest["key"], own=0.0, rest=rest["rest"]))
                elif kind == 1:
                    if loose:
                        known, loose = _cat(loose), []
                        known = _take(known, np.argsort(known["key"]))
                        keys = known["key"].copy()
                    if len(known):
                        asked = _singles(blob.as_buffer()).view(ASKED)
                        found, k = _found(keys, asked["key"].copy())
                        asked = _take(asked, found)
                        word = (asked["key"] & np.uint64(1)).astype(np.int64)
                        part = np.empty(len(asked), PART)
                        part["row"], part["hits"] = asked["row"], asked["n"] * word
                        part["own"], part["rest"] = asked["n"] * word * (known["own"][k] - UNKNOWN), asked["n"] * known["rest"][k]
                        parts.append(part)
                        size += len(part)
                        if size >= FLUSH:
                            parts = [_summed(_cat(parts))]
                            size = len(parts[0])
                            if size >= FLUSH // 2:
                                yield from _by_document(parts[0], 0, buckets)
                                parts, size = [], 0
                else:
                    yield from _by_document(np.frombuffer(blob.as_buffer(), DOCUMENT), 1, buckets)
        if parts:
            yield from _by_document(_summed(_cat(parts)), 0, buckets)

    return answer


def _summed(parts: np.ndarray) -> np.ndarray:
    """PART records of equal row added up, ascending by row."""
    parts = _take(parts, np.argsort(parts["row"], kind="stable"))
    if not len(parts):
        return parts
    at = np.flatnonzero(np.r_[True, parts["row"][1:] != parts["row"][:-1]])
    out = np.empty(len(at), PART)
    out["row"] = parts["row"][at]
    for name in ("hits", "own", "rest"):
        out[name] = np.add.reduceat(parts[name], at)
    return out


def _by_document(record: np.ndarray, kind: int, buckets: int):
    bucket = record["row"].astype(np.uint64) % np.uint64(buckets)
    by = np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")
    record, bucket = _take(record, by), bucket[by]
    cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    used = np.flatnonzero(np.diff(cuts))
    yield _rows(used, kind, [record[cuts[b] : cuts[b + 1]].tobytes() for b in used.tolist()])


def _total(batches):
    """A row for each document of the partition. Documents of equal row key are copies; each has its share of their sums."""
    docs, parts = [], []
    for batch in batches:
        for kind, blob in zip(column(batch, "kind").to_pylist(), column(batch, "blob"), strict=True):
            (docs if kind else parts).append(np.frombuffer(blob.as_buffer(), DOCUMENT if kind else PART))
    if not docs:
        return
    d = _cat(docs)
    p = _summed(_cat(parts) if parts else np.zeros(0, PART))
    rows, copies = np.unique(d["row"], return_counts=True)
    copies = copies[np.searchsorted(rows, d["row"])]
    sums = {name: np.zeros(len(d), PART[name]) for name in ("hits", "own", "rest")}
    if len(p):
        k = np.minimum(np.searchsorted(p["row"], d["row"]), len(p) - 1)
        has = p["row"][k] == d["row"]
        sums = {"hits": np.where(has, p["hits"][k] // copies, 0)} | {name: np.where(has, p[name][k] / copies, 0.0) for name in ("own", "rest")}
    yield pa.RecordBatch.from_arrays(
        [pa.array(d["doc_id"], mask=d["no_id"]), pa.array(d["out"]), pa.array(d["tokens"]), pa.array(d["known"] + sums["hits"]), pa.array(d["own"] + sums["own"]), pa.array(d["rest"] + sums["rest"])],
        names=[x.split()[0] for x in TOTALS.split(", ")],
    )


def score_texts(docs: DataFrame, folds: int = 10) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each document.

    Documents whose crc32(doc_id as text) modulo ``folds`` is 0 are held out of learning; a null doc_id is not. A null or
    empty text is its end token alone. Repeated rows are counted and returned as often as they come. Without training
    documents every token is unknown. Other columns are ignored.
    """
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("row_key"), held_out(F.col("doc_id"), folds).alias("held_out"))
    train = texts.where(~F.col("held_out")).select("text")
    slices = [checkpointed(train.mapInArrow(_counts(buckets, k, COUNT_SLICES, single=True), BLOBS).repartition("bucket").mapInArrow(_reduce, BLOBS)) for k in range(COUNT_SLICES)]
    sizes = reduce(DataFrame.unionAll, slices).where("kind = 0").select("blob").toArrow()["blob"].to_pylist()
    distinct, total, grams = (int(x) for x in sum((np.frombuffer(x, np.int64) for x in sizes), np.zeros(3, np.int64)))
    bottom = float(np.log10(total + SMOOTH * (distinct + 1)))
    packed, frequent = _weights(slices, max(2, int(total * ARC_SHARE)), bottom, total, grams, buckets)

    def scored(k: int) -> DataFrame:
        asked = texts.where(F.pmod("row_key", F.lit(SCORE_SLICES)) == k).mapInArrow(_scorer(frequent, buckets), BLOBS)
        sums = asked.unionByName(packed).repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_answerer(buckets), BLOBS)
        return checkpointed(sums.repartition("bucket").mapInArrow(_total, TOTALS))

    each = reduce(DataFrame.unionAll, [scored(k) for k in range(SCORE_SLICES)])
    base = F.col("own") - F.col("n_tokens") * bottom
    return each.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), (base + F.col("rest")).alias("score"))
