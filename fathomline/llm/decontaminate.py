"""Benchmark decontamination with a broadcast hash set of normalised benchmark n-grams.

Only DataFrame functions run here. A broadcast byte sieve, filled by hashes of three words of each benchmark window, is
tried at every place of a document; only windows that pass it are written out as strings. These are probed in a broadcast
hash table of the benchmark's windows (compared as whole strings, so a hit is verified by the probe itself), and all that
reaches the shuffle is one row a document plus its hits, already aggregated in the map task. The sieve decides nothing:
it has no false negatives, and what passes it wrongly fails the probe. A document's row holds its words and the windows
that passed, whatever the number of window lengths.
"""

from __future__ import annotations

import string

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.shared import small_or_shuffled

#: Bytes of benchmark windows up to which they are broadcast; beyond, the same join shuffles.
BROADCAST_BYTES = 48 << 20
#: Slots of the sieve for each benchmark window, and the most that it has: beyond, more windows reach the probe.
SLOTS_EACH, SLOTS_MOST = 16, 1 << 22


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone; whole-ASCII texts take the byte loop of lower()."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def item_words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _slot(words: str, first: str, length: int, slots: int) -> str:
    """The slot of the window of ``length`` words from ``first`` (counted from 0): by its first, middle and last word."""
    of = ", ".join(f"{words}[{first} + {k}]" for k in sorted({0, length // 2, length - 1}))
    return f"CAST(xxhash64({length}, {of}) & {slots - 1} AS INT)"


def _windows(words: str, length: int, slots: int) -> str:
    """The windows of ``length`` words that pass the sieve."""
    passed = f"filter(sequence(0, size({words}) - {length}), i -> substring(sieve, {_slot(words, 'i', length, slots)} + 1, 1) = X'01')"
    return f"IF(size({words}) >= {length}, transform({passed}, i -> named_struct('place', i, 'gram', array_join(slice({words}, i + 1, {length}), ' '))), array())"


def benchmark_windows(benchmark: DataFrame, window: int = 13) -> DataFrame:
    """One row per distinct window (gram, length, items): all of ``window`` words, or all words of a shorter item.

    Rows without text or words have none. Windows of a row without item_id count as windows; only its id is missing.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), item_words(F.col("text")).alias("w")).where("size(w) > 0")
    grams = items.select("item", F.expr(f"explode(transform(sequence(1, greatest(size(w) - {window - 1}, 1)), i -> named_struct('gram', array_join(slice(w, i, {window}), ' '), 'length', least(size(w), {window}))))").alias("x"))
    return grams.groupBy("x.gram", "x.length").agg(F.collect_set("item").alias("items"))


def _sieve(grams: DataFrame, lengths: list[int], slots: int) -> bytes:
    """A byte for each slot: 1 if a benchmark window has it. As large as ``slots``, whatever the number of windows."""
    words = grams.select("length", F.split("gram", " ").alias("w"))
    of = "CASE length " + " ".join(f"WHEN {n} THEN {_slot('w', '0', n, slots)}" for n in lengths) + " END" if lengths else "0"
    # one job, whatever the number of partitions; each bitmap holds 32768 slots
    maps = words.select(F.expr(of).alias("slot")).groupBy(F.expr("slot >> 15").alias("map")).agg(F.expr("bitmap_construct_agg(CAST(slot & 32767 AS BIGINT))").alias("bits"))
    filled = np.zeros(max(slots, 1 << 15), np.uint8)
    for r in maps.collect():
        filled[r["map"] << 15 : (r["map"] + 1) << 15] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
    return filled[:slots].tobytes()


def mark_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, and the row's text_hash.

    A word inside any occurrence of a benchmark window is hit; a document is contaminated if it has hits and
    ``share * n_hit >= n_words``. Null or empty text has no words and is clean; repeated rows are returned as often as
    they come; a null doc_id is kept; an empty benchmark leaves all documents clean. Other columns are ignored.
    """
    grams = benchmark_windows(benchmark, window)
    size = grams.agg(F.coalesce(F.sum(F.octet_length("gram") + F.lit(64) + F.expr("aggregate(items, 0L, (a, x) -> a + octet_length(x) + 16)")), F.lit(0)).alias("bytes"), F.collect_set("length").alias("lengths"), F.count("*").alias("n")).first()
    lengths = sorted(size["lengths"])
    slots = min(SLOTS_MOST, 1 << max(10, (SLOTS_EACH * size["n"]).bit_length()))
    sieve = _sieve(grams, lengths, slots)
    grams = grams.withColumnRenamed("gram", "known")
    if size["bytes"] <= BROADCAST_BYTES:
        grams = F.broadcast(grams)
    cells = ", ".join(["array(named_struct('place', -1, 'gram', CAST(NULL AS STRING)))", *(_windows("w", n, slots) for n in lengths)])
    scanned = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), item_words(F.col("text")).alias("w"), F.lit(sieve).alias("sieve"))
        .select("doc_id", "text_hash", F.expr("CAST(size(w) AS BIGINT)").alias("n_words"), F.expr(f"explode(concat({cells}))").alias("x"))
        .select("doc_id", "text_hash", "n_words", "x.place", "x.gram")
    )
    probed = scanned.join(grams, F.col("gram") == F.col("known"), "left").where("place < 0 OR known IS NOT NULL")
    each = probed.groupBy("doc_id", "text_hash", "n_words").agg(
        F.sum(F.expr("IF(place < 0, 1, 0)")).alias("rows"),
        F.collect_set(F.expr("IF(place < 0, NULL, named_struct('place', place, 'length', length))")).alias("hits"),
        F.collect_set("items").alias("found"),
    )
    counted = each.select(
        "doc_id", "text_hash", "n_words", "rows",
        F.expr("CAST(size(array_distinct(flatten(transform(hits, h -> sequence(h.place, h.place + h.length - 1))))) AS BIGINT)").alias("n_hit"),
        F.expr("array_sort(array_distinct(flatten(found)))").alias("items"),
    )
    return counted.select(
        "doc_id", "n_words", "n_hit",
        F.expr("CAST(size(items) AS BIGINT)").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        F.expr(f"n_hit > 0 AND {share} * n_hit >= n_words").alias("contaminated"),
        "text_hash",
        F.expr("explode(array_repeat(0, CAST(rows AS INT)))").alias("copy"),
    ).drop("copy")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """The documents that are not contaminated, with all their columns. Null and empty texts stay, rows without doc_id are
    judged like the others, repeated rows stay or go together, an empty table stays empty; columns may have any names."""
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"))
    bad = mark_contamination(docs, benchmark, window, share).where("contaminated").select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct()
    return packed.join(small_or_shuffled(bad), F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("hash") == F.col("bad_hash")), "left_anti").select("row.*")
