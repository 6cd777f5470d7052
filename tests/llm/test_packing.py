import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from fathomline.llm.packing import WordEncoder, best_fit_decreasing, pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_best_fit_takes_the_tightest_open_window():
    r = random.Random(4)
    for _ in range(200):
        lengths = [r.randrange(1, 33) for _ in range(r.randrange(60))]
        where, offset = best_fit_decreasing(lengths, 32)
        room, want = [], [None] * len(lengths)
        for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
            fit = [c for c in room if c >= lengths[k]]
            want[k] = min(fit) if fit else 32
            if fit:
                room.remove(min(fit))
            room.append(want[k] - lengths[k])
        assert [32 - o for o in offset] == want


def test_round_trip(spark):
    r = random.Random(1)
    words = ["The", "don't", "naïve", "É", "x²", "日本語", "<|endoftext|>", "a b", "12,5", "ét", "!!", "ΟΔΟΣ", "İx", "🙂"]
    rows = [(k, r.choice([" ", "\n", "\t"]).join(r.choice(words) + r.choice(["", str(r.randrange(99))]) for _ in range(r.choice([3, 40, 900])))) for k in range(40)]
    rows += [(None, "a b"), (90, None), (91, ""), (92, "  \n"), (3, rows[3][1]), (93, "z" * 30000), (94, "w " * 2047)]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, start int").repartition(3)
    out = pack_documents(df, PATH).collect()
    t = Tokenizer.from_file(PATH)
    want = sorted(((d, tuple(t.encode(x or "", add_special_tokens=False).ids) + (1,)) for d, x in rows), key=str)
    by, seqs = defaultdict(list), defaultdict(list)
    for p in out:
        by[p.doc_id, p.doc_tokens].append(p)
        seqs[p.sequence_id].append((p.offset, p.length))
    for d, ids in want:
        got = by[d, len(ids)]
        cuts = sorted({(p.start, p.length) for p in got})
        assert [a for a, _ in cuts] == np.cumsum([0, *(n for _, n in cuts)])[:-1].tolist() and sum(n for _, n in cuts) == len(ids)
        for p in got:
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
    assert sum(p.length for p in out) == sum(len(i) for _, i in want)
    for s in seqs.values():
        s.sort()
        assert [o for o, _ in s] == np.cumsum([0, *(n for _, n in s)])[:-1].tolist() and sum(n for _, n in s) <= 2048


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_each_of_many_parts_is_learnt_once():
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    parts = ["q" + "".join(letters[[k // 26**j % 26 for j in range(4)]]) for k in range(300_000)]
    texts = [" ".join(parts[k : k + 30_000]) for k in range(0, len(parts), 30_000)]
    encoder, learnt = WordEncoder(PATH), []
    learn = encoder._learn
    encoder._learn = lambda new: (learnt.append(len(new)), learn(new))
    first = [encoder.encode(pa.array([t]), 1)[0].tolist() for t in texts]
    assert [encoder.encode(pa.array([t.upper()]), 1)[0].tolist() for t in texts] == first
    assert sum(learnt) == len(parts)
    assert first[3] == encoder.tokenizer.encode(texts[3], add_special_tokens=False).ids + [1]
