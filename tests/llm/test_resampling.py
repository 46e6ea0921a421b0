import hashlib
import math
import random
import re
import zlib

import numpy as np

from tidecast.llm import resampling
from tidecast.llm.queries import QUERIES


def features_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def expected(docs, target, buckets=10000, percent=25, least=20, seed=7):
    """The contract, document by document."""

    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for f in features_of(text)[1]:
            s[bucket(f)] += 1
    for text in target:
        for f in features_of(text)[1]:
            t[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, text in docs:
        words, fs = features_of(text)
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    rank = {id(r): k + 1 for k, r in enumerate(able) if k < percent * len(able) // 100}
    return sorted(((*r[:4], rank.get(id(r))) for r in rows), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark, table):
    sf = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in table("documents", sf)]
    target = [r["text"] for r in table("benchmark", sf)]
    df = QUERIES["op12_resampling"](spark, sf)
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in df.dtypes} == {"bigint"}
    assert got(df) == expected(docs, target)


def test_cases(spark, make_docs):
    rng = random.Random(1)
    odd = ["İstanbul", "ÄÖ", "x²", "中文", "a\x00b", "it's", "A-Z", "w" * 47, "w" * 48, "w" * 49, "é" * 400, " ", " ", "9", "_"]
    docs = [(i, " ".join(rng.choice(odd) for _ in range(rng.randint(0, 60)))) for i in range(200)]
    docs += [(None, "word " * 30), (None, "word " * 30), (7, "word " * 30), (7, "word " * 30), (900, None), (901, ""), (902, "..."), (903, "long " * 300_000)]
    target = make_docs([(1, "word word ÄÖ"), (2, None), (3, ""), (4, "x² 中文")])
    want = expected(docs, ["word word ÄÖ", None, "", "x² 中文"], percent=40)
    assert got(resampling.importance(make_docs(docs), target, percent=40)) == want


def test_empty_tables(make_docs):
    docs = make_docs([(1, "a b " * 15), (2, "c d " * 15), (3, "e"), (4, "f " * 30), (5, "g " * 30)])
    none = docs.where("false")
    assert resampling.importance(none, docs).count() == 0
    assert resampling.importance(none, none).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(resampling.importance(docs, none)) == expected(rows, [])


def test_no_bigram_over_documents_and_none_missing_inside_batches():
    features = resampling.Features(1 << 31)
    texts = [b"a b", b"", None, b"c", b"c d e"]
    of_single, singles, of_pair, pairs = features(texts)
    assert of_single.tolist() == [0, 0, 3, 4, 4, 4] and of_pair.tolist() == [0, 4, 4]
    assert pairs.tolist() == [zlib.crc32(x) % (1 << 31) for x in (b"a b", b"c d", b"d e")]
    assert [a.size for a in features([])] == [0, 0, 0, 0]


def test_small_caches_change_nothing(monkeypatch):
    texts = [" ".join(f"w{k % 17}" for k in range(n)).encode() for n in range(60)]
    whole = resampling.Features(1000)(texts)
    monkeypatch.setattr(resampling, "CACHE_BYTES", 10)
    small = resampling.Features(1000)
    parts = [small(texts[k : k + 7]) for k in range(0, 60, 7)]
    assert np.concatenate([p[1] for p in parts]).tolist() == whole[1].tolist()
    assert np.concatenate([p[3] for p in parts]).tolist() == whole[3].tolist()


def test_drawn_rows_move_towards_the_target(make_docs):
    docs = [(i, ("good fine " if i % 2 else "bad poor ") * 20) for i in range(400)]
    out = resampling.resampled(make_docs(docs), make_docs([(0, "good fine " * 50)]))
    rows = out.collect()
    assert len(rows) == 100 and out.columns[:2] == ["doc_id", "text"] and "rank" in out.columns
    assert sum("good" in r["text"] for r in rows) > 60
    repeated = make_docs([(None, "q " * 30)] * 8)
    assert resampling.resampled(repeated, repeated).count() == 8
