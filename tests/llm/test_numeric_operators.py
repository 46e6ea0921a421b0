import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests_llm_helpers import words_of
from tidecast.llm import lm, mixing, packing, topk


def check_packing(rows, docs, capacity=4096):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    want = Counter()
    total = 0
    for doc_id, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        total += len(ids)
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            want[doc_id, k, a, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-total // capacity)


def test_pieces_and_sequences(make_docs, table):
    docs = [(r["doc_id"], r["text"]) for r in table("documents", "/root/testdata/sf0.01")]
    docs += [(None, None), (5000, ""), (5001, "it's <|endoftext|> x² İstanbul n°5 a'b',"), (5001, "twice"), (5001, "twice"), (5002, "word " * 9000)]
    rows = packing.packed_sequences(make_docs(docs)).collect()
    used, bound = check_packing(rows, docs)
    assert used <= bound * 1.01 + 1


def test_many_groups_pool_what_is_left(make_docs):
    docs = [(i, "a " * random.Random(i).randint(1, 60)) for i in range(600)]
    rows = packing.packed_sequences(make_docs(docs), capacity=64, group_pieces=50).collect()
    used, bound = check_packing(rows, docs, 64)
    assert used <= bound * 1.06 + 2


def test_no_documents(make_docs):
    assert packing.packed_sequences(make_docs([(1, "x")]).where("false")).count() == 0


def test_local_search_empties_bins_and_keeps_pieces():
    rng = random.Random(4)
    for _ in range(20):
        lengths = [rng.randint(5, 60) for _ in range(80)]
        start = packing.best_fit(lengths, 100)
        bins = packing.empty_bins([list(b) for b in start], lengths, 100)
        assert sorted(i for b in bins for i in b) == list(range(80))
        assert all(sum(lengths[i] for i in b) <= 100 for b in bins) and len(bins) <= len(start)
    # best fit leaves three bins here, one-for-two exchanges two
    assert len(packing.empty_bins([[0, 1], [2, 3], [4]], [50, 30, 50, 30, 40], 100)) == 2


def triplets(n, seed, capacity):
    """Lengths that fill n bins exactly, three pieces each."""
    rng, out = random.Random(seed), []
    for _ in range(n):
        a = rng.randint(capacity // 4, capacity // 2 - 1)
        b = rng.randint(capacity // 4, min(capacity // 2 - 1, capacity - a - capacity // 4))
        out += [a, b, capacity - a - b]
    rng.shuffle(out)
    return out


def test_local_search_runs_until_nothing_gains():
    lengths = triplets(400, 1, 4096)
    start = packing.best_fit(lengths, 4096)
    found = packing.empty_bins(start, lengths, 4096)
    assert len(start) >= 450 and len(found) <= 408
    small = triplets(12, 3, 60)
    end = packing.Bins(packing.best_fit(small, 60), small, 60)
    bins = end.run()

    def gains():
        """Squared fills of every packing that one exchange of two bins leads to."""
        for s in range(len(bins)):
            for t in range(len(bins)):
                outs = [x for r in (1, 2) for x in itertools.combinations(bins[s], r)]
                backs = [x for r in (0, 1, 2) for x in itertools.combinations(bins[t], r)]
                for out, back in itertools.product(outs, backs):
                    d = sum(small[i] for i in out) - sum(small[i] for i in back)
                    load_s, load_t = (sum(small[i] for i in bins[k]) for k in (s, t))
                    if s != t and (len(out), len(back)) != (2, 2) and d > 0 and load_t + d <= 60:
                        yield (load_s - d) ** 2 + (load_t + d) ** 2 - load_s**2 - load_t**2

    assert len(bins) == 12 or max(gains(), default=0) <= 0


SHARES = {"big": 4000, "mid": 800, "small": 300, None: 50}


def sources(make_docs, sizes=SHARES, words=9):
    rows, i = [], 0
    for source, tokens in sizes.items():
        for _ in range(tokens // 10):
            rows.append((i, "w " * words, None, source))
            i += 1
    return make_docs(rows), rows


def weights_for(shares, entropy, passes):
    total = sum(shares)
    p = [s / total for s in shares]

    def measure(a):
        z = sum(x**a for x in p)
        w = [x**a / z for x in p]
        ratio = [x / y for x, y in zip(w, p)]
        return -sum(x * math.log(x) for x in w), max(ratio) / min(ratio), w

    for k in range(2**mixing.BISECTION_BITS, -1, -64):
        a = k / 2**mixing.BISECTION_BITS
        h, most, w = measure(a)
        flat = h >= entropy * math.log(len(p))
        if most > passes:
            return prev
        prev = w
        if flat:
            return w
    return prev


@pytest.mark.parametrize("entropy, passes", [(0.6, 100.0), (0.95, 1000.0), (0.95, 3.0), (0.0, 4.0)])
def test_weights_and_quotas(make_docs, entropy, passes):
    docs, rows = sources(make_docs)
    got = mixing.mixture(docs, entropy, passes).collect()
    want = weights_for(list(SHARES.values()), entropy, passes)
    by_source, drawn = Counter(), Counter()
    for r in got:
        by_source[r.source] += r.n_tokens
        drawn[r.doc_id] += 1
    weight = {r.source: r.weight for r in got}
    assert [weight[s] for s in SHARES] == pytest.approx(want, abs=2e-3)
    budget = max(t / weight[s] for s, t in SHARES.items())
    for s, t in SHARES.items():
        assert weight[s] * budget - 10 - 1e-3 <= by_source[s] <= max(weight[s] * budget, t) + 1e-3
        times = [drawn[i] for i, _, _, source in rows if source == s]
        assert min(times) >= 1 and max(times) - min(times) <= 1 and max(times) <= math.ceil(passes)


def test_budget_takes_less_than_a_pass_and_order_holds_the_weights(make_docs):
    docs, _ = sources(make_docs, {"a": 30_000, "b": 20_000})
    got = mixing.mixture(docs, 0.0, 4.0, budget_tokens=10_000).collect()
    tokens = Counter()
    for r in got:
        tokens[r.source] += r.n_tokens
    assert 5_990 <= tokens["a"] <= 6_000 and 3_990 <= tokens["b"] <= 4_000
    assert max(Counter(r.doc_id for r in got).values()) == 1
    half = Counter()
    for r in sorted(got, key=lambda r: r.mix_position)[: len(got) // 2]:
        half[r.source] += r.n_tokens
    assert half["a"] / sum(half.values()) == pytest.approx(0.6, abs=0.02)


def test_mixing_keeps_rows_and_takes_empty_tables(make_docs):
    docs = make_docs([(1, None, None, "a"), (2, "", None, "a"), (2, "", None, "a"), (None, "x y", None, None)])
    drawn = mixing.draws(docs).select("row.*")
    assert drawn.columns == docs.columns and drawn.count() >= 4
    assert mixing.mixture(docs.where("false")).count() == 0


def test_words_in_equals_split(spark):
    texts = ["", " ", "a", " a", "a ", "  a\t\nb  ", "a\x0bb\x0cc\rd", "é x", "a\xa0b", "\n"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(mixing.words_in(mixing.text_or_empty("t"))).collect()]
    assert got == [len(words_of(t)) + 1 for t in texts]


def test_base_scores_counts_and_gain(spark, table):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in lm.scores(spark.read.parquet(f"{sf}/documents.parquet"), head_words=5_000).collect()}
    docs = table("documents", sf)
    counts, ends = Counter(), 0
    for d in docs:
        if zlib.crc32(str(d["doc_id"]).encode()) % 5 != 1:
            counts.update(words_of(d["text"]))
            ends += 1
    total, types = sum(counts.values()) + ends, len(counts) + 1
    base = model = 0.0
    for d in docs:
        words, r = words_of(d["text"]), got[d["doc_id"]]
        want = sum(math.log10((c + 0.5) / (total + 0.5 * (types + 1))) for c in [*(counts[w] for w in words), ends])
        assert r.base_score == pytest.approx(want, rel=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words) + 1, sum(counts[w] > 0 for w in words) + 1, total)
        assert r.score < 0
        if r.held_out:
            base, model = base + r.base_score, model + r.score
    assert model > base  # closer to zero on documents it never saw


def test_model_probabilities_sum_to_one(make_docs):
    train = [(i, "a b c a b d " * (1 + i % 3)) for i in range(12)]
    known = ["a", "b", "c", "d"]
    ids = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 5 == 1][:8]
    rows = train + [(ids[0], "a")] + [(ids[1 + k], f"a {w}") for k, w in enumerate(known)] + [(ids[5], None), (ids[6], "a zzz")]
    got = {r.doc_id: 10**r.score for r in lm.scores(make_docs(rows)).collect()}
    # P(w, end | a) <= P(w | a); together with the end after a they cannot exceed one
    assert 0 < sum(got[i] for i in ids[1:5]) + got[ids[0]] <= 1
    assert 0 < got[ids[6]] < 0.5 and 0 < got[ids[5]] <= 1


def test_scores_without_training_and_empty(make_docs):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    rows = lm.scores(make_docs([(ids[0], "a b"), (ids[1], None), (None, "x")])).collect()
    assert [(r.train_tokens, r.n_known) for r in rows] == [(0, 0)] * 3
    assert sorted(r.base_score for r in rows) == pytest.approx([0.0] * 3, abs=1e-9)
    assert lm.scores(make_docs([(1, "x")]).where("false")).count() == 0


def brute_top(vectors, every, k):
    use = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            use.setdefault((i, tuple(math.floor(1024 * x) for x in v)), None)
    out = []
    for i, q in use:
        if i % every == 0:
            scored = sorted({(-sum(a * b for a, b in zip(q, v)), j) for j, v in use if j != i})[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(50_000, 10_000), (60, 4)])
def test_top_k_equals_brute_force(spark, blocks):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(x) for x in centres[i % 6] + 0.05 * rng.normal(size=8)]) for i in range(400)]
    rows += [(1000 + i, [1.0] * 8) for i in range(40)] + [(2000, None), (2001, [1.0, None]), (2010, [float("nan")] * 8), (2020, [float("inf")]), (None, [1.0])]
    rows += [(2030, [0.5, -0.25]), (2040, []), (1000, [1.0] * 8)]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, rank int, score string")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.neighbours(frame, 10, 10, *blocks).collect())
    assert got == brute_top(rows, 10, 10)


def test_top_k_of_few_or_none(spark):
    frame = spark.createDataFrame([(100, [1.0]), (7, [2.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in topk.neighbours(frame).collect()] == [(100, 1, 7, 1024 * 2048)]
    assert topk.neighbours(frame.where("false")).count() == 0


def test_clusters_are_pruned():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 16)) * 100
    data = np.round(centres[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 16)))
    queries = np.round(centres[:5] + rng.normal(size=(5, 16)))
    search = topk.DualSearch(queries, np.arange(5), data, [np.array([i + 10]) for i in range(4000)], 10)
    best = search.run()
    exact = -np.sort(-(queries @ data.T), axis=1)[:, :10]
    assert (best.score == exact).all() and search.compared < 0.4 * 5 * 4000


def test_scores_beyond_exact_doubles(spark):
    rows = [(i, [float(2**20 + i), float(3 * i + 1)]) for i in range(30)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.neighbours(frame, 10, 5).collect())
    assert got == brute_top(rows, 10, 5)
