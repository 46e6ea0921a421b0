import hashlib

import numpy as np
import xxhash

from tests_llm_helpers import components_of, words_of
from tidecast.llm import exact_dedup, simhash
from tidecast.llm.components import components

CASES = [
    (1, "a b c"), (2, None), (3, ""), (4, "a b c"), (5, "A b c"), (6, " "), (7, "x" * 9000), (8, "x" * 9000), (9, "x" * 8999 + "y"),
    (10, "é" * 5000), (None, "alone"), (11, "𝒳" * 4097), (12, "𝒳" * 4097), (13, "x" * 4096), (14, "x" * 4097), (1, "a b c"), (2, "other"),
]


def test_block_names_group_equal_texts_only(make_docs):
    got = exact_dedup.exact_duplicates(make_docs(CASES)).collect()
    assert len(got) == len(CASES)
    groups = {}
    for doc_id, text in CASES:
        groups.setdefault(text or "", []).append(doc_id)
    want = set()
    for text, ids in groups.items():
        real = [i for i in ids if i is not None]
        keep = max(real) if real else None
        want |= {(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids}
    assert {(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got} == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in kept)


def test_small_blocks_and_odd_numbers_of_blocks(make_docs):
    texts = ["abcabcabc"[:n] for n in range(10)] + ["abcabcabd", "bcabcabca", "abcabcabc"]
    rows = exact_dedup.exact_duplicates(make_docs(list(enumerate(texts))), block=2).collect()
    assert {r.doc_id: r.keep_id for r in rows} == {i: max(j for j, t in enumerate(texts) if t == x) for i, x in enumerate(texts)}


def test_dropping_copies_keeps_columns(make_docs):
    docs = make_docs(CASES)
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.text or "") for r in kept.collect()) == sorted({t or "" for _, t in CASES})


def test_empty_tables(make_docs, spark):
    none = make_docs([(1, "x")]).where("doc_id > 1")
    assert exact_dedup.exact_duplicates(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def fingerprint(text):
    words = words_of(text)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components_equal_brute_force(make_docs, table):
    docs = [(r["doc_id"], r["text"]) for r in table("documents")]
    base = "one two three four five six seven eight nine ten " * 40
    docs += [(9000 + k, base + f"tail{k % 7} end") for k in range(30)] + [(9100, None), (9101, ""), (9102, " \t"), (9103, "Word"), (9104, "word")]
    got = {r.doc_id: r for r in simhash.near_duplicates(make_docs(docs)).collect()}
    prints = {i: fingerprint(t) for i, t in docs}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    near = [(i, j) for i in prints for j in prints if i < j and (prints[i] ^ prints[j]).bit_count() <= 3]
    assert {i: r.component_id for i, r in got.items()} == components_of(prints, near)


def test_hot_groups_are_dealt_again_without_loss(spark):
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 2**63))
    values = {centre}
    for _ in range(400):
        x = centre
        for b in rng.choice(64, size=int(rng.integers(1, 9)), replace=False):
            x ^= 1 << int(b)
        values.add(x)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    bits = spark.createDataFrame([(v,) for v in signed], "bits long")
    roots = {r.node: r.root for r in components(simhash.fingerprint_links(bits, group_limit=5)).collect()}
    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3]
    assert {v: roots.get(v, v) for v in signed} == components_of(signed, near)


def test_pivot_table_loses_no_pair():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**64, 300, dtype=np.uint64)
    values = np.unique(np.concatenate((values, values ^ np.uint64(5), values ^ (np.uint64(1) << np.uint64(63)))))
    found = {tuple(sorted(p)) for a, b in simhash.PivotTable().near_pairs(values, 3) for p in zip(a.tolist(), b.tolist())}
    want = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if (int(values[i]) ^ int(values[j])).bit_count() <= 3}
    assert found == want


def test_one_row_of_each_component_stays(make_docs):
    base = "some words that stand in all of these texts again and again " * 30
    docs = make_docs([(3, base + "x"), (1, base + "x"), (2, base), (2, base), (7, "something else entirely here"), (None, "lonely text here"), (7, base)])
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [(r.doc_id, r.text) for r in kept.collect()]
    assert (1, base + "x") in ids and (7, "something else entirely here") in ids and (None, "lonely text here") in ids
    assert len(ids) == len(set(ids)) and (7, base) not in ids


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(200, 260)] + [(7, 7), (None, 3), (4, None)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{k: 5 for k in [5, *range(200, 260)]}}
