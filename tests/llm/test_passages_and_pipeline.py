import random
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from tests_llm_helpers import components_of, words_of
from tidecast.llm import language, packing, passages, simhash

WORD = passages.WORDS


def prose(seed, n):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def planted():
    shared, other, near = prose(1, 60), prose(2, 51), prose(3, 120)
    docs = {i: prose(100 + i, 40 + 13 * i) for i in range(12)}
    for i, at in ((2, 0), (5, 31), (9, 17)):
        docs[i][at:at] = shared
    docs[7][3:3] = other
    docs[8] = docs[8] + other
    docs[20] = list(near)
    docs[21] = [*near[:50], "changed", *near[51:]]
    docs[22] = prose(7, 80)
    docs[23] = list(docs[22])  # an exact copy
    docs[24] = prose(8, 20) + shared[:40]  # too short a part
    docs[25] = (prose(9, 30)) * 6  # repeats itself only
    rows = [(i, " ".join(w).upper() if i == 9 else "\n".join(w)) for i, w in docs.items()]
    return rows + [(30, None), (31, ""), (32, "w1 " * 49), (33, "\t".join(docs[22]))]


def test_planted_passages_are_found_and_clean_texts_left_alone(make_docs):
    rows = planted()
    got = passages.repeated_passages(make_docs(rows)).collect()
    spans = defaultdict(list)
    for r in got:
        spans[r.doc_id].append((r.start_word, r.end_word))
    assert set(spans) == {2, 5, 7, 8, 9, 20, 21, 22, 23, 33}
    texts = {i: words_of(t) for i, t in rows}
    for i, ranges in spans.items():
        assert all(0 <= a < b <= len(texts[i]) for a, b in ranges)
    covers = lambda i, a, b: any(x <= a and b <= y for x, y in spans[i])
    assert covers(2, 0, 60) and covers(5, 31, 91) and covers(9, 17, 77) and covers(7, 3, 54)
    assert covers(22, 0, 80) and covers(23, 0, 80) and covers(33, 0, 80) and covers(20, 0, 120)
    component = {r.doc_id: r.component_id for r in got}
    assert component == {2: 2, 5: 2, 9: 2, 7: 7, 8: 7, 20: 20, 21: 20, 22: 22, 23: 22, 33: 22}
    assert {r.doc_id for r in got if r.kept} == {2, 7, 20, 22}


def test_every_exact_repeat_of_a_paragraph_is_covered(make_docs, table):
    docs = table("documents", "/root/testdata/sf0.01")[:400]
    rows = [(d["doc_id"], d["text"]) for d in docs]
    got = defaultdict(list)
    for r in passages.repeated_passages(make_docs(rows)).collect():
        got[r.doc_id].append((r.start_word, r.end_word))
    owners = defaultdict(set)
    texts = {i: words_of(t) for i, t in rows}
    for i, w in texts.items():
        for j in range(len(w) - WORD + 1):
            owners[tuple(w[j : j + WORD])].add(i)
    for i, w in texts.items():
        for j in range(len(w) - WORD + 1):
            if len(owners[tuple(w[j : j + WORD])]) > 1:
                assert any(a <= j and j + WORD <= b for a, b in got[i]), (i, j)


def test_a_shingle_of_many_documents_is_dealt_out(make_docs):
    shared = prose(1, 55)
    rows = [(i, " ".join([*prose(50 + i, 20), *shared, *prose(90 + i, 5)])) for i in range(40)]
    got = passages.repeated_passages(make_docs(rows), group_limit=8).collect()
    assert {r.doc_id for r in got} == set(range(40))
    assert {r.component_id for r in got} == {0} and sum(r.kept for r in got) == 1


def test_few_or_no_texts(make_docs):
    assert passages.repeated_passages(make_docs([(1, " ".join(prose(1, 90)))])).count() == 0
    same_id = [(1, " ".join(prose(1, 90))), (1, " ".join(prose(1, 90))), (None, " ".join(prose(2, 90)))]
    assert passages.repeated_passages(make_docs(same_id)).count() == 0
    assert passages.repeated_passages(make_docs([(1, "x")]).where("false")).count() == 0


def test_dealing_out_by_runs_finds_every_partner():
    rng = np.random.default_rng(0)
    width = passages.BEFORE + passages.AFTER
    draw = lambda: rng.integers(1, 60_000, width).astype("<u2")
    base = [draw() for _ in range(4)]
    rows = [draw() for _ in range(40)]
    for _ in range(160):
        row = base[rng.integers(4)].copy()
        low = int(rng.integers(0, passages.BEFORE))  # another text around a stretch of 50 to 60 words
        high = min(width, low + int(rng.integers(46, 62)))
        row[:low], row[high:] = draw()[:low], draw()[high:]
        for at in rng.integers(0, width, size=int(rng.integers(0, 3))):
            if not passages.BEFORE <= at < passages.BEFORE + passages.SHINGLE:
                row[at] = rng.integers(1, 60_000)
        rows.append(row)
    rows, docs = np.stack(rows), np.arange(200)
    want = set()
    for i in docs:
        _, end = passages.paragraphs_alike(rows, rows[i], 0.8)
        want |= {int(i)} if (np.delete(end, i) >= 0).any() else set()
    for groups in (np.zeros(200, dtype=int), docs // 20):
        found = passages.compared(groups, docs, rows, 0.8)
        if not groups.any():
            assert set(np.flatnonzero(found.last >= 0).tolist()) == want and 60 < len(want) < 190
        for i in docs:
            near = docs[(groups == groups[i]) & (docs != i)]
            _, end = passages.paragraphs_alike(rows[near], rows[i], 0.8)
            assert (found.last[i] >= 0) == (end >= 0).any()


def test_pipeline_stages_one_by_one(spark, table):
    sf = "/root/testdata/sf0.01"
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        steps[name] = docs.collect()
        assert name == "packing" or docs.columns == columns
    raw = table("documents", sf)
    assert {r.doc_id for r in steps["language"]} >= {d["doc_id"] for d in raw if any(c.isalpha() for c in d["text"])} - set(low_scores(spark, sf))
    last = {}
    for r in steps["language"]:
        last[r.text] = max(last.get(r.text, -1), r.doc_id)
    assert sorted(r.doc_id for r in steps["exact_dedup"]) == sorted(last.values())
    prints = {r.doc_id: fingerprint(r.text) for r in steps["exact_dedup"]}
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    assert sorted(r.doc_id for r in steps["near_dedup"]) == sorted(set(components_of(prints, near).values()))
    assert {r.doc_id for r in steps["mixing"]} == {r.doc_id for r in steps["near_dedup"]}
    pieces = Counter(r.doc_id for r in steps["packing"] if r.piece == 0)
    assert pieces == Counter(r.doc_id for r in steps["mixing"])


def low_scores(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    letters = {r.doc_id: sum(c.isalpha() for c in r.text or "") for r in docs.collect()}
    rows = language.identify(docs).collect()
    return [r.doc_id for r in rows if r.lang_pred == "und" or any(letters[r.doc_id] >= n and r.score < c for n, c in corpus_pipeline.BORDERS)]


def test_foreign_texts_go_and_clean_ones_stay(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    foreign = ["我们今天去公园散步然后回家吃饭", "zzxqj wvvkq qqxz jjvk", "Ελληνικά γράμματα είναι εδώ", "привет как дела сегодня", "日本語のテキストを書きます", "한국어 문장을 씁니다 오늘은", "12 34 ...", "", None]
    extra = spark.createDataFrame([(10**6 + i, t, None, "new", 0) for i, t in enumerate(foreign)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs.select(*extra.columns).unionByName(extra), sf).collect()}
    assert not {i for i in kept if i >= 10**6}
    lettered = {r.doc_id for r in docs.collect() if any(map(str.isalpha, r.text or ""))}
    assert lettered <= kept


def fingerprint(text):
    hashes = simhash.shingle_hashes(text)
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_run_equals_the_stages_in_turn(spark):
    sf = "/root/testdata/sf0.001"
    rows = corpus_pipeline.run(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
    assert Counter((r.doc_id, r.ids_crc32) for r in rows) == Counter((r.doc_id, r.ids_crc32) for r in packing.packed_sequences(docs).collect())


def jaccard(one, other):
    shingles = [Counter(tuple(w[i : i + passages.SHINGLE]) for i in range(len(w) - passages.SHINGLE + 1)) for w in (one, other)]
    return (shingles[0] & shingles[1]).total() / (shingles[0] | shingles[1]).total()


def test_a_word_put_in_or_left_out_is_verified():
    rng = np.random.default_rng(3)
    width = passages.BEFORE + passages.AFTER
    draw = lambda n: rng.integers(1, 60_000, n).astype("<u2")
    for change in (lambda p: np.insert(p, 30, 7), lambda p: np.delete(p, 30), lambda p: np.concatenate((p[:22], p[22:24], p[20:]))):
        passage = draw(60)
        rows = []
        for p in (passage, change(passage)):
            at = passages.BEFORE - 10  # both have the shingle that starts at the passage's tenth word
            rows.append(np.concatenate((draw(at), p, draw(width)))[:width])
        rows = np.stack(rows)
        windows = [[r[s : s + WORD].tolist() for s in range(passages.BEFORE + 1)] for r in rows]
        want = any(jaccard(x, y) >= 0.8 for x in windows[0] for y in windows[1])
        assert want and (passages.paragraphs_alike(rows, rows[1], 0.8)[1][0] >= 0) and passages.paragraphs_alike(rows, rows[0], 0.8)[1][1] >= 0


def test_repeated_shingles_count_as_often_as_both_have_them():
    rng = np.random.default_rng(4)
    width = passages.BEFORE + passages.AFTER
    for _ in range(60):
        one = rng.integers(1, 4, width).astype("<u2")
        other = np.roll(one, int(rng.integers(-3, 4)))
        for at in rng.integers(0, width, 4):
            other[at] = rng.integers(1, 4)
        windows = [[r[s : s + WORD].tolist() for s in range(passages.BEFORE + 1)] for r in (one, other)]
        best = max(jaccard(x, y) for x in windows[0] for y in windows[1])
        assert (passages.paragraphs_alike(one[None], other, 0.8)[1][0] >= 0) == (best >= 0.8)


def test_every_pair_of_a_large_group_counts():
    """Links and widest extents equal those of all pairs, with words changed, put in and left out."""
    rng = np.random.default_rng(11)
    width = passages.BEFORE + passages.AFTER
    draw = lambda n: rng.integers(1, 60_000, n).astype("<u2")
    chain = [draw(width)]
    for _ in range(5):  # each like the one before, the ends unlike
        chain.append(chain[-1].copy())
        chain[-1][rng.integers(0, 40, 2)] = rng.integers(1, 60_000, 2)
    rows = []
    for _ in range(240):
        row = chain[rng.integers(len(chain))].copy()
        low = int(rng.integers(0, passages.BEFORE))
        high = min(width, low + int(rng.integers(46, 80)))
        row[:low], row[high:] = draw(width)[:low], draw(width)[high:]
        if rng.random() < 0.4:
            row = np.insert(row, 60, draw(1))[:width] if rng.random() < 0.5 else np.append(np.delete(row, 60), draw(1))
        rows.append(row)
    rows, docs = np.stack(rows), np.arange(240) // 2
    found = passages.compared(np.zeros(240, dtype=int), docs, rows, 0.8)
    links = []
    for i in range(240):
        others = np.flatnonzero(docs != docs[i])
        start, end = passages.paragraphs_alike(np.repeat(rows[i : i + 1], len(others), axis=0), rows[others], 0.8)
        alike = end >= 0
        links += [(i, int(j)) for j in others[alike]]
        assert (found.last[i], found.first[i]) == ((end[alike].max(), start[alike].min()) if alike.any() else (-1, 10**6))
    want = components_of(range(240), links)
    assert len(set(want.values())) < 200
    assert all(found.root(i) == want[i] for i in range(240))


def test_hot_shingles_lose_no_pair_and_no_task_holds_them_all(make_docs, monkeypatch):
    """One text with a passage of a much copied one, and alike pairs among unlike surroundings of one shingle."""
    line, much = prose(1, 5), prose(2, 90)
    rows = [(i, " ".join([*prose(100 + i, 6), *much])) for i in range(30)] + [(30, " ".join([*prose(200, 40), *much[15:75], *prose(201, 9)]))]
    for i in range(20):
        left, right = prose(300 + i // 2, 40), prose(400 + i // 2, 40)  # two of each
        rows.append((40 + i, " ".join([*prose(500 + i, 9), *left, *line, *right])))
    alone = {100 + i: " ".join([*prose(600 + i, 60), *line, *prose(700 + i, 60)]) for i in range(20)}
    rows += list(alone.items())
    spans = lambda limit: sorted(map(tuple, passages.repeated_passages(make_docs(rows), group_limit=limit).collect()))
    few = spans(6)
    assert few == spans(20_000)
    assert {r[0]: r[3] for r in few} == {**{i: 0 for i in range(31)}, **{40 + i: 40 + i // 2 * 2 for i in range(20)}}


def test_a_word_that_goes_on_repeating_gives_no_key_for_every_place(make_docs):
    rows = [(1, "the " * 5000), (2, " ".join(["a", "b", "c"] * 1500)), (3, " ".join(prose(1, 400)))]
    keys = {r.doc: len(r["keys"]) for r in passages.sketches(make_docs(rows), passages.BANDS).collect()}
    assert keys[1] <= 5000 / passages.IN_PARAGRAPH + 2 and keys[2] <= 3 * (4500 / 40 + 2) and keys[3] >= 400 / WORD


def test_fewer_places_stand_in_the_same_paragraphs():
    rng = np.random.default_rng(6)
    for _ in range(200):
        shingles = rng.integers(0, 4, 400).astype(np.uint64)
        places = np.flatnonzero(rng.random(400) < rng.choice([0.02, 0.2, 1]))
        kept = passages.needed_places(shingles, places)
        inside = lambda some: {(int(shingles[p]), s) for p in some.tolist() for s in range(p - passages.IN_PARAGRAPH + 1, p + 1)}
        assert set(kept.tolist()) <= set(places.tolist()) and inside(kept) == inside(places)
    assert passages.needed_places(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)).size == 0


def passages_by(texts, places_of):
    """Merged stretches as (doc, start, end, smallest doc of the component), and the number of occurrences."""
    rows = []
    for doc, words in enumerate(texts):
        hashes = passages.word_hashes([w.encode() for w in words], {})
        shingles = passages.shingle_hashes(hashes)
        codes = np.maximum(hashes >> np.uint64(48), np.uint64(1)).astype("<u2")
        rows += [(int(shingles[p]), doc, p, passages.around(codes, p)) for p in places_of(shingles, passages.least_positions(shingles, 2)).tolist()]
    rows.sort()
    groups = np.unique([r[0] for r in rows], return_inverse=True)[1]
    found = passages.compared(groups, np.array([r[1] for r in rows]), np.frombuffer(b"".join(r[3] for r in rows), dtype="<u2").reshape(len(rows), -1), 0.8)
    merged, links = [], []
    spans = [(r[1], r[2] - passages.BEFORE + int(found.first[i]), r[2] - passages.BEFORE + int(found.last[i]), found.root(i)) for i, r in enumerate(rows) if found.last[i] >= 0]
    for doc, a, b, root in sorted(spans):
        if merged and merged[-1][0] == doc and a < merged[-1][2]:
            merged[-1][2] = max(b, merged[-1][2])
        else:
            merged.append([doc, a, b])
        links.append((len(merged) - 1, root + 10**6))
    root = components_of({n for link in links for n in link}, links)
    return [(*m, merged[root[i]][0]) for i, m in enumerate(merged)], len(rows)


def test_fewer_places_find_the_same_passages():
    rng = random.Random(8)
    pool = [prose(30 + i, rng.randrange(20, 90)) for i in range(6)]
    runs = lambda: rng.choice([["the"], ["la", "li"], ["x", "y", "z", "x"], pool[0][:17]]) * rng.randrange(3, 90)
    for _ in range(4):
        texts = []
        for i in range(14):
            words = prose(rng.random(), rng.randrange(30))
            for _ in range(4):
                words += rng.choice([runs, lambda: rng.choice(pool), lambda: prose(rng.random(), 25)])()
            if i % 3 == 0:
                words[len(words) // 2 : len(words) // 2] = ["put", "in"]
            texts.append((words + prose(rng.random(), 60))[: rng.randrange(60, 900)])
        every, before = passages_by(texts, lambda shingles, places: places)
        fewer, after = passages_by(texts, passages.needed_places)
        assert fewer == every and len(every) > 5 and after < 0.5 * before
