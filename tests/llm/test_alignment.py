import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidecast.llm import alignment
from tidecast.llm.packing import visible_bytes
from tidecast.llm.queries import QUERIES

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def plain_tokens(tokenizers, text):
    """(id, bytes) of both sides, without tables: vocabulary strings decoded one by one."""
    a, b = tokenizers
    byte = {c: n for n, c in enumerate(visible_bytes())}
    side_a = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    side_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        is_byte = len(piece) == 6 and piece.startswith("<0x")
        side_b.append((i, bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()))
    return side_a, side_b


def expected(tokenizers, docs):
    """The contract, token by token."""
    per_doc, pairs = [], Counter()
    for doc_id, text in docs:
        a, b = plain_tokens(tokenizers, text) if text else ([], [])
        whole = (" " + text).encode() if text else b""
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            a, b = [], []
        ends_b, at = {}, 0
        for j, (_, x) in enumerate(b):
            at += len(x)
            ends_b[at] = j
        groups, links, at, i0, j0 = [], [], 0, 0, 0
        for i, (_, x) in enumerate(a):
            at += len(x)
            if at in ends_b:
                j = ends_b[at]
                links.append((a[i][0], b[j][0]))
                groups.append(",".join(str(k) for k, _ in a[i0 : i + 1]) + "|" + ",".join(str(k) for k, _ in b[j0 : j + 1]))
                i0, j0 = i + 1, j + 1
        pairs.update(links)
        per_doc.append((doc_id, len(a), len(b), groups, links))
    most = {}
    for (_, j), n in pairs.items():
        most[j] = max(most.get(j, 0), n)
    return sorted(
        (
            (d, na, nb, len(g), len(l), sum(pairs[p] == most[p[1]] for p in l), sum(pairs[p] for p in l),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
            for d, na, nb, g, l in per_doc
        ),
        key=repr,
    )


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def odd_texts():
    rng = random.Random(8)
    parts = ["the", " quick", "  ", "\n", "\t", "naïve", "中文字", "🙂", "▁", "<0x41>", "<s>", "</s>", "<unk>", "<|endoftext|>", "1234567", "it's", "'ll",
             "....", "é", " ", "​", "\x00", "\r\n", "ﬁ", "Ａ", "İ", "𝔘", " ", "x" * 70, "don't", "--", "　"]
    return ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(1, 25))) for _ in range(300)]


def test_query_equals_brute_force(spark, table, tokenizers):
    sf = "/root/testdata/sf0.001"
    df = QUERIES["op11_alignment"](spark, sf)
    assert df.columns == COLUMNS and {t for c, t in df.dtypes if c != "groups_sha256"} == {"bigint"}
    docs = [(r["doc_id"], r["text"]) for r in table("documents", sf)]
    assert got(df) == expected(tokenizers, docs)


def test_cases(make_docs, tokenizers):
    docs = [*enumerate(odd_texts()), (None, None), (None, "again"), (7, "again"), (7, "again"), (901, ""), (902, " "), (903, "w" * 30_000 + " end")]
    frame = make_docs(docs)
    want = expected(tokenizers, docs)
    assert any(r[1] == 0 for r in want) and any(r[1] > 0 for r in want)
    assert got(alignment.aligned(frame)) == want
    # a short table of frequent pairs leaves the others to the join
    assert got(alignment.aligned(frame, head_pairs=5)) == want
    assert got(alignment.aligned(frame.where("false"))) == []


def test_groups_and_pair_table(make_docs, tokenizers):
    docs = [(1, "a naïve approach"), (2, "the naïve one")]
    frame = make_docs(docs)
    rows = alignment.aligned(frame, with_groups=True).collect()
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 for r in rows)
    table = alignment.pair_table(frame).collect()
    assert sum(r.n for r in table) == sum(r.n_links for r in rows)
    for b_id in {r.b_id for r in table}:
        group = [r for r in table if r.b_id == b_id]
        assert all(r.best == (r.n == max(x.n for x in group)) for r in group)


def test_ranks_give_the_ids_of_the_json_vocabulary(tokenizers, table):
    byte = alignment.ByteTokenizer(alignment.default_paths()[0], public_tokenizers.PATTERN)
    rng = random.Random(2)
    tokens = [t.decode("utf-8", "ignore") for t in byte.bytes_of]
    texts = ["".join(rng.choice(tokens) for _ in range(rng.randint(1, 12))) for _ in range(20_000)] + odd_texts()
    texts += [r["text"] or "" for r in table("documents")]
    whole = tokenizers[0].encode_batch([" " + t for t in texts], add_special_tokens=False)
    assert [byte.encode(" " + t) for t in texts] == [e.ids for e in whole]


def test_bounded_memory_changes_nothing(make_docs, monkeypatch):
    docs = make_docs(list(enumerate(odd_texts()[:60])))
    want = got(alignment.aligned(docs))
    for name, value in (("CACHE_TOKENS", 40), ("WINDOW_TOKENS", 3), ("SUM_PAIRS", 8)):
        monkeypatch.setattr(alignment, name, value)
    assert got(alignment.aligned(docs)) == want


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    rng = random.Random(5)
    sides = [np.array([rng.randint(0, 3) for _ in range(500)]) for _ in range(2)]
    cut = np.array(sorted({0, *rng.sample(range(500), 200)}))

    def key(k):
        return tuple(tuple(s[cut[k] : (*cut, 500)[k + 1]]) for s in sides)

    for colliding in (False, True):
        if colliding:
            monkeypatch.setattr(alignment, "MIX", (0, 0, 0, 0))
        kinds, kind = alignment.distinct_windows(tuple((s, cut) for s in sides))
        assert all(key(kinds[kind[k]]) == key(k) for k in range(len(cut)))
