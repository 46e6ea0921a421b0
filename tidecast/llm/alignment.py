"""Alignment of the tokens of two tokenizers, and corpus-wide counts of the aligned id pairs.

Every text is tokenised whole by both tokenizers, and the tokens' bytes must give back the text. Where
both have a token that begins with a space at the same byte, all tokens before end there: such
shared ends are anchors and cut the document into windows of token ids. A window's alignment depends
on its ids alone, so it is looked up by the pair of id tuples and only worked out once in a task.

Counting takes three steps. Documents are written with their distinct links and numbers; the links are
summed over the corpus; then each document looks up its pairs. The most frequent pairs (a stated
number) are held by every task, the rest is joined.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import map_slices, map_task
from tidecast.sources.storage import materialise

#: The ranks of the byte-level vocabulary give the ids of its JSON file, in less time (a test compares them).
BYTE_RANKS, PIECE_MODEL = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: Tokens of half the window alignments that a task remembers, and of one that it does.
CACHE_TOKENS, WINDOW_TOKENS = 2_500_000, 64
#: Distinct pairs that a task sums before it sends them; pairs that every task holds for the look-up.
SUM_PAIRS, HEAD_PAIRS = 1 << 20, 1 << 18
#: Between the two tuples of a packed key; multipliers of the hash of windows.
NO_ID, MIX = b"\xff\xff\xff\xff", (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

LINKED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes binary, numbers binary"
)


class ByteTokenizer:
    """Byte-level BPE; text in, ids out, with the bytes of each id."""

    def __init__(self, path: str, pattern: str) -> None:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        # without special tokens their strings are plain text
        self.model = tiktoken.Encoding("byte", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token

    def encode(self, text: str) -> list[int]:
        return self.model.encode_ordinary(text)


class PieceTokenizer:
    """Pieces with byte fallback; puts a space before the text by itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            else:
                self.bytes_of.append(piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Aligner:
    """Groups and links of the tokens of a text, window by window."""

    def __init__(self, bytes_a: list[bytes], bytes_b: list[bytes]) -> None:
        self.bytes_a, self.bytes_b = bytes_a, bytes_b
        self.size_a, self.size_b = (np.array([len(t) for t in x], dtype=np.int64) for x in (bytes_a, bytes_b))
        self.space_a, self.space_b = (np.array([t[:1] == b" " for t in x]) for x in (bytes_a, bytes_b))
        # of each id, A before B: its number inside and at the end of its side of a group
        self.names = [f"{i}{c}" for i in range(len(bytes_a)) for c in ",|"] + [f"{i}{c}" for i in range(len(bytes_b)) for c in ",;"]
        self.known: dict[bytes, tuple[str, bytes]] = {}
        self.older: dict[bytes, tuple[str, bytes]] = {}
        self.held = 0

    def aligned(self, keys: list[bytes], a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> list[tuple[str, bytes]]:
        """Groups of windows as text, and their links as codes (A id times the number of B ids plus B id).

        ``a`` and ``b`` are the ids of all these windows one after the other, ``sizes_a`` and ``sizes_b`` the
        numbers of tokens of each window; ``keys`` are their packed id tuples, under which they are remembered.
        """
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        place = np.searchsorted(ends_b, ends_a)  # windows end together, so there always is one
        shared_a = ends_b[place] == ends_a
        last_a, last_b = np.flatnonzero(shared_a), place[shared_a]
        shared_b = np.zeros(len(b), dtype=bool)
        shared_b[last_b] = True
        # tokens in the order in which groups name them: a group's A tokens, then its B tokens
        group_a, group_b = np.cumsum(shared_a) - shared_a, np.cumsum(shared_b) - shared_b
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + np.append(0, last_b + 1)[group_a]] = 2 * a + shared_a
        order[np.arange(len(b)) + (last_a + 1)[group_b]] = 2 * (b + len(self.bytes_a)) + shared_b
        raw = (a[last_a] * len(self.bytes_b) + b[last_b]).tobytes()
        links = np.append(0, np.cumsum(shared_a))[np.cumsum(sizes_a)].tolist()
        out, name, i, x = [], self.names.__getitem__, 0, 0
        for key, size, link in zip(keys, (sizes_a + sizes_b).tolist(), links, strict=True):
            found = "".join(map(name, order[i : i + size].tolist()))[:-1], raw[8 * x : 8 * link]
            i, x = i + size, link
            out.append(found)
            if size <= WINDOW_TOKENS:
                self._remember(key, found, size)
        return out

    def _remember(self, key: bytes, found: tuple[str, bytes], size: int) -> None:
        self.held += size + 8
        if self.held > CACHE_TOKENS:
            # windows that come again are taken over from the older half
            self.known, self.older, self.held = {}, self.known, size + 8
        self.known[key] = found

    def looked_up(self, keys: list[bytes], sides: tuple) -> list[tuple[str, bytes]]:
        """Alignments of windows by their keys; those not known yet are worked out together."""
        found: list[tuple[str, bytes] | None] = [self.known.get(key) for key in keys]
        for k, key in enumerate(keys):
            if found[k] is None and (old := self.older.get(key)) is not None:
                found[k] = old
                self._remember(key, old, len(key) // 4 - 1)
        new = [k for k, f in enumerate(found) if f is None]
        if new:
            (a, sizes_a), (b, sizes_b) = (
                (ids[np.repeat(first[new] - np.cumsum(span[new]) + span[new], span[new]) + np.arange(span[new].sum())], span[new])
                for ids, first, span in sides
            )
            for k, f in zip(new, self.aligned([keys[k] for k in new], a, b, sizes_a, sizes_b), strict=True):
                found[k] = f
        return found

    def windows(self, a: np.ndarray, b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First tokens of all windows on either side; ``first_a`` and ``first_b`` are those of the documents."""
        starts_a, starts_b = (np.cumsum(s[i]) - s[i] for s, i in ((self.size_a, a), (self.size_b, b)))
        marked_a, marked_b = self.space_a[a], self.space_b[b]
        marked_a[first_a] = marked_b[first_b] = True
        at_a, at_b = np.flatnonzero(marked_a), np.flatnonzero(marked_b)
        place = np.minimum(np.searchsorted(starts_b[at_b], starts_a[at_a]), len(at_b) - 1)
        shared = starts_b[at_b[place]] == starts_a[at_a]
        return at_a[shared], at_b[place[shared]]

    def __call__(self, texts: list[bytes], a: list[list[int]], b: list[list[int]]) -> list[tuple[str, np.ndarray] | None]:
        """Groups and link codes of each text; None for empty ones and where either side's bytes are not the text's.

        Equal windows of the batch are found by a hash of their ids and compared id by id, so that each
        is looked up once.
        """
        bytes_a, bytes_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        out: list[tuple[str, np.ndarray] | None] = [None] * len(texts)
        good = [k for k, t in enumerate(texts) if t and b"".join(map(bytes_a, a[k])) == t and b"".join(map(bytes_b, b[k])) == t]
        if not good:
            return out
        first_a, first_b = (np.cumsum([0, *[len(x[k]) for k in good[:-1]]]) for x in (a, b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(x[k] for k in good), dtype=np.int64) for x in (a, b))
        cut_a, cut_b = self.windows(ids_a, ids_b, first_a, first_b)
        kinds, kind = distinct_windows(((ids_a, cut_a), (ids_b, cut_b)))
        first, last = (cut_a[kinds], cut_b[kinds]), (np.append(cut_a[1:], len(ids_a))[kinds], np.append(cut_b[1:], len(ids_b))[kinds])
        raw_a, raw_b = ids_a.astype(np.uint32).tobytes(), ids_b.astype(np.uint32).tobytes()
        spans = zip(*(x.tolist() for x in (first[0], last[0], first[1], last[1])))
        keys = [raw_a[4 * i : 4 * x] + NO_ID + raw_b[4 * j : 4 * y] for i, x, j, y in spans]
        found = self.looked_up(keys, tuple((ids, i, x - i) for ids, i, x in zip((ids_a, ids_b), first, last)))
        groups, codes = [g for g, _ in found], np.frombuffer(b"".join([c for _, c in found]), dtype=np.int64)
        # links of all windows, one after the other
        number = np.array([len(c) // 8 for _, c in found], dtype=np.int64)
        lengths = number[kind]
        behind = np.cumsum(lengths)
        links = codes[np.repeat((np.cumsum(number) - number)[kind] - behind + lengths, lengths) + np.arange(behind[-1])]
        borders = [*np.searchsorted(cut_a, first_a).tolist(), len(cut_a)]
        kind_list = kind.tolist()
        for k, i, x in zip(good, borders, borders[1:]):
            own = links[behind[i] - lengths[i] : behind[x - 1]]
            out[k] = ";".join([groups[w] for w in kind_list[i:x]]), own
        return out


def distinct_windows(sides: tuple[tuple[np.ndarray, np.ndarray], ...]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of windows that stand for all equal ones, and for each window the place of its own in them.

    A side is its ids and the first place of each window in them.
    """
    spans = [np.diff(np.append(cut, len(ids))) for ids, cut in sides]
    id_mix, place_mix, sum_mix, side_mix = (np.uint64(m) for m in MIX)
    mixed = np.zeros(len(sides[0][1]), dtype=np.uint64)
    for (ids, cut), span in zip(sides, spans, strict=True):
        inside = np.arange(len(ids)) - np.repeat(cut, span)
        x = (ids + 1).astype(np.uint64) * id_mix + inside.astype(np.uint64) * place_mix
        x = (x ^ (x >> np.uint64(29))) * sum_mix
        mixed = mixed * side_mix + np.add.reduceat(x ^ (x >> np.uint64(32)), cut)
    _, kinds, kind = np.unique(mixed, return_index=True, return_inverse=True)
    like = kinds[kind]
    same = np.ones(len(like), dtype=bool)
    for (ids, cut), span in zip(sides, spans, strict=True):
        same &= span == span[like]
        shift = np.where(same, cut[like] - cut, 0)
        same &= np.logical_and.reduceat(ids[np.arange(len(ids)) + np.repeat(shift, span)] == ids, cut)
    # unlike windows of one hash stand for themselves
    other = np.flatnonzero(~same)
    kind[other] = len(kinds) + np.arange(len(other))
    return np.append(kinds, other), kind


def default_paths() -> tuple[str, str]:
    return public_tokenizers.path(BYTE_RANKS), public_tokenizers.path(PIECE_MODEL)


def linked(docs: DataFrame, paths: tuple[str, str] | None = None, with_groups: bool = False) -> DataFrame:
    """A row for each document: LINKED, and ``groups`` in plain text if asked for.

    ``codes`` are the distinct links in rising order, ``numbers`` how often each comes (64-bit integers).
    """
    ranks_path, model_path = paths or default_paths()
    pattern = public_tokenizers.PATTERN

    def make():
        byte, piece = ByteTokenizer(ranks_path, pattern), PieceTokenizer(model_path)
        aligner = Aligner(byte.bytes_of, piece.bytes_of)

        def link(rows, ids, texts):
            out = {k.split()[0]: [] for k in LINKED.split(", ")} | ({"groups": []} if with_groups else {})
            whole = [" " + t if t else "" for t in texts]
            a, b = [byte.encode(t) if t else [] for t in whole], piece.encode([t or "" for t in texts])
            found = aligner([t.encode() for t in whole], a, b)
            for row, doc_id, of_a, of_b, pair in zip(rows, ids, a, b, found, strict=True):
                n_a, n_b = (len(of_a), len(of_b)) if pair else (0, 0)
                groups, links = pair or ("", np.empty(0, dtype=np.int64))
                codes, numbers = np.unique(links, return_counts=True)
                values = (
                    row, doc_id, n_a, n_b, groups.count("|"), len(links),
                    hashlib.sha256(groups.encode()).hexdigest() if groups else "",
                    codes.tobytes(), numbers.astype(np.int64).tobytes(), *([groups] if with_groups else []),
                )
                for column, value in zip(out.values(), values, strict=True):
                    column.append(value)
            return out

        return link

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string")
    )
    return map_slices(rows, make, LINKED + (", groups string" if with_groups else ""))


def _summed(codes: list[np.ndarray], numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, place = np.unique(np.concatenate(codes), return_inverse=True)
    return every, np.bincount(place, weights=np.concatenate(numbers), minlength=len(every)).astype(np.int64)


def pair_counts(links: DataFrame) -> DataFrame:
    """``code, n, best``: links of each id pair in the corpus; best if no pair with its B id has more."""

    def run(slices: Iterator[list]) -> Iterator[dict]:
        codes, numbers, held, limit = [], [], 0, SUM_PAIRS
        for part_codes, part_numbers in slices:
            codes += [np.frombuffer(c, dtype=np.int64) for c in part_codes]
            numbers += [np.frombuffer(n, dtype=np.int64) for n in part_numbers]
            held += sum(map(len, part_codes)) // 8
            if held > limit:
                every, n = _summed(codes, numbers)
                if len(every) > SUM_PAIRS // 2:
                    yield {"code": every, "n": n}
                    every, n = every[:0], n[:0]
                codes, numbers, held, limit = [every], [n], len(every), len(every) + SUM_PAIRS
        if codes:
            every, n = _summed(codes, numbers)
            yield {"code": every, "n": n}

    counted = map_task(links.select("codes", "numbers"), run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    return materialise(counted, "pairs")


def with_best(pairs: DataFrame, ids_b: int) -> DataFrame:
    most = pairs.groupBy((F.col("code") % ids_b).alias("b")).agg(F.max("n").alias("most"))
    most = materialise(most, "most")
    return materialise(
        pairs.withColumn("b", F.col("code") % ids_b).join(most, "b").select("code", "n", (F.col("n") == F.col("most")).alias("best")), "best-pairs"
    )


def looked_up(links: DataFrame, pairs: DataFrame, head_pairs: int) -> DataFrame:
    """``links`` with ``n_best`` and ``count_sum``: frequent pairs looked up in the task, the rest by a join."""
    head = pairs.orderBy(F.col("n").desc(), "code").limit(head_pairs).toPandas().sort_values("code")
    codes, counts, best = (head[c].to_numpy(dtype=t) for c, t in (("code", np.int64), ("n", np.int64), ("best", np.int64)))
    kept = [c for c in links.columns if c not in ("codes", "numbers")]

    def make():
        def look_up(rows, binary_codes, binary_numbers):
            out = {"row": rows, "n_best": [], "count_sum": [], "rest_codes": [], "rest_numbers": []}
            for c, n in zip(binary_codes, binary_numbers, strict=True):
                own, number = np.frombuffer(c, dtype=np.int64), np.frombuffer(n, dtype=np.int64)
                at = np.searchsorted(codes, own)
                known = np.zeros(len(own), dtype=bool)
                inside = at < len(codes)
                known[inside] = codes[at[inside]] == own[inside]
                place, times = at[known], number[known]
                out["n_best"].append(int((times * best[place]).sum()))
                out["count_sum"].append(int((times * counts[place]).sum()))
                out["rest_codes"].append(own[~known])
                out["rest_numbers"].append(number[~known])
            return out

        return look_up

    schema = "row long, n_best long, count_sum long, rest_codes array<long>, rest_numbers array<long>"
    found = materialise(map_slices(links.select("row", "codes", "numbers"), make, schema), "looked-up")
    rest = found.where(F.size("rest_codes") > 0).select("row", F.explode(F.arrays_zip("rest_codes", "rest_numbers")).alias("r"))
    rest = rest.select("row", F.col("r.rest_codes").alias("code"), F.col("r.rest_numbers").alias("number")).join(pairs, "code")
    rest = rest.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("number")).otherwise(0)).alias("rest_best"), F.sum(F.col("number") * F.col("n")).alias("rest_sum")
    )
    numbers = found.select("row", "n_best", "count_sum").join(rest, "row", "left").select(
        "row",
        (F.col("n_best") + F.coalesce("rest_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rest_sum", F.lit(0))).alias("count_sum"),
    )
    return links.select(*kept).join(numbers, "row")


def aligned(
    docs: DataFrame, paths: tuple[str, str] | None = None, head_pairs: int = HEAD_PAIRS, with_groups: bool = False
) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A is the byte-level tokenizer, which gets the text with a space before it, B the piece tokenizer,
    which adds that space itself; strings of special tokens are plain text. Groups are the stretches
    between bytes where both have a token's end, links the two tokens that end there. ``n_best``
    counts the links whose pair is the most frequent of its B id in the corpus (ties all count),
    ``count_sum`` adds up the corpus counts of the links' pairs. ``with_groups`` adds ``groups``, such as
    ``a1,a2|b1;a3|b2,b3``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Null and empty texts, and those
    that either tokenizer does not give back byte for byte, have no tokens: zeros and an empty
    ``groups_sha256``; they count nowhere. Rows that repeat an id are documents of their own; a null
    id stays null. An empty table gives no rows. ``paths`` are files that every executor can open.
    Every task holds at most ``head_pairs`` counts (17 bytes each), which also pass the driver.
    """
    links = materialise(linked(docs, paths, with_groups), "links-of-tokens")
    ids_b = PieceTokenizer((paths or default_paths())[1]).model.get_piece_size()
    rows = looked_up(links, with_best(pair_counts(links), ids_b), head_pairs)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return rows.select(*columns, *(["groups"] if with_groups else []))


def pair_table(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """``a_id, b_id, n, best`` of all id pairs that are linked anywhere: a table to map one vocabulary to the other."""
    ids_b = PieceTokenizer((paths or default_paths())[1]).model.get_piece_size()
    pairs = with_best(pair_counts(materialise(linked(docs, paths), "links-of-tokens")), ids_b)
    return pairs.select(F.expr(f"code div {ids_b}").alias("a_id"), (F.col("code") % ids_b).alias("b_id"), "n", "best")
