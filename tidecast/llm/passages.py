"""Repeated passages: MinHash of sliding paragraphs, verified by exact Jaccard, clustered by components.

A paragraph is any stretch of WORDS words of a text (texts have no reliable paragraph breaks, and
a passage may stand in the middle of a line). Its MinHash under each of BANDS random orders is the
least of its word shingles. Neighbouring paragraphs mostly share their least shingle, so a text
gives about two for every WORDS words and order: the band keys. Of a shingle that a text repeats at
short distance, only as many places are kept as its paragraphs need. With one shingle a band, two
paragraphs of similarity s meet with probability 1 - (1 - s)^BANDS: 0.96 at 0.8 for two bands, and
always if they are equal.

Equal texts are first reduced to one. Shingles that only one document has are dropped before
anything else is looked at. Around each that is left, every two paragraphs that contain it are verified
by the exact Jaccard similarity of their shingles, repeats included, wherever they stand: a word put in
or left out shifts the others and costs only the shingles that hold it. Verified stretches of a document that overlap are merged to passages, and passages
linked over documents form components; one document keeps the passage.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import ascii_words, map_slices, map_task, text_or_empty
from tidecast.llm.components import components
from tidecast.sources.storage import materialise

WORDS, SHINGLE = 50, 5
SIMILARITY = 0.8
BANDS = 2
ORDERS = np.random.default_rng(5).integers(0, 2**63, size=8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Words of a text that are hashed in one step.
STEP_WORDS = 1 << 20
#: Occurrences of a shingle compared with each other in one task; of more, those of equal kind are found
#: by shuffles first, and what is left is dealt to blocks of which every two meet in a task.
GROUP_LIMIT = 20_000
#: Occurrences compared at once in a task, of whole groups.
TASK_ROWS = 20_000
#: Pairs compared at once, of them those of a kind at first; what stands for no shingle of a text, and for one that
#: no other document has.
STEP_PAIRS, STEP_LINKED, OUTSIDE, ALONE = 1_000, 30, 0, 2
NO_ID = -(2**63)
IN_PARAGRAPH = WORDS - SHINGLE + 1
#: Words kept before and after the first word of a shared shingle.
BEFORE, AFTER = WORDS - SHINGLE, WORDS


def word_hashes(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    if len(known) > 500_000:
        known.clear()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh64_intdigest(w)
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_hashes(hashes: np.ndarray) -> np.ndarray:
    n = len(hashes) - SHINGLE + 1
    with np.errstate(over="ignore"):
        total = np.zeros(n, dtype=np.uint64)
        for j in range(SHINGLE):
            total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n]
        total ^= total >> np.uint64(29)
        return total * np.uint64(0xBF58476D1CE4E5B9)


def least_positions(shingles: np.ndarray, bands: int) -> np.ndarray:
    """Positions of the shingles that are the least of some paragraph in some order."""
    found = [np.zeros(0, dtype=np.int64)]
    width = IN_PARAGRAPH
    for at in range(0, len(shingles) - width + 1, STEP_WORDS):
        part = shingles[at : at + STEP_WORDS + width - 1]
        place = np.arange(len(part), dtype=np.uint64)
        for order in ORDERS[:bands]:
            with np.errstate(over="ignore"):
                value = part * order
            low = ((value ^ (value >> np.uint64(31))) & ~np.uint64(0x1FFFFF)) | place
            size = 1
            while size * 2 <= width:
                low = np.minimum(low[:-size], low[size:])
                size *= 2
            if size < width:
                low = np.minimum(low[: len(low) - (width - size)], low[width - size :])
            spots = (low & np.uint64(0x1FFFFF)).astype(np.int64)
            found.append(at + spots[np.concatenate(([True], spots[1:] != spots[:-1]))])
    return np.unique(np.concatenate(found))


def needed_places(shingles: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Of the places of each shingle as few as are inside all the paragraphs that the others are inside of.

    A word or line that goes on repeating has the same shingle at every place or every few, and each would be
    compared with all of another text. Its paragraphs are what is compared, so one place for every paragraph's
    width does.
    """
    order = np.argsort(shingles[places], kind="stable")
    keys, at = shingles[places][order], places[order]
    near = (keys[1:] == keys[:-1]) & (at[1:] - at[:-1] <= IN_PARAGRAPH)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], near, [0]))))
    keep = np.ones(len(at), dtype=bool)
    for low, high in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        run, now = at[low : high + 1].tolist(), 0
        while now < len(run) - 1:
            after = bisect_right(run, run[now] + IN_PARAGRAPH) - 1
            keep[low + now + 1 : low + after] = False
            now = after
    return np.sort(at[keep])


def sketches(docs: DataFrame, bands: int) -> DataFrame:
    """``doc, text_key, n_words, keys, places, words`` of each row: band keys, where they are, 16 bits a word."""

    def make():
        known: dict[bytes, int] = {}

        def sketch(ids, texts_key, texts):
            out = {k: [] for k in ("doc", "text_key", "n_words", "keys", "places", "words")}
            for doc, key, text in zip(ids, texts_key, texts, strict=True):
                words = ascii_words(text)
                if len(words) < WORDS:
                    continue
                hashes = word_hashes(words, known)
                shingles = shingle_hashes(hashes)
                places = needed_places(shingles, least_positions(shingles, bands))
                out["doc"].append(doc)
                out["text_key"].append(key)
                out["n_words"].append(len(words))
                out["keys"].append(shingles[places].view(np.int64))
                out["places"].append(places.astype(np.int32))
                out["words"].append(np.maximum(hashes >> np.uint64(48), np.uint64(1)).astype("<u2").tobytes())
            return out

        return sketch

    schema = "doc long, text_key long, n_words int, keys array<long>, places array<int>, words binary"
    text = text_or_empty()
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.xxhash64(text, F.length(text)), F.col("text").cast("string"))
    return map_slices(rows, make, schema)


def around(words: np.ndarray, place: int) -> bytes:
    """The words around a shingle at ``place``; zero where the text has none."""
    out = np.zeros(BEFORE + AFTER, dtype="<u2")
    low, high = max(0, place - BEFORE), min(len(words), place + AFTER)
    out[low - place + BEFORE : high - place + BEFORE] = words[low:high]
    return out.tobytes()


def shingle_rows(rows: np.ndarray) -> np.ndarray:
    """Shingles of surroundings (n x words), each above ALONE; OUTSIDE where the text does not reach."""
    n = rows.shape[1] - SHINGLE + 1
    total, inside = np.zeros((len(rows), n), dtype=np.uint64), np.ones((len(rows), n), dtype=bool)
    words = rows.astype(np.uint64)
    with np.errstate(over="ignore"):
        for j in range(SHINGLE):
            total = total * np.uint64(0x9E3779B97F4A7C15) + words[:, j : j + n]
            inside &= rows[:, j : j + n] != 0
        total ^= total >> np.uint64(29)
        total *= np.uint64(0xBF58476D1CE4E5B9)
    return np.where(inside, total | np.uint64(4), np.uint64(OUTSIDE))


def moving_sum(values: np.ndarray, width: int) -> np.ndarray:
    sums = np.zeros((len(values), values.shape[1] + 1), dtype=np.int16)
    np.cumsum(values, axis=1, dtype=np.int16, out=sums[:, 1:])
    return sums[:, width:] - sums[:, :-width]


def least_common(similarity: float) -> int:
    """m equal shingles of IN_PARAGRAPH on either side have the Jaccard similarity m / (2 IN_PARAGRAPH - m)."""
    return int(np.ceil(2 * IN_PARAGRAPH * similarity / (1 + similarity) - 1e-9))


def whole(shingles: np.ndarray) -> np.ndarray:
    """Which paragraphs are inside the text."""
    return moving_sum(shingles != OUTSIDE, IN_PARAGRAPH) == IN_PARAGRAPH


def inside_some(paragraphs: np.ndarray, axis: int) -> np.ndarray:
    """How many of the marked paragraphs hold each shingle."""
    paragraphs = np.moveaxis(paragraphs, axis, -1)
    sums = np.zeros((*paragraphs.shape[:-1], paragraphs.shape[-1] + 1), dtype=np.int16)
    np.cumsum(paragraphs, axis=-1, dtype=np.int16, out=sums[..., 1:])
    place = np.arange(paragraphs.shape[-1] + IN_PARAGRAPH - 1)
    counts = sums[..., np.minimum(place + 1, paragraphs.shape[-1])] - sums[..., np.maximum(0, place - IN_PARAGRAPH + 1)]
    return np.moveaxis(counts, -1, axis)


def ends_of(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) in words of the marked shingles of each row."""
    return places.argmax(axis=1), places.shape[1] - 1 - places[:, ::-1].argmax(axis=1) + SHINGLE


def shared_places(one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where in its ``one`` each shingle of ``other`` first stands (-1: nowhere), and where each of ``one`` first does."""
    spots, firsts = np.empty(other.shape, dtype=np.int16), np.empty(one.shape, dtype=np.int16)
    for at in range(0, len(one), STEP_PAIRS):
        a, b = one[at : at + STEP_PAIRS], other[at : at + STEP_PAIRS]
        equal = (a[:, :, None] == b[:, None, :]) & (a > ALONE)[:, :, None]
        spots[at : at + len(a)] = np.where(equal.any(axis=1), equal.argmax(axis=1), -1)
        firsts[at : at + len(a)] = np.where(a > ALONE, (a[:, :, None] == a[:, None, :]).argmax(axis=2), -1)
    return spots, firsts


def repeated_shingles(found: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shared shingles of pairs as (pair, first place in the one), those that repeat on a side, and the others' places.

    Returns the owners and first places of the repeating ones, then a mask of the places in ``found`` of the others,
    and these pairs' numbers.
    """
    n, width = found.shape
    pair, y = np.nonzero(found >= 0)
    in_other = np.bincount(pair * width + found[pair, y], minlength=n * width)
    own, x = np.nonzero(firsts >= 0)
    in_one = np.bincount(own * width + firsts[own, x], minlength=n * width)
    (keys,) = np.nonzero((in_other > 0) & ((in_other > 1) | (in_one > 1)))
    once = (in_other[pair * width + found[pair, y]] == 1) & (in_one[pair * width + found[pair, y]] == 1)
    return keys // width, keys % width, y[once], pair[once]


def spans_on_grid(found: np.ndarray, firsts: np.ndarray, ok_one: np.ndarray, ok_other: np.ndarray, need: int) -> tuple[np.ndarray, ...]:
    """Start and end of what paragraphs marked ok share where they are alike, on either side; 10**6 and -1 if none are.

    Every two paragraphs are a point of a grid. A shingle that stands once on either side counts in a rectangle
    of it; of one that repeats, the smaller of its two numbers counts. ``found`` and ``firsts`` are as in
    :func:`shared_places`.
    """
    n, windows = ok_one.shape
    owner, value, y, pair = repeated_shingles(found, firsts)
    x = found[pair, y].astype(np.int64)
    low_x, high_x = np.maximum(x - IN_PARAGRAPH + 1, 0), np.minimum(x + 1, windows)
    low_y, high_y = np.maximum(y - IN_PARAGRAPH + 1, 0), np.minimum(y + 1, windows)
    side = windows + 1
    corners = [(pair * side + p) * side + q for p in (low_x, high_x) for q in (low_y, high_y)]
    common = np.zeros(n * side * side, dtype=np.int16)
    for corner, sign in zip(corners, (1, -1, -1, 1), strict=True):
        np.add.at(common, corner, np.int16(sign))
    common = common.reshape(n, side, side)
    np.cumsum(common, axis=1, out=common)
    np.cumsum(common, axis=2, out=common)
    common = common[:, :windows, :windows]
    # a bounded number of repeating shingles at once, with their places and numbers in every paragraph
    parts = [slice(at, at + STEP_PAIRS) for at in range(0, len(owner), STEP_PAIRS)]

    def places(part: slice) -> list[np.ndarray]:
        return [side[owner[part]] == value[part, None] for side in (firsts, found)]

    for part in parts:
        one, other = (moving_sum(marks, IN_PARAGRAPH).astype(np.int8) for marks in places(part))
        owners, starts = np.unique(owner[part], return_index=True)
        common[owners] += np.add.reduceat(np.minimum(one[:, :, None], other[:, None, :]), starts, axis=0, dtype=np.int16)
    equal = (common >= need) & ok_one[:, :, None] & ok_other[:, None, :]
    alike = np.zeros((n, side, side), dtype=np.int16)
    alike[:, 1:, 1:] = equal
    np.cumsum(alike, axis=1, out=alike)
    np.cumsum(alike, axis=2, out=alike)
    alike = alike.ravel()
    inside = alike[corners[0]] - alike[corners[1]] - alike[corners[2]] + alike[corners[3]] > 0
    shared = [np.zeros(found.shape, dtype=bool) for _ in range(2)]
    shared[0][pair[inside], x[inside]] = shared[1][pair[inside], y[inside]] = True
    for part in parts:
        marks = places(part)
        for k, axis in ((0, 2), (1, 1)):
            across = moving_sum(marks[1 - k], IN_PARAGRAPH) > 0
            met = (equal[owner[part]] & (across[:, None, :] if axis == 2 else across[:, :, None])).any(axis=axis)
            at, place = np.nonzero(marks[k] & (inside_some(met, 1) > 0))
            shared[k][owner[part][at], place] = True
    out = []
    for places_shared in shared:
        some = places_shared.any(axis=1)
        out += [np.where(some, end, none) for end, none in zip(ends_of(places_shared), (10**6, -1), strict=True)]
    return tuple(out)


def pairs_alike(
    one: np.ndarray,
    other: np.ndarray,
    similarity: float,
    held: tuple[np.ndarray, ...] | None = None,
    places: tuple[np.ndarray, np.ndarray] | None = None,
) -> tuple[np.ndarray, ...]:
    """Start and end (exclusive) in words of what each row of shingles shares with its pair in alike paragraphs.

    For ``one``, then for ``other``; end -1 if none. Every paragraph of the one is compared with every one of the
    other, by the Jaccard similarity of their shingles, repeats included, wherever in the paragraph they stand.
    ``held`` are starts and ends known of the rows, where the pair is linked already: pairs that cannot widen
    these are left out (end -1). ``places`` is :func:`shared_places` of the rows, if the caller has it.
    """
    n, need = len(one), least_common(similarity)
    out = [np.full(n, 10**6), np.full(n, -1), np.full(n, 10**6), np.full(n, -1)]
    spots, firsts = shared_places(one, other) if places is None else places
    (some,) = np.nonzero((spots >= 0).sum(axis=1) >= need)
    for at in range(0, len(some), STEP_PAIRS):
        left = some[at : at + STEP_PAIRS]
        found, first = spots[left], np.broadcast_to(firsts, one.shape)[left]
        in_a, in_b = np.zeros(found.shape, dtype=bool), found >= 0
        pair, y = np.nonzero(in_b)
        in_a[pair, found[pair, y]] = True
        in_a = np.take_along_axis(in_a, np.maximum(first, 0).astype(np.int64), axis=1) & (first >= 0)

        def inside_held(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Pairs that share nothing outside of what is known."""
            if held is None:
                return np.zeros(len(left), dtype=bool)
            ends = (*ends_of(a), *ends_of(b))
            known = [h[left] for h in held]  # noqa: B023
            return (ends[0] >= known[0]) & (ends[1] <= known[1]) & (ends[2] >= known[2]) & (ends[3] <= known[3])

        out_of = ~inside_held(in_a, in_b)
        left, found, first, in_a, in_b = (v[out_of] for v in (left, found, first, in_a, in_b))
        ok_a, ok_b = (moving_sum(shared, IN_PARAGRAPH) >= need for shared in (in_a, in_b))
        good = ok_a.any(axis=1) & ok_b.any(axis=1)
        left, found, first, in_a, in_b, ok_a, ok_b = (v[good] for v in (left, found, first, in_a, in_b, ok_a, ok_b))
        ok_a &= whole(one[left])
        ok_b &= whole(other[left])
        in_a &= inside_some(ok_a, 1) > 0
        in_b &= inside_some(ok_b, 1) > 0
        good = ok_a.any(axis=1) & ok_b.any(axis=1) & ~inside_held(in_a, in_b)
        left, found, first, in_a, in_b, ok_a, ok_b = (v[good] for v in (left, found, first, in_a, in_b, ok_a, ok_b))
        # nothing outside these bounds can be shared; where texts laid over each other reach them, that is all
        a, b = one[left], other[left]
        same = (a == b) & (a > ALONE)
        straight = ok_a & ok_b & (moving_sum(same, IN_PARAGRAPH) >= need)
        same &= inside_some(straight, 1) > 0
        reached, settled = ends_of(same), straight.any(axis=1)
        for shared in (in_a, in_b):
            bounds = ends_of(shared)
            settled &= (bounds[0] == reached[0]) & (bounds[1] == reached[1])
        for k, value in enumerate(reached * 2):
            out[k][left[settled]] = value[settled]
        (kept,) = np.nonzero(~settled)
        if len(kept):
            spans = spans_on_grid(found[kept], first[kept], ok_a[kept], ok_b[kept], need)
            for o, value in zip(out, spans, strict=True):
                o[left[kept]] = value
    return tuple(out)


def paragraphs_alike(rows: np.ndarray, other: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """:func:`pairs_alike` of surroundings: what each row shares with ``other``, a row or one for each."""
    own, others = shingle_rows(rows), shingle_rows(np.atleast_2d(other))
    return pairs_alike(own, np.broadcast_to(others, own.shape), similarity)[:2]


def reduced(groups: np.ndarray, docs: np.ndarray, shingles: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Which rows can have a partner in their group, and their shingles with those that cannot count marked ALONE.

    A shingle counts if another document of the group has it too and if it stands in a paragraph with enough of
    such shingles. What is left out of a row lowers those of others, so this goes on until nothing changes.
    No pair's common shingles in alike paragraphs are touched.
    """
    need, left = least_common(similarity), np.arange(len(groups))
    values, seed = shingles.copy(), groups.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    inside, done = whole(values), []
    while len(left):
        counts = values > ALONE
        with np.errstate(over="ignore"):
            keys = ((values ^ seed[left][:, None]) * np.uint64(0x9E3779B97F4A7C15))[counts]
        owner = np.repeat(docs[left], counts.sum(axis=1))
        order = np.argsort(keys)
        ranked, owner = keys[order], owner[order]
        edges = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if len(ranked) else np.zeros(0, dtype=np.int64)
        shared = np.zeros(len(ranked), dtype=bool)
        if len(edges):
            foreign = np.minimum.reduceat(owner, edges) != np.maximum.reduceat(owner, edges)
            shared[order] = np.repeat(foreign, np.diff(np.append(edges, len(ranked))))
        good = np.zeros_like(counts)
        good[counts] = shared
        paragraphs = inside & (moving_sum(good, IN_PARAGRAPH) >= need)
        good &= inside_some(paragraphs, 1) > 0
        values[counts & ~good] = ALONE
        some = paragraphs.any(axis=1)
        # groups in which nothing has changed stay as they are
        changed = np.zeros(int(groups.max()) + 1, dtype=bool)
        changed[groups[left[(good != counts).any(axis=1) | ~some]]] = True
        settled = ~changed[groups[left]]
        done.append((left[settled], values[settled]))
        some &= ~settled
        left, values, inside = left[some], values[some], inside[some]
    if not done:
        return left, values
    left, values = (np.concatenate(parts) for parts in zip(*done, strict=True))
    order = np.argsort(left)
    return left[order], values[order]


class Clusters:
    """Occurrences of shingles, joined where a paragraph around them is alike."""

    def __init__(self, docs: np.ndarray, similarity: float) -> None:
        self.docs, self.similarity = docs, similarity
        self.parent, self.first, self.last = np.arange(len(docs)), np.full(len(docs), 10**6), np.full(len(docs), -1)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = int(self.parent[i])
        return i


class Kinds:
    """Occurrences of equal reduced shingles as one: all pairs of kinds that can still change a result are compared.

    Members of a kind with two documents are partners of each other over all that counts in them, so only
    kinds of one document can still widen.
    """

    def __init__(self, clusters: Clusters, groups: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
        self.clusters, self.at, self.values = clusters, at, values
        odd = np.random.default_rng(7).integers(0, 2**63, size=values.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        with np.errstate(over="ignore"):
            mixed = (values ^ (values >> np.uint64(32))) * odd
            keys = (mixed ^ (mixed >> np.uint64(29))).sum(axis=1, dtype=np.uint64) + groups[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        _, once, self.of = np.unique(keys, return_index=True, return_inverse=True)
        order = np.argsort(self.of, kind="stable")
        edges = np.searchsorted(self.of[order], np.arange(len(once)))
        own = clusters.docs[at][order]
        low, high = (f.reduceat(own, edges) if len(once) else own for f in (np.minimum, np.maximum))
        # kinds of a group side by side
        rank = np.lexsort((once, groups[at][once]))
        place = np.empty_like(rank)
        place[rank] = np.arange(len(rank))
        self.of, self.once, self.low, self.many = place[self.of], once[rank], low[rank], (low != high)[rank]
        self.rows, self.group = values[self.once], groups[at][self.once]
        self.sizes = np.bincount(self.of, minlength=len(rank))
        counts = self.rows > ALONE
        self.low_end, self.high_end = counts.argmax(axis=1), counts.shape[1] - 1 - counts[:, ::-1].argmax(axis=1) + SHINGLE
        self.first = np.where(self.many, self.low_end, 10**6)
        self.last = np.where(self.many, self.high_end, -1)
        self.label = np.arange(len(rank))

    def join(self, one: np.ndarray, other: np.ndarray, spots: np.ndarray, firsts: np.ndarray) -> None:
        """Compare pairs of kinds and join the alike ones; the last two are their :func:`shared_places`."""
        linked = self.label[one] == self.label[other]
        held = []
        for k in (one, other):  # unlinked pairs hold nothing
            held += [np.where(linked, self.first[k], 10**6), np.where(linked, self.last[k], -1)]
        spans = pairs_alike(self.rows[one], self.rows[other], self.clusters.similarity, tuple(held), (spots, firsts))
        hit = spans[1] >= 0
        for k, start, end in ((one, *spans[:2]), (other, *spans[2:])):
            np.minimum.at(self.first, k[hit], start[hit])
            np.maximum.at(self.last, k[hit], end[hit])
        new = hit & ~linked
        for a, b in zip(one[new].tolist(), other[new].tolist(), strict=True):
            p, q = sorted((int(self.label[a]), int(self.label[b])))
            if p != q:
                low, high = self.edges[self.number[a]], self.edges[self.number[a] + 1]
                part = self.label[low:high]
                part[part == q] = p

    def wide(self, some) -> np.ndarray:
        return (self.first[some] <= self.low_end[some]) & (self.last[some] >= self.high_end[some])

    def open(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Which pairs can still change a result; two kinds of the same only document are no pair."""
        foreign = self.many[one] | self.many[other] | (self.low[one] != self.low[other])
        return foreign & ((self.label[one] != self.label[other]) | ~self.wide(one) | ~self.wide(other))

    def compare(self) -> None:
        """All pairs of the kinds of each group but those that share too little or can change nothing.

        First all with the kind of most occurrences, then round by round those of one more kind of each group. A
        partner has enough of a paragraph's shingles that it lacks fewer than ``spare`` of them, so it has one of any
        ``spare``, also of the rarest: only kinds with one of these are looked at.
        """
        if not len(self.group):
            return
        self.edges = np.flatnonzero(np.concatenate(([True], self.group[1:] != self.group[:-1], [True])))
        sizes = np.diff(self.edges)
        self.number = np.repeat(np.arange(len(sizes)), sizes)
        # numbers of shingles, different ones in every group
        counts = self.rows > ALONE
        numbers = np.full(self.rows.shape, -1)
        with np.errstate(over="ignore"):
            seeded = ((self.rows ^ (self.number.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))[:, None]) * np.uint64(0x9E3779B97F4A7C15))[counts]
        _, numbers[counts], times = np.unique(seeded, return_inverse=True, return_counts=True)
        owners = np.nonzero(counts)[0][np.argsort(numbers[counts], kind="stable")]
        starts = np.concatenate(([0], np.cumsum(times)))
        rarity = np.where(counts, np.append(times, 0)[numbers], 0)
        place_of = np.full(len(times) + 1, -1, dtype=np.int16)  # the last one stands for no shingle
        spare = IN_PARAGRAPH - least_common(self.clusters.similarity) + 1

        def join_all(ones: np.ndarray, one: np.ndarray, other: np.ndarray) -> None:
            """Pairs of ``ones``, one kind of each group, sorted; few of a kind first, as they may settle the others."""
            row, at = np.nonzero(counts[ones])
            own = numbers[ones[row], at]
            place_of[own[::-1]] = at[::-1]  # of a shingle that repeats, its first place
            rank = np.arange(len(one)) - np.searchsorted(one, one)
            low, step = 0, STEP_LINKED
            while (rank >= low).any():
                (some,) = np.nonzero((rank >= low) & (rank < low + step))
                for at in range(0, len(some), STEP_PAIRS):
                    part = some[at : at + STEP_PAIRS]
                    part = part[self.open(one[part], other[part])]
                    if len(part):
                        self.join(one[part], other[part], place_of[numbers[other[part]]], place_of[numbers[one[part]]])
                low, step = low + step, 4 * step
            place_of[own] = -1

        rank = np.lexsort((np.arange(len(self.group)), -self.sizes, self.number))
        leaders = rank[self.edges[:-1]]
        leader = leaders[self.number]
        others = np.flatnonzero(leader != np.arange(len(leader)))
        join_all(leaders, leader[others], others)
        place = np.arange(len(self.number)) - self.edges[self.number]
        for turn in range(int(sizes.max()) - 1):
            ones = self.edges[:-1][sizes > turn + 1] + turn
            ones = ones[ones != leaders[self.number[ones]]]
            for at in range(0, len(ones), STEP_PAIRS):
                some = ones[at : at + STEP_PAIRS]
                windows = np.lib.stride_tricks.sliding_window_view(rarity[some], IN_PARAGRAPH, axis=1)
                rarest = np.argpartition(windows, spare - 1, axis=2)[:, :, :spare] + np.arange(windows.shape[1])[None, :, None]
                row, usable = np.nonzero(moving_sum(counts[some], IN_PARAGRAPH) >= IN_PARAGRAPH - spare + 1)
                marks = np.zeros((len(some), counts.shape[1]), dtype=bool)
                marks[np.repeat(row, spare), rarest[row, usable].ravel()] = True
                row, spot = np.nonzero(marks & counts[some])
                keys = np.unique(numbers[some[row], spot])
                length = times[keys]
                first = np.repeat(starts[keys] - np.concatenate(([0], np.cumsum(length)[:-1])), length)
                other = np.unique(owners[first + np.arange(int(length.sum()))])
                # a pair is looked at from the first of the two
                other = other[(place[other] > turn) & (leader[other] != other)]
                one = self.edges[self.number[other]] + turn
                left = self.open(one, other)
                join_all(some, one[left], other[left])

    def finish(self) -> None:
        """Give the kinds' results to their members."""
        found = self.last[self.of] >= 0
        at, of = self.at[found], self.of[found]
        self.clusters.first[at], self.clusters.last[at] = self.first[of], self.last[of]
        least = np.full(len(self.label), len(self.clusters.docs))
        np.minimum.at(least, self.label[of], at)
        self.clusters.parent[at] = least[self.label[of]]


def compared(groups: np.ndarray, docs: np.ndarray, rows: np.ndarray, similarity: float) -> Clusters:
    """Clusters of the occurrences of shingles; ``groups`` holds the shingle's number, equal ones side by side."""
    clusters = Clusters(docs, similarity)
    at, values = reduced(groups, docs, shingle_rows(rows), similarity)
    if len(at):
        kinds = Kinds(clusters, groups, at, values)
        kinds.compare()
        kinds.finish()
    return clusters


def verified(occurrences: DataFrame, similarity: float, rows: int) -> DataFrame:
    """``key, doc, place, first, last, leader_doc, leader_place, part`` of occurrences; those of a (key, part) are compared."""
    import pyarrow as pa

    names = ["key", "doc", "place", "around"]

    def run(batches):
        held: dict[str, list] = {n: [] for n in ("key", "part", "doc", "place", "around")}

        def done(upto: int) -> dict:
            key, part, doc = (np.array(held[n][:upto], dtype=np.int64) for n in ("key", "part", "doc"))
            out = {n: [] for n in ("key", "doc", "place", "first", "last", "leader_doc", "leader_place", "part")}
            if upto:
                changes = np.concatenate(([0], np.cumsum((key[1:] != key[:-1]) | (part[1:] != part[:-1]))))
                rows = np.frombuffer(b"".join(held["around"][:upto]), dtype="<u2").reshape(upto, -1)
                clusters = compared(changes, doc, rows, similarity)
                for i in np.flatnonzero(clusters.last >= 0).tolist():
                    leader, place = clusters.root(i), held["place"][i] - BEFORE
                    out["key"].append(int(key[i]))
                    out["doc"].append(int(doc[i]))
                    out["place"].append(held["place"][i])
                    out["first"].append(place + int(clusters.first[i]))
                    out["last"].append(place + int(clusters.last[i]))
                    out["leader_doc"].append(int(doc[leader]))
                    out["leader_place"].append(held["place"][leader])
                    out["part"].append(int(part[i]))
            for n in held:
                del held[n][:upto]
            return out

        for batch in batches:
            for n, column in zip(held, batch.columns, strict=True):
                held[n] += column.to_pylist()
            n = len(held["key"])
            if n > TASK_ROWS:
                tail = n - 1
                while tail and held["key"][tail - 1] == held["key"][n - 1] and held["part"][tail - 1] == held["part"][n - 1]:
                    tail -= 1
                if tail:
                    yield done(tail)
        yield done(len(held["key"]))

    schema = "key long, doc long, place int, first int, last int, leader_doc long, leader_place int, part long"
    fields = pa.schema(
        [("key", pa.int64()), ("doc", pa.int64()), ("place", pa.int32()), ("first", pa.int32()), ("last", pa.int32()),
         ("leader_doc", pa.int64()), ("leader_place", pa.int32()), ("part", pa.int64())]
    )

    def task(batches):
        for out in run(batches):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in fields], schema=fields)

    # so many parts that no task has much more than TASK_ROWS rows but for one group; its work is not that of its bytes
    parts = max(int(occurrences.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))
    dealt = occurrences.select("key", "part", *names[1:]).repartition(parts, "key", "part")
    dealt = dealt.sortWithinPartitions("key", "part", "doc", "place")
    return dealt.mapInArrow(task, schema)


def cluster_id():
    return F.xxhash64("key", "part", "leader_doc", "leader_place")


def hot_kinds(rows: DataFrame, similarity: float) -> DataFrame:
    """``key, doc, place, around, kind`` of the occurrences that can have a partner, equal kinds with the same number.

    The first step of :func:`reduced` as shuffles by (key, shingle): no task holds the occurrences of a key.
    """
    need = least_common(similarity)

    def make():
        def listed(keys, docs, places, arounds):
            shingles = shingle_rows(np.frombuffer(b"".join(arounds), dtype="<u2").reshape(len(keys), -1))
            row, at = np.nonzero(shingles > ALONE)
            take = lambda column: np.array(column, dtype=np.int64)[row]
            return {"key": take(keys), "doc": take(docs), "place": take(places).astype(np.int32), "at": at.astype(np.int32), "shingle": shingles[row, at].view(np.int64)}

        return listed

    def make_kinds():
        def kinds(keys, docs, places, arounds, spots):
            out = {n: [] for n in ("key", "doc", "place", "around", "kind")}
            shingles = shingle_rows(np.frombuffer(b"".join(arounds), dtype="<u2").reshape(len(keys), -1))
            good = np.zeros(shingles.shape, dtype=bool)
            for i, some in enumerate(spots):
                good[i, some] = True
            paragraphs = whole(shingles) & (moving_sum(good, IN_PARAGRAPH) >= need)
            good &= inside_some(paragraphs, 1) > 0
            shingles[(shingles > ALONE) & ~good] = ALONE
            for i in np.flatnonzero(paragraphs.any(axis=1)).tolist():
                for name, value in zip(out, (keys[i], docs[i], places[i], arounds[i], xxhash.xxh3_64_intdigest(shingles[i].tobytes()) >> 1), strict=True):
                    out[name].append(value)
            return out

        return kinds

    each = map_slices(rows.select("key", "doc", "place", "around"), make, "key long, doc long, place int, at int, shingle long")
    shared = each.groupBy("key", "shingle").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low <> high").select("key", "shingle")
    spots = each.join(shared, ["key", "shingle"]).groupBy("key", "doc", "place").agg(F.collect_list("at").alias("spots"))
    left = rows.join(spots, ["key", "doc", "place"]).select("key", "doc", "place", "around", "spots")
    return map_slices(left, make_kinds, "key long, doc long, place int, around binary, kind long")


def hot_stretches(rows: DataFrame, similarity: float, group_limit: int) -> tuple[DataFrame, DataFrame]:
    """Like :func:`stretches` for the occurrences of shingles that no task should hold all of.

    Of each kind only the occurrences with the least and the largest document are compared, which stand for
    the others. Where these are more than ``group_limit`` they are dealt to blocks, and every two blocks meet
    in a task, so each pair does.
    """
    kinds = materialise(hot_kinds(rows, similarity), "hot-kinds")
    one = F.struct("doc", "place", "around")
    ends = kinds.groupBy("key", "kind").agg(F.min(one).alias("low"), F.max(one).alias("high"))
    some = ends.select("key", "kind", F.explode(F.array_distinct(F.array("low", "high"))).alias("r")).select("key", "kind", "r.*")
    some = materialise(some, "hot-ends")
    blocks = some.groupBy("key").agg(F.count(F.lit(1)).alias("n")).select(
        "key", F.when(F.col("n") <= group_limit, 1).otherwise(F.ceil(F.col("n") * 2 / group_limit)).cast("long").alias("blocks")
    )
    own = F.pmod(F.xxhash64("doc", "place"), F.col("blocks"))
    met = F.filter(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda b: (b != F.col("block")) | (F.col("blocks") == 1))
    parts = F.transform(met, lambda b: F.least(b, F.col("block")) * F.col("blocks") + F.greatest(b, F.col("block")))
    dealt = some.join(blocks, "key").withColumn("block", own).withColumn("part", F.explode(parts))
    dealt = materialise(dealt, "hot-dealt")
    found = verified(dealt, similarity, dealt.count()).join(some.select("key", "doc", "place", "kind"), ["key", "doc", "place"])
    found = found.select("key", "kind", (F.col("first") - F.col("place")).alias("low"), (F.col("last") - F.col("place")).alias("high"), cluster_id().alias("cluster"))
    found = materialise(found, "hot-found")
    widest = found.groupBy("key", "kind").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min("cluster").alias("cluster"))
    stretched = kinds.select("key", "kind", "doc", "place").join(widest, ["key", "kind"])
    links = found.select("key", "kind", F.col("cluster").alias("a")).join(widest.select("key", "kind", F.col("cluster").alias("b")), ["key", "kind"])
    return (
        stretched.select("doc", (F.col("place") + F.col("low")).alias("first"), (F.col("place") + F.col("high")).alias("last"), "cluster"),
        links.where("a <> b").select("a", "b").distinct(),
    )


def stretches(sketched: DataFrame, firsts: DataFrame, similarity: float, group_limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Verified stretches (``doc, first, last, cluster``) of the documents in ``firsts``, and links between clusters, if any."""
    keys = sketched.select("doc", F.explode(F.arrays_zip("keys", "places")).alias("k")).select(
        F.col("k.keys").alias("key"), "doc", F.col("k.places").alias("place")
    )
    shared = materialise(
        keys.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count(F.lit(1)).alias("size"))
        .where("low <> high").select("key", "size"),
        "shared",
    )
    at = keys.join(shared, "key").groupBy("doc").agg(F.collect_list(F.struct("key", "place", "size")).alias("spots"))

    def make():
        def cut(docs, spots, words):
            out = {n: [] for n in ("key", "size", "doc", "place", "around")}
            for doc, some, binary in zip(docs, spots, words, strict=True):
                own = np.frombuffer(binary, dtype="<u2")
                for s in some:
                    out["key"].append(s["key"])
                    out["size"].append(s["size"])
                    out["doc"].append(doc)
                    out["place"].append(s["place"])
                    out["around"].append(around(own, s["place"]))
            return out

        return cut

    joined = at.join(firsts.select("doc"), "doc", "left_semi").join(sketched.select("doc", "words"), "doc").select("doc", "spots", "words")
    rows = map_slices(joined, make, "key long, size long, doc long, place int, around binary")
    hot = F.col("size") >= group_limit
    total = shared.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    found = materialise(verified(rows.where(~hot).withColumn("part", F.lit(0).cast("long")), similarity, total), "stretches")
    own = found.select("doc", "first", "last", cluster_id().alias("cluster"))
    if shared.where(hot).isEmpty():
        return own, None
    hot_own, links = hot_stretches(materialise(rows.where(hot), "hot-rows"), similarity, group_limit)
    return own.unionByName(hot_own), links


def merged(own: DataFrame) -> DataFrame:
    """``doc, first, last, clusters``: overlapping stretches of a document as one passage."""

    def make():
        def merge(docs, lists):
            out = {n: [] for n in ("doc", "first", "last", "clusters")}
            for doc, some in zip(docs, lists, strict=True):
                passages: list[list] = []
                for s in sorted((x["first"], x["last"], x["cluster"]) for x in some):
                    if passages and s[0] < passages[-1][1]:
                        passages[-1][1] = max(passages[-1][1], s[1])
                        passages[-1][2].add(s[2])
                    else:
                        passages.append([s[0], s[1], {s[2]}])
                for a, b, clusters in passages:
                    out["doc"].append(doc)
                    out["first"].append(a)
                    out["last"].append(b)
                    out["clusters"].append(sorted(clusters))
            return out

        return merge

    lists = own.groupBy("doc").agg(F.collect_set(F.struct("first", "last", "cluster")).alias("stretches"))
    return map_slices(lists, make, "doc long, first int, last int, clusters array<long>")


def repeated_passages(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """One row per passage of a document that other documents have too.

    Columns: ``doc_id, start_word, end_word`` (words between ASCII white space, end exclusive),
    ``component_id`` (the smallest ``doc_id`` with the passage or one linked to it), ``kept`` (true in that
    document). Documents without such passages have no row. ``docs`` needs ``doc_id`` and ``text``;
    other columns are ignored. Null texts and texts of fewer than WORDS words have no passages. Words are
    compared after lower-casing A-Z. Rows that repeat an id are one document and do not repeat each other's
    passages; null ids are one such document. An empty table gives an empty result.
    """
    sketched = materialise(sketches(docs, bands), "sketches")
    sizes = sketched.groupBy("text_key", "n_words").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
    sizes = materialise(sizes, "texts")
    own, links = stretches(sketched, sizes.select(F.col("first_doc").alias("doc")).distinct(), similarity, group_limit)
    copied = sizes.where("first_doc <> last_doc").select(
        F.col("first_doc").alias("doc"), F.lit(0).alias("first"), F.col("n_words").alias("last"), F.xxhash64("text_key", "n_words").alias("cluster")
    )
    passages = materialise(merged(own.unionByName(copied)), "passages")
    inside = passages.select(F.explode("clusters").alias("a"), F.array_min("clusters").alias("b"))
    inside = inside.where("a <> b")
    roots = components(inside if links is None else inside.unionByName(links))
    rooted = (
        passages.withColumn("node", F.array_min("clusters"))
        .join(roots, "node", "left")
        .select("doc", "first", "last", F.coalesce("root", "node").alias("root"))
    )
    # copies have the passages of the first of them
    members = sketched.select(F.col("doc").alias("member"), "text_key", "n_words").join(sizes, ["text_key", "n_words"])
    spread = rooted.join(members.withColumnRenamed("first_doc", "doc"), "doc").select("member", "first", "last", "root").distinct()
    spread = materialise(spread, "spread")
    least = spread.groupBy("root").agg(F.min("member").alias("component"))
    return spread.join(least, "root").select(
        F.nullif("member", F.lit(NO_ID)).alias("doc_id"),
        F.col("first").alias("start_word"),
        F.col("last").alias("end_word"),
        F.nullif("component", F.lit(NO_ID)).alias("component_id"),
        (F.col("member") == F.col("component")).alias("kept"),
    )
