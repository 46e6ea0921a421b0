"""Best-fit packing of token sequences with swap-based local search.

Texts become token ids; documents longer than a sequence are cut. Pieces are packed in groups of
bounded size (best fit, longest first), and a local search empties bins: it moves a piece, or
exchanges one for one and two for one between underfull bins, whenever that raises the sum of
squared fills. What stands in bins that stay underfull is pooled over the groups and packed
again, until one group is left or nothing is gained.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import map_slices
from tidecast.sources.storage import materialise

CAPACITY = 4096
VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Pieces of a group: bounds the memory of a packing task, and its time, which may grow with their square.
GROUP_PIECES = 5_000
#: A bin with more free tokens than this goes to the next round.
SLACK = 16
ROUNDS = 4
#: Words whose ids a task remembers; exchanges that the local search weighs in one array.
CACHE_WORDS, EXCHANGES_AT_ONCE = 500_000, 2_000_000
TAIL = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def visible_bytes() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in shown}
    table |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in table)}
    return [table[b] for b in range(256)]


VISIBLE = visible_bytes()


def latin_letters(word: bytes) -> str | None:
    """A word of Latin letters only as its byte-level characters, lower-cased; None for other words."""
    text = word.decode("utf-8", "replace")
    if not text.isalpha() or max(text) > "\u017e" or not unicodedata.is_normalized("NFC", text):
        return None
    lowered = "".join(c.lower() for c in text)
    return "".join(VISIBLE[b] for b in lowered.encode()) if lowered.isalpha() else None


class WordIds:
    """Token ids of whole texts, word by word.

    The tokenizer lower-cases, splits at white space and never joins tokens over it, nor over the
    border of a letter and a punctuation mark; so a text's ids are those of its words, and words
    that come again are looked up. Texts with the vocabulary's special strings are encoded whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[bytes, bytes] = {}

    def packed(self, words: list[bytes]) -> list[bytes]:
        """Ids of words: those of Latin letters go straight to the merges, others the whole way."""
        direct = self.tokenizer.model.tokenize
        out: list[bytes | None] = []
        others = []
        for w in words:
            if w.isalpha():
                out.append(array("I", [t.id for t in direct(w.decode())]).tobytes())
            elif (latin := latin_letters(w)) is not None:
                out.append(array("I", [t.id for t in direct(latin)]).tobytes())
            else:
                others.append(len(out))
                out.append(None)
        texts = [words[i].decode("utf-8", "replace") for i in others]
        for i, e in zip(others, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            out[i] = array("I", e.ids).tobytes()
        return out

    def learn(self, words: set[bytes]) -> None:
        new = words.difference(self.known)
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known.clear()
            new = words
        parts, missing = {}, set()
        for w in new:
            stem = w.rstrip(TAIL)
            if stem and len(stem) < len(w) and (48 <= stem[-1] <= 57 or 97 <= stem[-1] <= 122):
                parts[w] = (stem, w[len(stem) :])
                missing.update(parts[w])
            else:
                missing.add(w)
        missing = list(missing.difference(self.known))
        self.known.update(zip(missing, self.packed(missing), strict=True))
        for w, (stem, tail) in parts.items():
            self.known[w] = self.known[stem] + self.known[tail]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; null is empty."""
        out: list[bytes] = []
        split = [None if t and any(s in t for s in self.special) else (t or "").encode().lower().split() for t in texts]
        self.learn({w for words in split if words for w in words})
        for text, words in zip(texts, split, strict=True):
            if words is None:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                out.append(np.array(ids, dtype="<u4").tobytes())
            else:
                out.append(b"".join(map(self.known.__getitem__, words)))
        return out


def pieces_of(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """Cut documents in pieces: all of ``capacity`` tokens, the last may be shorter."""

    def make():
        words, end = WordIds(path), np.array([end_id], dtype="<u4").tobytes()

        def cut(rows, ids, texts):
            out = {k: [] for k in ("row", "doc_id", "piece", "start", "length", "ids_crc32")}
            for row, doc_id, encoded in zip(rows, ids, words.encode(texts), strict=True):
                encoded += end
                for k, at in enumerate(range(0, len(encoded), 4 * capacity)):
                    piece = encoded[at : at + 4 * capacity]
                    out["row"].append(row)
                    out["doc_id"].append(doc_id)
                    out["piece"].append(k)
                    out["start"].append(at // 4)
                    out["length"].append(len(piece) // 4)
                    out["ids_crc32"].append(zlib.crc32(piece))
            return out

        return cut

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string")
    )
    return map_slices(rows, make, PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Longest first, each into the fullest bin that takes it; bins as lists of positions."""
    bins: list[list[int]] = []
    by_free: dict[int, list[int]] = {}
    present = 0  # bit f is set if a bin has f free tokens
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        fits = present >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            at = by_free[free].pop()
            if not by_free[free]:
                present ^= 1 << free
            bins[at].append(i)
            free -= n
        else:
            at, free = len(bins), capacity - n
            bins.append([i])
        by_free.setdefault(free, []).append(at)
        present |= 1 << free
    return bins


def combined(members: list[int], lengths: list[int]) -> tuple[np.ndarray, np.ndarray, list[tuple[int, ...]]]:
    """Sizes, numbers of pieces and pieces of all choices of one or two from a bin, one for each pair of lengths.

    Pieces of a length can stand for each other; a bin has few lengths, as k different ones take k (k + 1) / 2 tokens.
    """
    by_length: dict[int, list[int]] = {}
    for i in members:
        by_length.setdefault(lengths[i], []).append(i)
    kinds = sorted(by_length)
    sets: list[tuple[int, ...]] = [(by_length[n][0],) for n in kinds]
    for k, n in enumerate(kinds):
        if len(by_length[n]) > 1:
            sets.append(tuple(by_length[n][:2]))
        sets += [(by_length[n][0], by_length[m][0]) for m in kinds[k + 1 :]]
    return np.array([sum(lengths[i] for i in s) for s in sets], dtype=np.int64), np.array([len(s) for s in sets]), sets


class Bins:
    """Local search over bins: a source gives tokens to another underfull bin if the squared fills rise.

    Kinds of exchange: a piece moves over, one goes for one, two for one, one for two. If d tokens move from the
    source to a target, the sum of squared fills rises by 2 d (target - source) + 2 d^2.
    """

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int) -> None:
        self.bins, self.lengths, self.capacity = [list(b) for b in bins], lengths, capacity
        self.loads = np.array([sum(lengths[i] for i in b) for b in bins], dtype=np.int64)
        #: step of a bin's last change, and of the last search with it as the source
        self.changed, self.searched = np.zeros(len(bins), dtype=np.int64), np.full(len(bins), -1, dtype=np.int64)
        self.choices: dict[int, tuple[np.ndarray, np.ndarray, list[tuple[int, ...]]]] = {}
        self.step = 0

    def choices_of(self, k: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, ...]]]:
        if k not in self.choices:
            self.choices[k] = combined(self.bins[k], self.lengths)
        return self.choices[k]

    def best_exchange(self, source: int, targets: list[int]) -> tuple[int, tuple[int, ...], tuple[int, ...]] | None:
        """The exchange with the largest gain over all targets: (target, out of source, out of target)."""
        out_sizes, out_numbers, out_sets = self.choices_of(source)
        best, answer, at = 0, None, 0
        while at < len(targets):
            part, width = [], 0
            while at < len(targets) and width * len(out_sizes) < EXCHANGES_AT_ONCE:
                part.append(targets[at])
                width += 1 + len(self.choices_of(targets[at])[0])
                at += 1
            spans = np.cumsum([0, *[1 + len(self.choices[t][0]) for t in part]])
            back_sizes = np.concatenate([x for t in part for x in ((0,), self.choices[t][0])])
            back_numbers = np.concatenate([x for t in part for x in ((0,), self.choices[t][1])])
            loads = np.repeat(self.loads[part], np.diff(spans))
            moved = out_sizes[:, None] - back_sizes[None, :]
            gain = 2 * moved * (loads[None, :] - self.loads[source]) + 2 * moved * moved
            barred = (moved <= 0) | (moved > (self.capacity - loads)[None, :])
            barred |= (out_numbers[:, None] == 2) & (back_numbers[None, :] == 2)
            gain[barred] = 0
            place = int(gain.argmax())
            if gain.flat[place] > best:
                best = int(gain.flat[place])
                row, column = divmod(place, len(back_sizes))
                k = int(np.searchsorted(spans, column, side="right")) - 1
                inside = column - spans[k] - 1
                answer = part[k], out_sets[row], () if inside < 0 else self.choices[part[k]][2][inside]
        return answer

    def exchange(self, source: int, target: int, out: tuple[int, ...], back: tuple[int, ...]) -> None:
        moved = sum(self.lengths[i] for i in out) - sum(self.lengths[i] for i in back)
        self.bins[source] = [i for i in self.bins[source] if i not in out] + list(back)
        self.bins[target] = [i for i in self.bins[target] if i not in back] + list(out)
        self.loads[source] -= moved
        self.loads[target] += moved
        self.step += 1
        for k in (source, target):
            self.changed[k], self.searched[k] = self.step, -1
            self.choices.pop(k, None)

    def run(self) -> list[list[int]]:
        """Exchange until no bins fewer are possible or no exchange of any two bins gains.

        The emptiest bin that has something new to look at is the next source: itself if it has changed, else
        the bins that have changed since it was searched.
        """
        least = -(-int(self.loads.sum()) // self.capacity)
        while int((self.loads > 0).sum()) > least:
            open_ = np.flatnonzero((self.loads > 0) & (self.loads < self.capacity))
            newest = int(self.changed[open_].max()) if len(open_) else -1
            waiting = open_[self.searched[open_] < newest]
            if not len(waiting):
                break
            source = int(waiting[np.lexsort((waiting, self.loads[waiting]))[0]])
            targets = open_[(open_ != source) & (self.changed[open_] > self.searched[source])].tolist()
            found = self.best_exchange(source, targets)
            if found is None:
                self.searched[source] = self.step
            else:
                self.exchange(source, *found)
        return [b for b in self.bins if b]


def empty_bins(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Local search from a packing; see :class:`Bins`."""
    return Bins(bins, lengths, capacity).run()


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    return empty_bins(best_fit(lengths, capacity), lengths, capacity)


def packed_groups(pieces: DataFrame, capacity: int, groups: int, round_: int) -> DataFrame:
    """Pack ``pieces`` in ``groups`` groups; adds sequence_id, offset and the free tokens of the sequence."""

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "row", "piece"], ignore_index=True)
        lengths = frame["length"].tolist()
        seq, off, free = (np.zeros(len(frame), dtype="int64") for _ in range(3))
        base = (round_ << 59) + (int(frame["_group"].iloc[0]) << 26)
        for k, members in enumerate(pack(lengths, capacity)):
            at = 0
            for i in members:
                seq[i], off[i] = base + k, at
                at += lengths[i]
            free[members] = capacity - at
        return frame.drop(columns="_group").assign(sequence_id=seq, offset=off, free=free)

    schema = f"{PIECES}, sequence_id long, offset long, free long"
    keyed = pieces.withColumn("_group", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)))
    return keyed.groupBy("_group").applyInPandas(one, schema)


def packed_sequences(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Null text counts as empty and
    is a piece of the end id alone. Rows that repeat an id are documents of their own; a null
    ``doc_id`` stays null. An empty table gives no pieces. ``vocabulary`` is a tokenizer file that
    every executor can open. Only pieces' numbers are shuffled, in groups of about ``group_pieces``
    rows dealt by row number, whatever the ids are.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    pieces = materialise(pieces_of(docs, path, capacity, end_id), "pieces")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    full = F.col("length") == capacity
    whole = pieces.where(full).select(
        "*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    done, left = whole.select(*columns), pieces.where(~full)
    for round_ in range(1, ROUNDS + 1):
        count = left.count()
        if not count:
            break
        groups = -(-count // group_pieces)
        packed = materialise(packed_groups(left, capacity, groups, round_), "packed")
        if groups == 1 or round_ == ROUNDS:
            done = done.unionByName(packed.select(*columns))
            break
        done = done.unionByName(packed.where(F.col("free") <= SLACK).select(*columns))
        left = packed.where(F.col("free") > SLACK).drop("sequence_id", "offset", "free")
    return done
