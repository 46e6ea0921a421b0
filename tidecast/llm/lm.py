"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax.

The probability of a token is that of its class given the two tokens before it, times that of the
token in its class. The MODEL_WORDS most frequent training words fill word classes of CLASS_WORDS
words; every other word belongs to one of TAIL_CLASSES classes by its last letters, where its share
is its smoothed count. Class weights are those of a bias, the previous token, the class of the token
before it (a skip feature) and both together, the last hashed into buckets; word weights in a class
are those of a bias and of the previous token, hashed with the class.

Training gathers the feature counts of all training documents in one pass. Each gradient update
computes the expected feature counts under the weights from this table, one part of it a task, adds
the parts up and moves the weights; what a step exchanges is bounded by the size of the model. Texts
are scored in sparse numpy batches: a context's softmax is computed once for a batch. Words outside
the HEAD_WORDS known in tasks are looked up in the full table of counts by a join.
"""

from __future__ import annotations

import zlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import ascii_words, map_task
from tidecast.sources.storage import materialise

HOLD_OUT_PARTS = 5
CLASS_WORDS, WORD_CLASSES, TAIL_CLASSES = 64, 32, 32
MODEL_WORDS = CLASS_WORDS * WORD_CLASSES  # number 0 is the end of a text
CLASSES = WORD_CLASSES + TAIL_CLASSES
#: Context symbols: model words, tail classes, and the start of a text; a start has a class of its own.
SYMBOLS, START = MODEL_WORDS + TAIL_CLASSES + 1, MODEL_WORDS + TAIL_CLASSES
OLDER = CLASSES + 1
#: Words that tasks hold in memory with their counts; a documented bound of what is broadcast.
HEAD_WORDS = 2**18
#: Buckets that each previous token has for hashed features, of classes and of words in a class.
CLASS_BUCKETS, WORD_BUCKETS = 4, 8
#: Rows of the two weight tables (each row has a weight for every class, or word of a class).
FIXED_ROWS = 1 + SYMBOLS + OLDER
CLASS_ROWS, WORD_ROWS = FIXED_ROWS + SYMBOLS * CLASS_BUCKETS, WORD_CLASSES + SYMBOLS * WORD_BUCKETS
STEPS, RATE, PRIOR = 12, 0.35, 0.5
#: Parts of the table of feature counts, whose size the model bounds; tokens held before they are counted.
PARTS, HELD_TOKENS, HELD_WORDS, STEP_ROWS = 12, 1_500_000, 600_000, 200_000
WORD_KEYS = SYMBOLS * OLDER * CLASSES


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAIL_CLASSES


def class_rows(previous: np.ndarray, older: np.ndarray) -> list[np.ndarray]:
    """Rows of the class weights that a context switches on: bias, previous, skip, both (hashed)."""
    both = previous * CLASS_BUCKETS + (older * 40503 >> 5) % CLASS_BUCKETS
    return [np.zeros_like(previous), 1 + previous, 1 + SYMBOLS + older, FIXED_ROWS + both]


def word_rows(previous: np.ndarray, classes: np.ndarray) -> list[np.ndarray]:
    """Rows of the word weights of a class after a token: the bias, and both (hashed)."""
    return [classes, WORD_CLASSES + previous * WORD_BUCKETS + (classes * 40503 >> 5) % WORD_BUCKETS]


def log_softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
    return logits


class Lexicon:
    """Numbers of tokens: head words by rank, their context symbols, classes and counts."""

    def __init__(self, words: list[bytes], counts: list[int], ends: int) -> None:
        self.rank = {w: k for k, w in enumerate(words)}
        modelled = min(len(words), MODEL_WORDS - 1)
        self.symbols = np.array([1 + k if k < modelled else MODEL_WORDS + tail_class(w) for k, w in enumerate(words)], dtype=np.int64)
        self.log_counts = np.log10(np.array(counts, dtype=float) + 0.5)
        self.words_used, self.ends = modelled + 1, ends

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Ranks (-1 outside the head) and symbols of a text's words and its end, and the words outside."""
        ranks = np.fromiter(map(self.rank.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        symbols = np.zeros(len(words) + 1, dtype=np.int64)
        if len(self.symbols):
            symbols[:-1] = self.symbols[ranks]
        out = [words[i] for i in np.flatnonzero(ranks < 0).tolist()]
        symbols[:-1][ranks < 0] = [MODEL_WORDS + tail_class(w) for w in out]
        return ranks, symbols, out


def classes_of(symbols: np.ndarray) -> np.ndarray:
    """Class of each symbol; the start's is the last one and only a context."""
    return np.where(symbols < MODEL_WORDS, symbols // CLASS_WORDS, symbols - MODEL_WORDS + WORD_CLASSES)


def contexts(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token, previous token and class of the one before it, over texts of symbols."""
    padded = np.concatenate([np.concatenate(([START, START], t)) for t in texts])
    starts = np.cumsum([0, *(len(t) + 2 for t in texts)])[:-1]
    here = np.ones(len(padded), dtype=bool)
    here[starts] = here[starts + 1] = False
    at = np.flatnonzero(here)
    return padded[at], padded[at - 1], classes_of(padded[at - 2])


def word_counts(train: DataFrame) -> DataFrame:
    """``word, n`` over all texts; counted in tasks, then summed."""

    def run(parts):
        from collections import Counter

        counted: Counter = Counter()
        for (texts,) in parts:
            for text in texts:
                counted.update(ascii_words(text))
            if len(counted) > HELD_WORDS:
                yield {"word": list(counted), "n": list(counted.values())}
                counted.clear()
        yield {"word": list(counted), "n": list(counted.values())}

    return map_task(train.select("text"), run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def head_of(counts: DataFrame, most: int) -> tuple[list[bytes], list[int]]:
    """The most frequent words, down to a count that no more than ``most`` words reach; by count, then word.

    The border is found from how many words have each count, so no task ever sorts the words.
    """
    steps = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).limit(most).collect()
    border, taken = None, 0
    for n, words in steps:
        taken += words
        if taken > most:
            break
        border = n
    if border is None:
        return [], []
    rows = counts.where(F.col("n") >= border).select("word", "n").toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    return rows["word"].to_pylist(), rows["n"].to_pylist()


def feature_counts(train: DataFrame, lexicon) -> DataFrame:
    """``k, n``: how often each (context, class) and (previous token, word) occurs in all texts."""

    def run(parts):
        lex, held, tokens = Lexicon(*lexicon.value), [], 0

        def counted():
            token, previous, older = contexts(held)
            classes = classes_of(token)
            word = token < MODEL_WORDS
            keys = np.concatenate(
                ((previous * OLDER + older) * CLASSES + classes, WORD_KEYS + previous[word] * MODEL_WORDS + token[word])
            )
            keys, n = np.unique(keys, return_counts=True)
            return {"k": keys, "n": n}

        for (texts,) in parts:
            for text in texts:
                held.append(lex.encode(ascii_words(text))[1])
                tokens += len(held[-1])
            if tokens >= HELD_TOKENS:
                yield counted()
                held, tokens = [], 0
        if held:
            yield counted()

    return map_task(train.select("text"), run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))


def scatter_rows(table: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """table[rows] += values, with repeated rows added up."""
    if len(rows):
        order = np.argsort(rows, kind="stable")
        rows = rows[order]
        first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        table[rows[first]] += np.add.reduceat(values[order], first, axis=0)


class Weights:
    """The two weight tables and the sums over features that training and scoring take from them."""

    def __init__(self, words_used: int, of_class: np.ndarray | None = None, of_word: np.ndarray | None = None) -> None:
        self.words_used = words_used
        self.of_class = np.zeros((CLASS_ROWS, CLASSES), dtype=np.float32) if of_class is None else of_class
        self.of_word = np.zeros((WORD_ROWS, CLASS_WORDS), dtype=np.float32) if of_word is None else of_word
        unused = np.arange(MODEL_WORDS).reshape(WORD_CLASSES, CLASS_WORDS) >= words_used
        self.unused = unused  # places without a word; a class without any keeps its places

    def plain(self) -> tuple:
        """What a broadcast carries."""
        return self.words_used, self.of_class, self.of_word

    def log_classes(self, previous: np.ndarray, older: np.ndarray) -> np.ndarray:
        return log_softmax(sum(self.of_class[r] for r in class_rows(previous, older)))

    def log_words(self, previous: np.ndarray, classes: np.ndarray) -> np.ndarray:
        logits = sum(self.of_word[r] for r in word_rows(previous, classes))
        logits[self.unused[classes] & ~self.unused[classes].all(axis=1, keepdims=True)] = -1e9
        return log_softmax(logits)


def expected_counts(keys: np.ndarray, n: np.ndarray, weights: Weights, observed: bool, of_class: np.ndarray, of_word: np.ndarray) -> None:
    """Add the expected (or observed) feature counts of some rows of the table to the two sums."""
    is_word = keys >= WORD_KEYS
    for part, width, total in ((~is_word, CLASSES, of_class), (is_word, CLASS_WORDS, of_word)):
        k, c = keys[part], n[part].astype(np.float64)
        if not len(k):
            continue
        if total is of_class:
            context, target = k // CLASSES, k % CLASSES
        else:
            k = k - WORD_KEYS
            word = k % MODEL_WORDS
            context, target = (k // MODEL_WORDS) * WORD_CLASSES + word // CLASS_WORDS, word % CLASS_WORDS
        distinct, owner = np.unique(context, return_inverse=True)
        if total is of_class:
            rows = class_rows(distinct // OLDER, distinct % OLDER)
        else:
            rows = word_rows(distinct // WORD_CLASSES, distinct % WORD_CLASSES)
        if observed:
            values = np.bincount(owner * width + target, weights=c, minlength=len(distinct) * width).reshape(-1, width)
        else:
            logs = (
                weights.log_classes(distinct // OLDER, distinct % OLDER)
                if total is of_class
                else weights.log_words(distinct // WORD_CLASSES, distinct % WORD_CLASSES)
            )
            values = np.exp(logs) * np.bincount(owner, weights=c, minlength=len(distinct))[:, None]
        for r in rows:
            scatter_rows(total, r, values)


def summed(table: DataFrame, weights: Weights, observed: bool) -> tuple[np.ndarray, np.ndarray]:
    """Feature counts over the whole table.

    A part of the table holds all rows of a previous token, so nearly every row of the two sums comes from
    one task; what the driver adds up is about the size of the model, whatever the input.
    """
    shared = table.sparkSession.sparkContext.broadcast(weights.plain())
    fields = pa.schema([("row", pa.int32()), ("sums", pa.binary())])

    def run(batches):
        of_class, of_word = np.zeros((CLASS_ROWS, CLASSES)), np.zeros((WORD_ROWS, CLASS_WORDS))
        current, held, rows = Weights(*shared.value), [], 0

        def flush():
            keys, n = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(2))
            expected_counts(keys, n, current, observed, of_class, of_word)

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= STEP_ROWS:
                flush()
                held, rows = [], 0
        if rows:
            flush()
        sums = np.concatenate((of_class, of_word)).astype(np.float32)
        some = np.flatnonzero(sums.any(axis=1))
        for at in range(0, len(some), 2_000):
            part = some[at : at + 2_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, type=pa.int32()), pa.array([sums[i].tobytes() for i in part], type=pa.binary())], schema=fields
            )

    result = np.zeros((CLASS_ROWS + WORD_ROWS, CLASSES), dtype=np.float64)
    for row, sums in table.select("k", "n").mapInArrow(run, "row int, sums binary").collect():
        result[row] += np.frombuffer(sums, dtype=np.float32)
    shared.unpersist()
    return result[:CLASS_ROWS], result[CLASS_ROWS:]


def trained(table: DataFrame, words_used: int, steps: int = STEPS) -> Weights:
    """Weights after ``steps`` gradient updates over the whole table of feature counts.

    The gradient is observed minus expected count (and a Gaussian prior); each weight's step is scaled
    by the larger of the two counts, which stands for the curvature.
    """
    weights = Weights(words_used)
    observed = summed(table, weights, True)
    # the bias starts at the plain frequencies
    weights.of_class[0] = np.log(observed[0][0] + 0.5) - np.log((observed[0][0] + 0.5).sum())
    bias = observed[1][:WORD_CLASSES] + 0.5
    weights.of_word[:WORD_CLASSES] = np.log(bias) - np.log(bias.sum(axis=1, keepdims=True))
    for _ in range(steps):
        expected = summed(table, weights, False)
        for w, o, e in zip((weights.of_class, weights.of_word), observed, expected, strict=True):
            w += (RATE * (o - e - PRIOR * w) / (np.maximum(o, e) + 1.0)).astype(np.float32)
    return weights


def head_scores(docs: DataFrame, lexicon, shared) -> DataFrame:
    """Of each document: tokens, what is known of them in tasks, and the words left to look up.

    ``base`` sums log10(count + 0.5) over head words; ``model`` sums log10 of class and word
    probabilities, where words outside the model have their log10(count + 0.5) left out (``base``
    of head words is added already). ``outside`` are the other words with their numbers.
    """

    def run(parts):
        from collections import Counter

        lex, (tables, log_mass) = Lexicon(*lexicon.value), shared.value
        weights = Weights(*tables)
        everything = np.arange(SYMBOLS)
        # log probability of every model word after every symbol, class by class
        log_word = np.empty((SYMBOLS, MODEL_WORDS), dtype=np.float32)
        for c in range(WORD_CLASSES):
            log_word[:, c * CLASS_WORDS : (c + 1) * CLASS_WORDS] = weights.log_words(everything, np.full(SYMBOLS, c))
        log_word /= np.log(10)
        held: list[tuple] = []
        tokens = 0

        def scored():
            token, previous, older = contexts([h[2] for h in held])
            pairs, owner = np.unique(previous * OLDER + older, return_inverse=True)
            score = np.empty(len(token))
            classes = classes_of(token)
            # softmax once for each distinct context, a bounded number of contexts at a time
            order = np.argsort(owner, kind="stable")
            edges = np.searchsorted(owner[order], np.arange(0, len(pairs) + STEP_ROWS // 4, STEP_ROWS // 4))
            for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                at, low = order[a:b], k * (STEP_ROWS // 4)
                some = pairs[low : low + STEP_ROWS // 4]
                logs = weights.log_classes(some // OLDER, some % OLDER)
                score[at] = logs[owner[at] - low, classes[at]] / np.log(10)
            word = token < MODEL_WORDS
            score[word] += log_word[previous[word], token[word]]
            score[~word] -= log_mass[token[~word] - MODEL_WORDS]
            ends = np.cumsum([len(h[2]) for h in held])
            sums = np.add.reduceat(score, np.concatenate(([0], ends[:-1])))
            out = {k: [] for k in ("row", "doc_id", "held_out", "n_tokens", "n_head", "base", "model", "words", "times")}
            for (row, key, symbols, ranks, left, held_out), total in zip(held, sums.tolist(), strict=True):
                inside = ranks[ranks >= 0]
                logs = lex.log_counts[inside]
                counted = Counter(left)
                out["row"].append(row)
                out["doc_id"].append(key)
                out["held_out"].append(held_out)
                out["n_tokens"].append(len(symbols))
                out["n_head"].append(len(inside) + (lex.ends > 0))
                out["base"].append(float(logs.sum() + np.log10(lex.ends + 0.5)))
                out["model"].append(total + float(logs[lex.symbols[inside] >= MODEL_WORDS].sum()) if len(inside) else total)
                out["words"].append(list(counted))
                out["times"].append(list(counted.values()))
            return out

        for rows, ids, flags, texts in parts:
            for row, key, flag, text in zip(rows, ids, flags, texts, strict=True):
                ranks, symbols, left = lex.encode(ascii_words(text))
                held.append((row, key, symbols, ranks, left, flag))
                tokens += len(symbols)
            if tokens >= HELD_TOKENS // 4:
                yield scored()
                held, tokens = [], 0
        if held:
            yield scored()

    schema = (
        "row long, doc_id long, held_out boolean, n_tokens long, n_head long, base double, model double, "
        "words array<binary>, times array<int>"
    )
    return map_task(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text"), run, schema)


def scores(docs: DataFrame, parts: int = HOLD_OUT_PARTS, head_words: int = HEAD_WORDS, steps: int = STEPS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Everything is learnt from all rows
    whose id's crc32 is not 1 modulo ``parts``; a null id is neither held out nor learnt from. Null and
    blank texts are one end. Words that training never saw count as half a word: one for the base, one
    for each tail class of the model. Repeated rows give repeated rows (and count so in training). With
    nothing to learn from all counts are zero. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    remainder = F.crc32(F.col("doc_id").cast("long").cast("string")) % parts
    source = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), F.col("text").cast("string")
    )
    train = source.where(remainder != 1)
    counts = materialise(word_counts(train), "word-counts")
    ends = train.count()
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    train_tokens, types = total + ends, distinct + (ends > 0)
    words, numbers = head_of(counts, head_words)
    lexicon = spark.sparkContext.broadcast((words, numbers, ends))
    modelled = words[: MODEL_WORDS - 1]

    is_word = F.col("k") >= WORD_KEYS
    previous = F.when(is_word, F.expr(f"(k - {WORD_KEYS}) div {MODEL_WORDS}")).otherwise(F.expr(f"k div {OLDER * CLASSES}"))
    table = feature_counts(train, lexicon).repartition(PARTS, previous).sortWithinPartitions("k")
    weights = trained(materialise(table, "feature-counts"), len(modelled) + 1, steps)

    # smoothed mass of each tail class: all its words' counts, less those of words that the model has
    tail = F.crc32(F.substring("word", -2, 2)) % TAIL_CLASSES
    mass = np.full(TAIL_CLASSES, 0.5)
    for number, value in counts.groupBy(tail.alias("tail")).agg(F.sum(F.col("n") + 0.5)).collect():
        mass[number] += float(value)
    for w, n in zip(modelled, numbers):
        mass[tail_class(w)] -= n + 0.5
    shared = spark.sparkContext.broadcast((weights.plain(), np.log10(mass)))

    scored = materialise(head_scores(source, lexicon, shared), "head-scores")
    known = (
        scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("w"))
        .select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
        .join(counts, "word")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.log10(F.col("n") + 0.5)).alias("looked"), F.sum("times").alias("found"))
    )
    outside = F.aggregate("times", F.lit(0), lambda a, b: a + b)
    rows = scored.select("row", "doc_id", "held_out", "n_tokens", "n_head", "base", "model", outside.alias("outside")).join(known, "row", "left")
    found = F.coalesce("found", F.lit(0))
    rest = F.coalesce("looked", F.lit(0.0)) + (F.col("outside") - found) * float(np.log10(0.5))
    scale = float(np.log10(train_tokens + 0.5 * (types + 1)))
    return rows.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_head") + found).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + rest - F.col("n_tokens") * scale).alias("base_score"),
        (F.col("model") + rest).alias("score"),
    )
