"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. The vector of a letter trigram binds
(multiplies) the vectors of its letters, each permuted (rotated) by its place; a document or a
language bundles (adds) the vectors of its trigrams. A document gets the language whose
bundle, the prototype, has the largest cosine with its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import map_slices, map_task

DIMENSIONS = 1024
SEED = 20240
#: Codes of letters: 0 is anything else, 1-26 a-z, the others are shared out by code point.
CODES = 64
SHARED = CODES - 27
UNDETERMINED = "und"
HOLD_OUT_PARTS = 3


def code_of(code_point: int) -> int:
    if 97 <= code_point <= 122:
        return code_point - 96
    return 27 + (code_point * 2654435761 >> 7) % SHARED if chr(code_point).isalpha() else 0


class Profiles:
    """The letter codes and vectors; built once in a task."""

    def __init__(self) -> None:
        self.table = np.array([code_of(cp) for cp in range(0x250)], dtype=np.uint8)
        draw = np.random.default_rng(SEED).choice(np.array([-1, 1], dtype=np.int8), size=(CODES, DIMENSIONS))
        first, second = np.roll(draw, 2, axis=1), np.roll(draw, 1, axis=1)
        #: bound pairs (first letter rotated twice, second once), and last letters
        self.pairs = (first[:, None, :] * second[None, :, :]).reshape(CODES * CODES, DIMENSIONS)
        self.letters = draw

    def trigrams(self, text: str | None) -> np.ndarray:
        """Codes of all letter trigrams of the whole text; what is no letter counts once as a gap."""
        if not text:
            return np.zeros(0, dtype=np.int64)
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        codes = self.table[np.minimum(points, len(self.table) - 1)]
        far = points >= len(self.table)
        if far.any():
            values, where = np.unique(points[far], return_inverse=True)
            codes[far] = np.array([code_of(int(v)) for v in values], dtype=np.uint8)[where]
        codes = np.concatenate(([0], codes, [0])).astype(np.int64)
        codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]
        if len(codes) < 3:
            return np.zeros(0, dtype=np.int64)
        return codes[:-2] * (CODES * CODES) + codes[1:-1] * CODES + codes[2:]

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of the grams' vectors, each as often as it counts."""
        total = np.zeros(DIMENSIONS, dtype=np.float64)
        for at in range(0, len(grams), 4096):
            part = grams[at : at + 4096]
            vectors = self.pairs[part // CODES]
            vectors *= self.letters[part % CODES]
            total += counts[at : at + 4096].astype(np.float32) @ vectors.astype(np.float32)
        return total


def labelled_counts(docs: DataFrame) -> DataFrame:
    """``lang, gram, n``: trigrams of all documents of each language; combined in tasks, then summed."""

    def run(parts):
        profiles = Profiles()
        totals: dict[str, np.ndarray] = {}
        for texts, langs in parts:
            by_lang: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(texts, langs, strict=True):
                by_lang.setdefault(lang, []).append(profiles.trigrams(text))
            for lang, grams in by_lang.items():
                if lang not in totals:
                    totals[lang] = np.zeros(CODES**3, dtype=np.int64)
                totals[lang] += np.bincount(np.concatenate(grams), minlength=CODES**3)
        for lang, counts in totals.items():
            (grams,) = counts.nonzero()
            yield {"lang": [lang] * len(grams), "gram": grams, "n": counts[grams]}

    counted = map_task(docs.select(F.col("text").cast("string"), F.col("lang").cast("string")), run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def prototypes(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Names and unit prototypes of the languages of ``labelled`` (``text``, ``lang``).

    The driver gets the summed counts of at most 64^3 trigrams a language, whatever the input.
    """
    found: dict[str, list[tuple[int, int]]] = {}
    for lang, gram, n in labelled_counts(labelled.where("lang is not null and text is not null")).toLocalIterator():
        found.setdefault(lang, []).append((gram, n))
    profiles, names, rows = Profiles(), sorted(found), []
    for lang in names:
        grams, counts = np.array(sorted(found[lang]), dtype=np.int64).T
        vector = profiles.bundle(grams, counts)
        rows.append(vector / (np.linalg.norm(vector) or 1.0))
    return names, np.array(rows).reshape(len(names), DIMENSIONS)


def best_language(profiles: Profiles, names: list[str], vectors: np.ndarray, text: str | None) -> tuple[str, float]:
    """Name and cosine of the nearest prototype; ``und`` and -1 for a text without letters."""
    grams, counts = np.unique(profiles.trigrams(text), return_counts=True)
    vector = profiles.bundle(grams, counts)
    size = np.linalg.norm(vector)
    if len(grams) == 0 or not names or size == 0:
        return UNDETERMINED, -1.0
    cosines = vectors @ vector / size
    best = int(cosines.argmax())
    return names[best], float(min(1.0, cosines[best]))


def predictions(docs: DataFrame, names: list[str], vectors: np.ndarray) -> DataFrame:
    """``docs`` (``doc_id``, ``held_out``, ``text``) with ``lang_pred`` and ``score``, the cosine from 0 to 1."""

    def make():
        profiles = Profiles()

        def predict(ids, held, texts):
            found = [best_language(profiles, names, vectors, text) for text in texts]
            langs, scores = [lang for lang, _ in found], [max(0.0, cosine) for _, cosine in found]
            return {"doc_id": ids, "held_out": held, "lang_pred": langs, "score": scores}

        return predict

    return map_slices(docs, make, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, parts: int = HOLD_OUT_PARTS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, lang_pred, score``.

    ``docs`` needs ``doc_id``, ``text`` and ``lang``; other columns are ignored. Prototypes are learnt
    from all rows with a text, a ``lang`` and an id whose crc32 is not 1 modulo ``parts``; a prediction
    sees the text alone. Null, empty and letterless texts are ``und`` with score 0, and so is every
    text if there is nothing to learn from. A null ``doc_id`` is not held out and not learnt from.
    Equal cosines go to the first name. Repeated rows give repeated rows.
    """
    remainder = F.crc32(F.col("doc_id").cast("long").cast("string")) % parts
    source = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(remainder == 1, F.lit(False)).alias("held_out"),
        F.col("text").cast("string"), F.col("lang").cast("string"),
    )
    names, vectors = prototypes(source.where(remainder != 1).select("text", "lang"))
    return predictions(source.select("doc_id", "held_out", "text"), names, vectors)


def recognised(docs: DataFrame, borders: Sequence[tuple[int, float]], parts: int = HOLD_OUT_PARTS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that have a language.

    Rejected are texts without a letter trigram, and those whose cosine with every prototype is below that of
    the last of ``borders`` (letters, cosine) whose number of letters they have; texts shorter than all borders say
    too little to be rejected. Prototypes are learnt as in :func:`identify`; the text is read twice and never
    shuffled.
    """
    remainder = F.crc32(F.col("doc_id").cast("long").cast("string")) % parts
    names, vectors = prototypes(docs.where(remainder != 1).select("text", "lang"))

    highest = max((c for _, c in borders), default=-1.0)

    def accepted(profiles: Profiles, text: str | None) -> bool:
        name, cosine = best_language(profiles, names, vectors, text)
        if name == UNDETERMINED or cosine >= highest:
            return name != UNDETERMINED
        letters = sum(map(str.isalpha, text))
        return cosine >= max((c for n, c in borders if letters >= n), default=-1.0)

    @F.pandas_udf("boolean")
    def keeps(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        profiles = Profiles()
        for texts in batches:
            yield pd.Series([accepted(profiles, text) for text in texts], dtype=bool)

    return docs.where(keeps(F.col("text").cast("string")))
