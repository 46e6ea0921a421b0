"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score.

Base kinds (email, ip, card, phone) are found by fixed patterns and validated by structure
(parts of an address, number of digits) and the Luhn sum. Further kinds are proposed by wider
patterns and stand only if a validator (mod-97 of an account number) or a context word near
them raises the score over a threshold. All positions are code points, the end is exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import map_slices

# Kinds in their order, characters and word lists.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "tel")
EMAIL_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "telefono", "téléphone"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social security"),
    "tel": ("phone", "tel", "call", "mobile", "fax", "telefon", "telefono", "téléphone"),
}
#: Score of a confirmed span without context, and what a context word adds.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.8, "iban": 0.8, "ssn": 0.3, "tel": 0.3}
CONTEXT_BONUS, THRESHOLD, NEAR = 0.2, 0.5, 40
IBAN_LENGTHS = (15, 34)

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
DIGIT_RUN = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
TEL = re.compile(r"(?<![0-9+().-])(?:\([0-9]{2,5}\) ?)?[0-9]{2,5}(?:[ .-][0-9]{2,5}){1,3}(?![0-9.-])")
HAS_DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int, float]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Local part: the longest run of its characters before an at sign, after the last match."""
    taken, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > taken and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        after = DOMAIN.match(text, at + 1) if start < at else None
        if after:
            taken = after.end()
            yield start, taken
        at = text.find("@", max(taken, at + 1))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four dotted numbers; a longer row of numbers is taken four at a time."""
    for run in DOTTED.finditer(text):
        parts, at = run.group().split("."), run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def cards(text: str) -> Iterator[tuple[int, int]]:
    for run in DIGIT_RUN.finditer(text):
        if run.end() - run.start() >= 12:
            digits = digits_of(run.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield run.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for run in PHONE.finditer(text):
        if 9 <= len(digits_of(run.group())) <= 15:
            yield run.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    for run in IBAN.finditer(text):
        account = run.group().replace(" ", "")
        if IBAN_LENGTHS[0] <= len(account) <= IBAN_LENGTHS[1] and mod97(account):
            yield run.span()


def ssns(text: str) -> Iterator[tuple[int, int]]:
    for run in SSN.finditer(text):
        area, group, serial = run.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield run.span()


def tels(text: str) -> Iterator[tuple[int, int]]:
    for run in TEL.finditer(text):
        if 7 <= len(digits_of(run.group())) <= 12:
            yield run.span()


BASE_FINDERS = (("email", emails), ("ip", addresses), ("card", cards), ("phone", phones))
MORE_FINDERS = (("iban", ibans), ("ssn", ssns), ("tel", tels))


def has_context(text: str, kind: str, start: int, end: int) -> bool:
    near = text[max(0, start - NEAR) : start].lower() + " | " + text[end : end + NEAR].lower()
    words = set(re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)*", near))
    return any(w in words or (" " in w and w in near) for w in CONTEXT[kind])


def find(text: str | None) -> list[Span]:
    """All spans of a text as (kind, start, end, score), by start, then kind as listed."""
    if not text:
        return []
    numeric = HAS_DIGIT.search(text) is not None
    found: list[Span] = []
    for kind, finder in BASE_FINDERS:
        if numeric or kind == "email":
            found += [
                (kind, a, b, min(1.0, PRIOR[kind] + CONTEXT_BONUS * has_context(text, kind, a, b)))
                for a, b in finder(text)
            ]
    if numeric:
        base = sorted((a, b) for _, a, b, _ in found)
        for kind, finder in MORE_FINDERS:
            for a, b in finder(text):
                if any(x < b and a < y for x, y in base):
                    continue
                score = PRIOR[kind] + CONTEXT_BONUS * has_context(text, kind, a, b)
                if score >= THRESHOLD:
                    found.append((kind, a, b, min(1.0, score)))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b, _ in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, counts, ``base_sha256``, ``spans``, ``scores``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Null text counts as
    empty and has no spans; a null ``doc_id`` stays null; repeated rows give repeated rows.
    Base spans always stand; added ones are only taken where no base span overlaps them.
    ``scores`` holds the score of each span in the order of ``spans``. Nothing is shuffled.
    """

    def make():
        def spans(ids, texts):
            out = {k: [] for k in ("doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "scores")}
            for doc_id, text in zip(ids, texts, strict=True):
                found = find(text)
                base = [s for s in found if s[0] in BASE_KINDS]
                out["doc_id"].append(doc_id)
                for kind in BASE_KINDS:
                    out[f"n_{kind}"].append(sum(s[0] == kind for s in base))
                out["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
                out["spans"].append(written(found))
                out["scores"].append([round(s[3], 3) for s in found])
            return out

        return spans

    schema = (
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
        "base_sha256 string, spans string, scores array<double>"
    )
    return map_slices(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, schema)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; null text stays null."""
    columns = docs.columns

    @F.pandas_udf("string")
    def masked(texts):
        def one(text):
            if text is None:
                return None
            parts, at = [], 0
            for kind, a, b, _ in find(text):
                if a >= at:
                    parts += [text[at:a], f"[{kind}]"]
                    at = b
            return "".join(parts) + text[at:]

        return texts.map(one)

    return docs.withColumn("text", masked("text")).select(*columns)
