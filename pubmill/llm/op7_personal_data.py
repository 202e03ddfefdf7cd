"""Personal data: patterns propose, checksums confirm, context words weigh.

Base kinds: email, ip (parts to 255), card (14 to 19 digits, Luhn) and phone
(+ and 10 to 15 digits), each leftmost and not overlapping within its kind;
proposals that fail their check are dropped. Added by the method: iban (mod-97)
and card13 (13 digits, Luhn), kept where words nearby lift their score to
``KEEP``. Base spans stay whatever their score. Offsets count code points, ends
exclusive.

Cases: null and empty texts have no spans; texts are searched whole and in time
linear in their length; repeated rows give repeated rows; an empty table gives
none; further columns are not used by the detector and kept by ``redact``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "card13")
_ORDER = {k: i for i, k in enumerate(KINDS)}
#: Score that an added span needs; characters on each side in which context counts.
KEEP, NEARBY = 0.75, 48
# Context words of each kind.
CONTEXT = {
    "email": frozenset({"mail", "email", "contact", "write", "courriel", "correo"}),
    "ip": frozenset({"ip", "address", "host", "server", "adresse"}),
    "card": frozenset({"card", "visa", "payment", "carte", "karte", "tarjeta"}),
    "phone": frozenset({"phone", "telephone", "tel", "call", "mobile", "fax"}),
    "iban": frozenset({"iban", "account", "bank", "konto", "compte", "cuenta"}),
    "card13": frozenset({"card", "visa", "payment", "carte", "karte", "tarjeta"}),
}

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}")
_DIGIT = re.compile("[0-9]")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_WORDS = re.compile(r"[^\W\d_]+")
_SPACERS = str.maketrans("", "", " -")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(_DOUBLED[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def mod97(code: str) -> bool:
    """True for an international account number with right check digits."""
    moved = code[4:] + code[:4]
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, (end := m.end())
            at = text.find("@", end)
        else:
            end = max(end, at)
            at = text.find("@", at + 1)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in _DOTTED.finditer(text):
        parts, at = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            own = parts[i : i + 4]
            end = at + sum(map(len, own)) + 3
            if all(len(v := p.lstrip("0")) <= 3 and int(v or 0) <= 255 for p in own):
                yield at, end
            at = end + 1


def _cards(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].translate(_SPACERS)
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.start(), m.end(), "card" if len(digits) > 13 else "card13"


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Each proposal, shortened by whole groups until its check digits are right: a word after it may look like a group."""
    at = 0
    while m := _IBAN.search(text, at):
        end = m.end()
        while end > m.start() and not mod97(text[m.start() : end].replace(" ", "")):
            end = text.rfind(" ", m.start(), end)
        if end > m.start():
            yield m.start(), end
        at = max(end, m.start() + 1)


def score(text: str, kind: str, start: int, end: int, checked: bool) -> float:
    """0.5 for a proposal, 0.2 more with a checksum, 0.25 more with a context word (whole, in any case) nearby."""
    near = text[max(0, start - NEARBY) : start] + " " + text[end : end + NEARBY]
    return 0.5 + 0.2 * checked + 0.25 * (not CONTEXT[kind].isdisjoint(_WORDS.findall(near.lower())))


def find(text: str) -> list[tuple[int, str, int, float]]:
    """(start, kind, end, score) by start, then kind as listed."""
    out = []
    if "@" in text:
        out += [(a, "email", b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        out += [(a, "ip", b) for a, b in _addresses(text)]
        out += [(a, kind, b) for a, b, kind in _cards(text)]
        if "+" in text:
            out += [(a, "phone", b) for a, b in _phones(text)]
        out += [(a, "iban", b) for a, b in _ibans(text)]
    scored = [(a, kind, b, score(text, kind, a, b, kind in ("card", "iban", "card13"))) for a, kind, b in out]
    return sorted((s for s in scored if s[1] in BASE or s[3] >= KEEP), key=lambda s: (s[0], _ORDER[s[1]], s[2]))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, end, score) of each document (doc_id, text)."""

    def per_batch(batch: pa.RecordBatch):
        found = [find(text.as_py() or "") for text in batch["text"]]
        return batch["doc_id"], [[{"kind": k, "start": a, "end": b, "score": s} for a, k, b, s in x] for x in found]

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(source, per_batch, "doc_id long, spans array<struct<kind:string,start:long,end:long,score:double>>")


def masked(text: str) -> str:
    """The text with each stretch of spans replaced by the first one's kind in brackets."""
    out, at = [], 0
    for a, kind, b, _ in find(text):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data masked in its text column; a null text stays null."""
    at = docs.columns.index(text)

    def per_batch(batch: pa.RecordBatch):
        columns = list(batch.columns)
        columns[at] = [None if t is None else masked(t) for t in batch.column(at).to_pylist()]
        return columns

    return arrow_map(docs, per_batch, docs.schema)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the personal data in every document."""
    found = personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    scores = F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 2)), ",").alias("scores")
    return found.select("doc_id", *(count(k) for k in BASE), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), scores)
