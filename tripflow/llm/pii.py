"""Personal data: patterns propose spans, checksums confirm them, nearby words move the score.

Four base kinds (email, ip, card, phone) are exact: every span their pattern and check accept is reported.
Further kinds (iban, national_id, phone_local) are reported where pattern, checksum and context together
reach `threshold`; they never replace or hide a base span, and never overlap one.

Defined results: a null or empty text has no spans (and stays null or empty when masked); rows are handled one by one, so
repeated rows and ties give the same spans each; an empty table gives an empty table; the columns the operator adds are
named by the caller (`spans`, `text`), all other columns pass through or are ignored.
All scans are linear in the text, so one very long text costs no more than many short ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripflow.llm.common import lean

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("iban", "national_id", "phone_local")
KINDS = BASE_KINDS + MORE_KINDS

# Words that make a span of the kind likelier (lower case, four languages).
CONTEXT = {
    "email": ("mail", "contact", "correo", "courriel", "kontakt"),
    "ip": ("ip", "host", "server", "address", "adresse", "servidor"),
    "card": ("card", "visa", "credit", "carte", "karte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "anruf", "llame", "appel"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "national_id": ("ssn", "social", "security", "identity", "ausweis", "seguridad"),
    "phone_local": ("phone", "call", "tel", "mobile", "anruf", "llame", "appel"),
}
# What pattern and checksum are worth without any context word; a context word adds CONTEXT_GAIN.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.7, "national_id": 0.3, "phone_local": 0.3}
CONTEXT_GAIN = 0.25
CONTEXT_CHARS = 48

_LOCAL = r"[A-Za-z0-9._%+-]"
_DOMAIN = r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_EMAIL_HERE = re.compile(rf"{_LOCAL}++{_DOMAIN}")
_EMAIL_NEXT = re.compile(rf"(?<!{_LOCAL}){_LOCAL}++{_DOMAIN}")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
_DIGIT_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9(+])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_WORD = re.compile(r"[^\W\d_]+")

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
)
_ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        if place % 2:
            digit = digit * 2 - 9 * (digit > 4)
        total += digit
    return total % 10 == 0


def mod97(code: str) -> bool:
    """The check of international account numbers: country and check digits last, letters as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # Inside a run of local-part characters only the first start can match, so no inner start is tried;
    # right after a match the rest of a run is a start of its own.
    at = 0
    while text.find("@", at) >= 0:
        found = (at and _EMAIL_HERE.match(text, at)) or _EMAIL_NEXT.search(text, at)
        if not found:
            return
        yield found.span()
        at = found.end()


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for chain in _DOTTED.finditer(text):
        parts = chain[0].split(".")
        at = chain.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            # Long runs of digits are compared by length first: int() of a huge run is slow and limited.
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                yield at, end
            at = end + 1


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for chain in _DIGIT_CHAIN.finditer(text):
        if chain.end() - chain.start() <= 37:
            digits = _NOT_DIGIT.sub("", chain[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield chain.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", found[0])) <= 15:
            yield found.span()


def _more(text: str) -> Iterator[tuple[str, int, int]]:
    for found in _IBAN.finditer(text):
        code = found[0].replace(" ", "")
        if 15 <= len(code) <= 34 and mod97(code):
            yield "iban", *found.span()
    for found in _NATIONAL.finditer(text):
        yield "national_id", *found.span()
    for found in _LOCAL_PHONE.finditer(text):
        yield "phone_local", *found.span()


def score(text: str, kind: str, start: int, end: int) -> float:
    around = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
    words = set(_WORD.findall(around.lower()))
    return min(1.0, PRIOR[kind] + CONTEXT_GAIN * bool(words.intersection(CONTEXT[kind])))


def find_spans(text: str | None, threshold: float = 0.5) -> list[tuple[str, int, int, float]]:
    """Spans as (kind, start, end, score), by kind in the order of `KINDS`, then by start."""
    if not text:
        return []
    found: list[tuple[str, int, int]] = [("email", *span) for span in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for kind, spans in (("ip", _ips), ("card", _cards), ("phone", _phones)):
            found += [(kind, *span) for span in spans(text)]
        base = list(found)
        extra = []
        for kind, start, end in _more(text):
            if not any(a < end and start < b for _, a, b in base) and score(text, kind, start, end) >= threshold:
                extra.append((kind, start, end))
        found += sorted(extra, key=lambda x: (KINDS.index(x[0]), x[1]))
    return [(k, a, b, score(text, k, a, b)) for k, a, b in found]


def masked(text: str | None, spans: list[tuple[str, int, int, float]]) -> str | None:
    """The text with each span, overlapping ones together, replaced by its kind in brackets."""
    if not spans:
        return text
    out, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def with_spans(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), threshold: float = 0.5) -> DataFrame:
    """Columns `keep` and `spans`, one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in find_spans(t, threshold)]
                for t in batch.column(text).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(spans, _ARROW_SPANS)], [*keep, "spans"]
            )

    narrow = docs.select(*dict.fromkeys((*keep, text)))
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("spans", SPANS)])
    return narrow.mapInArrow(lean(run), schema)


def mask_documents(docs: DataFrame, text: str = "text", length: str | None = "n_chars", threshold: float = 0.5) -> DataFrame:
    """The documents with masked texts and, where the column exists, their new length in code points."""
    names = docs.columns
    length = length if length in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(n) for n in names}
            texts = columns[text].to_pylist()
            clean = [masked(t, find_spans(t, threshold)) for t in texts]
            columns[text] = pa.array(clean, columns[text].type)
            if length:
                kind = columns[length].type
                columns[length] = pa.array(
                    [
                        old if new is was else len(new)
                        for new, was, old in zip(clean, texts, columns[length].to_pylist(), strict=True)
                    ],
                    kind,
                )
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return docs.mapInArrow(lean(run), docs.schema)
