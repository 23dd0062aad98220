"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust the score.

Base kinds are found by their patterns alone, leftmost and without overlaps within a kind, and a match that
fails its check is dropped without another try: ``email``, ``ip`` (parts of at most 255), ``card`` (16 to 19
digits with a right Luhn sum), ``phone`` (``+`` and 8 to 15 digits). They are always kept.

Further kinds start from a score for their pattern, gain ``CHECKED`` for a right checksum and ``NEARBY`` for a
context word within ``REACH`` characters, and are kept from ``THRESHOLD`` on: ``iban`` (mod 97), ``short_card``
(12 to 15 digits, Luhn), ``ssn`` and ``local_phone`` (no checksum, so only beside a context word). A further
span that overlaps a base one is dropped. Scores of base spans are adjusted in the same way, for callers to use.

All patterns are scanned in time linear in the text: runs of name characters are only looked at beside an
``@``, and a run of digits is entered at its first digit only. Nothing is shuffled.

Defined results: NULL text is empty and has no spans. Places count code points, the end is exclusive. Rows are
judged each for itself, so NULL or repeated doc_id, repeated rows, empty tables and further columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds in the order of results.
BASE = ("email", "ip", "card", "phone")
FURTHER = ("iban", "short_card", "ssn", "local_phone")
# Words that speak for a kind when they are near.
CONTEXT = {
    "email": ("mail", "contact", "correo", "courriel", "kontakt"),
    "ip": ("ip", "address", "host", "server", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "tarjeta", "carte", "karte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "teléfono", "téléphone"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "short_card": ("card", "amex", "diners", "credit", "tarjeta", "carte", "karte"),
    "ssn": ("ssn", "social security"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "teléfono", "téléphone"),
}
PATTERN_SCORE = {"email": 0.8, "ip": 0.6, "card": 0.4, "phone": 0.6, "iban": 0.3, "short_card": 0.1, "ssn": 0.3, "local_phone": 0.3}
CHECKED, NEARBY, REACH, THRESHOLD = 0.4, 0.3, 40, 0.6

NAME = re.compile(r"[A-Za-z0-9._%+-]++")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
NOT_DIGIT = re.compile(r"[^0-9]")
WORD = {kind: re.compile(r"\b(?:" + "|".join(words) + r")\b") for kind, words in CONTEXT.items()}

SPANS = "doc_id long, spans array<struct<kind:string,start:long,end:long,score:double>>"
Span = tuple[str, int, int, float]


def luhn(digits: str) -> bool:
    """Every second digit from the right doubled, the digits of all summed: a multiple of ten."""
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def mod_97(code: str) -> bool:
    """Check digits of an account number: letters as numbers from 10 on, the first four characters last."""
    code = code.replace(" ", "")
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        if domain := DOMAIN.match(text, at + 1):
            # The name is the run of name characters that ends at the sign.
            name = NAME.match(text[done:at][::-1])
            if name:
                yield at - name.end(), domain.end()
                done = domain.end()
        done = max(done, at + 1)
        at = text.find("@", done)


def base_matches(text: str) -> Iterator[tuple[str, int, int]]:
    if "@" in text:
        for start, end in emails(text):
            yield "email", start, end
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in DIGITS.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                yield "phone", m.start(), m.end()


def further_matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """Kind, span, and whether a checksum confirms it."""
    for m in IBAN.finditer(text):
        if mod_97(m[0]):
            yield "iban", m.start(), m.end(), True
    for m in DIGITS.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 15 and luhn(digits):
            yield "short_card", m.start(), m.end(), True
    for m in SSN.finditer(text):
        yield "ssn", m.start(), m.end(), False
    for m in LOCAL_PHONE.finditer(text):
        yield "local_phone", m.start(), m.end(), False


def nearby(text: str, kind: str, start: int, end: int) -> bool:
    around = text[max(0, start - REACH) : start] + " " + text[end : end + REACH]
    return bool(WORD[kind].search(around.lower()))


def find_spans(text: str) -> list[Span]:
    """All spans of a text, by kind and then by start."""
    out: list[Span] = []
    for kind, start, end in base_matches(text):
        score = PATTERN_SCORE[kind] + CHECKED * (kind == "card") + NEARBY * nearby(text, kind, start, end)
        out.append((kind, start, end, round(min(1.0, score), 2)))
    taken = sorted((s, e) for _, s, e, _ in out)
    for kind, start, end, checked in further_matches(text):
        score = PATTERN_SCORE[kind] + CHECKED * checked
        if score + NEARBY >= THRESHOLD and (near := score + NEARBY * nearby(text, kind, start, end)) >= THRESHOLD:
            if not any(s < end and start < e for s, e in taken):
                out.append((kind, start, end, round(min(1.0, near), 2)))
    return out


def _arrow(rows: list[list[Span]]) -> pa.Array:
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    return pa.array([[dict(zip(("kind", "start", "end", "score"), s)) for s in spans] for spans in rows], pa.list_(kind))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) for every document."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [find_spans(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _arrow(spans)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(search, SPANS)


def masked(text: str) -> str:
    """The text with ``<KIND>`` in place of each span; of overlapping spans the first and longest."""
    out, at = [], 0
    for kind, start, end, _ in sorted(find_spans(text), key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
            at = end
        elif end > at:  # the rest of an overlapping span goes too
            at = end
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with personal data in the text masked; a NULL text stays NULL."""

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [None if t is None else masked(t) for t in (x.as_py() for x in batch.column(at))]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(replace, docs.schema)


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def digest(result: DataFrame) -> DataFrame:
    """Counts of the base kinds, hash of the base spans, all spans and the sum of scores."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return result.select(
        "doc_id", *[of(k) for k in BASE], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
        *[of(k) for k in FURTHER],
    )
