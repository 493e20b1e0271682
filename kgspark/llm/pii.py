"""Personal data: regular expressions propose spans, checksums confirm them, nearby context words adjust the score.

A base span (email, ip, card, phone) is kept whatever its score; further kinds are kept from ``least`` upwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kgspark.llm.shared import map_text

#: Kinds in the order used for ties; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "account")
BASE = KINDS[:4]
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
DIGITS = re.compile(r"[0-9]+")
#: Score before context, and the words that raise it. Fixed values.
START = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3, "account": 0.3}
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile"),
    "iban": ("iban", "bank", "account"),
    "ssn": ("ssn", "social", "security"),
    "account": ("card", "account", "payment"),
}
RAISE, WINDOW = 0.3, 40


def luhn(digits: str) -> bool:
    """True if the weighted digit sum is a multiple of ten."""
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(account: str) -> bool:
    """True if the account number, first four characters moved to the end and letters as 10 to 35, leaves 1 modulo 97."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def emails(text: str) -> Iterable[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from each @ so that long runs without one cost nothing."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            yield start, free
        at = text.find("@", free)


def ibans(text: str) -> Iterable[tuple[int, int]]:
    """Bank accounts: from each start the longest end at a character-group boundary that passes the checksum.

    Capital words or numbers after an account, or before it, hide nothing: the search goes on behind the account, or behind
    the start that gave none.
    """
    m = IBAN.search(text)
    while m:
        start, free = m.start(), m.start() + 1
        ends = [m.end(), *(start + i for i in range(len(m.group()) - 1, 0, -1) if m.group()[i] == " ")]
        for end in ends:
            account = text[start:end].replace(" ", "")
            if len(account) < 15:
                break
            if mod97(account):
                yield start, end
                free = end
                break
        m = IBAN.search(text, free)


def _ascii_digits(text: str) -> str:
    return "".join(DIGITS.findall(text))


def proposed(text: str) -> Iterable[tuple[str, int, int]]:
    """Confirmed spans: kind, start, end (code points, end exclusive)."""
    if "@" in text:
        yield from (("email", *span) for span in emails(text))
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m.group().split(".")):
            yield "ip", m.start(), m.end()
    for m in CARD.finditer(text):
        digits = _ascii_digits(m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()
        elif 12 <= len(digits) <= 13 and luhn(digits):
            yield "account", m.start(), m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(_ascii_digits(m.group())) <= 15:
                yield "phone", m.start(), m.end()
    yield from (("iban", *span) for span in ibans(text))
    for m in SSN.finditer(text):
        yield "ssn", m.start(), m.end()


def scored(text: str | None, least: float = 0.5) -> list[tuple[int, int, int, float]]:
    """Sorted (start, index of the kind, end, score). Base kinds always stay, others with a score of ``least`` or more."""
    found = []
    for kind, start, end in proposed(text or ""):
        near = f"{text[max(0, start - WINDOW) : start]} {text[end : end + WINDOW]}".lower()
        score = min(1.0, START[kind] + RAISE * any(word in near for word in CONTEXT[kind]))
        if kind in BASE or score >= least:
            found.append((start, KINDS.index(kind), end, score))
    return sorted(found)


def find_pii(docs: DataFrame, text_col: str = "text", least: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the kept columns) and ``out.kinds, starts, ends, scores``: parallel arrays, by start, then by kind.

    Null and empty texts have no span; repeated rows are searched each; an empty table gives no row. Work is linear in
    the length of a text. Nothing is shuffled.
    """

    def kernel(texts: list) -> dict[str, list]:
        spans = [scored(t.decode("utf-8", "replace") if t else "", least) for t in texts]
        return {
            "kinds": [[KINDS[k] for _, k, _, _ in s] for s in spans],
            "starts": [[x[0] for x in s] for s in spans],
            "ends": [[x[2] for x in s] for s in spans],
            "scores": [[x[3] for x in s] for s in spans],
        }

    return map_text(docs, text_col, kernel, "kinds array<string>, starts array<bigint>, ends array<bigint>, scores array<double>", keep)


def op2_pii(docs: DataFrame) -> DataFrame:
    found = find_pii(docs, keep=["doc_id"])
    spans = F.transform(
        F.arrays_zip("out.kinds", "out.starts", "out.ends"),
        lambda s: F.struct(s["kinds"].alias("kind"), F.concat_ws(":", s["kinds"], s["starts"].cast("string"), s["ends"].cast("string")).alias("text")),
    )
    found = found.select(F.col("row.doc_id").alias("doc_id"), spans.alias("spans"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: s["text"]), ",")
    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )
