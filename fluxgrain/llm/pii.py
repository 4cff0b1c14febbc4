"""Personal data in texts: patterns propose spans, checksums confirm them, context words move the score.

Kinds with a fixed definition (always kept): email, ip (parts at most 255), card (14 to 19 digits, Luhn), phone
(international, 10 to 15 digits). Kinds that the method adds: iban (ISO 13616 shape, mod-97), tel (a national number,
kept only where nearby words speak of a telephone) and secret (20 to 512 letters and digits of many kinds, kept only
where a word such as token or password is just before it).

Nulls and empty texts have no spans. Repeated rows and rows without an id are scored each for itself; an empty table gives no rows. Other columns are
not read, or stay as they are where texts are masked, whatever their names. Work per text is linear in its length: no
pattern can be retried from each position of a long run.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxgrain.llm.rows import map_rows

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "tel", "secret")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match starts at the first digit of a run: later starts in a run that failed fail too.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9]{4})")
#: Characters of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24,
    "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32,
    "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22,
    "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
TEL = re.compile(r"(?<![0-9+.,-])\(?0?[0-9]{2,4}\)?[ /.-][0-9]{3,4}[ .-]?[0-9]{3,5}(?![0-9.,-]?[0-9])")
SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?![A-Za-z0-9+/_-])")
#: A span's score before context, the words that raise it, and those that lower it.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.8, "iban": 0.85, "tel": 0.3, "secret": 0.3}
NEAR = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "mastercard", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "konto"),
    "tel": ("phone", "tel", "call", "mobile", "fax", "telefon"),
    "secret": ("token", "secret", "password", "passwd", "apikey", "key", "credential", "bearer", "authorization"),
}
#: A secret's words stand before it, with only such characters between.
ASSIGNED = re.compile(r"([A-Za-z]+)[\"']?\s*(?:[:=]|=>)\s*[\"']?$")
AGAINST = ("isbn", "version", "order", "serial", "page")
CONTEXT_CHARS, CONTEXT_STEP, KEEP_AT = 40, 0.25, 0.5


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Runs of as many characters as their country's IBANs have (in groups of four with single spaces, or without), not followed by another letter or digit, whose check digits hold."""
    for m in IBAN.finditer(text):
        n, at, part = IBAN_LENGTHS.get(m[0][:2], 0), m.end(), 4
        while part < n:
            take = min(4, n - part)
            at += text[at : at + 1] == " "
            if not re.fullmatch(f"[A-Z0-9]{{{take}}}", text[at : at + take]):
                break
            at, part = at + take, part + take
        if n and part == n and not re.match("[A-Za-z0-9]", text[at : at + 1]) and mod97(text[m.start() : at]):
            yield m.start(), at


def varied(s: str) -> bool:
    """Whether a string looks drawn at random: letters and digits, over three bits a character."""
    n = len(s)
    return bool(re.search("[0-9]", s) and re.search("[A-Za-z]", s)) and -sum(c / n * math.log2(c / n) for c in map(s.count, set(s))) > 3


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`` found from each @, so that long runs are read once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield start, end
        at = text.find("@", m.end() if m else at + 1)


def score(kind: str, text: str, start: int, end: int) -> float:
    if kind == "secret":
        m = ASSIGNED.search(text[max(0, start - CONTEXT_CHARS) : start])
        return PRIOR[kind] + 2 * CONTEXT_STEP * bool(m and m[1].lower() in NEAR[kind])
    near = (text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]).lower()
    found = set(re.findall(r"[a-z]+", near))
    s = PRIOR[kind] + CONTEXT_STEP * bool(found.intersection(NEAR[kind])) - CONTEXT_STEP * bool(found.intersection(AGAINST))
    return round(min(1.0, max(0.0, s)), 2)


def spans(text: str | None) -> list[tuple[int, int, int, float]]:
    """(start, rank of kind, end, score) of a text's spans, by start and then kind; offsets count code points."""
    if not text:
        return []
    found = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if re.search("[0-9]", text):
        if "." in text:
            found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = re.sub("[ -]", "", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
        found += [(a, 4, e) for a, e in ibans(text)]
        taken, i, until = sorted((s, e) for s, _, e in found), 0, -1
        for m in TEL.finditer(text):
            while i < len(taken) and taken[i][0] < m.end():
                until, i = max(until, taken[i][1]), i + 1
            if until <= m.start():
                found.append((m.start(), 5, m.end()))
        found += [(m.start(), 6, m.end()) for m in SECRET.finditer(text) if varied(m[0])]
    out = [(s, k, e, score(KINDS[k], text, s, e)) for s, k, e in sorted(found)]
    return [x for x in out if x[1] < len(BASE_KINDS) or x[3] >= KEEP_AT]


def redact(text: str | None) -> str | None:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first, then longest, names it."""
    if not (found := spans(text)):
        return text
    out, at = [], 0
    for s, k, e, _ in sorted(found, key=lambda x: (x[0], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, spans array<struct<kind, start, end, score>>. No shuffle; texts stay in their partition."""

    def run(ids: list, texts: list) -> dict:
        return {"id": ids, "spans": [[{"kind": KINDS[k], "start": s, "end": e, "score": x} for s, k, e, x in spans(t)] for t in texts]}

    kind = docs.schema[id_col].dataType.simpleString()
    found = map_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>")
    return found.withColumnRenamed("id", id_col)


def pii_digest(docs: DataFrame) -> DataFrame:
    """Counts and digests of find_pii's spans for each document (null text: empty)."""

    names = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "scores")

    def run(ids: list, texts: list) -> dict:
        rows = []
        for t in texts:
            found = spans(t)
            base = [x for x in found if x[1] < len(BASE_KINDS)]
            said = [f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in found]
            digest = hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in base).encode()).hexdigest()
            rows.append((*(sum(k == n for _, k, _, _ in base) for n in range(4)), digest, ",".join(said), ",".join(f"{x[3]:.2f}" for x in found)))
        return {"doc_id": ids, **{k: [r[i] for r in rows] for i, k in enumerate(names)}}

    return map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, scores string")


def redact_pii(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked and n_chars counted anew; all other columns, and every row, stay."""

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return texts.map(redact, na_action="ignore")

    out = docs.withColumn("text", masked("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
