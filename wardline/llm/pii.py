"""Personal data: proposed by patterns, confirmed by checksums, scored by context.

All of it is column expressions.  A pattern's matches come from
``regexp_extract_all`` and the text between them from ``split`` with the same
pattern, so positions are running lengths of both: linear in the text, and the
neighbourhood of a match is the end and the start of its two neighbours.

Kinds, in order: ``email``, ``ip``, ``card`` (Luhn), ``phone``: the base
kinds, which always stay; ``iban`` (mod 97) and ``ssn`` (issue rules): kept
when their score reaches ``KEEP``.  A span's score is its kind's, raised by a
passed checksum and by a context word within 40 characters before or 20 after.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.tables import fresh

KEEP = 0.6
CHUNK = 256             # matches of a text that are worked on together
BEFORE, AFTER = 40, 20
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")

# Possessive and anchored forms of the stated patterns: the same matches, no
# backtracking over long runs.  A run can only start a match at its first
# character, or where the match before it ended (\G).
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{0,2}[0-9])?)\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}
# What a text must hold for the pattern to be tried at all.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]", "phone": r"\+[0-9]",
         "iban": r"[A-Z]{2}[0-9]{2}[A-Z0-9 ]", "ssn": r"[0-9]-[0-9]{2}-[0-9]"}

# Score of a kind, what a passed checksum adds, what context adds.
SCORES = {"email": (0.8, 0.0, 0.1), "ip": (0.6, 0.0, 0.2), "card": (0.5, 0.3, 0.2), "phone": (0.5, 0.0, 0.3),
          "iban": (0.4, 0.4, 0.2), "ssn": (0.3, 0.0, 0.4)}
CONTEXT = {
    "email": "mail|contact|kontakt|contacto|adresse|write|correo",
    "ip": "ip|host|server|address|login|client",
    "card": "card|visa|mastercard|credit|karte|carte|tarjeta|payment",
    "phone": "phone|tel|call|mobile|fax|telefon|appel|llame|handy",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social security|social-security|taxpayer",
}
_PLACEHOLDER = {k: f"[{k.upper()}]" for k in KINDS}


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(number)

    def add(acc, i):
        digit = F.ascii(number.substr(n - i + 1, F.lit(1))) - 48
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return acc + F.when(i % 2 == 0, twice).otherwise(digit)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number without spaces leaves 1 modulo 97, its first
    four characters moved to the end and letters read as 10 to 35."""
    turned = F.concat(iban.substr(F.lit(5), F.length(iban)), iban.substr(F.lit(1), F.lit(4)))

    def step(acc, i):
        code = F.ascii(turned.substr(i, F.lit(1)))
        return F.when(code < 58, acc * 10 + code - 48).otherwise(acc * 100 + code - 55) % 97
    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def valid(kind: str, match: Column) -> Column:
    """Whether a proposed span passes its kind's rules."""
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        number = digits(match)
        return F.when(F.length(number).between(13, 19), luhn(number)).otherwise(False)
    if kind == "phone":
        return F.length(digits(match)).between(9, 15)
    if kind == "iban":
        plain = F.replace(match, F.lit(" "), F.lit(""))
        return F.when(F.length(plain).between(15, 34), mod97(plain)).otherwise(False)
    if kind == "ssn":
        return match.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")
    return F.lit(True)


def score(kind: str, before: Column, after: Column) -> Column:
    """Score of a valid span with the text around it."""
    base, checked, context = SCORES[kind]
    near = F.lower(F.concat(before, F.lit(" "), after)).rlike(rf"\b(?:{CONTEXT[kind]})")
    return F.least(F.lit(1.0), F.lit(base + checked) + F.when(near, F.lit(context)).otherwise(F.lit(0.0)))


def _parts(text: Column, kind: str) -> tuple[Column, Column]:
    """(matches, the pieces between them: one more)."""
    tried = text.contains("@") if kind == "email" else text.rlike(NEEDS[kind])
    matches = F.when(tried, F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))).otherwise(F.array().cast("array<string>"))
    pieces = F.when(tried, F.split(text, PATTERNS[kind], -1)).otherwise(F.array(text))
    return matches, pieces


def find(matches: Column, pieces: Column, kind: str) -> Column:
    """Kept spans of one kind in reading order: array of structs ``kind,
    start, end`` (code points, end exclusive) and ``score``.

    Matches are taken in chunks, whose starts come from the sums of lengths
    before them; only what passes the kind's rules is appended, so the work is
    linear in the matches, also where one text holds very many."""
    n = F.size(matches)
    nothing = F.array().cast("array<struct<start:int,m:string,before:string,after:string>>")

    def rows(chunk):
        first, size = chunk * CHUNK + 1, F.least(F.lit(CHUNK), n - chunk * CHUNK)
        return F.arrays_zip(F.slice(matches, first, size).alias("m"), F.slice(pieces, first, size).alias("before"),
                            F.slice(pieces, first + 1, size).alias("after"))

    def add(acc, x):
        start = acc["at"] + F.length(x["before"])
        row = F.struct(start.alias("start"), x["m"].alias("m"), F.right(x["before"], F.lit(BEFORE)).alias("before"),
                       F.left(x["after"], F.lit(AFTER)).alias("after"))
        return F.struct((start + F.length(x["m"])).alias("at"),
                        F.when(valid(kind, x["m"]), F.concat(acc["rows"], F.array(row))).otherwise(acc["rows"]).alias("rows"))

    def length(chunk):
        return F.aggregate(rows(chunk), F.lit(0), lambda a, x: a + F.length(x["before"]) + F.length(x["m"]))
    chunks = F.sequence(F.lit(0), F.floor((n - 1) / CHUNK).cast("int"))
    starts = F.aggregate(F.transform(chunks, length), F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                         lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))["out"]
    kept = F.flatten(F.transform(starts, lambda at, chunk: F.aggregate(
        rows(chunk), F.struct(at.alias("at"), nothing.alias("rows")), add)["rows"]))
    spans = F.transform(F.when(n > 0, kept).otherwise(nothing), lambda x: F.struct(
        F.lit(kind).alias("kind"), x["start"].alias("start"), (x["start"] + F.length(x["m"])).alias("end"),
        score(kind, x["before"], x["after"]).alias("score")))
    return spans if kind in BASE else F.filter(spans, lambda x: x["score"] >= KEEP)


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and an array of spans for each kind
    (columns named like the kinds).  A null text is an empty one."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    parts = [c.alias(f"{name}_{k}") for k in KINDS for name, c in zip("mp", _parts(F.col("text"), k))]
    return rows.select("doc_id", *parts) \
        .select("doc_id", *[find(F.col(f"m_{k}"), F.col(f"p_{k}"), k).alias(k) for k in KINDS])


def _joined(arrays: list[Column]) -> Column:
    return F.array_join(F.transform(F.concat(*arrays), lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts of the base kinds, ``base_sha256``, ``spans`` (all
    kept spans), and ``scores`` (each span's score, in the same order).

    Null and empty texts have no spans; repeated rows and rows without an id
    give their own rows; an empty table gives none; other columns are ignored.
    """
    found = spans(docs)
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in BASE]
    every = [F.col(k) for k in KINDS]
    base = _joined(every[:len(BASE)])
    scores = F.array_join(F.transform(F.concat(*every), lambda x: F.format_string("%.1f", x["score"])), ",")
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"),
                        _joined(every).alias("spans"), scores.alias("scores"))


def _replaced(kind: str, text: Column, matches: Column, pieces: Column) -> Column:
    """``text`` with its kept matches replaced; ``pieces`` lie between them."""

    def shown(m, i):
        ok = valid(kind, m)
        if kind not in BASE:
            before, after = F.right(F.get(pieces, i), F.lit(BEFORE)), F.left(F.get(pieces, i + 1), F.lit(AFTER))
            ok = ok & (score(kind, before, after) >= KEEP)
        return F.concat(F.when(ok, F.lit(_PLACEHOLDER[kind])).otherwise(m), F.get(pieces, i + 1))
    rebuilt = F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(matches, shown), ""))
    return F.when(F.size(matches) > 0, rebuilt).otherwise(text)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every kept span replaced by its kind in brackets, and
    ``n_chars`` (if there) set to the new length.

    Kinds are replaced one after the other, each in the text that the ones
    before it left.  Null texts stay null; all other columns stay as they are.
    """
    out, kept = docs, [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    names = [fresh(docs.columns, x) for x in ("pii_text", "pii_m", "pii_p")]
    for kind in ("email", "iban", "ssn", "card", "phone", "ip"):
        matches, pieces = _parts(F.col(text_col), kind)
        out = out.select(*kept, F.col(text_col).alias(names[0]), matches.alias(names[1]), pieces.alias(names[2])) \
            .select(*kept, _replaced(kind, *map(F.col, names)).alias(text_col))
    if "n_chars" in docs.columns:
        changed = F.length(text_col).cast(dict(docs.dtypes)["n_chars"])
        out = out.withColumn("n_chars", F.when(F.col(text_col).isNull(), F.col("n_chars")).otherwise(changed))
    return out.select([F.col(f"`{c}`") for c in docs.columns])
