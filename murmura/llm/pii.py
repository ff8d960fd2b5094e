"""Personal data by patterns, checksums and context, in DataFrame functions only.

Base spans, leftmost and non-overlapping per kind: e-mail addresses, IPv4 addresses with parts up
to 255, card numbers of 14 to 19 digits that pass Luhn, phone numbers of 10 to 15 digits. A match
that fails its check is dropped and not tried again. The method adds account numbers (iban) that pass
mod 97. Each span starts from its kind's score; context words within 40 characters raise it. Base
spans stay whatever their score; an iban needs 0.6, which one of a country without a known length
reaches only beside a context word.

Offsets are code points, end exclusive. They come from the lengths of the matches and of the gaps
that ``split`` leaves by the same pattern, so a text is scanned twice a kind and nothing is shuffled.
Running sums over them go in blocks, and texts are cut into chunks once, so that the work for many spans
of one text is linear. Patterns are the contract's with possessive loops and a guard that skips starts inside a run, which
changes no match and keeps long runs linear.

Cases: a null or empty text has no spans (counts 0, digest of the empty string). Every row has its
own result, so repeated rows repeat it; a null doc_id is handed through; other columns are ignored.
No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "iban")
_LOCAL, _HOST = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}+(?:\.{_HOST}+)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\b",
}
#: A text without this has no match of the kind that can pass its check.
HINTS = {
    "email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?+[0-9]){13}",
    "phone": r"\+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]",
}
SCORES = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8}
UNKNOWN_COUNTRY, CONTEXT_BONUS, IBAN_LEAST = 0.4, 0.2, 0.6
CONTEXT_REACH = 40
CONTEXT = {
    "email": "mail|e-mail|contact|address", "ip": "ip|host|server|address", "card": "card|visa|mastercard|amex|payment|credit",
    "phone": "phone|tel|call|fax|mobile|cell", "iban": "iban|account|bank|konto|compte|cuenta",
}
# Lengths of account numbers by country, of the public registry.
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22,
    "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IT": 27, "LT": 20, "LU": 20, "LV": 21, "NL": 18, "NO": 15, "PL": 28, "PT": 25,
    "RO": 24, "SE": 24, "SI": 19, "SK": 24,
}
#: Places of a running sum that share a block, and code points of a chunk.
SCAN, CHUNK = 256, 4096
_SPAN = "struct<start:bigint,rank:int,stop:bigint,kind:string,value:string>"


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def part(i: Column) -> Column:
        d = F.substring(digits, n + 1 - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), n), part), F.lit(0), lambda acc, x: acc + x)
    return total % 10 == 0


def _mod97(plain: Column) -> Column:
    """Whether an account number, its first four characters moved to the end, is 1 modulo 97."""
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code < 58, (acc * 10 + code - 48) % 97).otherwise((acc * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        plain = F.replace(value, F.lit(" "), F.lit(""))
        return F.when(F.length(plain).between(15, 34), _mod97(plain)).otherwise(False)
    return F.lit(True)


def _known_length(value: Column) -> Column:
    plain = F.replace(value, F.lit(" "), F.lit(""))
    lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])
    return F.coalesce(lengths[F.substring(plain, 1, 2)] == F.length(plain), F.lit(False))


def _matches(text: Column, kind: str) -> tuple[Column, Column]:
    """The matches and the gaps around them; empty where a text cannot hold the kind."""
    hint, pattern = F.lit(HINTS[kind]), F.lit(PATTERNS[kind])
    may = text.rlike(HINTS[kind])
    none = F.array().cast("array<string>")
    return F.when(may, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(none), F.when(
        may, F.split(text, PATTERNS[kind], -1)).otherwise(none)


def _before(values: Column, combine) -> Column:
    """For each of some longs, at least one, what ``combine`` makes of 0 and all values before it.

    Blocks of SCAN values are gone through by themselves, then their totals, so no step copies a long array.
    """
    def scan(block: Column, value) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("before"))
        return F.aggregate(block, zero, lambda acc, x: F.struct(
            combine(acc["at"], value(x)).alias("at"), F.array_append(acc["before"], acc["at"]).alias("before")))

    last = F.floor((F.size(values) - 1) / SCAN).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), last), lambda i: scan(F.slice(values, i * SCAN + 1, F.lit(SCAN)), lambda x: x))
    return F.flatten(F.zip_with(
        blocks, scan(blocks, lambda x: x["at"])["before"],
        lambda block, base: F.transform(block["before"], lambda x: combine(base, x)),
    ))


def _spans(kind: str) -> Column:
    """Valid spans of a kind out of its matches and gaps."""
    found, gaps = F.col(f"_m_{kind}"), F.col(f"_g_{kind}")
    places = F.sequence(F.lit(0), F.size(found) - 1)
    steps = F.transform(places, lambda i: (F.length(F.get(gaps, i)) + F.length(F.get(found, i))).cast("long"))
    spans = F.zip_with(
        _before(steps, lambda x, y: x + y), places,
        lambda at, i: F.struct(
            (at + F.length(F.get(gaps, i))).alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
            (at + F.length(F.get(gaps, i)) + F.length(F.get(found, i))).alias("stop"), F.lit(kind).alias("kind"),
            F.get(found, i).alias("value"),
        ),
    )
    valid = F.filter(spans, lambda s: _valid(kind, s["value"]))
    return F.when(F.size(found) > 0, valid).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}+"), F.lit(0))


def _piece(chunks: Column, start: Column, stop: Column) -> Column:
    """The text from ``start`` to ``stop``, out of the chunks that hold it."""
    first = F.floor(start / CHUNK).cast("int")
    count = F.floor((stop - 1) / CHUNK).cast("int") - first + 1
    joined = F.array_join(F.slice(chunks, first + 1, count), "")
    return F.when(stop > start, F.substring(joined, (start - first * CHUNK + 1).cast("int"), (stop - start).cast("int"))).otherwise("")


def _score(chunks: Column, span: Column) -> Column:
    """The span's score: its kind's, more beside a context word, less for an unknown country."""
    low = F.greatest(span["start"] - CONTEXT_REACH, F.lit(0))
    near = F.lower(F.concat_ws(
        " ", _piece(chunks, low, span["start"]), _piece(chunks, span["stop"], span["stop"] + CONTEXT_REACH)))
    score = F.lit(0.0)
    for kind in KINDS:
        own = F.lit(SCORES[kind])
        if kind == "iban":
            own = F.when(_known_length(span["value"]), own).otherwise(UNKNOWN_COUNTRY)
        own = own + F.when(near.rlike(rf"\b(?:{CONTEXT[kind]})\b"), CONTEXT_BONUS).otherwise(0.0)
        score = F.when(span["kind"] == kind, own).otherwise(score)
    return F.round(score, 2)


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_spans``: start, rank, stop, kind, value and score of each span, in order."""
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    df = docs
    for kind in KINDS:
        found, gaps = _matches(own, kind)
        df = df.withColumns({f"_m_{kind}": found, f"_g_{kind}": gaps})
    df = df.withColumns({f"_s_{kind}": _spans(kind) for kind in KINDS})
    everything = F.concat(*[F.col(f"_s_{kind}") for kind in KINDS])
    df = df.withColumn("_all", everything)
    df = df.withColumn("_chunks", F.when(F.size("_all") > 0, _chunks(own)))
    scored = F.transform(
        "_all",
        lambda s: F.struct(s["start"], s["rank"], s["stop"], s["kind"], s["value"], _score(F.col("_chunks"), s).alias("score")),
    )
    kept = F.filter(F.array_sort(scored), lambda s: (s["kind"] != "iban") | (s["score"] >= IBAN_LEAST))
    df = df.withColumn("_spans", F.when(F.size("_all") > 0, kept).otherwise(scored))
    return df.drop("_all", "_chunks", *[f"_{x}_{kind}" for x in "mgs" for kind in KINDS])


def _listed(spans: Column, score: bool = False) -> Column:
    parts = lambda s: [s["kind"], s["start"].cast("string"), s["stop"].cast("string")] + (
        [s["score"].cast("string")] if score else [])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", *parts(s))), ",")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans, and ``scored`` (spans with their score)."""
    df = with_spans(docs.select("doc_id", "text"))
    base = F.filter("_spans", lambda s: s["kind"] != "iban")

    def count(kind: str) -> Column:
        return F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS[:4]]
    return df.select(
        F.col("doc_id").cast("long").alias("doc_id"), *counts, F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("_spans")).alias("spans"), _listed(F.col("_spans"), True).alias("scored"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; n_chars follows the new text.

    Spans that overlap become one mark, named by the first of them. Texts without spans,
    null ones too, stay as they are.
    """
    df = with_spans(docs.select(F.struct(*docs.columns).alias("row"), "text"))
    text, chunks = F.col("text"), F.col("_chunks")
    df = df.withColumn("_chunks", F.when(F.size("_spans") > 0, _chunks(text)))
    covered = _before(F.transform("_spans", lambda s: s["stop"]), F.greatest)
    marks = F.filter(
        F.zip_with("_spans", covered, lambda s, at: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), at.alias("at"))),
        lambda m: m["start"] >= m["at"],
    )
    parts = F.transform(
        marks, lambda m: F.concat(_piece(chunks, m["at"], m["start"]), F.lit("["), F.upper(m["kind"]), F.lit("]")))
    rest = _piece(chunks, F.array_max(F.transform("_spans", lambda s: s["stop"])), F.length(text).cast("long"))
    df = df.withColumn("new", F.when(F.size("_spans") > 0, F.concat(F.array_join(parts, ""), rest)))
    changed = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("new").cast(docs.schema["n_chars"].dataType)
    return df.select(*[
        F.when(F.col("new").isNotNull(), changed[c]).otherwise(F.col("row")[c]).alias(c) if c in changed else F.col("row")[c].alias(c)
        for c in docs.columns
    ])
