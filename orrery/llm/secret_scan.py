"""Secret scans with corpus-wide ownership of each candidate."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orrery.llm import words as T
from orrery.sources.storage import written

# Kinds in the order in which spans at one start are listed, with what they match. Letters of the keywords
# of `assign` stand in either case, which is why it is matched on text with A-Z lowered.
KEYWORDS = ["password", "passwd", "secret", "token", "api_key", "apikey"]
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
BASE_KINDS = ["assign", "access", "hex"]
# Shapes beyond the base: key headers, well-known prefixes, signed tokens, credentials in an address, long mixed strings.
MORE = {
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\x20\t\r\n]+-----END [A-Z ]*PRIVATE KEY-----",
    "prefixed": r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_-]{35}|sk_live_[0-9A-Za-z]{16,}",
    "signed": r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "address": r"[a-z][a-z0-9+.-]*://[^\x20\t\r\n:/@]+:([^\x20\t\r\n:/@]{6,})@",
    "mixed": r"[A-Za-z0-9+/_-]{32,}",
}
# A text without any of these has no match of that kind.
HINTS = {
    "private_key": ["-----BEGIN "],
    "prefixed": ["ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "AIza", "sk_live_"],
    "signed": [".eyJ"],
    "address": ["://"],
    "mixed": [],
}
MIXED_NEEDS = ["[a-z]", "[A-Z]", "[0-9]"]  # each of these must occur in a mixed string
KINDS = [*BASE_KINDS, *MORE]
OWNERS = 3  # a value that so many owners hold is an example that was copied around
ENTROPY = 3.0  # bits a character of a value that looks live, at least
PLACEHOLDERS = ("example", "changeme", "placeholder", "dummy", "sample", "xxxx", "1234567890", "your")
SALTS = 16
SPAN = "struct<kind:int,start:int,end:int,value:string,live:boolean>"

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_ASSIGN, _ACCESS, _HEX = re.compile(ASSIGN), re.compile(ACCESS), re.compile(HEX)
_NEEDS = [re.compile(p) for p in MIXED_NEEDS]
# The same matches as in `MORE` found from their middle, since a search from each possible start is quadratic in long runs.
_SIGNED_REST = re.compile(r"\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+")
_ADDRESS_REST = re.compile(r"://[^\x20\t\r\n:/@]++:([^\x20\t\r\n:/@]{6,}+)@")
_SIGNED_BEFORE = re.compile(r"[^A-Za-z0-9_-]")
_SCHEME_BEFORE = re.compile(r"[^a-z0-9+.-]")
_LOOK = 1 << 10  # characters looked back at once


def _run_start(text: str, end: int, low: int, other: re.Pattern[str]) -> int:
    """Where the run of characters that are not `other` and that ends before `end` starts, not before `low`."""
    while end > low:
        begin = max(low, end - _LOOK)
        last = None
        for last in other.finditer(text, begin, end):
            pass
        if last is not None:
            return last.end()
        end = begin
    return low


def _signed(text: str) -> Iterator[tuple[int, int, str]]:
    """Matches of `signed`: three runs joined by dots; the first has the header of a match at its first place with 8 characters after it."""
    low = at = 0
    while m := _SIGNED_REST.search(text, at):
        start = text.find("eyJ", _run_start(text, m.start(), low, _SIGNED_BEFORE), max(0, m.start() - 8))
        if start < 0:
            at = m.start() + 1
        else:
            yield start, m.end(), text[start : m.end()]
            low = at = m.end()


def _addresses(text: str) -> Iterator[tuple[int, int, str]]:
    """Matches of `address`: from the first letter of the scheme's run."""
    low = at = 0
    while m := _ADDRESS_REST.search(text, at):
        start = _run_start(text, m.start(), low, _SCHEME_BEFORE)
        while start < m.start() and not "a" <= text[start] <= "z":
            start += 1
        if start == m.start():
            at = m.start() + 1
        else:
            yield start, m.end(), m[1]
            low = at = m.end()


def _by_pattern(pattern: re.Pattern[str]):
    return lambda text: ((m.start(), m.end(), m[0]) for m in pattern.finditer(text))


_FINDERS = [
    (k, {"signed": _signed, "address": _addresses}.get(k) or _by_pattern(re.compile(p)), HINTS[k]) for k, p in MORE.items()
]


def looks_live(value: str) -> bool:
    """Many different characters, and none of the words that mark an example."""
    low = value.translate(_LOWER)
    if any(p in low for p in PLACEHOLDERS):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= ENTROPY


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """`(kind, start, end, value)` of every match, in code points; the time grows with the length of the text."""
    out = []
    low = text.translate(_LOWER)
    if any(k in low for k in KEYWORDS):
        for m in _ASSIGN.finditer(low):
            if m.end(2) - m.start(2) >= 12:
                out.append((0, m.start(), m.end(), text[m.start(2) : m.end(2)]))
    if "AKIA" in text:
        out += [(1, m.start(), m.end(), m[0]) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(2, m.start(), m.end(), m[0]) for m in _HEX.finditer(text)]
    for kind, (name, find, hints) in enumerate(_FINDERS, len(BASE_KINDS)):
        if not hints or any(h in text for h in hints):
            hits = [(kind, *m) for m in find(text)]
            out += [h for h in hits if name != "mixed" or all(p.search(h[3]) for p in _NEEDS)]
    return sorted(out)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("live", pa.bool_())])
    for part in T.slices(batches, "text"):
        found = [
            [
                {"kind": k, "start": s, "end": e, "value": hashlib.sha256(v.encode()).hexdigest(), "live": looks_live(v)}
                for k, s, e, v in candidates(x)
            ]
            for x in part.column("text").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in ("doc_id", "owner", "repository", "text_hash")), pa.array(found, pa.list_(kind))],
            ["doc_id", "owner", "repository", "text_hash", "found"],
        )


def _text(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def ownership(found: DataFrame) -> DataFrame:
    """`value, owners, repositories` for each hashed value of `found (value, owner, repository)`.

    Distinct pairs first, then repositories per owner, then owners: each step is combined before its shuffle, so a
    value that a third of all documents hold is at most a row per task. A null owner counts as one owner."""
    pairs = found.select("value", "owner", "repository").distinct()
    each = pairs.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("value").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repositories"))


def secrets(docs: DataFrame, owner: str = "source", repository: str = "doc_id", owners: int = OWNERS) -> DataFrame:
    """One row per row of `docs`: `doc_id, text_hash, spans array<struct<kind, start, end, value, live, owners, repositories, verdict>>`.

    Values leave the text only as SHA-256. Verdicts: `copied` if at least `owners` owners hold the value, else
    `live` if it looks like a credential, else `unclear`. Where the corpus has no repositories each document is one, and its
    source is the owner. Null texts count as empty, repeated rows as one repository each time; no documents, no rows. Texts are scanned once,
    whole and in time that grows with their length, and not shuffled; spans are."""
    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(owner).cast("string").alias("owner"),
        F.col(repository).cast("string").alias("repository"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        _text(F.col("text")).alias("text"),
    )
    scanned = written(
        named.mapInArrow(_scan, f"doc_id long, owner string, repository string, text_hash long, found array<{SPAN}>").withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "candidates",
    )
    single = scanned.select("row", "doc_id", "text_hash", "owner", "repository", F.explode_outer("found").alias("f")).select(
        "row", "doc_id", "text_hash", "owner", "repository", "f.*"
    )
    wide = written(ownership(single.where("value IS NOT NULL")).where(F.col("repositories") > 1), "owners")
    salted = wide.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    # Documents without a candidate have no value; their row number keeps them from meeting in one task.
    keyed = single.withColumn("value", F.coalesce("value", F.col("row").cast("string")))
    known = keyed.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS))).join(
        salted.hint("merge"), ["value", "salt"], "left"  # as many values as the corpus has: never broadcast
    )
    held = F.coalesce("owners", F.lit(1).cast("long"))
    verdict = F.when(held >= owners, "copied").when(F.col("live"), "live").otherwise("unclear")
    span = F.struct(
        "start", "kind", "end", "value", "live",
        held.alias("owners"), F.coalesce("repositories", F.lit(1).cast("long")).alias("repositories"), verdict.alias("verdict"),
    )
    return known.groupBy("row", "doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull(), span))).alias("spans")
    ).drop("row")


def chosen(spans: Column) -> Column:
    """The base spans, and those beyond the base that look live and that few owners hold."""
    return F.filter(spans, lambda s: (s["kind"] < len(BASE_KINDS)) | (s["verdict"] == "live"))


def listed(spans: Column) -> Column:
    """`kind:start:end`, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def secret_report(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: `doc_id, n_assign, n_access, n_hex, base_sha256, spans`; see `secrets`."""
    found = secrets(docs, owner, repository)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_KINDS))
    return found.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)], F.sha2(listed(base), 256).alias("base_sha256"),
        listed(chosen(F.col("spans"))).alias("spans"),
    )


def redacted(docs: DataFrame, owner: str = "source", repository: str = "doc_id", mark: str = "[secret]") -> DataFrame:
    """`docs` with every chosen span of `text` replaced by `mark` and `n_chars` set anew; rows and columns stay.

    Spans that overlap become one mark. Only documents with a span get a new text."""
    found = secrets(docs, owner, repository).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), chosen(F.col("spans")).alias("__spans")
    ).where(F.size("__spans") > 0).dropDuplicates(["__id", "__hash"])
    text, spans = docs["text"].cast("string"), found["__spans"]
    parts = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, s: F.when(s["start"] < a["at"], F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at"))).otherwise(
            F.struct(F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark)).alias("out"), s["end"].alias("at"))
        ),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))),
    )
    same = docs["doc_id"].cast("long").eqNullSafe(found["__id"]) & (F.xxhash64(text) == found["__hash"])
    changed = {"text": F.when(spans.isNotNull(), parts).otherwise(text)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(spans.isNotNull(), F.length(parts).cast("long")).otherwise(docs["n_chars"])
    return docs.join(found, same, "left").select(*(changed[c].alias(c) if c in changed else docs[c] for c in docs.columns))
