"""Secrets in texts: fixed patterns, and stretches of high entropy per character class.

Three patterns give the base spans (:func:`base_spans`): values assigned to a telling name, access keys,
long hexadecimal runs. Beyond them, every candidate string (a long run of characters that keys are made of)
is judged by class (:data:`CLASSES`): a window slides over the candidate's runs of the class, the Shannon
entropy of what it shows is kept up by the counts of the character that enters and the one that leaves, and
windows above the class's bits that show letters and digits enough join into a span
(:func:`random_stretches`). Counts weigh in as whole numbers, so that a window's entropy does not depend on
the path to it. The allow-list (:data:`ALLOWED`, :data:`HARMLESS_BEFORE`, and the caller's patterns)
suppresses spans of the entropy windows; those of the patterns always stay.

Each text is judged alone and whole, in the task that reads it: nothing is shuffled, and rows that repeat
are each judged. Positions count code points, the end is exclusive. A NULL or empty text has no spans. All
columns go on; one that is named like the added column makes that one take a leading underscore.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.staging import fresh_name

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_LEAST = 8
# Runs of these have no shorter match inside that a search for shorter runs would take first, so the least
# length can stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
# What each assignment has in it; a text without any needs no search.
NAMES = ("passw", "secret", "token", "api")

BASE_KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class CharacterClass:
    """Characters of one kind of key, and what a window of them must show to look random."""

    kind: str
    runs: str
    bits: float
    letters: int
    digits: int
    both_cases: bool = False


WINDOW = 20
CLASSES = (
    CharacterClass("random_hex", rf"[0-9a-f]{{{WINDOW},}}|[0-9A-F]{{{WINDOW},}}", 3.0, 4, 4),
    CharacterClass("random_base36", rf"[0-9a-z]{{{WINDOW},}}|[0-9A-Z]{{{WINDOW},}}", 3.5, 4, 3),
    CharacterClass("random_base64", rf"[0-9A-Za-z+/_=-]{{{WINDOW},}}", 3.85, 4, 2, both_cases=True),
)
KINDS = (*BASE_KINDS, *[c.kind for c in CLASSES])
_CANDIDATE = re.compile(rf"[0-9A-Za-z+/_=-]{{{WINDOW},}}")
_RUNS = {c.kind: re.compile(c.runs) for c in CLASSES}
_DIGIT = re.compile("[0-9]")

# A span is no secret if its text has one of these: unique ids that are made to be public, digests of
# nothing, alphabets, stand-ins.
ALLOWED = (
    r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
    r"d41d8cd98f00b204e9800998ecf8427e|da39a3ee5e6b4b0d3255bfef95601890afd80709|e3b0c44298fc1c149afbf4c8996fb924",
    r"0123456789|123456789|abcdefghij|qwertyuiop",
    r"example|sample|dummy|placeholder|changeme|redacted|xxxx|your_?api|your_?key",
)
# Or if this stands right before it: digests and revisions name public things.
HARMLESS_BEFORE = r"(sha-?1|sha-?256|sha-?384|sha-?512|md5|checksum|digest|integrity|etag|commit|revision|uuid|guid)[\"']?[\x20:=/-]{1,3}[\"']?"
LOOK_BACK = 24

# n * log2(n) as whole numbers, for the counts a window can have.
_SCALE = 1 << 20
_WEIGHT = [0] + [round(n * log2(n) * _SCALE) for n in range(1, WINDOW + 1)]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """What the three patterns find, leftmost first and without overlaps per kind."""
    found = []
    lowered = text.lower()
    if any(name in lowered for name in NAMES):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def random_stretches(run: str, kind: CharacterClass) -> Iterator[tuple[int, int]]:
    """Where windows of a run look random; windows that touch are one stretch."""
    most = round(WINDOW * (log2(WINDOW) - kind.bits) * _SCALE)
    counts: dict[str, int] = {}
    weight = upper = lower = digits = 0
    begin = end = -1
    for at, entering in enumerate(run):
        n = counts.get(entering, 0)
        counts[entering] = n + 1
        weight += _WEIGHT[n + 1] - _WEIGHT[n]
        digits += "0" <= entering <= "9"
        upper += "A" <= entering <= "Z"
        lower += "a" <= entering <= "z"
        start = at + 1 - WINDOW
        if start < 0:
            continue
        if (
            weight <= most and digits >= kind.digits and upper + lower >= kind.letters
            and (not kind.both_cases or (upper and lower))
        ):
            if start > end:
                if begin >= 0:
                    yield begin, end
                begin = start
            end = at + 1
        leaving = run[start]
        n = counts[leaving]
        counts[leaving] = n - 1
        # The next window has one character less until the next one enters.
        weight += _WEIGHT[n - 1] - _WEIGHT[n]
        digits -= "0" <= leaving <= "9"
        upper -= "A" <= leaving <= "Z"
        lower -= "a" <= leaving <= "z"
    if begin >= 0:
        yield begin, end


class Scanner:
    """The patterns, the classes and an allow-list, ready for use in a task."""

    def __init__(self, allow: tuple[str, ...] = ()):
        self.allowed = re.compile("|".join(f"(?:{p})" for p in (*ALLOWED, *allow)), re.ASCII | re.IGNORECASE)
        self.before = re.compile(f"(?:{HARMLESS_BEFORE})$", re.ASCII | re.IGNORECASE)
        self.heading = re.compile(HARMLESS_BEFORE, re.ASCII | re.IGNORECASE)

    def suppressed(self, text: str, begin: int, end: int, candidate: tuple[int, int]) -> bool:
        """Whether the allow-list names the candidate round a span, its head, or what stands before it."""
        return bool(
            self.allowed.search(text, max(candidate[0], begin - LOOK_BACK), min(candidate[1], end + LOOK_BACK))
            or self.heading.match(text, candidate[0])
            or self.before.search(text[max(0, candidate[0] - LOOK_BACK) : candidate[0]])
            or self.before.search(text[max(0, begin - LOOK_BACK) : begin])
        )

    def entropy_spans(self, text: str, known: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Random stretches that lie in no span known already, neither the patterns' nor another class's."""
        found: list[tuple[str, int, int]] = []
        for candidate in _CANDIDATE.finditer(text):
            if not _DIGIT.search(text, *candidate.span()):
                continue
            at, to = candidate.span()
            here = [(a, b) for _, a, b in known if a < to and b > at]
            for kind in CLASSES:
                for run in _RUNS[kind.kind].finditer(text, at, to):
                    for a, b in random_stretches(run[0], kind):
                        a, b = a + run.start(), b + run.start()
                        if any(x <= a and b <= y for x, y in here) or self.suppressed(text, a, b, (at, to)):
                            continue
                        here.append((a, b))
                        found.append((kind.kind, a, b))
        return found

    def spans(self, text: str | None) -> list[tuple[str, int, int]]:
        """All spans of a text by start, then kind as listed."""
        if not text:
            return []
        known = base_spans(text)
        return sorted(known + self.entropy_spans(text, known), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def with_secrets(
    docs: DataFrame, text: str = "text", name: str = "secrets", allow: tuple[str, ...] = ()
) -> tuple[DataFrame, str]:
    """The rows with their spans, and the new column's name. ``allow`` has further regular expressions."""
    name = fresh_name(docs, name)

    def found(texts: pa.Array) -> pa.Array:
        scanner = Scanner(allow)
        return pa.array(
            [[{"kind": k, "start": a, "end": b} for k, a, b in scanner.spans(t.as_py())] for t in texts], _ARROW_SPANS
        )

    return docs.withColumn(name, F.arrow_udf(found, SPANS)(F.col(f"`{text}`"))), name


def without_secrets(docs: DataFrame, text: str = "text", mask: str = "[secret]", allow: tuple[str, ...] = ()) -> DataFrame:
    """The rows with each secret in their texts replaced; spans that overlap become one."""
    rows, name = with_secrets(docs, text, allow=allow)

    def masked(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([_masked(t, s, mask) for t, s in zip(texts.to_pylist(), spans.to_pylist(), strict=True)], pa.string())

    cleaned = F.arrow_udf(masked, "string")(F.col(f"`{text}`"), F.col(f"`{name}`"))
    return rows.withColumn(text, cleaned).drop(name)


def _masked(text: str | None, spans: list[dict], mask: str) -> str | None:
    if not spans:
        return text
    parts, at = [], 0
    for span in sorted(spans, key=lambda s: (s["start"], s["end"])):
        if span["start"] >= at:
            parts += [text[at : span["start"]], mask]
        at = max(at, span["end"])
    return "".join([*parts, text[at:]])


def of_kind(spans: str, kind: str) -> Column:
    """How many spans a row has of a kind."""
    return F.size(F.filter(F.col(f"`{spans}`"), lambda s: s["kind"] == kind)).cast("bigint")


def listed(spans: Column) -> Column:
    """The spans as text: ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secrets_report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, the patterns' counts, a digest of their spans, and all spans."""
    rows, spans = with_secrets(docs.select("doc_id", "text"))
    base = F.filter(F.col(spans), lambda s: s["kind"].isin(*BASE_KINDS))
    return rows.select(
        "doc_id",
        *[of_kind(spans, kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col(spans)).alias("spans"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return secrets_report(spark.read.parquet(f"{folder}/documents.parquet"))
