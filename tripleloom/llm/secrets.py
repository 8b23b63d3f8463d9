"""Scan for secrets: fixed patterns, and windows of high entropy.

Besides the patterns, every run of at least WINDOW letters, digits and `+/_=-` is a candidate. It is cut at
the signs into parts. Words, numbers, words with a number, and identifiers in the 8-4-4-4-12 form are no
secrets, so that paths, addresses and slugs stay; what lies between them, signs included, is judged by its own
character class (hexadecimal, upper case or lower case with digits, or mixed). A window slides over it, whose
Shannon entropy is kept up to date by the counts of the character that enters and the one that leaves. Windows
at or over the threshold of the class join to a span `entropy`, unless the allow-list has it: spans
with a word for examples inside. What a pattern has found already is left out of a span, the rest of which
stays. The allow-list never touches the patterns' spans.

Null text counts as empty. Texts without secrets have no spans and the digest of the empty string.
Places are code points, ends exclusive. Repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripleloom.llm.common import id_and_text

#: The patterns, in the order in which spans of one start are listed.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW)
#: Bits per character that one in a hundred windows of random characters of the class falls below.
THRESHOLDS = {"hex": 2.9, "upper": 3.4, "lower": 3.4, "mixed": 3.6}
ALLOWED = re.compile(r"(?i).*(?:example|sample|placeholder|changeme).*")
PART = re.compile(r"(?<![A-Za-z0-9])(?:[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12})(?![A-Za-z0-9])|[A-Za-z0-9]+")
SEGMENT = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
#: A word of up to so many letters inside random characters, or at their ends, is one of chance.
INSIDE, AT_END = 8, 3
_SHARE = [0.0, *(c * math.log2(c) for c in range(1, WINDOW + 2))]  # one more than a window holds: a character enters before one leaves


def character_class(run: str) -> str | None:
    """The class whose threshold holds for a run without signs; None for words of one case."""
    digit, upper, lower = any(c.isdigit() for c in run), run != run.lower(), run != run.upper()
    if digit and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", run):
        return "hex"
    if digit and upper != lower:
        return "upper" if upper else "lower"
    return "mixed" if upper and lower and (digit or re.search("[a-z][A-Z]+[a-z]*[A-Z]", run)) else None


def word_like(part: str) -> bool:
    """Whether a part is words or numbers: in random characters the case or kind changes after two or three."""
    segments = len(SEGMENT.findall(part))
    cases = part != part.lower() and part != part.upper()
    return "-" in part or segments <= 2 or len(part) >= (3.5 if cases else 5) * segments


def random_stretches(run: str) -> Iterator[tuple[int, int, str | None]]:
    """(start, end, class) of what is left of a candidate without its words, if it has the length of a window."""
    parts = [(m.start(), m.end(), word_like(m.group())) for m in PART.finditer(run)]
    strange = [i for i, part in enumerate(parts) if not part[2]]
    groups: list[list[int]] = []
    for i in strange:
        inner = parts[groups[-1][1] + 1 : i] if groups else []
        if groups and all(b - a <= INSIDE and not ALLOWED.fullmatch(run[a:b]) for a, b, _ in inner):
            groups[-1][1] = i
        else:
            groups.append([i, i])
    for first, last in groups:
        kind = character_class("".join(run[a:b] for a, b, known in parts[first : last + 1] if not known))
        if first > 0 and parts[first - 1][1] - parts[first - 1][0] <= AT_END:
            first -= 1
        if last + 1 < len(parts) and parts[last + 1][1] - parts[last + 1][0] <= AT_END:
            last += 1
        start, end = parts[first][0], parts[last][1]
        if end - start >= WINDOW:
            yield start, end, kind


def dense_windows(run: str, threshold: float) -> Iterator[tuple[int, int]]:
    """(start, end) of the joined windows of `run` whose entropy is at least `threshold`."""
    counts: dict[str, int] = {}
    total = 0.0  # of c * log2(c) over the window's counts
    start = end = -1
    for i, c in enumerate(run):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += _SHARE[n + 1] - _SHARE[n]
        if i >= WINDOW:
            gone = run[i - WINDOW]
            n = counts[gone]
            counts[gone] = n - 1
            total += _SHARE[n - 1] - _SHARE[n]
        if i >= WINDOW - 1 and math.log2(WINDOW) - total / WINDOW >= threshold - 1e-9:
            first = i - WINDOW + 1
            if first > end:
                if end > 0:
                    yield start, end
                start = first
            end = i + 1
    if end > 0:
        yield start, end


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the patterns' matches."""
    lower = text.lower()
    found = []
    if any(k in lower for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def entropy_spans(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of dense windows that are not allowed, without what is inside one of the `known` spans."""
    found = []
    for m in CANDIDATE.finditer(text):
        for start, end, kind in random_stretches(m.group()):
            for a, b in dense_windows(m.group()[start:end], THRESHOLDS[kind]) if kind else ():
                a, b = a + m.start() + start, b + m.start() + start
                if ALLOWED.fullmatch(text[a:b]):
                    continue
                for s, _, e in sorted((k for k in known if k[0] < b and a < k[2]), key=lambda k: k[0]):
                    found.append((a, 3, min(s, b)))
                    a = max(a, e)
                found.append((a, 3, b))
    return [(a, k, b) for a, k, b in found if any(c.isalnum() for c in text[a:b])]


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans) of every text."""
    names = ["doc_id", "n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], [], []]
            digests, spans = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = pattern_spans(text)
                every = base + entropy_spans(text, base)
                for k, column in enumerate(counts):
                    column.append(sum(s[1] == k for s in every))
                digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
                spans.append(listed(every))
            columns = [*(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    rows = id_and_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string"
    )


def redacted(text: str | None, mark: str = "[secret]") -> str | None:
    """The text with `mark` in the place of each span; overlapping spans are one."""
    if text is None:
        return None
    base = pattern_spans(text)
    out, at = [], 0
    for a, _, b in sorted(base + entropy_spans(text, base)):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:] if out else text
