"""Secret scans: known forms, and sliding-window entropy for strings of no known form.

Known forms are key assignments, access keys and hexadecimal runs. For the rest, each candidate string (a run of the
characters that keys are written in) is cut into runs of one character class; a window slides over each run and its
Shannon entropy is kept up to date from the counts of the one character that leaves and the one that enters. Windows
at or above the class's threshold are joined to spans. An allow-list suppresses what is random in form only. The work is
linear in the text's length but for sorting its spans.

Null text is an empty text; an empty text has no spans. Repeated rows give repeated results. Spans are
``kind:start:end`` in code points, end exclusive.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnos.llm.shared import id_and_text, map_slices, rewritten

# The known forms.
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
    r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_VALUE, ACCESS_LENGTH = 12, 18
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_alnum", "entropy_base64")

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{20,}")


@dataclass(frozen=True)
class CharacterClass:
    """A class with its window length and the least entropy, in bits a character, of a suspicious window."""

    kind: str
    run: re.Pattern
    window: int
    bits: float


CLASSES = (
    CharacterClass("entropy_hex", re.compile(r"[0-9A-Fa-f]+"), 20, 3.1),
    CharacterClass("entropy_alnum", re.compile(r"[0-9A-Za-z]+"), 20, 3.7),
    CharacterClass("entropy_base64", re.compile(r"[0-9A-Za-z+/_-]+"), 24, 4.0),
)
# What is random in form only: words and names, in one case or with capitals where words begin, alone or joined by signs;
# numbers, identifiers of public kinds, dates and times.
SHORT_WORDS = "Am|An|As|At|Be|By|Do|Go|He|Id|If|In|Is|It|Me|My|No|Of|On|Or|So|To|Up|Us|We"
WORDS = rf"[a-z]*(?:[A-Z]+[a-z]{{2,}}|[A-Z]*(?:{SHORT_WORDS}))*[A-Z]*"
ALLOWED = tuple(
    re.compile(p)
    for p in (
        rf"(?:{WORDS}[+/_.=-])*{WORDS}",
        r"[0-9+/_.=-]+",
        r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
        r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9.+:Z-]+",
        rf"(?:{WORDS}[0-9]{{0,4}}[._/+=-])+[A-Za-z0-9]{{0,12}}",
    )
)
SAMPLE, SAMPLE_LENGTH = "EXAMPLE", 64  # published sample keys hold this word and are no longer


def _is_allowed(text: str) -> bool:
    return any(a.fullmatch(text) for a in ALLOWED)


def window_entropies(run: str, window: int) -> Iterator[float]:
    """Entropy of each window over ``run``, by its counts: H = log2(w) - sum(n log2 n) / w."""
    terms = [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    for i, entering in enumerate(run):
        if i >= window:
            leaving = run[i - window]
            n = counts[leaving]
            total += terms[n - 1] - terms[n]
            counts[leaving] = n - 1
        n = counts.get(entering, 0)
        total += terms[n + 1] - terms[n]
        counts[entering] = n + 1
        if i >= window - 1:
            yield math.log2(window) - total / window


def _outside(spans: list[tuple[int, int, str]], around: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Those of ``spans`` that lie in none of ``around``, by one sweep over both in order of their starts."""
    opened = iter(sorted(around))
    coming = next(opened, None)
    reach, out = -1, []  # the furthest end of spans that start no later
    for span in sorted(spans):
        while coming is not None and coming[0] <= span[0]:
            reach = max(reach, coming[1])
            coming = next(opened, None)
        if span[1] > reach:
            out.append(span)
    return out


def entropy_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of suspicious windows, of the first class only where classes overlap."""
    by_class: dict[str, list[tuple[int, int, str]]] = {c.kind: [] for c in CLASSES}
    for candidate in CANDIDATE.finditer(text):
        if _is_allowed(candidate[0]):
            continue
        for chars in CLASSES:
            out = by_class[chars.kind]
            for run in chars.run.finditer(candidate[0]):
                if len(run[0]) < chars.window or _is_allowed(run[0]) or len(run[0]) <= SAMPLE_LENGTH and SAMPLE in run[0]:
                    continue
                begin = candidate.start() + run.start()
                span = None
                for i, bits in enumerate(window_entropies(run[0], chars.window)):
                    if bits < chars.bits:
                        continue
                    start, end = begin + i, begin + i + chars.window
                    if span and start <= span[1]:
                        span = (span[0], end)
                    else:
                        if span:
                            out.append((*span, chars.kind))
                        span = (start, end)
                if span:
                    out.append((*span, chars.kind))
    kept: list[tuple[int, int, str]] = []
    for spans in by_class.values():
        kept += _outside(spans, kept)
    return kept


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def all_spans(text: str | None) -> list[tuple[int, int, str]]:
    """Known forms, and entropy spans that lie in none of them, by start and then by kind."""
    if not text:
        return []
    found = base_spans(text)
    found += _outside(entropy_spans(text), found)
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, and its spans as an array of (kind, start, end)."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [[{"kind": k, "start": s, "end": e} for s, e, k in all_spans(t)] for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span))], ["doc_id", "spans"])

    return map_slices(id_and_text(docs, id_column, text_column), work,
                      "doc_id bigint, spans array<struct<kind: string, start: bigint, end: bigint>>")


def redact(docs: DataFrame, text_column: str = "text", length_column: str = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each span, or each union of overlapping spans, replaced by ``mark``; null texts stay null."""

    def clean(text: str | None) -> str | None:
        out, at = [], 0
        for start, end, _ in all_spans(text):
            if start >= at:
                out += [text[at:start], mark]
            at = max(at, end)
        return "".join([*out, text[at:]]) if out else text

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(batch.schema.get_field_index(text_column)).to_pylist()
        return rewritten(batch, text_column, [clean(t) for t in texts], length_column)

    return map_slices(docs, work, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """The counts, the digest of the known forms and all spans as one text."""
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    text = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
    )
