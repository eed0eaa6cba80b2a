"""Secrets in whole texts: a trigram index says which texts a rule can match, then its expression
is run on those.

Each batch of texts gets its own inverted index of the trigrams that the rules' expressions make
mandatory. A rule's Boolean query intersects and unites the postings; only the texts that answer it
are searched. A rule without mandatory trigrams searches every text. No shuffle is needed, and a
lost task repeats its own batches.

A null text is empty and has no secrets. Spans are in code points, end exclusive, and do not cross
rows. A very long text is searched whole, in time linear in its length. Spans of equal start are in
the order of their rules. Repeated rows are searched each. An empty table gives no rows. Only doc_id
and text are read; ``redact`` keeps all columns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import released, texts
from tidemark.llm.trigrams import Postings, Query, trigram_query


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches; one whose ``group`` is shorter than ``least`` is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0

    @cached_property
    def expression(self) -> re.Pattern[str]:
        return re.compile(self.pattern, re.ASCII)

    @cached_property
    def query(self) -> Query:
        return trigram_query(self.pattern)

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [
            m.span() for m in self.expression.finditer(text)
            if m.end(self.group) - m.start(self.group) >= self.least
        ]


# The three kinds that are counted, in the order in which they are listed.
BASE = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    # A run of hex digits is matched whole, so asking for its length at once drops the same runs.
    Rule("hex", r"[0-9a-f]{16,}", least=16),
)

# Further well-known forms of credentials.
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}?-----END "
                        r"(?:[A-Z]+ )?PRIVATE KEY-----"),
    # From the start of a run only, so that a run is read once.
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("code_host", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{20,}"),
    Rule("bearer", r"(?i:bearer) [A-Za-z0-9+/_.=-]{20,}"),
    Rule("url_login", r"[a-z]{3,8}://[A-Za-z0-9_.-]+:([^\s:/@]{6,})@[A-Za-z0-9.-]+", 1, 6),
)
RULES = BASE + MORE

# Stands for a removed secret.
MASK = "[secret]"


class Scanner:
    def __init__(self, rules: Sequence[Rule]):
        self._rules = rules
        self._postings = Postings(rule.query for rule in rules)

    def scan(self, column: pa.Array) -> list[list[tuple[int, int, int]]]:
        """(start, rule number, end) of every span of every text, in that order."""
        data, offsets = texts(column)
        held = self._postings.index(data, offsets)
        raw = column.to_pylist()
        found: list[list[tuple[int, int, int]]] = [[] for _ in raw]
        for number, rule in enumerate(self._rules):
            for i in self._postings.answers(held, rule.query).nonzero()[0]:
                if raw[i]:
                    found[i] += [(start, number, end) for start, end in rule.spans(raw[i])]
        for spans in found:
            spans.sort()
        return found


def _listed(spans: list[tuple[int, int, int]], rules: Sequence[Rule]) -> str:
    return ",".join(f"{rules[number].kind}:{start}:{end}" for start, number, end in spans)


def _report(rules: Sequence[Rule]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            found = scanner.scan(batch.column("text"))
            base = [[span for span in spans if span[1] < len(BASE)] for spans in found]
            columns = {"doc_id": batch.column("doc_id")}
            for number, rule in enumerate(BASE):
                counts = [sum(span[1] == number for span in spans) for spans in base]
                columns[f"n_{rule.kind}"] = pa.array(counts, pa.int64())
            digests = [hashlib.sha256(_listed(s, rules).encode()).hexdigest() for s in base]
            columns["base_sha256"] = pa.array(digests, pa.string())
            columns["spans"] = pa.array([_listed(s, rules) for s in found], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return report


def find_secrets(documents: DataFrame, more: Sequence[Rule] = MORE) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every row."""
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _report((*BASE, *more)),
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every longest run of overlapping spans replaced by one mask."""
    parts, at, last = [], 0, -1
    for start, _, end in spans:
        if start >= last:
            parts += [text[at:start], MASK]
        at = last = max(last, end)
    return "".join(parts) + text[at:] if spans else text


def _masking(
    rules: Sequence[Rule],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in released(batches):
            column = batch.column("text")
            changed = [
                masked(text, spans) if spans else text
                for text, spans in zip(column.to_pylist(), scanner.scan(column))
            ]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(changed, pa.string()))

    return mask


def redact(documents: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents with their secrets masked; every column stays, ``n_chars`` is counted anew."""
    cleaned = documents.mapInArrow(_masking(rules), documents.schema)
    if "n_chars" not in documents.columns:
        return cleaned
    kind = documents.schema["n_chars"].dataType
    return cleaned.withColumn("n_chars", F.char_length("text").cast(kind))
