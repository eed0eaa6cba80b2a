"""Personal data in whole texts: generated candidate spans, judged by boosted trees.

* Base spans (e-mail, IP address, card, phone) follow fixed forms and checks, and always stay.
* Generators propose further spans with high recall: addresses whose sign or dots are written out,
  and every row of up to ``GROUPS`` neighbouring digit groups with 7 to 19 digits. These overlap.
* Gradient boosted trees (Spark's own, fitted here) score a candidate by its form and its context.
  What the checks themselves look at (check digit, parts of an address) is no input, so the
  score carries over to forms that the base rules do not know.
* Scores are calibrated on held-out examples by isotonic regression, kind by kind; the cutoff is the
  least score whose calibrated share of true spans is at least ``SHARE``. A kind with too few
  examples to reach it adds nothing.
* Of overlapping selected spans the one of higher score stays.

Examples come from the texts. Base spans are true ones, as they stand and rewritten (without country
code, with other separators, with signs written out) in their place. Candidates that fail a check,
cut a base span short or run past it are false ones. All others are unknown: a first model takes them
for false, and those that it scores below nearly all true ones (the ``SPIES`` quantile of their
scores) are false ones for the second model, which judges. All examples count (copies of a text give
theirs once): a hash halves them, the models are fitted on one half and calibrated on the other.
Equal examples are one weighted row.

Spans are in code points, end exclusive, and do not cross rows. Null and empty texts have none.
Repeated rows are searched each. Work grows with the length of a text, not its square. Equal starts
are listed in the order of ``KINDS``. An empty table gives no rows. Of the columns only doc_id and
text are read; ``redact`` keeps all.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.shared import save_shared

# The four base kinds in the order in which they are listed.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "national_id")

SHARE = 0.95
SPIES = 0.02
LEAST_EXAMPLES = 50
GROUPS = 6
TREES, DEPTH = 15, 4
# What an example is.
TRUE, FALSE, UNKNOWN = 1.0, 0.0, 0.5
CONTEXT = 32
MASK = "[personal]"

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBER = re.compile(r"[0-9]+")
_OTHERS = re.compile(r"[^0-9]")


def _digits(text: str) -> str:
    return _OTHERS.sub("", text)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


# --- base spans ---


def _emails(text: str) -> list[tuple[int, int]]:
    """From every sign outwards, so a long run of letters costs nothing."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        # What was looked at before this sign belongs to no later match.
        last = domain.end() if domain else at + 1
        if domain:
            found.append((start, last))
        at = text.find("@", last)
    return found


def _addresses(text: str) -> list[tuple[int, int]]:
    """Numbers joined by dots, four at a time; parts above 255 are dropped."""
    found = []
    for run in _DOTTED.finditer(text):
        if run.group().count(".") < 3:
            continue
        numbers = list(_NUMBER.finditer(text, *run.span()))
        for i in range(0, len(numbers) - 3, 4):
            four = numbers[i : i + 4]
            if all(len(n := m.group().lstrip("0")) <= 3 and int(n or 0) <= 255 for m in four):
                found.append((four[0].start(), four[3].end()))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in that order."""
    found = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    found += [(a, 1, b) for a, b in _addresses(text)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _digits(m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


# --- candidates ---

_AT = re.compile(r"@|[(\[{]\x20?(?i:at)\x20?[)\]}]|\x20(?i:at)\x20")
_DOT = r"(?:\.|\x20?[(\[{]\x20?(?i:dot)\x20?[)\]}]\x20?|\x20(?i:dot)\x20)"
_WRITTEN = re.compile(rf"\x20?[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,4}}")
_GROUPED = re.compile(r"[0-9]+(?:[\x20().\-/]{1,2}[0-9]+)*")


def _kind_of(sizes: list[int], between: list[str], lead: str) -> int:
    total = sum(sizes)
    if len(sizes) == 4 and all(b == "." for b in between) and max(sizes) <= 3:
        return 1
    if sizes == [3, 2, 4] and len(set(between)) == 1:
        return 4
    if total >= 12 and "+" not in lead and not any(c in "()./" for b in between for c in b):
        return 2
    return 3


def candidates(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, kind, end), overlapping."""
    for sign in _AT.finditer(text):
        domain = _WRITTEN.match(text, sign.end())
        if domain:
            from_ = max(sign.start() - 64, 0)
            lead = text[from_ : sign.start()].rstrip(" ")
            local = _LOCAL_END.search(lead)
            if local:
                yield from_ + local.start(), 0, domain.end()
    for run in _GROUPED.finditer(text):
        if run.end() - run.start() < 7:
            continue
        numbers = [m.span() for m in _NUMBER.finditer(text, *run.span())]
        for i, (start, _) in enumerate(numbers):
            total = 0
            for j in range(i, min(i + GROUPS, len(numbers))):
                total += numbers[j][1] - numbers[j][0]
                if total > 19:
                    break
                if total < 7:
                    continue
                lead = text[max(start - 2, 0) : start]
                first = start - (lead[-1:] in ("+", "(")) - (lead == "+(")
                own = numbers[i : j + 1]
                between = [text[a[1] : b[0]] for a, b in zip(own, own[1:])]
                kind = _kind_of([b - a for a, b in own], between, lead)
                yield first, kind, own[-1][1]


_CUES = tuple(
    re.compile(words, re.ASCII | re.IGNORECASE)
    for words in (
        r"phone|tel|call|mobile|cell|fax|whatsapp|handy|m[oó]vil|appel",
        r"card|visa|credit|account|iban|karte|konto|carte|tarjeta",
        r"\bip\b|host|server|address|adresse|direcci",
        r"mail|contact|write|kontakt|correo|contacto",
        r"\bid\b|ssn|passport|social|number|nummer|num[eé]ro",
        r"price|total|year|page|order|isbn|\bno\b|version|chapter|[$€£#]",
    )
)
# Names of the inputs of a score, in order.
INPUTS = (
    *(f"is_{kind}" for kind in KINDS),
    "length", "n_digits", "n_groups", "longest", "shortest", "first", "last", "even",
    "spaces", "dashes", "dots", "brackets", "plus", "letters", "signs_written", "leading_zero",
    "distinct_digits", "before_kind", "after_kind", "digits_before", "digits_after",
    *(f"cue_{i}" for i in range(len(_CUES))),
)


def _char_kind(c: str) -> int:
    if not c or c.isspace():
        return 0
    if c.isdigit():
        return 3
    return 2 if c.isalpha() else 1


def inputs(text: str, start: int, end: int, kind: int, span: str | None = None) -> list[float]:
    """Form of a span and its context; ``span`` stands in place of what the text has there."""
    span = text[start:end] if span is None else span
    sizes = [len(m) for m in _NUMBER.findall(span)] or [0]
    digits = _digits(span)
    before, after = text[max(start - CONTEXT, 0) : start], text[end : end + CONTEXT]
    own = [float(kind == k) for k in range(len(KINDS))]
    form = [
        len(span), len(digits), len(sizes), max(sizes), min(sizes), sizes[0], sizes[-1],
        len(set(sizes)) == 1, span.count(" "), span.count("-"), span.count("."),
        span.count("(") + span.count(")"), span.startswith("+"),
        sum(c.isalpha() for c in span), kind == 0 and "@" not in span, digits.startswith("0"),
        len(set(digits)),
    ]
    context = [
        _char_kind(before[-1:]), _char_kind(after[:1]),
        sum(c.isdigit() for c in before), sum(c.isdigit() for c in after),
        *(cue.search(before) is not None for cue in _CUES),
    ]
    return own + [float(x) for x in (*form, *context)]


def _rewritten(span: str, kind: int) -> list[str]:
    """Other ways to write a true span."""
    if kind == 0:
        name, domain = span.split("@", 1)
        return [f"{name} at {domain.replace('.', ' dot ')}", f"{name}(at){domain}",
                f"{name} [at] {domain.replace('.', ' [dot] ')}"]
    digits = _digits(span)
    if kind == 2 and len(digits) == 16:
        return [sign.join(digits[i : i + 4] for i in range(0, 16, 4)) for sign in (" ", "-")]
    if kind == 3 and len(digits) >= 10:
        a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
        return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}"]
    return []


# --- the pass over the texts ---

_FOUND = (
    "row long, doc_id long, text_key string, base array<struct<start:int,kind:int,end:int>>, "
    "proposed array<struct<start:int,kind:int,end:int,inputs:array<double>>>, "
    "examples array<struct<kind:int,label:double,inputs:array<double>>>"
)
_SPAN = [("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]
_SCHEMA = pa.schema(
    [
        ("row", pa.int64()), ("doc_id", pa.int64()), ("text_key", pa.string()),
        ("base", pa.list_(pa.struct(_SPAN))),
        ("proposed", pa.list_(pa.struct([*_SPAN, ("inputs", pa.list_(pa.float64()))]))),
        ("examples", pa.list_(pa.struct([("kind", pa.int32()), ("label", pa.float64()),
                                         ("inputs", pa.list_(pa.float64()))]))),
    ]
)


def _refuted(span: str, kind: int) -> bool:
    """Whether a check speaks against a candidate of a base form."""
    digits = _digits(span)
    if kind == 1:
        return any(int(part) > 255 for part in _NUMBER.findall(span))
    if kind == 2:
        return not luhn(digits)
    return kind == 3 and span.startswith("+") and not 9 <= len(digits) <= 15


def propose(text: str) -> tuple[list, list, list]:
    """Base spans, other candidates, and examples."""
    base = base_spans(text)
    proposed, examples = [], []
    for start, kind, end in base:
        forms = [None, *_rewritten(text[start:end], kind)]
        examples += [(kind, TRUE, inputs(text, start, end, kind, form)) for form in forms]
    # Base spans of different kinds may overlap; their ends, running, are in order.
    starts = [start for start, _, _ in base]
    reach, ends = 0, []
    for _, _, end in base:
        ends.append(reach := max(reach, end))
    exact = {(start, kind, end) for start, kind, end in base}
    for start, kind, end in candidates(text):
        if (start, kind, end) in exact:
            continue
        x = inputs(text, start, end, kind)
        i = bisect_left(starts, end)
        free = not i or ends[i - 1] <= start
        unknown = free and not _refuted(text[start:end], kind)
        examples.append((kind, UNKNOWN if unknown else FALSE, x))
        if free:
            proposed.append((start, kind, end, x))
    return base, proposed, examples


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            text = text.as_py() or ""
            base, proposed, examples = propose(text)
            rows.append(
                {
                    "row": number,
                    "doc_id": doc_id,
                    "text_key": hashlib.md5(text.encode()).hexdigest(),
                    "base": [dict(zip(("start", "kind", "end"), s)) for s in base],
                    "proposed": [dict(zip(("start", "kind", "end", "inputs"), s)) for s in proposed],
                    "examples": [dict(zip(("kind", "label", "inputs"), s)) for s in examples],
                }
            )
            number += 1
        yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def search(documents: DataFrame) -> DataFrame:
    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return save_shared(rows.mapInArrow(_search, _FOUND), "personal")


# --- the model ---


@dataclass(frozen=True)
class Judge:
    model: GBTClassificationModel | None
    # By kind, the least score that is selected.
    cutoffs: dict[int, float]


def _trees(examples: DataFrame) -> GBTClassificationModel:
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=13, weightCol="n")
    return trees.fit(examples.withColumn("features", array_to_vector("inputs")))


def _score(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    scored = model.transform(rows.withColumn("features", array_to_vector("inputs")))
    return scored.withColumn("score", vector_to_array("probability")[1])


def _cutoff(scored: DataFrame) -> float | None:
    """The least score whose calibrated share of true spans is ``SHARE``, or none."""
    fitted = IsotonicRegression(featuresCol="score", labelCol="label", weightCol="n").fit(scored)
    for score, share in zip(fitted.boundaries.toArray(), fitted.predictions.toArray()):
        if share >= SHARE:
            return float(score)
    return None


def counted_examples(found: DataFrame) -> DataFrame:
    """``half, kind, label, inputs, n``: every example of a searched table, equal ones counted.

    Copies of a text give theirs once: those of the row of least number. The hash of text and place
    decides which half an example belongs to.
    """
    once = found.groupBy("text_key").agg(F.min("row").alias("row")).select("row")
    examples = found.join(once, "row", "left_semi").select(
        "text_key", F.posexplode("examples").alias("at", "x")
    )
    half = F.pmod(F.xxhash64("text_key", "at"), F.lit(2)).cast("int").alias("half")
    return examples.select(half, "x.*").groupBy("half", "kind", "label", "inputs").agg(
        F.count("*").cast("double").alias("n")
    )


def fit(found: DataFrame) -> Judge:
    """The judge from all examples of a searched table."""
    examples = save_shared(counted_examples(found), "examples")
    fitted_on, held_out = (examples.filter(F.col("half") == i) for i in (0, 1))
    for half in (fitted_on, held_out):
        if half.select(F.col("label") == TRUE).distinct().count() < 2:
            return Judge(None, {})
    first = _trees(fitted_on.withColumn("label", F.floor("label").cast("double")))
    scored = save_shared(
        _score(first, examples).select(*examples.columns, F.round("score", 6).alias("score")),
        "first-scores",
    )
    # Of rounded scores there are at most a million, however many examples.
    spies = scored.filter((F.col("half") == 1) & (F.col("label") == TRUE))
    spies = spies.groupBy("score").agg(F.sum("n").cast("long").alias("n"))
    below = spies.agg(F.percentile("score", F.lit(SPIES), F.col("n"))).scalar()
    known = (F.col("label") != UNKNOWN) | (F.col("score") < below)
    settled = scored.filter(known).withColumn("label", F.floor("label").cast("double")).drop("score")

    model = _trees(settled.filter("half = 0"))
    # Few different scores are enough to calibrate: they are rounded and counted.
    counted = save_shared(
        _score(model, settled.filter("half = 1"))
        .groupBy("kind", F.round("score", 4).alias("score"))
        .agg((F.sum(F.col("label") * F.col("n")) / F.sum("n")).alias("label"), F.sum("n").alias("n")),
        "calibration",
    )
    sizes = counted.groupBy("kind").agg(F.sum(F.col("n") * F.col("label")).alias("n")).collect()
    cutoffs = {}
    for row in sizes:
        if row["n"] >= LEAST_EXAMPLES:
            cutoff = _cutoff(counted.filter(F.col("kind") == row["kind"]))
            if cutoff is not None:
                cutoffs[row["kind"]] = cutoff
    return Judge(model, cutoffs)


# --- selection ---


def _apart(spans: list[dict]) -> list[tuple[int, int, int]]:
    """Spans of highest score that do not overlap."""
    kept: list[tuple[int, int, int]] = []
    for s in sorted(spans, key=lambda s: (-s["score"], s["start"] - s["end"], s["start"], s["kind"])):
        at = bisect_left(kept, (s["start"],))
        if (at and kept[at - 1][2] > s["start"]) or (at < len(kept) and kept[at][0] < s["end"]):
            continue
        insort(kept, (s["start"], s["kind"], s["end"]))
    return kept


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for base, more in zip(batch.column("base").to_pylist(), batch.column("more").to_pylist()):
            base = [(s["start"], s["kind"], s["end"]) for s in base]
            spans = sorted(base + _apart(more or []))
            rows.append([dict(zip(("start", "kind", "end"), span)) for span in spans])
        kept = batch.select(["doc_id", "text_key", "base"])
        yield kept.append_column("spans", pa.array(rows, pa.list_(pa.struct(_SPAN))))


def spans(documents: DataFrame) -> DataFrame:
    """``doc_id, text_key, base, spans`` of every row: base spans, and all selected ones."""
    found = search(documents)
    judge = fit(found)
    kind = "array<struct<start:int,kind:int,end:int>>"
    rows = found.select("row", "doc_id", "text_key", "base")
    if judge.model is None or not judge.cutoffs:
        return rows.select("doc_id", "text_key", "base", F.col("base").alias("spans"))
    cutoffs = F.create_map(*[F.lit(x) for pair in judge.cutoffs.items() for x in pair])
    proposed = found.select("row", F.inline("proposed")).filter(
        F.col("kind").isin(*judge.cutoffs)
    )
    taken = (
        _score(judge.model, proposed)
        .filter(F.col("score") >= cutoffs[F.col("kind")])
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "kind", "end", "score")).alias("more"))
    )
    return rows.join(taken, "row", "left").mapInArrow(
        _chosen, f"doc_id long, text_key string, base {kind}, spans {kind}"
    )


def _listed(column: str) -> F.Column:
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            column,
            lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"),
                                  s["end"].cast("string")),
        ),
        ",",
    )


def find_personal(documents: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every row."""
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}")
        for k, name in enumerate(BASE)
    ]
    return spans(documents).select(
        "doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
    )


# --- redaction ---


def masked(text: str, found: list[dict]) -> str:
    """The text with every longest run of overlapping spans replaced by one mask."""
    parts, at, last = [], 0, -1
    for s in found:
        if s["start"] >= last:
            parts += [text[at : s["start"]], MASK]
        at = last = max(last, s["end"])
    return "".join(parts) + text[at:]


def _mask(at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, found = batch.columns
            columns[at] = pa.array(
                [masked(text.as_py(), own) if own else text.as_py()
                 for text, own in zip(columns[at], found.to_pylist())],
                pa.string(),
            )
            names = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return mask


def _unused(columns: list[str], name: str) -> str:
    while name in columns:
        name += "_"
    return name


def redact(documents: DataFrame) -> DataFrame:
    """The documents with selected spans masked; every row and column stays."""
    key, found, own = (_unused(documents.columns, n) for n in ("masked_key", "found", "own_key"))
    held = (
        spans(documents).filter(F.size("spans") > 0)
        .groupBy(F.col("text_key").alias(key))
        .agg(F.any_value("spans").alias(found))
    )
    held = save_shared(held, "masks")
    rows = documents.withColumn(own, F.md5(F.col("text").cast("binary")))
    joined = rows.join(held, F.col(own) == F.col(key), "left")
    return joined.select(*[F.col(f"`{c}`") for c in documents.columns], found).mapInArrow(
        _mask(documents.columns.index("text")), documents.schema
    )
