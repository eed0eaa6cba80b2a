"""Phrase collocations, counted in direct-address tiles of frequency-ranked pairs.

A phrase of k words is a pair: a phrase of k - 1 words and a word. A pass over the texts for each
length counts those pairs:

* Only pairs whose parts are frequent enough themselves can be. A filter of fixed size (``BITS``
  bits) per length tells tasks which phrases may be; what it lets through by chance is counted
  exactly and falls below the least count afterwards.
* The ``RANKED`` most frequent phrases and words have ids by falling frequency, which cut the plane
  of pairs into tiles of ``TILE`` x ``TILE`` cells. Of each buffer of pairs, tiles that many pairs
  fall into are counted directly with ``bincount``, the others as sorted coordinates. Pairs with a
  part beyond the ranks are sorted coordinates as well.
* Cells are summed by Spark, one row per task buffer and cell at most, so a pair that is everywhere
  costs a row per buffer. Frequent pairs are ranked anew for the next length.

What a task holds is bounded: two filters and rank tables, a slice of text, ``BUFFER`` pairs.

Null and empty texts have no words, a null language is ``und``. Repeated rows count each. Phrases
never cross a piece or a text; very long texts are read in slices of whole texts. Equal scores are
ordered by count and phrase, so ranks are unique. Without frequent phrases there are no rows. Only
text and lang are read. Words and phrases are known by 64-bit hashes while they are counted, pairs
by two of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import LOWER, mix, prefix_sums, ragged, slices, substring_hash, texts, words
from tidemark.llm.bitmaps import gather, perhaps
from tidemark.operators.ordering import number_rows
from tidemark.sources.shared import save_shared

LEAST = 10
LONGEST = 3
TOP = 2000
# A phrase goes if a longer one has at least this percentage of its occurrences.
INSIDE = 50

RANKED = 1 << 16
TILE = 512
# A tile with this many pairs of a buffer is counted by direct address.
DENSE = TILE * TILE // 8
BUFFER = 1 << 18
BITS = 1 << 25
_ROWS = 1 << 16
# Rows of a batch that are looked at together.
_AT_ONCE = 500

_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _ENDS.copy()
_GAP[[0x20, 0x09]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def phrase_code(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * _ODD + second)


# --- words ---


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in small batches, so that a batch of long texts is not held twice."""
    for batch in batches:
        for at in range(0, batch.num_rows, _AT_ONCE):
            yield batch.slice(at, _AT_ONCE)


def _coded(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Per slice: bytes; start, end, text number and code of every word, and whether the next word
    follows in the same piece."""
    langs = batch.column("lang").to_pylist()
    seeds = {lang: xxhash.xxh3_64_intdigest(lang) for lang in set(langs)}
    seed = np.array([seeds[lang] for lang in langs], np.uint64)
    data, offsets = texts(batch.column("text"))
    for first, last in slices(offsets):
        inner = offsets[first : last + 1]
        part = LOWER[data[inner[0] : inner[-1]]]
        starts, ends, owner = words(part, inner - inner[0], _GAP)
        codes = mix(substring_hash(prefix_sums(part), starts, ends) ^ seed[owner + first])
        n_ends = np.zeros(len(part) + 1, np.int32)
        np.cumsum(_ENDS[part], out=n_ends[1:])
        follows = np.zeros(len(codes), bool)
        follows[:-1] = (owner[1:] == owner[:-1]) & (n_ends[starts[1:]] == n_ends[ends[:-1]])
        yield part, starts, ends, owner + first, codes, follows


def _strings(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    lengths = ends - starts
    bounds = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(lengths, out=bounds[1:])
    data = part[ragged(starts, lengths)]
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data))


def _merged(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the same word put together."""
    table = pa.Table.from_batches(parts).combine_chunks()
    codes = table["code"].to_numpy()
    _, first, where = np.unique(codes, return_index=True, return_inverse=True)
    counts = np.bincount(where, weights=table["n"].to_numpy()).astype(np.int64)
    kept = table.take(pa.array(first))
    kept = kept.set_column(kept.schema.get_field_index("n"), "n", pa.array(counts))
    yield from kept.to_batches(max_chunksize=_ROWS)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: list[pa.RecordBatch] = []
    held = 0
    for batch in _parts(batches):
        langs = batch.column("lang")
        for part, starts, ends, owner, codes, _ in _coded(batch):
            found, first, n = np.unique(codes, return_index=True, return_counts=True)
            parts.append(
                pa.RecordBatch.from_pydict(
                    {
                        "lang": langs.take(pa.array(owner[first])),
                        "word": _strings(part, starts[first], ends[first]),
                        "code": pa.array(found.view(np.int64)),
                        "n": pa.array(n.astype(np.int64)),
                    }
                )
            )
            held += len(found)
            if held >= BUFFER // 4:
                yield from _merged(parts)
                parts, held = [], 0
    if held:
        yield from _merged(parts)


def word_counts(documents: DataFrame) -> DataFrame:
    """``lang, word, code, n`` of every word, rare ones too."""
    counted = documents.mapInArrow(_count_words, "lang string, word string, code long, n long")
    return counted.groupBy("lang", "word", "code").agg(F.sum("n").alias("n"))


# --- tiles ---


@dataclass(frozen=True)
class Known:
    """What tasks know of the frequent phrases of one length."""

    bitmap: np.ndarray
    # By rank, and the same sorted with the rank of each.
    codes: np.ndarray
    in_order: np.ndarray
    ranks: np.ndarray

    def frequent(self, codes: np.ndarray) -> np.ndarray:
        return perhaps(self.bitmap, codes)

    def rank(self, codes: np.ndarray) -> np.ndarray:
        """Rank of each code, -1 beyond the ranks."""
        if not len(self.codes):
            return np.full(len(codes), -1, np.int32)
        at = np.searchsorted(self.in_order, codes)
        at[at == len(self.in_order)] = 0
        return np.where(self.in_order[at] == codes, self.ranks[at], np.int32(-1))


def known(frequent: DataFrame) -> Known:
    """From a written table of ``code, n``: its filter, and the codes of the largest counts.

    Counts are first grouped by their binary logarithm in eighths, so the driver is sent only the
    groups that fit into ``RANKED`` codes together.
    """
    size = F.floor(F.log2("n") * 8)
    groups = frequent.groupBy(size.alias("size")).count().collect()
    held, least = 0, None
    for row in sorted(groups, reverse=True):
        held += row["count"]
        if held > RANKED:
            break
        least = row["size"]
    codes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if least is not None:
        top = frequent.filter(size >= least).select("code", "n").toArrow()
        codes, counts = top["code"].to_numpy().view(np.uint64), top["n"].to_numpy()
    codes = codes[np.lexsort((codes, -counts))]
    ranks = np.argsort(codes).astype(np.int32)
    return Known(gather(frequent, F.col("code"), BITS), codes, codes[ranks], ranks)


def _runs(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted coordinates with their counts."""
    if not len(first):
        return first, second, np.zeros(0, np.int64)
    order = np.argsort(phrase_code(first, second))
    first, second = first[order], second[order]
    new = np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]))
    at = np.flatnonzero(new)
    return first[at], second[at], np.diff(np.append(at, len(first)))


def tally(
    first: np.ndarray, second: np.ndarray, left: Known, right: Known
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each pair of codes once, with its count."""
    a, b = left.rank(first), right.rank(second)
    both = (a >= 0) & (b >= 0)
    found = [_runs(first[~both], second[~both])]
    a, b = a[both], b[both]
    across = RANKED // TILE
    tile = (a // TILE * across + b // TILE).astype(np.uint16)
    sizes = np.bincount(tile, minlength=across * across)
    dense = sizes >= DENSE
    inside = dense[tile]
    cells = np.sort(a[~inside].astype(np.int64) * RANKED + b[~inside])
    if len(cells):
        at = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
        counts = np.diff(np.append(at, len(cells)))
        found.append((left.codes[cells[at] // RANKED], right.codes[cells[at] % RANKED], counts))
    order = np.argsort(tile[inside], kind="stable")
    cells = (a[inside] % TILE * TILE + b[inside] % TILE)[order]
    stop = 0
    for number in np.flatnonzero(dense):
        start, stop = stop, stop + sizes[number]
        counts = np.bincount(cells[start:stop], minlength=TILE * TILE)
        at = np.flatnonzero(counts)
        found.append(
            (
                left.codes[number // across * TILE + at // TILE],
                right.codes[number % across * TILE + at % TILE],
                counts[at],
            )
        )
    return tuple(np.concatenate(parts) for parts in zip(*found))


def _pairs(
    codes: np.ndarray, follows: np.ndarray, levels: Sequence[Known]
) -> tuple[np.ndarray, np.ndarray]:
    """First and second part of every phrase of one word more than the last level's, if all shorter
    phrases in it may be frequent."""
    phrase, valid = codes, levels[0].frequent(codes)
    for length, level in enumerate(levels[1:], 2):
        n = max(len(codes) - length + 1, 0)
        phrase = phrase_code(phrase[:n], codes[length - 1 :])
        valid = valid[:n] & valid[1 : n + 1] & follows[length - 2 : length - 2 + n]
        valid[valid] = level.frequent(phrase[valid])
    k = len(levels)
    n = max(len(codes) - k, 0)
    at = np.flatnonzero(valid[:n] & valid[1 : n + 1] & follows[k - 1 : k - 1 + n])
    return phrase[at], codes[at + k]


def _count_pairs(
    levels: Sequence[Known],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        first, second = (np.concatenate(side) for side in zip(*parts))
        first, second, n = tally(first, second, levels[-1], levels[0])
        batch = pa.RecordBatch.from_pydict(
            {"first": first.view(np.int64), "second": second.view(np.int64), "n": n}
        )
        for at in range(0, len(n), _ROWS):
            yield batch.slice(at, _ROWS)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for batch in _parts(batches):
            for *_, codes, follows in _coded(batch):
                parts.append(_pairs(codes, follows, levels))
                held += len(parts[-1][0])
                if held >= BUFFER:
                    yield from rows(parts)
                    parts, held = [], 0
        if held:
            yield from rows(parts)

    return count_pairs


def _with_code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        first, second = (batch.column(side).to_numpy().view(np.uint64) for side in ("first", "second"))
        yield batch.append_column("code", pa.array(phrase_code(first, second).view(np.int64)))


# --- phrases ---


def frequent_phrases(
    documents: DataFrame, counted: DataFrame, longest: int, least: int
) -> list[DataFrame]:
    """By length ``lang, phrase, codes, code, n``, ``codes`` being those of the words."""
    single = counted.filter(F.col("n") >= least).select(
        "lang", F.col("word").alias("phrase"), F.array("code").alias("codes"), "code", "n"
    )
    tables = [save_shared(single, "phrases-1")]
    levels = [known(tables[0])]
    last = tables[0].select(
        F.col("code").alias("second"), F.col("phrase").alias("word"), F.col("codes").alias("more")
    )
    for length in range(2, longest + 1):
        cells = documents.mapInArrow(_count_pairs(levels), "first long, second long, n long")
        summed = cells.groupBy("first", "second").agg(F.sum("n").alias("n"))
        enough = summed.filter(F.col("n") >= least).mapInArrow(
            _with_code, "first long, second long, n long, code long"
        )
        pairs = save_shared(enough, f"pairs-{length}")
        heads = tables[-1].select("lang", F.col("code").alias("first"),
                                  F.col("phrase").alias("head"), "codes")
        named = pairs.join(heads, "first").join(last, "second").select(
            "lang", F.concat_ws(" ", "head", "word").alias("phrase"),
            F.concat("codes", "more").alias("codes"), "code", "n",
        )
        tables.append(save_shared(named, f"phrases-{length}"))
        if length < longest:
            levels.append(known(pairs))
    return tables


def _weakest_cuts(candidates: DataFrame, every: DataFrame) -> DataFrame:
    """Score, ``l`` and ``r`` of each candidate's lowest-scoring cut, the first of equal ones."""
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("codes") - 1)))
    cuts = cuts.withColumns(
        {
            "head": F.slice("codes", F.lit(1), F.col("k")),
            "tail": F.slice("codes", F.col("k") + 1, F.size("codes") - F.col("k")),
        }
    )
    for part, name in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(every.select(F.col("codes").alias(part), F.col("n").alias(name)), part)
    # Counts of up to 14 digits: the products have at most 37.
    exact = "cast({} as decimal(14,0))".format
    score = F.expr(
        f"cast(1000000 as decimal(7,0)) * {exact('a')} * {exact('a')}"
        f" div ({exact('l')} * {exact('r')})"
    )
    return (
        cuts.withColumn("score", score)
        .groupBy("codes", "lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("codes", "lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )


def _inner_phrases(candidates: DataFrame) -> DataFrame:
    """Per phrase of two or more words, the most occurrences of a longer candidate around it."""
    size = F.size("codes")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda n: F.transform(
                F.sequence(F.lit(1), size - n + 1), lambda at: F.slice("codes", at, n)
            ),
        )
    )
    return (
        candidates.filter(size > 2)
        .select(F.explode(inner).alias("codes"), F.col("a").alias("around"))
        .groupBy("codes")
        .agg(F.max("around").alias("around"))
    )


def collocations(
    documents: DataFrame,
    top: int = TOP,
    least: int = LEAST,
    longest: int = LONGEST,
    inside: int = INSIDE,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases of 2 to ``longest``
    words."""
    rows = documents.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    counted = save_shared(word_counts(rows), "word-counts")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    tables = frequent_phrases(rows, counted, longest, least)
    every = reduce(DataFrame.unionByName, [table.select("codes", "n") for table in tables])
    candidates = reduce(
        DataFrame.unionByName,
        [table.select("lang", "phrase", "codes", F.col("n").alias("a")) for table in tables[1:]],
    )
    around = _inner_phrases(candidates)
    left = candidates.join(around, "codes", "left").filter(
        F.col("around").isNull() | (100 * F.col("around") < inside * F.col("a"))
    )
    scored = _weakest_cuts(left.drop("around"), every)
    # Slices of the order are ranked each, so a language is never one task.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = number_rows(scored, order, ["lang"]).filter(F.col("place") < top)
    return best.join(totals, "lang").select(
        "lang", (F.col("place") + 1).cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
        "score",
    )
