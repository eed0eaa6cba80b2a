"""Quality rules whose cutoffs are proved, on labelled holdouts, to spare good documents.

A rule rejects a document whose rate lies beyond a cutoff. Cutoffs are chosen per stratum (language)
in ever stricter levels on one half of the labelled documents; the other half, the holdout, decides
which level may be used: the share of good documents that the rules together would reject must be
at most ``RISK``, by an exact binomial test. Levels are tested from the most lenient on and the
first failure ends the sequence, so levels need no correction; strata are corrected by Bonferroni.
With probability ``1 - ERROR`` no stratum loses more than ``RISK`` of its good documents. Among
the proved levels the one of best use on the first half is taken; a stratum without a proved level
rejects nothing.

All counts are over all documents, all tests over all labelled ones. What is chosen from is, per
stratum and rule, the number of documents between ``GRID`` quantiles, whatever the corpus.

A null text has no words. A null language is a stratum of its own. Documents with several labels
take the lowest; null labels are none. Very long texts are counted whole. Of levels of equal use the
most lenient is taken. Repeated rows are judged, and counted, each. Only doc_id,
text and lang are read. No documents give no rows; no labels reject nothing beyond the base rules.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import (
    mix,
    prefix_sums,
    slices,
    substring_hash,
    texts,
    window_hashes,
    words,
)
from tidemark.sources.shared import save_shared

RISK = 0.02
ERROR = 0.05
# A good document lost weighs as much as this many bad ones kept.
COST = 5.0
# Share of the first half's good documents that each rule may reject, level by level.
LEVELS = (0.0, 0.0005, 0.001, 0.002, 0.005, 0.01)
GRID = 200

# Base rules: fewer words than this, or more than this share of them in repeated windows.
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent


# --- counts ---

SYMBOLS = b"#*$%&|<>"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
    "n_marks",
)


def _bytes(members: bytes) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(members)] = True
    return flags


_SYMBOL = _bytes(SYMBOLS)
_CAPITAL = _bytes(bytes(range(65, 91)))
_MARK = _bytes(bytes(c for c in range(33, 127) if not chr(c).isalnum()))


def _repeats(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: met twice or more in its text; the first of its kind in its text."""
    keys = mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first, inverse, count = np.unique(
        keys, return_index=True, return_inverse=True, return_counts=True
    )
    opening = np.zeros(len(keys), bool)
    opening[first] = True
    return count[inverse] > 1, opening


def _count_slice(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    n = len(offsets) - 1
    starts, ends, owner = words(data, offsets)
    sums = prefix_sums(data)
    n_words = np.bincount(owner, minlength=n)

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(flags))
        return total[offsets[1:]] - total[offsets[:-1]]

    leads = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    chars = np.bincount(owner, weights=leads[ends] - leads[starts], minlength=n).astype(np.int64)

    # Lines end at line feeds and at the ends of texts; only those with a word count.
    feeds = np.flatnonzero(data == 10)
    opens = np.unique(np.concatenate([offsets[:-1], feeds + 1]))
    opens = opens[opens < len(data)]
    closes = np.minimum(
        np.append(feeds, len(data))[np.searchsorted(feeds, opens)],
        offsets[np.searchsorted(offsets, opens, side="right")] if len(opens) else opens,
    )
    filled = np.searchsorted(starts, closes) > np.searchsorted(starts, opens)
    opens, closes = opens[filled], closes[filled]
    line_owner = np.searchsorted(offsets, opens, side="right") - 1
    line = substring_hash(sums, opens, closes) + (closes - opens).astype(np.uint64)
    _, first_line = _repeats(line, line_owner)

    windows, at = window_hashes(substring_hash(sums, starts, ends), owner, n, 3, whole=False)
    again, _ = _repeats(windows, owner[at])
    in_repeat = np.zeros(len(starts), bool)
    for j in range(3):
        in_repeat[at[again] + j] = True

    latin = np.zeros(len(data), bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] < 0x9F)
    return [
        n_words,
        chars,
        per_text(_SYMBOL[data]),
        np.bincount(line_owner[~first_line], minlength=n),
        np.bincount(owner[in_repeat], minlength=n),
        np.bincount(line_owner, minlength=n),
        per_text(_CAPITAL[data] | latin),
        per_text(_MARK[data]),
    ]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = texts(batch.column("text"))
        parts = [
            _count_slice(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            for a, b in slices(offsets)
        ]
        columns = {"doc_id": batch.column("doc_id"), "stratum": batch.column("stratum")}
        for name, arrays in zip(COUNTS, zip(*parts)):
            columns[name] = pa.array(np.concatenate(arrays), pa.int64())
        if parts:
            yield pa.RecordBatch.from_pydict(columns)


def count_text(documents: DataFrame) -> DataFrame:
    """``doc_id, stratum`` and the counts of every row."""
    schema = "doc_id long, stratum string, " + ", ".join(f"{name} long" for name in COUNTS)
    columns = documents.select(
        F.col("doc_id").cast("long"), F.coalesce("lang", F.lit("")).alias("stratum"), "text"
    )
    return columns.mapInArrow(_count, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    )


# --- rules ---


def rates() -> list[Column]:
    """Each rule rejects a rate above its cutoff; short words are a rule by their negative."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    length = F.col("word_chars") / n
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return [
        length,
        -length,
        F.col("n_symbols") / n,
        F.col("n_marks") / chars,
        F.col("n_upper") / chars,
        F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        F.col("n_repeat_words") / n,
    ]


def _choose_levels(counts: pd.DataFrame) -> pd.DataFrame:
    """Per level and rule the cutoff that catches most bad documents within the level's share of
    good ones; of equal ones the one that lies farthest from the good documents' side.

    ``counts``: per rule and grid cell the number of good and bad documents; cell i holds rates
    above grid value i - 1 and up to grid value i, the last one those above all.
    """
    found = []
    for rule, cells in counts.groupby("rule"):
        grid = np.asarray(cells["grid"].iloc[0], float)
        good, bad = np.zeros(len(grid) + 1), np.zeros(len(grid) + 1)
        np.add.at(good, cells["cell"].to_numpy(), cells["good"].to_numpy())
        np.add.at(bad, cells["cell"].to_numpy(), cells["bad"].to_numpy())
        above_good = good.sum() - np.cumsum(good)[:-1]
        above_bad = bad.sum() - np.cumsum(bad)[:-1]
        for level, share in enumerate(LEVELS):
            cutoff = math.inf
            fit = above_good <= share * good.sum()
            caught = np.where(fit, above_bad, 0)
            if caught.max(initial=0) > 0:
                best = np.flatnonzero(caught == caught.max())
                cutoff = (grid[best[0]] + grid[best[-1]]) / 2
            found.append((level, rule, cutoff))
    table = pd.DataFrame(found, columns=["level", "rule", "cutoff"])
    rows = [
        (counts["stratum"].iloc[0], level, part.sort_values("rule")["cutoff"].tolist())
        for level, part in table.groupby("level")
    ]
    return pd.DataFrame(rows, columns=["stratum", "level", "cutoffs"])


def tail(k: int, n: int, p: float) -> float:
    """Exactly the probability of at most k successes in n trials."""
    if k >= n:
        return 1.0
    i = np.arange(k)
    steps = np.log((n - i) / (i + 1)) + math.log(p / (1 - p))
    logs = n * math.log1p(-p) + np.concatenate([[0.0], np.cumsum(steps)])
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum()))


def _certify(strata: int):
    def certify(rows: pd.DataFrame) -> pd.DataFrame:
        best, use = None, 0.0
        for row in rows.sort_values("level").itertuples():
            if not row.good_holdout or tail(
                int(row.lost_holdout), int(row.good_holdout), RISK
            ) > ERROR / strata:
                break
            value = row.caught / max(row.bad, 1) - COST * row.lost / max(row.good, 1)
            if value > use:
                best, use = row, value
        if best is None:
            return rows[["stratum", "level", "cutoffs"]].head(0)
        return pd.DataFrame(
            {"stratum": [best.stratum], "level": [best.level], "cutoffs": [list(best.cutoffs)]}
        )

    return certify


def choose_cutoffs(counted: DataFrame, labels: DataFrame) -> DataFrame:
    """``stratum, level, cutoffs`` of the strata that have a proved level."""
    verdicts = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("quality")
    )
    labelled = counted.filter(~base_failed()).join(
        verdicts.filter(F.col("quality").isNotNull()), "doc_id"
    )
    labelled = save_shared(
        labelled.select(
            "stratum",
            (F.col("quality") == 1).alias("good"),
            (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0).alias("holdout"),
            F.array(*rates()).alias("rates"),
        ),
        "labelled",
    )
    first = labelled.filter(~F.col("holdout")).select(
        "stratum", "good", F.posexplode("rates").alias("rule", "rate")
    )
    steps = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    grids = first.groupBy("stratum", "rule").agg(
        F.array_distinct(F.percentile_approx("rate", steps, F.lit(10_000))).alias("grid")
    )
    cell = F.size(F.filter("grid", lambda value: value < F.col("rate")))
    cells = (
        first.join(grids, ["stratum", "rule"])
        .groupBy("stratum", "rule", cell.alias("cell"))
        .agg(
            F.first("grid").alias("grid"),
            F.sum(F.col("good").cast("long")).alias("good"),
            F.sum((~F.col("good")).cast("long")).alias("bad"),
        )
    )
    levels = save_shared(
        cells.groupBy("stratum").applyInPandas(
            _choose_levels, "stratum string, level int, cutoffs array<double>"
        ),
        "levels",
    )
    beyond = F.exists(F.arrays_zip("rates", "cutoffs"), lambda r: r["rates"] > r["cutoffs"])

    def count_if(condition: Column) -> Column:
        return F.sum(condition.cast("long"))

    good, holdout = F.col("good"), F.col("holdout")
    judged = (
        labelled.join(levels, "stratum")
        .withColumn("beyond", beyond)
        .groupBy("stratum", "level")
        .agg(
            F.first("cutoffs").alias("cutoffs"),
            count_if(good & holdout).alias("good_holdout"),
            count_if(good & holdout & F.col("beyond")).alias("lost_holdout"),
            count_if(good & ~holdout).alias("good"),
            count_if(good & ~holdout & F.col("beyond")).alias("lost"),
            count_if(~good & ~holdout).alias("bad"),
            count_if(~good & ~holdout & F.col("beyond")).alias("caught"),
        )
    )
    strata = max(1, levels.select("stratum").distinct().count())
    return judged.groupBy("stratum").applyInPandas(
        _certify(strata), "stratum string, level int, cutoffs array<double>"
    )


def judge(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The counts of every row, ``base_failed`` and ``kept``."""
    counted = save_shared(count_text(documents), "counted")
    cutoffs = save_shared(choose_cutoffs(counted, labels), "cutoffs")
    beyond = F.exists(
        F.arrays_zip(F.array(*rates()).alias("rates"), "cutoffs"),
        lambda r: r["rates"] > r["cutoffs"],
    )
    judged = counted.join(cutoffs, "stratum", "left").withColumns(
        {"base_failed": base_failed(), "rejected": F.coalesce(beyond, F.lit(False))}
    )
    return judged.select(
        "doc_id", *COUNTS[:5], "base_failed",
        (~F.col("base_failed") & ~F.col("rejected")).alias("kept"),
        *COUNTS[5:], "level",
    )
