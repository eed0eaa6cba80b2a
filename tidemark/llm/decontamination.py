"""Benchmark passages in documents: a prefix-filtered set join, verified word by word.

A window is ``WINDOW`` consecutive words of a benchmark item; an item of fewer words, but not none,
is one window. A document holds a window if its words stand in the document one after the other.

A document that holds a window holds all of its shingles of ``SHINGLE`` words (or of as many as the
window has). So any one of them is a prefix that suffices: shingles are ordered by how often they
occur in the documents, and only the rarest of each window is joined. The place of the shingle in
the window gives the place where the window would start in the document (positional bound), and
the window has to end within the document (length bound). What passes is compared word for word.

Two passes read the documents. The first explodes words once, keeps the occurrences of benchmark
shingles, counts them and finds the candidates; the second compares. Whatever documents are joined
with is written before, so Spark broadcasts it by its size, or splits what a hot shingle or many rows
alike bring into one partition. A document's candidates are bounded by its own words. Equal windows
of several items are one window until the end. All expressions are Spark's own.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lowering A-Z. A null text has no words. A row
is known by its doc_id and two hashes of its text; rows alike in all of them get the same answer. A
null item_id counts as an item of that (empty) name. Of equally rare shingles of a window the first
in text order, then in place, is taken. Very long texts are exploded like any other. Empty tables on
either side hit nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.shared import save_shared

WINDOW = 10
SHINGLE = 3

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(lowered, _GAPS), "")


def _runs(words: Column, width: int) -> Column:
    """Zipped columns of ``width`` consecutive words; incomplete at the end of the array."""
    shifted = [words, *(F.slice(words, i + 1, F.greatest(F.size(words) - i, F.lit(0)))
                        for i in range(1, width))]
    names = [f"w{i}" for i in range(width)]
    return F.arrays_zip(*[column.alias(name) for column, name in zip(shifted, names)])


def shingles(rows: DataFrame, keep: Sequence[str], width: int) -> DataFrame:
    """``keep``, ``at`` (from 0) and the hash ``shingle`` of every run of ``width`` words."""
    names = [f"w{i}" for i in range(width)]
    spread = rows.select(*keep, F.posexplode(_runs(F.col("words"), width)).alias("at", "run"))
    return spread.filter(F.col(f"run.w{width - 1}").isNotNull()).select(
        *keep, "at", F.xxhash64(*[F.col(f"run.{name}") for name in names]).alias("shingle")
    )


def windows_of(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct windows ``window, words, size`` and ``window, item_id`` of the items with them."""
    words = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        words_of(F.col("text")).alias("words"),
    ).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - WINDOW, F.lit(0)))
    spread = words.withColumn("start", F.explode(starts)).select(
        "item_id", F.slice("words", F.col("start") + 1, F.lit(WINDOW)).alias("words")
    )
    spread = save_shared(
        spread.select(
            F.sha2(F.array_join("words", " "), 256).alias("window"), "item_id", "words"
        ).distinct(),
        "windows",
    )
    distinct = spread.groupBy("window").agg(F.first("words").alias("words"))
    return (
        distinct.withColumn("size", F.size("words")),
        spread.select("window", "item_id").distinct(),
    )


def _candidates(documents: DataFrame, windows: DataFrame) -> DataFrame:
    """``key, start, window`` by the rarest shingle of each window, for every shingle width."""
    found = []
    for width in range(1, SHINGLE + 1):
        wide = F.col("size") >= width if width == SHINGLE else F.col("size") == width
        own = save_shared(
            shingles(windows.filter(wide), ["window", "size"], width), f"shingles-{width}"
        )
        if own.isEmpty():
            continue
        # Written first, the wanted shingles have a known size: where they are few they are
        # broadcast and no shingle of a document is shuffled; else a hot one is split by Spark.
        wanted = save_shared(own.select("shingle").distinct(), f"wanted-{width}")
        met = save_shared(
            shingles(documents, ["key", "n_words"], width).join(wanted, "shingle"), f"met-{width}"
        )
        often = met.groupBy("shingle").agg(F.count("*").alias("n"))
        rarity = F.struct(F.coalesce("n", F.lit(0)), "shingle", "at")
        prefix = save_shared(
            own.join(often, "shingle", "left")
            .groupBy("window", "size")
            .agg(F.min(rarity).alias("rarest"))
            .select("window", "size", F.col("rarest.shingle").alias("shingle"),
                    F.col("rarest.at").alias("place")),
            f"prefix-{width}",
        )
        start = F.col("at") - F.col("place")
        found.append(
            met.join(prefix, "shingle")
            .filter((start >= 0) & (start + F.col("size") <= F.col("n_words")))
            .select("key", start.alias("start"), "window")
        )
    none = documents.sparkSession.createDataFrame([], "key string, start int, window string")
    return reduce(DataFrame.unionByName, found, none)


def _covered(spans: Column) -> Column:
    """Number of positions in sorted (start, size) spans."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def add(state: Column, span: Column) -> Column:
        end = F.greatest(state["end"], span["start"] + span["size"])
        return F.struct(
            (state["n"] + end - F.greatest(state["end"], span["start"])).alias("n"),
            end.alias("end"),
        )

    return F.aggregate(spans, zero, add, lambda state: state["n"])


def row_key() -> Column:
    """What a row of documents is known by; rows alike share it."""
    return F.to_json(
        F.struct(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64(F.lit("one"), "text").alias("one"),
            F.xxhash64("text", F.lit("two")).alias("two"),
        )
    )


def keyed(documents: DataFrame) -> DataFrame:
    """The rows with ``words``, ``n_words`` and ``key``."""
    words = words_of(F.col("text"))
    return documents.select(
        row_key().alias("key"), F.col("doc_id").cast("long"), words.alias("words"),
        F.size(words).alias("n_words"),
    )


def find_passages(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Per distinct row: ``key, doc_id, n_words, n_hit, item_ids`` (sorted) and ``rows`` alike."""
    rows = keyed(documents)
    windows, owners = windows_of(items)
    windows = save_shared(windows, "distinct-windows")
    candidates = _candidates(rows.select("key", "n_words", "words"), windows)
    candidates = candidates.distinct().join(
        windows.select("window", F.col("words").alias("wanted"), "size"), "window"
    )
    per_key = save_shared(
        candidates.groupBy("key").agg(
            F.collect_list(F.struct("start", "size", "window", "wanted")).alias("candidates")
        ),
        "candidates",
    )
    held = F.array_sort(
        F.transform(
            F.filter(
                "candidates",
                lambda c: F.slice("words", c["start"] + 1, c["size"]) == c["wanted"],
            ),
            lambda c: F.struct(c["start"].alias("start"), c["size"].alias("size"),
                               c["window"].alias("window")),
        )
    )
    judged = rows.join(per_key, "key", "left").select(
        "key", "doc_id", F.col("n_words").cast("long"),
        F.coalesce(_covered(held), F.lit(0)).cast("long").alias("n_hit"),
        F.array_distinct(F.transform(held, lambda h: h["window"])).alias("held"),
    )
    judged = save_shared(judged, "judged")
    names = save_shared(
        judged.filter(F.col("n_hit") > 0)
        .select("key", F.explode("held").alias("window"))
        .distinct()
        .join(owners, "window")
        .groupBy("key")
        .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids")),
        "names",
    )
    return judged.drop("held").join(names, "key", "left").withColumn(
        "item_ids", F.coalesce("item_ids", F.array().cast("array<string>"))
    )


def decontaminate(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every row."""
    found = find_passages(documents, items)
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
