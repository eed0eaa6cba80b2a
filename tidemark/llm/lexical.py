"""Ranked lexical search: item bundles visit one term owner after the other.

Documents stand in blocks of at most ``BLOCK_DOCS`` rows and about ``BLOCK_BYTES`` of text. A term
has one posting row per block that holds it, so a term on every document is many rows of bounded
size, never one. The items are dealt into bundles of about ``BUNDLE``, and every bundle visits every
block: that is a stated query set against all rows, in blocks.

1. The items' words set bits of a filter of fixed size (``BITS`` bits). A document's words that
   hit no bit are counted only for its length; the others become postings. What the filter lets
   through by chance falls away in the join with the items' terms.
2. Terms are dealt to owners by how rare they are (``OWNERS``: shares of documents), rarest first.
3. A bundle carries its sparse accumulators (item, document, score so far) through a block's owners
   by cogroup, rarest terms first. Each owner adds its integer contributions. A document whose
   score and all that later owners can still give lie below the block's ``top``-th score so far can
   not be chosen and leaves the accumulator; ties stay, so the result is exact.
4. The last owner selects each item's ``top`` documents of the block, and the blocks' selections are
   ranked together.

Rows of one item_id are one item, whose terms are those of all its texts; a null item_id is an item
like any other. Every document row is a document of its own, those that repeat included; a null
doc_id ranks behind others of equal score, rows of equal doc_id and score in any order (their result
rows are equal). Null, empty and blank texts have no terms: such a document is not counted, such an
item has no rows. Very long texts are read in slices and are a block of their own. Without items or
documents there are no rows. Only item_id, doc_id and text are read.

Terms are known by 64-bit hashes within a block, by their text everywhere else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import LOWER, prefix_sums, slices, substring_hash, texts, words
from tidemark.llm.bitmaps import gather, perhaps
from tidemark.sources.shared import save_shared

TOP = 50
BLOCK_DOCS = 8192
BLOCK_BYTES = 32 << 20
BUNDLE = 128
BITS = 1 << 22
# An owner holds the terms in less than this share of the documents; the last one all others.
OWNERS = (0.001, 0.01, 0.1)

# Every byte that no term holds.
GAP = np.ones(256, dtype=bool)
GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_POSTINGS = (
    "block long, term string, docs binary, counts binary, most int, density double, "
    "ids array<long>, n_filled long, n_terms long"
)
_STATE = "block long, bundle int, lengths binary, items binary, docs binary, scores binary"
_FOUND = "block long, bundle int, found array<struct<item:int,at:int,score:long>>"


def _hashed(
    column: pa.Array,
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per slice: first and last text; its lowered bytes; start, end, owner, hash of every term."""
    data, offsets = texts(column)
    for first, last in slices(offsets):
        inner = offsets[first : last + 1]
        part = LOWER[data[inner[0] : inner[-1]]]
        starts, ends, owner = words(part, inner - inner[0], GAP)
        yield first, last, part, starts, ends, owner, substring_hash(
            prefix_sums(part), starts, ends
        )


# --- the filter of the items' words ---


def _item_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for *_, hashes in _hashed(batch.column("text")):
            yield pa.RecordBatch.from_pydict({"hash": np.unique(hashes).view(np.int64)})


def word_filter(items: DataFrame) -> np.ndarray:
    """A filter of the items' words: half a megabyte for any items."""
    hashes = items.select("text").mapInArrow(_item_hashes, "hash long")
    return gather(hashes, F.col("hash"), BITS)


# --- postings ---


class _Block:
    """Documents gathered by one task until the block is full."""

    def __init__(self, wanted: np.ndarray):
        self._wanted = wanted
        self._clear()
        self._number = TaskContext.get().partitionId() << 32

    def _clear(self) -> None:
        self.n_docs = self.n_bytes = 0
        self._ids, self._lengths, self._hashes, self._docs = [], [], [], []
        self._names: dict[int, str] = {}

    def add(self, ids: list, part, starts, ends, owner, hashes) -> None:
        self._lengths.append(np.bincount(owner, minlength=len(ids)))
        hit = perhaps(self._wanted, hashes)
        kept = hashes[hit]
        self._hashes.append(kept)
        self._docs.append(owner[hit] + self.n_docs)
        _, first = np.unique(kept, return_index=True)
        for h, a, b in zip(kept[first].tolist(), starts[hit][first], ends[hit][first]):
            if h not in self._names:
                self._names[h] = part[a:b].tobytes().decode()
        self._ids += ids
        self.n_docs += len(ids)
        self.n_bytes += len(part)

    def rows(self) -> pa.RecordBatch:
        """The posting rows, then one row of the block's documents; documents in doc_id order."""
        ids = self._ids
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        lengths = np.concatenate(self._lengths)[order]
        hashes, docs = np.concatenate(self._hashes), place[np.concatenate(self._docs)]
        terms, number = np.unique(hashes, return_inverse=True)
        cells, counts = np.unique(number * len(ids) + docs, return_counts=True)
        docs = cells % len(ids)
        bounds = np.searchsorted(cells, np.arange(len(terms) + 1) * len(ids))
        share = counts / lengths[docs]
        rows = [
            {
                "term": self._names[h],
                "docs": docs[a:b].astype(np.int32).tobytes(),
                "counts": counts[a:b].astype(np.int32).tobytes(),
                "most": int(counts[a:b].max()),
                "density": float(share[a:b].max()),
            }
            for h, a, b in zip(terms.tolist(), bounds[:-1], bounds[1:])
        ]
        rows.append(
            {
                "counts": lengths.astype(np.int32).tobytes(),
                "ids": [ids[i] for i in order],
                "n_filled": int((lengths > 0).sum()),
                "n_terms": int(lengths.sum()),
            }
        )
        for row in rows:
            row["block"] = self._number
        self._number += 1
        self._clear()
        return pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


_SCHEMA = pa.schema(
    [
        ("block", pa.int64()), ("term", pa.string()), ("docs", pa.binary()),
        ("counts", pa.binary()), ("most", pa.int32()), ("density", pa.float64()),
        ("ids", pa.list_(pa.int64())), ("n_filled", pa.int64()), ("n_terms", pa.int64()),
    ]
)


def _to_postings(
    wanted: np.ndarray,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def to_postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(wanted)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for first, last, part, starts, ends, owner, hashes in _hashed(batch.column("text")):
                full = block.n_bytes + len(part) > BLOCK_BYTES
                if block.n_docs and (full or block.n_docs + last - first > BLOCK_DOCS):
                    yield block.rows()
                # A slice of many short texts may itself be more than a block.
                for a in range(first, last, BLOCK_DOCS):
                    b = min(a + BLOCK_DOCS, last)
                    own = slice(*np.searchsorted(owner, [a - first, b - first]))
                    block.add(ids[a:b], part, starts[own], ends[own], owner[own] - (a - first),
                              hashes[own])
                    if b < last:
                        yield block.rows()
        if block.n_docs:
            yield block.rows()

    return to_postings


def postings(documents: DataFrame, wanted: np.ndarray) -> DataFrame:
    """Per block and term, places and counts; and per block a row of its documents (no term)."""
    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return save_shared(rows.mapInArrow(_to_postings(wanted), _POSTINGS), "postings")


# --- items and their terms ---


def _bundled(items: DataFrame, bundles: int) -> DataFrame:
    """``item_id, bundle, item``: every item's bundle and its number there."""
    ids = items.select("item_id").distinct()
    dealt = ids.withColumn("bundle", F.pmod(F.xxhash64("item_id"), F.lit(bundles)).cast("int"))
    numbers = F.row_number().over(Window.partitionBy("bundle").orderBy("item_id")) - 1
    return save_shared(dealt.withColumn("item", numbers.cast("int")), "items")


def _item_terms(items: DataFrame, bundled: DataFrame) -> DataFrame:
    lowered = F.translate("text", _UPPER, _LOWER)
    terms = items.select(
        F.col("item_id").alias("own_id"),
        F.explode(F.regexp_extract_all(lowered, F.lit(_TERM), F.lit(0))).alias("term"),
    ).distinct()
    return terms.join(bundled, F.col("own_id").eqNullSafe(F.col("item_id"))).select(
        "term", "bundle", "item"
    )


def _weighted(terms: DataFrame, posted: DataFrame, n: int, total: int) -> DataFrame:
    """Per term and bundle: owner, weight, and the bundle's items with what later owners can give.

    The most a term can give follows from its greatest count and its greatest share of a document.
    """
    per_term = posted.filter(F.col("term").isNotNull()).groupBy("term").agg(
        F.sum((F.octet_length("docs") / 4).cast("long")).alias("df"),
        F.max("most").alias("most"),
        F.max("density").alias("density"),
    )
    weight = F.floor(1000 * F.log(F.lit(2.0 * n + 2.0) / (2.0 * F.col("df") + 1.0)))
    # The length in percent is rounded down, so it may be less by 1 than in this quotient.
    least = 49 / F.col("most") + 50 * F.lit(n / max(total, 1)) / F.col("density")
    bound = F.ceil(F.col("weight") * (1e9 / (1000 + 20 * least)) * (1 + 1e-9)) + 1
    owner = sum(((F.col("df") >= F.lit(share * n)).cast("int") for share in OWNERS), F.lit(0))
    later = (
        Window.partitionBy("bundle", "item").orderBy("owner")
        .rangeBetween(1, Window.unboundedFollowing)
    )
    found = terms.join(per_term, "term").withColumns({"weight": weight, "owner": owner})
    found = found.withColumn("bound", bound)
    rest = F.coalesce(F.sum("bound").over(later), F.lit(0)).alias("rest")
    return save_shared(
        found.select("term", "bundle", "owner", "weight", "item", rest)
        .groupBy("term", "bundle", "owner", "weight")
        .agg(F.collect_list(F.struct("item", "rest")).alias("items")),
        "weights",
    )


# --- owners ---


def _ints(value, kind=np.int32) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), kind) if value.is_valid else np.zeros(0, kind)


def _accumulate(
    state: pa.Table, owned: pa.Table, n: int, total: int
) -> tuple[np.ndarray, dict[int, int]]:
    """Scores by item and document after this owner, and what later ones can add to each item."""
    lengths = _ints(state["lengths"][0]).astype(np.int64)
    places = 50 + 50 * lengths * n // max(total, 1)
    held = _ints(state["items"][0])
    wanted = [[(x["item"], x["rest"]) for x in row] for row in owned["items"].to_pylist()]
    rests = dict(pair for row in wanted for pair in row)
    width = max([*rests, *held[-1:].tolist()], default=-1) + 1
    scores = np.zeros((width, len(lengths)), np.int64)
    scores[held, _ints(state["docs"][0])] = _ints(state["scores"][0], np.int64)
    for items, weight, docs, counts in zip(
        wanted, owned["weight"].to_pylist(), owned["docs"], owned["counts"]
    ):
        docs, counts = _ints(docs), _ints(counts).astype(np.int64)
        given = weight * (10**9 * counts // (1000 * counts + 20 * places[docs]))
        for item, _ in items:
            scores[item, docs] += given
    return scores, rests


def _pass_on(n: int, total: int, top: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def pass_on(state: pa.Table, owned: pa.Table) -> pa.Table:
        if not owned.num_rows:
            return state
        scores, rests = _accumulate(state, owned, n, total)
        for item, rest in rests.items():
            row = scores[item]
            given = row[row > 0]
            if len(given) > top:
                row[row + rest < np.partition(given, -top)[-top]] = 0
        items, docs = np.nonzero(scores)
        kept = {
            "items": items.astype(np.int32).tobytes(),
            "docs": docs.astype(np.int32).tobytes(),
            "scores": scores[items, docs].tobytes(),
        }
        for name, value in kept.items():
            at = state.schema.get_field_index(name)
            state = state.set_column(at, name, pa.array([value], pa.binary()))
        return state

    return pass_on


def _select(n: int, total: int, top: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def select(state: pa.Table, owned: pa.Table) -> pa.Table:
        scores, _ = _accumulate(state, owned, n, total)
        found = []
        for item, row in enumerate(scores):
            given = np.flatnonzero(row)
            for at in given[np.argsort(-row[given], kind="stable")[:top]].tolist():
                found.append({"item": item, "at": at, "score": int(row[at])})
        kind = pa.list_(pa.struct([("item", pa.int32()), ("at", pa.int32()),
                                   ("score", pa.int64())]))
        return pa.table(
            {"block": state["block"], "bundle": state["bundle"],
             "found": pa.array([found], kind)}
        )

    return select


def search(documents: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: every item's ``top`` documents with a score above 0."""
    posted = postings(documents, word_filter(items))
    blocks = posted.filter(F.col("term").isNull())
    n, total = blocks.agg(
        F.coalesce(F.sum("n_filled"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))
    ).first()
    bundles = max(-(-items.select("item_id").distinct().count() // BUNDLE), 1)
    bundled = _bundled(items, bundles)
    weights = _weighted(_item_terms(items, bundled), posted, n, total)
    owned = save_shared(
        posted.select("block", "term", "docs", "counts")
        .join(weights, "term")
        .select("block", "bundle", "owner", "weight", "docs", "counts", "items"),
        "owned",
        by=["owner"],
    )
    numbers = F.sequence(F.lit(0), F.lit(bundles - 1))
    none = F.lit(b"")
    state = blocks.select(
        "block", F.explode(numbers).alias("bundle"), F.col("counts").alias("lengths"),
        none.alias("items"), none.alias("docs"), none.alias("scores"),
    )
    keys = ("block", "bundle")
    for owner in range(len(OWNERS) + 1):
        last = owner == len(OWNERS)
        step = _select(n, total, top) if last else _pass_on(n, total, top)
        terms = owned.filter(F.col("owner") == owner).drop("owner")
        state = state.groupBy(*keys).cogroup(terms.groupBy(*keys)).applyInArrow(
            step, _FOUND if last else _STATE
        )
    chosen = F.transform(
        "found",
        lambda x: F.struct(x["item"].alias("item"), F.col("ids")[x["at"]].alias("doc_id"),
                           x["score"].alias("score")),
    )
    best = state.join(blocks.select("block", "ids"), "block").select("bundle", F.inline(chosen))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    rank = F.row_number().over(Window.partitionBy("bundle", "item").orderBy(*order))
    return (
        best.withColumn("rank", rank).filter(F.col("rank") <= top)
        .join(bundled, ["bundle", "item"])
        .select("item_id", "rank", "doc_id", "score")
    )
