"""Near-duplicates by MinHash, with sequential Bayesian verification and an exact check.

A document's set is its distinct shingles of ``SHINGLE`` words (fewer words: all of them as one).
Equal sets are one node from the start, so copies cost nothing further. Nodes meet in buckets of
``BANDS`` bands of ``ROWS`` minimum hashes; two sets of similarity ``THRESHOLD`` share none with
probability (1 - t**4)**20, below 4e-7 at 0.85.

A candidate pair is compared by batches of hashes. With ``n`` of ``m`` hashes equal and a uniform
prior, its similarity is at least the threshold with the probability that a binomial of ``m + 1``
draws is at most ``n``; once that is below ``MISS`` the pair is dropped. Survivors are compared on
their full sets.

Buckets are not expanded into pairs:

1. Every node of a bucket is paired with the bucket's hub, the node that meets most others over all
   its buckets, in one join. A node linked to a hub takes it as its label.
2. Where a bucket's nodes have several labels, the nodes of all such buckets of one hub are a group.
   Nodes outside the group's most common label are compared with all of the group: both sides are
   cut into slices of ``SLICE`` nodes, and each pair of slices is compared in a task's memory,
   first by signature, then by full set. A link makes one label of two at once, so a pair of
   slices gives fewer links than it has nodes, and no link between components is lost.

Components follow from all links together.

Shingles are 64-bit hashes, sets compared as sorted arrays of them; texts of different words have
equal hashes with probability about 2**-64 per pair. Sets are built a second time, from the texts of
nodes that share a bucket.

A null, empty or blank text has the empty set, and is linked with nothing. The component of a node
is the least doc_id of its rows, nulls aside. Rows that repeat are copies. A very long text is hashed
in one slice of its own, its set is as large as it is. Only doc_id and text are read; no documents
give no rows.

``kept`` tells of a doc_id, which rows may share or lack. ``one_of_each_group`` chooses rows: of each
component the one of least doc_id, nulls last, and then of least text hash. Rows of one doc_id and
text are one row, blank ones too.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import (
    BLANK,
    LOWER,
    mix,
    prefix_sums,
    released,
    slices,
    substring_hash,
    texts,
    window_hashes,
    words,
)
from tidemark.llm.components import connected_components
from tidemark.sources.shared import save_shared

SHINGLE = 5
HASHES = 128
BANDS, ROWS = 20, 4
BATCH = 16
MISS = 1e-7
SLICE = 512

_RANDOM = np.random.default_rng(5)
_FACTORS = _RANDOM.integers(1, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
_OFFSETS = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64)


# --- sets and signatures ---


def shingle_sets(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per slice of texts: shingle hashes, grouped by text, and the n + 1 offsets between texts."""
    data, offsets = texts(column)
    for first, last in slices(offsets):
        inner = offsets[first : last + 1]
        part = LOWER[data[inner[0] : inner[-1]]]
        starts, ends, owner = words(part, inner - inner[0], BLANK)
        hashes = substring_hash(prefix_sums(part), starts, ends)
        found, at = window_hashes(hashes, owner, last - first, SHINGLE, whole=True)
        yield found, np.searchsorted(owner[at], np.arange(last - first + 1))


def _distinct(hashes: np.ndarray) -> np.ndarray:
    hashes = np.sort(hashes)
    return hashes[np.append(True, hashes[1:] != hashes[:-1])] if len(hashes) else hashes


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of minimum hashes per text; texts without shingles are all ones."""
    filled = np.flatnonzero(np.diff(bounds))
    found = np.full((len(bounds) - 1, HASHES), np.uint32(0xFFFFFFFF))
    if len(filled):
        for i in range(HASHES):
            values = ((hashes * _FACTORS[i] + _OFFSETS[i]) >> np.uint64(32)).astype(np.uint32)
            found[filled, i] = np.minimum.reduceat(values, bounds[filled])
    return found


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in released(batches):
        sizes, nodes, marks = [], [], []
        for hashes, bounds in shingle_sets(batch.column("text")):
            for a, b in zip(bounds[:-1], bounds[1:]):
                own = _distinct(hashes[a:b])
                sizes.append(len(own))
                nodes.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
            marks += [row.tobytes() for row in signatures(hashes, bounds)]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "text_key": batch.column("text_key"),
                "n_shingles": pa.array(sizes, pa.int64()),
                "node": pa.array(nodes, pa.binary()),
                "signature": pa.array(marks, pa.binary()),
            }
        )


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text"
    )


def describe(documents: DataFrame) -> DataFrame:
    return _keyed(documents).mapInArrow(
        _describe,
        "doc_id long, text_key long, n_shingles long, node binary, signature binary",
    )


# --- sequential verification ---


def least_matches(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """(hashes compared, equal ones needed to go on), batch by batch."""
    found = []
    for m in range(BATCH, HASHES + 1, BATCH):
        below, n = 0.0, 0
        while True:
            below += math.comb(m + 1, n) * threshold**n * (1 - threshold) ** (m + 1 - n)
            if below >= miss:
                break
            n += 1
        found.append((m, n))
    return found


# Hashes outside the bands come first: those say nothing yet of a pair that met in a band.
_ORDER = np.roll(np.arange(HASHES), -BANDS * ROWS)


def _as_matrix(column: pa.Array) -> np.ndarray:
    data, _ = texts(column)
    return np.ascontiguousarray(data).view(np.uint32).reshape(-1, HASHES)


def passing(a: np.ndarray, b: np.ndarray, needed: list[tuple[int, int]]) -> np.ndarray:
    """Which rows of two signature matrices stay candidates through all batches."""
    alive = np.arange(len(a))
    equal = np.zeros(len(a), np.int64)
    for m, n in needed:
        at = _ORDER[m - BATCH : m]
        equal[alive] += (a[alive][:, at] == b[alive][:, at]).sum(axis=1)
        alive = alive[equal[alive] >= n]
    return alive


def _band_keys(matrix: np.ndarray) -> np.ndarray:
    total = np.zeros((len(matrix), BANDS), np.uint64)
    bands = matrix[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
    for row in range(ROWS):
        total = mix(total + bands[:, :, row])
    return mix(total + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _to_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = _band_keys(_as_matrix(batch.column("signature")))
        yield pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array(keys.ravel()),
                "node": batch.column("node").take(pa.array(np.repeat(np.arange(len(keys)), BANDS))),
            }
        )


def _prune(
    needed: list[tuple[int, int]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alive = passing(_as_matrix(batch.column("a_signature")),
                            _as_matrix(batch.column("b_signature")), needed)
            yield batch.select(["a", "b"]).take(pa.array(alive))

    return prune


# --- exact verification ---


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in released(batches):
        nodes, sets = [], []
        for hashes, bounds in shingle_sets(batch.column("text")):
            for a, b in zip(bounds[:-1], bounds[1:]):
                own = _distinct(hashes[a:b])
                nodes.append(xxhash.xxh3_128_digest(own.tobytes()))
                sets.append(own.tobytes())
        yield pa.RecordBatch.from_pydict(
            {"node": pa.array(nodes, pa.binary()), "shingles": pa.array(sets, pa.binary())}
        )


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = np.sort(np.concatenate([a, b]))
    same = int((both[1:] == both[:-1]).sum())
    return 100 * same >= percent * (len(both) - same)


def _linked(
    percent: int,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                _similar(np.frombuffer(a.as_buffer(), np.uint64),
                         np.frombuffer(b.as_buffer(), np.uint64), percent)
                for a, b in zip(batch.column("a_set"), batch.column("b_set"))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return linked


def _node_sets(documents: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, shingles`` of the wanted nodes, from one text each."""
    source = nodes.join(wanted, "node").select(
        F.col("source.doc_id").alias("source_id"), F.col("source.text_key").alias("source_key")
    )
    rows = _keyed(documents)
    same = (rows["text_key"] == source["source_key"]) & rows["doc_id"].eqNullSafe(
        source["source_id"]
    )
    sets = rows.join(source, same, "left_semi").select("text").mapInArrow(
        _sets, "node binary, shingles binary"
    )
    return save_shared(sets.dropDuplicates(["node"]), "sets", compression="none")


def _links(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs of nodes ``a`` and ``b`` that are linked."""
    sized = nodes.select("node", "n_shingles", "signature")
    both = pairs
    for side in ("a", "b"):
        both = both.join(
            sized.select(F.col("node").alias(side), F.col("n_shingles").alias(f"{side}_size"),
                         F.col("signature").alias(f"{side}_signature")),
            side,
        )
    sizes = (F.col("a_size"), F.col("b_size"))
    both = both.filter(100 * F.least(*sizes) >= percent * F.greatest(*sizes))
    near = both.select("a", "b", "a_signature", "b_signature").mapInArrow(
        _prune(least_matches(percent / 100)), "a binary, b binary"
    )
    near = save_shared(near, "near")
    for side in ("a", "b"):
        near = near.join(
            sets.select(F.col("node").alias(side), F.col("shingles").alias(f"{side}_set")), side
        )
    linked = near.select("a", "b", "a_set", "b_set").mapInArrow(
        _linked(percent), "a binary, b binary"
    )
    return save_shared(linked, "links")


# --- slices of groups ---


def _compare_slices(
    needed: list[tuple[int, int]], percent: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links between the two slices of one block at a time; rows come ordered by block."""

    def block(rows: pa.Table) -> pa.RecordBatch:
        matrix = _as_matrix(rows.column("signature").combine_chunks())
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in rows.column("shingles")]
        sizes = np.array([len(s) for s in sets])
        _, root = np.unique(np.array(rows.column("root").to_pylist()), return_inverse=True)
        label = np.arange(root.max() + 1)  # of each root, as links are found
        left = rows.column("is_left").to_numpy()
        ones, others = np.flatnonzero(left), np.flatnonzero(~left)
        first, second = [], []
        for i in ones:
            js = others[label[root[others]] != label[root[i]]]
            small, large = np.minimum(sizes[js], sizes[i]), np.maximum(sizes[js], sizes[i])
            js = js[100 * small >= percent * large]
            js = js[passing(np.broadcast_to(matrix[i], (len(js), HASHES)), matrix[js], needed)]
            for j in js:
                if label[root[j]] != label[root[i]] and _similar(sets[i], sets[j], percent):
                    first.append(i)
                    second.append(j)
                    label[label == label[root[j]]] = label[root[i]]
        nodes = rows.column("node").combine_chunks()
        return pa.RecordBatch.from_pydict(
            {"a": nodes.take(pa.array(first, pa.int64())),
             "b": nodes.take(pa.array(second, pa.int64()))}
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            keys = held.column("block").to_numpy()
            bounds = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()]
            for a, b in zip(bounds, bounds[1:]):
                yield block(held.slice(a, b - a))
            held = held.slice(bounds[-1])
        if held is not None and held.num_rows:
            yield block(held)

    return compare


def _labels(links: DataFrame, met: DataFrame) -> DataFrame:
    """``node, root``: of the hubs a linked node is linked to the one that meets most, and that
    one's own label if it has one. Nodes of one label are in one component."""
    first = save_shared(
        links.join(met.withColumnRenamed("node", "b"), "b")
        .groupBy("a")
        .agg(F.max(F.struct("met", "b"))["b"].alias("root")),
        "labels",
    )
    further = first.select(F.col("a").alias("root"), F.col("root").alias("next"))
    return first.join(further, "root", "left").select(
        F.col("a").alias("node"), F.coalesce("next", "root").alias("root")
    )


def _links_between_labels(
    members: DataFrame, nodes: DataFrame, sets: DataFrame, labels: DataFrame, percent: int
) -> DataFrame:
    """Links in groups of buckets whose members have several labels."""
    rooted = members.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = save_shared(rooted, "rooted")
    unsettled = (
        rooted.groupBy("bucket")
        .agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("n"))
        .filter((F.col("least") != F.col("most")) & (F.col("n") > 2))
        .select("bucket")
    )
    placed = save_shared(
        rooted.join(unsettled, "bucket")
        .select(F.col("hub").alias("group"), "node", "root")
        .distinct(),
        "groups",
    )
    sizes = placed.groupBy("group", "root").agg(F.count("*").alias("n"))
    plans = sizes.groupBy("group").agg(
        F.max_by("root", F.struct("n", "root")).alias("largest"),
        F.sum("n").alias("n"),
        (F.sum("n") - F.max("n")).alias("outside"),
    ).select(
        "group", "largest",
        F.ceil(F.col("n") / SLICE).cast("int").alias("rights"),
        F.ceil(F.col("outside") / SLICE).cast("int").alias("lefts"),
    )
    dealt = placed.join(plans, "group").withColumn("deal", F.xxhash64("node", "group"))
    left = dealt.filter(F.col("root") != F.col("largest")).withColumns(
        {"left": F.pmod("deal", "lefts").cast("int"), "is_left": F.lit(True),
         "right": F.explode(F.sequence(F.lit(0), F.col("rights") - 1))}
    )
    right = dealt.withColumns(
        {"right": F.pmod("deal", "rights").cast("int"), "is_left": F.lit(False),
         "left": F.explode(F.sequence(F.lit(0), F.col("lefts") - 1))}
    )
    columns = ["group", "left", "right", "is_left", "node", "root"]
    blocks = (
        left.select(*columns).unionByName(right.select(*columns))
        .withColumn("block", F.xxhash64("group", "left", "right"))
        .join(nodes.select("node", "signature"), "node")
        .join(sets, "node")
        .select("block", "is_left", "node", "root", "signature", "shingles")
        .repartition("block")
        .sortWithinPartitions("block")
    )
    linked = blocks.mapInArrow(
        _compare_slices(least_matches(percent / 100), percent), "a binary, b binary"
    )
    return save_shared(linked, "more-links")


def _components(documents: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Every row's description, and ``node, least_id, source, root`` of every node."""
    rows = save_shared(describe(documents), "described")
    nodes = save_shared(
        rows.filter(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("least_id"),
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key"))
            .alias("source"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        ),
        "nodes",
    )
    members = nodes.select("node", "signature").mapInArrow(_to_bands, "bucket long, node binary")
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    members = save_shared(members.join(shared, "bucket"), "members")
    met = save_shared(members.groupBy("node").agg(F.sum("n").alias("met")), "met")
    hubs = (
        members.join(met, "node")
        .groupBy("bucket")
        .agg(F.max(F.struct("met", "node"))["node"].alias("hub"))
    )
    members = save_shared(members.join(hubs, "bucket").select("bucket", "node", "hub"), "hubs")
    sets = _node_sets(documents, nodes, met.select("node"))
    pairs = members.filter(F.col("node") != F.col("hub")).select(
        F.col("node").alias("a"), F.col("hub").alias("b")
    )
    links = _links(pairs.distinct(), nodes, sets, percent)
    more = _links_between_labels(members, nodes, sets, _labels(links, met), percent)
    roots = connected_components(links.unionByName(more))
    placed = nodes.select("node", "least_id", "source").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    return rows, placed


def near_duplicates(documents: DataFrame, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row; links from ``percent`` on."""
    rows, placed = _components(documents, percent)
    leaders = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    placed = placed.join(leaders, "root").select("node", "component_id")
    component = F.coalesce("component_id", "doc_id")
    return rows.select("doc_id", "n_shingles", "node").join(placed, "node", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def one_of_each_group(documents: DataFrame, percent: int = 85) -> DataFrame:
    """The documents without near-duplicates: one row of each component, all columns."""
    rows, placed = _components(documents, percent)
    key = ("no_id", "id", "text_key")

    def keyed(frame: DataFrame) -> DataFrame:
        doc_id = F.col("doc_id").cast("long")
        return frame.withColumns({"no_id": doc_id.isNull(), "id": F.coalesce(doc_id, F.lit(0))})

    first = placed.groupBy("root").agg(F.min("source").alias("source")).select("source.*")
    blank = rows.filter(F.col("node").isNull())
    chosen = first.select("doc_id", "text_key").unionByName(blank.select("doc_id", "text_key"))
    chosen = keyed(chosen).select(*key).distinct()
    # Which of the rows of one key stays does not depend on their order. Maps have no hash.
    ties = [f.name for f in documents.schema if "map<" not in f.dataType.simpleString()]
    single = keyed(
        documents.select(
            "doc_id",
            F.xxhash64("text").alias("text_key"),
            F.xxhash64(*[F.col(f"`{name}`") for name in ties]).alias("tie"),
            F.struct(*[F.col(f"`{name}`") for name in documents.columns]).alias("row"),
        )
    )
    alike = Window.partitionBy(*key).orderBy("tie")
    single = single.withColumn("place", F.row_number().over(alike)).filter(F.col("place") == 1)
    return single.join(chosen, list(key)).select("row.*")
