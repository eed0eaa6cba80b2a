"""Repeated passages by a distributed merge sort of suffixes, and texts without them.

Every byte covered by a string of ``WIDTH`` bytes that also starts anywhere else is removed. Not all
suffixes are sorted: of the ``WIDTH - SEED + 1`` seeds of ``SEED`` bytes in a window the one of least
hash is its anchor, which depends on the window's bytes alone, so equal windows have equal anchors
at equal places. Consecutive windows with one anchor form a segment; a window is repeated exactly
if another segment has the same bytes left and right of its anchor. About one suffix in 85 is an
anchor.

1. Each batch finds its segments. Equal segments of a batch are repeated at once; one of them goes
   on. So a passage that stands everywhere is one row per batch from here.
2. One shuffle by seed: segments whose seed occurs only once cannot be repeated and end here. A seed
   of more than ``HOT_SEGMENTS`` is hot; its segments are marked and go by their windows instead.
3. The others meet their texts. Each task sorts its segments' strings, the bytes from the anchor on
   and then those before it, last first; and front-codes the sorted run into blocks by bucket, a
   hash of the seed.
4. One shuffle of blocks by bucket. Runs are merged by a loser tree that never compares a known
   prefix again, which also gives the prefix each suffix shares with its neighbour. For each place
   of the anchor in a window, suffixes that share the right part and the left part are found by
   numbering both orders; two with the same numbers are the same window. Each window of a hot
   segment is a row of the same shuffle, dealt by its own 128-bit hash: equal strings of a run are
   one before, and equal windows of up to ``HOT_WINDOWS`` are one or two rows. So a line in a third
   of all texts, with other text around it, is spread over all tasks.
5. Spans go back to their texts by one more join.

Texts are known by a 64-bit hash; equal texts have equal spans and share them. Segments are compared
byte by byte, hot ones by the hashes of their windows. A null text is empty; texts shorter than ``WIDTH`` lose nothing. Rows that repeat are
texts of their own, so what they share is removed from each. Only doc_id and text are read; doc_id
may be null. A very long text is searched in overlapping stretches. Of repeated passages no occurrence is
preferred: all lose the passage. No documents give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import (
    _INVERSE,
    mix,
    powers,
    prefix_sums,
    slices,
    substring_hash,
    texts,
)
from tidemark.llm.suffix_merge import merge_runs, pack_run, unpack_run
from tidemark.sources.shared import save_shared

WIDTH = 200
SEED = 32
_SEEDS = WIDTH - SEED + 1

# Bytes looked at together where one text is longer; places within fit 24 bits.
_STRETCH = 1 << 22
_PLACE = np.uint64((1 << 24) - 1)

# Bytes of text per sorted run, and per bucket.
RUN_BYTES = 32 << 20
BUCKET_BYTES = 16 << 20

# Segments that one seed may have in a bucket, and windows of hot segments made one in memory.
HOT_SEGMENTS = 8192
HOT_WINDOWS = 1 << 17

_SINGLE, _SPAN, _COVERED = 0, 1, 2
_HOT = 4  # added to the kind of a segment


# --- segments ---


def _segments_of(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Seed hash, anchor, first and last window, text number and content hash of each segment."""
    if len(data) < WIDTH:
        return [np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 4, np.zeros(0, np.uint64)]
    sums = prefix_sums(data)
    n = len(data) - SEED + 1
    seeds = mix((sums[SEED:] - sums[:n]) * powers(_INVERSE, len(sums))[:n])
    best = (seeds & ~_PLACE) | np.arange(n, dtype=np.uint64)
    width = 1
    while 2 * width <= _SEEDS:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    rest = _SEEDS - width
    if rest:
        best = np.minimum(best[:-rest], best[rest:])
    window = np.arange(len(best))
    owner = np.searchsorted(offsets, window, side="right") - 1
    inside = window + WIDTH <= offsets[owner + 1]
    window, owner = window[inside], owner[inside]
    anchor = (best[inside] & _PLACE).astype(np.int64)
    first = np.flatnonzero(
        np.append(True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]))[: len(anchor)]
    )
    last = np.append(first[1:], len(anchor))[: len(first)] - 1
    at, low, high = anchor[first], window[first], window[last]
    left, right = substring_hash(sums, low, at), substring_hash(sums, at, high + WIDTH)
    content = mix(left + mix(right + (at - low).astype(np.uint64)))
    return [seeds[at], at, low, high, owner[first], content]


def segments(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """As :func:`_segments_of`; places count from the start of their text."""
    found = []
    for a, b in slices(offsets):
        inner = offsets[a : b + 1]
        for start in range(inner[0], max(inner[-1] - WIDTH, inner[0]) + 1, _STRETCH):
            end = min(start + _STRETCH + WIDTH - 1, inner[-1])
            bounds = np.clip(inner, start, end) - start
            seed, at, low, high, owner, content = _segments_of(data[start:end], bounds)
            owner = owner + a
            back = start - offsets[owner]
            found.append([seed, at + back, low + back, high + back, owner, content])
    return [np.concatenate(column) for column in zip(*found)] if found else _segments_of(
        np.zeros(0, np.uint8), np.zeros(1, np.int64)
    )


def text_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    raw, bounds = memoryview(np.ascontiguousarray(data)), offsets.tolist()
    keys = [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(bounds, bounds[1:])]
    return np.array(keys, np.uint64).view(np.int64)


def _merged(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans sorted by (owner, start) with those that overlap or touch made one."""
    if not len(owner):
        return owner, start, end
    # Ends never fall within an owner: push owners apart, take running maxima, pull back.
    apart = int(end.max()) + 2
    reach = np.maximum.accumulate(end + owner * apart) - owner * apart
    opens = np.append(True, (owner[1:] != owner[:-1]) | (start[1:] > reach[:-1]))
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(owner)) - 1
    return owner[first], start[first], reach[last]


def _rows(seed, owner, item, kind) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "seed": pa.array(np.asarray(seed).view(np.int64)),
            "owner": pa.array(owner, pa.int64()),
            "item": pa.array(item, pa.int64()),
            "kind": pa.array(np.full(len(owner), kind), pa.int8()),
        }
    )


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = texts(batch.column("text"))
        keys = text_keys(data, offsets)
        seed, at, low, high, text, content = segments(data, offsets)
        item = (at << 16) | ((at - low) << 8) | (at - high)
        _, first, inverse, count = np.unique(
            content, return_index=True, return_inverse=True, return_counts=True
        )
        twin = count[inverse] > 1
        spans = _merged(text[twin], low[twin], high[twin] + WIDTH)
        yield _rows(keys[spans[0]], keys[spans[0]], (spans[1] << 32) | spans[2], _SPAN)
        for kind, chosen in ((_SINGLE, first[count == 1]), (_COVERED, first[count > 1])):
            yield _rows(seed[chosen], keys[text[chosen]], item[chosen], kind)


def _shared_seeds(
    most: int,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Spans, and segments whose seed has another segment; rows come ordered by seed.

    Segments of a seed that has more than ``most`` are marked as hot and not held.
    """

    def shared_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # of the last seed, which may have more
        hot: int | None = None  # the last seed, if it is known to be hot

        def chosen(table: pa.Table, count: np.ndarray, is_hot: np.ndarray) -> Iterator[pa.RecordBatch]:
            again = np.repeat((count > 1) | is_hot, count)
            kind = table.column("kind").to_numpy() + np.repeat(is_hot, count) * np.int8(_HOT)
            kept = table.select(["owner", "item"]).append_column("kind", pa.array(kind, pa.int8()))
            yield from kept.filter(pa.array(again)).combine_chunks().to_batches()

        for batch in batches:
            is_span = pa.array(batch.column("kind").to_numpy() == _SPAN)
            yield batch.select(["owner", "item", "kind"]).filter(is_span)
            found = pa.Table.from_batches([batch.filter(pc.invert(is_span))])
            table = found if held is None else pa.concat_tables([held, found])
            seed = table.column("seed").to_numpy()
            if not len(seed):
                continue
            bounds = np.flatnonzero(np.concatenate([[True], seed[1:] != seed[:-1], [True]]))
            count = np.diff(bounds)
            is_hot = (count > most) | (seed[bounds[:-1]] == hot if hot is not None else False)
            hot = int(seed[-1]) if is_hot[-1] else None
            known = len(count) if is_hot[-1] else len(count) - 1
            yield from chosen(table.slice(0, bounds[known]), count[:known], is_hot[:known])
            held = table.slice(bounds[known])
        if held is not None and held.num_rows:
            yield from chosen(held, np.array([held.num_rows]), np.array([False]))

    return shared_seeds


# --- runs ---


def _pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compress = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        data, offsets = texts(batch.column("text"))
        raw, bounds = memoryview(np.ascontiguousarray(data)), offsets.tolist()
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "owner": pa.array(text_keys(data, offsets)),
                "packed": pa.array(
                    [compress(raw[a:b]) for a, b in zip(bounds, bounds[1:])], pa.binary()
                ),
            }
        )


def packed_texts(documents: DataFrame) -> DataFrame:
    columns = documents.select(F.col("doc_id").cast("long"), "text")
    return columns.mapInArrow(_pack_texts, "doc_id long, owner long, packed binary")


class _Run:
    """Segments of some texts, as strings to sort."""

    def __init__(self):
        self.entries: dict[tuple[bytes, int], list[tuple[int, int, int]]] = {}
        self.hot: dict[tuple[bytes, int], list[tuple[int, int, int]]] = {}
        self.size = 0

    def add(self, text: bytes, owner: int, items: list[tuple[int, int]]) -> None:
        self.size += len(text)
        for kind, item in items:
            at = item >> 16
            low, end = at - (item >> 8 & 255), at - (item & 255) + WIDTH
            if end > len(text):
                continue  # another text's, under an equal hash
            key = (text[at:end] + text[low:at][::-1], end - at)
            entries = self.hot if kind & _HOT else self.entries
            entries.setdefault(key, []).append((owner, item, kind & ~_HOT))

    def blocks(self, buckets: int) -> Iterator[tuple[int, bytes]]:
        dealt: dict[int, list] = {}
        for key in sorted(self.entries):
            bucket = xxhash.xxh3_64_intdigest(key[0][:SEED]) % buckets
            dealt.setdefault(bucket, []).append(key)
        for bucket, keys in dealt.items():
            refs = [self.entries[key] for key in keys]
            flat = [ref for own in refs for ref in own]
            fields = {
                "right": np.array([right for _, right in keys], np.uint8),
                "refs": np.array([len(own) for own in refs], np.int64),
                "owner": np.array([ref[0] for ref in flat], np.int64),
                "item": np.array([ref[1] for ref in flat], np.int64),
                "kind": np.array([ref[2] for ref in flat], np.int8),
            }
            yield bucket, pack_run([string for string, _ in keys], fields)

    def windows(self) -> Iterator[tuple[list[tuple[int, int]], dict[bytes, list]]]:
        """Spans of hot segments found to be repeated here, and windows of hot segments by hash:
        owner and span of one, and whether it is known to be repeated."""
        spans: list[tuple[int, int]] = []
        windows: dict[bytes, list] = {}
        for key in sorted(self.hot):
            string, right = key
            refs = self.hot[key]
            repeated = len(refs) > 1 or any(kind == _COVERED for _, _, kind in refs)
            if repeated:
                spans += [((owner, ((item >> 16) - (item >> 8 & 255) << 32)
                            | ((item >> 16) - (item & 255) + WIDTH))) for owner, item, _ in refs]
            owner, item, _ = refs[0]
            low = (item >> 16) - (item >> 8 & 255)
            body = string[right:][::-1] + string[:right]
            for i in range(len(body) - WIDTH + 1):
                span = (low + i << 32) | (low + i + WIDTH)
                name = xxhash.xxh3_128_digest(body[i : i + WIDTH])
                other = windows.get(name)
                if other is None:
                    windows[name] = [owner, span, repeated]
                else:
                    other[2] = True
                    spans.append((owner, span))
            if len(windows) >= HOT_WINDOWS:
                yield spans, windows
                spans, windows = [], {}
        if spans or windows:
            yield spans, windows


def _joined(owner: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owners and spans with those that overlap or touch made one."""
    order = np.lexsort((item, owner))
    # Owners are numbered for the merge, as hashes are too large to be pushed apart.
    names, number = np.unique(owner[order], return_inverse=True)
    number, start, end = _merged(number, item[order] >> 32, item[order] & 0xFFFFFFFF)
    return names[number], (start << 32) | end


def _to_blocks(
    buckets: int,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(bucket, block: list, owner, item, window=None) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array(bucket, pa.int64()), "block": pa.array(block, pa.binary()),
                "owner": pa.array(owner, pa.int64()), "item": pa.array(item, pa.int64()),
                "window": pa.array([None] * len(block) if window is None else window, pa.int64()),
            }
        )

    def hot_rows(spans: list[tuple[int, int]], windows: dict[bytes, list]) -> Iterator[pa.RecordBatch]:
        if spans:
            owner, item = _joined(*np.array(spans, np.int64).T)
            yield rows(owner % buckets, [None] * len(owner), owner, item)
        # A window known to be repeated is there twice, so it is found with any other.
        twice = np.array([1 + repeated for _, _, repeated in windows.values()])
        names = np.repeat(np.frombuffer(b"".join(windows), np.int64).reshape(-1, 2), twice, axis=0)
        places = np.array([ref[:2] for ref in windows.values()], np.int64)
        places = np.repeat(places.reshape(-1, 2), twice, axis=0)
        for a in range(0, len(names), 10_000):
            name, place = names[a : a + 10_000], places[a : a + 10_000]
            yield rows(name[:, 0], [None] * len(name), place[:, 0], place[:, 1], name[:, 1])

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        run = _Run()

        def flush() -> Iterator[pa.RecordBatch]:
            for bucket, block in run.blocks(buckets):
                yield rows([bucket], [block], [None], [None])
            for spans, windows in run.windows():
                yield from hot_rows(spans, windows)

        for batch in batches:
            for owner, packed, kinds, items in zip(
                batch.column("owner").to_pylist(), batch.column("packed"),
                batch.column("kinds").to_pylist(), batch.column("items").to_pylist(),
            ):
                spans = [i for k, i in zip(kinds, items) if k == _SPAN]
                if spans:
                    n = len(spans)
                    yield rows([owner % buckets] * n, [None] * n, [owner] * n, spans)
                found = [(k, i) for k, i in zip(kinds, items) if k != _SPAN]
                if found:
                    run.add(unpack(packed.as_buffer()), owner, found)
                if run.size >= RUN_BYTES:
                    yield from flush()
                    run = _Run()
        yield from flush()

    return to_blocks


# --- merging ---


def _repeated_windows(
    right: np.ndarray, left: np.ndarray, right_shared: np.ndarray, left_order: np.ndarray,
    left_shared: np.ndarray,
) -> np.ndarray:
    """Flags: for each place of the anchor in a window, the strings whose window is repeated.

    Strings are in right order. A window with ``o`` bytes before its anchor is the same for two
    strings that share ``o`` bytes to the left and ``WIDTH - o`` to the right.
    """
    n = len(right)
    flags = np.zeros((_SEEDS, n), bool)
    left_number = np.empty(n, np.int64)
    for o in range(_SEEDS):
        able = np.flatnonzero((left >= o) & (right >= WIDTH - o))
        if len(able) < 2:
            continue
        left_number[left_order] = np.cumsum(left_shared < o)
        number = left_number[able] * n + np.cumsum(right_shared < WIDTH - o)[able] - 1
        order = np.argsort(number, kind="stable")
        equal = number[order][1:] == number[order][:-1]
        flags[o, able[order[1:][equal]]] = True
        flags[o, able[order[:-1][equal]]] = True
    return flags


def _merge_bucket(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Owners and spans of all repeated windows of a bucket."""
    unpacked = [unpack_run(block) for block in blocks]
    run, place, shared = merge_runs([(strings, prefix) for strings, prefix, _ in unpacked])
    strings = [unpacked[r][0][p] for r, p in zip(run, place)]
    before = np.cumsum([0] + [len(u[0]) for u in unpacked])
    entry = before[run] + np.array(place)
    fields = {name: np.concatenate([u[2][name] for u in unpacked])
              for name in ("right", "refs", "owner", "item", "kind")}
    right, refs = fields["right"][entry].astype(np.int64), fields["refs"][entry]
    first_ref = (np.cumsum(fields["refs"]) - fields["refs"])[entry]
    covered = np.add.reduceat(fields["kind"] == _COVERED, np.cumsum(fields["refs"]) - fields["refs"])
    known = (refs > 1) | (covered[entry] > 0)

    length, shared = np.array([len(s) for s in strings]), np.array(shared)
    same = np.append(False, (shared[1:] == length[1:]) & (shared[1:] == length[:-1])
                     & (right[1:] == right[:-1]))
    kind = np.cumsum(~same) - 1  # number of the distinct string
    whole = (np.bincount(kind) > 1) | (np.bincount(kind, weights=known) > 0)

    owners, spans = [], []

    def emit(ref: np.ndarray, before_anchor: np.ndarray, after: np.ndarray) -> None:
        """Spans from ``before_anchor`` bytes before to ``after`` bytes behind the anchor."""
        at = fields["item"][ref] >> 16
        owners.append(fields["owner"][ref])
        spans.append(((at - before_anchor) << 32) | (at + after))

    resolved = np.flatnonzero(whole[kind])
    ref = np.repeat(first_ref[resolved] - np.append(0, np.cumsum(refs[resolved]))[:-1],
                    refs[resolved]) + np.arange(int(refs[resolved].sum()))
    ref = ref[fields["kind"][ref] != _COVERED]
    item = fields["item"][ref]
    emit(ref, item >> 8 & 255, WIDTH - (item & 255))

    # One of each distinct string, in seeds that have an unresolved one and another.
    head = np.flatnonzero(~same)
    seed = np.cumsum(shared[head] < SEED) - 1
    wanted = (np.bincount(seed) > 1) & (np.bincount(seed, weights=~whole) > 0)
    chosen = wanted[seed]
    head, seed = head[chosen], seed[chosen]
    if len(head):
        width = _SEEDS - 1
        left = (length - right)[head]
        lefts = [strings[i][right[i]:].ljust(width, b"\0") for i in head]
        order = np.array(sorted(range(len(head)), key=lambda i: (seed[i], lefts[i])))
        table = np.frombuffer(b"".join(lefts[i] for i in order), np.uint8).reshape(-1, width)
        differ = table[1:] != table[:-1]
        left_shared = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        left_shared = np.where(seed[order][1:] != seed[order][:-1], -1, left_shared)
        flags = _repeated_windows(
            right[head], left, shared[head], order, np.append(-1, left_shared)
        )
        flags[:, whole[kind[head]]] = False
        edge = np.zeros((1, len(head)), bool)
        steps = np.diff(np.concatenate([edge, flags, edge]).astype(np.int8), axis=0)
        string, low = np.nonzero(steps.T == 1)
        _, high = np.nonzero(steps.T == -1)
        emit(first_ref[head[string]], high - 1, WIDTH - low)
    return np.concatenate(owners), np.concatenate(spans)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans as they come, those of each bucket's blocks, and windows of hot segments that stand
    more than once; rows come ordered by bucket and window."""
    bucket, blocks = None, []
    last = np.zeros((0, 4), np.int64)  # the last window, which the next batch may repeat

    def rows(owner: np.ndarray, item: np.ndarray) -> pa.RecordBatch:
        owner, item = _joined(owner, item)
        return pa.RecordBatch.from_pydict({"owner": pa.array(owner), "item": pa.array(item)})

    for batch in batches:
        is_window = batch.column("window").is_valid()
        is_span = pc.and_(pc.invert(is_window), batch.column("block").is_null())
        spans = batch.filter(is_span).select(["owner", "item"])
        if spans.num_rows:
            yield spans
        windows = batch.filter(is_window)
        if windows.num_rows:
            names = ("bucket", "window", "owner", "item")
            table = np.concatenate([last, np.stack([windows.column(n).to_numpy() for n in names], 1)])
            equal = (table[1:, :2] == table[:-1, :2]).all(axis=1)
            again = np.append(equal, False) | np.append(False, equal)
            yield rows(table[again, 2], table[again, 3])
            last = table[-1:]
        stored = batch.filter(batch.column("block").is_valid())
        for number, block in zip(stored.column("bucket").to_pylist(), stored.column("block")):
            if number != bucket and blocks:
                yield rows(*_merge_bucket(blocks))
                blocks = []
            bucket = number
            blocks.append(block.as_py())
    if blocks:
        yield rows(*_merge_bucket(blocks))


def repeated_spans(documents: DataFrame, hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """``owner, item`` of a written table: text hash and span (start << 32 | end)."""
    size = documents.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    found = documents.select("text").mapInArrow(
        _find, "seed long, owner long, item long, kind tinyint"
    )
    shared = found.repartition("seed").sortWithinPartitions("seed").mapInArrow(
        _shared_seeds(hot_segments), "owner long, item long, kind tinyint"
    )
    per_text = shared.groupBy("owner").agg(
        F.collect_set(F.struct("kind", "item")).alias("found")
    )
    joined = packed_texts(documents).join(per_text, "owner").select(
        "owner", "packed", F.col("found.kind").alias("kinds"), F.col("found.item").alias("items")
    )
    blocks = joined.mapInArrow(
        _to_blocks(buckets), "bucket long, block binary, owner long, item long, window long"
    )
    merged = blocks.repartition("bucket").sortWithinPartitions("bucket", "window").mapInArrow(
        _merge, "owner long, item long"
    )
    return save_shared(merged, "spans")


# --- removal ---


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        kept, sizes, removed, runs = [], [], [], []
        for packed, items in zip(batch.column("packed"), batch.column("items").to_pylist()):
            text = unpack(packed.as_buffer())
            items = np.sort(np.array(items or [], np.int64))
            _, start, end = _merged(
                np.zeros(len(items), np.int64), items >> 32, items & 0xFFFFFFFF
            )
            end = np.minimum(end, len(text))
            parts, at = [], 0
            for a, b in zip(start.tolist(), end.tolist()):
                parts.append(text[at:a])
                at = b
            kept.append(b"".join([*parts, text[at:]]))
            sizes.append(len(text))
            removed.append(len(text) - len(kept[-1]))
            runs.append(len(start))
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "n_bytes": pa.array(sizes, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(runs, pa.int64()),
                "kept_sha256": pa.array(
                    [hashlib.sha256(text).hexdigest() for text in kept], pa.string()
                ),
                "kept": pa.array(kept, pa.binary()),
            }
        )


def remove_repeats(documents: DataFrame, hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (the bytes left) of every row."""
    spans = repeated_spans(documents, hot_segments).groupBy("owner").agg(F.collect_set("item").alias("items"))
    return (
        packed_texts(documents)
        .join(spans, "owner", "left")
        .select("doc_id", "packed", "items")
        .mapInArrow(
            _remove,
            "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
            "kept binary",
        )
    )
