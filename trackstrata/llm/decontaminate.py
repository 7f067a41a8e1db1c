"""Benchmark decontamination with a positional inverted index.

The words of every document that occur in the test items are stored as postings (term, positions), next to
the document they belong to, so the index is as distributed as the documents and has no hot term. A search
takes, for each window of the test items, the posting list of its rarest term (by corpus counts over all
documents), shifts it to the window's start, and intersects it with the shifted lists of the other terms, next
rarest first. What is left are exact phrase matches. With the same lists, a window whose terms all lie
within ``slack`` words around the rarest one's window counts as a proximity match.

The test items are held in blocks of ``block_words`` words; a larger test set takes several rounds of index
and search, each adding to the hits of the one before. Null or empty texts have no words; items without words have no
windows; a null item id reads ``null`` and repeated ids count once. Extra columns pass through; columns named
like an output are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import OWN, as_text, row_blocks, shielded, stored, utf8

WORDS, SLACK = 10, 5
BLOCK_WORDS = 500_000
#: lower-cases A-Z, and turns all other ASCII that is no letter or digit into blanks
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


@dataclass
class TestBlock:
    """Terms, distinct windows [n, WORDS] of term numbers (0 where shorter) and the items each window comes from."""

    terms: dict[bytes, int] = field(default_factory=dict)
    windows: dict[tuple[int, ...], list[int]] = field(default_factory=dict)
    items: list[str] = field(default_factory=list)
    words: int = 0

    def add(self, item: str, text: bytes, length: int) -> None:
        ids = [self.terms.setdefault(w, len(self.terms) + 1) for w in words_of(text)]
        if not ids:
            return
        if not self.items or self.items[-1] != item:
            self.items.append(item)
        number = len(self.items) - 1
        self.words += len(ids)
        for at in range(max(1, len(ids) - length + 1)):
            owners = self.windows.setdefault(tuple(ids[at : at + length]), [])
            if not owners or owners[-1] != number:
                owners.append(number)


def test_blocks(items: DataFrame, length: int = WORDS, block_words: int = BLOCK_WORDS) -> Iterator[TestBlock]:
    """The items, streamed through the driver, one bounded block at a time. At least one block, perhaps empty."""
    block = TestBlock()
    ordered = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("i"), as_text("text").alias("t")).orderBy("i", "t")
    for row in ordered.toLocalIterator():
        if block.words >= block_words:  # an item may go on in the next block: its hits are united by document
            yield block
            block = TestBlock()
        block.add(row.i, row.t.encode(), length)
    yield block


def positional_index(docs: DataFrame, block: TestBlock, keep: list[str]) -> DataFrame:
    """Stored postings: columns ``keep``, ``n_words``, and ``terms``/``positions`` ordered by term and position."""
    terms = docs.sparkSession.sparkContext.broadcast(block.terms)
    schema = docs.select(*[F.col(f"`{c}`") for c in keep], F.lit(0).cast("bigint").alias("n_words"), F.array(F.lit(0)).alias("terms"), F.array(F.lit(0)).alias("positions")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = terms.value.get
        for batch in batches:
            data, offsets = utf8(batch, "_bytes")
            raw = data.tobytes().translate(FOLD)
            for a, b in row_blocks(offsets):
                split = [raw[offsets[i] : offsets[i + 1]].split() for i in range(a, b)]
                counts = np.array([len(w) for w in split], np.int64)
                ids = np.fromiter((get(w, 0) for words in split for w in words), np.int64, counts.sum())
                begins = np.cumsum(counts) - counts
                row = np.repeat(np.arange(b - a), counts)
                hit = np.flatnonzero(ids)
                row, term, position = row[hit], ids[hit], hit - begins[row[hit]]
                order = np.argsort((row << 32) | term, kind="stable")
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=b - a))]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x[order].astype(np.int32))) for x in (term, position)]
                part = batch.slice(a, b - a)
                columns = [part.column(batch.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(counts), *lists], [*keep, "n_words", "terms", "positions"])

    return stored(docs.select(*[F.col(f"`{c}`") for c in keep], as_text("text").alias("_bytes")).mapInArrow(run, schema))


class Search:
    """The windows of a block, each with its terms in order of rarity, grouped by their rarest term."""

    def __init__(self, block: TestBlock, frequency: dict[int, int], slack: int):
        windows = list(block.windows)
        self.size = np.array([len(w) for w in windows], np.int64)
        width = int(self.size.max()) if windows else 1
        self.term, self.offset = (np.zeros((len(windows), width), np.int64) for _ in range(2))
        for i, w in enumerate(windows):
            order = sorted(range(len(w)), key=lambda j: (frequency.get(w[j], 0), w[j], j))
            self.term[i, : len(w)] = [w[j] for j in order]
            self.offset[i, : len(w)] = order
        rarest = self.term[:, 0]
        self.by_rarest = np.argsort(rarest, kind="stable")
        self.first = np.searchsorted(rarest[self.by_rarest], np.arange(len(block.terms) + 2))
        owners = [block.windows[w] for w in windows]
        self.owner_first = np.concatenate([[0], np.cumsum([len(o) for o in owners])]).astype(np.int64)
        self.owner = np.array([i for o in owners for i in o], np.int64)
        self.items, self.slack = block.items, slack
        self.gap = 2 * (width + slack) + 2  # keeps matches within a document

    def run(self, keys: np.ndarray, span: int, term: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(windows, places, exact) of phrase matches (place: the start) and of proximity matches (place: of the rarest term).
        ``keys`` are ``term * span + place``, sorted."""
        fan = self.first[term + 1] - self.first[term]
        has = np.flatnonzero(fan)
        ends = np.cumsum(fan[has])
        at = 0
        while at < len(has):  # at most about a million candidates at a time
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 1_000_000, side="right")))
            part = has[at:to]
            n = fan[part]
            window = self.by_rarest[np.repeat(self.first[term[part]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            anchor = np.repeat(place[part], n)
            yield *self._exact(keys, span, window, anchor), True
            yield *self._near(keys, span, window, anchor), False
            at = to

    def _exact(self, keys, span, window, anchor):
        start = anchor - self.offset[window, 0]
        for j in range(1, self.term.shape[1]):
            wanted = self.term[window, j]
            key = wanted * span + start + self.offset[window, j]
            found = keys[np.minimum(np.searchsorted(keys, key), len(keys) - 1)] == key
            stay = found | (wanted == 0)
            window, start = window[stay], start[stay]
        return window, start

    def _near(self, keys, span, window, anchor):
        for j in range(1, self.term.shape[1]):
            wanted = self.term[window, j]
            reach = self.size[window] + self.slack
            least = wanted * span + anchor - reach
            found = keys[np.minimum(np.searchsorted(keys, least), len(keys) - 1)]
            stay = ((found >= least) & (found <= least + 2 * reach)) | (wanted == 0)
            window, anchor = window[stay], anchor[stay]
        return window, anchor


def _search_table(index: DataFrame, search: Search) -> DataFrame:
    """Adds this block's matches to those of earlier blocks (``_hits`` positions, ``_items``, ``_near``)."""
    shared = index.sparkSession.sparkContext.broadcast(search)
    drop = ("terms", "positions")
    schema = index.drop(*drop).schema
    earlier = {"_hits", "_items", "_near"} <= set(index.columns)
    if not earlier:
        schema = T.StructType([*schema, *T.StructType.fromDDL("_hits array<int>, _items array<string>, _near array<string>")])
    plain = [f.name for f in schema if f.name not in ("_hits", "_items", "_near")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = shared.value
        items = np.array(find.items, dtype=object)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                column = {f: batch.column(batch.schema.get_field_index(f)) for f in batch.schema.names}
                rows = batch.num_rows
                words = column["n_words"].to_numpy(zero_copy_only=False).astype(np.int64)
                base = np.cumsum(words + find.gap) - words
                posted = np.diff(column["terms"].offsets.to_numpy()).astype(np.int64)
                term = column["terms"].flatten().to_numpy().astype(np.int64)
                place = column["positions"].flatten().to_numpy().astype(np.int64) + np.repeat(base, posted)
                span = int(base[-1] + words[-1] + 2 * find.gap) if rows else 1
                hits, found, near = (column[c].to_pylist() if earlier else [[] for _ in range(rows)] for c in ("_hits", "_items", "_near"))
                if len(term) and len(find.size):
                    keys = np.sort(term * span + place)
                    for window, start, exact in find.run(keys, span, term, place):
                        row = np.searchsorted(base, start, side="right") - 1
                        into = found if exact else near
                        n = find.owner_first[window + 1] - find.owner_first[window]
                        owner = find.owner[np.repeat(find.owner_first[window], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
                        pairs = np.unique((np.repeat(row, n) << 32) | owner)
                        for r, o in zip((pairs >> 32).tolist(), (pairs & 0xFFFFFFFF).tolist()):
                            into[r].append(items[o])
                        if exact:
                            size = find.size[window]
                            covered = np.unique(np.repeat(start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
                            owner_row = np.searchsorted(base, covered, side="right") - 1
                            for r in np.unique(owner_row).tolist():
                                hits[r] = hits[r] + (covered[owner_row == r] - base[r]).tolist()
                arrays = [column[c] for c in plain]
                arrays.append(pa.array([sorted(set(h)) for h in hits], pa.list_(pa.int32())))
                arrays += [pa.array([sorted(set(x)) for x in y], pa.list_(pa.string())) for y in (found, near)]
                yield pa.RecordBatch.from_arrays(arrays, [*plain, "_hits", "_items", "_near"])


    return index.mapInArrow(run, T.StructType([schema[c] for c in [*plain, "_hits", "_items", "_near"]]))


def decontaminate(docs: DataFrame, items: DataFrame, keep: list[str] | None = None, length: int = WORDS, slack: int = SLACK, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Columns ``keep`` (all by default) with ``n_words, n_hit, hits`` (word positions), ``n_items, items, n_near_items, items_sha256, contaminated``."""
    outputs = ["n_words", "n_hit", "hits", "n_items", "items", "n_near_items", "items_sha256", "contaminated"]
    return shielded(docs, ["text"], outputs, keep, lambda own: _decontaminated(own, items, length, slack, block_words))


def _decontaminated(docs: DataFrame, items: DataFrame, length: int, slack: int, block_words: int) -> DataFrame:
    keep = [OWN]
    current, blocks = docs, iter(test_blocks(items, length, block_words))
    block = next(blocks)
    state: list[str] = []
    while block is not None:
        following = next(blocks, None)
        carried = list(dict.fromkeys([*keep, *(["text"] if following is not None else []), *state]))
        index = positional_index(current, block, carried)
        counts = index.select(F.explode("terms").alias("t")).groupBy("t").count()  # one row a term of the block
        frequency = {r.t: r["count"] for r in counts.collect()}
        current = _search_table(index, Search(block, frequency, slack))
        if following is not None:
            current, state = stored(current).drop("n_words"), ["_hits", "_items", "_near"]
        block = following
    n_hit, found = F.size("_hits").cast("bigint"), F.size("_items").cast("bigint")
    return current.select(
        *[F.col(f"`{c}`") for c in keep],
        "n_words",
        n_hit.alias("n_hit"),
        F.col("_hits").alias("hits"),
        found.alias("n_items"),
        F.col("_items").alias("items"),
        F.size("_near").cast("bigint").alias("n_near_items"),
        F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
