"""Packing of tokenized documents into fixed windows by best-fit decreasing.

Each document's ids are cut into full windows and one remainder. Remainders are dealt at random into groups of about
``group_size``; each group places its pieces, longest first, into the open window with the least sufficient
room, found by a segment tree indexed by remaining capacity. A group leaves about one window partly empty, so
padding stays a fixed small share at any size. A sequence is padded to ``window`` unless its length is a power of two.

Null texts count as empty: every row gives at least one piece, its end id. Repeated rows and repeated or null
ids are packed as rows of their own. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_blocks, stored

WINDOW, END_ID = 4096, 2
GROUP_SIZE = 4096
CACHED_WORDS, CACHED_IDS, LONG_TEXT = 700_000, 1 << 22, 1 << 20
MARKS = frozenset(".,;:?!")
#: ASCII punctuation after a letter and before a blank, without apostrophes, which may begin a part such as 's.
_MARK = re.compile(r"[!-&(-/:-@\[-`{-~](?<=[a-zß-öø-ÿ].)[!-&(-/:-@\[-`{-~]*(?= |\Z)")
#: Beyond U+017F, or not one letter in lower case.
_OTHER = re.compile("[^\x00-\u017f]|[\u0130\u0149]")


class WordTokenizer:
    """Ids of whole texts, with the ids of words between blanks kept for reuse.

    Exact for tokenizers whose pre-tokenizer never joins characters across the blanks split on here: the ids
    of a text are then those of its blank-separated parts, one after the other. A part of Latin letters only is one
    word of the vocabulary's merges, so unknown ones are coded many at a time and cut at the word ends
    in the ids; a mark after such a word is a part of its own. All other parts go through the tokenizer as they are.
    Texts of Latin letters are lower-cased as a whole, and punctuation between a letter and a blank set apart in them, so that a word is
    known by one spelling and without its marks.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # words are lower-cased and cut at white space here, so the tokenizer must do the same and no more to them
        normal, sample = self.tokenizer.normalizer, "AZ ÀŽ é\tb\nc"
        if normal is None or normal.normalize_str(sample) != " ".join(sample.lower().split()):
            raise ValueError("this tokenizer does not lower-case its text and make white space one blank")
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.start, self.entries = np.zeros(1 << 16, np.int64), 1
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def _gather(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the entries, one after the other, and where each ends."""
        begin = self.start[index]
        sizes = self.start[index + 1] - begin
        ends = np.cumsum(sizes)
        source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + sizes, sizes)
        return self.flat[source], ends

    def _append(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        first, self.entries = self.entries, self.entries + len(words)
        while self.entries >= len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        self.known.update(zip(words, range(first, self.entries)))
        self.start[first + 1 : self.entries + 1] = ends + self.used
        self.used += len(ids)

    def _learn(self, words: list[str]) -> None:
        known, other, plain = self.known, [], []
        simple, simple_stems, marked, marked_stems = [], [], [], []
        for word in words:
            if word.islower() and word.isascii() and word.isalpha():
                plain.append(word)
            elif _latin(word):
                simple.append(word)
                simple_stems.append(word.lower())
            elif word[-1] in MARKS and _latin(word[:-1]):
                marked.append(word)
                marked_stems.append(word[:-1].lower())
            else:
                other.append(word)
        self._learn_plain([stem for stem in {*plain, *simple_stems, *marked_stems} if stem not in known])
        other += [mark for mark in MARKS if mark not in known and mark not in other]
        for at in range(0, len(other), 4096):
            part = other[at : at + 4096]
            coded = [c.ids for c in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            self._append(part, np.fromiter(chain.from_iterable(coded), np.uint32), np.cumsum([len(c) for c in coded]))
        known.update(zip(simple, [known[stem] for stem in simple_stems]))
        pairs = np.empty(2 * len(marked), np.int64)
        pairs[::2], pairs[1::2] = [known[stem] for stem in marked_stems], [known[word[-1]] for word in marked]
        ids, ends = self._gather(pairs)
        self._append(marked, ids, ends[1::2])

    def _learn_plain(self, stems: list[str]) -> None:
        for at in range(0, len(stems), 200 * 64):
            part = stems[at : at + 200 * 64]
            lines = [" ".join(part[i : i + 200]) for i in range(0, len(part), 200)]
            ids = np.array([i for coded in self.plain.encode_batch_fast(lines, add_special_tokens=False) for i in coded.ids], np.uint32)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(part) or ends[-1] != len(ids):
                raise ValueError("this vocabulary does not mark word ends with </w>")
            self._append(part, ids, ends)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """One array of ids per text; together the texts should be of bounded size."""
        parts = [_spelled(t.replace("\n", " ").replace("\t", " ").replace("\r", " ")).split(" ") for t in texts]
        if len(self.known) > CACHED_WORDS or self.used > CACHED_IDS:
            self._clear()
        words = list(chain.from_iterable(parts))
        index = np.array(list(map(self.known.get, words, repeat(-1))), np.int64)
        unknown = np.flatnonzero(index < 0).tolist()
        if unknown:
            self._learn(list({words[i] for i in unknown}))
            index[unknown] = [self.known[words[i]] for i in unknown]
        counts = np.array([len(p) for p in parts], np.int64)
        flat, ends = self._gather(index)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return [flat[a:b] for a, b in zip(bounds, bounds[1:])]

    def long_ids(self, text: str) -> np.ndarray:
        """Ids of a very long text, taken in parts that end at blanks."""
        out, at = [], 0
        while at < len(text):
            end = at + LONG_TEXT
            if end < len(text):
                ends = [e for e in (text.find(c, end) for c in " \n\t\r") if e >= 0]
                end = min(ends) if ends else len(text)
            out += self.ids([text[at:end]])
            at = end
        return np.concatenate(out) if out else np.zeros(0, np.uint32)


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One per worker process, so that tasks that follow each other share its cache."""
    return WordTokenizer(path)


def _spelled(text: str) -> str:
    """Lower case, with a blank before punctuation that follows a letter and ends at a blank; unchanged if not all of Latin letters, as
    other ones may depend on their neighbours."""
    if not text.isascii() and _OTHER.search(text):
        return text
    return _MARK.sub(r" \g<0>", text.lower())


def _latin(word: str) -> bool:
    """Letters up to U+017F whose lower case is one letter: neither normalization nor the pre-tokenizer changes or cuts them."""
    return word.isalpha() and (word.isascii() or max(word) <= "\u017f" and "\u0130" not in word and "\u0149" not in word)


def token_pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens`` (and ``ids`` if asked for)."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    schema += ", ids array<int>" if keep_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(tokenizer_path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            offsets = np.concatenate([[0], np.cumsum(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))])
            for a, b in row_blocks(offsets, LONG_TEXT):
                block = texts.slice(a, b - a).to_pylist()
                coded = [tokenizer.long_ids(block[0])] if b - a == 1 else tokenizer.ids(block)
                row, start, length, crc, total, kept = [], [], [], [], [], []
                for i, ids in enumerate(coded):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for s in range(0, len(ids), window):
                        piece = ids[s : s + window]
                        row.append(a + i)
                        start.append(s)
                        length.append(len(piece))
                        crc.append(zlib.crc32(piece.tobytes()))
                        total.append(len(ids))
                        if keep_ids:
                            kept.append(piece.astype(np.int32))
                arrays = [keys.take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    arrays.append(pa.array(kept, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, schema)


class OpenWindows:
    """Open windows by remaining capacity: a segment tree of counts finds the smallest capacity of at least a given size."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, name: int) -> None:
        self.windows[room].append(name)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += by
            at >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return (room, window) of the tightest open window with room for ``size``."""
        count, at = self.count, size + self.leaves
        if not count[at]:
            while at > 1 and (at & 1 or not count[at + 1]):  # climb until a right sibling has windows
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if count[2 * at] else 2 * at + 1
        room = at - self.leaves
        self._change(room, -1)
        return room, self.windows[room].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window number and offset of each piece."""
    place, offset = [0] * len(lengths), [0] * len(lengths)
    tree, windows = OpenWindows(window), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[i])
        if found is None:
            room, name = window, windows
            windows += 1
        else:
            room, name = found
        place[i], offset[i] = name, window - room
        tree.add(room - lengths[i], name)
    return place, offset


def pack(pieces: DataFrame, window: int = WINDOW, group_size: int = GROUP_SIZE) -> DataFrame:
    """The pieces with ``sequence_id, offset, sequence_tokens, padded_tokens``. A sequence is named by the number
    of its first piece. The pieces are stored once, so numbers and groups stay the same if a task is repeated."""
    numbered = stored(pieces.withColumn("_piece", F.monotonically_increasing_id()))
    rest = numbered.where(F.col("length") < window)
    groups = max(1, -(-rest.count() // group_size))
    schema = "_piece bigint, sequence_id bigint, offset bigint, sequence_tokens bigint"

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "_piece"], ascending=[False, True], ignore_index=True)
        at, offset = best_fit_decreasing(frame["length"].tolist(), window)
        frame["offset"], at = offset, np.array(at)
        first = frame["_piece"].to_numpy()[np.unique(at, return_index=True)[1]]
        filled = np.bincount(at, weights=frame["length"]).astype(np.int64)
        frame["sequence_id"], frame["sequence_tokens"] = first[at], filled[at]
        return frame[["_piece", "sequence_id", "offset", "sequence_tokens"]]

    dealt = rest.select("_piece", "length", F.pmod(F.xxhash64("_piece"), F.lit(groups)).alias("_group"))
    placed = dealt.groupBy("_group").applyInPandas(place, schema)
    packed = numbered.where(F.col("length") < window).join(placed, "_piece")
    full = numbered.where(F.col("length") == window).select(
        "*", F.col("_piece").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"), F.col("length").alias("sequence_tokens")
    )
    tokens = F.col("sequence_tokens")
    power = tokens.bitwiseAND(tokens - 1) == 0
    return packed.unionByName(full).withColumn("padded_tokens", F.when(power, tokens).otherwise(F.lit(window).cast("bigint"))).drop("_piece")


def sequences(packed: DataFrame, pad_id: int = 0) -> DataFrame:
    """Token sequences of pieces packed with their ids: ``sequence_id, ids`` padded as said above. A sequence has at most ``window`` pieces."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(ordered.alias("_p"), F.first("padded_tokens").alias("_n"))
    ids = F.flatten(F.transform("_p", lambda p: p["ids"]))
    return joined.select("sequence_id", F.concat(ids, F.array_repeat(F.lit(pad_id), (F.col("_n") - F.size(ids)).cast("int"))).alias("ids"))
