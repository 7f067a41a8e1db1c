"""URL filters: all glob rules at once by a bit-parallel Shift-And automaton.

A URL becomes ``.host/path`` in UTF-8 (see ``canonical``). Every rule is a glob over that text: ``**`` stands for any characters,
``*`` for any but ``/``, ``?`` for one character. The literals of all globs lie one after the other in the bits of a few
64-bit words; one step per byte moves the states of all rules for a whole block of URLs. The longest matching rule wins, a tie goes to ``block``, then to the smaller text.

Null URLs or URLs without ``://`` have empty host and path. URLs that no rule fits are allowed. Repeated rows are judged each; extra
columns pass through, and columns named like an output are replaced. URLs are taken in blocks of bounded
size and ordered by length, so a very long one only costs its own bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import passed, row_blocks, shielded, utf8

_BIT = np.uint64(1)


@dataclass(frozen=True)
class Rule:
    """``glob`` over the canonical URL; ``name`` is what the result shows, and its length ranks the rule."""

    glob: str
    verdict: str
    name: str
    rank: int


def domain_rules(host: str, path: str, verdict: str) -> list[Rule]:
    """Fits the host and its subdomains where the URL's path starts with ``path`` (which begins with ``/``, or is empty)."""
    globs = [f"*.{host}{path}**"] if path else [f"*.{host}", f"*.{host}/**"]
    return [Rule(glob, verdict, host + path, len(host + path)) for glob in globs]


class GlobAutomaton:
    """Bits: one state per literal of each glob, after one state for its beginning."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        states, self.finals = [], []
        for rule in rules:
            literals, loops, glob = [], [None], rule.glob
            at = 0
            while at < len(glob):
                if glob.startswith("**", at):
                    loops[-1] = "any"
                    at += 2
                elif glob[at] == "*":
                    loops[-1] = loops[-1] or "segment"
                    at += 1
                else:
                    for byte in [None] if glob[at] == "?" else glob[at].encode():
                        literals.append(byte)
                        loops.append(None)
                    at += 1
            states += [(None, True, loops[0])] + [(b, False, w) for b, w in zip(literals, loops[1:])]
            self.finals.append(len(states) - 1)
        words = max(1, -(-len(states) // 64))
        self.start = np.zeros(words, np.uint64)
        self.step = np.zeros((256, words), np.uint64)
        self.loop = np.zeros((256, words), np.uint64)
        for i, (byte, begins, wild) in enumerate(states):
            word, bit = i // 64, _BIT << np.uint64(i % 64)
            if begins:
                self.start[word] |= bit
            elif byte is None:
                self.step[:, word] |= bit
            else:
                self.step[byte, word] |= bit
            if wild:
                self.loop[:, word] |= bit
                if wild == "segment":
                    self.loop[ord("/"), word] &= ~bit
        best = sorted(range(len(rules)), key=lambda r: (-rules[r].rank, rules[r].verdict != "block", rules[r].name))
        self.ranking = [(r, self.finals[r] // 64, _BIT << np.uint64(self.finals[r] % 64)) for r in best]

    def match(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The winning rule's index for each text, -1 for none."""
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        begin, size = offsets[:-1][order], lengths[order]
        state = np.tile(self.start, (len(size), 1))
        live = len(size)
        for t in range(int(size[0]) if len(size) else 0):
            while live and size[live - 1] <= t:
                live -= 1
            byte = data[begin[:live] + t]
            now = state[:live]
            moved = now << _BIT
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.step[byte]) | (now & self.loop[byte])
        won = np.full(len(size), -1)
        for rule, word, bit in reversed(self.ranking):
            won[(state[:, word] & bit) != 0] = rule
        out = np.empty_like(won)
        out[order] = won
        return out


def canonical(urls: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``: host after the first ``://`` up to ``/?#``, path from there up to ``?#``."""
    whole = f"coalesce(cast(`{url}` as string), '')"
    rest = f"if(instr({whole}, '://') > 0, substring({whole}, instr({whole}, '://') + 3), '')"
    host = f"regexp_extract({rest}, '^[^/?#]*', 0)"
    # only ASCII letters are folded
    folded = f"translate({host}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return urls.withColumns({"host": F.expr(folded), "path": F.expr(f"regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1)")})


def filter_urls(urls: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """All columns with ``host``, ``path``, ``rule`` (name of the winning rule, or null) and ``verdict``."""
    return shielded(urls, [url], ["host", "path", "rule", "verdict"], None, lambda own: _judged(own, rules, url))


def _judged(urls: DataFrame, rules: list[Rule], url: str) -> DataFrame:
    automaton = urls.sparkSession.sparkContext.broadcast(GlobAutomaton(rules))
    source = canonical(urls.withColumnRenamed(url, "_url"), "_url").drop("_url")
    schema = passed(source, "rule string, verdict string")
    kept = [f.name for f in schema][:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton.value
        names = np.array([r.name for r in machine.rules] + [None], dtype=object)
        verdicts = np.array([r.verdict for r in machine.rules] + ["allow"], dtype=object)
        for batch in batches:
            data, offsets = utf8(batch, "_text")
            won = np.empty(batch.num_rows, np.int64)
            for a, b in row_blocks(offsets, 1 << 20):
                won[a:b] = machine.match(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names[won], pa.string()), pa.array(verdicts[won], pa.string())], [*kept, "rule", "verdict"])

    return source.withColumn("_text", F.concat(F.lit("."), "host", "path")).mapInArrow(run, schema)
