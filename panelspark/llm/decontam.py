"""Operator 9: benchmark decontamination by a generalised suffix automaton.

Test items are normalised to words (A-Z lower-cased; runs of letters, digits
and bytes beyond ASCII) and put into one suffix automaton over word codes.
Every document streams through it; the longest suffix of the words read so far
that is also a substring of an item is tracked word by word.  A length of
``window`` or more means that the last ``window`` words are a window of an item;
an item of fewer words is found where its whole match ends.  Words of documents
that no item holds reset the automaton, so only runs of item words are streamed.

The automaton is broadcast in blocks of at most ``block_words`` item words, a
bound of its size; more items make more passes over the rows, and every pass
adds its findings to the row.

Limits: a document is contaminated if it has a hit and at least one word in
``coverage_parts`` is hit.  ``without_spans`` cuts hit spans out of a text.

Cases: null or empty texts have no words, and are clean.  Items without words
find nothing.  Repeated items are all named (ids are united as strings); an
item without an id marks words and is not named.  Repeated documents are judged
row by row.  Columns of any name are carried along.  An empty benchmark leaves
every document clean.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import textkit as K

WINDOW = 13
#: A document is contaminated if at least one of so many of its words is hit.
COVERAGE_PARTS = 20
#: Words of test items in one broadcast automaton (about 300 bytes each).
BLOCK_WORDS = 200_000


def word_table(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Byte start, end, row and hash of every normalised word, and the row offsets in bytes."""
    buf, off = K.text_bytes(column)
    buf = K.lower(buf)
    start, end, row = K.word_spans(buf, off, K.ALNUM)
    return start, end, row, K.span_hash(buf, start, end), off


@dataclass
class SuffixAutomaton:
    """Generalised suffix automaton of items given as lists of word codes."""
    window: int
    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    size: list[int] = field(default_factory=lambda: [0])

    def _state(self, size: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(0)
        self.size.append(size)
        return len(self.size) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        copy = self._state(self.size[p] + 1, dict(self.next[q]))
        self.link[copy], self.link[q] = self.link[q], copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word: int) -> int:
        q = self.next[last].get(word)
        if q is not None:
            return q if self.size[q] == self.size[last] + 1 else self._split(last, q, word)
        new, p = self._state(self.size[last] + 1, {}), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, q, word)
        return new

    def build(self, items: list[list[int]]) -> SuffixAutomaton:
        for words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        # base: the state of the last ``window`` words of a longer match
        order = sorted(range(1, len(self.size)), key=self.size.__getitem__)
        self.base = [-1] * len(self.size)
        for v in order:
            up = self.base[self.link[v]]
            self.base[v] = up if up >= 0 else v if self.size[v] >= self.window else -1
        self.whole: list[tuple[tuple[int, int], ...]] = [()] * len(self.size)  # (words, item) of short items ending here
        self.holders: dict[int, set[int]] = {}
        for k, words in enumerate(items):
            state = 0
            for i, word in enumerate(words):
                state = self.next[state][word]  # a prefix of an item is always there
                if i + 1 >= self.window:
                    self.holders.setdefault(self.base[state], set()).add(k)
            if 0 < len(words) < self.window:
                self.whole[state] += ((len(words), k),)
        for v in order:
            self.whole[v] += self.whole[self.link[v]]
        return self

    def stream(self, words: list[int], at: int, starts: list[int], ends: list[int], items: set[int]) -> None:
        """Appends the hit runs of ``words`` (place ``at`` on) and adds the items found."""
        nxt, link, size, base, whole, window = self.next, self.link, self.size, self.base, self.whole, self.window
        state = length = 0
        for i, word in enumerate(words, at):
            to = nxt[state].get(word)
            while to is None and state:
                state = link[state]
                length = size[state]
                to = nxt[state].get(word)
            if to is None:
                length = 0
                continue
            state = to
            length += 1
            if length >= window:
                starts.append(i - length + 1)
                ends.append(i + 1)
                items |= self.holders[base[state]]
            for words_of, item in whole[state]:
                if words_of <= length:
                    starts.append(i - words_of + 1)
                    ends.append(i + 1)
                    items.add(item)


@dataclass
class Block:
    """One broadcast part of the benchmark."""
    ids: list[str | None]
    vocabulary: np.ndarray
    automaton: SuffixAutomaton
    shortest: int


def make_block(ids: list[str | None], items: list[np.ndarray], window: int) -> Block:
    vocabulary = np.unique(np.concatenate([*items, np.zeros(0, np.uint64)]))
    coded = [np.searchsorted(vocabulary, x).tolist() for x in items]
    shortest = min([window, *(len(x) for x in coded if x)])
    return Block(ids, vocabulary, SuffixAutomaton(window).build(coded), shortest)


def _item_mapper(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in K.chunks(batch, "text"):
            _, _, row, words, _ = word_table(part.column("text"))
            ends = np.searchsorted(row, np.arange(part.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(ends[1:] - ends[:-1], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(words.view(np.int64)))], names=["id", "n", "words"])


def blocks(benchmark: DataFrame, window: int, block_words: int) -> Iterator[Block]:
    """The items in blocks of at most ``block_words`` words (or one item), read
    one by one from the partitions, so that the driver holds one block."""
    items = benchmark.select(benchmark["item_id"].cast("string").alias("id"), benchmark["text"]) \
        .mapInArrow(_item_mapper, "id string, n long, words array<long>").where("n > 0")
    ids, words, n = [], [], 0
    for item in items.toLocalIterator():
        if words and n + item["n"] > block_words:
            yield make_block(ids, words, window)
            ids, words, n = [], [], 0
        ids.append(item["id"])
        words.append(np.array(item["words"], np.int64).view(np.uint64))
        n += item["n"]
    if words:
        yield make_block(ids, words, window)


def _merge(starts: Iterable[int], ends: Iterable[int]) -> list[int]:
    """start, end, start, end, ... of the union of runs."""
    out: list[int] = []
    for a, b in sorted(zip(starts, ends)):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def find(words: np.ndarray, row: np.ndarray, n_rows: int, block: Block) -> dict[int, tuple[list[int], set[int]]]:
    """Merged hit runs (places among the row's words) and items of the rows that have any."""
    code = np.searchsorted(block.vocabulary, words)
    code[code == len(block.vocabulary)] = 0
    known = block.vocabulary[code] == words
    edge = np.ones(len(words) + 1, bool)  # runs of item words in one row
    edge[1:-1] = (known[1:] != known[:-1]) | (row[1:] != row[:-1])
    cut = np.flatnonzero(edge)
    a, b = cut[:-1], cut[1:]
    keep = known[a] & (b - a >= block.shortest) if len(a) else np.zeros(0, bool)
    first = np.searchsorted(row, np.arange(n_rows))
    found: dict[int, tuple[list[int], list[int], set[int]]] = {}
    for s, e in zip(a[keep].tolist(), b[keep].tolist()):
        r = int(row[s])
        got = found.get(r) or ([], [], set())
        block.automaton.stream(code[s:e].tolist(), s - int(first[r]), *got)
        if got[0]:
            found[r] = got
    return {r: (_merge(x, y), items) for r, (x, y, items) in found.items()}


_EXTRA = ", n_words long, n_hit long, spans array<long>, bytes array<long>, items array<string>"


def _mapper(shared, window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value if shared is not None else make_block([], [], window)
        for batch in batches:
            at = 0
            for row, text in K.row_chunks([batch]):
                n = len(row)
                start, end, doc, words, off = word_table(text)
                first = np.searchsorted(doc, np.arange(n + 1))
                hits = find(words, doc, n, block) if len(block.ids) else {}
                spans, cuts, items = [[] for _ in range(n)], [[] for _ in range(n)], [[] for _ in range(n)]
                if "spans" in batch.schema.names:
                    before = batch.slice(at, n)
                    spans, cuts, items = (before.column(c).to_pylist() for c in ("spans", "bytes", "items"))
                for r, (runs, who) in hits.items():
                    spans[r] = _merge([*spans[r][::2], *runs[::2]], [*spans[r][1::2], *runs[1::2]])
                    base = int(first[r])
                    cuts[r] = [int(x) - int(off[r]) for a, b in zip(spans[r][::2], spans[r][1::2]) for x in (start[base + a], end[base + b - 1])]
                    items[r] = sorted({*items[r], *(block.ids[k] for k in who if block.ids[k] is not None)})
                yield pa.RecordBatch.from_arrays(
                    [row, pa.array(first[1:] - first[:-1], pa.int64()), pa.array([sum(x[1::2]) - sum(x[::2]) for x in spans], pa.int64()), pa.array(spans, pa.list_(pa.int64())),
                     pa.array(cuts, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))],
                    names=["row", "n_words", "n_hit", "spans", "bytes", "items"])
                at += n
    return run


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage_parts: int = COVERAGE_PARTS,
         block_words: int = BLOCK_WORDS, columns: tuple[str, ...] = ()) -> DataFrame:
    """``row`` (all columns of ``docs`` or ``columns``), ``n_words``, ``n_hit``, ``spans``
    and ``bytes`` (start, end, ... of the hit runs, in words and in UTF-8 bytes),
    ``items`` (sorted ids) and ``contaminated`` for every row."""
    spark = docs.sparkSession
    out = K.as_rows(docs, *columns)
    schema = f"row {K.row_type(out)}{_EXTRA}"
    passes = 0
    for block in blocks(benchmark, window, block_words):
        out = out.mapInArrow(_mapper(spark.sparkContext.broadcast(block), window), schema)
        passes += 1
    if not passes:
        out = out.mapInArrow(_mapper(None, window), schema)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * coverage_parts >= F.col("n_words")))


def without_spans(text: str | None, cuts: list[int]) -> str | None:
    """``text`` without the byte runs ``cuts``."""
    if not cuts:
        return text
    raw = text.encode()
    keep = [0, *cuts, len(raw)]
    return b"".join(raw[a:b] for a, b in zip(keep[::2], keep[1::2])).decode()
