"""Operator 8: substring dedup with sharded Aho-Corasick automata.

Words are runs of anything but ASCII white space; a window is ``width`` words of
one document.  Every word that a window covers whose word sequence also starts
anywhere else (in the same document too) goes, first occurrence included.

Candidate regions come from ``regions`` without loss.  In each bucket, windows
that recur are confirmed; each maximal run of them is cut into phrases of
``width`` words that cover it, and the distinct phrases are compiled into that
bucket's automaton (pyahocorasick).  All regions of the bucket are streamed
through it, and every occurrence of a phrase marks its words.  A phrase is a
recurring window itself, so nothing else is marked, and a run's own phrases
cover all of it.

Cases: null, empty and short texts lose nothing.
Repeated rows are repeats like others; null doc_ids are documents like others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelspark.llm import regions as R
from panelspark.llm import textkit as K

WIDTH = 35
#: Bytes of region text in one bucket, about; its automaton has at most one node a byte.
BUCKET_BYTES = 1 << 20


def plan(width: int = WIDTH) -> R.Plan:
    return R.Plan(words=True, width=width, gram=max(1, width // 4), across=False, bucket_bytes=BUCKET_BYTES)


def _phrases(words: list[str], starts: np.ndarray, width: int) -> Iterator[str]:
    """Windows that together cover the runs of window starts."""
    cut = np.flatnonzero(np.diff(starts) > 1) + 1
    for run in np.split(starts, cut):
        lo, hi = int(run[0]), int(run[-1])
        for s in [*range(lo, hi, width), hi]:
            yield " " + " ".join(words[s:s + width]) + " "


def judge(width: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        texts = group.column("words").to_pylist()
        weight = group.column("n").to_numpy()
        strings = pa.array([t.decode() for t in texts])
        units = R.units_of(strings, plan(width))
        at = np.flatnonzero(K.same_row(units.row, width))
        value = K.window_hash(units.value, width)[at]
        _, code = np.unique(value, return_inverse=True)
        recurring = np.bincount(code, weights=weight[units.row[at]])[code] > 1  # confirmed
        at = at[recurring]
        row = units.row[at]
        automaton = ahocorasick.Automaton()
        split: dict[int, list[str]] = {}
        for r, starts in zip(np.unique(row).tolist(), np.split(at, np.flatnonzero(np.diff(row)) + 1) if len(at) else []):
            words = split[r] = strings[r].as_py().split(" ")
            for phrase in _phrases(words, starts - units.first[r], width):
                automaton.add_word(phrase, len(phrase))
        classes, a, b = [], [], []
        if len(automaton):
            automaton.make_automaton()
            for r, text in enumerate(strings.to_pylist()):
                text = f" {text} "
                ends = [e for e, _ in automaton.iter(text)]
                if not ends:
                    continue
                spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 32)
                last = np.searchsorted(spaces, ends)  # the word before space k is word k - 1
                runs = R.merge_runs([x for k in last.tolist() for x in (k - width, k)])
                classes += [r] * (len(runs) // 2)
                a += runs[::2]
                b += runs[1::2]
        return R.ragged_runs(np.array(classes, np.int64), np.array(a, np.int64), np.array(b, np.int64), None, group)
    return run


def _cut_mapper(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in K.chunks(batch, "text"):
            buf, off = K.text_bytes(part.column("text"))
            start, end, row = K.word_spans(buf, off, K.NON_SPACE)
            first = np.searchsorted(row, np.arange(part.num_rows + 1)).tolist()
            out = []
            for lo, hi, runs in zip(first[:-1], first[1:], part.column("runs").to_pylist()):
                gone = R.merge_runs(runs)
                words = [buf[x:y].tobytes() for a, b in R.kept(hi - lo, gone)
                         for x, y in zip(start[lo + a:lo + b].tolist(), end[lo + a:lo + b].tolist())]
                left = b" ".join(words)
                out.append((hi - lo, hi - lo - len(words), gone, hashlib.sha256(left).hexdigest(), left.decode()))
            n, removed, gone, sha, left = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(sha, pa.string()), pa.array(gone, pa.list_(pa.int64())), pa.array(left, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "spans", "kept"])


def dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row, with ``spans``
    (start, end, ... of removed words) and ``kept`` (the rest, joined by one space)."""
    rows = R.named(docs)
    found = R.with_runs(rows, R.removed_runs(rows, plan(width), judge(width)), across=False)
    return found.mapInArrow(_cut_mapper, "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<long>, kept string")
