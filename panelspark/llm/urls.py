"""Operator 6: URL filters by a bit-parallel wildcard automaton.

All glob patterns are packed, one bit per pattern position, into 64-bit words
(multiword Shift-And).  The automaton reads a whole Arrow slice of canonical
URLs at once: step t feeds byte t of every URL that long, and moves the states
of all patterns of all those URLs with a few numpy operations.  ``*`` is a bit
that stays set (a self-loop) and is passed without a byte; ``?`` takes any byte.

Canonical form: host (A-Z lower-cased) + path, as ``split_url`` gives them.  A
rule ``host/path`` fits its host and all its subdomains, if the path starts
with the rule's: the globs ``host/path*`` and ``*.host/path*``, where ``*.``
cannot pass a ``/`` (a second kind of loop that takes host bytes only).

Cases: null url or one without ``://``: host and path are empty, no rule fits,
and the verdict is the default.  Repeated rows are judged row by row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import textkit as K

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``text`` is ``host/path`` (longest fitting rule wins) or, with ``glob``, a
    pattern over host + path that speaks only where no rule fits."""
    text: str
    verdict: str
    glob: bool = False


def host_and_path(url):
    """The two canonical parts as Spark columns."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)\A.*?://", ""))
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


class Automaton:
    """Shift-And masks of a list of rules.

    Places are numbered over all patterns; place p holds "the pattern is matched
    up to p".  ``take[b]`` has the places that byte b enters from their left
    neighbour, ``stay``/``stay_host`` those with a self-loop."""

    def __init__(self, rules: Sequence[Rule]) -> None:
        self.rules = list(rules)
        places: list[tuple[str, int]] = []  # symbol that leads into the place, rule
        self.begin, self.final, loops, host_loops = [], [], [], []
        for k, rule in enumerate(self.rules):
            globs = [rule.text] if rule.glob else [f"{rule.text}*", f"\0.{rule.text}*"]
            for glob in globs:
                self.begin.append(len(places))
                places.append(("", k))
                for symbol in glob.encode("utf-8").decode("latin-1"):
                    if symbol == "*":
                        loops.append(len(places) - 1)
                    elif symbol == "\0":
                        host_loops.append(len(places) - 1)
                    else:
                        places.append((symbol, k))
                self.final.append((len(places) - 1, k))
        self.words = len(places) // 64 + 1
        self.take = np.zeros((256, self.words), np.uint64)
        for p, (symbol, _) in enumerate(places):
            if symbol:
                for b in range(256) if symbol == "?" else [ord(symbol)]:
                    self._set(self.take[b], p)
        loop, host_loop = np.zeros(self.words, np.uint64), np.zeros(self.words, np.uint64)
        for p in loops:
            self._set(loop, p)
        for p in host_loops:
            self._set(host_loop, p)
        self.stay = np.tile(loop | host_loop, (256, 1))
        self.stay[ord("/")] = loop
        self.start = np.zeros(self.words, np.uint64)
        for p in self.begin:
            self._set(self.start, p)

    @staticmethod
    def _set(mask: np.ndarray, place: int) -> None:
        mask[place // 64] |= np.uint64(1 << (place % 64))

    def matches(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """rows x rules: which rules match each whole text."""
        size = off[1:] - off[:-1]
        order = np.argsort(-size, kind="stable")  # the rows still running are a prefix
        first, length = off[:-1][order], size[order]
        state = np.tile(self.start, (len(size), 1))
        for t in range(int(length[0]) if len(length) else 0):
            n = int(np.searchsorted(-length, -t, "left"))
            byte, now = buf[first[:n] + t], state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.take[byte]) | (now & self.stay[byte])
        hit = np.zeros((len(size), len(self.rules)), bool)
        for p, k in self.final:
            hit[order, k] |= (state[:, p // 64] >> np.uint64(p % 64)) & np.uint64(1) == 1
        return hit


def _mapper(rules: Sequence[Rule], default: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(rules)
        named = [k for k, r in enumerate(automaton.rules) if not r.glob]
        named.sort(key=lambda k: (len(automaton.rules[k].text), automaton.rules[k].text))  # the longest last
        globs = [k for k, r in enumerate(automaton.rules) if r.glob]
        names = np.array([r.text for r in automaton.rules] + [None], object)
        verdicts = np.array([r.verdict for r in automaton.rules], object)
        for batch in batches:
            for part in K.chunks(batch, "canonical", 1 << 20):
                hit = automaton.matches(*K.text_bytes(part.column("canonical")))
                rule = np.full(part.num_rows, len(automaton.rules))
                verdict = np.full(part.num_rows, default, object)
                for k in reversed(globs):  # the first listed glob speaks
                    verdict[hit[:, k]] = verdicts[k]
                for k in named:
                    rule[hit[:, k]], verdict[hit[:, k]] = k, verdicts[k]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("host"), part.column("path"),
                     pa.array(names[rule], pa.string()), pa.array(verdict, pa.string())],
                    names=["page_id", "host", "path", "rule", "verdict"])
    return run


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = ALLOW) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages``."""
    host, path = host_and_path(pages["url"])
    cut = pages.select(pages["page_id"], host.alias("host"), path.alias("path")).withColumn("canonical", F.concat("host", "path"))
    schema = f"page_id {dict(pages.dtypes)['page_id']}, host string, path string, rule string, verdict string"
    return cut.mapInArrow(_mapper(rules, default), schema)
