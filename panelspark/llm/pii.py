"""Operator 5: personal data by fixed patterns and a linear-chain CRF.

The base patterns find e-mail addresses, IPv4 addresses, card numbers and phone
numbers.  A linear-chain conditional random field over word-shape features adds
spans that the patterns miss (another layout of a phone number, say); base spans
always stay.  It is trained by maximum likelihood (forward-backward in numpy,
Adagrad) in one task, from a small labelled table: at most about ``MAX_ROWS``
texts with their base spans, and for each text with spans ``COPIES`` more in which
every span is written in another layout (``LAYOUTS``), which the patterns miss.

Decoding is Viterbi over numpy batches.  A word is outside on every best path if
its emission for "outside" beats every other label by more than three transitions
can differ and the next word can lose by beginning a span instead of going on
with one: any other path gets better by that change.  Sequences are cut at such
words without changing the result, and the short rest is decoded together, step
by step over all sequences.

Words are runs of anything but ASCII white space.  Offsets are code points, the
end exclusive.  Cases: null or empty text: no spans.  Repeated rows are handled
row by row.  An empty labelled table gives a model that adds nothing.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import textkit as K

KINDS = ("email", "ip", "card", "phone")
#: Labelled texts that are learned, about (they are picked by hash).
MAX_ROWS = 1_500
#: Copies of a labelled text with its spans in other layouts.
COPIES = 3
#: Words in a training sequence.
PIECE = 32
#: Hash bits of a feature, and how many features a word has.
BITS, FEATURES = 14, 7

# The base patterns.
_AT_MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(2 * int(d) - 9 * (d > "4") for d in even)) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """The leftmost start of a match is the start of the run of local characters
    before its ``@``, so only those places are tried."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _AT_MAIL.match(text, start) if start < at else None
        if m:
            out.append(m.span())
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", free)
    return out


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind and start."""
    out = [(0, a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((3, *m.span()))
    return out


def as_text(spans: Iterable[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


# Word-shape features.  Labels: 0 outside, 1 + 2k begins kind k, 2 + 2k goes on.
LABELS = 1 + 2 * len(KINDS)
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = ord("a")
_CLASS[48:58] = ord("9")
#: Bytes of a word that is a feature by itself.
SHORT = 6
_DIGIT_BUCKETS = np.array([1, 2, 3, 4, 5, 7, 9, 11, 13, 20])


@dataclass
class Words:
    """The words of a slice: byte spans, row, and features (words x kinds of feature)."""
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    off: np.ndarray
    features: np.ndarray
    buf: np.ndarray


def words_of(text: pa.Array) -> Words:
    buf, off = K.text_bytes(text)
    start, end, row = K.word_spans(buf, off, K.NON_SPACE)
    classes = _CLASS[buf]
    turn = np.ones(len(buf), bool)
    turn[1:] = classes[1:] != classes[:-1]
    turn[start] = True
    turn &= K.NON_SPACE[buf]
    place = np.concatenate([[0], np.cumsum(turn)])
    shape = K.span_hash(classes[turn], place[start], place[end])  # runs of a class count once
    digits = np.concatenate([[0], np.cumsum(classes == ord("9"))])
    n = np.digitize(digits[end] - digits[start], _DIGIT_BUCKETS).astype(np.uint64)
    valid = np.zeros(len(start), np.uint64)  # passes the check of a card number or of an address
    for k in np.flatnonzero((n >= 4) & (end - start < 64)).tolist():
        word = buf[start[k]:end[k]].tobytes().decode("utf-8", "replace").strip("().,;:!?\"'#*$%&|<>")
        only = _NOT_DIGIT.sub("", word)
        if word.count(".") == 3:
            valid[k] = 1 + all(p and len(p) < 4 and p.isascii() and p.isdigit() and int(p) < 256 for p in word.split("."))
        elif 13 <= len(only) <= 19:
            valid[k] = 3 + luhn(only)
    short = np.where(end - start <= SHORT, K.span_hash(K.lower(buf), start, end), K.mix(n, 17))  # "at", "dot", "[at]"
    own = K.mix(shape + (n << np.uint64(8)) + valid, 7)
    edge = np.ones(len(start) + 1, bool)
    edge[1:-1] = row[1:] != row[:-1]

    def beside(what: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.where(edge[:-1], np.uint64(1), np.roll(what, 1)), np.where(edge[1:], np.uint64(2), np.roll(what, -1))
    (before, after), (word_before, word_after) = beside(own), beside(short)
    kinds = [K.mix(shape, 11), K.mix(own, 12), K.mix(own ^ K.mix(before, 13), 14), K.mix(own ^ K.mix(after, 15), 16),
             K.mix(short, 18), K.mix(shape ^ K.mix(word_before, 19), 20), K.mix(shape ^ K.mix(word_after, 21), 22)]
    features = np.stack([(h >> np.uint64(64 - BITS)).astype(np.int32) + (k << BITS) for k, h in enumerate(kinds)], axis=1)
    return Words(start, end, row, off, features, buf)


@dataclass
class Model:
    """Emission weights by feature and label, and transitions (from, to).  Row
    ``LABELS`` of ``moves`` is the start of a text."""
    emit: np.ndarray
    moves: np.ndarray

    @staticmethod
    def empty() -> Model:
        emit = np.zeros((FEATURES << BITS, LABELS), np.float32)
        moves = np.zeros((LABELS + 1, LABELS), np.float32)
        moves[:, 0] = 1.0
        return Model(emit, moves)


def _forbidden() -> np.ndarray:
    """-inf where a label cannot follow: "goes on" needs its own kind before."""
    ban = np.zeros((LABELS + 1, LABELS))
    for k in range(len(KINDS)):
        ban[:, 2 + 2 * k] = -30.0
        ban[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0.0
    return ban


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def fit(features: np.ndarray, labels: np.ndarray, length: np.ndarray, rounds: int = 60, rate: float = 0.5, l2: float = 1e-4) -> Model:
    """Maximum likelihood on sequences padded to one size: features (n, T, kinds),
    labels (n, T); ``length`` words of each count."""
    n, size, _ = features.shape
    if not n:
        return Model.empty()
    places, inverse = np.unique(features, return_inverse=True)
    inverse = inverse.reshape(features.shape)
    emit, moves, ban = np.zeros((len(places), LABELS)), np.zeros((LABELS + 1, LABELS)), _forbidden()
    emit_sq, moves_sq = np.full_like(emit, 1e-6), np.full_like(moves, 1e-6)
    on = np.arange(size)[None, :] < length[:, None]
    truth = np.zeros((n, size, LABELS))
    truth[np.arange(n)[:, None], np.arange(size)[None, :], labels] = 1.0
    truth *= on[:, :, None]
    before = np.concatenate([np.full((n, 1), LABELS), labels[:, :-1]], axis=1)
    seen = np.zeros_like(moves)
    np.add.at(seen, (before[on], labels[on]), 1.0)
    total = float(on.sum())
    for _ in range(rounds):
        e = emit[inverse].sum(axis=2)
        m = moves + ban
        alpha, beta = np.zeros((n, size, LABELS)), np.zeros((n, size, LABELS))
        alpha[:, 0] = m[LABELS] + e[:, 0]
        for t in range(1, size):
            step = _sum_exp(alpha[:, t - 1, :, None] + m[None, :LABELS], 1) + e[:, t]
            alpha[:, t] = np.where(on[:, t, None], step, alpha[:, t - 1])
        norm = _sum_exp(alpha[:, -1], 1)
        gradient_m = -seen
        for t in range(size - 1, 0, -1):
            ahead = e[:, t] + beta[:, t]
            pair = np.exp(alpha[:, t - 1, :, None] + m[None, :LABELS] + ahead[:, None, :] - norm[:, None, None]) * on[:, t, None, None]
            gradient_m[:LABELS] += pair.sum(axis=0)
            step = _sum_exp(m[None, :LABELS] + ahead[:, None, :], 2)
            beta[:, t - 1] = np.where(on[:, t, None], step, 0.0)
        chance = np.exp(alpha + beta - norm[:, None, None]) * on[:, :, None]
        # words after the end carry no weight; the start moves come from the first word
        gradient_m[LABELS] += chance[:, 0].sum(axis=0)
        miss = (chance - truth)[on]
        gradient_e = np.zeros_like(emit)
        for k in range(inverse.shape[2]):
            which = inverse[:, :, k][on]
            for s in range(LABELS):
                gradient_e[:, s] += np.bincount(which, weights=miss[:, s], minlength=len(places))
        for w, g, sq in ((emit, gradient_e / total * 100, emit_sq), (moves, gradient_m / total * 100, moves_sq)):
            g = g + l2 * w
            sq += g * g
            w -= rate * g / np.sqrt(sq)
    made = Model.empty()
    made.emit[places] = emit
    # A feature never seen in training says "outside".
    unseen = np.ones(FEATURES << BITS, bool)
    unseen[places] = False
    made.emit[unseen, 0] = 1.0
    made.moves = (moves + ban).astype(np.float32)
    return made


def decode(words: Words, model: Model) -> np.ndarray:
    """Best label of every word."""
    n = len(words.start)
    labels = np.zeros(n, np.int64)
    if not n:
        return labels
    code = np.zeros(n, np.uint64)
    for k in range(words.features.shape[1]):
        code = K.mix(code ^ words.features[:, k].astype(np.uint64), k)
    _, lead, same = np.unique(code, return_index=True, return_inverse=True)
    scores = model.emit[words.features[lead]].sum(axis=1)  # few distinct combinations
    moves = model.moves.astype(np.float64)
    low = moves[_forbidden() == 0].min()
    on_over_begin = np.maximum(scores[:, 2::2] - scores[:, 1::2], 0).max(axis=1)[same]
    after = np.zeros(n)
    after[:-1] = np.where(words.row[1:] == words.row[:-1], on_over_begin[1:], 0.0)
    certain = (scores[:, 0] - scores[:, 1:].max(axis=1))[same] > 3 * (moves.max() - low) + after + 1e-3
    open_at = np.flatnonzero(~certain)
    if not len(open_at):
        return labels
    first = np.ones(len(open_at), bool)
    first[1:] = (np.diff(open_at) > 1) | (words.row[open_at[1:]] != words.row[open_at[:-1]])
    begin = np.flatnonzero(first)
    size = np.diff(np.append(begin, len(open_at)))
    order = np.argsort(-size, kind="stable")
    start, size = open_at[begin][order], size[order]
    after_start = (start == 0) | (words.row[start - 1] != words.row[start])
    end = start + size
    before_certain = (end < n) & (words.row[np.minimum(end, n - 1)] == words.row[start])
    best = np.where(after_start[:, None], moves[LABELS], moves[0]) + scores[same[start]]
    back, last = [], np.zeros((len(start), LABELS))
    for t in range(1, int(size[0]) + 1):
        on = int(np.searchsorted(-size, -t, "left"))  # sequences with a word t
        last[on:len(best)] = best[on:]
        if not on:
            break
        step = best[:on, :, None] + moves[None, :LABELS]
        back.append(step.argmax(axis=1).astype(np.int8))
        best = step.max(axis=1) + scores[same[start[:on] + t]]
    label = (last + np.where(before_certain[:, None], moves[:LABELS, 0], 0.0)).argmax(axis=1)
    for t in range(int(size[0]) - 1, -1, -1):
        on = int(np.searchsorted(-size, -t, "left"))
        labels[start[:on] + t] = label[:on]
        if t:
            label = label.copy()
            label[:on] = back[t - 1][np.arange(on), label[:on]]
    return labels


_TRIM = b".,;:!?\"'#*$%&|<>"
#: What an added span of a kind must have to be one: at least so many digits, at most so many words.
MIN_DIGITS, MAX_WORDS = (0, 4, 12, 7), 16


def added_spans(words: Words, labels: np.ndarray) -> dict[int, list[Span]]:
    """Byte spans of the labelled runs by row, trimmed of punctuation around them.
    A run with fewer digits or more words than its kind has is none."""
    out: dict[int, list[Span]] = {}
    at = np.flatnonzero(labels).tolist()
    k = 0
    while k < len(at):
        i = j = at[k]
        kind = (int(labels[i]) - 1) // 2
        while k + 1 < len(at) and at[k + 1] == j + 1 and labels[j + 1] == 2 + 2 * kind and words.row[j + 1] == words.row[i]:
            k += 1
            j += 1
        k += 1
        a, b = int(words.start[i]), int(words.end[j])
        raw = words.buf[a:b].tobytes()
        a, b = a + len(raw) - len(raw.lstrip(_TRIM)), b - (len(raw) - len(raw.rstrip(_TRIM)))
        if a < b and j - i < MAX_WORDS and sum(48 <= c < 58 for c in raw) >= MIN_DIGITS[kind]:
            base = int(words.off[words.row[i]])
            out.setdefault(int(words.row[i]), []).append((kind, a - base, b - base))
    return out


def find(column: pa.Array, model: Model) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of every text of a slice."""
    words = words_of(column)
    more = added_spans(words, decode(words, model))
    found = []
    for r, text in enumerate(column.to_pylist()):
        base = base_spans(text) if text else []
        every = list(base)
        if r in more:
            raw = text.encode()
            for kind, a, b in more[r]:
                a, b = len(raw[:a].decode()), len(raw[:b].decode())
                if not any(x < b and a < y for _, x, y in base):
                    every.append((kind, a, b))
        found.append((base, sorted(every)))
    return found


def label_words(words: Words, spans: list[list[Span]], texts: list[str | None]) -> np.ndarray:
    """Labels of words by the spans (code points) of their rows."""
    labels = np.zeros(len(words.start), np.int64)
    first = np.searchsorted(words.row, np.arange(len(spans) + 1))
    for r, row_spans in enumerate(spans):
        lo, hi = int(first[r]), int(first[r + 1])
        base = int(words.off[r])
        for kind, a, b in row_spans:
            a, b = len(texts[r][:a].encode()), len(texts[r][:b].encode())
            i = lo + int(np.searchsorted(words.end[lo:hi] - base, a, "right"))
            j = lo + int(np.searchsorted(words.start[lo:hi] - base, b, "left"))
            if i < j and not labels[i:j].any():
                labels[i:j] = 2 + 2 * kind
                labels[i] = 1 + 2 * kind
    return labels


def _train_mapper(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features, labels, sizes = [], [], []
    for batch in batches:
        for part in K.chunks(batch, "text"):
            texts = part.column("text").to_pylist()
            words = words_of(part.column("text"))
            spans = [[(KINDS.index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in x.split(",") if s)]
                     for x in part.column("spans").to_pylist()]
            truth = label_words(words, spans, texts)
            marked = np.isin(_CLASS[words.buf], list(b"9@+"))
            sums = np.concatenate([[0], np.cumsum(marked)])
            special = sums[words.end] > sums[words.start]
            first = np.searchsorted(words.row, np.arange(len(texts) + 1)).tolist()
            for lo, hi in zip(first[:-1], first[1:]):
                for a in range(lo, hi, PIECE):  # pieces with a digit, sign or label, and the text's first one
                    b = min(a + PIECE, hi)
                    if a == lo or special[a:b].any() or truth[a:b].any():
                        features.append(words.features[a:b])
                        labels.append(truth[a:b])
                        sizes.append(b - a)
    n = len(sizes)
    x, y = np.zeros((n, PIECE, FEATURES), np.int64), np.zeros((n, PIECE), np.int64)
    for k in range(n):
        x[k, :sizes[k]], y[k, :sizes[k]] = features[k], labels[k]
    model = fit(x, y, np.array(sizes, np.int64))
    yield pa.RecordBatch.from_arrays([pa.array([model.emit.tobytes()]), pa.array([model.moves.tobytes()])], names=["emit", "moves"])


def train(labelled: DataFrame) -> Model:
    """A model from rows ``text, spans`` (``kind:start:end``, comma-joined)."""
    rows = labelled.select("text", "spans").where("text IS NOT NULL AND spans IS NOT NULL").repartition(1) \
        .sortWithinPartitions("text", "spans").mapInArrow(_train_mapper, "emit binary, moves binary").collect()
    if not rows:
        return Model.empty()
    return Model(np.frombuffer(rows[0]["emit"], np.float32).reshape(-1, LABELS),
                 np.frombuffer(rows[0]["moves"], np.float32).reshape(-1, LABELS))


def _mail(by_at: str, by_dot: str):
    return lambda text: text.replace("@", by_at).replace(".", by_dot)


def _parts(by: str):
    return lambda text: by.join(text.split("."))


def _fours(by: str):
    def write(text: str) -> str:
        digits = _NOT_DIGIT.sub("", text)
        return by.join(digits[k:k + 4] for k in range(0, len(digits), 4))
    return write


def _phone(form: str):
    def write(text: str) -> str:
        digits = _NOT_DIGIT.sub("", text)
        return form.format(land=digits[:-10], area=digits[-10:-7], mid=digits[-7:-4], last=digits[-4:])
    return write


#: Other layouts of a base span, by kind, in the order of ``KINDS``.
LAYOUTS = (
    (_mail(" at ", " dot "), _mail(" [at] ", " [dot] "), _mail("[at]", "[dot]"), _mail("(at)", "(dot)"), _mail(" (at) ", " (dot) "),
     _mail(" @ ", "."), _mail(" AT ", " DOT "), _mail(" at ", ".")),
    (_parts("[.]"), _parts(" . "), _parts("(.)"), _parts(" dot ")),
    (_fours("."), _fours("/"), _fours(" - "), _fours("_"), _fours("  ")),
    (_phone("({area}) {mid}-{last}"), _phone("{area}-{mid}-{last}"), _phone("{area}.{mid}.{last}"), _phone("{area} {mid} {last}"),
     _phone("00{land} {area} {mid} {last}"), _phone("{area}/{mid}-{last}"), _phone("tel:{area}-{mid}-{last}")),
)


def relaid(text: str, spans: list[Span], turn: int) -> tuple[str, list[Span]]:
    """``text`` with its spans in other layouts, and where they stand then; ``turn``
    picks the layouts.  Of spans that overlap the leftmost is taken."""
    out, found, at, size = [], [], 0, 0
    for kind, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a < at:
            continue
        layouts = LAYOUTS[kind]
        new = layouts[(turn * 5 + zlib.crc32(text[a:b].encode())) % len(layouts)](text[a:b])
        out += [text[at:a], new]
        size += a - at
        found.append((kind, size, size + len(new)))
        size, at = size + len(new), b
    return "".join([*out, text[at:]]), sorted(found)


def _label_mapper(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in K.chunks(batch, "text"):
            texts, spans = [], []
            for text in part.column("text").to_pylist():
                base = base_spans(text)
                for new, where in [(text, base), *(relaid(text, base, k) for k in range(COPIES) if base)]:
                    texts.append(new)
                    spans.append(as_text(where))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(spans, pa.string())], names=["text", "spans"])


def labelled_by_patterns(docs: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """A small labelled table: about ``max_rows`` of the texts with a digit or an
    ``@``, picked by hash, with the base spans as labels, and ``COPIES`` of each
    that has spans with these in other layouts."""
    telling = docs.where(docs["text"].rlike("[0-9@]")).select(docs["text"])
    n = telling.count()
    picked = telling.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(min(1.0, max_rows / max(n, 1)) * (1 << 30)))
    return picked.mapInArrow(_label_mapper, "text string, spans string")


def _scan_mapper(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for row, text in K.row_chunks(batches):
            found = find(text, model)
            yield pa.RecordBatch.from_arrays(
                [row, pa.array([as_text(base) for base, _ in found], pa.string()), pa.array([as_text(every) for _, every in found], pa.string())],
                names=["row", "base", "spans"])
    return run


def scan(docs: DataFrame, model: Model, columns: tuple[str, ...] = ()) -> DataFrame:
    """``row`` (all columns of ``docs`` or ``columns``), and the ``base`` and all
    ``spans`` as ``kind:start:end``, by kind and start, comma-joined."""
    rows = K.as_rows(docs, *columns)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_scan_mapper(shared), f"row {K.row_type(rows)}, base string, spans string")


def redact(text: str | None, spans: str) -> str | None:
    """``text`` with every span replaced by its kind in brackets."""
    if not spans:
        return text
    runs = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(",")))
    out, at = [], 0
    for a, b, kind in runs:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def _mask_mapper(shared, names: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for row, text in K.row_chunks(batches):
            spans = [as_text(every) for _, every in find(text, model)]
            masked = [redact(t, s) for t, s in zip(text.to_pylist(), spans)]
            columns = []
            for k, name in enumerate(names):
                column = row.field(k)
                if name == "text":
                    column = pa.array(masked, column.type)
                elif name == "n_chars":
                    column = pa.array([len(m) if s else n for m, s, n in zip(masked, spans, column.to_pylist())], column.type)
                columns.append(column)
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def masked(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` with every span replaced; ``n_chars``, if there is
    such a column, is counted anew where a text has changed."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return K.as_rows(docs).mapInArrow(_mask_mapper(shared, docs.columns), docs.schema)
