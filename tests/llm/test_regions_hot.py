"""Regions of one anchor that differ only at their edges do not gather in one task."""
import random

import pyarrow as pa

from panelspark.llm import bwt, substrings
from tests.llm.common import frame
from tests.llm.test_repeats import brute_bytes, brute_words


def seen(monkeypatch, module, folder):
    """Bytes of each bucket's classes, by the module's judge."""
    judge = module.judge

    def noting(width):
        run = judge(width)

        def noted(group: pa.Table) -> pa.Table:
            with open(f"{folder}/{random.SystemRandom().random()}", "w") as f:
                f.write(str(sum(map(len, group.column("words").to_pylist()))))
            return run(group)
        return noted

    monkeypatch.setattr(module, "judge", noting)
    return lambda: [int(p.read_text()) for p in folder.iterdir()]


def test_words_of_a_common_tail(spark, monkeypatch, tmp_path):
    rng = random.Random(5)
    tail = " ".join(f"t{k}" for k in range(40))
    texts = [" ".join(f"u{rng.random()}" for _ in range(40)) + " " + tail for _ in range(400)]
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 10_000)
    buckets = seen(monkeypatch, substrings, tmp_path)
    got = substrings.dedup(frame(spark, texts)).collect()
    want = brute_words(texts, 35)
    for r in got:
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == want[r["doc_id"]]
    assert len(got) == len(texts) and max(buckets()) <= 2 * 10_000


def test_bytes_of_a_common_tail(spark, monkeypatch, tmp_path):
    rng = random.Random(6)
    tail = "".join(chr(97 + k * 7 % 26) + str(k) for k in range(30)) + "\u00e9"
    texts = ["".join(rng.choices("abcdefgh\u00e9", k=60)) + tail for _ in range(400)]
    monkeypatch.setattr(bwt, "BUCKET_BYTES", 10_000)
    buckets = seen(monkeypatch, bwt, tmp_path)
    got = bwt.dedup(frame(spark, texts)).collect()
    want = brute_bytes(range(len(texts)), texts, 50)
    for r in got:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]]
    assert len(got) == len(texts) and max(buckets()) <= 2 * 10_000
