import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelspark.llm import merkle
from tests.llm.common import DOC_SCHEMA, ODD


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lowered(text):
    return text and "".join(c.lower() if c.isascii() else c for c in text)


def tree(nodes):
    """The root and, for each leaf, the (left, right) siblings upwards."""
    steps, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, at in enumerate(places):
            lo = at // 16 * 16
            steps[leaf].append(("".join(nodes[lo:at]), "".join(nodes[at + 1:lo + 16])))
        nodes = [H(*nodes[lo:lo + 16]) for lo in range(0, len(nodes), 16)]
        places = [at // 16 for at in places]
    return nodes[0], steps


def brute(rows):
    """Rows of (doc_id, text, lang, source, n_chars)."""
    sources = defaultdict(list)
    for doc_id, text, lang, source, n in rows:
        hashed = lambda t: H(*map(framed, (doc_id, source, lang, n, t)))  # noqa: B023, E731
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        sources[source].append((doc_id, hashed(text), hashed(lowered(text)) if hit else hashed(text)))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for s in order:
        sources[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        made[s] = tree([x[1] for x in sources[s]])
    root, upper = tree([made[s][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for (doc_id, leaf, now), steps in zip(sources[s], made[s][1]):
            path = steps + upper[k]
            for left, right in path:
                now = H(left, now, right)
            out.append((doc_id, leaf, made[s][0], root, H(*[x for both in path for x in both]), now, now == root))
    return sorted(out, key=str)


def result(docs):
    hit = F.crc32(docs["doc_id"].cast("string")) % 5 == 0
    return sorted((tuple(r) for r in merkle.manifest(docs, hit).collect()), key=str)


def rows():
    out = [(k, t, None, "odd", None) for k, t in enumerate(ODD)]
    out += [(1000 + k, f"Text Number {k}", "en", "big", k) for k in range(16 * 16 + 3)]
    out += [(5000 + k, "Same", "de", f"s{k}", 4) for k in range(20)]
    out += [(7000 + k, "In No Source", "fr", None, 1) for k in range(17)]
    return out + [(None, "No Id", None, None, None), (9001, "Empty name", "en", "", 2), (9002, "É", "en", "é", -1)]


def test_against_brute_force(spark):
    want = brute(rows())
    docs = spark.createDataFrame(rows(), DOC_SCHEMA)
    for name in ("tree", "n", "lo", "hi", "kids", "root", "digest"):
        docs = docs.selectExpr("*", f"'x' AS `{name}`")
    got = result(docs)
    assert got == want
    assert any(not r[-1] for r in got) and sum(r[-1] for r in got) > len(got) / 2


def test_repeated_rows_and_ids(spark):
    made = [(1, "A", None, "s", None)] * 20 + [(1, "B", None, "s", None), (2, "A", None, "s", None)]
    assert result(spark.createDataFrame(made, DOC_SCHEMA)) == brute(made)


@pytest.mark.parametrize("made", [[], [(3, "Only One", None, None, None)], [(0, "A", "en", "s", 1), (1, None, "en", "s", 1)]])
def test_small_tables(spark, made):
    assert result(spark.createDataFrame(made, DOC_SCHEMA)) == (brute(made) if made else [])


@pytest.mark.parametrize("parts", [1, 23])
def test_any_partitioning(spark, parts):
    docs = spark.createDataFrame(rows(), DOC_SCHEMA).repartition(parts)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert result(docs) == brute(rows())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_long_text(spark):
    made = [(0, "Long " * 400_000, "en", "s", 5), (5, "ü" * 100_000, "en", "t", 5)]
    assert result(spark.createDataFrame(made, DOC_SCHEMA)) == brute(made)
