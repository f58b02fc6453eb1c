import fnmatch
import random

import numpy as np

from panelspark.llm import catalog, urls


def judged(spark, values):
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(values)], "page_id long, url string, host string")
    return {r["page_id"]: r for r in urls.judge(pages, catalog.URL_RULES).collect()}


def test_rules_and_parts(spark):
    cases = {
        "https://WWW.Example.NET/en/1?q=/de/": ("www.example.net", "/en/1", "example.net/en/", "allow"),
        "http://example.net/fr/": ("example.net", "/fr/", "net/", "block"),
        "http://badexample.net/en/": ("badexample.net", "/en/", "net/", "block"),
        "x://example.com/de/#a": ("example.com", "/de/", "example.com/de/", "block"),
        "x://example.com/DE/": ("example.com", "/DE/", None, "allow"),
        "x://net": ("net", "", None, "allow"),
        "x://net/": ("net", "/", "net/", "block"),
        "x://a.org/fr/b/login": ("a.org", "/fr/b/login", "org/fr/", "allow"),
        "x://a.org/login": ("a.org", "/login", None, "block"),
        "x://a?b://c/d": ("a", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "x://é.NET/ü": ("é.net", "/ü", "net/", "block"),
        "x://h/" + "a" * 5000 + ".exe": ("h", "/" + "a" * 5000 + ".exe", None, "block"),
    }
    got = judged(spark, [*cases, *cases])  # repeated rows
    for k, want in enumerate([*cases.values(), *cases.values()]):
        r = got[k]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == want
    assert judged(spark, []) == {}


def test_automaton_equals_fnmatch():
    rng = random.Random(1)
    globs = ["".join(rng.choices("ab?*/.", k=rng.randint(1, 9))) for _ in range(60)]
    texts = ["".join(rng.choices("ab/.c", k=rng.randint(0, 14))) for _ in range(500)]
    automaton = urls.Automaton([urls.Rule(g, "block", glob=True) for g in globs])
    assert automaton.words > 1
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    hit = automaton.matches(np.frombuffer("".join(texts).encode(), np.uint8), off)
    for r, text in enumerate(texts):
        assert [bool(x) for x in hit[r]] == [fnmatch.fnmatchcase(text, g) for g in globs]
