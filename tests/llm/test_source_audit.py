import random
import re
from collections import Counter, defaultdict

import duckdb

from pulsewatch.llm import source_audit as A

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, TEXT string, term int"


def brute(rows, least=3, ranks=200):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    found, seen, n = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        words = TERM.findall(lower(text))
        found[lang or "", source or ""].update(words)
        seen[lang or ""].update(set(words))
        n[lang or ""].update(words)
    out = []
    for lang in seen:
        kept = [t for t, k in seen[lang].items() if k >= least]
        mine = {s: {t: found[x, s][t] for t in kept} for x, s in found if x == lang}
        share = {s: {t: 1 + 10**9 * (c + 1) // (sum(own.values()) + len(kept)) for t, c in own.items()} for s, own in mine.items()}
        whole = {t: 1 + 10**9 * (n[lang][t] + 1) // (sum(n[lang][t] for t in kept) + len(kept)) for t in kept}
        for s, own in mine.items():
            f = lambda p, q: (p - q) ** 2 // q
            pairs = [(sum(f(share[s][t], share[o][t]) for t in kept), o) for o in mine if o != s]
            terms = [(f(share[s][t], whole[t]), t) for t in kept if own[t] and share[s][t] > whole[t]]
            for part, items, top in (("pair", pairs, len(pairs)), ("term", terms, ranks)):
                order = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:top]
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(order, 1)]
    return sorted(out)


def corpus():
    r = random.Random(3)
    words = ["Alpha", "beta", "gämma", "ДА", "x1y", "l'eau", "日本", *[f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(8)]]
    rows = [(i, " ".join(words[min(int(r.expovariate(0.04)), len(words) - 1)] for _ in range(r.randrange(0, 60))), r.choice(["en", "de", None]),
             f"s{min(int(r.expovariate(0.3)), 9)}", "X", 1) for i in range(400)]
    rows += [(900, None, "en", "empty", None, 1), (901, "", "xx", "only", None, 1), (902, "12 34", "xx", None, None, 1), (903, "once", "yy", "a", None, 1)]
    return rows + rows[:3] + [(904, "alpha " * 30_000 + "beta " * 20_000, "en", "s1", None, 1)]


def collected(df):
    return sorted(tuple(r) for r in df.collect())


def test_equals_brute_force_with_any_blocks_and_tiles(spark, monkeypatch):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert collected(A.divergences(df)) == want
    monkeypatch.setattr(A, "TILE", 3)
    monkeypatch.setattr(A, "BLOCK", 20)
    monkeypatch.setattr(A, "SENT_ROWS", 0)
    monkeypatch.setattr(A, "STEP_CELLS", 50)
    monkeypatch.setattr(A, "STEP_BYTES", 1000)      # the long text is counted in parts
    assert collected(A.divergences(df)) == want
    assert collected(A.divergences(df, ranks=2)) == brute(rows, ranks=2)


def test_bitsets_hold_each_count(spark):
    """Joint cells by AND and popcount, and zeros by complement, add up to all terms."""
    import numpy as np

    p, q = A._share(np.array([0, 5, 9_000_000_000]), np.array([10, 10, 10**13])), 1 + 10**9 * (9_000_000_000 + 1) // 10**13
    assert p.tolist() == [1 + 10**8, 1 + 6 * 10**8, q]
    got = spark.createDataFrame([(0, 10), (5, 10), (9_000_000_000, 10**13)], "n long, base long").select(A.share("n", "base")).collect()
    assert [r[0] for r in got] == p.tolist()


def test_statement_equals_brute_force():
    rows = [r[:4] for r in corpus()[:-1]]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    assert sorted(con.execute(A.oracle()).fetchall()) == brute(rows)


def test_empty_table_and_nothing_kept(spark):
    assert A.divergences(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, "one two", "en", "a", None, 1), (2, "three", "en", "b", None, 1)]
    assert collected(A.divergences(spark.createDataFrame(rows, SCHEMA))) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
