import random

from pulsewatch.llm import decontaminate as D
from tests.llm import brute


def tables():
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 8)))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([14, 25, 40, 59, 30, 5, 3])] + [(50, None), (51, "!!!"), (52, "")]
    docs = []
    for i in range(40):
        w = [word() for _ in range(r.randrange(0, 120))]
        if i % 2 and i < 30:
            own = items[i % 7][1].split()
            if i % 4 == 1 and len(own) > 20:
                own[r.randrange(len(own))] = "changed"
            if i % 8 == 3:
                own = [x.upper() + "," for x in own]
            at = r.randrange(len(w) + 1)
            w[at:at] = own
        docs.append((i, " ".join(w)))
    docs += [(100, None), (101, ""), (102, items[6][1]), (103, items[0][1]), (103, items[0][1]), (104, items[0][1] + " " + items[1][1]), (105, "?!")]
    return docs, items


def test_finds_what_all_windows_find(spark):
    docs, items = tables()
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n int")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, words int")
    got = {(r["doc_id"], r["item_id"]) for r in D.matches(df, bench).collect()}
    assert got == brute.window_matches(docs, items)
    kept = sorted(r[0] for r in D.decontaminated(df, bench, "doc_id", "text").collect())
    assert kept == sorted(i for i, _ in docs if i not in {x for x, _ in got})


def test_empty_tables(spark):
    docs, items = tables()
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert D.matches(df.limit(0), bench).collect() == [] and D.matches(df, bench.limit(0)).collect() == []
