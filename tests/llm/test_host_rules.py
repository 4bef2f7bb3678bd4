import random

from pulsewatch.llm import host_rules as H
from tests.llm import brute


def docs():
    r = random.Random(4)
    out = []
    for i in range(60):
        words = [r.choice(["a", "b", "c", "dd", "é", "|", "x***"]) for _ in range(r.randrange(0, 120))]
        out.append((i, "".join(w + r.choice([" ", "  ", "\n", "\t", " \n "]) for w in words), "h%d" % (i % 3)))
    return out + [(100, None, None), (101, "", "h0"), (102, "same same same", None), (103, "l\nl\n\nl", "h1"), (103, "l\nl\n\nl", "h1"),
                  (104, "one \x0b two\x0cthree " * 400, "h2")]


def test_measures_equal_plain_ones(spark):
    df = spark.createDataFrame([(i, t, h, 1) for i, t, h in docs()], "doc_id long, text string, source string, words int")
    rows = H.host_rules(df).collect()
    got = sorted((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in rows)
    assert got == sorted(brute.measured_rows([(i, t) for i, t, _ in docs()]))
    assert all(not r["kept"] for r in rows if r["base_failed"])


def good(r, n):
    return " ".join(f"w{r.randrange(9999)}" for _ in range(n))


def test_hosts_of_ordinary_rates_differ_in_verdict(spark):
    """One host fails twice as often as the others, all far below one half; the same text stays elsewhere and goes there."""
    r = random.Random(5)
    rows = [(i, good(r, 120) if r.random() > (0.24 if i % 20 == 7 else 0.12) else "spam", f"host{i % 20}") for i in range(6000)]
    repeated = " ".join(["one two three four five six"] * 6) + " " + good(r, 84)    # 30 % repeated words: passes the plain rules only
    rows += [(9000 + k, repeated, f"host{k}") for k in range(20)]
    rows += [(9500, good(r, 60), "host7"), (9501, good(r, 30) + " *** ||| ###" * 5, "host3"), (9600, "spam", "small"), (9601, repeated, "small")]
    out = {x["doc_id"]: x for x in H.host_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert [k for k in range(20) if not out[9000 + k]["kept"]] == [7]
    assert out[9500]["kept"] and not out[9501]["kept"] and out[9601]["kept"] and not out[9600]["kept"]
    assert max(x["host_rate"] for x in out.values()) < 0.4


def test_plain_rules_decide_everywhere(spark):
    """Lines that repeat and symbols, on a host like all others."""
    r = random.Random(6)
    lines = "\n".join([good(r, 30)] + ["the same line again", "and one more line"] * 4 + [good(r, 40)])
    rows = [(i, good(r, 100), f"h{i % 3}") for i in range(90)] + [(100, lines, "h0"), (101, good(r, 60) + " ####" * 40, "h1")]
    out = {x["doc_id"]: x for x in H.host_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not out[100]["kept"] and not out[100]["base_failed"] and not out[101]["kept"] and all(out[i]["kept"] for i in range(90))


def test_empty_table(spark):
    assert H.host_rules(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []
