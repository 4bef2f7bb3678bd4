import random

from pulsewatch.llm import language_id as L

SOUNDS = {"xx": ["ka", "to", "mi", "ra"], "yy": ["sch", "ein", "ung", "ber"], "zz": ["ção", "lhe", "dos", "que"]}


def text(r, lang, n):
    return " ".join("".join(r.choice(SOUNDS[lang]) for _ in range(r.randrange(1, 4))) for _ in range(n))


def test_held_out_texts_mixtures_and_odd_rows(spark):
    r = random.Random(8)
    rows = [(i, text(r, lang, 40), lang, "z") for i in range(300) for lang in [list(SOUNDS)[i % 3]]]
    rows += [(900, None, "xx", "z"), (901, "", "xx", "z"), (902, "12 34 !!", "xx", "z"), (903, text(r, "yy", 30), None, "z"), (None, text(r, "zz", 30), "zz", "z"),
             (904, text(r, "xx", 60) + " " + text(r, "yy", 30), None, "z"), (905, "ка то", None, "z"), (0, rows[0][1], "xx", "z")]
    got = L.language_ids(spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")).collect()
    assert len(got) == len(rows)
    want = {i: lang for i, _, lang, _ in rows}
    held = [x for x in got if x["held_out"] and x["doc_id"] is not None and x["doc_id"] < 300]
    assert held and all(x["lang_pred"] == want[x["doc_id"]] for x in held)
    by = {x["doc_id"]: x for x in got}
    assert [by[k]["lang_pred"] for k in (900, 901, 902, 903)] == ["und", "und", "und", "yy"] and by[None]["lang_pred"] == "zz"
    assert by[904]["lang_pred"] == "xx" and 0.55 < by[904]["score"] < 0.8
    assert by[0]["score"] > 0.95 and all(0 <= x["score"] <= 1 for x in got) and by[900]["score"] == 0


def test_nothing_to_learn_from(spark):
    rows = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in L.language_ids(rows).collect()] == [("und", 0.0)]
    assert L.language_ids(rows.limit(0)).collect() == []
