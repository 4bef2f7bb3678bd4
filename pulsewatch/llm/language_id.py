"""Language identification as multilingual mixture inference.

Every language gets likelihoods of byte trigrams (with word borders), counted over the labelled training texts into a table of
fixed size. A text's words are drawn from a mixture of the languages; expectation-maximisation estimates the proportions. Then
languages leave one by one as long as the log-likelihood loses less than the penalty for one more proportion (half the
logarithm of the number of words, as in BIC), each time followed by more steps of estimation. What stays is the text's set of
languages; the one of the largest proportion is predicted, and that proportion is the score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewatch.llm.common import Words, give_back, pick, pieces, remainder

BUCKETS = 1 << 16
#: The model is one value per bucket and language, held by every task; more languages than this are refused.
MOST_LANGUAGES = 1000
PRIOR, STEPS, MORE_STEPS = 0.5, 8, 3
#: Least log-likelihood ratio that one word can give against a language.
FLOOR = -30.0
UNKNOWN = "und"


def _trigrams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of all words, a space before and after each, and how many each word has."""
    texts = words.to_pylist()
    raw = np.frombuffer((" " + " ".join(texts) + " ").encode(), np.uint8).astype(np.uint32)
    code = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    starts = np.nonzero(raw == 32)[0]
    sizes = np.diff(starts) - 1
    inside = np.ones(len(raw), bool)
    inside[starts[1:] - 1] = False  # a trigram that begins on a word's last byte reaches into the next word
    inside[-2:] = False
    return ((code * np.uint32(2654435761)) >> np.uint32(16))[inside[:-2]], sizes


def _counts(batches):
    total: dict[str, np.ndarray] = {}
    for batch in pieces(batches, 1000):
        words = Words(batch.column("text"))
        if not len(words.ids):
            continue
        buckets, sizes = _trigrams(words.values)
        langs = batch.column("lang").to_pylist()
        for lang in set(langs):
            of = np.repeat(np.array([x == lang for x in langs]), np.diff(words.ends))
            n = np.bincount(words.ids[of], minlength=len(words.values))
            total.setdefault(lang, np.zeros(BUCKETS))
            total[lang] += np.bincount(buckets, np.repeat(n, sizes), BUCKETS)
    give_back()
    for lang, n in total.items():
        at = np.nonzero(n)[0]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at].astype(np.int64))],
                                         names=["lang", "bucket", "n"])


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log-likelihood of every bucket (row) under each, from columns text and lang."""
    found = (docs.where("lang is not null and text is not null").select("text", "lang").mapInArrow(_counts, "lang string, bucket int, n long")
             .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    langs = sorted(r[0] for r in docs.where("lang is not null").select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    rows = found.toPandas()
    n = np.zeros((BUCKETS, len(langs)))
    n[rows["bucket"].to_numpy(int), np.searchsorted(langs, rows["lang"].to_numpy(str))] = rows["n"].to_numpy(float)
    return langs, np.log((n + PRIOR) / (n.sum(0) + PRIOR * BUCKETS))


def mixtures(likely: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Proportions of the languages for each text. ``likely``: every word's likelihood by language; no text is without words.

    A tie is resolved towards the language that comes first.
    """
    starts, n = ends[:-1], np.diff(ends)

    def steps(share, times):
        for _ in range(times):
            r = likely * np.repeat(share, n, 0)
            r /= r.sum(1, keepdims=True)
            share = np.add.reduceat(r, starts) / n[:, None]
        return share

    def level(share):
        return np.add.reduceat(np.log((likely * np.repeat(share, n, 0)).sum(1)), starts)

    share = steps(np.full((len(n), likely.shape[1]), 1 / likely.shape[1], likely.dtype), STEPS)
    penalty = 0.5 * np.log(n) + 1
    for _ in range(likely.shape[1] - 1):
        loss = np.full(share.shape, np.inf)
        now = level(share)
        for k in range(share.shape[1]):
            less = share.copy()
            less[:, k] = 0
            rest = less.sum(1)
            can = (share[:, k] > 0) & (rest > 0)
            less[~can] = share[~can]
            less /= less.sum(1, keepdims=True)
            loss[can, k] = (now - level(less))[can]
        worst = loss.shape[1] - 1 - loss[:, ::-1].argmin(1)
        out = loss[np.arange(len(n)), worst] <= penalty
        if not out.any():
            break
        share[np.nonzero(out)[0], worst[out]] = 0
        share /= share.sum(1, keepdims=True)
        share = steps(share, MORE_STEPS)
    return share


def _identify(langs: list[str], model: np.ndarray, keep_text: bool):
    def run(batches):
        for batch in pieces(batches, 1000):
            letter = batch.column("letter").to_numpy(zero_copy_only=False).astype(bool)
            best, score = np.full(batch.num_rows, -1), np.zeros(batch.num_rows)
            words = Words(batch.column("text"))
            rows = np.nonzero(letter & (np.diff(words.ends) > 0))[0]
            if langs and len(rows):
                buckets, sizes = _trigrams(words.values)
                by_word = np.add.reduceat(model[buckets], np.concatenate([[0], np.cumsum(sizes)[:-1]]))
                by_word = np.exp(np.maximum(by_word - by_word.max(1, keepdims=True), FLOOR)).astype(np.float32)
                kept = np.repeat(np.isin(np.arange(batch.num_rows), rows), np.diff(words.ends))
                ends = np.concatenate([[0], np.cumsum(np.diff(words.ends)[rows])])
                share = mixtures(by_word[words.ids[kept]], ends)
                best[rows], score[rows] = share.argmax(1), np.clip(share.max(1), 0, 1)
            named = pa.array([langs[k] if k >= 0 else UNKNOWN for k in best], pa.string())
            yield (batch.drop_columns(["letter"] if keep_text else ["letter", "text"]).append_column("lang_pred", named).append_column("score", pa.array(score, pa.float64())))
        give_back()
    return run


def identified(rows: DataFrame, langs: list[str], model: np.ndarray, keep_text: bool = True) -> DataFrame:
    """The given rows with lang_pred and score, from their column text."""
    model = model.astype(np.float32)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if keep_text or f.name != "text")
    return (rows.withColumn("letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
            .mapInArrow(_identify(langs, model, keep_text), f"{kinds}, lang_pred string, score double"))


def language_ids(docs: DataFrame, mod: int = 4, held: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of all texts.

    Learns from text and lang of the rows whose crc32(doc_id as text) modulo ``mod`` is not ``held`` and whose text and lang are
    not null. A null text, an empty text and one without a letter give ``und`` with score 0, and so does everything if
    nothing was learnt. Repeated rows get equal answers; a null id counts as empty text for the split; a tie goes to the language
    first in order; extra columns do not matter; an empty table gives an empty result.
    """
    docs = pick(docs, "doc_id", "text", "lang").withColumn("held_out", remainder(F.col("doc_id"), mod) == held)
    langs, model = learn(docs.where("not held_out"))
    return identified(docs.select("doc_id", "held_out", "text"), langs, model, keep_text=False).select("doc_id", "held_out", "lang_pred", "score")
