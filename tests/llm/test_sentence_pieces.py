import random

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from pulsewatch.llm import sentence_pieces as S
from pulsewatch.llm.common import public_file

PATH = public_file("piece_bpe_32k.model")


def texts(n):
    r, letters = random.Random(1), "aaabbeethino  \n\t  ▁é漢😀xyz.,0123  "
    return ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(n)] + [" " * 333 + "x", "internationalization" * 300, "", " ", "\n"]


def test_ids_equal_the_library(spark):
    library, encoder = sentencepiece.SentencePieceProcessor(model_file=PATH), S.Encoder(S.read_model(PATH))
    for x in texts(1500):
        ids = encoder.encode(x)
        assert ids.tolist() == library.encode(x)
        assert encoder.decode(ids) == library.decode(ids.tolist()) == x.replace("▁", " ")


def test_few_ids_wait_to_be_committed():
    encoder = S.Encoder(S.read_model(PATH))
    long, given = "x" + "internationalization" * 500, 0
    for k, _ in enumerate(encoder.stream(long)):
        given = k
    assert given > 1000


def test_every_stretch_of_a_table_goes_through_the_streaming_search(spark, sf_dir):
    """The number of commits is that of the different stretches, all others are remembered; few boundaries are held at a time."""
    encoder = S.Encoder(S.read_model(PATH))
    rows = [r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    stretches = {x for t in rows if t for x in encoder.cut.findall((S.SPACE if encoder.prefix else "") + t.replace(" ", S.SPACE))}
    for t in rows:
        encoder.encode(t)
    long = sum(len(x) // encoder.longest for x in stretches)
    assert len(stretches) > 5000 and len(stretches) <= encoder.commits <= len(stretches) + long
    assert encoder.window <= 2 * encoder.longest + 1
    encoder.encode("internationalization" * 3000)
    assert encoder.window <= 2 * encoder.longest + 1


def unigram(tmp_path):
    """A small unigram model written by hand."""
    r, proto = random.Random(3), pb.ModelProto()
    proto.trainer_spec.model_type = 1
    proto.trainer_spec.byte_fallback = True
    proto.normalizer_spec.add_dummy_prefix = True
    proto.normalizer_spec.remove_extra_whitespaces = False
    proto.normalizer_spec.escape_whitespaces = True
    proto.normalizer_spec.name = "identity"
    add = lambda p, s, t: proto.pieces.append(pb.ModelProto.SentencePiece(piece=p, score=s, type=t))
    for name, kind in (("<unk>", 2), ("<s>", 3), ("</s>", 3)):
        add(name, 0, kind)
    for b in range(256):
        add(f"<0x{b:02X}>", 0, 6)
    found = set("abc▁")
    while len(found) < 60:
        found.add("▁" * r.randrange(2) + "".join(r.choice("abc") for _ in range(r.randrange(1, 5))))
    for p in sorted(found):
        add(p, -r.random() * 10 - len(p), 1)
    path = tmp_path / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    return str(path)


def test_unigram_paths_have_the_best_score(tmp_path):
    path = unigram(tmp_path)
    library, model = sentencepiece.SentencePieceProcessor(model_file=path), S.read_model(path)
    encoder, r = S.Encoder(model), random.Random(4)
    value = lambda ids: sum(model["pieces"][i][1] for i in ids)
    for _ in range(500):
        x = "".join(r.choice("abc ab") for _ in range(r.randrange(1, 80)))
        ids = encoder.encode(x)
        assert value(ids.tolist()) == pytest.approx(value(library.encode(x)), abs=1e-3) and encoder.decode(ids) == x


def test_tables(spark):
    rows = [(k, x, 1) for k, x in enumerate(texts(50))] + [(None, None, 1), (3, "same", 1), (3, "same", 1)]
    out = S.encoded(spark.createDataFrame(rows, "doc_id long, text string, ids int"), "doc_id", "text")
    got = out.collect()
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert len(got) == len(rows)
    for r in got:
        assert r["ids"] == (None if r["text"] is None else library.encode(r["text"])) and r["round_trip"] in (None, True)
    back = S.decoded(out.select("doc_id", "ids"), "doc_id", "ids").collect()
    key = lambda t: (t is None, t or "")
    assert sorted((r["text"] for r in back), key=key) == sorted((None if x is None else x.replace("▁", " ") for _, x, _ in rows), key=key)
    assert S.encoded(out.select("doc_id", "text").limit(0), "doc_id").collect() == []


def test_a_word_is_searched_once_whatever_follows_it():
    """No piece goes on from a letter to a mark or back: these are stretches of their own."""
    encoder, library, r = S.Encoder(S.read_model(PATH)), sentencepiece.SentencePieceProcessor(model_file=PATH), random.Random(6)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randrange(4, 12))) for _ in range(200)]
    for mark in ("", ",", ".", "...", ")", "!?", "$$$", "1"):
        text = " ".join(f"{w}{mark}" for w in words)
        assert encoder.encode(text).tolist() == library.encode(text)
    assert encoder.commits <= len(words) + 20


@pytest.mark.parametrize("seed", range(40))
def test_neighbours_fit_as_merging_says(seed):
    """Also if a piece comes before its parts, cannot be merged or has the score of others."""
    r, names = random.Random(seed), set("ab")
    while len(names) < 14:
        names.add("".join(r.choice("ab") for _ in range(r.randrange(2, 6))))
    rows = [("<unk>", 0.0, S.UNKNOWN), *((p, -float(r.randrange(8) if seed % 2 else len(p)), S.NORMAL) for p in sorted(names))]
    encoder = S.Encoder({"bpe": True, "prefix": False, "bytes": False, "pieces": rows})
    assert all(encoder.fits(a, b) == (encoder.merged(a + b) == [a, b]) for a in names for b in names)
