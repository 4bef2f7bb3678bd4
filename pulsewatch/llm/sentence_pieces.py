"""SentencePiece encoding and decoding by a streaming Viterbi search.

The lattice has a node for every boundary between characters and an edge for every piece. Each node keeps one backpointer, a piece.
A future piece can only start at the last ``longest`` nodes, so only these can be the end of a surviving path; as soon as all
their paths run through one boundary, the ids before it are committed and forgotten. Memory is bounded by the longest piece, not
by the text. Between two characters that stand together in no piece all paths meet at once. Every stretch between two such places is
searched this way; its committed ids are remembered for when it comes again, and so are the backpointers of its beginnings.

For a unigram model the backpointer maximises the sum of the piece scores. For a BPE model the sum of scores is not what the model
means: a path is worth nothing if merging would join two of its neighbours otherwise, so edges are only followed from a piece that
can stand before theirs, that is, where merging the two pieces' characters by the model's ranks gives these two pieces again.
One path survives, and it is the merging result of the whole text.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewatch.llm.common import pick, pieces, public_file

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE, BPE = 1, 2, 3, 4, 6, 2
#: What is remembered: ids of stretches and backpointers of beginnings up to this length, twice these numbers of the latest ones.
REMEMBERED, KNOWN_PARTS, KNOWN_ENDS = 64, 300_000, 300_000
#: What an unknown character costs below the worst piece of a unigram model.
PENALTY = 10.0
_NONE = float("-inf")


def read_model(path: str) -> dict:
    """Pieces, scores and settings of a model file; only identity normalisation is supported."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    norm = proto.normalizer_spec
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
        raise ValueError("only models with identity normalisation are supported")
    return {"pieces": [(p.piece, p.score, p.type) for p in proto.pieces], "bpe": proto.trainer_spec.model_type == BPE,
            "prefix": norm.add_dummy_prefix, "bytes": proto.trainer_spec.byte_fallback}


class Encoder:
    def __init__(self, model: dict):
        self.bpe, self.prefix, self.byte_fallback = model["bpe"], model["prefix"], model["bytes"]
        self.names = [p for p, _, _ in model["pieces"]]
        self.id = {p: k for k, (p, _, kind) in enumerate(model["pieces"]) if kind in (NORMAL, USER)}
        self.score = {p: s for p, s, kind in model["pieces"] if kind in (NORMAL, USER)}
        self.unknown = next((k for k, (_, _, kind) in enumerate(model["pieces"]) if kind == UNKNOWN), 0)
        self.byte_id = {int(p[3:5], 16): k for k, (p, _, kind) in enumerate(model["pieces"]) if kind == BYTE}
        self.longest = max(map(len, self.id), default=1)
        self.endings = {p[k:] for p in self.id for k in range(1, len(p))}
        self.kind = {p: (p in self.id, p in self.endings) for p in self.endings | set(self.id)}
        self.worst = min(self.score.values(), default=0.0) - PENALTY
        self.inside = inside = {x for p in self.id for x in zip(p, p[1:])}
        letters = {c for p in self.id for c in p}
        # paths always meet before a space mark that follows something else, if no piece holds such a pair
        after_space = any(b == SPACE and a != SPACE for a, b in inside)
        self.cut = re.compile("\n|[^\n]+" if after_space or "\n" in letters else f"\n|{SPACE}*(?:{self._runs()})|{SPACE}+" if self.bpe else
                              f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.ends: dict[str, list[str]] = {}
        #: How often converged paths were committed, and the most boundaries held at a time.
        self.commits = self.window = 0
        self.lasts: dict[str, tuple[str, str] | None] = {}
        self.fits = lru_cache(1 << 19)(self._fits)
        self.raw = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else p.replace(SPACE, " ").encode()
                    for p, _, kind in model["pieces"]]

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        parts = self.cut.findall((SPACE if self.prefix else "") + text.replace(" ", SPACE))
        if len(self.parts) > KNOWN_PARTS:
            self.older, self.parts = self.parts, {}
        known, older = self.parts, self.older
        found = list(map(known.get, parts))
        for k in [k for k, x in enumerate(found) if x is None]:
            part = parts[k]
            found[k] = known.get(part) or older.get(part) or array("i", self._short(part) if self.bpe and len(part) <= REMEMBERED else self.stream(part)).tobytes()
            if len(part) <= REMEMBERED:
                known[part] = found[k]
        return np.frombuffer(b"".join(found), np.int32)

    def _runs(self) -> str:
        """A pattern of runs of characters that pieces join, directly or through others: all paths meet between two such runs."""
        group = {c: {c} for x in self.inside for c in x if c != SPACE}
        for a, b in self.inside:
            if SPACE not in (a, b) and group[a] is not group[b]:
                small, large = sorted((group[a], group[b]), key=len)
                large |= small
                group.update(dict.fromkeys(small, large))
        joined = {id(x): x for x in group.values() if len(x) > 1}
        runs = ["".join(map(re.escape, sorted(x))) for x in sorted(joined.values(), key=lambda x: (-len(x), min(x)))]
        return "|".join([*(f"[{x}]+" for x in runs), f"[^{SPACE}\n{''.join(runs)}]+"])

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text

    def stream(self, text: str):
        """Ids of the best path, each given out as soon as no other path can survive."""
        size, committed, last, score, begin, back = len(text), 0, {0: ""}, {0: 0.0}, 1, []
        if self.bpe:
            if size <= REMEMBERED:
                yield from self._short(text)
                return
            # the search goes on behind the beginning, whose backpointers are remembered; a piece may begin at the last ``longest`` of them
            back, begin = self._beginning(text[:REMEMBERED]), REMEMBERED + 1
            last |= {k: back[k] for k in range(max(1, begin - self.longest), begin)}
            before = last.get
        for end in range(begin, size + 1):
            if self.bpe:
                piece = self._fitting(text, end, before)
            else:
                piece = self._best(text, end, last, score)
            last[end] = piece
            if end == size or end - committed >= 2 * self.longest:
                self.window = max(self.window, len(last))
                # a path to the end can still run through the last boundaries only
                alive = {size} if end == size else set(range(end - self.longest + 1, end + 1))
                while len(alive) > 1:
                    k = max(alive)
                    alive.discard(k)
                    alive.add(k - len(last[k] if k in last else back[k]))
                meet, path = alive.pop(), []
                k = meet
                while k > committed:
                    path.append(last[k] if k in last else back[k])
                    k -= len(path[-1])
                self.commits += meet > committed
                path.reverse()
                yield from self._all_ids(path)
                if end < size:
                    for k in range(committed, meet):
                        last.pop(k, None)
                        score.pop(k, None)
                committed = max(committed, meet)

    def _beginning(self, text: str) -> list[str]:
        """The backpointer of every boundary of a short text, from the longest beginning on that was met before."""
        known, size = self.ends, len(text)
        if len(known) > KNOWN_ENDS:
            known.clear()
        begin = size
        while (found := known.get(text[:begin])) is None and begin:
            begin -= 1
        back = [""] if found is None else found if begin == size else found[:begin + 1]
        for end in range(begin + 1, size + 1):
            back.append(self._fitting(text, end, back.__getitem__))
            known[text[:end]] = back
        return back

    def _short(self, text: str) -> list[int]:
        """Ids of a short text: the paths meet at its end at the latest."""
        back, path, k = self._beginning(text), [], len(text)
        self.commits += 1
        while k:
            path.append(back[k])
            k -= len(back[k])
        path.reverse()
        return self._all_ids(path)

    def _ending(self, text: str, end: int) -> list[str]:
        """Pieces that end here, longest first; a character without a piece stands for itself."""
        found = []
        for start in range(end - 1, -1, -1):
            piece = text[start:end]
            if piece in self.id:
                found.append(piece)
            elif start == end - 1:
                found.append(piece)
            if piece not in self.endings:
                break
        found.reverse()
        return found

    def _fitting(self, text: str, end: int, before) -> str:
        """The longest piece that ends here and can follow the one before it; a character without a piece stands for itself."""
        kind, inside = self.kind.get, self.inside
        start, found = end - 1, []
        while True:
            piece = text[start:end]
            is_piece, is_ending = kind(piece, (False, False))
            if is_piece or start == end - 1:
                found.append(piece)
            if not start or not is_ending:
                break
            start -= 1
        for piece in reversed(found):
            left = before(end - len(piece))
            if left is not None and (not left or (left[-1], piece[0]) not in inside or self.fits(left, piece)):
                return piece
        raise AssertionError("every text has a path")

    def _best(self, text: str, end: int, last: dict[int, str], score: dict[int, float]) -> str:
        best = None
        for piece in self._ending(text, end):
            before = score.get(end - len(piece))
            value = None if before is None else before + self.score.get(piece, self.worst)
            if value is not None and (best is None or value > score[end]):
                best, score[end] = piece, value
        return best

    def _all_ids(self, path: list[str]) -> list[int]:
        found = list(map(self.id.get, path))
        return found if None not in found else [i for piece in path for i in self._ids(piece)]

    def _ids(self, piece: str):
        if piece in self.id:
            yield self.id[piece]
        elif self.byte_fallback:
            yield from (self.byte_id[b] for b in piece.encode())
        else:
            yield self.unknown

    def _fits(self, left: str, right: str) -> bool:
        """Whether merging the characters of both by rank gives exactly these two.

        The merges that made them are undone from the last one back; none of those between both sides may have come before.
        """
        if self._last(left) is None or self._last(right) is None:
            return self.merged(left + right) == [left, right]
        score, limit, ties = self.score.get, _NONE, False
        while True:
            across = score(left + right, _NONE)
            if across > limit or (ties and across == limit):
                return False
            if len(left) == len(right) == 1:
                return True
            # at equal scores the left one was merged first
            if len(right) == 1 or (len(left) > 1 and score(left) < score(right)):
                limit, ties, left = score(left), False, self.lasts[left][1]
            else:
                limit, ties, right = score(right), True, self.lasts[right][0]

    def _last(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merging made this one; None if merging does not give it or its parts come after it."""
        if piece not in self.lasts:
            parts, found = [], None
            if len(piece) == 1:
                found = piece, ""
            elif self.merged(piece, parts) == [piece]:
                found = parts[-1]
                if any(len(x) > 1 and (self._last(x) is None or self.score[x] < self.score[piece]) for x in found):
                    found = None
            self.lasts[piece] = found
        return self.lasts[piece]

    def merged(self, text: str, joined: list | None = None) -> list[str]:
        """Pieces after joining, again and again, the neighbours that form the piece of the highest score (ties: the first).
        ``joined`` gets all neighbours joined."""
        score, parts = self.score.get, list(text)
        both = [score(a + b, _NONE) for a, b in zip(parts, parts[1:])]
        while both and (best := max(both)) > _NONE:
            k = both.index(best)
            if joined is not None:
                joined.append((parts[k], parts[k + 1]))
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del both[k]
            if k:
                both[k - 1] = score(parts[k - 1] + parts[k], _NONE)
            if k < len(both):
                both[k] = score(parts[k] + parts[k + 1], _NONE)
        return parts


_ENCODERS: dict[str, Encoder] = {}


def _encoder(key: str, model) -> Encoder:
    """One encoder per Python worker and model, so that what it has looked up serves later tasks too."""
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(model.value)
    return _ENCODERS[key]


def _encode(key: str, model, check: bool, keep: list[str]):
    def run(batches):
        encoder = _encoder(key, model)
        for batch in pieces(batches, 1000):
            texts = batch.column("text").to_pylist()
            found = [None if t is None else encoder.encode(t) for t in texts]
            ends = np.cumsum([0, *(0 if f is None else len(f) for f in found)])
            offsets = pa.array(ends, pa.int32(), mask=np.array([f is None for f in found] + [False], bool))
            flat = np.concatenate([f for f in found if f is not None] or [np.empty(0, np.int32)])
            out = batch.select(keep).append_column("ids", pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32())))
            out = out.append_column("n_ids", pa.array([None if f is None else len(f) for f in found], pa.int64()))
            if check:
                same = [None if t is None else encoder.decode(f) == t.replace(SPACE, " ") for t, f in zip(texts, found)]
                out = out.append_column("round_trip", pa.array(same, pa.bool_()))
            yield out
    return run


def _decode(key: str, model):
    def run(batches):
        encoder = _encoder(key, model)
        for batch in pieces(batches, 1000):
            texts = [None if ids is None else encoder.decode(np.array(ids, np.int32)) for ids in batch.column("ids").to_pylist()]
            yield batch.append_column("text", pa.array(texts, pa.string()))
    return run


def _model(df: DataFrame, path: str | None):
    path = path or public_file("piece_bpe_32k.model")
    return path, df.sparkSession.sparkContext.broadcast(read_model(path))


def encoded(docs: DataFrame, *columns: str, path: str | None = None, check: bool = True) -> DataFrame:
    """The named columns with the ids of the column text (array of int), n_ids, and round_trip: whether decoding gives the text again.

    A null text has null ids, an empty one none. U+2581 stands for a space in the pieces and is read as one, as the model's own library
    does. Characters without a piece become their UTF-8 bytes. Repeated rows give equal rows; extra columns do not matter; an empty
    table gives an empty result. The model file is read by the driver and sent to the tasks; its size is the vocabulary's.
    """
    rows = pick(docs, *dict.fromkeys([*columns, "text"]))
    key, model = _model(docs, path)
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in columns)
    return rows.mapInArrow(_encode(key, model, check, list(columns)), f"{kinds}, ids array<int>, n_ids long" + (", round_trip boolean" if check else ""))


def decoded(rows: DataFrame, *columns: str, path: str | None = None) -> DataFrame:
    """The named columns (ids among them) with the decoded text; null ids give a null text, no ids an empty one."""
    rows = pick(rows, *columns)
    key, model = _model(rows, path)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(_decode(key, model), f"{kinds}, text string")
