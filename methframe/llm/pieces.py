"""SentencePiece encoding and decoding by a streaming Viterbi pass.

The lattice of pieces is walked left to right with one backpointer per position, the
piece that ends there.  Which path into a position survives is decided as the model's kind demands:

* unigram models: the path with the highest sum of piece scores;
* merge (BPE) models: the path that merging would give.  A sequence of pieces is
  the result of merging exactly if every two neighbours, merged on their own, stay as
  they are; so each position has one surviving backpointer, found from its neighbour.

Only positions within the longest piece's length can still be reached back to.  Whenever the window of
open positions is twice that long, the paths of those positions are followed down; where all meet in one
boundary, the ids before it are committed and their positions forgotten.

Positions that no piece spans (before a space, around characters that are in no
piece) are such boundaries for every text.  So a text is handed to the pass stretch by stretch between them,
and what the pass committed for a stretch is remembered in a bounded table, since most stretches recur.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrowmap import add_columns

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # fixed values of the model format
UNIGRAM, BPE = 1, 2
REMEMBERED = 200_000  # stretches that make a worker forget those it has not met since the last time
REMEMBER_UP_TO = 64  # characters of a remembered stretch
_UNKNOWN_PENALTY = 10.0
_NONE, _STRANGE = -1, -2  # no piece ends here; _STRANGE - code point: a character that is no piece


class Vocabulary:
    """A model file's pieces and the settings that this module needs; raises for normalisations it does not do."""

    def __init__(self, model_file: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = pb.ModelProto()
        m.ParseFromString(model_file)
        norm = m.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or m.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only identity normalisation with white space as prefix is supported")
        if m.trainer_spec.model_type not in (UNIGRAM, BPE) or any(p.type == USER for p in m.pieces):
            raise ValueError("only unigram and BPE models without user-defined pieces are supported")
        self.merging = m.trainer_spec.model_type == BPE
        self.prefix = norm.add_dummy_prefix
        self.names = [p.piece for p in m.pieces]
        self.kinds = [p.type for p in m.pieces]
        self.scores = [p.score for p in m.pieces]


class Codec:
    def __init__(self, vocabulary: Vocabulary):
        v = self.v = vocabulary
        self.ids = {p: i for i, (p, k) in enumerate(zip(v.names, v.kinds, strict=True)) if k == NORMAL}
        self.longest = max(map(len, self.ids), default=1)
        self.unknown = next((i for i, k in enumerate(v.kinds) if k == UNKNOWN), 0)
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(v.names, v.kinds, strict=True)) if k == BYTE}
        self.floor = min((v.scores[i] for i in self.ids.values()), default=0.0) - _UNKNOWN_PENALTY
        chars = set("".join(self.ids))
        self.chars = chars
        apart = [c for c in "\n\t\r\x0b\x0c\0" if c not in chars]
        inner = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        lone = re.escape("".join(apart))
        self.stretch = None if inner else re.compile(f" *[^ {lone}]+| +|[{lone}]" if apart else " *[^ ]+| +", re.S)
        self.memory: dict[str, bytes] = {}  # stretches since the last turn, and those before it
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.lengths = [len(p) for p in v.names]
        self.passes = self.commits = self.widest = 0  # stretches walked, commits inside of them, most open positions
        self.halves: dict[str, tuple[str, str] | None] = {}  # of each piece that merging can make: the two parts merged last
        if v.merging:
            for p in self.ids:
                parts, last = self._merged(p)
                if parts == [p]:
                    self.halves[p] = last
            self.reachable = {p: self.ids[p] for p in self.halves}
            rank = {p: -v.scores[i] for p, i in self.ids.items()}
            self.ranks = rank
            self.ordered = all(h is None or rank[p] > max(rank[x] if len(x) > 1 else -np.inf for x in h) for p, h in self.halves.items() if not p.startswith(SPACE * 2))
        else:
            self.reachable = self.ids
        self.lattice = ahocorasick.Automaton()
        for p, i in self.reachable.items():
            self.lattice.add_word(p, (len(p), v.scores[i], i))
        self.lattice.make_automaton()
        self.texts = [self._piece_bytes(i) for i in range(len(v.names))]

    def _piece_bytes(self, i: int) -> bytes:
        name, kind = self.v.names[i], self.v.kinds[i]
        if kind == BYTE:
            return bytes([int(name[3:5], 16)])
        if kind == NORMAL:
            return name.replace(SPACE, " ").encode()
        return b" \xe2\x81\x87 " if kind == UNKNOWN else b""

    # --- the survivor of a merge model -------------------------------------------------

    def _merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """Highest score first, leftmost first: plain merging of a short text; and the last two parts that were merged."""
        parts: list[str | None] = list(text)
        right = list(range(1, len(parts) + 1))
        left = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []
        last = None

        def offer(i: int) -> None:
            j = right[i]
            if j < len(parts) and (p := parts[i] + parts[j]) in self.ids:
                heapq.heappush(heap, (-self.v.scores[self.ids[p]], i, p))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, p = heapq.heappop(heap)
            j = right[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or parts[i] + parts[j] != p:
                continue
            last = (parts[i], parts[j])
            parts[i], parts[j], right[i] = p, None, right[j]
            if right[i] < len(parts):
                left[right[i]] = i
                offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [p for p in parts if p is not None], last

    def _stays(self, a: str, b: str) -> bool:
        """Whether two neighbouring pieces stay as they are when merged on their own."""
        tied = a[-1] == SPACE == b[0] or SPACE * 2 in a  # runs of spaces have equal scores
        return self._merged(a + b)[0] == [a, b] if tied or not self.ordered else self._never_joined(a, b)

    def _never_joined(self, a: str, b: str) -> bool:
        """The same from scores: no part at a's right edge meets a part at b's left edge with which it would merge
        before either becomes part of something larger.  Where scores tie, the left one is merged first."""
        ranks, halves = self.ranks, self.halves
        edge, until_a = a, np.inf
        while True:
            other, until_b = b, np.inf
            while True:
                r = ranks.get(edge + other)
                if r is not None and r < until_a and r <= until_b:
                    return False
                h = halves.get(other)
                if h is None:
                    break
                until_b, other = ranks[other], h[0]
            h = halves.get(edge)
            if h is None:
                return True
            until_a, edge = ranks[edge], h[1]

    # --- the streaming pass -------------------------------------------------------------

    def walk(self, text: str) -> list[int]:
        """The pieces of a text in order, by id; characters that are no piece as _STRANGE - code point."""
        merging, longest, lengths, pairs, many = self.v.merging, self.longest, self.lengths, self.pairs, len(self.lengths)
        done: list[int] = []
        base, top, limit = 0, 0, 2 * longest  # committed up to base; open positions
        last = [_NONE] * (min(len(text), limit) + 1)  # of base and the open positions after it: the surviving piece,
        best = [] if merging else [0.0] + [-np.inf] * (len(last) - 1)  # and its path's score

        get = pairs.get
        self.passes += 1
        for end, (length, score, i) in self.lattice.iter(text):  # every piece in the text, by end, longest first
            k = end + 1 - base
            if k == top + 1 and top < limit and merging and (last[top] != _NONE or not top):
                top = k  # the usual step
            while k != top:
                if top and (last[top] == _NONE or not merging):
                    self._close(text[base + top - 1], last, best, top)
                if top >= limit:
                    self.widest = max(self.widest, top)
                    meet = self._meet(last, top)
                    if meet:
                        done += self._back(last, meet)
                        best = [x - best[meet] for x in best[meet:]]
                        last = last[meet:]
                        base, top, k = base + meet, top - meet, k - meet
                        self.commits += 1
                    limit = max(top, longest) + longest
                    more = limit + 1 - len(last)
                    last += [_NONE] * more
                    best += [] if merging else [-np.inf] * more
                top += 1
            start = k - length
            if start < 0:
                continue
            if not merging:
                score += best[start]
                if score > best[k]:
                    last[k], best[k] = i, score
            elif last[k] == _NONE:
                if start or base:
                    before = last[start]
                    if before >= 0:
                        ok = get(before * many + i)
                        if ok is None:
                            if len(pairs) > 2 * REMEMBERED:
                                pairs.clear()
                            ok = pairs[before * many + i] = self._stays(self.v.names[before], self.v.names[i])
                        if ok:
                            last[k] = i
                    else:
                        last[k] = i
                else:
                    last[k] = i
        while True:
            if top and (last[top] == _NONE or not merging):
                self._close(text[base + top - 1], last, best, top)
            if base + top == len(text):
                break
            top += 1
            if top == len(last):
                last.append(_NONE)
                best += [] if merging else [-np.inf]
        self.widest = max(self.widest, top)
        return done + self._back(last, top)

    def _close(self, ch: str, last: list[int], best: list[float], top: int) -> None:
        """Position top is complete: a character that is no piece is one by itself where no piece, or no better path, ends."""
        if self.v.merging:
            if last[top] == _NONE:
                last[top] = _STRANGE - ord(ch)
        elif ch not in self.reachable and best[top - 1] + self.floor > best[top]:
            last[top], best[top] = _STRANGE - ord(ch), best[top - 1] + self.floor

    def _meet(self, last: list[int], top: int) -> int:
        """The position that the paths of all positions which a later piece can begin at have in common."""
        lengths = self.lengths
        heads = set(range(max(0, top - self.longest + 1), top + 1))
        while len(heads) > 1:
            h = max(heads)
            heads.remove(h)
            heads.add(h - (lengths[last[h]] if last[h] >= 0 else 1))
        return heads.pop()

    def _back(self, last: list[int], end: int) -> list[int]:
        """The path into a position, from base on."""
        out, lengths = [], self.lengths
        while end > 0:
            i = last[end]
            out.append(i)
            end -= lengths[i] if i >= 0 else 1
        return out[::-1]

    def segments(self, text: str) -> list[str]:
        """The pieces of a text, in order; unknown characters come as themselves."""
        return [self.v.names[i] if i >= 0 else chr(_STRANGE - i) for i in self.walk(text)]

    def _ids(self, piece: str) -> list[int]:
        i = self.ids.get(piece)
        if i is not None:
            return [i]
        if self.bytes:
            return [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")]
        return [self.unknown]

    def _stretch_ids(self, stretch: str) -> bytes:
        found = self.older.get(stretch)
        if found is None:
            ids = self.walk(stretch.replace(" ", SPACE))
            if ids and min(ids) < 0:
                ids = [j for i in ids for j in ([i] if i >= 0 else self._ids(chr(_STRANGE - i)))]
            found = array("i", ids).tobytes()
        if len(stretch) <= REMEMBER_UP_TO:
            if len(self.memory) >= REMEMBERED:
                self.older = dict(self.memory)
                self.memory.clear()
            self.memory[stretch] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        if not text:
            return np.empty(0, np.int32)
        text = (" " if self.v.prefix else "") + text.replace(SPACE, " ")
        parts = [text] if self.stretch is None else self.stretch.findall(text)
        memory, miss = self.memory, self._stretch_ids
        return np.frombuffer(b"".join([memory.get(p) or miss(p) for p in parts]), np.int32)

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text of ids; the space that encoding put before it is taken off."""
        table = self.texts
        raw = b"".join([table[i] for i in (ids.tolist() if isinstance(ids, np.ndarray) else ids)])
        if self.v.prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


def _lists(found: list[np.ndarray]) -> pa.Array:
    at = np.zeros(len(found) + 1, np.int32)
    np.cumsum([len(x) for x in found], out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(found)))


def codec(df: DataFrame, model_path: str):
    """A broadcast codec (bounded by the model file); a Python worker keeps it, and what it remembers, from task to task."""
    with open(model_path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(Codec(Vocabulary(f.read())))


def encode(df: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """df with the ids of each text (array<int>); null and empty texts give an empty array.  A column ids_col is replaced."""
    shared = codec(df, model_path)

    def make():
        c = shared.value

        def run(batch: pa.RecordBatch) -> list:
            return [_lists([c.encode(t or "") for t in batch.column(text_col).to_pylist()])]

        return run

    return add_columns(df, [(ids_col, T.ArrayType(T.IntegerType()))], make)


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """df with the text of each array of ids; a null array gives null.  A column text_col is replaced."""
    shared = codec(df, model_path)

    def make():
        c = shared.value

        def run(batch: pa.RecordBatch) -> list:
            col = batch.column(ids_col)
            return [[None if not ok else c.decode(x.values.to_numpy(zero_copy_only=False)) for x, ok in zip(col, col.is_valid().to_pylist(), strict=True)]]

        return run

    return add_columns(df, [(text_col, T.StringType())], make)


def round_trip(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, n_tokens, decoded_sha256, exact): encoded, decoded again, and whether that gives the text.

    A model writes a space as U+2581, so a U+2581 in a text comes back as a space; exact compares with that.  Null texts count as empty.
    Both directions run in one Python step: two would keep two workers, each with what it remembers, for every task.
    """
    shared = codec(df, model_path)

    def make():
        c = shared.value

        def run(batch: pa.RecordBatch) -> list:
            found, digests, exact = [], [], []
            for t in batch.column("text").to_pylist():
                t = t or ""
                ids = c.encode(t)
                back = c.decode(ids)
                found.append(ids)
                digests.append(hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest())
                exact.append(back == t.replace(SPACE, " "))
            return [_lists(found), [len(x) for x in found], digests, exact]

        return run

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    fields = [("ids", T.ArrayType(T.IntegerType())), ("n_tokens", T.LongType()), ("decoded_sha256", T.StringType()), ("exact", T.BooleanType())]
    return add_columns(rows, fields, make).drop("text")
