"""A gated recurrent language model with a class-factored softmax, in numpy.

P(text) = product over tokens of P(class | state) * P(word | class, state).  The most frequent words and the end are
classes of their own; every other word belongs to the class of its last two bytes.  Both factors are softmaxes over
the state: the one over classes, and within a class one over its MEMBERS most frequent words and
the rest.  A word of the rest has its smoothed share of the training tokens of the class's rest, so that
the vocabulary has no bound and unknown words have their share.

The recurrent part reads units: words that are classes or members, and for all others their class's rest.  It is
trained by backpropagation truncated to WINDOW tokens with the state carried from window to window, and scores whole
documents in the same way.  Training documents are dealt to shards by hash, about SHARD_TOKENS each, whatever
files and partitions they come from.  A first model learns from one in so many documents that they make about
WARM_TOKENS; then every shard trains a copy of it on its whole documents, in hash order, and the copies are
averaged by their tokens.  So equal rows give equal models.

Counts are exact over all training documents: words, told apart by 128 bits of hash, are added up in Spark; the
most frequent ones (KNOWN at most) are broadcast, the others meet their counts in a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrowmap import sliced
from .common import stash
from .wordhash import Words, scanned, signed

HIDDEN = 16
HEADS = 23  # words that are classes of their own
ENDINGS = 22  # classes of endings; then other endings and the end of a document
MEMBERS = 31  # words of such a class that its softmax tells apart
WINDOW = 16
LANES = 1024  # documents that advance together
KNOWN = 1 << 20  # words whose counts are broadcast: 24 MB
SHARD_TOKENS = 1 << 21
WARM_TOKENS, WARM_LANES, WARM_EPOCHS = 1 << 18, 64, 3
RATE, LOCAL_RATE = 5e-3, 1e-3
SMOOTH = 0.1
SUMS = 1024  # partial sums of shards' models that reach the driver

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def ending(words: Words) -> np.ndarray:
    """The last two bytes of each word as a number, lower-cased; the first is 0 for words of one byte."""
    last = _LOWER[words.data[words.end - 1]].astype(np.int32)
    before = np.where(words.end - words.start > 1, _LOWER[words.data[words.end - 2]], 0).astype(np.int32)
    return before << 8 | last


def _distinct(h: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of a first occurrence, inverse, number) of the different pairs, sorted by h."""
    _, at, inverse, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    if (check[at][inverse] == check).all():
        return at, inverse, n
    _, at, inverse, n = np.unique(np.stack([h, check], 1), axis=0, return_index=True, return_inverse=True, return_counts=True)
    return at, inverse.ravel(), n


@dataclass
class Classes:
    """From words to units and classes.

    Units: the heads, then for each class of endings its rest and its members, then the end.
    """

    hashes: np.ndarray  # heads and members, sorted
    checks: np.ndarray
    unit: np.ndarray
    log: np.ndarray  # log10(count + SMOOTH)
    by_ending: np.ndarray  # 65536 units: the rests
    class_of: np.ndarray  # by unit
    member_of: np.ndarray  # by unit: 0 for heads, rests and the end
    log_size: np.ndarray  # by unit: log10 of the smoothed number of a rest's tokens, else 0
    first: int  # class of endings

    @property
    def end(self) -> int:
        """The unit of the end."""
        return len(self.class_of) - 1

    def __call__(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(unit, log10(count + SMOOTH) for heads and members, else log_size) of each word."""
        out = self.by_ending[ending(words)]
        log = self.log_size[out]
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, words.hash), len(self.hashes) - 1)
            hit = np.flatnonzero((self.hashes[at] == words.hash) & (self.checks[at] == words.check))
            out[hit], log[hit] = self.unit[at[hit]], self.log[at[hit]]
        return out, log

    def tokens(self, words: Words, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(units with an end after each document, where each document begins)."""
        docs = len(words.first) - 1
        begin = words.first + np.arange(docs + 1)
        out = np.full(len(units) + docs, self.end, np.uint16)
        out[np.arange(len(units)) + words.document_of()] = units
        return out, begin

    def model(self) -> Recurrent:
        return Recurrent(int(self.class_of[-1]) + 1, self.end, class_of=self.class_of, member_of=self.member_of, first=self.first)


class Recurrent:
    """The recurrent part: units in, log-probabilities of the next unit out.

    class_of and member_of say how units make up classes; classes from first on, but the last, have members.
    By default each unit is a class.
    """

    def __init__(self, classes: int, end: int, hidden: int = HIDDEN, seed: int = 9, class_of: np.ndarray | None = None, member_of: np.ndarray | None = None, first: int | None = None):
        r = np.random.default_rng(seed)
        self.end, self.hidden = end, hidden
        self.class_of = np.arange(classes, dtype=np.uint8) if class_of is None else class_of
        self.member_of = np.zeros(len(self.class_of), np.uint8) if member_of is None else member_of
        self.first = classes - 1 if first is None else first
        wide = int(self.member_of.max()) + 1
        scale = 1 / np.sqrt(hidden)
        self.p = {
            "read": r.normal(0, 0.3, (len(self.class_of), 3 * hidden)).astype(np.float32),
            "carry": r.normal(0, scale, (hidden, 3 * hidden)).astype(np.float32),
            "write": r.normal(0, scale, (hidden, classes)).astype(np.float32),
            "bias": np.zeros(classes, np.float32),
        }
        if classes - 1 > self.first:
            self.p["inner"] = r.normal(0, scale, (classes - 1 - self.first, hidden, wide)).astype(np.float32)
            self.p["inner_bias"] = np.zeros((classes - 1 - self.first, wide), np.float32)
        for k in range(classes - 1 - self.first):  # classes with fewer members have no more
            own = self.member_of[self.class_of == self.first + k]
            self.p["inner_bias"][k, int(own.max(initial=0)) + 1 :] = -60
        self._forget_moments()

    def _forget_moments(self) -> None:
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.steps = 0

    def vector(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)])

    def load(self, vector: np.ndarray) -> Recurrent:
        at = 0
        for k in sorted(self.p):
            n = self.p[k].size
            self.p[k] = vector[at : at + n].reshape(self.p[k].shape).astype(np.float32)
            at += n
        self._forget_moments()
        return self

    def run(self, tokens: np.ndarray, begin: np.ndarray, rate: float = 0.0, together: int = LANES) -> np.ndarray:
        """Natural log-probability of each document's units; with a rate, learns from each window after it."""
        total = np.zeros(len(begin) - 1)
        length = np.diff(begin)
        order = np.argsort(-length, kind="stable")
        for g in range(0, len(order), together):
            lanes = order[g : g + together]
            self._lanes(tokens, begin[lanes], length[lanes], lanes, total, rate)
        return total

    def _lanes(self, tokens: np.ndarray, start: np.ndarray, length: np.ndarray, lanes: np.ndarray, total: np.ndarray, rate: float) -> None:
        """Documents in falling order of length, window by window."""
        h = np.zeros((self.hidden, len(start)), np.float32)
        before = np.full(len(start), self.end, tokens.dtype)
        for at in range(0, int(length[0]) if len(length) else 0, WINDOW):
            steps = np.arange(at, min(at + WINDOW, int(length[0])))
            active = np.searchsorted(-length, -steps, "left")  # documents longer than the step
            most = active[0]
            h, before = h[:, :most], before[:most]
            target = np.concatenate([tokens[start[:m] + t] for t, m in zip(steps, active, strict=True)])
            source = np.concatenate([before, target[: len(target) - active[-1]]])
            if (active[:-1] != active[1:]).any():  # documents that ended have no successor
                offset = np.cumsum(active) - active
                source = np.concatenate([before, *(target[o : o + m] for o, m in zip(offset[:-1], active[1:], strict=True))])
            h = self._window(source, target, active, h, lanes, total, rate)
            last = target[len(target) - active[-1] :]
            if active[-1] < most:
                before = before.copy()
            before[: active[-1]] = last

    def _window(self, source: np.ndarray, target: np.ndarray, active: np.ndarray, h: np.ndarray, lanes: np.ndarray, total: np.ndarray, rate: float) -> np.ndarray:
        """One window; the state after it.  Arrays are by feature, then token, so that each step runs over whole rows of memory."""
        p, n = self.p, self.hidden
        size = len(target)
        source = source.astype(np.intp)
        read, carry = np.ascontiguousarray(p["read"].T), np.ascontiguousarray(p["carry"].T)
        states = np.empty((n, size), np.float32)
        kept = []
        at = 0
        h = h.copy()
        for m in active:
            g = np.take(read, source[at : at + m], axis=1)
            prev = h[:, :m]
            hu = carry @ prev
            zr = g[: 2 * n]
            zr += hu[: 2 * n]
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            z, r, hn = zr[:n], zr[n:], hu[2 * n :]
            new = r * hn
            new += g[2 * n :]
            np.tanh(new, out=new)
            out = prev - new
            if rate:
                kept.append((z, r, hn, new, out.copy(), prev.copy()))
            out *= z
            out += new
            states[:, at : at + m] = out
            h[:, :m] = out
            at += m
        logits = p["write"].T @ states
        logits += p["bias"][:, None]
        np.minimum(logits, 60, out=logits)
        tokens = np.arange(size)
        chosen = self.class_of[target]
        hit = logits[chosen, tokens]
        np.exp(logits, out=logits)
        sums = logits.sum(0)
        hit -= np.log(sums)
        inner, parts = self._within(states, target, chosen, hit, rate > 0)
        at = 0
        for m in active:
            total[lanes[:m]] += hit[at : at + m]
            at += m
        if rate:
            logits *= 1 / (sums * size)
            logits[chosen, tokens] -= np.float32(1 / size)
            grads = {"write": states @ logits.T, "bias": logits.sum(1)}
            grads |= {k: np.zeros_like(p[k]) for k in ("inner", "inner_bias") if k in p}
            back = p["write"] @ logits
            if parts:
                more = np.empty((n, len(inner)), back.dtype)
                for k, a, b, own, error in parts:
                    error *= np.float32(1 / size)
                    grads["inner"][k] = own @ error.T
                    grads["inner_bias"][k] = error.sum(1)
                    more[:, a:b] = p["inner"][k] @ error
                back[:, inner] += more
            to_read = np.empty((3 * n, size), np.float32)
            to_carry = np.empty((3 * n, size), np.float32)
            previous = np.empty((n, size), np.float32)
            later = np.zeros((n, active[0]), np.float32)
            at = size
            for m, (z, r, hn, new, diff, prev) in zip(active[::-1], kept[::-1], strict=True):
                at -= m
                dh = back[:, at : at + m] + later[:, :m]
                a, b = to_read[:, at : at + m], to_carry[:, at : at + m]
                rest = 1 - z
                dnew = dh * rest
                rest *= z
                rest *= diff
                np.multiply(dh, rest, out=a[:n])
                new *= new
                np.subtract(1, new, out=new)
                dnew *= new
                a[2 * n :] = dnew
                np.multiply(dnew, r, out=b[2 * n :])
                dnew *= hn
                dnew *= r
                np.subtract(1, r, out=r)
                np.multiply(dnew, r, out=a[n : 2 * n])
                b[: 2 * n] = a[: 2 * n]
                previous[:, at : at + m] = prev
                dh *= z
                dh += p["carry"] @ b
                later[:, :m] = dh
            grads["carry"] = previous @ to_carry.T
            order = np.argsort(source, kind="stable")
            used, first = np.unique(source[order], return_index=True)
            grads["read"] = np.zeros_like(p["read"])
            grads["read"][used] = np.add.reduceat(np.take(to_read, order, axis=1), first, axis=1).T
            self._step(grads, rate)
        return h

    def _within(self, states: np.ndarray, target: np.ndarray, chosen: np.ndarray, hit: np.ndarray, learn: bool) -> tuple[np.ndarray, list[tuple]]:
        """Adds the log-probabilities within the targets' classes to hit.

        To learn from: tokens of classes with members, by class, and for each class (class, first and one past the last
        of its tokens there, their states, softmax less target).
        """
        inner = np.flatnonzero((chosen >= self.first) & (chosen < self.p["bias"].shape[0] - 1))
        if not len(inner):
            return inner, []
        inner = inner[np.argsort(chosen[inner], kind="stable")]
        kinds = chosen[inner]
        cuts = np.flatnonzero(np.diff(kinds)) + 1
        states, members = np.take(states, inner, axis=1), self.member_of[target[inner]]
        found = np.empty(len(inner), hit.dtype)
        out = []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(inner)], strict=True):
            k, own = int(kinds[a]) - self.first, states[:, a:b]
            x = self.p["inner"][k].T @ own
            x += self.p["inner_bias"][k][:, None]
            np.minimum(x, 60, out=x)
            tokens, member = np.arange(b - a), members[a:b]
            found[a:b] = x[member, tokens]
            np.exp(x, out=x)
            sums = x.sum(0)
            found[a:b] -= np.log(sums)
            if learn:
                x /= sums
                x[member, tokens] -= 1
                out.append((k, a, b, own, x))
        hit[inner] += found
        return inner, out

    def _step(self, grads: dict[str, np.ndarray], rate: float) -> None:
        """Adam."""
        self.steps += 1
        for k, g in grads.items():
            m, v = self.m[k], self.v[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            self.p[k] -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.99**self.steps)) + 1e-8)


def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, document starts) of several blocks as one."""
    shift = np.cumsum([0, *(len(t) for t, _ in parts)])
    starts = [begin[:-1] + s for (_, begin), s in zip(parts, shift, strict=False)]
    return np.concatenate([t for t, _ in parts]), np.concatenate([*starts, shift[-1:]])


def _counts(train: DataFrame) -> DataFrame:
    """(h, w, ending, c): words of the training texts, by both their hashes, and how often they occur."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [(w.hash, w.check, ending(w)) for _, _, w in scanned(batch.column(0), True)]
            h, w, e = (np.concatenate(x) for x in zip(*found, strict=True))
            at, _, n = _distinct(h, w)
            for a in range(0, len(at), 1 << 18):
                i, part = at[a : a + (1 << 18)], slice(a, a + (1 << 18))
                yield pa.RecordBatch.from_arrays([pa.array(signed(h[i])), pa.array(signed(w[i])), pa.array(e[i].astype(np.int32)), pa.array(n[part])], names=["h", "w", "ending", "n"])

    counted = train.select("text").mapInArrow(count, "h long, w long, ending int, n long")
    return stash(counted.groupBy("h", "w").agg(F.min("ending").alias("ending"), F.sum("n").alias("c")))


def _classes(counts: DataFrame) -> Classes:
    """Classes and their members by the counts: HEADS + (ENDINGS + 1) * MEMBERS words and 65536 endings come to the driver at most."""
    heads = counts.orderBy(F.desc("c"), "h", "w").limit(HEADS).collect()
    least = (heads[-1]["c"], heads[-1]["h"], heads[-1]["w"]) if heads else (0, 0, 0)
    rest = counts.where(F.expr(f"c < {least[0]} or c = {least[0]} and (h > {least[1]} or h = {least[1]} and w > {least[2]})"))
    top = rest.groupBy("ending").agg(F.sum("c").alias("n")).orderBy(F.desc("n"), "ending").limit(ENDINGS).collect()
    place = {r["ending"]: k for k, r in enumerate(top)}
    kind = F.create_map(*[F.lit(x) for pair in place.items() for x in pair])[F.col("ending")] if place else F.lit(None).cast("int")
    rest = rest.withColumn("kind", F.coalesce(kind, F.lit(len(top))))
    ranked = rest.withColumn("k", F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("c"), "h", "w")))
    members = sorted(ranked.where(F.col("k") <= MEMBERS).collect(), key=lambda r: (r["kind"], r["k"]))
    sizes = {r["kind"]: (r["n"], r["v"]) for r in rest.groupBy("kind").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    first = len(heads)
    class_of, member_of, log_size, words = list(range(first)), [0] * first, [0.0] * first, [(r, k) for k, r in enumerate(heads)]
    rest_unit = []
    for k in range(len(top) + 1):
        own = [r for r in members if r["kind"] == k]
        n, v = sizes.get(k, (0, 0))
        rest_unit.append(len(class_of))
        log_size += [np.log10(n - sum(r["c"] for r in own) + SMOOTH * (v - len(own) + 1))] + [0.0] * len(own)
        words += [(r, len(class_of) + 1 + i) for i, r in enumerate(own)]
        class_of += [first + k] * (1 + len(own))
        member_of += range(1 + len(own))
    by_ending = np.full(1 << 16, rest_unit[-1], np.uint16)
    for e, k in place.items():
        by_ending[e] = rest_unit[k]
    hashes = np.array([r["h"] for r, _ in words], np.int64).view(np.uint64)
    order = np.argsort(hashes, kind="stable")
    return Classes(
        hashes[order],
        np.array([r["w"] for r, _ in words], np.int64).view(np.uint64)[order],
        np.array([u for _, u in words], np.uint16)[order],
        np.log10(np.array([r["c"] for r, _ in words], float) + SMOOTH)[order],
        by_ending,
        np.array([*class_of, first + len(top) + 1], np.uint8),
        np.array([*member_of, 0], np.uint8),
        np.array([*log_size, 0.0]),
        first,
    )


def _known(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(sorted hashes, second hashes, log10(count + SMOOTH), smallest count) of the words above the count that *most* words can have."""
    none = np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0), np.inf
    level = F.floor(F.log2(F.col("c")) * 16).cast("int")
    found, least = 0, None
    for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).orderBy(F.desc("level")).collect():  # 1024 rows at most
        if found + r["n"] > most:
            break
        found, least = found + r["n"], r["c"]
    if least is None:
        return none
    table = counts.where(F.col("c") >= least).select("h", "w", "c").toArrow()
    h = table.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    if (h[order][1:] == h[order][:-1]).any():  # two words share the first hash: the join tells them apart
        return none
    return h[order], table.column("w").to_numpy().view(np.uint64)[order], np.log10(table.column("c").to_numpy()[order] + SMOOTH), float(least)


def _ordered(table: pa.Table, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, document starts) of a shard's texts in the order of their keys."""
    order = np.lexsort((table.column("size").to_numpy(), table.column("key").to_numpy()))
    text = table.column("text").combine_chunks().take(pa.array(order))
    return _joined([classes.tokens(words, classes(words)[0]) for _, _, words in scanned(text, True)])


def _trained(train: DataFrame, classes: Classes, tokens: int) -> Recurrent:
    """A first model from a hashed share of the documents, then one pass of all shards over all documents, averaged by tokens."""
    context = train.sparkSession.sparkContext
    keyed = train.select("text", F.xxhash64("doc_id", "text").alias("key"), F.length("text").alias("size"))
    shared = context.broadcast(classes)

    def warm(table: pa.Table) -> pa.Table:
        model = shared.value.model()
        found = _ordered(table, shared.value)
        for epoch in range(WARM_EPOCHS):
            model.run(*found, RATE / (1 + epoch), WARM_LANES)
        return pa.table({"model": pa.array([model.vector().tobytes()], pa.binary())})

    share = -(-tokens // WARM_TOKENS)
    begun = keyed.where(F.pmod("key", F.lit(share)) == 0).groupBy(F.lit(0).alias("all")).applyInArrow(warm, "model binary").collect()  # one row
    start = np.frombuffer(bytes(begun[0]["model"]), np.float32) if begun else classes.model().vector()
    begin = context.broadcast(start)
    shards = -(-tokens // SHARD_TOKENS)
    shard = F.pmod(F.shiftrightunsigned("key", 20), F.lit(shards))

    def learn(table: pa.Table) -> pa.Table:
        model = shared.value.model().load(begin.value)
        found = _ordered(table, shared.value)
        model.run(*found, LOCAL_RATE)
        n = len(found[0])
        return pa.table({"shard": table.column("shard").slice(0, 1), "seen": [n], "sums": pa.array([(model.vector().astype(np.float64) * n).tobytes()], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["shard", "seen", "sums"]).to_pylist(), key=lambda r: r["shard"])
        sums = sum(np.frombuffer(r["sums"]) for r in rows)
        return pa.table({"part": table.column("part").slice(0, 1), "seen": [sum(r["seen"] for r in rows)], "sums": pa.array([sums.tobytes()], pa.binary())})

    learned = keyed.withColumn("shard", shard).groupBy("shard").applyInArrow(learn, "shard long, seen long, sums binary")
    added = learned.withColumn("part", F.col("shard") % SUMS).groupBy("part").applyInArrow(add, "part long, seen long, sums binary")
    seen, sums = 0, np.zeros(len(start))
    for r in sorted(added.collect(), key=lambda r: r["part"]):  # SUMS rows at most
        seen += r["seen"]
        sums = sums + np.frombuffer(bytes(r["sums"]))
    return classes.model().load(sums / seen if seen else start)


def score(df: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: int = KNOWN) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row of df.

    train: the rows to learn from, with the same two columns.  Tokens are words outside
    [\\x20\\x09-\\x0D], A-Z lower-cased, and one end per text.  base_score adds up log10 of the smoothed
    unigram probabilities (c + 0.1) / (N + 0.1 * (V + 1)); score is the model's log10 probability of the text.

    Null and empty texts are the end alone.  Rows that repeat id and text get equal
    scores; null ids are scored like others.  Other columns are not read.  Without training rows
    N and V are 0 and the recurrent part is untrained.  Scores do not depend on files, partitions or
    their order, but for the rounding of single-precision sums.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    learn = train.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counts = _counts(learn)
    totals = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = learn.count()
    n_all, v_all = (totals["n"] or 0) + ends, totals["v"] + (ends > 0)
    log_all = float(np.log10(n_all + SMOOTH * (v_all + 1)))
    end_log = float(np.log10(ends + SMOOTH))
    classes = _classes(counts)
    *hashed, logs, least = _known(counts, known)
    model = _trained(learn, classes, n_all) if ends else classes.model()
    shared = df.sparkSession.sparkContext.broadcast((classes, model, *hashed, logs))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, model, hashes, checks, logs = shared.value
        for batch in sliced(batches):
            parts, sums, lists = [], [], []
            for i, j, words in scanned(batch.column(1), True):
                docs = j - i
                units, unit_log = classes(words)
                owner = words.document_of()
                first, inverse, _ = _distinct(words.hash, words.check)
                uniq = words.hash[first]
                at = np.minimum(np.searchsorted(hashes, uniq), max(len(hashes) - 1, 0))
                hit = (hashes[at] == uniq) & (checks[at] == words.check[first]) if len(hashes) else np.zeros(len(uniq), bool)
                log = np.where(hit, logs[at] if len(hashes) else 0.0, 0.0)[inverse]
                found = hit[inverse]
                parts.append(classes.tokens(words, units))
                sums.append(np.stack([np.bincount(owner, x, docs) for x in (log, found, unit_log)]))
                rare = np.flatnonzero(~found)
                lists.append((np.diff(np.searchsorted(rare, words.first)), words.hash[rare], words.check[rare]))
            tokens, begin = _joined(parts)
            word_log, found, within = np.concatenate(sums, 1)
            rare_at = pa.array(np.concatenate([[0], np.cumsum(np.concatenate([x[0] for x in lists]))]).astype(np.int32))
            rare = [pa.ListArray.from_arrays(rare_at, pa.array(signed(np.concatenate([x[k] for x in lists])))) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(begin)),
                    pa.array(found.astype(np.int64)),
                    pa.array(word_log),
                    pa.array(model.run(tokens, begin) / np.log(10) - within),
                    *rare,
                ],
                names=["doc_id", "n_tokens", "n_found", "word_log", "model_log", "rare", "rare_w"],
            )

    done = rows.mapInArrow(apply, "doc_id long, n_tokens long, n_found long, word_log double, model_log double, rare array<long>, rare_w array<long>")
    done = stash(done.withColumn("row", F.monotonically_increasing_id()))  # numbers that are written stay as they are
    # The words that were not broadcast.
    some = done.where(F.size("rare") > 0)
    spread = some.select("row", F.explode(F.arrays_zip(F.col("rare").alias("h"), F.col("rare_w").alias("w"))).alias("x"))
    spread = spread.select("row", F.col("x.h").alias("h"), F.col("x.w").alias("w")).groupBy("row", "h", "w").agg(F.count(F.lit(1)).alias("tf"))
    met = spread.join(counts.where(F.col("c") < least) if least != float("inf") else counts, ["h", "w"], "left")
    log = F.log10(F.coalesce("c", F.lit(0)) + F.lit(SMOOTH))
    summed = met.groupBy("row").agg(F.sum(F.col("tf") * log).alias("rare_log"), F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("rare_found"))
    out = done.drop("rare", "rare_w").join(summed, "row", "left")
    words = F.col("word_log") + F.coalesce("rare_log", F.lit(0.0))
    return out.select(
        "doc_id",
        "n_tokens",
        (F.col("n_found") + F.coalesce("rare_found", F.lit(0)) + F.lit(1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (words + F.lit(end_log) - F.col("n_tokens") * F.lit(log_all)).alias("base_score"),
        (words + F.col("model_log")).alias("score"),
    )
