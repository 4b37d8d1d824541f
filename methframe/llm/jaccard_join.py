"""An exact join of documents whose word shingles have a Jaccard similarity of at least PERCENT.

Shingles are ordered from rare to frequent (by frequency class, then hash), so similar
sets share one of their first shingles, their prefix.  Shingles of one document alone
can be in no intersection: they count in sizes and fill the prefix, and are otherwise left out.
Documents with equal shared shingles and sizes have equal answers and form one item.

Work is saved by set relations at two levels (exact set similarity join literature):

* index: prefix lists are kept in blocks by position and size; a probing set skips each
  block whose positions cannot leave enough common shingles.
* answers: the overlaps of a set that differs little from one already answered are derived
  from that one's overlaps by the lists of the differing shingles alone.

Items meet first by their first shingle (large groups in blocks of GROUP), where exact
answers give first components.  Then components that share a prefix shingle are
compared by one pair each; last, each pair of items that shares prefix
shingles across components and passes the overlap bound is compared.  So a group of thousands of near
copies is joined without its pairs, and no pair between components is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowmap import sliced
from .common import fresh, small, stash
from .components import components
from .repeats import BITS, Filter, frequent
from .wordhash import Words, mix, scanned, signed

SHINGLE = 5
PERCENT = 75
GROUP = 512
CLASSES = [2, 16, 128]  # frequency thresholds of the order
BLOCK_POSITIONS = 8  # positions of a list's block
LEAD = 8  # first prefix shingles that tell a pair that it has met before


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct shingles of a block, sorted; documents with fewer words have their whole sequence as one."""
    at, h = words.windows(size)
    doc = words.document_of()[at]
    counts = np.diff(words.first)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = []
        for k in range(1, size):
            at_k, h_k = words.windows(k)
            if (pick := counts[short] == k).any():
                whole.append((short[pick], mix(h_k[np.searchsorted(at_k, words.first[short[pick]])] + np.uint64(k))))
        doc = np.concatenate([doc, *(d for d, _ in whole)])
        h = np.concatenate([h, *(x for _, x in whole)])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


def needed(total: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Smallest overlap of two sets whose sizes add up to total: 100 o >= percent * (total - o)."""
    return -(-percent * total // (100 + percent))


def prefix_length(n: np.ndarray | int, shared: np.ndarray | int, percent: int) -> np.ndarray | int:
    """How many of the shared shingles belong to the prefix of a set of n; the others of it come before them."""
    return n - (-(-percent * n // 100)) + 1 - (n - shared)


class LocalJoin:
    """The join of a group of sets (arrays of distinct uint64 in the global order, with full sizes)."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, percent: int):
        order = np.argsort(sizes, kind="stable")
        self.order, self.percent, self.n = order, percent, np.asarray(sizes)[order]
        self.sets = [sets[k] for k in order]
        self.shared = np.array([len(s) for s in self.sets])
        self.offset = np.zeros(len(sets) + 1, np.int64)
        np.cumsum(self.shared, out=self.offset[1:])
        every = np.concatenate(self.sets)
        self.tokens, self.local = np.unique(every, return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), self.shared)
        place = np.arange(len(every)) - self.offset[owner] + (self.n - self.shared)[owner]  # position in the full set
        by = np.argsort(self.local, kind="stable")
        self.list_owner = owner[by]  # by token, then size
        self.list_at = np.searchsorted(self.local[by], np.arange(len(self.tokens) + 1))
        # Blocks of prefix postings: by token and range of positions.
        front = place - (self.n - self.shared)[owner] < prefix_length(self.n, self.shared, percent)[owner]
        token, who, pos = self.local[front], owner[front], place[front]
        by = np.lexsort((who, pos // BLOCK_POSITIONS, token))
        token, self.block_owner, pos = token[by], who[by], pos[by]
        cut = np.flatnonzero(np.append(True, (token[1:] != token[:-1]) | (pos[1:] // BLOCK_POSITIONS != pos[:-1] // BLOCK_POSITIONS)))
        self.block_from, self.block_to = cut, np.append(cut[1:], len(token))
        self.block_token = token[cut]
        self.block_pos = pos[cut] // BLOCK_POSITIONS * BLOCK_POSITIONS
        self.block_size = np.maximum.reduceat(self.n[self.block_owner], cut) if len(cut) else cut
        self.token_block = np.searchsorted(self.block_token, np.arange(len(self.tokens) + 1))

    def _candidates(self, x: int) -> np.ndarray:
        """Sets that share a prefix shingle with x in a block that positions do not rule out."""
        own = self.local[self.offset[x] : self.offset[x + 1]]
        own = own[: prefix_length(int(self.n[x]), int(self.shared[x]), self.percent)]
        pos = np.arange(len(own)) + self.n[x] - self.shared[x]
        first, last = self.token_block[own], self.token_block[own + 1]
        count = last - first
        block = np.repeat(first, count) + _ramp(count)
        i = np.repeat(pos, count)
        size = self.block_size[block]
        j_low, j_high = self.block_pos[block], self.block_pos[block] + BLOCK_POSITIONS - 1
        best = 1 + np.minimum(i, j_high) + np.minimum(self.n[x] - i - 1, size - j_low - 1)
        least = needed(self.n[x] + -(-self.percent * self.n[x] // 100), self.percent)
        block = block[best >= least]
        length = self.block_to[block] - self.block_from[block]
        found = np.unique(self.block_owner[np.repeat(self.block_from[block], length) + _ramp(length)])
        n = self.n[found]
        return found[(100 * np.minimum(n, self.n[x]) >= self.percent * np.maximum(n, self.n[x])) & (found != x)]

    def _overlaps(self, x: int, among: np.ndarray) -> np.ndarray:
        """Exact overlaps of x with sets, from their shingles."""
        mask = np.zeros(len(self.tokens), np.int64)
        mask[self.local[self.offset[x] : self.offset[x + 1]]] = 1
        length = self.shared[among]
        hits = mask[self.local[np.repeat(self.offset[among], length) + _ramp(length)]]
        return np.add.reduceat(hits, np.cumsum(length) - length)

    def _derived(self, x: int, y: int, overlaps: np.ndarray) -> np.ndarray | None:
        """Overlaps of y with all sets from those of x; null if their difference is not small."""
        a, b = self.local[self.offset[x] : self.offset[x + 1]], self.local[self.offset[y] : self.offset[y + 1]]
        gone, come = np.setdiff1d(a, b, True), np.setdiff1d(b, a, True)
        lists = (self.list_at[gone + 1] - self.list_at[gone]).sum() + (self.list_at[come + 1] - self.list_at[come]).sum()
        if 4 * lists > self.offset[-1]:
            return None
        out = overlaps.copy()
        for tokens, sign in ((gone, -1), (come, 1)):
            length = self.list_at[tokens + 1] - self.list_at[tokens]
            np.add.at(out, self.list_owner[np.repeat(self.list_at[tokens], length) + _ramp(length)], sign)
        return out

    def components(self) -> np.ndarray:
        """For each set (in the order given) the number of a set that stands for its component."""
        m = len(self.sets)
        parent = list(range(m))

        def root(k: int) -> int:
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = parent[k]
            return k

        answered: dict[int, np.ndarray] = {}  # root: overlaps with all sets of one answered member, and which
        member: dict[int, int] = {}
        for x in range(m):
            r = root(x)
            known = answered.get(r)
            over = self._derived(member[r], x, known) if known is not None else None
            if over is not None:
                near = np.flatnonzero(over)
            else:
                near = self._candidates(x)
                if not len(near):
                    continue
                over = np.zeros(m, np.int64)
                over[near] = self._overlaps(x, near)
                whole = np.zeros(m, np.int64)
                if len(near) > 8:  # many relatives: overlaps with all sets serve them too
                    everyone = np.arange(m)
                    whole = self._overlaps(x, everyone)
                    answered[r], member[r] = whole, x
            linked = near[(100 + self.percent) * over[near] >= self.percent * (self.n[x] + self.n[near])]
            for y in linked.tolist():
                if y != x:
                    a, b = root(x), root(y)
                    if a != b:
                        keep, lose = min(a, b), max(a, b)
                        parent[lose] = keep
                        if lose in answered:
                            if keep not in answered:
                                answered[keep], member[keep] = answered[lose], member[lose]
                            del answered[lose], member[lose]
        out = np.empty(m, np.int64)
        out[self.order] = self.order[[root(k) for k in range(m)]]
        return out


def _ramp(size: np.ndarray) -> np.ndarray:
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def _sets(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b, np.uint64) for b in column.to_pylist()]


class _Shared:
    """From blocks of documents to sizes, shared shingles and signatures."""

    def __init__(self, filters: list[Filter], size: int, percent: int):
        self.filters, self.size, self.percent = filters, size, percent

    def __call__(self, text: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(first row, end, sizes, shared sizes, signatures (2), shingles in order, where each row's begin)."""
        for i, j, words in scanned(text, True):
            doc, h = shingles(words, self.size)
            n = np.bincount(doc, minlength=j - i)
            rare = self.filters[0](h)
            doc, h = doc[rare], h[rare]
            c = np.bincount(doc, minlength=j - i)
            open_ = (c > 0) & (100 * c >= self.percent * n)
            pick = open_[doc]
            doc, h = doc[pick], h[pick]
            c = np.where(open_, c, 0)
            level = np.zeros(len(h), np.int8)
            for f in self.filters[1:]:
                level += f(h)
            order = np.lexsort((h, level, doc))
            h = h[order]
            at = np.zeros(len(c) + 1, np.int64)
            np.cumsum(c, out=at[1:])
            sums = np.zeros((2, len(h) + 1), np.uint64)
            np.cumsum(mix(h), out=sums[0, 1:])
            np.cumsum(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), out=sums[1, 1:])
            sig = sums[:, at[1:]] - sums[:, at[:-1]]
            yield i, j, n, c, signed(np.ascontiguousarray(sig)), h, at


def jaccard_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT, group: int = GROUP, bits: int = BITS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of df.

    Texts are lower-cased (A-Z) and split into words outside [\\x20\\x09-\\x0D]; a set is the distinct
    shingles of *size* words, or the whole sequence of a shorter text.  Two rows link if
    100 * intersection >= percent * union; component_id is the smallest id reachable by links.

    Null and empty texts have no shingles and link with nothing.  A row with a null id gives its size and a null
    component and links with nothing.  Rows that repeat an id are joined like others and share its component
    if they are linked.  Other columns are not read.  An empty table gives no rows.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def every():
        def run(batch: pa.RecordBatch) -> np.ndarray:
            return np.concatenate([np.empty(0, np.uint64), *(shingles(w, size)[1] for _, _, w in scanned(batch.column(0), True))])

        return run

    filters = frequent(docs, ["text"], every, CLASSES, bits)
    shared = spark.sparkContext.broadcast(_Shared(filters, size, percent))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for i, j, n, c, sig, _, _ in shared.value(batch.column(1)):
                open_ = c > 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n.astype(np.int32)), pa.array(c.astype(np.int32)), pa.array(sig[0], mask=~open_), pa.array(sig[1], mask=~open_)],
                    names=["doc_id", "n", "c", "sig_a", "sig_b"],
                )

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            seen: set[tuple[int, int, int]] = set()
            for i, j, n, c, sig, h, at in shared.value(batch.column(1)):
                pick = np.flatnonzero((c > 0) & known[i:j])
                fresh = []
                for k in pick.tolist():  # a batch sends each set once; ids are settled with the keys
                    key = (int(sig[0, k]), int(sig[1, k]), int(n[k]))
                    if key not in seen:
                        seen.add(key)
                        fresh.append(k)
                if fresh:
                    f = np.array(fresh)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(sig[0, f]), pa.array(sig[1, f]), pa.array(n[f].astype(np.int32)), pa.array(c[f].astype(np.int32)), pa.array([h[at[k] : at[k + 1]].tobytes() for k in fresh], pa.binary()), pa.array(signed(h)[at[f]])],
                        names=["sig_a", "sig_b", "n", "c", "tokens", "home"],
                    )

    rows = docs.mapInArrow(keys, "doc_id long, n int, c int, sig_a long, sig_b long")
    key = ["sig_a", "sig_b", "n"]
    classes = stash(rows.where("sig_a is not null and doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("item"), F.max("c").alias("c")))
    tokens = docs.mapInArrow(sets, "sig_a long, sig_b long, n int, c int, tokens binary, home long").groupBy(*key).agg(F.first("tokens").alias("tokens"), F.first("home").alias("home"))
    items = stash(tokens.join(classes, key).select("item", "n", "c", "home", "tokens"))

    links = stash(_home_links(items, group, percent))
    labels = small(stash(components(links).select(F.col("node").alias("item"), F.col("component").alias("label"))))
    near = stash(_verified(_label_pairs(_postings(items, labels, percent), percent), items, percent))
    links = links.unionByName(near)
    labels = small(stash(components(links).select(F.col("node").alias("item"), F.col("component").alias("label"))))
    last = stash(_verified(_item_pairs(_postings(items, labels, percent), percent), items, percent))
    if last.take(1):
        labels = small(stash(components(links.unionByName(last)).select(F.col("node").alias("item"), F.col("component").alias("label"))))

    settled = classes.join(labels, "item", "left")
    inner = (100 + percent) * F.col("c") >= 2 * percent * F.col("n")  # members of the item link with each other
    settled = settled.select(*key, F.coalesce("label", F.when(inner, F.col("item"))).alias("component"))
    out = rows.join(small(stash(settled)), key, "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def _home_links(items: DataFrame, group: int, percent: int) -> DataFrame:
    """(a, b): stars of the components among items with the same first shingle, in blocks of *group*."""
    homes = items.groupBy("home").count().where("count > 1")
    homes = small(stash(homes.select("home", F.ceil(F.col("count") / group).alias("salts"))))
    met = items.join(homes, "home").withColumn("salt", F.pmod(F.xxhash64("item"), F.col("salts")))

    def join(table: pa.Table) -> pa.Table:
        ids = table.column("item").to_numpy()
        found = LocalJoin(_sets(table.column("tokens")), table.column("n").to_numpy(), percent).components()
        other = np.flatnonzero(found != np.arange(len(ids)))
        return pa.table({"a": ids[other], "b": ids[found[other]]})

    return met.select("home", "salt", "item", "n", "tokens").groupBy("home", "salt").applyInArrow(join, "a long, b long")


def _postings(items: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(token, item, n, c, label, i, lead) of the shared prefix shingles; i: place among the item's shared shingles; lead: its first LEAD ones."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            item, n, c, label = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            sets = _sets(batch.column(4))
            length = prefix_length(n.astype(np.int64), c.astype(np.int64), percent)
            for a in range(0, len(sets), 256):
                part = slice(a, a + 256)
                token = np.concatenate([s[:k] for s, k in zip(sets[part], length[part], strict=True)])
                place = _ramp(length[part]).astype(np.int32)
                lead = [signed(s[: min(k, LEAD)]) for s, k in zip(sets[part], length[part].tolist(), strict=True) for _ in range(k)]
                at = np.zeros(len(lead) + 1, np.int32)
                np.cumsum([len(x) for x in lead], out=at[1:])
                leads = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(lead)))
                yield pa.RecordBatch.from_arrays([pa.array(signed(token)), *(pa.array(np.repeat(x[part], length[part])) for x in (item, n, c, label)), pa.array(place), leads], names=["token", "item", "n", "c", "label", "i", "lead"])

    labelled = items.join(labels, "item", "left").select("item", "n", "c", F.coalesce("label", "item").alias("label"), "tokens")
    return labelled.mapInArrow(spread, "token long, item long, n int, c int, label long, i int, lead array<long>")


def _likely(common: str, percent: int):
    """Whether so many common prefix shingles make a link likely; the exact pass does not rely on it."""
    rest = [F.ceil(percent * F.col(f"n_{k}") / 100) - 1 for k in "xy"]
    return F.col(common) + F.least(*rest) >= F.ceil(percent * (F.col("n_x") + F.col("n_y")) / (100 + percent))


def _label_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """(x, y): for each prefix shingle that components share, one pair of items of the smallest and each other component."""
    heads = postings.groupBy("token", "label").agg(F.min(F.struct("item", "n", "c", "i")).alias("head"))
    centres = heads.groupBy("token").agg(F.min(F.struct("label", "head")).alias("centre"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
    own = [F.col(f"centre.head.{k}").alias(a) for k, a in (("item", "x"), ("n", "n_x"), ("c", "c_x"), ("i", "i_x"))]
    other = [F.col(f"head.{k}").alias(a) for k, a in (("item", "y"), ("n", "n_y"), ("c", "c_y"), ("i", "i_y"))]
    pairs = heads.join(centres, "token").where("label <> centre.label").select(*own, *other)
    counted = pairs.where(_may_link(percent)).groupBy("x", "y", "n_x", "n_y").count()
    return counted.where(_likely("count", percent)).select("x", "y")


def _may_link(percent: int):
    """Whether sizes, and the places of a common shingle among the shared ones, leave enough room for a link."""
    room = F.least("i_x", "i_y") + 1 + F.least(F.col("c_x") - F.col("i_x") - 1, F.col("c_y") - F.col("i_y") - 1)
    return (100 + percent) * room >= percent * (F.col("n_x") + F.col("n_y"))


def _early_enough(percent: int):
    """Whether a common prefix shingle can be the first of as many as a link needs.

    Of two sets, the one whose prefix ends first has all further common shingles in its rest; so a link has at least
    needed - (longer rest) common prefix shingles, and the first of them has the others behind it in both prefixes.
    """
    whole = {k: F.ceil(percent * F.col(f"n_{k}") / 100) for k in "xy"}
    least = F.ceil(percent * (F.col("n_x") + F.col("n_y")) / (100 + percent)) - F.greatest(*whole.values()) + 1
    places = [F.col(f"i_{k}") <= F.col(f"c_{k}") - whole[k] + 1 - least for k in "xy"]
    return (least <= 1) | (places[0] & places[1])


def _item_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """(x, y): every pair of items of different components that shares a prefix shingle and may link.

    A pair is left out where it has certainly met before, at a common shingle among the first ones of both, so
    pairs of a large group come once rather than once per common shingle.
    """
    postings = stash(postings)
    mixed = stash(postings.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("token"))
    open_ = stash(postings.join(mixed, "token", "left_semi"))
    names = ("n", "c", "i", "label", "lead")
    x = open_.select("token", F.col("item").alias("x"), *[F.col(k).alias(f"{k}_x") for k in names])
    y = open_.select("token", F.col("item").alias("y"), *[F.col(k).alias(f"{k}_y") for k in names])
    met = F.expr("arrays_overlap(slice(lead_x, 1, i_x), slice(lead_y, 1, i_y))")
    on = (x["token"] == y["token"]) & (F.col("x") < F.col("y")) & (F.col("label_x") != F.col("label_y")) & _early_enough(percent) & _may_link(percent) & ~met
    return x.join(y, on).select("x", "y").distinct()


def _verified(pairs: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs whose sets link."""
    left = items.select(F.col("item").alias("x"), F.col("n").alias("n_x"), F.col("tokens").alias("tokens_x"))
    right = items.select(F.col("item").alias("y"), F.col("n").alias("n_y"), F.col("tokens").alias("tokens_y"))
    met = small(stash(pairs)).join(left, "x").join(right, "y").select("x", "y", "n_x", "n_y", "tokens_x", "tokens_y")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            n = batch.column(2).to_numpy().astype(np.int64) + batch.column(3).to_numpy()
            over = np.array([len(np.intersect1d(a, b, True)) for a, b in zip(_sets(batch.column(4)), _sets(batch.column(5)), strict=True)], np.int64)
            ok = pa.array((100 + percent) * over >= percent * n)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["a", "b"])

    return met.mapInArrow(compare, "a long, b long")


def keep_one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of df, with all their columns, whose id is the smallest of its component; rows with a null id stay."""
    (mark,) = fresh(df, "dropped_id")
    joined = jaccard_join(df, id_col, text_col, **options)
    dropped = small(stash(joined.where("doc_id <> component_id").select(F.col("doc_id").alias(mark)).distinct()))
    return df.join(dropped, df[id_col] == dropped[mark], "left_anti")
