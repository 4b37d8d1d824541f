"""Language identification by cross-parsing entropy.

Per language a suffix automaton is built over labelled text.  A text is parsed
greedily into the longest phrases that occur in that text (a walk along the
automaton's transitions from its root, begun anew where none is left); the fewer
phrases, the closer the language.  Phrase counts are normalised with the usual
cross-parsing estimate: phrases * log2(training length) / text length.

Fitting is bounded: per language the labelled documents with the smallest hashes,
DOCUMENTS at most, give LETTERS symbols at most.  Every language with a training row is
learned; automata are broadcast in groups of GROUP languages, and a worker holds one group at a time.
Prediction reads whole texts, and a phrase ends only where the language has no longer match.  For numpy, thousands of
blocks of BLOCK symbols advance together: first each from the root, then again from the state
in which its predecessor ended, until the two walks meet (from there on they are one) or the block ends;
this is repeated while any block's last state changed.  The counts are those of one walk over the whole text.

Letters and the marks that combine with them are symbols, everything else is a space.
"""

from __future__ import annotations

import copy
import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from .arrowmap import add_columns

DOCUMENTS = 64
LETTERS = 40_000
SALTS = 64  # tasks that share the ranking of one language's documents
GROUP = 16  # languages whose automata are in memory together
BLOCK = 1024
UNDETERMINED = "und"
_SLICE = 1 << 20  # characters mapped and parsed at once


class Automaton:
    """Transitions of the automaton of all substrings, sparse: a dict of symbols per state; -1: none; state 0 is the root."""

    def __init__(self, rows: list[dict[int, int]]):
        self.rows = rows

    def __getitem__(self, key: tuple[int, int]) -> int:
        return self.rows[key[0]].get(key[1], -1)


def suffix_automaton(symbols: list[int], width: int) -> Automaton:
    """The automaton of symbols below width."""
    rows: list[dict[int, int]] = [{}]
    length, link = [0], [-1]
    last = 0
    for c in symbols:
        new = len(rows)
        rows.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in rows[p]:
            rows[p][c] = new
            p = link[p]
        if p >= 0:
            q = rows[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(rows)
                rows.append(dict(rows[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and rows[p].get(c) == q:
                    rows[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return Automaton(rows)


def _packed(go: Automaton, width: int) -> tuple[np.ndarray, int]:
    """(table, root): the rows displaced over each other in one table.

    A state is its row's displacement, which no other state has; the entry at state + symbol holds
    symbol << 32 | next state where it belongs to the state, and another symbol (or -1) where it does not.
    """
    rows = go.rows
    order = sorted(range(len(rows)), key=lambda s: -len(rows[s]))  # wide rows first, while there is room
    size = 1 << max(6, (2 * max(len(rows), sum(map(len, rows)))).bit_length())
    while True:
        filled, taken = bytearray(size + width), bytearray(size)
        base, at, ok = [0] * len(rows), 0, True
        for s in order:
            row = rows[s]
            for _ in range(4096):
                at = (at * 1103515245 + 12345) & (size - 1)  # runs through all places
                if not taken[at] and not any(filled[at + c] for c in row):
                    break
            else:
                ok = False
                break
            base[s] = at
            taken[at] = 1
            for c in row:
                filled[at + c] = 1
        if ok:
            break
        size *= 2
    table = np.full(size + width, -1, np.int64)
    for s, row in enumerate(rows):
        for c, to in row.items():
            table[base[s] + c] = c << 32 | base[to]
    return table, base[0]


class Group:
    """Automata of some languages in one table, ready for parallel parsing."""

    def __init__(self, samples: list[np.ndarray], width: int):
        roots, tables, base = [], [], 0
        for symbols in samples:
            table, root = _packed(suffix_automaton(symbols.tolist(), width), width)
            roots.append(base + root)
            tables.append(np.where(table < 0, table, table + base))
            base += len(table)
        self.table = np.concatenate(tables)
        self.roots = np.array(roots, np.int64)[:, None]
        # Where a language's root leads by each symbol: a symbol that it lacks is a phrase of its own.
        entry = self.table[self.roots + np.arange(width)]
        self.first = np.where(entry >> 32 == np.arange(width), entry & 0xFFFFFFFF, self.roots)

    def _step(self, state: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next states, whether a phrase began) of states (languages x walks) by the walks' next symbols; a symbol that a language lacks is a phrase and leads to its root."""
        entry = self.table[state + c]
        restart = entry >> 32 != c  # no transition was left
        return np.where(restart, self.first[:, c], entry & 0xFFFFFFFF), restart | (state == self.roots)

    def phrases(self, symbols: np.ndarray, start: np.ndarray, size: np.ndarray, follows: np.ndarray) -> np.ndarray:
        """Phrases (languages x blocks) that begin in the blocks of symbols at start; follows: whether a block goes on with the text of the one before."""
        order = np.argsort(-size, kind="stable")
        begin, length = start[order], size[order]
        active = np.searchsorted(-length, -np.arange(int(length[0])), "left")  # blocks longer than t
        state = np.repeat(self.roots, len(start), 1)
        count = np.zeros((len(self.roots), len(start)), np.int32)
        for t in range(int(length[0])):
            m = active[t]
            state[:, :m], restart = self._step(state[:, :m], symbols[begin[:m] + t].astype(np.int64))
            count[:, :m] += restart
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        count, last = count[:, back], state[:, back]
        entered = np.repeat(self.roots, len(start), 1)
        while True:
            ahead = np.roll(last, 1, 1)
            again = np.flatnonzero(follows & (ahead != entered).any(0))  # blocks that begin in another state than they were walked from
            if not len(again):
                return count
            old, new = entered[:, again], ahead[:, again]
            entered[:, again] = new
            begin, left, t = start[again], size[again], 0
            while len(again):
                c = symbols[begin + t].astype(np.int64)
                old, before = self._step(old, c)
                new, now = self._step(new, c)
                count[:, again] += now.astype(np.int32) - before
                t += 1
                over = left == t
                last[:, again[over]] = new[:, over]
                on = (old != new).any(0) & ~over
                again, begin, left, old, new = again[on], begin[on], left[on], old[:, on], new[:, on]


class LanguageModel:
    """Symbols and training samples of all languages; their automata are built group by group."""

    def __init__(self, samples: dict[str, list[str]], letters: int = LETTERS, group: int = GROUP):
        texts = {lang: " ".join(t.lower() for t in parts) for lang, parts in sorted(samples.items())}
        known = sorted({ch for t in texts.values() for ch in set(t) if _counts(ch)})  # each is a symbol of its own
        self.width = len(known) + 2  # then "another letter" and "space"
        self.letter = {ch: i for i, ch in enumerate(known)}
        self.codes = _symbol_table(self.letter, self.width)
        self.alpha = np.fromiter((chr(k).isalpha() for k in range(0x110000)), bool, 0x110000)
        self.langs, self.sizes, self.samples = [], [], []
        for lang, t in texts.items():
            symbols = _collapse(self.codes, np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32), self.width - 1)[0][:letters]
            if not (symbols < self.width - 1).any():
                continue
            self.langs.append(lang)
            self.sizes.append(len(symbols))
            self.samples.append(symbols)
        self.bounds = [(k, min(k + group, len(self.langs))) for k in range(0, len(self.langs), group)]

    def group(self, k: int) -> Group:
        """The automata of the k-th group of languages, built anew."""
        return Group(self.samples[slice(*self.bounds[k])], self.width)

    def without_samples(self) -> LanguageModel:
        """What workers need besides the groups."""
        out = copy.copy(self)
        out.samples = []
        return out

    def phrases(self, texts: list[str], groups: list[Group] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrases: texts x languages of the groups, symbols per text, whether a text has a letter); all groups by default."""
        if groups is None:
            groups = [self.group(k) for k in range(len(self.bounds))]
        n, width = len(texts), self.width
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        bounds = np.zeros(n + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=bounds[1:])
        symbols, kept = _collapse(self.codes, points, width - 1, bounds)
        lengths = np.diff(kept)
        found = np.zeros(len(points) + 1, np.int64)
        np.cumsum(self.alpha[points], out=found[1:])
        lettered = found[bounds[1:]] > found[bounds[:-1]]
        out = np.zeros((n, sum(len(g.roots) for g in groups)), np.int64)
        if not groups or not len(symbols):
            return out, lengths, lettered
        blocks = -(-lengths // BLOCK)
        owner = np.repeat(np.arange(n), blocks)
        rank = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = kept[:-1][owner] + rank * BLOCK
        size = np.minimum(BLOCK, kept[1:][owner] - start)
        i = 0
        for g in groups:
            for count in g.phrases(symbols, start, size, rank > 0):
                out[:, i] = np.bincount(owner, count, n).astype(np.int64)
                i += 1
        return out, lengths, lettered

    def predict(self, texts: list[str | None], load: Callable[[int], Group] | None = None) -> tuple[list[str], list[float]]:
        """Languages and scores; load gives the groups, one at a time."""
        n = len(texts)
        slices, i = [], 0
        while i < n:
            j, chars = i, 0
            while j < n and (j == i or chars + len(texts[j] or "") <= _SLICE):
                chars += len(texts[j] or "")
                j += 1
            slices.append(slice(i, j))
            i = j
        least, best, shares, lettered = np.full(n, np.inf), np.zeros(n, np.int64), np.zeros(n), np.zeros(n, bool)
        for k, (first, last) in enumerate(self.bounds):
            group = (load or self.group)(k)
            for at in slices:
                phrases, lengths, lettered[at] = self.phrases([(t or "").lower() for t in texts[at]], [group])
                entropy = phrases * np.log2(np.array(self.sizes[first:last]) + 2.0) / np.maximum(lengths, 1)[:, None]
                low = entropy.min(1)
                share = np.exp2(-4 * (entropy - low[:, None])).sum(1)
                lower, before = low < least[at], least[at]
                # The shares of all groups so far, relative to the least entropy of all.
                shares[at] = np.where(lower, share + shares[at] * np.exp2(-4 * (before - low)), shares[at] + share * np.exp2(-4 * np.maximum(low - before, 0)))
                best[at] = np.where(lower, first + entropy.argmin(1), best[at])
                least[at] = np.minimum(before, low)
            del group
        names, scores = [UNDETERMINED] * n, [0.0] * n
        for k in np.flatnonzero(lettered):
            names[k], scores[k] = self.langs[best[k]], float(1 / shares[k])
        return names, scores


def _counts(ch: str) -> bool:
    """Whether a character is a symbol: a letter, or a mark that combines with letters."""
    return ch.isalpha() or unicodedata.category(ch)[0] == "M"


def _symbol_table(letter: dict[str, int], width: int) -> np.ndarray:
    """Symbol of each code point below 0x110000: known letters, another letter, space."""
    out = np.full(0x110000, width - 1, np.uint8 if width <= 256 else np.int32)
    for point in range(0x110000):
        if _counts(chr(point)):
            out[point] = width - 2
    for ch, i in letter.items():
        out[ord(ch)] = i
    return out


def _collapse(codes: np.ndarray, points: np.ndarray, space: int, bounds: np.ndarray | None = None):
    """Symbols with runs of spaces as one, and where each text begins in them."""
    symbols = codes[points]
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != space) | (symbols[:-1] != space)
    if bounds is None:
        return symbols[keep], None
    inner = bounds[:-1][bounds[:-1] < len(symbols)]
    keep[inner] = True
    sums = np.zeros(len(symbols) + 1, np.int64)
    np.cumsum(keep, out=sums[1:])
    return symbols[keep], sums[bounds]


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", documents: int = DOCUMENTS, letters: int = LETTERS) -> LanguageModel:
    """A model of all languages of the labelled rows (null languages and texts are left out), bounded by documents and letters a language.

    Ids choose the documents, by hash; their texts are then read in a second pass, so that only ids are sorted.
    Of rows that repeat an id and a language the first text in sorting order is taken.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    keys = rows.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.xxhash64(F.col(id_col).cast("string")).alias("h"))
    # The first of each partition, of each salt's partitions, of each language: no task ranks more than SALTS * documents
    # rows of a language, or a salt's share of the partitions' firsts. Which partition a row is in changes no result.
    salted = keys.distinct().withColumn("salt", F.spark_partition_id() % SALTS)
    order = Window.partitionBy("lang", "salt").orderBy("h", "id")
    salted = salted.withColumn("n", F.row_number().over(order)).where(F.col("n") <= documents).drop("n", "salt")
    chosen = salted.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "id"))).where(F.col("n") <= documents)
    ids = F.broadcast(chosen.select(F.col("lang").alias("chosen_lang"), F.col("id").alias("chosen_id"), "n"))  # languages * documents rows at most
    text = F.substring(F.col(text_col), 1, letters).alias("text")
    found = rows.join(ids, (rows[id_col] == F.col("chosen_id")) & (rows[lang_col] == F.col("chosen_lang"))).groupBy("chosen_lang", "n").agg(F.min(text).alias("text"))
    # Only texts that begin within the sample come to the driver.
    ahead = Window.partitionBy("chosen_lang").orderBy("n", "text").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("ahead", F.coalesce(F.sum(F.length("text")).over(ahead), F.lit(0))).where(F.col("ahead") < letters)
    samples: dict[str, list[str]] = {}
    for r in sorted(found.select("chosen_lang", "n", "text").collect(), key=lambda r: (r["chosen_lang"], r["n"], r["text"])):
        samples.setdefault(r["chosen_lang"], []).append(r["text"])
    return LanguageModel(samples, letters)


def identify(df: DataFrame, model: LanguageModel, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """df with the predicted language and its share (0 to 1) among all languages' evidence.

    Null texts and texts without a letter give 'und' and 0, as does a model without languages.
    Columns named like the outputs are replaced; all others pass through; repeated rows get equal answers.
    """
    context = df.sparkSession.sparkContext
    head = context.broadcast(model.without_samples())
    groups = [context.broadcast(model.group(k)) for k in range(len(model.bounds))]  # bounded each: GROUP * 2 * letters states

    def make():
        m = head.value

        def load(k: int) -> Group:
            group = groups[k].value
            if len(groups) > 1 and hasattr(groups[k], "_path"):  # or the worker would keep every group that it has read
                vars(groups[k]).pop("_value", None)
            return group

        return lambda batch: m.predict(batch.column(text_col).to_pylist(), load)

    return add_columns(df, [(lang_out, T.StringType()), (score_out, T.DoubleType())], make)


def training_rows(df: DataFrame, remainder: Column, held_out: int) -> DataFrame:
    """Rows whose remainder is known and not the held-out one."""
    return df.where(remainder.isNotNull() & (remainder != held_out))
