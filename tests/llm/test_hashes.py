"""Word and window hashes: no pattern of bytes or words makes different ones equal."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from methframe.llm import gru_lm
from methframe.llm.common import bucket
from methframe.llm.jaccard_join import jaccard_join
from methframe.llm.substring_dedup import substring_dedup
from methframe.llm.wordhash import scan

from .test_dedup_and_mixing import counted, linked, without_repeats


def thue_morse(n: int, a: str = "a", b: str = "b") -> tuple[str, str]:
    """A word of n letters and its complement: equal under every polynomial hash modulo 2**64 from 1,024 letters on."""
    bits = [bin(k).count("1") & 1 for k in range(n)]
    return "".join(b if x else a for x in bits), "".join(a if x else b for x in bits)


PAIRS = [w for n in (1024, 2048) for w in thue_morse(n)]


def test_lanes_of_words_and_windows():
    r = random.Random(1)
    words = sorted({"".join(r.choice("abéZ") for _ in range(r.choice((1, 3, 7, 8, 9, 15, 16, 17, 63, 64, 65, 200)))) for _ in range(3000)} | set(PAIRS))
    text = " ".join(words).encode()
    found = scan(np.frombuffer(text + b" " + text, np.uint8), np.array([0, 2 * len(text) + 1]), False)
    for lane in (found.hash, found.check):
        assert (lane[: len(words)] == lane[len(words) :]).all() and len(set(lane.tolist())) == len(words)
    assert not (set(found.hash.tolist()) & set(found.check.tolist()))
    lower = scan(np.frombuffer(b"ABC abc ABc", np.uint8), np.array([0, 11]), True)
    assert len(set(lower.hash.tolist())) == 1
    sequence = [r.choice(words[:4]) for _ in range(4000)]
    raw = " ".join(sequence).encode()
    found = scan(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), False)
    for n in (1, 2, 3, 5, 10, 20):
        for lane in (0, 1):
            at, h = found.windows(n, lane)
            assert len(at) == 4000 - n + 1 and len(set(h.tolist())) == len({tuple(sequence[k : k + n]) for k in at})


@pytest.fixture(scope="module")
def patterned():
    """Documents that share nothing but the lengths of their words, and Thue-Morse sequences of words."""
    a, b = thue_morse(1024)
    c, d = thue_morse(2048)
    x, y = thue_morse(64, "red ", "blue ")
    return [(1, " ".join([a] * 30)), (2, " ".join([b] * 30)), (3, " ".join([c] * 30)), (4, " ".join([d] * 30)), (5, x), (6, y), (7, f"{a} {b}"), (8, f"{b} {a}")]


def test_patterns_decide_nothing(spark, patterned):
    df = spark.createDataFrame(patterned, "doc_id long, text string").repartition(3)
    assert counted(map(tuple, substring_dedup(df).collect())) == counted(without_repeats(patterned, 20))
    assert counted(map(tuple, jaccard_join(df).collect())) == counted(linked(patterned))


@pytest.mark.parametrize("known", [1 << 20, 0])
def test_patterns_are_not_known_words(spark, known):
    a, b = thue_morse(1024)
    held = next(k for k in range(100) if __import__("zlib").crc32(str(k).encode()) % 10 == 0)
    learned = next(k for k in range(100) if __import__("zlib").crc32(str(k).encode()) % 10)
    df = spark.createDataFrame([(held, f"{a} {b}"), (learned, a)], "doc_id long, text string")
    out = {r["doc_id"]: r["n_known"] for r in gru_lm.score(df, df.where(bucket(F.col("doc_id"), 10) != 0), known=known).collect()}
    assert out == {held: 2, learned: 2}  # the learned word and the end


def test_long_words_are_digested():
    word = b"q" * 1000
    found = scan(np.frombuffer(word, np.uint8), np.array([0, 1000]), False)
    assert int(found.hash[0]).to_bytes(8, "little") + int(found.check[0]).to_bytes(8, "little") == hashlib.blake2b(word, digest_size=16).digest()
