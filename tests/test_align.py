"""Gapped and paired alignment against plain dynamic programming and all pairs of places."""

import random
import re

import numpy as np
import pytest

from methframe.operators import align


def brute(read, ref):
    """Best end-to-end score of a read anywhere in a reference, by a full table; gaps keep off both ends."""
    low, n = -10**9, len(read)
    m = [[0] * (len(ref) + 1)] + [[low] * (len(ref) + 1) for _ in read]
    ins = [[low] * (len(ref) + 1) for _ in range(n + 1)]
    dele = [[low] * (len(ref) + 1) for _ in range(n + 1)]
    for i in range(n + 1):
        for j in range(len(ref) + 1):
            if i and j:
                c = -1 if "N" in (read[i - 1], ref[j - 1]) else 0 if read[i - 1] == ref[j - 1] else -6
                m[i][j] = max(m[i - 1][j - 1], ins[i - 1][j - 1], dele[i - 1][j - 1]) + c
            if i and 4 <= i - 1 < n - 4:
                ins[i][j] = max(max(m[i - 1][j], dele[i - 1][j]) - 8, ins[i - 1][j] - 3)
            if j and 4 <= i <= n - 4:
                dele[i][j] = max(max(m[i][j - 1], ins[i][j - 1]) - 8, dele[i][j - 1] - 3)
    return max(max(m[n]), max(ins[n]), max(dele[n]))


def rescored(read, ref, cigar):
    """Score of a CIGAR against the reference from its first base."""
    i = j = score = 0
    for n, op in re.findall(r"(\d+)([MID])", cigar):
        n = int(n)
        if op == "M":
            score += sum(-1 if "N" in (a, b) else 0 if a == b else -6 for a, b in zip(read[i : i + n], ref[j : j + n], strict=True))
            i, j = i + n, j + n
        else:
            score -= 5 + 3 * n
            i, j = (i + n, j) if op == "I" else (i, j + n)
    assert i == len(read)
    return score, j


@pytest.mark.parametrize("length", [40, 60, 100])
def test_band_equals_full_tables(length):
    r = random.Random(length)
    gap = align.longest_gap(length)
    assert gap == {40: 1, 60: 2, 100: 5}[length]
    reads, refs = [], []
    for _ in range(25):
        ref = "".join(r.choices("AGT", k=length + 2 * gap))
        own = list(ref[gap:])
        for _ in range(r.randint(0, 2)):
            k = r.randrange(5, length - 5)
            what = r.random()
            if what < 0.4:
                own[k] = r.choice("AGTN")
            elif what < 0.7:
                del own[k : k + r.randint(1, gap)]
            else:
                own[k:k] = r.choices("AGT", k=r.randint(1, gap))
        read = "".join(own)[:length].ljust(length, "A")
        reads.append(read)
        refs.append(ref)
    code = lambda x: np.array([list(s.encode()) for s in x], np.uint8)
    score, start, cigar = align.band_align(code(reads), code(refs), gap)
    for read, ref, s, at, c in zip(reads, refs, score.tolist(), start.tolist(), cigar, strict=True):
        found, used = rescored(read, ref[at + gap :], c)
        assert found == s and at + gap + used <= len(ref)
        full = brute(read, ref)
        if full >= align.MIN_SCORE * length:  # what a valid alignment needs lies in the band
            assert s == full


def random_genome(seed, n=4000):
    r = random.Random(seed)
    return r, "".join(r.choices("ACGT", k=n))


def test_indels_are_found(spark):
    r, seq = random_genome(1)
    rows, want = [], {}
    for k in range(60):
        at = r.randrange(0, 3800)
        a, b = seq[at : at + 30], seq[at + 30 : at + 60]
        kind = k % 4
        read, cigar, score = [(a + seq[at + 32 : at + 62], "2D", -11), (a + "AA" + b[:28], "2I", -11), (a + b, "60M", 0), (a + ("A" if b[0] != "A" else "T") + b[1:], "60M", -6)][kind]
        if kind == 3:
            score = -6 if {b[0], read[30]} != {"C", "T"} else 0
        rows.append((k, read.replace("C", "T"), "I" * 60))
        want[k] = (at + 1, cigar, score)
    genome = spark.createDataFrame([("chr1", seq), ("chr2", "ACGT" * 3)], "chr string, seq string")
    reads = spark.createDataFrame(rows, "read_no long, seq string, qual string")
    got = {x["read_no"]: x for x in align.align(reads, genome, "W").collect()}
    for k, (pos, cigar, score) in want.items():
        assert got[k]["pos"] == pos and got[k]["as_score"] >= score and (got[k]["as_score"] > score or cigar in got[k]["cigar"]), (k, got[k], pos, cigar)
    assert sum(got[k]["as_score"] == s for k, (_, _, s) in want.items()) > 55
    assert align.align(reads.limit(0), genome, "W").count() == 0


def test_edges_of_a_chromosome(spark):
    _, seq = random_genome(2, 200)
    t = seq.replace("C", "T")
    rows = [(1, t[:60]), (2, t[140:]), (3, t[1:30] + t[32:63]), (4, "GGGGG" + t[:55])]
    genome = spark.createDataFrame([("chr1", seq)], "chr string, seq string")
    got = {x["read_no"]: (x["pos"], x["as_score"]) for x in align.align(spark.createDataFrame([(k, s, "I" * len(s)) for k, s in rows], "read_no long, seq string, qual string"), genome, "W").collect()}
    assert got[1] == (1, 0) and got[2] == (141, 0) and got[3] == (2, -11) and 4 not in got


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


@pytest.mark.parametrize("strand", "WC")
def test_pairs_against_all_pairs_of_places(spark, strand):
    r, seq = random_genome(3, 3000)
    repeat = seq[500:620]
    seq = seq[:1500] + repeat + seq[1620:2000] + repeat + seq[2120:]
    letters = ("C", "T") if strand == "W" else ("G", "A")
    t = seq.replace(*letters)
    rows = []
    for k in range(50):
        a = r.randrange(0, 2800) if k % 5 else r.choice([520, 1520, 2020]) + r.randrange(0, 40)
        b = min(2940, max(0, a + r.choice([-30, 0, 20, 100, 180, 700])))
        left, right = t[a : a + 50], t[b : b + 50]
        if k % 7 == 0:
            left = left[:25] + left[26:] + t[a + 50]
        rows.append((k, left, rc(right)) if strand == "W" else (k, rc(left), right))
    pairs = spark.createDataFrame([(k, a, "I" * 50, b, "#" * 50) for k, a, b in rows], "read_no long, seq1 string, qual1 string, seq2 string, qual2 string")
    genome = spark.createDataFrame([("chr1", seq)], "chr string, seq string")
    got = {x["read_no"]: x for x in align.align_pairs(pairs, genome, strand, 60, 250).collect()}
    one = [{}, {}]
    for mate in (1, 2):
        for x in align.places(align.oriented(pairs, strand, mate), genome, strand).collect():
            spent = sum(int(n) for n, o in re.findall(r"(\d+)([MID])", x["cigar"]) if o != "I")
            one[mate - 1].setdefault(x["read_no"], []).append((x["pos"], x["pos"] + spent - 1, x["as_score"]))
    for k in range(50):
        both = sorted(
            (-p[2] - q[2], p[0], q[0]) for p in one[0].get(k, []) for q in one[1].get(k, []) if 60 <= max(p[1], q[1]) - min(p[0], q[0]) + 1 <= 250
        )
        if not both:
            assert k not in got
            continue
        x = got[k]
        assert (-x["as_score"], x["pos1"], x["pos2"]) == both[0] and x["has_xs"] == (len(both) > 1)
        assert x["mapq"] == (42 if len(both) == 1 else 30 if both[1][0] > both[0][0] else 1)
    assert 20 < len(got) < 50
