"""Equal reads are aligned once; each of them has the places that it has alone."""

import random

from methframe.operators import align


def _rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def _aligned(monkeypatch, call):
    """Rows of call() and how many rows met the reference."""
    met = []
    kept = align.with_reference
    monkeypatch.setattr(align, "with_reference", lambda df, *a, **k: (met.append(df), kept(df, *a, **k))[1])
    rows = call().collect()
    monkeypatch.setattr(align, "with_reference", kept)
    return rows, sum(df.count() for df in met)


def test_copies_of_reads_and_pairs_meet_the_reference_once(spark, monkeypatch):
    r = random.Random(5)
    seq = "".join(r.choices("ACGT", k=3000))
    t = seq.replace("C", "T")
    genome = spark.createDataFrame([("chr1", seq)], "chr string, seq string")
    texts = [t[a : a + 30] + t[a + 31 : a + 61] for a in range(0, 500, 50)]
    rows = [(k, texts[k % 10] if k % 13 else None, chr(40 + k % 50) * 60) for k in range(400)]
    reads = spark.createDataFrame(rows, "read_no long, seq string, qual string")
    got, met = _aligned(monkeypatch, lambda: align.align(reads, genome, "W"))
    assert met < 40 and len(got) == sum(s is not None for _, s, _ in rows)
    for x in got:
        assert (x["seq"], x["qual"]) == rows[x["read_no"]][1:] and x["pos"] == 1 + 50 * (x["read_no"] % 10) and x["as_score"] == -8
    pairs = [(k, t[100 * (k % 5) :][:50], "I" * 50, _rc(t[100 * (k % 5) + 80 + k % 3 :][:50]), chr(40 + k % 50) * 50) for k in range(300)]
    got, met = _aligned(monkeypatch, lambda: align.align_pairs(spark.createDataFrame(pairs, "read_no long, seq1 string, qual1 string, seq2 string, qual2 string"), genome, "W"))
    assert met < 60 and sorted(x["read_no"] for x in got) == list(range(300))
    for x in got:
        k = x["read_no"]
        assert (x["pos1"], x["pos2"], x["as_score"], x["seq1"], x["seq2"], x["qual2"]) == (1 + 100 * (k % 5), 81 + 100 * (k % 5) + k % 3, 0, pairs[k][1], _rc(pairs[k][3]), pairs[k][4][::-1])
