"""Trimming and places in batches: what they give by the definition, and that no walk over a read's places is left in the plan."""

import random

import pytest
from pyspark.sql import functions as F

from methframe.functions import batches as B
from methframe.functions.reads import ADAPTERS
from methframe.operators import preprocess

SWAP = dict(zip("ACGT", "TGCA", strict=True))


def texts(seed, n):
    """Reads with whole and spoilt adapters, of any length, some with other characters, some null."""
    r = random.Random(seed)
    for k in range(n):
        ad = "".join(c if r.random() > 0.12 else r.choice("ACGTN") for c in r.choice([a.read1 for a in ADAPTERS.values()]))
        s = "".join(r.choice("ACGT") for _ in range(r.randint(0, 40)))
        s = (s + ad + "".join(r.choice("ACGT") for _ in range(40)))[: r.randint(0, 60)]
        if k % 9 == 0 and s:
            at = r.randrange(len(s))
            s = s[:at] + r.choice("äN€𝄞") + s[at + 1 :]
        yield None if k % 31 == 0 else s + r.choice(["", "A", "AG", "AA", "CT"])


def quals(seed, n):
    r = random.Random(seed)
    for k in range(n):
        yield None if k % 37 == 0 else "".join(r.choice("II5é") for _ in range(r.randint(0, 60))) + "".join(r.choice("4#I") for _ in range(r.randint(0, 5)))


def plain(kit, seqs, quals, least=20):
    """(trimmed_length, adapter_at, tail) of one read or pair."""
    ad = ADAPTERS[kit]
    ads = [ad.read1, ad.read2]
    length = 1
    if all(q is not None for q in quals):
        length = max([i + 1 for i in range(min(map(len, quals))) if all(ord(q[i]) >= 53 for q in quals)] + [1])
    if length < least or any(s is None for s in seqs):
        return length, None, 0
    seqs = [s[:length] for s in seqs]
    n0 = len(seqs[0])
    for i in sorted({k for s in seqs for k in range(len(s)) if s[k : k + 3] == ad.seed}):
        n = min(ad.length, n0 - i)
        wrong = [sum(s[i + k : i + k + 1] != a[k] for k in range(n)) for s, a in zip(seqs, ads)]
        if n >= 3 and max(wrong) <= (n + 3) // 4 and (len(seqs) == 1 or sum(wrong) <= (n + 1) // 2):
            return length, i, 0
    two = all(s.endswith(a[:2]) for s, a in zip(seqs, ads))
    if len(seqs) == 1:
        return length, None, 2 if two else 0
    one = all(s.endswith(a[:1]) for s, a in zip(seqs, ads))

    def evidence(i, j):
        return all(a[i : i + 1] in SWAP and SWAP[a[i : i + 1]] == b[j : j + 1] for a, b in (seqs, seqs[::-1]))

    if n0 < 9:
        return length, None, 0
    if two:
        return length, None, 2 if evidence(5, n0 - 8) else 0
    return length, None, 1 if one and evidence(5, n0 - 7) and evidence(6, n0 - 8) else 0


@pytest.mark.parametrize("kit", list(ADAPTERS))
@pytest.mark.parametrize("pair", [False, True])
def test_trimming_by_the_definition(spark, kit, pair):
    n = 3000
    rows = list(zip(range(n), texts(1, n), texts(2, n), quals(3, n), quals(4, n)))
    for k in range(0, n, 5):  # short fragments: mate 2 is the complement of mate 1
        no, a, _, p, _ = rows[k]
        rows[k] = (no, a, a and "".join(SWAP.get(c, c) for c in reversed(a)), p, p)
    for k in range(1, n, 25):  # and ends that look like the adapter's start, with and without evidence
        s = "TTTTTGG" + "T" * 20
        ends = ADAPTERS[kit].read1[: 1 + k % 2], ADAPTERS[kit].read2[: 1 + k % 2]
        a, b = (s + e for e in ends)
        m = len(a)
        if k % 4 < 2:
            other = list(b)
            for i, j in ((5, m - 7), (6, m - 8), (5, m - 8)):
                other[j] = SWAP[a[i]]
            first = list(a)
            for i, j in ((5, m - 7), (6, m - 8), (5, m - 8)):
                first[j] = SWAP[other[i]]
            a, b = "".join(first), "".join(other)
        rows[k] = (rows[k][0], a, b, "I" * m, "I" * m)
    df = spark.createDataFrame(rows, "read_no long, seq1 string, seq2 string, qual1 string, qual2 string")
    if not pair:
        df = df.selectExpr("read_no", "seq1 as seq", "qual1 as qual")
    out = preprocess.trim(df, kit)
    got = {r["read_no"]: (r["trimmed_length"], r["adapter_at"], r["tail"]) for r in out.select("read_no", "trimmed_length", "adapter_at", "tail").collect()}
    assert got == {no: plain(kit, [a, b][: 1 + pair], [p, q][: 1 + pair]) for no, a, b, p, q in rows}
    assert len({g[2] for g in got.values()}) == 2 + pair and sum(g[1] is not None for g in got.values()) > 3


def test_places_by_the_definition(spark):
    found = [*texts(5, 500), "", "CG", "CGCG", "GCGC", "C", "ÄCG𝄞CG", None, "CG" * 3000, "G", ""]
    df = spark.createDataFrame(list(enumerate(found)), "k int, t string").repartition(2)
    got = df.select("k", B.offsets("t", "CG").alias("a"), B.offsets("t", "C", 1).alias("b")).collect()
    assert len(got) == len(found)
    for r in got:
        t = found[r["k"]] or ""
        assert r["a"] == [i for i in range(len(t)) if t[i : i + 2] == "CG"] and r["b"] == [i + 1 for i in range(len(t)) if t[i] == "C"]


def test_runs_of_rows(spark, monkeypatch):
    """Runs of rows give what one run gives."""
    import pyarrow as pa

    data = pa.array([*texts(7, 300)]).slice(5, 250)
    for size in (1, 64, 1 << 20):
        monkeypatch.setattr(B, "RUN_BYTES", size)
        assert pa.concat_arrays([t for (t,) in B._runs(data)]).equals(data)
    assert [len(t) for (t,) in B._runs(data.slice(0, 0))] == [0]


@pytest.mark.parametrize("made", [lambda d: preprocess.trim(d), lambda d: preprocess.convert(d, 4), lambda d: preprocess.convert(d, 3)])
def test_no_walk_in_the_plan(spark, made):
    """Lambdas are interpreted for each element."""
    df = spark.range(3).select(F.col("id").alias("read_no"), *[F.lit(t).alias(c) for c, t in {"seq1": "ACGT", "qual1": "IIII", "seq2": "ACGT", "qual2": "IIII"}.items()])
    plan = made(df)._jdf.queryExecution().analyzed().toString()
    assert "lambda" not in plan
