"""Files in small ranges: as many tasks for large files as for others, the same records."""

from methframe import queries
from methframe.sources import files, sequence


def test_ranges_grow_where_they_would_be_many(tmp_path):
    text = b"".join(b"@r%d\nACGT\n+\nIIII\n" % k for k in range(20_000))
    for name in ("a.fq", "b.fq"):
        (tmp_path / name).write_bytes(text)
    reader = sequence.FastqReader({"path": f"{tmp_path}/*.fq", "splitBytes": "64"})
    parts = reader.partitions()
    assert len(parts) <= sequence.RANGES + 2 and max(p.end - p.start for p in parts) <= files.SPLIT
    assert [(p.file, p.split) for p in parts] == sorted({(p.file, p.split) for p in parts})
    ids = [r[0] for p in parts for r in sequence._records(p)]
    assert ids == [b"@r%d" % k for k in range(20_000)] * 2


def test_mates_are_written_by_as_many_tasks_as_the_session_has(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(queries, "_written", lambda x, lines, **options: seen.append(lines.rdd.getNumPartitions()) or "p")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        rows = spark.range(100).selectExpr("id as read_no", "'@r' as id1", "'A' as seq1", "'I' as qual1")
        queries._in_files(type("X", (), {"spark": spark}), rows, "1")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen == [7]
