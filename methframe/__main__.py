"""Command line: python -m methframe COMMAND --help."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import SparkSession

from .operators import charts, intervals, preprocess, profile, report, view
from .plans import index
from .plans.pipeline import Conf, Pipeline
from .sources import sequence, sinks, text


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="methframe")
    sub = p.add_subparsers(dest="command", required=True)

    c = sub.add_parser("index", help="reference tables of a genome")
    c.add_argument("fasta")
    c.add_argument("out")
    c.add_argument("--refgene")
    c.add_argument("--control")

    c = sub.add_parser("trim", help="trimmed and converted reads as FASTQ, with counters and composition")
    c.add_argument("reads1")
    c.add_argument("--reads2")
    c.add_argument("out")
    _settings(c)

    c = sub.add_parser("run", help="calls and report from merged alignments (Parquet: single reads or pairs with strand)")
    c.add_argument("alignments")
    c.add_argument("index")
    c.add_argument("out")
    _settings(c)

    c = sub.add_parser("view", help="picture of a region as text and HTML")
    c.add_argument("alignments", help="Parquet of name, chr, pos, cigar, seq, qual, strand")
    c.add_argument("index")
    c.add_argument("region")
    c.add_argument("out")
    c.add_argument("--protocol", default="BS")
    c.add_argument("--strand", choices=["W", "C"])
    c.add_argument("--exact", action="store_true")
    c.add_argument("--snp-sort", action="store_true")
    c.add_argument("--dense", type=int, default=0, choices=[0, 1, 2])

    c = sub.add_parser("regions", help="covered sites and bases of every interval")
    c.add_argument("chr_info")
    c.add_argument("calls")
    c.add_argument("bed")
    c.add_argument("out")

    c = sub.add_parser("bins", help="methylation by bins")
    c.add_argument("calls")
    c.add_argument("width", type=int)
    c.add_argument("out")
    c.add_argument("--mask", default="chr")
    c.add_argument("--protocol", default="BS")

    c = sub.add_parser("merge", help="one call table of several")
    c.add_argument("out")
    c.add_argument("calls", nargs="+")

    c = sub.add_parser("wig", help="coverage of intervals")
    c.add_argument("chr_info")
    c.add_argument("bed")
    c.add_argument("width", type=int)
    c.add_argument("out")
    c.add_argument("--track")
    c.add_argument("--raw", action="store_true", help="no normalisation")
    return p


def _settings(c: argparse.ArgumentParser) -> None:
    d = Conf()
    for name in ("mode", "cycle", "min_qual", "phred", "min_size", "min_ins", "max_ins", "min_align"):
        c.add_argument(f"--{name.replace('_', '-')}", type=int, default=getattr(d, name))
    c.add_argument("--protocol", default=d.protocol)
    c.add_argument("--kit", default=d.kit)
    for name in ("call_cph", "align_only"):
        c.add_argument(f"--{name.replace('_', '-')}", action="store_true")


def main(argv: list[str] | None = None) -> None:
    a = _parser().parse_args(argv)
    spark = SparkSession.builder.appName("methframe").getOrCreate()
    if a.command == "index":
        index.build(spark, a.fasta, a.out, a.refgene, a.control)
    elif a.command in ("trim", "run"):
        conf = Conf(**{k: v for k, v in vars(a).items() if k in Conf.__dataclass_fields__})
        run = Pipeline(spark, conf, f"{a.out}/work")
        if a.command == "trim":
            reads = sequence.fastq_pairs(spark, a.reads1, a.reads2) if a.reads2 else sequence.fastq(spark, a.reads1)
            got = run.preprocess(reads)
            packed = preprocess.packed_ids(got["converted"], run.conf.mode)
            for k in "12" if a.reads2 else "1":
                tag = k if a.reads2 else ""
                sinks.lines(sinks.fastq_lines(packed, f"name{k}", f"seq{tag}", f"qual{tag}"), f"{a.out}/R{k}.fq")
            sinks.lines(sinks.trim_log_lines(got["counters"]), f"{a.out}/trim.log", single=True)
            sinks.lines(sinks.tsv_lines(got["composition"], order=["mate", "cycle"]), f"{a.out}/composition", single=True)
            for row in charts.of(got).toLocalIterator():
                Path(f"{a.out}/{row['chart']}.svg").write_text(row["svg"])
        else:
            genes = Path(f"{a.index}/tss_bins").exists()
            out = run.run(spark.read.parquet(a.alignments), index.load(spark, a.index))
            if genes and "calls" in out:
                out["tss_profile"] = profile.tss_profile(out["calls"], index.load(spark, a.index, "tss_bins"), run.conf.protocol)
            for name, df in out.items():
                if name not in ("unique", "calls", "cph"):  # those are Parquet tables in work already
                    sinks.lines(sinks.tsv_lines(df), f"{a.out}/{name}", single=True)
            if "calls" in out:
                sinks.lines(sinks.call_lines(out["calls"]), f"{a.out}/calls")
                drawn = run.save(charts.of(out, run.conf.protocol), "charts")
                for row in drawn.toLocalIterator():  # a row a chart
                    Path(f"{a.out}/{row['chart']}.svg").write_text(row["svg"])
                rows = out["totals"].selectExpr("strand as n", "strand as item", "string(c + t) as value", "string(level) as share")
                Path(f"{a.out}/report.html").write_text(report.page(rows, run.settings(), charts=drawn).first()["page"])
    elif a.command == "view":
        if warning := view.region_warning(a.region):
            print(warning)
        lines, page = view.Viewer(spark.read.parquet(a.alignments), index.load(spark, a.index), a.protocol).render(a.region, a.strand, a.exact, a.snp_sort, a.dense)
        Path(f"{a.out}.txt").write_text(lines)
        Path(f"{a.out}.html").write_text(page)
    elif a.command == "regions":
        sinks.lines(sinks.annotated_bed_lines(profile.region_stats(text.calls(spark, a.calls), text.bed(spark, a.bed), text.chr_info(spark, a.chr_info))), a.out)
    elif a.command == "bins":
        sinks.lines(sinks.tsv_lines(profile.binned(text.calls(spark, a.calls), a.width, a.mask, a.protocol), order=["chr", "bin"]), a.out, single=True)
    elif a.command == "merge":
        merged = profile.merge_calls(*[text.calls(spark, c) for c in a.calls])
        sinks.lines(sinks.call_lines(merged), a.out)
    elif a.command == "wig":
        info = text.chr_info(spark, a.chr_info)
        values = intervals.coverage(text.bed(spark, a.bed).select("chr", "start", "end"), info, a.width, not a.raw)
        sinks.lines(sinks.wig_lines(values, a.width, info, a.track), a.out, single=True)


if __name__ == "__main__":
    main()
