"""A whole run as one object: settings, their checks, and the DataFrames from reads to report."""

from __future__ import annotations

import warnings
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from ..operators import calls as CALLS
from ..operators import dedup as DEDUP
from ..operators import genome as GENOME
from ..operators import merge as MERGE
from ..operators import ordering as ORDERING
from ..operators import preprocess as PRE
from ..operators import profile as PROFILE
from ..operators import report as REPORT
from ..sources import sinks
from ..sources.text import strand_of


@dataclass(frozen=True)
class Conf:
    """Settings of a run; checked() normalises them."""

    mode: int = 3  # converted letters: 3 all C, 4 those of CpG
    protocol: str = "BS"
    kit: str = "illumina"
    cycle: int = 0  # 0: detected, from raw reads the usual length, from aligned ones the largest
    min_qual: int = 20
    phred: int = 33
    min_size: int = 20
    min_ins: int = 0
    max_ins: int = 1000
    min_align: int = 0
    call_cph: bool = False
    exclude_crick_cpg: bool = False
    align_only: bool = False

    def checked(self) -> Conf:
        protocol, kit = self.protocol.upper(), self.kit.lower()
        if protocol not in ("BS", "TAPS"):
            raise ValueError(f"unknown protocol {self.protocol!r}")
        if self.mode not in (3, 4):
            raise ValueError("mode is 3 or 4")
        if kit not in PRE.R.ADAPTERS:
            raise ValueError(f"unknown kit {self.kit!r}")
        if self.phred not in (33, 64):
            raise ValueError("phred is 33 or 64")
        if self.max_ins == 0 or self.min_ins > self.max_ins:
            raise ValueError("the insert range is empty")
        mode = self.mode
        if protocol == "BS" and mode == 4:
            warnings.warn("bisulfite data are analysed in mode 3", stacklevel=2)
            mode = 3
        return replace(self, protocol=protocol, kit=kit, mode=mode)

    @property
    def threshold(self) -> int:
        """The quality threshold as a character code."""
        return self.min_qual + self.phred


class Pipeline:
    """Steps of a run.  Only merged and called tables have several consumers; save() writes them once and reads them again."""

    def __init__(self, spark: SparkSession, conf: Conf, work_dir: str | None = None):
        self.spark, self.conf, self.work_dir = spark, conf.checked(), work_dir

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """df as a Parquet table in the working folder (on shared storage), or df itself without one."""
        if self.work_dir is None:
            return df
        path = f"{self.work_dir}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def preprocess(self, reads: DataFrame) -> dict[str, DataFrame]:
        """reads or pairs -> cropped, composition, trimmed, counters, converted."""
        c = self.conf
        cycle = c.cycle
        if not cycle:
            seq = "seq1" if "seq1" in reads.columns else "seq"
            cycle = PRE.detect_cycle(reads.selectExpr("read_no", f"{seq} as seq")).first()["cycle"] or 0
        cropped = PRE.crop(PRE.equal_mates(reads) if "seq2" in reads.columns else reads, cycle)
        trimmed = PRE.trim(cropped, c.kit, c.threshold, c.min_size)
        return {"composition": PRE.composition(cropped), "trimmed": trimmed, "counters": PRE.trim_counters(trimmed), "converted": PRE.convert(PRE.kept(trimmed), c.mode)}

    def align(self, watson: DataFrame, crick: DataFrame) -> DataFrame:
        """The winners of both hypotheses (alignments come from an external aligner)."""
        return self.save(MERGE.merge_hypotheses(watson, crick), "merged")

    def from_sam(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(aligned, orphans) of paired SAM rows in any order, from text or binary files with strand tags: pairs linked by name and numbered in its order, for run()."""
        pairs, orphans = MERGE.link_mates(rows, strand_of())
        return ORDERING.numbered(pairs, "name", name="read_no"), orphans

    def run(self, aligned: DataFrame, genome: DataFrame, refgene: DataFrame | None = None, cycle: int | None = None) -> dict[str, DataFrame]:
        """From merged alignments (single or pairs, with strand) to every table of the report."""
        c, info = self.conf, GENOME.chr_info(genome)
        pairs = "pos2" in aligned.columns
        unique = self.save((DEDUP.dedup_pairs if pairs else DEDUP.dedup_single)(aligned, info), "unique")
        out = {"unique": unique, "dedup_log": DEDUP.dedup_log(aligned, info, unique), "strands": MERGE.strand_counts(aligned)}
        if pairs:
            out["sizes"] = DEDUP.size_distribution(unique, c.max_ins)
        if c.align_only:
            return out
        observed = self.save(CALLS.observations(CALLS.shown(unique, genome, c.min_align), genome), "observed")  # read by the calls and each M-bias table
        called = self.save(CALLS.calls(observed), "calls")
        log = CALLS.chr_log(unique, called, genome, c.min_align)
        out |= {"calls": called, "chr_log": log, "bedgraph": CALLS.bedgraph(called, c.protocol)}
        # Without a given cycle that of the longest read, or bases beyond it would be left out.
        n = cycle or c.cycle or CALLS.longest(aligned) or 100  # 100: no reads
        for mate in (1, 2) if pairs else (1,):
            out[f"mbias_{mate}"] = CALLS.mbias(observed, n, mate)
        if c.call_cph:
            cph = self.save(CALLS.call(unique, genome, c.min_align, "CpH", exclude_crick_cpg=c.exclude_crick_cpg), "cph")
            out |= {"cph": cph, "cph_log": CALLS.chr_log(unique, cph, genome, c.min_align)}
        if refgene is not None:
            out["tss_profile"] = PROFILE.tss_profile(called, GENOME.tss_bins(refgene), c.protocol)
        out["totals"] = REPORT.methylation_totals(log, c.protocol)
        out["conversion"] = REPORT.control_conversion(log)
        return out

    def settings(self) -> DataFrame:
        return sinks.conf_table(self.spark, asdict(self.conf))
