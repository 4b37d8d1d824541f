"""Schemas of the data model; positions are 1-based except in BED-like tables (0-based, half-open)."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


_S, _L, _I, _F, _D = T.StringType(), T.LongType(), T.IntegerType(), T.FloatType(), T.DoubleType()

READ = _struct(read_no=_L, id=_S, seq=_S, qual=_S)
GENOME = _struct(chr=_S, seq=_S)
CHR_INFO = _struct(chr=_S, length=_L)
SAM = _struct(qname=_S, flag=_I, chr=_S, pos=_L, mapq=_I, cigar=_S, rnext=_S, pnext=_L, tlen=_L, seq=_S, qual=_S, tags=T.ArrayType(_S))
CALL = _struct(chr=_S, locus=_L, total=_L, wC=_L, wT=_L, wO=_L, context=_S, cC=_L, cT=_L, cO=_L)
BED = _struct(chr=_S, start=_L, end=_L, line=_S)
REFGENE = _struct(chr=_S, strand=_S, tx_start=_L, tx_end=_L, gene=_S)
TSS_BIN = _struct(chr=_S, start=_L, end=_L, gene=_S, distance=_I, strand=_S)
CHR_LOG = _struct(chr=_S, reads=_L, wC=_L, wT=_L, cC=_L, cT=_L)
CONF = _struct(key=_S, value=_S)
METRIC = _struct(key=_S, value=_L)
