"""Read-name and CIGAR expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from circlet.functions.coords import _c


def read_key(name) -> Column:
    """Fragment name: a trailing /1 is removed, then a trailing /2."""
    return F.regexp_replace(F.regexp_replace(_c(name), "/1$", ""), "/2$", "")


def first_word(text) -> Column:
    """Up to the first white space, which may not stand at the front."""
    return F.regexp_extract(F.trim(_c(text)), r"^(\S*)", 1)


def name_key(header) -> Column:
    """Fragment name of a whole read header: its first word without the mate."""
    return read_key(first_word(header))


def has_flag(flag, bit: int) -> Column:
    return _c(flag).bitwiseAND(F.lit(bit)) != 0


def mate_number(flag) -> Column:
    return F.when(has_flag(flag, 128), "2").when(has_flag(flag, 64), "1").otherwise("")


def chain_key(name, flag) -> Column:
    """One physical read: mates of a fragment never share a chain."""
    name = _c(name)
    return (
        F.when(has_flag(flag, 64), F.concat(read_key(name), F.lit("/1")))
        .when(has_flag(flag, 128), F.concat(read_key(name), F.lit("/2")))
        .otherwise(name)
    )


def cigar_lengths(cigar, ops: str) -> Column:
    """Sum of the operation lengths whose letter is one of ``ops``."""
    found = F.regexp_extract_all(F.coalesce(_c(cigar), F.lit("")), F.lit(f"([0-9]+)[{ops}]"), F.lit(1))
    return F.aggregate(found, F.lit(0), lambda acc, n: acc + n.cast("int"))


def leading_clip(cigar) -> Column:
    """Length of the clip run at the front of the CIGAR."""
    head = F.regexp_extract(F.coalesce(_c(cigar), F.lit("")), "^((?:[0-9]+[SH])*)", 1)
    return cigar_lengths(head, "SH")


def cigar_metrics(cigar) -> dict[str, Column]:
    """Q01: query length, query start/end, aligned query and reference lengths."""
    start, aligned = leading_clip(cigar), cigar_lengths(cigar, "MI=X")
    return {
        "query_length": cigar_lengths(cigar, "MISH=X"),
        "query_start": start,
        "query_end": start + aligned,
        "aligned_query_length": aligned,
        "aligned_reference_length": cigar_lengths(cigar, "MDN=X"),
    }


def aligned_blocks(start, cigar) -> Column:
    """Gapless aligned blocks (closed, 1-based) of an alignment that starts at ``start``."""
    cigar = F.coalesce(_c(cigar), F.lit(""))
    lengths = F.regexp_extract_all(cigar, F.lit("([0-9]+)([MIDNSHP=X])"), F.lit(1))
    letters = F.regexp_extract_all(cigar, F.lit("([0-9]+)([MIDNSHP=X])"), F.lit(2))
    ops = F.zip_with(lengths, letters, lambda n, op: F.struct(n.cast("int").alias("n"), op.alias("op")))
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc, item):
        matched = item["op"].isin("M", "=", "X")
        consumes = matched | item["op"].isin("D", "N")
        block = F.struct(acc["pos"].alias("start"), (acc["pos"] + item["n"] - 1).alias("end"))
        return F.struct(
            F.when(consumes, acc["pos"] + item["n"]).otherwise(acc["pos"]).alias("pos"),
            F.when(matched, F.concat(acc["blocks"], F.array(block))).otherwise(acc["blocks"]).alias("blocks"),
        )

    init = F.struct(_c(start).cast("int").alias("pos"), empty.alias("blocks"))
    return F.aggregate(ops, init, step, lambda acc: acc["blocks"])


def query_pair_metrics(start1, end1, start2, end2, read_length) -> dict[str, Column]:
    """Q02: how two aligned query spans of one read relate."""
    start1, end1, start2, end2 = _c(start1), _c(end1), _c(start2), _c(end2)
    swap = (start2 < start1) | ((start2 == start1) & (end2 < end1))
    s1, e1 = F.when(swap, start2).otherwise(start1), F.when(swap, end2).otherwise(end1)
    s2, e2 = F.when(swap, start1).otherwise(start2), F.when(swap, end1).otherwise(end2)
    length = F.greatest(_c(read_length), F.lit(1))
    overlap = F.greatest(F.lit(0), e1 - s2)
    gap = F.greatest(F.lit(0), s2 - e1)
    total = (e1 - s1) + (e2 - s2)
    return {
        "query_first_start": s1,
        "query_first_end": e1,
        "query_second_start": s2,
        "query_second_end": e2,
        "query_overlap_bp": overlap,
        "query_gap_bp": gap,
        "query_union_coverage": F.least(F.lit(1.0), F.greatest(F.lit(0.0), (total - overlap) / length)),
        "query_union_aligned_length": total - overlap,
        "total_aligned_query_length": total,
        "read_length": length,
        "query_segments_adjacent": gap == 0,
        "query_junction_boundary_distance_from_read_end_min": F.least(e1, length - e1, s2, length - s2),
    }


def forward_sequence(seq, reverse) -> Column:
    """Sequence in the orientation it was read."""
    seq = _c(seq)
    return F.when(_c(reverse), F.reverse(F.translate(seq, "ACGTNacgtn", "TGCANtgcan"))).otherwise(seq)


def forward_quality(qual, seq, reverse) -> Column:
    """Quality in read orientation; missing quality becomes I for every base."""
    filled = F.coalesce(_c(qual), F.repeat(F.lit("I"), F.length(_c(seq))))
    return F.when(_c(reverse), F.reverse(filled)).otherwise(filled)
