"""Scalar functions over nucleotide and amino-acid strings, as column expressions."""

from __future__ import annotations

from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# What each ambiguity letter of nucleotides and amino acids stands for.
NT_LETTERS = {
    "A": "A", "C": "C", "G": "G", "T": "T", "M": "AC", "R": "AG", "W": "AT", "S": "CG", "Y": "CT", "K": "GT",
    "V": "ACG", "H": "ACT", "D": "AGT", "B": "CGT", "N": "ACGT", "-": "-",
}
AA_LETTERS = {c: c for c in "ACDEFGHIKLMNOPQRSTUVWY*-"} | {"B": "DN", "J": "IL", "Z": "EQ", "X": "ACDEFGHIKLMNOPQRSTUVWY"}
# Genetic codes by NCBI number, residues and start/stop marks over codons in TCAG order.
GENETIC_CODES = {
    1: ("FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG", "---M------**--*----M---------------M----------------------------"),
    2: ("FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSS**VVVVAAAADDEEGGGG", "----------**--------------------MMMM----------**---M------------"),
    3: ("FFLLSSSSYY**CCWWTTTTPPPPHHQQRRRRIIMMTTTTNNKKSSRRVVVVAAAADDEEGGGG", "----------**----------------------MM---------------M------------"),
    4: ("FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG", "--MM------**-------M------------MMMM---------------M------------"),
    5: ("FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSSSSVVVVAAAADDEEGGGG", "---M------**--------------------MMMM---------------M------------"),
    6: ("FFLLSSSSYYQQCC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG", "--------------*--------------------M----------------------------"),
    9: ("FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIIMTTTTNNNKSSSSVVVVAAAADDEEGGGG", "----------**-----------------------M---------------M------------"),
    10: ("FFLLSSSSYY**CCCWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG", "----------**-----------------------M----------------------------"),
    11: ("FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG", "---M------**--*----M------------MMMM---------------M------------"),
    12: ("FFLLSSSSYY**CC*WLLLSPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG", "----------**--*----M---------------M----------------------------"),
    13: ("FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSSGGVVVVAAAADDEEGGGG", "---M------**----------------------MM---------------M------------"),
    14: ("FFLLSSSSYYY*CCWWLLLLPPPPHHQQRRRRIIIMTTTTNNNKSSSSVVVVAAAADDEEGGGG", "-----------*-----------------------M----------------------------"),
    15: ("FFLLSSSSYY*QCC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG", "----------*---*--------------------M----------------------------"),
    16: ("FFLLSSSSYY*LCC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG", "----------*---*--------------------M----------------------------"),
    21: ("FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNNKSSSSVVVVAAAADDEEGGGG", "----------**-----------------------M---------------M------------"),
    22: ("FFLLSS*SYY*LCC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG", "------*---*---*--------------------M----------------------------"),
    23: ("FF*LSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG", "--*-------**--*-----------------M--M---------------M------------"),
    24: ("FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSSKVVVVAAAADDEEGGGG", "---M------**-------M---------------M---------------M------------"),
    25: ("FFLLSSSSYY**CCGWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG", "---M------**-----------------------M---------------M------------"),
    26: ("FFLLSSSSYY**CC*WLLLAPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG", "----------**--*----M---------------M----------------------------"),
    27: ("FFLLSSSSYYQQCCWWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG", "--------------*--------------------M----------------------------"),
    28: ("FFLLSSSSYYQQCCWWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG", "----------**--*--------------------M----------------------------"),
    29: ("FFLLSSSSYYYYCC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG", "--------------*--------------------M----------------------------"),
    30: ("FFLLSSSSYYEECC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG", "--------------*--------------------M----------------------------"),
    31: ("FFLLSSSSYYEECCWWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG", "----------**-----------------------M----------------------------"),
    32: ("FFLLSSSSYY*WCC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG", "---M------*---*----M------------MMMM---------------M------------"),
    33: ("FFLLSSSSYYY*CCWWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSSKVVVVAAAADDEEGGGG", "---M-------*-------M---------------M---------------M------------"),
}
# Pairs of residues that an ambiguous codon may stand for, and what is written for them.
AMBIGUOUS_RESIDUES = {"DN": "N", "EQ": "Q", "IL": "L"}


def letters(kind: str) -> dict[str, str]:
    return NT_LETTERS if kind == "NT" else AA_LETTERS


def pair_identity(kind: str) -> dict[str, float]:
    """Share of equal residues over the pairs that two letters stand for, by the two letters in order."""
    sets = letters(kind)
    found = {a + b: len(set(sets[a]) & set(sets[b])) / (len(sets[a]) * len(sets[b])) for a in sorted(sets) for b in sorted(sets) if a <= b}
    return found | {"--": 0.0}


#: Letters, and those that stand for them on the other strand.
BASES, COMPLEMENTS = "ATGCatgcRYSWryswKMBVkmbvDHNdhn", "TACGtacgYRSWyrswMKVBmkvbHDNhdn"


def reverse_complement(s: Column) -> Column:
    """Reverse complement with ambiguity letters; case is kept, unknown signs stay."""
    return F.translate(F.reverse(s), BASES, COMPLEMENTS)


def count_of(s: Column, pattern: str) -> Column:
    """How many characters of ``s`` are in a character class."""
    return F.length(F.regexp_replace(s, f"[^{pattern}]", ""))


def gc_weight(s: Column) -> Column:
    """Summed G or C share of every letter of an upper-case string."""
    return count_of(s, "GCS") + count_of(s, "RYKMN") / 2.0 + count_of(s, "VB") * 2.0 / 3.0 + count_of(s, "HD") / 3.0


def gc_percent(s: Column) -> Column:
    """Fractional GC percentage over nucleotide letters, gaps left out; null if there are none."""
    u = F.upper(s)
    return F.try_divide(100.0 * gc_weight(u), count_of(u, "ACGTMRWSYKVHDBN"))


def gc_percent_strict(s: Column) -> Column:
    """GC percentage over A, C, G and T alone."""
    u = F.upper(s)
    return F.try_divide(100.0 * count_of(u, "GC"), count_of(u, "ACGT"))


def codon_position(s: Column, position: int) -> Column:
    """The letters at one codon position (1 to 3) of an ungapped sequence."""
    return F.regexp_replace(F.substring(s, position, 1 << 30), "(.).{0,2}", "$1")


def melting_temperature(gc: Column, length: Column, chemistry: str = "RNA-DNA", sodium: float = 0.9, formamide: float = 0.0) -> Column:
    """Melting temperature of an oligonucleotide from its GC percentage and length."""
    g = gc / 100.0
    if chemistry == "DNA-DNA":
        return 81.5 + 41.0 * g - 500.0 / length + F.lit(16.6) * F.log(F.lit(sodium)) - 0.62 * formamide
    factor = {"RNA-DNA": 0.5, "RNA-RNA": 0.35}[chemistry]
    return 79.8 + 58.4 * g + 11.8 * g * g - 820.0 / length + F.lit(18.5) * F.log(F.lit(sodium)) - factor * formamide


def longest_homopolymer(s: Column) -> Column:
    """Longest run of one letter; the run that ends the sequence doesn't count, and 1 is the least."""
    runs = F.regexp_extract_all(F.upper(s), F.lit("((.)\\2*)"), F.lit(1))
    inner = F.slice(runs, F.lit(1), F.greatest(F.size(runs) - 1, F.lit(0)))
    return F.greatest(F.lit(1), F.coalesce(F.array_max(F.transform(inner, F.length)), F.lit(1)))


def low_complexity_percent(s: Column) -> Column:
    """Share of masked (lower-case) letters."""
    return F.try_divide(100.0 * count_of(s, "a-z"), F.length(s))


def codon_table(code: int = 1, first: bool = False, last: bool = False) -> str:
    """``ATGM`` entries, each codon of unambiguous meaning with its residue, ambiguity letters included."""
    residues, marks = GENETIC_CODES[code]
    plain = {"".join(c): (r, m) for c, r, m in zip(product("TCAG", repeat=3), residues, marks, strict=True)}
    out = []
    sets = {k: v for k, v in NT_LETTERS.items() if k != "-"}
    for codon in map("".join, product(sorted(sets), repeat=3)):
        if codon.count("N") > 1:
            continue
        got = set()
        for c in map("".join, product(*(sets[b] for b in codon))):
            residue, mark = plain[c]
            got.add("M" if first and mark == "M" else "*" if last and mark == "*" else residue)
        aa = got.pop() if len(got) == 1 else AMBIGUOUS_RESIDUES.get("".join(sorted(got)))
        if aa:
            out.append(f"{codon}{aa}")
    return " ".join(out)


_CODON_LETTERS = "ACGTMRWSYKVHDBN"


@lru_cache(maxsize=None)
def _codon_lookup(code: int, first: bool, last: bool) -> np.ndarray:
    """Residue of each codon by its three letters' numbers in base 16; X where there is none."""
    out = np.full(4096, ord("X"), np.uint8)
    for entry in codon_table(code, first, last).split(" "):
        a, b, c = (_CODON_LETTERS.index(x) for x in entry[:3])
        out[a << 8 | b << 4 | c] = ord(entry[3])
    return out


def _letter_numbers(complement: bool) -> np.ndarray:
    """Numbers of letters or of their complements by byte, 15 for unknown ones, 16 for what is left out."""
    out = np.full(256, 15, np.uint8)
    other = str.maketrans("ACGTMRWSYKVHDBN", "TGCAKYWSRMBDHVN")
    for x in _CODON_LETTERS:
        y = x.translate(other) if complement else x
        out[ord(x)] = out[ord(x.lower())] = _CODON_LETTERS.index(y)
    out[[ord("-"), ord(" ")]] = 16
    return out


def translated(sequences: pa.Array, code: int, frame: int, start_as_m: bool) -> pa.Array:
    """``translate`` of a batch: the codons of all rows at once, by one look-up."""
    data = [(x or "").encode("ascii", "replace") for x in sequences.to_pylist()]
    number = _letter_numbers(frame < 0)[np.frombuffer(b"".join(data), np.uint8)]
    kept = np.append(0, np.cumsum(number < 16))
    edge = kept[np.cumsum([0, *map(len, data)])]
    number = number[number < 16].astype(np.int64)
    skip = abs(frame) - 1
    many = np.maximum(np.diff(edge) - skip, 0) // 3
    ends = np.cumsum(many)
    nth = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - many, many)
    at = np.repeat(edge[:-1] + skip, many) + 3 * nth if frame > 0 else np.repeat(edge[1:] - 1 - skip, many) - 3 * nth
    step = 1 if frame > 0 else -1
    codon = (number[at] << 8 | number[at + step] << 4 | number[at + 2 * step]) if len(at) else np.zeros(0, np.int64)
    residues = _codon_lookup(code, False, False)[codon]
    full = many > 0
    final, begin = ends[full] - 1, (ends - many)[full]
    residues[final] = _codon_lookup(code, False, True)[codon[final]]
    residues[begin] = _codon_lookup(code, start_as_m, False)[codon[begin]]
    text = pa.StringArray.from_buffers(len(data), pa.py_buffer(np.append(0, ends).astype(np.int32).tobytes()), pa.py_buffer(residues.tobytes()))
    return pc.if_else(sequences.is_valid(), text, pa.scalar(None, pa.string())) if sequences.null_count else text


def translate(s: Column, code: int = 1, frame: int = 1, start_as_m: bool = False) -> Column:
    """Residues of a nucleotide sequence in a frame (1 to 3, or -1 to -3 on the other strand).

    Ambiguous codons that all mean one residue, or one of the pairs D/N, E/Q and I/L, are resolved; other
    ones and unknown letters give X. The first codon may count as a start, the last as a stop. Gaps and spaces are left out.
    Runs in Arrow batches, as a look-up of all codons of a batch; null stays null.
    """

    @F.arrow_udf(returnType="string")
    def batch(sequences: pa.Array) -> pa.Array:
        return translated(sequences, code, frame, start_as_m)

    return batch(s)


def best_frame(s: Column, code: int = 1) -> Column:
    """(stops, unknown, place, frame, aa) of the frame with the fewest inner stops, then fewest X, then in order."""
    tried = []
    for place, frame in enumerate((1, 2, 3, -1, -2, -3)):
        aa = translate(s, code, frame)
        tried.append(F.struct(count_of(F.regexp_replace(aa, "\\*$", ""), "*").alias("stops"), count_of(aa, "X").alias("unknown"), F.lit(place).alias("place"), F.lit(frame).alias("frame"), aa.alias("aa")))
    return F.array_min(F.array(*tried))


def mask_premature_stops(aa: Column) -> Column:
    """Gaps removed and every stop but a final one written as X."""
    return F.regexp_replace(F.regexp_replace(aa, "-", ""), "\\*(?=.)", "X")


def mark_terminal_gaps(s: Column, sign: str = "#") -> Column:
    """Leading and trailing gaps written as another sign."""
    lead, tail = F.length(F.regexp_extract(s, "^(-*)", 1)), F.length(F.regexp_extract(s, "(-*)$", 1))
    inner = F.substring(s, lead + 1, F.length(s) - lead - tail)
    return F.when(lead == F.length(s), F.repeat(F.lit(sign), F.length(s))).otherwise(F.concat(F.repeat(F.lit(sign), lead), inner, F.repeat(F.lit(sign), tail)))


def resolve_ambiguities(s: Column, name: Column, seed: int = 0) -> Column:
    """Each ambiguity letter replaced by one of its bases, drawn by a hash of name, place and seed; case is kept."""
    known = "".join(f"{k}{v}{'.' * (4 - len(v))}" for k, v in NT_LETTERS.items() if len(v) > 1)

    def one(c: Column, i: Column) -> Column:
        at = F.instr(F.lit(known), F.upper(c))
        options = F.rtrim(F.translate(F.substring(F.lit(known), at + 1, F.lit(4)), ".", " "))
        drawn = F.substring(options, F.pmod(F.xxhash64(name, i, F.lit(seed)), F.length(options)).cast("int") + 1, F.lit(1))
        ambiguous = F.upper(c).rlike("^[MRWSYKVHDBN]$")
        return F.when(~ambiguous, c).when(c == F.lower(c), F.lower(drawn)).otherwise(drawn)

    return F.array_join(F.transform(F.split(s, ""), one), "")


def sequence_kind(s: Column) -> Column:
    """NT if all letters are nucleotide letters, AA if all are amino-acid letters, else invalid."""
    u = F.translate(F.upper(s), "U", "T")
    return F.when(u.rlike("^[ACGTMRWSYKVHDBN?-]*$"), "NT").when(F.upper(s).rlike("^[A-Z*?-]*$"), "AA").otherwise("invalid")


def wrap(s: Column, width: int) -> Column:
    """Line breaks after every ``width`` letters."""
    return F.regexp_replace(s, f"(.{{{width}}})(?=.)", "$1\n") if width else s
