"""Headers by the first record of a file, and the kind of a file."""

from phylospark.operators import assembly
from phylospark.sources import readers


def test_the_first_record_decides(spark, tmp_path):
    texts = {
        "a.fa": ">k141_7 flag=1 multi=2.5000 len=4\nACGU\n>k99_8 flag=0 multi=3.0 len=2\nAC\n",
        "b.fa": ">Contig_5_7.08\nACGT\n>Contig_6_1.5_Circ\nACG\n",
        "c.fa": ">NODE_1_length_4_cov_2.0 x y\nACGT\n>k141_7 flag=1 multi=2.5 len=4\nAC\n",
        "d.fa": ">some contig\nACGT\n>Contig_6_1.5_Circ\nACG\n",
        "e.fa": ">p1\nMKLV*\n>p2\nACG\n",
    }
    for n, t in texts.items():
        (tmp_path / n).write_text(t)
    records = readers.read_fasta(spark, str(tmp_path), with_order=True)
    got = {(x["src_file"][-4:], x["name"], x["description"], x["assembler"], x["sequence"]) for x in readers.import_assemblies(records).collect()}
    assert got == {
        ("a.fa", "NODE_7_length_4_cov_2.5000_k_141_flag_1", "", "flag", "ACGT"), ("a.fa", "NODE_8_length_2_cov_3.0_k_99_flag_0", "", "flag", "AC"),
        ("b.fa", "NODE_5_length_4_cov_7.08", "", "contig", "ACGT"), ("b.fa", "NODE_6_length_3_cov_1.5_circular", "", "contig", "ACG"),
        ("c.fa", "NODE_1_length_4_cov_2.0", "x y", "node", "ACGT"), ("c.fa", "k141_7", "flag=1 multi=2.5 len=4", "node", "AC"),
        ("d.fa", "some", "contig", "unknown", "ACGT"), ("d.fa", "Contig_6_1.5_Circ", "", "unknown", "ACG"),
    }
    assert {x["src_file"][-4:]: x["kind"] for x in assembly.file_kind(records).collect()} == {"a.fa": "NT", "b.fa": "NT", "c.fa": "NT", "d.fa": "NT", "e.fa": "AA"}
