"""Phylogenomic analytics on Spark: operators over tables of sequences, hits and alignments."""
