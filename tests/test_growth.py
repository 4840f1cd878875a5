"""Queries on small tables of the kind that large ones hold: high ids, repeats, frequent windows."""

import random

import duckdb
import pytest

from phylospark.operators import similarity
from phylospark.plans import catalog, registry  # noqa: F401
from phylospark.sources import readers

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark, folder, **rows):
    """Small tables of the given rows, and a connection that has them as views."""
    con = duckdb.connect()
    for name, (found, schema) in rows.items():
        path = f"{folder}/{name}.parquet"
        spark.createDataFrame(found, schema).coalesce(1).write.parquet(path)
        con.execute(f"create view {name} as select * from read_parquet('{path}/*.parquet')")
    return str(folder), con


def same(spark, folder, con, name):
    """Rows of a query, which must be its SQL's."""
    got = registry.QUERIES[name](spark, folder).toPandas()
    want = con.execute(registry.SQL[name]).df()[list(got.columns)]
    rows = lambda f: sorted(map(tuple, f.astype(str).itertuples(index=False)))
    assert rows(got) == rows(want)
    return got


@pytest.mark.parametrize("doc", [0, 3400, 34001, 3400001])
def test_ranks_of_any_number_of_digits(spark, tmp_path, doc):
    folder, con = tables(spark, tmp_path, documents=([(doc, "some text", "en", "src0", 9)], DOCUMENTS))
    assert same(spark, folder, con, "p02_split_names")["rank"].tolist() == [doc // 340]


def test_filters_on_cut_reads_leave_each_search_once_and_on_reads(spark, tmp_path):
    rows = [(i, "acgtacgt " * 400, "en", "src0", 5) for i in range(3)]
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, "SOMEWHERE")], "r_regionkey long, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    plan = registry.QUERIES["q07_two_rounds"](spark, str(tmp_path))._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("ArrowEvalPython") == 4  # two searches a round
    below = plan.rsplit("ArrowEvalPython", 1)[1]
    assert below.index("substring") < below.index("explode(sequence")  # reads are cut before they are searched


def _baits_of_repeats(spark):
    repeat = "ACGGT" * 60
    baits = [("a", i, repeat[i : i + 20]) for i in range(50)] + [("b", 0, "T" * 20), ("b", 1, "ACCGTACCGTACCGTACCGT"), ("c", 0, "ACG")]
    return spark.createDataFrame(baits, "name string, bait_no int, bait string"), spark.createDataFrame([(str(i), repeat.lower()) for i in range(50)], "exon string, sequence string")


def test_exonic_baits_of_frequent_kmers_make_no_pairs(spark):
    baits, exons = _baits_of_repeats(spark)
    found = similarity.exonic(baits, exons, k=8)
    got = {(r["name"], r["bait_no"]) for r in found.collect()}
    assert got == {("a", i) for i in range(50)} | {("b", 1)}
    plan = found._jdf.queryExecution().executedPlan()
    assert "Inner" not in plan.toString()  # baits meet distinct ends by a semi-join alone


def test_exonic_baits_against_all_places(spark):
    draw = random.Random(3)
    exon = "".join(draw.choice("ACGT") for _ in range(1500))
    turned = str.maketrans("ACGT", "TGCA")
    baits = []
    for i in range(200):
        n = draw.choice([12, 20, 33])
        at = draw.randrange(len(exon) - n)
        b = list(exon[at : at + n])
        if draw.random() < 0.5:
            b[draw.randrange(n)] = "A"
        text = "".join(b)
        baits.append((str(i), 1, text if i % 2 else text[::-1].translate(turned)))

    def maps(b):
        n = len(b)
        return any(exon[i : i + 8] == x[:8] and exon[i + n - 8 : i + n] == x[-8:] for x in (b, b[::-1].translate(turned)) for i in range(len(exon) - n + 1))

    frame = spark.createDataFrame(baits, "name string, bait_no int, bait string")
    got = {r["name"] for r in similarity.exonic(frame, spark.createDataFrame([("e", exon)], "exon string, sequence string"), k=8).collect()}
    assert got == {name for name, _, b in baits if maps(b)}


def test_records_of_one_file_are_not_one_task(spark):
    rows = spark.createDataFrame([("p-x", "MKVL", "aa"), ("q-x", "ACGT", "aa"), ("r-y", "ATGAAATAG", "nt"), ("s-y", "ACGT", None)], "name string, sequence string, src_file string")
    found = readers.reference_targets(rows)
    assert {r["target"]: r["seq_type"] for r in found.collect()} == {"p-x": "AA", "q-x": "AA", "r-y": "NT", "s-y": "NT"}
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
