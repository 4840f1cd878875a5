"""Near duplicates: MinHash with tensored banding, exact verification, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, let_go, mixed, read_table, word_hashes

#: Half-keys on either side and minhashes in each: SIDE * SIDE tables from 2 * SIDE * WIDTH minhashes.
SIDE, WIDTH = 8, 2
MINHASHES = 2 * SIDE * WIDTH
#: Candidates may differ in so many of the minhashes, of which two bits each are compared, at most. Of a pair
#: of similarity 0.8, 4.8 of 32 differ on average; over 15 has probability 3e-6.
MOST_DIFFERING = 15
#: Bits of a set's parity map, in two parts, and the size of sets from which a part takes only a share of the shingles.
PARITY, WHOLE = 1024, 512
#: First rounds, in which a class is paired with one leader among those of all its keys.
REDUCING = 2
#: Leading classes that a key's others are paired with in the round after those; sixteen times as many in each later one.
LEADERS = 64
_MASK48 = np.uint64((1 << 48) - 1)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles; of fewer words, one of the whole sequence."""
    h, _ = word_hashes((text or "").encode("utf-8", "replace").lower())
    if not len(h):
        return h
    n = min(words, len(h))
    total = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - n + 1 + i])
    return np.unique(total)


_SEEDS = mixed(np.arange(1, MINHASHES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def minhashes(found: np.ndarray) -> np.ndarray:
    """The least of MINHASHES hash functions over a set, as signed 32-bit integers."""
    least = np.full(MINHASHES, np.iinfo(np.uint64).max, np.uint64)
    for first in range(0, len(found), 4096):
        part = found[first : first + 4096]
        least = np.minimum(least, (part[None, :] * _SEEDS[:, None] + (_SEEDS[:, None] >> np.uint64(7))).min(axis=1))
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _sketch(mh: np.ndarray) -> int:
    """Two bits of every minhash."""
    return int(((mh.astype(np.int64) & 3).astype(np.uint64) << np.arange(0, 2 * MINHASHES, 2, dtype=np.uint64)).sum(dtype=np.uint64).view(np.int64))


def thinning(n: int) -> int:
    """Of a set of n shingles, one in 2**thinning is in either part of its parity map: all of those below WHOLE are in one or the other."""
    return max(0, int(n).bit_length() - WHOLE.bit_length() + 1)


def parity_map(found: np.ndarray) -> np.ndarray:
    """PARITY bits, each whether an odd number of the set's shingles falls on it, as signed 64-bit integers.

    The leading bits of a shingle's hash tell its part, so sets below 2 * WHOLE are mapped whole, and of larger ones two shares are.
    Two sets' maps differ in at most as many bits as shingles are in one of the sets only.
    """
    h = mixed(found ^ np.uint64(0x6A09E667F3BCC909))
    part = h >> np.uint64(64 - max(1, thinning(len(found))))
    at = part * np.uint64(PARITY // 2) + h % np.uint64(PARITY // 2)
    odd = np.bincount(at[part < 2].astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _packed(found: np.ndarray) -> bytes:
    """48 bits of every hash, sorted."""
    low = np.unique(found & _MASK48)
    return np.stack([(low >> np.uint64(s)).astype(np.uint16) for s in (32, 16, 0)]).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    high, mid, low = np.frombuffer(data, np.uint16).reshape(3, -1).astype(np.uint64)
    return (high << np.uint64(32)) | (mid << np.uint64(16)) | low


def _fingerprint(found: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    return int((mixed(found + np.uint64(1)).sum(dtype=np.uint64) ^ np.uint64(len(found) * 0x9E3779B97F4A7C15 % (1 << 64))).view(np.int64))


def _row() -> Column:
    """What orders rows: ids before none, the smaller id, then the text's mark."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")


def _signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, mark, n, cls, mh, sketch, parity): the text's mark, and what is derived from each document's set."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int64(), pa.list_(pa.int64())]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            rows = []
            for value in batch.column("text"):
                found = shingles(value.as_py(), words)
                if len(found):
                    mh = minhashes(found)
                    rows.append((len(found), _fingerprint(found), mh, _sketch(mh), parity_map(found)))
                else:
                    rows.append((0, 0, None, 0, None))
            columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), *made], ["doc_id", "mark", "n", "cls", "mh", "sketch", "parity"])

    return docs.select("doc_id", "mark", "text").mapInArrow(sign, f"doc_id {kind}, mark long, n long, cls long, mh array<int>, sketch long, parity array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(cls, shingle set) of the wanted classes, each once, from a row that stands for it."""
    reps = wanted.select(F.col("rep.doc_id").alias("r_id"), F.col("rep.mark").alias("r_mark"), "cls")
    chosen = docs.join(reps, docs["doc_id"].eqNullSafe(reps["r_id"]) & (docs["mark"] == reps["r_mark"]))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            found = [shingles(v.as_py(), words) for v in batch.column("text")]
            own = pa.array([_fingerprint(s) == c for s, c in zip(found, batch.column("cls").to_pylist(), strict=True)], pa.bool_())  # not another text of the same mark
            yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array([_packed(s) for s in found], pa.binary())], ["cls", "items"]).filter(own)

    return chosen.select("cls", "text").mapInArrow(pack, "cls long, items binary").dropDuplicates(["cls"])  # rows may repeat


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets share at least ``percent`` hundredths of their union."""
    both = pairs.join(sets.select(F.col("cls").alias("a"), F.col("items").alias("x")), "a").join(sets.select(F.col("cls").alias("b"), F.col("items").alias("y")), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            good, last, x = [], None, None
            for left, right in zip(batch.column("x"), batch.column("y"), strict=True):
                raw = right.as_py()
                if raw != last:
                    last, y = raw, _unpacked(raw)
                x = _unpacked(left.as_py())
                shared = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")


def connected_components(edges: DataFrame) -> DataFrame:
    """(v, comp) with the least vertex reachable over the edges (a, b), by rounds of minima and jumps.

    Every round takes the least label among neighbours and then the label's own label, and is written
    to the shared folder; a hub's neighbours meet by a join, so no neighbourhood is gathered anywhere.
    """
    own = Scratch(edges.sparkSession)
    both = own.write(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = own.write(both.groupBy(F.col("a").alias("v")).agg(F.least(F.first("a"), F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("b"), "comp"), "b").groupBy(F.col("a").alias("v")).agg(F.min("comp").alias("least"))
        lower = labels.join(near, "v").select("v", F.least("comp", "least").alias("comp"), F.col("comp").alias("old"))
        jump = labels.select(F.col("v").alias("comp"), F.col("comp").alias("next"))
        moved = own.write(lower.join(jump, "comp", "left").select("v", F.least("comp", F.coalesce("next", "comp")).alias("comp"), "old"), "labels")
        labels = moved.select("v", "comp")
        if not moved.where("comp <> old").limit(1).count():
            own.drop("edges")
            return labels


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group documents whose sets of word shingles have a Jaccard similarity of ``percent`` / 100 or more.

    Documents with equal sets are one class from the start, so copies cost one row each. A class's keys
    come from tensored banding: SIDE half-keys on either side, of WIDTH minhashes each, combine into
    SIDE * SIDE tables from only 2 * SIDE * WIDTH minhashes; a pair of similarity 0.8 shares a key with
    probability 0.9994, of 0.9 with more than 0.99999. The classes of a key aren't paired with one another:
    in a few first rounds, each class is paired with one leader of its keys, and candidates are verified on
    their full sets, so that components form. Then each class meets the key's leaders that lie in other
    components, and the leaders leave; a key whose classes are one component is done. Leaders grow sixteenfold, so
    rounds are few, and nobody's partners are capped: what is left unpaired at the end lies in one component.
    A pair becomes a row only where parity maps of the two sets (1024 bits, whose distance bounds the difference of
    the sets from below) allow the similarity, so unlike texts that share keys cost a comparison of a few words.

    Returns doc_id, n_shingles, component_id (the smallest id reachable) and kept (doc_id = component_id).
    Null, empty and blank texts have no shingles and are their own component; texts of fewer words are one
    shingle. Rows that repeat an id are returned each, with their own set. A null id counts as the smallest only
    in a component of nulls. Other columns aren't read. An empty table gives no rows.
    """
    named = _grouped(docs, words, percent, id_col, text_col)
    return named.select("doc_id", "n_shingles", F.col("lead.doc_id").alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of ``near_duplicates``: of the smallest id, and of equal ids one text.

    Rows are told apart by id and text, so unlike texts stay though they share an id or have none. Texts
    without shingles stay, every row of them.
    """
    mark = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    lead = _grouped(docs, words, percent, id_col, text_col).where("n_shingles > 0").select(F.col("lead.doc_id").alias("__id"), F.col("lead.mark").alias("__lead")).distinct()
    marked = docs.withColumn("__mark", mark)
    has_words = F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = marked.where(has_words).join(lead, marked[id_col].eqNullSafe(lead["__id"]) & (marked["__mark"] == lead["__lead"]), "left_semi")
    return kept.dropDuplicates([id_col, "__mark"]).union(marked.where(~has_words)).drop("__mark")


def _grouped(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, mark, n_shingles, lead): each row, and the row (doc_id, mark) that leads its component."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("mark"), F.col(text_col).alias("text"))
    own = Scratch(docs.sparkSession)
    signed = own.write(_signatures(docs, words), "signatures")
    classes = signed.where("n > 0").groupBy("cls").agg(F.min(_row()).alias("rep"), *[F.first(c).alias(c) for c in ("n", "mh", "sketch", "parity")])
    classes = own.write(classes, "classes")
    members = own.write(_members(classes), "members")
    if not members.limit(1).count():
        return _named(signed, classes, None)
    weights = members.groupBy("cls").agg(F.sum("size").alias("weight"))
    traits = own.write(_traits(classes).join(weights, "cls"), "traits")
    sets = own.write(_sets(docs, classes.join(traits, "cls", "left_semi"), words), "sets")
    comps, turn = None, 0
    while True:
        turn += 1
        if turn <= REDUCING:
            pairs = _one_each(members, traits, percent, turn)
        else:
            draw = F.pmod(F.xxhash64("cls", F.lit(turn)), F.lit(1 << 30)) * F.col("size")
            members = members.withColumn("leads", draw < (LEADERS << 4 * (turn - REDUCING - 1) << 30))
            pairs = _candidates(members, traits, percent)
            members = members.where("not leads")
        links = own.write(_linked(own.write(pairs, "pairs"), sets, percent), "links")
        if links.limit(1).count():
            comps = own.write(connected_components(links) if comps is None else _joined(comps, links), "components")
        placed = members.select("key", "cls").withColumn("comp", F.col("cls"))
        if comps is not None:
            placed = members.select("key", "cls").join(comps.select(F.col("v").alias("cls"), "comp"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        keys = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo < hi").select("key", "size")
        members = own.write(placed.join(keys, "key"), "members")
        if not members.limit(1).count():
            own.drop("members", "traits", "sets", "pairs", "links")
            return _named(signed, classes, comps)


def _members(classes: DataFrame) -> DataFrame:
    """(key, cls, comp, size): the classes of each key that several have, each its own component at first."""
    at = lambda k: F.element_at("mh", k + 1)
    left, right = F.floor(F.col("t") / SIDE).cast("int") * WIDTH, F.pmod("t", F.lit(SIDE)) * WIDTH + SIDE * WIDTH
    keyed = classes.select("cls", "mh", F.explode(F.sequence(F.lit(0), F.lit(SIDE * SIDE - 1))).alias("t"))
    keyed = keyed.select("cls", F.xxhash64("t", *[at(left + i) for i in range(WIDTH)], *[at(right + i) for i in range(WIDTH)]).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return keyed.join(shared, "key").select("key", "cls", F.col("cls").alias("comp"), "size")


#: A map's 64 bits each, as columns: what compares them stays short enough to be compiled.
_MAPS = [f"map{i}" for i in range(PARITY // 64)]


def _traits(classes: DataFrame) -> DataFrame:
    """What tells whether two classes may be linked: sizes, how thinned their maps' parts are (1: whole), sketches and maps."""
    thin = F.greatest(F.lit(1), F.length(F.bin("n")) - WHOLE.bit_length() + 1)
    return classes.select("cls", "n", thin.alias("thin"), "sketch", *[F.element_at("parity", i + 1).alias(m) for i, m in enumerate(_MAPS)])


def _of_leader(traits: DataFrame) -> DataFrame:
    return traits.select(*[F.col(c).alias(f"l_{c}") for c in ("cls", "n", "thin", "sketch", *_MAPS)])


def _differing() -> Column:
    """Bits in which the parity maps of a class and its leader differ."""
    bits = [F.bit_count(F.col(m).bitwiseXOR(F.col(f"l_{m}"))) for m in _MAPS]
    return sum(bits[1:], bits[0])


def _possible(percent: int) -> Column:
    """Whether sizes, sketches and parity maps of a class and of its leader allow a link.

    Linked sets differ in at most (100 - percent) / (100 + percent) of the sum of their sizes. Maps of whole sets
    hold that bound exactly; those of thinned ones, of equal thinning, within six standard deviations.
    """
    differing = F.col("sketch").bitwiseXOR(F.col("l_sketch"))
    differing = F.bit_count(differing.bitwiseOR(F.shiftrightunsigned(differing, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    allowed = F.lit(100 - percent) * (F.col("n") + F.col("l_n")) / F.lit(100 + percent) / F.pow(F.lit(2.0), F.col("thin") - 1)
    within = _differing() <= F.when(F.col("thin") == 1, allowed + 1e-6).otherwise(allowed + 6 * F.sqrt(allowed))
    return (100 * F.least("n", "l_n") >= percent * F.greatest("n", "l_n")) & (differing <= MOST_DIFFERING) & ((F.col("thin") != F.col("l_thin")) | within)


def _ordered() -> list[Column]:
    return [F.least("cls", "l_cls").alias("a"), F.greatest("cls", "l_cls").alias("b")]


def _one_each(members: DataFrame, traits: DataFrame, percent: int, turn: int) -> DataFrame:
    """Each class with one of its keys' leaders in other components: the one whose parity map is nearest.

    In the first round a key is led by the class that shares most keys with others, the hub of a group of copies;
    then by others in a hashed order.
    """
    order = -F.col("weight") if turn == 1 else F.xxhash64("cls", F.lit(turn))
    rows = members.join(traits.select("cls", "weight"), "cls") if turn == 1 else members
    lead = rows.groupBy("key").agg(F.min_by(F.struct("cls", "comp"), F.struct(order, F.col("cls"))).alias("l"))
    lead = lead.select("key", F.col("l.cls").alias("l_cls"), F.col("l.comp").alias("l_comp"))
    met = members.join(lead, "key").where("comp <> l_comp").select("cls", "l_cls").distinct()
    met = met.join(traits, "cls").join(_of_leader(traits), "l_cls").where(_possible(percent))
    one = met.groupBy("cls").agg(F.min_by("l_cls", F.struct(_differing(), F.col("l_cls"))).alias("l_cls"))
    return one.select(*_ordered()).distinct()


def _candidates(members: DataFrame, traits: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of a key's leaders with its other classes in other components, where a link is possible."""
    lead = members.where("leads").select("key", F.col("cls").alias("l_cls"), F.col("comp").alias("l_comp")).join(_of_leader(traits), "l_cls")
    one_way = ~F.col("leads") | (F.col("cls") < F.col("l_cls"))
    met = members.join(traits, "cls").join(lead, "key").where((F.col("comp") != F.col("l_comp")) & one_way & _possible(percent))
    return met.select(*_ordered()).distinct()


def _joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: their labels are joined up, new vertices come in."""
    name = lambda side: comps.select(F.col("v").alias(side), F.col("comp").alias(f"c_{side}"))
    lifted = links.join(name("a"), "a", "left").join(name("b"), "b", "left").select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
    merged = connected_components(lifted).select(F.col("v").alias("comp"), F.col("comp").alias("to"))
    known = comps.join(merged, "comp", "left").select("v", F.coalesce("to", "comp").alias("comp"))
    fresh = merged.select(F.col("comp").alias("v"), F.col("to").alias("comp")).join(known, "v", "left_anti")
    return known.union(fresh)


def _named(signed: DataFrame, classes: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Each row with the one that leads its component."""
    if comps is None:
        named = classes.select("cls", F.col("rep").alias("lead"))
    else:
        own = classes.select("cls", "rep").join(comps.select(F.col("v").alias("cls"), "comp"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        least = own.groupBy("comp").agg(F.min("rep").alias("lead"))
        named = own.join(least, "comp").select("cls", "lead")
    lone = signed.where("n = 0").select("doc_id", "mark", F.col("n").alias("n_shingles"), _row().alias("lead"))
    return signed.where("n > 0").join(named, "cls").select("doc_id", "mark", F.col("n").alias("n_shingles"), "lead").union(lone)


def op9_neardup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), words=4)
