"""Secret scans: fixed patterns, and a battery of randomness tests under false-discovery control."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import read_table

#: The patterns of the base kinds and the least length of what they must hold.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
#: Runs that the randomness tests look at, whatever letters and digits they hold.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
#: Share of reported candidates that may be no random strings, and the p-value bins a decade.
RATE, BINS = 0.05, 50
#: Random strings drawn for each encoding and band of lengths, and the longest band (64 characters or more).
DRAWS, LONGEST = 1000, 6
#: Where the estimate of how many candidates are random looks, and the share of random strings that may be given up.
TAILS, FLOOR = (0.1, 0.25, 0.5), 0.01
_SPAN = "array<struct<s:int,o:int,e:int,txt:string>>"


def _found(text: Column, pattern: str, order: int) -> Column:
    """Leftmost non-overlapping matches with their places in code points."""
    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda a, b: F.struct(F.length(a).alias("gap"), F.length(b).alias("n"), b.alias("txt")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))
    one = lambda acc, x: F.array(F.struct((acc.at + x.gap).alias("s"), F.lit(order).alias("o"), (acc.at + x.gap + x.n).alias("e"), x.txt.alias("txt")))
    walk = F.aggregate(steps, start, lambda acc, x: F.struct((acc.at + x.gap + x.n).alias("at"), F.concat(acc.out, one(acc, x)).alias("out")), lambda acc: acc.out)
    return F.when(text.rlike(pattern), walk).otherwise(F.array().cast(_SPAN))


def _upper_tail(z: Column) -> Column:
    """1 - Phi(z) by a rational approximation (absolute error under 1e-7), at least 1e-12."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) * 0.3989422804014327 * series
    return F.greatest(F.lit(1e-12), F.when(z >= 0, tail).otherwise(1 - tail))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings in the order in which they are tried: characters that a string may hold, its alphabet.
ENCODINGS = (
    ("^[0-9a-f]+$", "0123456789abcdef"),
    ("^[0-9A-F]+$", "0123456789ABCDEF"),
    ("^[A-Z2-7]+$", _LETTERS + "234567"),
    ("^[0-9a-z]+$", "0123456789" + _LETTERS.lower()),
    ("^[0-9A-Z]+$", "0123456789" + _LETTERS),
    ("", _LETTERS + _LETTERS.lower() + "0123456789+/"),
)


def _tested(txt: Column) -> Column:
    """(encoding's size, band of lengths, bin of the p-value) of a string, were it random over its encoding's alphabet."""
    alphabet = F.lit(ENCODINGS[-1][1])
    for pattern, letters in ENCODINGS[-2::-1]:
        alphabet = F.when(txt.rlike(pattern), F.lit(letters)).otherwise(alphabet)
    values = lambda a: F.transform(F.split(F.translate(txt, "-_", "+/"), ""), lambda c: F.instr(a, c) - 1)
    held = _let(alphabet, lambda a: F.struct(F.length(a).cast("double").alias("k"), F.filter(values(a), lambda v: v >= 0).alias("v"), F.length(F.regexp_replace(txt, "[^0-9]", "")).cast("double").alias("digits")))

    def moments(x: Column) -> Column:
        counts = F.transform(F.sequence(F.lit(0), (x.k - 1).cast("int")), lambda s: F.size(F.filter(x.v, lambda w: w == s)).cast("double"))
        return F.struct(
            x.k.alias("k"),
            x.v.alias("v"),
            F.size(x.v).cast("double").alias("n"),
            x.digits.alias("digits"),
            F.aggregate(counts, F.lit(0.0), lambda acc, c: acc + c * c).alias("squares"),
            (F.aggregate(x.v, F.lit(0.0), lambda acc, v: acc + v) / F.size(x.v)).alias("mean"),
            F.size(F.filter(x.v, lambda v: v >= x.k / 2)).cast("double").alias("high"),
            F.zip_with(F.slice(x.v, 1, F.size(x.v) - 1), F.slice(x.v, 2, F.size(x.v) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b"))).alias("pairs"),
        )

    def statistics(x: Column) -> Column:
        cross = F.aggregate(x.pairs, F.lit(0.0), lambda acc, p: acc + (p.a - x.mean) * (p.b - x.mean))
        spread = F.aggregate(x.v, F.lit(0.0), lambda acc, v: acc + (v - x.mean) * (v - x.mean))
        turns = F.size(F.filter(x.pairs, lambda p: (p.a >= x.k / 2) != (p.b >= x.k / 2)))
        free, expected = x.k - 1, 2 * x.high * (x.n - x.high) / x.n + 1
        variance = (expected - 1) * (expected - 2) / (x.n - 1)
        chi = F.greatest(x.k / x.n * x.squares - x.n, F.lit(0.0))
        expected_share = F.when(x.k == 32, 6.0).otherwise(10.0) / x.k
        return F.struct(
            x.k.cast("int").alias("k"),
            x.n.alias("n"),
            F.abs((x.digits - x.n * expected_share) / F.sqrt(x.n * expected_share * (1 - expected_share))).alias("digits_z"),
            ((F.pow(chi / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))).alias("chi_z"),
            F.coalesce(F.abs(F.try_divide(turns + 1 - expected, F.sqrt(F.greatest(variance, F.lit(0.0))))), F.lit(9.0)).alias("runs_z"),
            F.abs(F.coalesce(F.try_divide(cross, spread), F.lit(1.0)) * F.sqrt(x.n)).alias("serial_z"),
        )

    def grade(x: Column) -> Column:
        lowest = F.least(_upper_tail(x.chi_z), 2 * _upper_tail(x.digits_z), 2 * _upper_tail(x.runs_z), 2 * _upper_tail(x.serial_z))
        p = F.least(F.lit(1.0), 4 * lowest)
        return F.struct(x.k.alias("k"), F.least(F.lit(LONGEST), F.floor(F.log2(x.n)).cast("int")).alias("band"), F.floor(-F.log10(p) * BINS).cast("int").alias("bin"))

    return _let(_let(_let(held, moments), statistics), grade)


def _random_strings(spark) -> DataFrame:
    """(k, band, bin, drawn): how the tests grade DRAWS random strings of each encoding and band.

    Short strings have too few characters for the tests' approximations, so candidates are compared with these.
    """
    alphabets, bands = [letters for _, letters in ENCODINGS], range(4, LONGEST + 1)
    of = lambda values, at: F.element_at(F.array(*map(F.lit, values)), at.cast("int") + 1)
    band = F.floor(F.col("id") / len(alphabets)) % len(bands)
    low, high = [max(20, 1 << n) for n in bands], [2 << n for n in bands]
    size = of(low, band) + F.pmod(F.xxhash64("id"), of(high, band) - of(low, band)) - 1
    drawn = spark.range(DRAWS * len(alphabets) * len(bands)).select("id", of(alphabets, F.col("id") % len(alphabets)).alias("a"), size.alias("n"))
    letter = lambda i: F.substring(F.col("a"), (F.pmod(F.xxhash64("id", i), F.length("a")) + 1).cast("int"), F.lit(1))
    graded = drawn.select(_tested(F.array_join(F.transform(F.sequence(F.lit(0), F.col("n").cast("int")), letter), "")).alias("grade"))
    return graded.groupBy("grade.k", "grade.band", "grade.bin").agg(F.count(F.lit(1)).alias("drawn"))


def _cuts(tests: DataFrame) -> DataFrame:
    """(k, band, cut): for each encoding and band of lengths the last bin that is reported (bounded table).

    A candidate's share is that of the random strings that look less random than it. Random candidates' shares
    are even over 0 to 1; words, names and paths have shares near 0. So the candidates with large shares tell how
    many are random in all, and what passes a share beyond those is no random string. In each band the least
    share is taken from which the rate of such false reports is at most RATE. All candidates are counted.
    """
    bins = tests.groupBy("k", "band", "bin").agg(F.count(F.lit(1)).alias("c"))
    both = bins.withColumn("drawn", F.lit(0).cast("long")).unionByName(_random_strings(tests.sparkSession).withColumn("c", F.lit(0).cast("long")))
    both = both.groupBy("k", "band", "bin").agg(F.sum("c").alias("c"), F.sum("drawn").alias("drawn"))
    own = Window.partitionBy("k", "band")
    worse = F.coalesce(F.sum("drawn").over(own.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shares = both.withColumn("share", worse / F.sum("drawn").over(own)).where("c > 0")
    band = Window.partitionBy("band")
    least = lambda tail: (F.sum(F.when(F.col("share") > tail, F.col("c")).otherwise(0)).over(band) + 1) / (1 - tail)
    ranked = shares.withColumns({"reported": F.sum("c").over(band.orderBy(F.desc("share"))), "random": F.greatest(*map(least, TAILS))})
    good = (F.col("share") >= FLOOR) & (1 - F.col("random") * (1 - F.col("share")) / F.col("reported") <= RATE)
    passed = ranked.withColumn("from", F.min(F.when(good, F.col("share"))).over(band)).where(F.col("share") >= F.col("from"))
    return passed.groupBy("k", "band").agg(F.max("bin").alias("cut"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Spans of secrets in every whole text.

    Base kinds: assignments to names of secrets, access keys, long hexadecimal runs. The method adds
    ``random``: long runs, with digits or without, whose characters pass, for the encoding inferred
    from their alphabet (hex, base32, base36, base64), a chi-squared test of uniformity and one of the
    share of digits, a runs test about the middle of the alphabet and a test of serial correlation. How a
    candidate fares is compared with random strings of its encoding and band of lengths, and in each band as many
    are reported as keep the share of false reports at 0.05 (see ``_cuts``); with very few candidates in a band
    one or two undecided ones may be reported. Random strings that are no secrets (identifiers drawn at random)
    are reported too.

    Two scans with built-in functions; only the counts of p-value bins are shuffled, and the cuts of
    a dozen encodings and bands broadcast. Returns doc_id, the ``keep`` columns, and ``spans``: array of (s, o, e, txt)
    with places in code points, end exclusive, sorted by start, then kind (``o`` indexes KINDS). A kept column
    that is named like one of those comes as ``kept_`` and its name.

    Null and empty texts have no spans. Repeated rows are scanned each. Columns other than the named
    ones aren't read. An empty table gives no rows.
    """
    name = lambda c: f"kept_{c}" if c in ("doc_id", "spans") else c
    return _scanned(docs, id_col, text_col, keep).select("doc_id", *[F.col(f"__kept_{c}").alias(name(c)) for c in keep], "spans")


def _scanned(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """doc_id, the kept columns behind a prefix, and the spans."""
    source = docs.select(F.col(id_col).alias("doc_id"), *[F.col(f"`{c}`").alias(f"__kept_{c}") for c in keep], F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    text = F.col("__text")
    graded = source.withColumn("__tests", F.transform(_found(text, CANDIDATE, 3), lambda x: F.struct(x.alias("span"), _tested(x.txt).alias("grade"))))
    tests = graded.select(F.explode("__tests").alias("x")).select("x.grade.k", "x.grade.band", "x.grade.bin")
    at = lambda k, band: 100 * band + k
    cut_of = _cuts(tests).agg(F.map_from_entries(F.collect_list(F.struct(at(F.col("k"), F.col("band")), "cut"))).alias("cuts"))
    assign = F.filter(_found(text, ASSIGN, 0), lambda x: F.length(F.regexp_extract(x.txt, ASSIGN, 2)) >= 6)
    scanned = graded.withColumns({"__base": F.concat(assign, _found(text, ACCESS, 1), _found(text, HEX, 2)), "__cuts": cut_of.scalar()})
    passed = F.filter("__tests", lambda x: x.grade.bin <= F.coalesce(F.element_at("__cuts", at(x.grade.k, x.grade.band)), F.lit(-1)))
    added = F.filter(F.transform(passed, lambda x: x.span), lambda c: ~F.exists("__base", lambda b: (b.s < c.e) & (c.s < b.e)))
    return scanned.select("doc_id", *[f"`__kept_{c}`" for c in keep], F.array_sort(F.concat("__base", added)).alias("spans"))


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every secret's span replaced by ``mark``; texts without secrets are left as they are.

    Overlapping spans are replaced once, as their union. Null texts stay null, empty ones empty; repeated rows are
    treated alike, columns may have any names, and an empty table stays empty.
    """
    found = _scanned(docs, id_col, text_col, tuple(docs.columns))
    text = F.col(f"`__kept_{text_col}`")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        cut = F.when(x.s < acc.at, acc.out).otherwise(F.concat(acc.out, F.substring(text, acc.at + 1, x.s - acc.at), F.lit(mark)))
        return F.struct(F.greatest(acc.at, x.e).alias("at"), cut.alias("out"))

    clean = F.aggregate("spans", start, step, lambda acc: F.concat(acc.out, F.substring(text, acc.at + 1, F.length(text))))
    clean = F.when(text.isNull() | (F.size("spans") == 0), text).otherwise(clean)
    return found.select(*[(clean if c == text_col else F.col(f"`__kept_{c}`")).alias(c) for c in docs.columns])


def _joined(spans: Column) -> Column:
    named = F.transform(spans, lambda x: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), x.o + 1), x.s.cast("string"), x.e.cast("string")))
    return F.array_join(named, ",")


def op8_secrets(spark, sf_dir: str) -> DataFrame:
    found = scan_secrets(read_table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda x: x.o == k)).cast("long")
    base = F.sha2(_joined(F.filter("spans", lambda x: x.o < 3)).cast("binary"), 256)
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), base.alias("base_sha256"), _joined(F.col("spans")).alias("spans"), count(3).alias("n_random"))
