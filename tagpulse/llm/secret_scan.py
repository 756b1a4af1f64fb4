"""Secrets in texts: patterns, and long tokens that a battery of tests can't tell from random symbols."""

from math import log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagpulse.session import checkpointed

# Kinds of spans in their order, the patterns of the base ones, and the least length of a match or its value.
KINDS = ["assign", "access", "hex", "random"]
PATTERNS = [
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    r"AKIA[A-Z0-9]+",
    r"[0-9a-f]{24,}",  # a run of such digits is longest as it is, so the length can be asked for here
    r"[A-Za-z0-9+/_-]{20,}",
]
LEAST = [6, 20, 24, 20]
# Encodings of random bytes: name, whole-token pattern, classes it must have, symbols.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = [
    ("hex", r"^[0-9a-f]+$", ["[0-9]", "[a-f]"], DIGITS + "abcdef"),
    ("HEX", r"^[0-9A-F]+$", ["[0-9]", "[A-F]"], DIGITS + "ABCDEF"),
    ("base32", r"^[A-Z2-7]+$", ["[2-7]", "[A-Z]"], UPPER + "234567"),
    ("base36", r"^[a-z0-9]+$", ["[0-9][a-z]+[0-9]"], DIGITS + LOWER),  # digits among the letters, not a word and a number
    ("BASE36", r"^[A-Z0-9]+$", ["[0-9][A-Z]+[0-9]"], DIGITS + UPPER),
    ("letters", r"^[A-Za-z]+$", ["[a-z]", "[A-Z]{2}"], UPPER + LOWER),  # not words joined by their capitals
    ("alphanumeric", r"^[A-Za-z0-9]+$", ["[0-9]", "[a-z]", "[A-Z]"], UPPER + LOWER + DIGITS),
    ("base64", r"^[A-Za-z0-9+/]+$", ["[0-9]", "[a-z]", "[A-Z]"], UPPER + LOWER + DIGITS + "+/"),
    ("base64url", r"^[A-Za-z0-9_-]+$", ["[0-9]", "[a-z]", "[A-Z]"], UPPER + LOWER + DIGITS + "-_"),
]
SECRET_BITS = 96  # a token that could hold fewer is not tested: too short for any test to tell
BINS_PER_DECADE, DECADES = 8, 40  # how finely p-values are counted


def matches(text: Column, kind: int) -> Column:
    """The pattern's matches in order, each with the characters since the one before."""
    pattern = F.lit(PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.transform(F.split(text, PATTERNS[kind], -1), lambda piece: F.char_length(piece))
    rows = F.zip_with(gaps, found, lambda gap, match: F.struct(F.lit(kind).alias("kind"), gap.alias("gap"), match.alias("match")))
    none = F.array().cast("array<struct<kind:int,gap:int,match:string>>")
    return F.when(F.regexp_like(text, pattern), F.filter(rows, lambda r: r["match"].isNotNull())).otherwise(none)


def upper_tail(z: Column) -> Column:
    """The chance of a standard normal value above z: the rational approximation with an error below 1e-7."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    # The coefficients of the approximation.
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    q = 0.3989422804014327 * F.exp(-a * a / 2) * poly
    return F.when(z >= 0, q).otherwise(1 - q)


def encoding(token: Column) -> Column:
    """(name, symbols) of the first encoding that the token is written in; NULL if there is none, or it is too short."""
    choice = F.lit(None).cast("struct<name:string,symbols:string>")
    for name, pattern, classes, symbols in reversed(ENCODINGS):
        fits = F.regexp_like(token, F.lit(pattern)) & (F.char_length(token) * log2(len(symbols)) >= SECRET_BITS)
        for c in classes:
            fits = fits & F.regexp_like(token, F.lit(c))
        choice = F.when(fits, F.struct(F.lit(name).alias("name"), F.lit(symbols).alias("symbols"))).otherwise(choice)
    return choice


def randomness(tokens: DataFrame) -> DataFrame:
    """Adds `p` to (match, symbols): the chance that symbols drawn evenly and on their own look as uneven as the token's.

    Chi-squared test of the counts, runs above and below the middle, and correlation of neighbours, combined by Fisher's
    method. Step by step, each value computed once; NULL where there are no symbols.
    """
    others = tokens.columns
    square = lambda array: F.aggregate(array, F.lit(0.0), lambda s, x: s + x * x)
    total = lambda array: F.aggregate(array, F.lit(0.0), lambda s, x: s + x)
    n, k = F.col("_n"), F.col("_k")
    half = F.floor(k / 2).cast("int")
    halves = F.call_function("translate", F.col("match"), F.col("symbols"), F.concat(F.repeat(F.lit("0"), half), F.repeat(F.lit("1"), (k - half).cast("int"))))
    counts = F.transform(F.array_distinct("_letters"), lambda c: n - F.char_length(F.replace(F.col("match"), c, F.lit(""))))
    without = lambda part: n - F.char_length(F.replace(F.col("_halves"), F.lit(part), F.lit("")))
    turned = F.concat(F.slice("_values", 2, F.size("_values")), F.slice("_values", 1, 1))
    product = total(F.zip_with("_values", turned, lambda x, y: x * y))
    steps = [
        {"_n": F.char_length("match").cast("double"), "_k": F.char_length("symbols").cast("double"), "_letters": F.split("match", "")},
        {"_halves": F.when(F.col("symbols").isNotNull(), halves),
         "_values": F.transform("_letters", lambda c: F.instr(F.col("symbols"), c).cast("double")), "_squares": square(counts)},
        {"_ones": without("1"), "_runs": 1 + (without("01") + without("10")) / 2,
         "_sum": total(F.col("_values")), "_square": square(F.col("_values")), "_product": product},
        {"_ratio": (k * F.col("_squares") / n - n) / (k - 1), "_spread": 2 / (9 * (k - 1)), "_mixed": 2 * F.col("_ones") * (n - F.col("_ones")),
         "_below": n * F.col("_square") - F.col("_sum") * F.col("_sum")},
        {"_uneven": (F.pow(F.greatest("_ratio", F.lit(0.0)), F.lit(1 / 3)) - (1 - F.col("_spread"))) / F.sqrt("_spread"),
         "_deviation": F.sqrt(F.greatest(F.col("_mixed") * (F.col("_mixed") - n) / (n * n * (n - 1)), F.lit(0.0))),
         "_r": (n * F.col("_product") - F.col("_sum") * F.col("_sum")) / F.when(F.col("_below") > 0, F.col("_below"))},
        {"_clumped": F.abs(F.col("_runs") - F.col("_mixed") / n - 1) / F.when(F.col("_deviation") > 0, F.col("_deviation")),
         "_linked": F.abs(F.col("_r") + 1 / (n - 1)) * F.sqrt(n)},
        {"_p1": upper_tail(F.col("_uneven")), "_p2": F.coalesce(2 * upper_tail(F.col("_clumped")), F.lit(0.0)),
         "_p3": F.coalesce(2 * upper_tail(F.col("_linked")), F.lit(0.0))},
        {"_x": -sum((F.ln(F.greatest(c, F.lit(1e-15))) for c in ("_p1", "_p2", "_p3")), F.lit(0.0))},
    ]
    for step in steps:
        tokens = tokens.withColumns(step)
    x = F.col("_x")  # half of a chi-squared value with six degrees of freedom
    return tokens.select(*others, F.when(F.col("symbols").isNotNull(), F.exp(-x) * (1 + x + x * x / 2)).alias("p"))


def spans(docs: DataFrame) -> DataFrame:
    """All matches in `docs` (`row`, `text` and others): the others with kind (its number, -1 for one more row per document),
    start, end, match, and for tokens of an inferred encoding band (encoding and length class) and bin (of their p-value)."""
    others = [c for c in docs.columns if c != "text"]
    mark = F.array(F.struct(F.lit(-1).alias("kind"), F.lit(0).alias("gap"), F.lit("").alias("match")))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(*others, F.posexplode(F.concat(*[matches(text, k) for k in range(len(KINDS))], mark)).alias("at", "m"))
    along = Window.partitionBy("row", "kind").orderBy("at")
    placed = (
        rows.select(*others, "at", "m.*").withColumn("length", F.char_length("match"))
        .withColumn("end", F.sum((F.col("gap") + F.col("length")).cast("long")).over(along))
        .withColumn("start", F.col("end") - F.col("length")))
    judged = F.when(F.col("kind") == 0, F.char_length(F.regexp_extract("match", PATTERNS[0], 2))).otherwise(F.col("length"))
    least = F.element_at(F.array(*map(F.lit, LEAST)), F.greatest(F.col("kind"), F.lit(0)) + 1)
    kept = placed.where((F.col("kind") < 0) | (judged >= least))
    kept = kept.withColumn("written", F.when(F.col("kind") == 3, encoding(F.col("match")))).where("kind <> 3 or written is not null")
    band = F.struct(F.col("written.name").alias("encoding"), F.floor(F.log2("length")).cast("int").alias("doublings"))
    tested = randomness(kept.withColumn("symbols", F.col("written.symbols")))
    floor = F.greatest(F.col("p"), F.lit(10.0**-DECADES))
    return tested.select(
        *others, "kind", "start", "end", "match", F.when(F.col("kind") == 3, band).alias("band"),
        F.floor(-F.log10(floor) * BINS_PER_DECADE).cast("int").alias("bin"))


def structured(found: DataFrame, rate: float) -> DataFrame:
    """(band, cut): bins from `cut` on are rejected as structured, with a false-discovery rate of `rate` in each band.

    Benjamini and Hochberg's step-up rule over counts per bin, whose upper edge stands for all p-values in it. Longer
    tokens have more power and are judged among their like. There are fewer than 200 bands and 321 bins, whatever the input.
    """
    counts = found.where("kind = 3").groupBy("band", "bin").agg(F.count("*").alias("n"))
    down = Window.partitionBy("band").orderBy(F.desc("bin"))
    edge = F.pow(F.lit(10.0), -F.col("bin") / BINS_PER_DECADE)
    ranked = counts.select(
        "band", "bin", edge.alias("edge"), F.sum("n").over(down).alias("rank"), F.sum("n").over(Window.partitionBy("band")).alias("all"))
    return ranked.where(F.col("edge") <= F.col("rank") * rate / F.col("all")).groupBy("band").agg(F.min("bin").alias("cut"))


def secrets(docs: DataFrame, rate: float = 0.05) -> DataFrame:
    """The rows of `spans` that are secrets: base kinds, and tokens not rejected as structured; and one per document."""
    found = checkpointed(spans(docs))  # a few rows per document; read for the counts and for the result
    cuts = F.broadcast(structured(found, rate))  # under 200 rows
    return found.join(cuts, "band", "left").where("kind <> 3 or cut is null or bin < cut")


def scan(docs: DataFrame, rate: float = 0.05) -> DataFrame:
    """Secrets in every whole text of `docs` (`doc_id`, `text`).

    Base kinds are patterns. The method adds kind random: a run of 20 and more symbols of an inferred encoding, long enough
    for 96 bits, that three tests do not reject as structured at a false-discovery rate of `rate` among all tokens of the
    corpus in its encoding and length class. Letters of one case are of no encoding: at 28 letters the tests reject (at 0.05) only four
    in ten runs of joined words, so long compounds of clean texts would be taken for secrets.

    Per row: doc_id, n_assign, n_access, n_hex, base_sha256 and spans, as kind:start:end in code points, end exclusive, by start
    and then kind. A NULL or empty text has none; a NULL doc_id is kept; repeated rows come out once each; an empty table gives
    no rows; other columns are ignored. Texts are read once, only their matches are shuffled.
    """
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    span = F.struct("start", "kind", "end")
    name = F.array(*map(F.lit, KINDS))
    line = lambda rows: F.array_join(F.transform(rows, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")
    listed = secrets(numbered, rate).groupBy("row", "doc_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") >= 0, span))).alias("all"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{KINDS[k]}") for k in range(3)])
    base = F.filter("all", lambda s: s["kind"] < 3)
    return listed.select(
        "doc_id", *[f"n_{k}" for k in KINDS[:3]], F.sha2(line(base), 256).alias("base_sha256"), line(F.col("all")).alias("spans"))


def redact(docs: DataFrame, rate: float = 0.05, mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every secret in `text` replaced by `mark`, and n_chars, where there is one, counted anew.

    Spans that overlap are one and get one mark. A secret's string goes wherever else it stands in its text, longest first.
    Secrets meet the documents by a hash of the text, so a NULL doc_id or a repeated row changes nothing. All rows and other
    columns stay as they are.
    """
    key = F.xxhash64("text").alias("text_key")
    found = secrets(docs.select(F.monotonically_increasing_id().alias("row"), key, "text"), rate)
    along = Window.partitionBy("text_key").orderBy("start", "end", "match")
    ends = found.where("kind >= 0").select("text_key", "start", "end", "match").distinct().withColumn(
        "reached", F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1)))
    merged = (
        ends.withColumn("of", F.count_if(F.col("reached").isNull() | (F.col("start") >= F.col("reached"))).over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("text_key", "of").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.collect_set("match").alias("matches")))
    longest_first = lambda a, b: F.char_length(b) - F.char_length(a)
    listed = merged.groupBy("text_key").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("places"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("matches"))), longest_first).alias("matches"))
    whole = docs.select(F.struct(*docs.columns).alias("doc"), key)  # so that no column of docs clashes with another
    text = F.col("doc.text")
    starts, stops = (F.col(f"places.{c}").cast("array<int>") for c in ("start", "end"))
    pieces = F.zip_with(
        F.concat(F.array(F.lit(0)), stops), F.concat(starts, F.array(F.char_length(text))), lambda a, b: F.substring(text, a + 1, b - a))
    left = F.transform(pieces, lambda piece: F.aggregate("matches", piece, lambda rest, match: F.replace(rest, match, F.lit(mark))))
    clean = F.array_join(left, mark)
    doc = F.col("doc").withField("text", clean)
    if "n_chars" in docs.columns:
        doc = doc.withField("n_chars", F.char_length(clean).cast(docs.schema["n_chars"].dataType))
    joined = whole.join(listed, "text_key", "left")
    return joined.select(F.when(F.col("matches").isNull(), F.col("doc")).otherwise(doc).alias("doc")).select("doc.*")
