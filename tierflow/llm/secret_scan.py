"""Secret scans: three fixed patterns and a battery of randomness tests, in DataFrame functions only.

Runs of 20 or more encoding characters that hold a letter are candidates. Each gets its encoding from its
characters (hex and base32, also with separators between; letters where there is no digit, in either case; base64
where both cases and digits occur; base36 for the rest, separators left out) and three tests: chi-squared uniformity
over the alphabet, Wald-Wolfowitz runs, lag-one serial correlation. A candidate is a discovery when the battery does
not reject randomness and ordinary text of its length would hardly look so random; that second probability is
weighted by length and held to a false-discovery rate over all candidates of an encoding in the corpus
(Benjamini-Hochberg on a histogram of fixed width), so that long words take no power from keys with digits.

Ordinary letters are those of the corpus itself: how often two of them agree, and how often neighbours are a vowel and
a consonant. For the encodings with digits the ordinary rates are constants of this module. Runs of digits alone are
numbers, not candidates.

Null text: no spans. Spans are code points, end exclusive. Rows are kept one for one, also repeated ones;
other columns than ``doc_id`` and ``text`` are not read. Empty tables give empty results. Very long texts: spans are
numbered, compared and blotted out in blocks, so that work does not grow with the square of the matches; a text and
its spans must fit in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fresh

# Fixed patterns of the base kinds, in the order ties are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "random")

# A whole run of encoding characters, 20 at least.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
VOWELS = "aeiou"
HEX_DIGITS = "0123456789abcdef"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE36 = "0123456789abcdefghijklmnopqrstuvwxyz"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"

RATE = 0.01  # false discoveries among discoveries
REJECT = 3.3  # a battery test beyond this z speaks against randomness
# Ordinary tokens: chance that two characters agree, and that neighbours differ in kind (upper, lower, digit).
ORDINARY_AGREE = 0.065
ORDINARY_AGREE_HEX = 0.11
ORDINARY_AGREE_36 = 0.055  # long names of one case with digits, separators left out, in installed Python files
ORDINARY_CHANGE = 0.2
# Letters of English, and that neighbours are a vowel and a consonant: as good as so many letters of the corpus.
ORDINARY_LETTERS = (0.065, 0.6)
KNOWN_LETTERS = 100_000.0
BIN = 0.05  # width of the histogram of -log10 p
TOP = 300.0
BLOCK = 256  # items of an array that are folded at a time


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _blocks(rows: Column) -> Column:
    """An array cut into arrays of at most ``BLOCK`` items; an empty one is one empty block."""
    last = F.greatest(F.floor((F.size(rows) - 1) / BLOCK), F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda g: F.slice(rows, g * BLOCK + 1, F.lit(BLOCK)))


def _running(rows: Column, state: Column, item: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """Fold over an array that gives an item of type ``item`` for each of its own: ``step`` makes the next state and the
    item. An array grows by copying, so items are gathered in blocks and the blocks are put together at the end."""
    none = F.array().cast(f"array<{item}>")

    def one(acc: Column, row: Column) -> Column:
        after, made = step(acc["state"], row)
        return F.struct(after.alias("state"), F.concat(acc["out"], F.array(made)).alias("out"))

    def block(acc: Column, part: Column) -> Column:
        inner = F.aggregate(part, F.struct(acc["state"].alias("state"), none.alias("out")), one)
        return _bind(
            inner, lambda i: F.struct(i["state"].alias("state"), F.concat(acc["out"], F.array(i["out"])).alias("out"))
        )

    start = F.struct(state.alias("state"), F.array().cast(f"array<array<{item}>>").alias("out"))
    return _bind(rows, lambda all_: F.aggregate(_blocks(all_), start, block, lambda acc: F.flatten(acc["out"])))


def _spans(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as (start, end, value); value is the given group."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    steps = F.zip_with(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole)),
        F.arrays_zip(whole.alias("w"), value.alias("v")),
        lambda piece, m: F.struct(F.length(piece).alias("gap"), F.length(m["w"]).alias("len"), m["v"].alias("value")),
    )

    def place(at: Column, s: Column) -> tuple[Column, Column]:
        end = at + s["gap"] + s["len"]
        return end, F.struct((at + s["gap"]).alias("start"), end.alias("end"), s["value"].alias("value"))

    kind = "struct<start:int,end:int,value:string>"
    found = _running(steps, F.lit(0), kind, place)
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(F.array().cast(f"array<{kind}>"))


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function, logistic approximation; good to 2e-4 and smooth in the tails."""
    z = F.least(F.greatest(z, F.lit(-12.0)), F.lit(12.0))
    return 1.0 / (1.0 + F.exp(-(1.5976 * z + 0.07056 * z * z * z)))


def battery(found: Column, letters: tuple[float, float] = ORDINARY_LETTERS) -> Column:
    """Spans with their tests: encoding, length and z of uniformity, runs and serial correlation, and ``p``:
    the chance that ordinary text of this length looks as random. Spans have a letter and two letters or digits.
    ``letters``: rates of ordinary letters, that two agree and that neighbours are a vowel and a consonant."""
    agreeing, changing = letters

    known = ["start", "end", "value"]

    def add(rows: Column, **fields: Callable[[Column], Column]) -> Column:
        # one transform to a new struct for each step, so that no expression is written out twice
        names = list(known)
        known.extend(fields)
        return F.transform(
            rows,
            lambda s: F.struct(*(s[c].alias(c) for c in names), *(make(s).alias(c) for c, make in fields.items())),
        )

    rows = add(found, body=lambda s: F.rtrim(s["value"], F.lit("=")))
    rows = add(rows, plain=lambda s: F.regexp_replace(s["body"], "[+/_-]", ""))
    rows = add(
        rows,
        code=lambda s: F.when(
            s["plain"].rlike("^([0-9a-f]+|[0-9A-F]+)$") & s["plain"].rlike("[0-9]") & s["plain"].rlike("[a-fA-F]"), "hex"
        )
        .when(s["plain"].rlike("^[A-Z2-7]+$") & s["plain"].rlike("[2-7]") & s["plain"].rlike("[A-Z]"), "base32")
        .when(~s["plain"].rlike("[0-9]"), "letters")
        .when(s["body"].rlike("[0-9]") & s["body"].rlike("[a-z]") & s["body"].rlike("[A-Z]"), "base64")
        .otherwise("base36"),
    )
    rows = add(
        rows,
        alphabet=lambda s: F.when(s["code"] == "hex", HEX_DIGITS)
        .when(s["code"] == "base32", BASE32)
        .when(s["code"] == "base36", BASE36)
        .when(s["code"] == "letters", LETTERS)
        .otherwise(BASE64),
        # url-safe base64 is read as plain base64
        read=lambda s: F.when(s["code"].isin("hex", "base36", "letters"), F.lower(s["plain"]))
        .when(s["code"] == "base32", s["plain"])
        .otherwise(F.translate(s["body"], "-_", "+/")),
        kinds=lambda s: F.when(
            s["code"] == "letters",
            F.regexp_replace(F.regexp_replace(F.lower(s["plain"]), f"[{VOWELS}]+", "0"), "[a-z]+", "1"),
        ).otherwise(F.regexp_replace(F.regexp_replace(
                F.regexp_replace(F.when(s["code"] == "base64", s["body"]).otherwise(s["plain"]), "[a-z]+", "a"), "[A-Z]+", "A"
            ),
            "[0-9]+",
            "0",
        )),
    )
    rows = add(
        rows,
        n=lambda s: F.length(s["read"]).cast("double"),
        k=lambda s: F.length(s["alphabet"]).cast("double"),
        symbols=lambda s: F.filter(F.split(s["read"], ""), lambda c: c != ""),
    )
    rows = add(
        rows,
        codes=lambda s: F.transform(s["symbols"], lambda c: F.instr(s["alphabet"], c).cast("double") - 1.0),
        squares=lambda s: F.aggregate(
            F.array_distinct(s["symbols"]),
            F.lit(0.0),
            lambda acc, c: acc + F.pow(s["n"] - F.length(F.replace(s["read"], c, F.lit(""))), F.lit(2.0)),
        ),
    )
    rows = add(
        rows,
        pairs=lambda s: F.zip_with(
            F.slice(s["codes"], F.lit(1), F.size(s["codes"]) - 1),
            F.slice(s["codes"], F.lit(2), F.size(s["codes"]) - 1),
            lambda a, b: F.struct(a.alias("a"), b.alias("b")),
        ),
        high=lambda s: F.size(F.filter(s["codes"], lambda c: c >= s["k"] / 2)).cast("double"),
        mean=lambda s: F.aggregate(s["codes"], F.lit(0.0), lambda acc, c: acc + c) / s["n"],
    )
    rows = add(
        rows,
        runs=lambda s: 1.0 + F.size(F.filter(s["pairs"], lambda p: (p["a"] >= s["k"] / 2) != (p["b"] >= s["k"] / 2))),
        usual_runs=lambda s: 1.0 + 2.0 * s["high"] * (s["n"] - s["high"]) / s["n"],
        spread=lambda s: F.greatest(
            F.aggregate(s["codes"], F.lit(0.0), lambda acc, c: acc + F.pow(c - s["mean"], F.lit(2.0))), F.lit(1e-9)
        ),
        product=lambda s: F.aggregate(
            s["pairs"], F.lit(0.0), lambda acc, p: acc + (p["a"] - s["mean"]) * (p["b"] - s["mean"])
        ),
        agree=lambda s: (s["squares"] - s["n"]) / (s["n"] * (s["n"] - 1)),
        usual=lambda s: F.when(s["code"] == "hex", ORDINARY_AGREE_HEX)
        .when(s["code"] == "base36", ORDINARY_AGREE_36)
        .when(s["code"] == "letters", agreeing)
        .otherwise(ORDINARY_AGREE),
        changes=lambda s: F.length(s["kinds"]) - 1.0,
    )
    rows = add(
        rows,
        z_chi=lambda s: (s["squares"] * s["k"] / s["n"] - s["n"] - (s["k"] - 1))
        / F.sqrt(2.0 * (s["k"] - 1) * (s["n"] - 1) / s["n"]),
        z_runs=lambda s: (s["runs"] - s["usual_runs"])
        / F.sqrt(F.greatest((s["usual_runs"] - 1) * (s["usual_runs"] - 2) / (s["n"] - 1), F.lit(1e-9))),
        z_serial=lambda s: (s["product"] / s["spread"] + 1.0 / s["n"]) * F.sqrt(s["n"]),
        # against ordinary text: fewer agreeing characters, more changes between upper, lower and digits
        p_agree=lambda s: normal_cdf(
            (s["agree"] - s["usual"])
            / F.sqrt(2.0 * s["usual"] * (1 - s["usual"]) / (s["n"] * (s["n"] - 1)) + 0.3 * s["usual"] * s["usual"] / s["n"])
        ),
        # of letters: fewer changes between vowels and consonants
        p_change=lambda s: F.when(
            s["code"] == "letters",
            normal_cdf((s["changes"] - changing * (s["n"] - 1)) / F.sqrt((s["n"] - 1) * changing * (1 - changing))),
        ).otherwise(normal_cdf(
            (ORDINARY_CHANGE * (s["n"] - 1) - s["changes"])
            / F.sqrt((s["n"] - 1) * ORDINARY_CHANGE * (1 - ORDINARY_CHANGE))
        )),
    )
    # Fisher's sum of the two logarithms: chi-squared with four degrees of freedom, in closed form
    rows = add(rows, half=lambda s: -F.log(s["p_agree"]) - F.log(s["p_change"]))
    return F.transform(
        rows,
        lambda s: F.struct(
            *(s[c].alias(c) for c in ("start", "end", "code", "n", "z_chi", "z_runs", "z_serial")),
            F.when(
                F.greatest(F.abs(s["z_chi"]), F.abs(s["z_runs"]), F.abs(s["z_serial"])) <= REJECT,
                # length-aware: a weight in proportion to length, 1 at 40 characters
                F.least(F.lit(1.0), F.exp(-s["half"]) * (1.0 + s["half"]) * 40.0 / s["n"]),
            )
            .otherwise(1.0)
            .alias("p"),
        ),
    )


def ordinary_letters(docs: DataFrame) -> tuple[float, float]:
    """Rates of the letters of all texts: that two agree, and that neighbours are a vowel and a consonant. English
    ones count as ``KNOWN_LETTERS`` more, so that a few texts of keys do not pass for ordinary."""
    text = F.lower(F.coalesce("text", F.lit("")))
    marks = "".join("0" if c in VOWELS else "1" for c in LETTERS)
    # digits give way first: they stand for vowels and consonants then
    kinds = F.translate(F.translate(text, "01", "  "), LETTERS, marks)
    rows = docs.select(text.alias("text"), kinds.alias("kinds"))
    text, kinds = F.col("text"), F.col("kinds")

    def times(value: Column, part: str) -> Column:
        return (F.octet_length(value) - F.octet_length(F.replace(value, F.lit(part), F.lit("")))) / len(part)

    counts = [F.sum(times(text, c)).alias(c) for c in LETTERS]
    found = rows.agg(
        *counts,
        *(F.sum(times(kinds, pair)).alias(f"c{pair}") for pair in ("01", "10")),
        F.sum(F.regexp_count("kinds", F.lit("[01]+"))).alias("runs"),
    ).first()
    n = float(sum(found[c] or 0 for c in LETTERS))
    agree = sum(((found[c] or 0) / n) ** 2 for c in LETTERS) if n else 0.0
    mixed = lambda known, seen, weight: (known * KNOWN_LETTERS + seen) / (KNOWN_LETTERS + weight)
    changes, pairs = sum(float(found[c] or 0) for c in ("c01", "c10")), n - float(found["runs"] or 0)
    return mixed(ORDINARY_LETTERS[0], agree * n, n), mixed(ORDINARY_LETTERS[1], changes, pairs)


def _candidates(text: Column, letters: tuple[float, float]) -> Column:
    """Candidates of a text with their tests."""
    tested = lambda s: s["value"].rlike("[A-Za-z]") & s["value"].rlike("[A-Za-z0-9][+/_-]*[A-Za-z0-9]")
    return battery(F.filter(_spans(text, CANDIDATE), tested), letters)


def discovery_bounds(docs: DataFrame, letters: tuple[float, float], rate: float = RATE) -> dict[str, float]:
    """For each encoding the largest weighted p that keeps the false-discovery rate over its candidates in ``docs``;
    none for an encoding without any.

    The p values are counted in bins of 0.05 decades, at most 6,001 of them for each encoding whatever the input."""
    p = docs.select(F.explode(_candidates(F.coalesce("text", F.lit("")), letters)).alias("s")).select(
        F.col("s.code").alias("code"),
        F.floor(F.least(-F.log10(F.greatest(F.col("s.p"), F.lit(1e-300))), F.lit(TOP)) / BIN).alias("bin"),
    )
    bins = p.groupBy("code", "bin").agg(F.count("*").alias("n"))
    of = Window.partitionBy("code")
    ranked = bins.select("code", "bin", F.sum("n").over(of.orderBy(F.desc("bin"))).alias("found"), F.sum("n").over(of).alias("all"))
    kept = ranked.filter(F.pow(F.lit(10.0), -F.col("bin") * BIN) <= rate * F.col("found") / F.col("all"))
    return {r["code"]: 10.0 ** (-r["least"] * BIN) for r in kept.groupBy("code").agg(F.min("bin").alias("least")).collect()}


def scan(docs: DataFrame, name: str, rate: float = RATE) -> DataFrame:
    """``docs`` with a column ``name``: all spans as (start, kind rank, end, kind), sorted by start, then kind."""
    letters = ordinary_letters(docs)
    bounds = discovery_bounds(docs, letters, rate)
    text = F.coalesce("text", F.lit(""))
    base, found = fresh(docs, "base_spans"), fresh(docs, "found_spans")

    def named(spans: Column, rank: int) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(KINDS[rank]).alias("kind")
            ),
        )

    assigned = F.filter(_spans(text, ASSIGN, 2), lambda s: F.length(s["value"]) >= ASSIGN_LEAST)
    spans = F.concat(named(assigned, 0), named(_spans(text, ACCESS), 1), named(_spans(text, HEX), 2))
    discovered = lambda s: F.lit(False)
    if bounds:
        limits = F.create_map(*(F.lit(x) for pair in bounds.items() for x in pair))
        discovered = lambda s: F.coalesce(s["p"] <= F.try_element_at(limits, s["code"]), F.lit(False))
    with_base = docs.withColumn(base, spans).withColumn(found, named(F.filter(_candidates(text, letters), discovered), 3))
    return with_base.withColumn(name, _new(F.array_sort(F.concat(base, found)))).drop(base, found)


def _new(spans: Column) -> Column:
    """Sorted spans without the discoveries inside or across a base span, which say nothing new. Discoveries do not
    overlap each other: of the spans after one only the next can begin in it."""
    fields = ("start", "rank", "end", "kind")

    def held(reached: Column, s: Column) -> tuple[Column, Column]:
        me, following = s["me"], s["following"]
        random = me["rank"] == 3
        ahead = F.coalesce((following["rank"] < 3) & (following["start"] < me["end"]), F.lit(False))
        clash = random & ((reached > me["start"]) | ahead)
        kept = F.struct(*(me[c].alias(c) for c in fields), clash.alias("clash"))
        return F.when(random, reached).otherwise(F.greatest(reached, me["end"])), kept

    def pairs(rows: Column) -> Column:
        after = F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0)))
        return F.zip_with(rows, after, lambda me, following: F.struct(me.alias("me"), following.alias("following")))

    kind = "struct<start:int,rank:int,end:int,kind:string,clash:boolean>"
    told = _running(_bind(spans, pairs), F.lit(0), kind, held)
    return F.transform(F.filter(told, lambda s: ~s["clash"]), lambda s: F.struct(*(s[c].alias(c) for c in fields)))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: counts of the base kinds, digest of the base spans, all spans."""
    count = lambda rank: F.size(F.filter("secrets", lambda s: s["rank"] == rank)).cast("long")
    return scan(docs.select("doc_id", "text"), "secrets").select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_joined(F.filter("secrets", lambda s: s["rank"] < 3)).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("secrets")).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``; overlapping spans give one mark.
    ``n_chars``, where there is one, is counted anew for changed texts. Null texts stay null."""
    spans, clean = fresh(docs, "secrets"), fresh(docs, "clean_text")
    text = F.col("text")

    def gap(at: Column, s: Column) -> tuple[Column, Column]:
        return F.greatest(at, s["end"]), F.struct(at.alias("from"), s["start"].alias("to"))

    # what stands before each mark; a span that begins inside an earlier one has none of its own
    gaps = F.filter(_running(F.col(spans), F.lit(0), "struct<from:int,to:int>", gap), lambda g: g["from"] <= g["to"])

    def cut(part: Column) -> Column:
        # a block's stretch of the text first, so that no piece is looked for from the beginning of the text
        first, last = part[0]["from"], F.element_at(part, -1)["to"]
        return _bind(
            F.substring(text, first + 1, last - first),
            lambda stretch: F.array_join(
                F.transform(part, lambda g: F.concat(F.substring(stretch, g["from"] - first + 1, g["to"] - g["from"]), F.lit(mark))), ""
            ),
        )

    reached = F.array_max(F.transform(spans, lambda s: s["end"]))
    before = _bind(gaps, lambda rows: F.array_join(F.transform(_blocks(rows), cut), ""))
    replaced = F.concat(before, F.substring(text, reached + 1, F.length(text)))
    changed = F.size(spans) > 0
    out = scan(docs, spans).withColumn(clean, F.when(changed, replaced).otherwise(text))
    new = {"text": F.col(clean), "n_chars": F.when(changed, F.length(clean).cast("long")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*(new[c].alias(c) if c in new else F.col(c) for c in docs.columns))
